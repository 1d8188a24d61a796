"""One consistent form for text that looks the same but differs in its characters.

A transducer is compiled once from rules over the Unicode character database:
width forms, separate accents, spaces, invisible characters and look-alike
letters each give a set of ``source -> target`` entries, and so do their
products, such as a look-alike letter with a separate accent.  All entries are
checked for conflicts (one source, one target; no target is itself a source)
and put into tries: one for every text, and one, with the look-alikes, for words
that otherwise are of the Latin alphabet.  Text is rewritten in one pass over
grapheme clusters with the longest match.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquarry.session import Remembered

# Characters that by default show nothing and are not of the category of format characters, as ranges.
IGNORABLE = ((0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x2065, 0x2065), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0xE0000, 0xE0FFF))
# Format characters that do show something.
SHOWN = ((0x0600, 0x0605), (0x06DD, 0x06DD), (0x070F, 0x070F), (0x0890, 0x0891), (0x08E2, 0x08E2), (0xFFF9, 0xFFFB))
# Letters of other alphabets, and what each looks like.
LOOKALIKE_SOURCE = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοАВЕКМНОРСТУХаеорсухіІјЈѕЅһԁԛԝοօɡıðÐƉɖɑ"
LOOKALIKE_TARGET = "ABEZHIKMNOPTYXoABEKMHOPCTYXaeopcyxiIjJsShdqwoogiđĐĐđa"
# Cherokee letters and small capitals, and what each looks like.
LOOKALIKE_SOURCE += "ᎪᏴᏟᎠᎬᎶᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ" + "ᴀʙᴄᴅᴇɢʜɪᴊᴋʟᴍɴᴏᴘʀꜱᴛᴜᴠᴡʏᴢ"
LOOKALIKE_TARGET += "ABCDEGHJKLMPRSTVWZ" + "abcdeghijklmnoprstuvwyz"
# Letters that also are signs of formulas and units, so they need a longer word around them.
FORMULA_SOURCE = "ακνρυιτ\u212a\u212b"
FORMULA_TARGET = "akvpuitKÅ"
# Look-alikes that count even where no other letter of the word is Latin, as they are of its blocks.
_OWN_BLOCK = frozenset("ðÐƉɖı")
_MARKS = "\u0300-\u036f"
_JOINERS = "\u200c\u200d"
_KEYCAP, _FLAG = "\u20e3", "\U0001f3f4"


def _invisible() -> frozenset[str]:
    """Format characters and those that are ignorable by default, but for those that show something."""
    inside = lambda c, ranges: any(a <= c <= b for a, b in ranges)
    found = {chr(c) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Cf" and not inside(c, SHOWN)}
    return frozenset(found | {chr(c) for a, b in IGNORABLE for c in range(a, b + 1)})


def _spaces() -> frozenset[str]:
    return frozenset(chr(c) for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs")


def _compositions() -> dict[str, str]:
    """Every spelling of a composed letter in which at least one accent is a character of its own."""
    out: dict[str, str] = {}
    for code in range(0xC0, 0x2000):
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) < 2 or unicodedata.normalize("NFC", letter) != letter:
            continue
        if not all(unicodedata.combining(m) for m in parts[1:]):
            continue
        for marks in set(itertools.permutations(parts[1:])):
            for k in range(len(marks)):
                head = unicodedata.normalize("NFC", parts[0] + "".join(marks[:k]))
                source = head + "".join(marks[k:])
                if len(head) == 1 and unicodedata.normalize("NFC", source) == letter:
                    out[source] = letter
    return out


def _lookalikes() -> dict[str, str]:
    """Letters that look like Latin ones, also with accents of their own."""
    out = dict(zip(LOOKALIKE_SOURCE + FORMULA_SOURCE, LOOKALIKE_TARGET + FORMULA_TARGET))
    for source, target in list(out.items()):
        for code in itertools.chain(range(0x386, 0x3D0), range(0x400, 0x460)):
            parts = unicodedata.normalize("NFD", chr(code))
            if len(parts) > 1 and parts[0] == source:
                whole = unicodedata.normalize("NFC", target + parts[1:])
                if len(whole) == 1:
                    out[chr(code)] = whole
    return out


INVISIBLE, SPACES, LOOKALIKES = _invisible(), _spaces(), _lookalikes()
WIDTH = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}


def checked(entries: list[tuple[str, str]], base: dict[str, str] | None = None) -> dict[str, str]:
    """The entries as one mapping laid over ``base``; raises ValueError where two of them disagree or a target is itself a source."""
    own: dict[str, str] = {}
    for source, target in entries:
        if own.setdefault(source, target) != target:
            raise ValueError(f"two targets for {source!r}: {own[source]!r} and {target!r}")
    out = (base or {}) | own
    for source, target in out.items():
        if target in out:
            raise ValueError(f"the target of {source!r} is itself a source")
    return out


def build_mappings() -> tuple[dict[str, str], dict[str, str]]:
    """(entries for every text, entries for Latin words)."""
    composed = _compositions()
    wide: dict[str, list[str]] = {}
    for source, target in WIDTH.items():
        wide.setdefault(target, []).append(source)
    alike: dict[str, list[str]] = {}
    for source, target in LOOKALIKES.items():
        alike.setdefault(target, []).append(source)
    products = lambda heads: [(h + source[1:], target) for source, target in composed.items() for h in heads.get(source[0], ())]
    every = checked([*WIDTH.items(), *((c, " ") for c in SPACES), *((c, "") for c in INVISIBLE), *composed.items(), *products(wide)])
    return every, checked([*LOOKALIKES.items(), *products(alike)], every)


MAPPING, LATIN_MAPPING = build_mappings()


def _trie(mapping: dict[str, str]) -> dict:
    root: dict = {}
    for source, target in mapping.items():
        node = root
        for c in source:
            node = node.setdefault(c, {})
        node[""] = target
    return root


_ANY, _LATIN = _trie(MAPPING), _trie(LATIN_MAPPING)
_FORMULA = frozenset(FORMULA_SOURCE)


def _class(chars) -> str:
    """The characters as the inside of a character class, neighbours joined to ranges."""
    codes = sorted(map(ord, set(chars)))
    runs: list[list[int]] = []
    for c in codes:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(re.escape(chr(a)) + ("-" + re.escape(chr(b)) if b > a else "") for a, b in runs)


_TAIL = _MARKS + _class(INVISIBLE)
_TRIGGERS = _TAIL + _class(set(WIDTH) | SPACES | set(LOOKALIKES))
_TRIGGER = re.compile(f"[{_TRIGGERS}]")
_CHUNK = re.compile(f"[^ \n\t\r]*?[{_TRIGGERS}][^ \n\t\r]*")
_LOOK = re.compile(f"[{_class(LOOKALIKES)}]")
#: A cluster: a character and the accents and invisible characters that hang on it.
_CLUSTER = re.compile(f"(?s)(.)([{_TAIL}]*)")


def _latin(c: str) -> bool:
    return ("a" <= c <= "z") or ("A" <= c <= "Z") or ("\u00c0" <= c <= "\u024f") or ("\u1e00" <= c <= "\u1eff")


def _is_emoji(c: str) -> bool:
    return unicodedata.category(c) in ("So", "Sk", "Sm") or c in "\u203c\u2049\u3030\u303d\u2139"


def _keeps(c: str, text: str, i: int) -> bool:
    """Whether the invisible character ``c`` at ``i`` is needed: inside emoji, and in words of scripts that need it."""
    before, after = text[i - 1] if i else "", text[i + 1] if i + 1 < len(text) else ""
    if c in _JOINERS:
        return _keeps_joiner(before, after)
    if "\ufe00" <= c <= "\ufe0f" or "\U000e0100" <= c <= "\U000e01ef":
        return bool(before) and (after == _KEYCAP or _is_emoji(before) or (unicodedata.category(before)[0] == "L" and not _latin(before)))
    if "\U000e0020" <= c <= "\U000e007f":  # the tags of a flag
        while i and "\U000e0020" <= text[i] <= "\U000e007f":
            i -= 1
        return text[i] == _FLAG
    return False


def _keeps_joiner(before: str, after: str) -> bool:
    if not before or not after or ord(before) < 0x600 or ord(after) < 0x600:
        return False
    if _latin(before) or _latin(after) or before in WIDTH or after in WIDTH or before in SPACES or after in SPACES:
        return False
    kinds = (unicodedata.category(before), unicodedata.category(after))
    emoji = ("So", "Sk", "Mn")
    if kinds[0] in emoji and kinds[1] in ("So", "Sk"):
        return True
    return all(k[0] in "LM" for k in kinds) and not any(0x1100 <= ord(c) < 0x1200 for c in (before, after))


def _is_latin_word(bases: list[str]) -> bool:
    """Whether the letters of a word, some of them look-alikes, are of the Latin alphabet but for these."""
    look = [c for c in bases if c in LOOKALIKES]
    latin = sum(_latin(c) and c not in LOOKALIKES for c in bases)
    if any(c.isalpha() and not _latin(c) and c not in LOOKALIKES for c in bases):  # the word is of another alphabet
        return False
    if not latin and any(c not in _OWN_BLOCK for c in look):
        return False
    return latin >= 2 or not any(c in _FORMULA for c in look)


def _rewritten(base: str, marks: str, trie: dict) -> str:
    """The longest match of ``trie`` in a cluster, and what of it remains."""
    node, best, end = trie.get(base), base, 0
    if node:
        best = node.get("", base)
        for j, m in enumerate(marks, 1):
            node = node.get(m)
            if not node:
                break
            if "" in node:
                best, end = node[""], j
    return best + marks[end:]


def _fix_chunk(text: str) -> str:
    out: list[str] = []
    word: list[tuple[str, str]] = []
    alike = False

    def close() -> None:
        nonlocal alike
        if word:
            trie = _LATIN if alike and _is_latin_word([b for b, _ in word]) else _ANY
            out.extend(_rewritten(b, t, trie) for b, t in word)
            word.clear()
        alike = False

    for c in _CLUSTER.finditer(text):
        base, tail = c.groups()
        if tail:
            at = c.start() + 1
            tail = "".join(x for k, x in enumerate(tail) if x not in INVISIBLE or _keeps(x, text, at + k))
        if base in INVISIBLE:  # only at the beginning, elsewhere they hang on what is before them
            out.append((base if _keeps(base, text, c.start()) else "") + tail)
            continue
        base = WIDTH.get(base, base)
        if base.isalnum() and not base.isdecimal():
            word.append((base, tail))
            alike = alike or base in LOOKALIKES
            continue
        close()
        out.append(_rewritten(base, tail, _ANY))
    close()
    return "".join(out)


_fixed = Remembered(_fix_chunk, 100_000)


def canonical(text: str) -> str:
    """``text`` in the one consistent form; clean text is returned as it is."""
    return _CHUNK.sub(lambda m: _fixed[m.group()], text) if _TRIGGER.search(text) else text


def kinds(text: str) -> list[str]:
    """Which kinds of difference ``text`` holds, in a fixed order."""
    if not _TRIGGER.search(text) or (fixed := canonical(text)) == text:
        return []
    out = []
    if any(c in WIDTH for c in text):
        out.append("width")
    if any(c in SPACES for c in text):
        out.append("space")
    if sum(c in INVISIBLE for c in text) > sum(c in INVISIBLE for c in fixed):
        out.append("invisible")
    marks = re.compile(f"[{_MARKS}]")
    if len(marks.findall(text)) > len(marks.findall(fixed)):
        out.append("accent")
    if len(_LOOK.findall(text)) > len(_LOOK.findall(fixed)):
        out.append("lookalike")
    return out


@F.udf(T.StringType(), useArrow=True)
def _canonical_udf(text):
    return None if text is None else canonical(text)


def canonical_column(column: Column | str) -> Column:
    """The column in the consistent form; null stays null.

    Every value goes to Python: looking for the characters in question there takes a
    third of the time that ``rlike`` takes for them in the JVM.
    """
    c = F.col(column) if isinstance(column, str) else column
    return _canonical_udf(c)


def noncanonical_fields(df: DataFrame, id_column: str, fields: list[str]) -> DataFrame:
    """One row (id, field_name, kind) for each field of ``df`` and each kind of difference it holds.

    Null and empty values hold none.  Rows repeated in the input give their rows once.
    Other columns of ``df``, whatever their names, play no part.
    """
    long = df.select(
        F.col(id_column).alias("id"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x"),
    ).select("id", "x.field_name", "x.value")
    suspicious = long.where(F.col("value").isNotNull())

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, f, k) for i, f, v in zip(*(b.column(x).to_pylist() for x in range(3))) for k in kinds(v)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], b.schema.field(0).type), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                ["id", "field_name", "kind"],
            )

    schema = T.StructType([T.StructField("id", df.schema[id_column].dataType), T.StructField("field_name", T.StringType()), T.StructField("kind", T.StringType())])
    return suspicious.mapInArrow(detect, schema).distinct().withColumnRenamed("id", id_column)
