import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsquarry.llm.canonical import LATIN_MAPPING, LOOKALIKES, MAPPING, build_mappings, canonical, canonical_column, checked, kinds, noncanonical_fields

CASES = [
    ("ｎｇườｉ", "người", ["width"]), ("yêu cầu", "yêu cầu", ["accent"]), ("ậ", "ậ", ["accent"]), ("ậ", "ậ", ["accent"]), ("ậ", "ậ", ["accent"]), ("n­u​ôi", "nuôi", ["invisible"]), ("Sở Lao　động", "Sở Lao động", ["space"]),
    ("vàο", "vào", ["lookalike"]), ("Кelоra", "Kelora", ["lookalike"]), ("CΟ₂", "CO₂", ["lookalike"]), ("Ðình ðổi", "Đình đổi", ["lookalike"]), ("a​̣", "ạ", ["invisible", "accent"]), ("ｅ̂", "ê", ["width", "accent"]),
]
CLEAN = ["«завод удобрений»", "肥料工場", "Δ và α", "CO₂ µg/m³ ½", "👩‍🔧 kỹ sư", "hoà hòa", "“trích” – dài…", "x̂ q̃", "tab\tvà\nxuống dòng", "", "می‌خواهم", "ﬁ"]


@pytest.mark.parametrize("raw,want,what", CASES)
def test_cases(raw, want, what):
    assert canonical(raw) == want and kinds(raw) == what


@pytest.mark.parametrize("raw", CLEAN)
def test_left_alone(raw):
    assert canonical(raw) == raw and kinds(raw) == []


def test_mapping_has_no_conflicts():
    every, latin = build_mappings()
    assert every == MAPPING and latin == LATIN_MAPPING and set(LOOKALIKES) <= set(latin)
    for m in (every, latin):
        assert not set(m.values()) & set(m)
    for entries in ([("а", "a"), ("а", "o")], [("а", "a"), ("a", "b")]):
        with pytest.raises(ValueError):
            checked(entries)


@pytest.mark.parametrize("raw,want", [("b\ufe0fạn", "bạn"), ("tin\U000e0041", "tin"), ("a\u2065b", "ab"), ("\u212bngström", "Ångström"), ("bɑn", "ban"), ("Ꮇột", "Một"), ("ᴛin", "tin"), ("вàn\u0301g", "вàńg"), ("kа\u0323", "kạ"), ("\ufeff\u0301x", "\u0301x")])
def test_more_cases(raw, want):
    assert canonical(raw) == want


@pytest.mark.parametrize("raw", ["❤\ufe0f 1\ufe0f\u20e3 ☎\ufe0e", "\U0001f3f4\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f", "葛\U000e0100", "300 \u212a và 5 \u212b", "ᏣᎳᎩ", "葛\ufe00", "и\u0306"[:1]])
def test_needed_ones_stay(raw):
    assert canonical(raw) == raw


ALPHABET = st.text(st.sampled_from("aáạậoợ̛́̂ｂ​  \nοсðđΔж1.*‍👩🔧"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_twice_is_once_and_composed(text):
    once = canonical(text)
    assert canonical(once) == once and kinds(once) == []
    assert (kinds(text) != []) == (once != text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aăâeêoôơuưyàáảãạằắẳẵặầấẩẫậđ bcxyz"), max_size=30))
def test_decomposed_text_comes_back(text):
    assert canonical(unicodedata.normalize("NFD", text)) == text


def test_fields(spark):
    rows = [("1", "Βên", None, "", "v"), ("1", "Βên", None, "", "v"), ("2", None, "sạch", "a b " * 30_000, "v"), (None, "Βên", "x", "y", "v")]
    df = spark.createDataFrame(rows, "article_id string, title string, sapo string, body string, value string")
    got = sorted((r.article_id or "", r.field_name, r.kind) for r in noncanonical_fields(df, "article_id", ["title", "sapo", "body"]).collect())
    assert got == [("", "title", "lookalike"), ("1", "title", "lookalike"), ("2", "body", "space")]
    assert noncanonical_fields(df.limit(0), "article_id", ["title"]).count() == 0
    assert [r.c for r in df.limit(2).select(canonical_column("title").alias("c")).collect()] == ["Bên", "Bên"]
