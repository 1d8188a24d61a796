"""Main text of an HTML page by its structure, with the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages shorter than this are no pages, texts shorter than this no articles.
MIN_PAGE = 2_000
MIN_TEXT = 200
_SKIP = {"script", "style", "nav", "header", "footer", "aside", "form", "table", "noscript", "figure", "button", "svg"}
_BLOCK = {"p", "h1", "h2", "h3", "h4", "li", "blockquote", "br", "div", "section", "article", "main"}
_VOID = {"br", "img", "hr", "meta", "link", "input", "source"}


class _Main(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.blocks: list[tuple[bool, list[str]]] = [(False, [])]

    def handle_starttag(self, tag, attrs):
        if tag not in _VOID:
            self.stack.append(tag)
        if tag in _BLOCK:
            self.blocks.append(("article" in self.stack or "main" in self.stack, []))

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass
        if tag in _BLOCK:
            self.blocks.append(("article" in self.stack or "main" in self.stack, []))

    def handle_data(self, data):
        if not any(t in _SKIP for t in self.stack) and data.strip():
            self.blocks[-1][1].append(data.strip())


def main_text(html: str | None) -> str | None:
    """The blocks inside ``article`` or ``main``, else all blocks of a sentence's length; None under MIN_TEXT characters."""
    if not html:
        return None
    parser = _Main()
    parser.feed(html)
    parser.close()
    blocks = [(inside, " ".join(words)) for inside, words in parser.blocks if words]
    chosen = [t for inside, t in blocks if inside] or [t for _, t in blocks if len(t) >= 60]
    text = "\n".join(chosen)
    return text if len(text) >= MIN_TEXT else None


@F.udf(T.StringType(), useArrow=True)
def _main_text(html):
    return main_text(html)


def extract_main(html):
    """Column: main text of a page, null where there is none."""
    return _main_text(F.col(html) if isinstance(html, str) else html)


def acquire(direct, reader, reader_status):
    """(text, status): the direct page, else the reader service's, each taken only if a text can be drawn from it.

    A page under MIN_PAGE characters counts as failed; a limit of the reader service means try again.
    """
    page = F.when(F.length(direct) >= MIN_PAGE, extract_main(direct))
    text = F.coalesce(page, extract_main(reader))
    return F.struct(text.alias("text"), F.when(text.isNotNull(), "fetched").when(reader_status == 429, "ratelimited").otherwise("failed").alias("status"))
