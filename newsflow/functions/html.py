"""One pass over a page's HTML: links, metadata groups and text blocks.

The only Python in the hot path. It is an Arrow UDF rather than ``mapInPandas`` so
that other columns stay in the JVM, filters on them still reach the scan, and Spark
bounds each batch by bytes (``spark.sql.execution.arrow.maxBytesPerBatch``).
Everything derived from its result is built-in expressions.
"""

import re
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, functions as F

# HTML elements that end the running text block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav "
    "ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
# Elements with raw text, elements whose text is not shown, elements around
# an article, and elements that hold one.
RAW_TAGS = frozenset("script style textarea title".split())
HIDDEN_TAGS = frozenset("noscript template".split())
CHROME_TAGS = frozenset("nav footer aside".split())
CONTENT_TAGS = frozenset("article main".split())

# A comment opening, a tag, or markup to skip. A quote counts only after "=", and every
# loop is possessive, so the scan is linear in the page even where tags are left open.
_TOKEN = re.compile(
    r"""<(?:(!--)
        |(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)
        |[!?/][^>]*+>?)""",
    re.VERBOSE,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+"""
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW_TAGS}

PARTS = ("links", "meta", "blocks")
# Characters of pages that are Python objects at once. A page with more stands alone.
SLICE_CHARS = 1_000_000
_DDL = {
    "links": "array<string>",
    "meta": "map<string,map<string,string>>",
    "blocks": "array<struct<text:string,words:int,link_words:int,chrome:boolean>>",
}
_ARROW = {
    "links": pa.list_(pa.string()),
    "meta": pa.map_(pa.string(), pa.map_(pa.string(), pa.string())),
    "blocks": pa.list_(
        pa.struct(
            [
                ("text", pa.string()),
                ("words", pa.int32()),
                ("link_words", pa.int32()),
                ("chrome", pa.bool_()),
            ]
        )
    ),
}


def _attributes(source: str) -> dict[str, str]:
    """Attributes of a tag with entities decoded; the first of a name wins."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class PageReader:
    """Collects hrefs, metadata and text blocks of one page in document order."""

    def __init__(self, with_blocks: bool) -> None:
        self.links: list[str] = []
        self.meta: dict[str, dict[str, str]] = {}
        self.blocks: list[dict] = []
        self._with_blocks = with_blocks
        self._hidden = self._chrome = 0
        self._in_link = False
        self._pieces: list[str] = []
        self._link_words = 0

    def _put(self, group: str, key: str, value: str | None) -> None:
        if key and value:
            self.meta.setdefault(group, {}).setdefault(key, value)

    def _read_meta(self, attrs: dict[str, str]) -> None:
        self._put("meta", "charset", attrs.get("charset"))
        name = attrs.get("property") or attrs.get("name") or attrs.get("http-equiv") or ""
        lowered = name.lower()
        for group, prefix in (("og", "og:"), ("twitter", "twitter:"), ("dc", "dc.")):
            if lowered.startswith(prefix):
                return self._put(group, lowered[len(prefix) :], attrs.get("content"))
        self._put("meta", lowered, attrs.get("content"))

    def _text(self, text: str) -> None:
        if text and not self._hidden:
            text = unescape(text)
            self._pieces.append(text)
            if self._in_link:
                self._link_words += len(text.split())

    def _end_block(self) -> None:
        words = "".join(self._pieces).split()
        if words:
            self.blocks.append(
                {
                    "text": " ".join(words),
                    "words": len(words),
                    "link_words": self._link_words,
                    "chrome": self._chrome > 0,
                }
            )
        self._pieces, self._link_words = [], 0

    def _structure(self, tag: str, opens: bool) -> None:
        step = 1 if opens else -1
        if tag in BLOCK_TAGS:
            self._end_block()
        if tag in HIDDEN_TAGS:
            self._hidden = max(0, self._hidden + step)
        elif tag in CHROME_TAGS:
            self._chrome = max(0, self._chrome + step)
        elif tag in CONTENT_TAGS and opens:
            self._chrome = 0

    def read(self, html: str) -> None:
        at, end = 0, html.rfind(">") + 1
        while (token := _TOKEN.search(html, at, end)) is not None:
            if self._with_blocks:
                self._text(html[at : token.start()])
            at = token.end()
            comment, closing, name, source = token.groups()
            if comment:
                close = html.find("-->", token.start() + 2)
                at = close + 3 if close >= 0 else len(html)
            if not name:
                continue
            tag = name.lower()
            if self._with_blocks:
                self._structure(tag, not closing)
            if tag == "a":
                self._in_link = not closing
            if closing:
                continue
            if tag == "a":
                href = _attributes(source).get("href")
                if href is not None:
                    self.links.append(href)
            elif tag == "meta":
                self._read_meta(_attributes(source))
            elif tag == "link":
                attrs = _attributes(source)
                if attrs.get("rel", "").lower() == "canonical":
                    self._put("page", "canonical", attrs.get("href"))
            elif tag in RAW_TAGS and not source.endswith("/"):
                close = _RAW_END[tag].search(html, at)
                stop = close.start() if close else len(html)
                if tag == "title":
                    self._put("page", "title", unescape(html[at:stop]))
                at = stop
        if self._with_blocks:
            self._text(html[at:])
            self._end_block()


def read_page(html: str | None, parts: tuple[str, ...] = PARTS) -> dict | None:
    """The asked-for parts of one page."""
    if html is None:
        return None
    reader = PageReader("blocks" in parts)
    reader.read(html)
    found = {
        "links": reader.links,
        "meta": [(group, list(pairs.items())) for group, pairs in reader.meta.items()],
        "blocks": reader.blocks,
    }
    return {part: found[part] for part in parts}


def page_parser(*parts: str) -> Callable[[Column], Column]:
    """An Arrow UDF that returns a struct of the asked-for parts of a page.

    Ask only for what is used: text blocks are as large as the page itself.
    """
    wanted = tuple(p for p in PARTS if p in (parts or PARTS))
    arrow_type = pa.struct([(p, _ARROW[p]) for p in wanted])
    spark_type = "struct<" + ",".join(f"{p}:{_DDL[p]}" for p in wanted) + ">"

    def slices(batch: pa.Array) -> Iterator[pa.Array]:
        # Results are many times larger as Python objects than as Arrow arrays.
        found, size = [], 0
        for value in batch:
            html = value.as_py()
            if found and size + len(html or "") > SLICE_CHARS:
                yield pa.array(found, type=arrow_type)
                found, size = [], 0
            found.append(read_page(html, wanted))
            size += len(html or "") + 100
        yield pa.array(found, type=arrow_type)

    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays(slices(batch))

    return F.arrow_udf(parse, spark_type)


def first_of(meta: Column, *path: tuple[str, str]) -> Column:
    """First non-empty value among (group, key) places of a metadata map, or ''."""
    found = [F.nullif(meta[group][key], F.lit("")) for group, key in path]
    return F.coalesce(*found, F.lit(""))
