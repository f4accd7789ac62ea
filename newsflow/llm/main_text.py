"""Main text of web pages, with a suffix array per host to find its boilerplate.

Markup decides what it can: navigation, page headers and footers, asides, forms, scripts,
and blocks whose class, id or role says menu, advert, notice or comments are left out, and
where a page marks its article that is the main text. The rest is decided by repetition.
The token streams of a host's pages are laid end to end and their suffixes sorted by their
first RUN tokens; suffixes that are equal that far on enough distinct pages mark a long
repeated run. Runs that only markup-free text has are boilerplate when few pages share
them; inside a marked article only text of most pages is. Covered tokens are removed and
the unique runs stay.

Pages are counted by their own text: copies of a text, and pages that are little more
than a text others have, are one context of a run. Runs stay inside a zone, do not reach
past the place where their pages part, and take of a block they enter all or nothing.

Pages are dealt into chunks of about CHUNK_BYTES of a host, pages of equal text into the same
one, so that the contexts of a run are the sum over the chunks. A run that has a share of the
contexts of a host has it in one of its chunks at least: each chunk names the runs that it
finds that often, all chunks of the host count the named ones, and the sums decide. So the
text does not depend on the number of chunks, and no task holds a large host.
"""

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b
from html.parser import HTMLParser
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.functions.html import BLOCK_TAGS
from newsflow.llm.blocks import bucketed, mix64, rows_of
from newsflow.llm.common import each, session_of, stored

RUN = 8  # tokens; a power of two
CHUNK_BYTES = 12_000_000  # of HTML; some two million tokens
# (pages, share of pages) from which a run is boilerplate: in a marked article, and elsewhere.
IN_ARTICLE = (10, 0.6)
ELSEWHERE = (3, 0.05)
# A page with less than this share of its text outside of repeated runs is a copy.
COPY_IN_ARTICLE, COPY_ELSEWHERE = 0.5, 0.1
# Pages part at the end of a run if fewer than this share of them go on alike.
GO_ON = 0.5
# A run of fewer contexts is boilerplate nowhere.
LEAST, SHARE = map(min, zip(IN_ARTICLE, ELSEWHERE))

CHROME, ARTICLE, BODY = 0, 1, 2
_FIRST = 4  # added to the zone of a block's first token
# HTML elements without end tags.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# HTML elements whose content is not shown as text.
SILENT_TAGS = frozenset(
    "script style noscript template iframe svg canvas object head title select button "
    "textarea datalist audio video math".split()
)
SIBLING_TAGS = frozenset("p li dt dd tr td th".split())
CHROME_TAGS = frozenset("nav footer aside form dialog menu".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split()
)
# Words in a class or id that say what a block is.
CHROME_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs "
    "comment comments disqus replies consent cookie cookies gdpr footer masthead menu modal nav "
    "navbar navigation newsletter notice notices notification pagination popup promo promoted "
    "promotion recommended related share sharing sidebar sidenav signup social sponsor sponsored "
    "subscribe teaser toolbar topbar widget".split()
)
# First words of names that say what is around a block, as in "has-sidebar".
_AROUND = frozenset("has with without no".split())
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Reader(HTMLParser):
    """Blocks of a page with their zone, in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int]] = []
        self.stack: list[tuple[str, int, bool]] = []  # tag, zone inside, silent inside
        self.open: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.zone, self.silent = BODY, False

    def end_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.blocks.append((text, self.zone))
        self.pieces = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK_TAGS:
            self.end_block()
        if tag in VOID_TAGS:
            return
        zone, silent = self.inside(tag, attrs)
        if zone != self.zone:
            self.end_block()
        if self.stack and self.stack[-1][0] == tag and tag in SIBLING_TAGS:
            self.pop()  # its end tag was left out
            zone, silent = self.inside(tag, attrs)
        self.open[tag] += 1
        self.stack.append((tag, self.zone, self.silent))
        self.zone, self.silent = zone, silent

    def inside(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[int, bool]:
        """Zone and silence of what stands inside a tag that opens here."""
        zone, silent = self.zone, self.silent or tag in SILENT_TAGS
        if zone != CHROME:
            if _is_chrome(tag, attrs) or (tag == "header" and zone != ARTICLE):
                zone = CHROME
            elif tag in ("article", "main"):
                zone = ARTICLE
        return zone, silent

    def pop(self) -> str:
        tag, zone, silent = self.stack.pop()
        self.open[tag] -= 1
        if zone != self.zone:
            self.end_block()
        self.zone, self.silent = zone, silent
        return tag

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.end_block()
        if self.open[tag]:
            while self.pop() != tag:
                pass

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """The slash of a tag counts where nothing of it is shown; else it means nothing."""
        self.handle_starttag(tag, attrs)
        if tag in SILENT_TAGS:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.pieces.append(data)


def _is_chrome(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in CHROME_TAGS:
        return True
    for name, value in attrs:
        value = value or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in CHROME_ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            for label in value.split():
                words = [word.lower() for word in _NAME_WORDS.findall(label)]
                if not CHROME_WORDS.isdisjoint(words) and words[0] not in _AROUND:
                    return True
    return False


def page_blocks(html: str) -> list[tuple[str, int]]:
    """(text, zone) of each block of a page; white space inside a block is one space."""
    reader = _Reader()
    last = html.rfind("<")
    if last > html.rfind(">") and re.match(r"<[a-zA-Z/!]", html[last : last + 2]):
        html = html[:last]  # the page ends inside a tag
    reader.feed(html)
    reader.close()
    reader.end_block()
    return reader.blocks


def _host(url: str | None) -> str:
    try:
        return urlsplit(url or "").netloc.lower()
    except ValueError:
        return ""


def _hosts(url: Column) -> Column:
    def hosts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_host(value.as_py()) for value in batch], pa.string())

    return F.arrow_udf(hosts, "string")(url)


def _digest(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: its host, a digest of its text, and its tokens as 24-bit hashes with zones and
    block starts, deflated. Of pages that a task finds again there is one row.

    A run has RUN tokens, so a chance collision of one token is all but harmless.
    """
    seen: set[int] = set()
    for batch in batches:
        hosts, pages, owners, tokens = [], [], [], []
        for host, page, html in each(batch, "host", "page", "html"):
            if page in seen:
                continue
            seen.add(page)
            blocks = page_blocks(html)
            words = [
                (w, zone if i else zone | _FIRST) for text, zone in blocks for i, w in enumerate(text.split(" "))
            ]
            hashes = np.fromiter((zlib.crc32(w.encode()) for w, _ in words), np.uint32, len(words))
            zones = np.fromiter((zone for _, zone in words), np.uint8, len(words))
            wanted = ARTICLE if any(zone == ARTICLE for _, zone in blocks) else BODY
            planes = hashes.view(np.uint8).reshape(-1, 4)[:, :3].T
            hosts.append(host)
            pages.append(page)
            owners.append(_digest(planes[:, zones & (_FIRST - 1) == wanted].tobytes()))
            tokens.append(zlib.compress(planes.tobytes() + zones.tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()),
                pa.array(pages, pa.int64()),
                pa.array(owners, pa.int64()),
                pa.array(tokens, pa.binary()),
            ],
            names=["host", "page", "owner", "tokens"],
        )


def sorted_runs(tokens: np.ndarray, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array to a depth of RUN tokens: suffixes in order, and a rank for each.

    Suffixes get equal ranks if their first RUN tokens are equal. Ranks of twice the length
    come from pairs of ranks (prefix doubling). Suffixes with fewer tokens on their page
    are left out of the order and have rank -1.
    """
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64)
    length = 1
    while length < RUN:
        after = np.zeros(n, dtype=np.int64)
        after[: max(n - length, 0)] = rank[length:] + 1
        _, rank = np.unique(rank * (n + 1) + after, return_inverse=True)
        length *= 2
    whole = np.zeros(n, dtype=bool)
    if n >= RUN:
        whole[: n - RUN + 1] = pages[: n - RUN + 1] == pages[RUN - 1 :]
    rank = np.where(whole, rank, -1)
    order = np.argsort(rank, kind="stable")
    return order[int((~whole).sum()) :], rank


def contexts(tokens: np.ndarray, segments: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For each token, how many distinct owners have the run that starts there (0: no run).

    Runs lie inside a segment.
    """
    found = np.zeros(len(tokens), dtype=np.int64)
    order, rank = sorted_runs(tokens, segments)
    if not len(order):
        return found
    order = order[np.lexsort((owners[order], rank[order]))]
    ranks, own = rank[order], owners[order]
    first = np.r_[True, ranks[1:] != ranks[:-1]]
    new_owner = first | np.r_[True, own[1:] != own[:-1]]
    group = np.cumsum(first) - 1
    found[order] = np.bincount(group, new_owner)[group].astype(np.int64)
    return found


def over_tokens(runs: np.ndarray) -> np.ndarray:
    """For each token, the largest value of a run over it."""
    found = runs.copy()
    for shift in range(1, RUN):
        found[shift:] = np.maximum(found[shift:], runs[: max(len(runs) - shift, 0)])
    return found


def repeated(tokens: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """For each token, on how many distinct pages a run over it is found at most."""
    return over_tokens(contexts(tokens, pages, pages))


def _past_parting(at: np.ndarray) -> np.ndarray:
    """Runs that overlap a run of more than 1 / GO_ON times as many contexts.

    Such a run begins or ends in text that only some of the larger run's pages go on with.
    """
    # at a token: the largest run that starts at it or up to RUN - 1 tokens before or after
    most = np.maximum(over_tokens(at), over_tokens(at[::-1])[::-1])
    return at < GO_ON * most


def _covered(at: np.ndarray, least: float, block: np.ndarray) -> np.ndarray:
    """Tokens of boilerplate runs; runs over several blocks take whole blocks only."""
    chosen = (at >= least) & ~_past_parting(at)
    ends = np.minimum(np.arange(len(at)) + RUN - 1, len(at) - 1)
    inside = over_tokens((chosen & (block == block[ends])).astype(np.int8)) > 0
    across = over_tokens(chosen.astype(np.int8)) > 0
    whole = np.bincount(block, ~across) == 0
    return inside | (across & whole[block])


_CHUNK_DDL = "block long, host string, chunks int, pages array<long>, owners array<long>, sizes array<int>, tokens binary"


def _chunk(rows: pa.Table) -> pa.Table:
    """The pages of a chunk as one row; repeated rows are one page."""
    _, once = np.unique(rows["page"].to_numpy(), return_index=True)
    rows = rows.take(pa.array(np.sort(once)))
    parts = [zlib.decompress(x.as_py()) for x in rows["tokens"]]
    planes = np.concatenate([np.frombuffer(x, np.uint8).reshape(4, -1) for x in parts], axis=1)
    first = rows.slice(0, 1).to_pylist()[0]
    return pa.table(
        {
            "block": pa.array([first["block"]], pa.int64()),
            "host": pa.array([first["host"]], pa.string()),
            "chunks": pa.array([first["chunks"]], pa.int32()),
            "pages": pa.array([rows["page"].to_pylist()], pa.list_(pa.int64())),
            "owners": pa.array([rows["owner"].to_pylist()], pa.list_(pa.int64())),
            "sizes": pa.array([[len(x) // 4 for x in parts]], pa.list_(pa.int32())),
            "tokens": pa.array([zstandard.ZstdCompressor(level=3).compress(planes.tobytes())], pa.binary()),
        }
    )


def run_keys(tokens: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of the run that starts at each token, and whether it lies in one segment."""
    n = len(tokens)
    key = mix64(tokens.astype(np.uint64) + np.uint64(1))
    length = 1
    while length < RUN:
        after = np.zeros(n, dtype=np.uint64)
        after[: max(n - length, 0)] = key[length:]
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + after)
        length *= 2
    whole = np.zeros(n, dtype=bool)
    if n >= RUN:
        whole[: n - RUN + 1] = segments[: n - RUN + 1] == segments[RUN - 1 :]
    return key.view(np.int64), whole


class Chunk:
    """Pages of a host, laid end to end.

    An owner is a text that one page or equal pages have; ``copies`` are the pages whose text
    is little more than what others have, and all of them have one owner in the host.
    """

    def __init__(self, row: dict) -> None:
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["tokens"]), np.uint8)
        low, middle, high, marks = raw.reshape(4, -1)
        self.tokens = low.astype(np.uint32) | middle.astype(np.uint32) << 8 | high.astype(np.uint32) << 16
        self.zones = marks & (_FIRST - 1)
        self.block = np.cumsum(marks >= _FIRST) - 1
        self.page = page = np.repeat(np.arange(len(self.sizes)), self.sizes)
        zones = self.zones
        self.segment = np.cumsum(np.r_[True, (page[1:] != page[:-1]) | (zones[1:] != zones[:-1])][: len(page)])
        self.in_article = np.bincount(page[zones == ARTICLE], minlength=len(self.sizes)) > 0
        self.wanted = zones == np.where(self.in_article[page], ARTICLE, BODY)
        self.owner = np.unique(np.array(row["owners"], dtype=np.int64), return_inverse=True)[1]
        self.keys, self.whole = run_keys(self.tokens, self.segment)

    def own(self, copies: np.ndarray) -> int:
        """Owners without that of the copies."""
        return len(np.unique(self.owner[~copies]))

    def frequent(self, copies: np.ndarray, chunks: int) -> np.ndarray:
        """Keys of the runs that may be boilerplate by what this chunk has of them."""
        owner = np.where(copies, self.owner.max(initial=0) + 1, self.owner)
        at = contexts(self.tokens, self.segment, owner[self.page])
        return np.unique(self.keys[(at > 0) & (at >= max(SHARE * self.own(copies), LEAST / chunks))])

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens at which one of the sorted keys starts, and the number of the key."""
        if not len(keys):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        # most tokens are ruled out by the last bits of their key
        known = np.zeros(1 << 20, dtype=bool)
        known[keys & 0xFFFFF] = True
        at = np.flatnonzero(self.whole & known[self.keys & 0xFFFFF])
        number = np.minimum(np.searchsorted(keys, self.keys[at]), len(keys) - 1)
        same = keys[number] == self.keys[at]
        return at[same], number[same]

    def counts(self, keys: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key, how many owners have the run, and whether a copy has it."""
        at, number = self.places(keys)
        copied = copies[self.page[at]]
        owners = int(self.owner.max(initial=0)) + 1
        held = np.unique(number[~copied] * owners + self.owner[self.page[at[~copied]]]) // owners
        return np.bincount(held, minlength=len(keys)), np.bincount(number[copied], minlength=len(keys)) > 0

    def boilerplate(self, keys: np.ndarray, counts: np.ndarray, whole: int) -> np.ndarray:
        """Which tokens are boilerplate of their page's text; ``whole`` is the host's owners."""
        at = np.zeros(len(self.tokens), dtype=np.int64)
        place, number = self.places(keys)
        at[place] = counts[number]
        drop = np.zeros(len(at), dtype=bool)
        for zone, (least, share) in ((ARTICLE, IN_ARTICLE), (BODY, ELSEWHERE)):
            drop |= (self.zones == zone) & _covered(at, max(least, share * whole), self.block)
        return drop & self.wanted

    def copies(self, drop: np.ndarray) -> np.ndarray:
        """Pages whose text is little more than boilerplate."""
        size = np.bincount(self.page[self.wanted], minlength=len(self.sizes))
        own = size - np.bincount(self.page[drop], minlength=len(self.sizes))
        return (own < np.where(self.in_article, COPY_IN_ARTICLE, COPY_ELSEWHERE) * size) & (own < size)

    def removed(self, drop: np.ndarray) -> list[list[int]]:
        """The places of tokens to remove from each page."""
        ends = np.cumsum(self.sizes)
        found = zip((ends - self.sizes).tolist(), ends.tolist())
        return [np.flatnonzero(drop[start:end]).tolist() for start, end in found]


_TYPES = {
    "long": pa.int64(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
    "array<boolean>": pa.list_(pa.bool_()),
    "array<array<int>>": pa.list_(pa.list_(pa.int32())),
}


def _per_chunk(rows: DataFrame, answer: Callable[..., dict], **columns: str) -> DataFrame:
    """A row per chunk: block, host, and the columns that ``answer`` gives.

    It gets the chunk, the row, the keys and counts of runs that came with it, and its copies.
    """
    columns = {"block": "long", "host": "string"} | columns
    schema = pa.schema([(name, _TYPES[kind]) for name, kind in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, counts = (np.array(row.get(name) or [], dtype=np.int64) for name in ("keys", "counts"))
            copies = np.array(row.get("copies") or [False] * len(row["pages"]), dtype=bool)
            found = answer(Chunk(row), row, keys, counts, copies)
            found |= {"block": row["block"], "host": row["host"]}
            yield pa.RecordBatch.from_pylist([found], schema=schema)

    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in columns.items()))


def _named(chunk: Chunk, row: dict, keys: np.ndarray, counts: np.ndarray, copies: np.ndarray) -> dict:
    return {"whole": chunk.own(copies), "keys": chunk.frequent(copies, row["chunks"])}


def _counted(chunk: Chunk, row: dict, keys: np.ndarray, counts: np.ndarray, copies: np.ndarray) -> dict:
    own, copied = chunk.counts(keys, copies)
    held = (own > 0) | copied
    return {"keys": keys[held], "counts": own[held], "copied": copied[held]}


def _decided(chunk: Chunk, row: dict, keys: np.ndarray, counts: np.ndarray, copies: np.ndarray) -> dict:
    drop = chunk.boilerplate(keys, counts, row["whole"])
    copies = chunk.copies(drop)
    again = chunk.frequent(copies, row["chunks"]) if copies.any() else []
    found = {"pages": row["pages"], "places": chunk.removed(drop), "copies": copies}
    return found | {"whole": chunk.own(copies), "keys": again}


def _told(blocks: DataFrame, whole: DataFrame, runs: DataFrame, *others: DataFrame) -> DataFrame:
    """Chunks of the hosts in ``whole`` (host, block, whole) with their host's runs (host, key,
    count), in the order of the keys. Chunks are bucketed by block: what they are told moves."""
    pairs = F.sort_array(F.collect_list(F.struct("key", "count")))
    lists = runs.groupBy("host").agg(pairs.alias("runs"))
    lists = lists.select("host", F.col("runs.key").alias("keys"), F.col("runs.count").alias("counts"))
    told = blocks.join(whole.join(lists, "host", "left").drop("host"), "block")
    for other in others:
        told = told.join(other, "block")
    return told


def _totals(told: DataFrame, whole: DataFrame) -> DataFrame:
    """Contexts in the whole host of the runs that chunks were asked for: host, key, count."""
    found = _per_chunk(told, _counted, keys="array<long>", counts="array<long>", copied="array<boolean>")
    rows = found.select("host", F.explode(F.arrays_zip("keys", "counts", "copied")).alias("run"))
    count = F.sum("run.counts") + F.max(F.col("run.copied").cast("int"))  # copies have one owner
    summed = rows.groupBy("host", F.col("run.keys").alias("key")).agg(count.alias("count"))
    often = (F.col("count") >= LEAST) & (F.col("count") >= F.floor(SHARE * F.col("whole")))
    summed = summed.join(whole.select("host", "whole").distinct(), "host").where(often)
    return stored(summed.select("host", "key", "count"), "run-totals")


def _whole(chunks: DataFrame, copies: int) -> DataFrame:
    """The owners of each chunk's host: host, block, whole."""
    sums = chunks.groupBy("host").agg((F.sum("whole") + copies).alias("whole"))
    return chunks.select("host", "block").join(sums, "host")


def _removed(blocks: DataFrame) -> DataFrame:
    """Tokens to remove from the pages: page, and their places.

    Runs are counted, and then once more in hosts that have copies, with one owner for all.
    """

    def asked(chunks: DataFrame) -> DataFrame:
        return chunks.select("host", F.explode("keys").alias("key")).distinct().withColumn("count", F.lit(0))

    named = stored(_per_chunk(blocks, _named, whole="long", keys="array<long>"), "named-runs")
    whole = _whole(named, 0)
    totals = _totals(_told(blocks, whole, asked(named)), whole)
    decided = {"pages": "array<long>", "places": "array<array<int>>"}
    more = {"copies": "array<boolean>", "whole": "long", "keys": "array<long>"}
    first = stored(_per_chunk(_told(blocks, whole, totals), _decided, **decided, **more), "boilerplate-first")

    copied = first.where(F.exists("copies", lambda copy: copy)).select("host").distinct()
    of_copied = first.join(copied, "host", "left_semi")
    whole = _whole(of_copied, 1)
    keys = named.select("host", "keys").join(copied, "host", "left_semi").unionByName(of_copied.select("host", "keys"))
    totals = _totals(_told(blocks, whole, asked(keys), of_copied.select("block", "copies")), whole)
    second = _per_chunk(_told(blocks, whole, totals), _decided, **decided, **more)
    found = first.join(copied, "host", "left_anti").unionByName(second)
    each_page = found.select(F.explode(F.arrays_zip("pages", "places")).alias("found"))
    each_page = each_page.select(F.col("found.pages").alias("page"), F.col("found.places").alias("places"))
    return stored(each_page.where(F.size("places") > 0), "boilerplate")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, places in each(batch, "html", "places"):
            texts.append(_text(page_blocks(html), set(places or ())))
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def _text(blocks: list[tuple[str, int]], removed: set[int]) -> str:
    wanted = ARTICLE if any(zone == ARTICLE for _, zone in blocks) else BODY
    lines, place = [], 0
    for text, zone in blocks:
        words = text.split(" ")
        if zone == wanted:
            if removed:
                text = " ".join([w for i, w in enumerate(words, place) if i not in removed])
            if text:
                lines.append(text)
        place += len(words)
    return "\n".join(lines)


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text.

    A null html is empty and gives an empty text; a null or unreadable url belongs to the
    host with the empty name. Repeated rows and pages of equal text are one page for the
    counts and give a row each. Other columns are not looked at. An empty table gives no rows.
    """
    session_of(pages)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("host", _hosts(F.col("url"))).withColumn("page", F.xxhash64("host", "html"))
    # Hosts of one chunk are left out, so this is small unless the corpus has many large
    # hosts; its size is known once it is written, and Spark joins by it.
    hosts = rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("whole"))
    large = stored(
        hosts.where(F.col("whole") > CHUNK_BYTES).select(
            "host", F.ceil(F.col("whole") / CHUNK_BYTES).cast("int").alias("chunks")
        ),
        "large-hosts",
    )
    streams = rows.select("host", "page", "html").mapInArrow(
        _streams, "host string, page long, owner long, tokens binary"
    )
    dealt = streams.join(large, "host", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    block = F.xxhash64("host", F.pmod("owner", "chunks"))
    dealt = dealt.select(block.alias("block"), "host", "chunks", "page", "owner", "tokens")
    removed = _removed(bucketed(dealt.groupBy("block").applyInArrow(_chunk, _CHUNK_DDL), "block"))
    return (
        rows.join(removed, "page", "left")
        .select("page_id", "url", "html", "places")
        .mapInArrow(_texts, "page_id long, url string, text string")
    )
