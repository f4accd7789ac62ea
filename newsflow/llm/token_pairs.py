"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked id pairs.

Both tokenizers cut the same bytes; ends that both share cut them into groups, and tokens
whose bytes overlap are linked. How many documents link a pair of ids is counted
externally: tasks cut their documents into blocks, and write a block's pairs, radix-dealt
by the first id, as sorted runs of zstd frames. A task merges the runs of a radix
partition by a heap, frame by frame, and adds up the counts of each pair. Runs are in the
order of the first id, so each id's highest count is known when the next id comes. Counts
and marks then stream back to the blocks, in the order in which each block holds its pairs.

Texts are cut into chunks where no token of either side crosses. Both sides end there, so a
chunk's links and groups are the same in every text, and a frequent chunk is aligned once.

A block counts a pair once per document before anything is shuffled, so a pair that all
documents hold costs one entry per block. A radix partition's merged pairs are bounded by
the two vocabularies.
"""

import heapq
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow.llm.blocks import bucketed, rows_of
from newsflow.llm.common import each, session_of, stored

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# Links and documents of a block, about; a longer document has a block of its own.
BLOCK_LINKS, BLOCK_DOCS = 1_000_000, 20_000
RADIX = 64
# Pairs in a frame of a run; runs that a task merges at once; blocks that one task answers.
FRAME_PAIRS, FAN_IN, ANSWERED = 4096, 256, 1024
# Characters given to a tokenizer at once.
_BATCH_CHARS = 500_000
_SECOND_BITS = 32
_U = np.uint64


@dataclass
class Tokens:
    """The tokens of one text: their ids and the ends of their bytes."""

    ids: np.ndarray
    ends: np.ndarray


# Texts of these characters are cut into words below: letters, digits, blanks and marks that
# all versions of Unicode class alike.
_LETTER, _DIGIT, _BLANK = "A-Za-zÀ-ÖØ-öø-ʯ", "0-9", "\t\n\r "
_PLAIN = re.compile(f"[{_BLANK}!-~¡-¨«»¿{_LETTER}]*")
# The pattern of byte-level vocabularies, over those characters. No token crosses its words.
_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_BLANK}{_LETTER}{_DIGIT}]+"
    f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
# Distinct words whose ids a task keeps.
KEPT_WORDS = 400_000
# A chunk begins at a space behind one of !-~, or at a mark behind a letter, all of ASCII. The
# pattern of byte-level vocabularies cuts there whatever surrounds it; that no entry of either
# vocabulary has such a place inside is looked up.
_MARK = r"!-/:-@\[-`{-~"
_CHUNK = re.compile(rf"[ {_MARK}][^ {_MARK}]*+(?:(?:(?<![A-Za-z])[{_MARK}]|(?<![!-~]) )[^ {_MARK}]*+)*+(?: ++\Z)?+")
_INSIDE = re.compile(rf"[!-~] |[A-Za-z][{_MARK}]".encode())
# A chunk that any other may follow.
_STEM = " a"
# Distinct chunks and characters that a worker keeps, and once more of those it kept before;
# texts of longer chunks, on average, are read whole.
KEPT_CHUNKS, KEPT_CHARS, LONG_CHUNK = 150_000, 3_000_000, 50


class Vocabulary:
    """The bytes of each id, and a tokenizer whose ids are checked against the bytes of a text.

    With ``words``, which cuts plain texts where no token crosses, the ids of words are kept,
    so that a frequent word is encoded once.
    """

    def __init__(
        self,
        pieces: list[bytes],
        encode: Callable[[list[str]], list[list[int]]],
        words: Callable[[str], list[str]] | None = None,
        encode_words: Callable[[list[str]], list[list[int]]] | None = None,
        controls: frozenset[int] = frozenset(),
    ) -> None:
        self.pieces = pieces
        # Ids of control strings aside, which no text has, no token crosses chunks.
        self.chunked = not any(_INSIDE.search(p) for i, p in enumerate(pieces) if i not in controls)
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.encode, self.words, self.encode_words = encode, words, encode_words
        self.kept: dict[str, bytes] = {}  # packed ids
        self.unspelled: set[str] = set()

    def tokens(self, texts: list[str]) -> list[Tokens | None]:
        """Tokens of each text, None where they do not spell a space and the text."""
        plain = [i for i, text in enumerate(texts) if self.words and _PLAIN.fullmatch(text)]
        others = sorted(set(range(len(texts))) - set(plain))
        found: list[Tokens | None] = [None] * len(texts)
        for i, own in zip(others, self.whole([texts[i] for i in others])):
            found[i] = own
        cut = [self.words(texts[i]) for i in plain]
        if cut:
            self._learn(cut)
        for i, words in zip(plain, cut):
            if self.unspelled.isdisjoint(words):
                ids = np.frombuffer(b"".join(map(self.kept.__getitem__, words)), dtype=np.int32)
                found[i] = self._tokens(ids.astype(np.int64))
        return found

    def whole(self, texts: list[str]) -> list[Tokens | None]:
        """As ``tokens``, of texts that are encoded in one piece."""
        return [
            self._tokens(np.array(ids, dtype=np.int64)) if self._spells(ids, b" " + text.encode()) else None
            for text, ids in zip(texts, self.encode(texts))
        ]

    def _tokens(self, ids: np.ndarray) -> Tokens:
        return Tokens(ids, np.cumsum(self.lengths[ids]))

    def _spells(self, ids: list[int], expected: bytes) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids)) == expected

    def _learn(self, cut: list[list[str]]) -> None:
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
            self.unspelled.clear()
        new = list(set().union(*cut).difference(self.kept))
        found = self.encode_words(new)
        ends = np.cumsum([0, *map(len, found)])
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]))
        packed, at = ids.tobytes(), (ids.itemsize * ends).tolist()
        self.kept.update((word, packed[s:e]) for word, s, e in zip(new, at, at[1:]))
        # All words are checked at once: their bytes in one row, and where each word ends.
        sizes = np.diff(np.cumsum(np.append(0, self.lengths[ids]))[ends])
        words = [word.encode() for word in new]
        if sizes.tolist() != [*map(len, words)] or not self._spells(ids.tolist(), b"".join(words)):
            self.unspelled.update(word for word, own in zip(new, found) if not self._spells(own, word.encode()))


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte.

    Printable characters of Latin-1 stand for themselves, the others for those from 256 on.
    """
    printable = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(data: bytes) -> Vocabulary:
    """A byte-level BPE from its JSON file. Strings of special tokens are plain text."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has its own core
    tokenizer = Tokenizer.from_str(data.decode())
    tokenizer.encode_special_tokens = True
    letters = _byte_letters()
    described = json.loads(data)
    vocabulary = {**described["model"]["vocab"], **{t["content"]: t["id"] for t in described["added_tokens"]}}
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        pieces[number] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()

    def encode_words(words: list[str]) -> list[list[int]]:
        return [found.ids for found in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode(texts: list[str]) -> list[list[int]]:
        return encode_words([" " + text for text in texts])

    controls = frozenset(t["id"] for t in described["added_tokens"] if t["special"])
    return Vocabulary(pieces, encode, lambda text: _WORD.findall(" " + text), encode_words, controls)


def piece_level(data: bytes) -> Vocabulary:
    """A SentencePiece model from its file. It puts a space before the text by itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=data)

    def spelled(number: int) -> bytes:
        piece = model.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode()

    pieces = [spelled(number) for number in range(model.get_piece_size())]
    def encode(texts: list[str]) -> list[list[int]]:
        return model.encode(texts, num_threads=1)

    controls = frozenset(i for i in range(len(pieces)) if model.is_control(i) or model.is_unknown(i))
    return Vocabulary(pieces, encode, controls=controls)


class Writer:
    """Group strings of documents, joined from one prepared text per id and place."""

    def __init__(self, first: int, second: int) -> None:
        # a token's number, then what follows it inside its side of a group and at its end
        self.texts = [f"{i}{end}" for ends, n in ((",|", first), (",;", second)) for i in range(n) for end in ends]
        self.sizes = np.array([len(text) for text in self.texts])
        self.offset = 2 * first

    def written(self, a: Tokens, b: Tokens, common: np.ndarray) -> tuple[str, np.ndarray]:
        """The text of all groups, with a mark too many, and where in it the text of each token ends."""
        ends_a, ends_b = (np.zeros(len(side.ids), dtype=np.int64) for side in (a, b))
        ends_a[np.searchsorted(a.ends, common)] = 1
        ends_b[np.searchsorted(b.ends, common)] = 1
        group_a = np.cumsum(ends_a) - ends_a
        group_b = np.cumsum(ends_b) - ends_b
        sizes_a, sizes_b = np.bincount(group_a), np.bincount(group_b)
        order = np.empty(len(a.ids) + len(b.ids), dtype=np.int64)
        # before a token: its own side's tokens, and the other side's in earlier groups (B: in its own, too)
        order[np.arange(len(a.ids)) + (np.cumsum(sizes_b) - sizes_b)[group_a]] = 2 * a.ids + ends_a
        order[np.arange(len(b.ids)) + np.cumsum(sizes_a)[group_b]] = self.offset + 2 * b.ids + ends_b
        return "".join(map(self.texts.__getitem__, order.tolist())), np.cumsum(self.sizes[order])


def aligned(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The pair of ids of each link, in order, and the byte ends that both sides share.

    All ends together cut the bytes into parts; each part is the overlap of one token of
    either side, and each overlap is one part.
    """
    all_ends = np.sort(np.concatenate([a.ends, b.ends]), kind="stable")
    single = np.append(all_ends[1:] != all_ends[:-1], True)
    ends = all_ends[single]
    first = a.ids[np.searchsorted(a.ends, ends)]
    second = b.ids[np.searchsorted(b.ends, ends)]
    pairs = (first.astype(_U) << _U(_SECOND_BITS)) | second.astype(_U)
    return pairs, all_ends[~single]


def frozen(array: np.ndarray) -> bytes:
    """An array as a zstd frame, byte plane by byte plane."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def thawed(frame: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).reshape(-1)


def _gaps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=_U(0))


_DOC_FIELDS = "n_a n_b n_groups n_links".split()
_DOC_TYPE = pa.struct(
    [("doc_id", pa.int64()), *((n, pa.int64()) for n in _DOC_FIELDS), ("groups_sha256", pa.string()), ("distinct", pa.int32())]
)
_BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("docs", pa.list_(_DOC_TYPE)),
        ("pairs", pa.binary()),
        ("held", pa.binary()),
        ("records", pa.binary()),
        ("times", pa.binary()),
    ]
)
_BLOCK_DDL = (
    f"block long, docs array<struct<doc_id: long, {', '.join(n + ': long' for n in _DOC_FIELDS)}, groups_sha256: string, distinct: int>>, "
    "pairs binary, held binary, records binary, times binary"
)


def _dealt(pairs: np.ndarray) -> np.ndarray:
    """The order in which a block holds its pairs: by radix of the first id, then by pair."""
    return np.lexsort((pairs, (pairs >> _U(_SECOND_BITS)) % _U(RADIX)))


def _block(number: int, docs: list[dict], links: list[np.ndarray]) -> pa.RecordBatch:
    """Documents, their distinct pairs in radix order, and each document's records on them."""
    sizes = [len(own) for own in links]
    doc = np.repeat(np.arange(len(docs)), sizes)
    pairs, place = np.unique(np.concatenate(links), return_inverse=True)
    order = _dealt(pairs)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    records, times = np.unique(doc * max(len(pairs), 1) + rank[place], return_counts=True)
    records_doc, records_pair = np.divmod(records, max(len(pairs), 1))
    held = np.bincount(records_pair, minlength=len(pairs)).astype(np.uint32)
    distinct = np.bincount(records_doc, minlength=len(docs))
    for own, n in zip(docs, distinct.tolist()):
        own["distinct"] = n
    row = {
        "block": number,
        "docs": docs,
        "pairs": frozen(pairs[order]),
        "held": frozen(held),
        "records": frozen(records_pair.astype(np.uint32)),
        "times": frozen(times.astype(np.uint32)),
    }
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)


def _encoded(texts: list[str], a: Vocabulary, b: Vocabulary) -> Iterator[tuple[Tokens, Tokens] | None]:
    """Tokens of both sides, or None where a side does not give the text's bytes."""
    for text, one, other in zip(texts, a.tokens(texts), b.tokens(texts)):
        yield None if not text or one is None or other is None else (one, other)


@dataclass
class Aligned:
    """What both sides make of one text."""

    n_a: int
    n_groups: int
    pairs: np.ndarray
    groups: str  # with a mark too many


class Aligner:
    """Aligns texts chunk by chunk; what is known of a chunk is kept."""

    def __init__(self, a: Vocabulary, b: Vocabulary) -> None:
        self.a, self.b = a, b
        self.writer = Writer(len(a.pieces), len(b.pieces))
        # Of each chunk: tokens of A, groups, pairs and group strings; None if a side does not spell it.
        self.kept: dict[str, tuple[int, int, bytes, str] | None] = {}
        self.before = self.kept
        self.chars = 0

    def align(self, texts: list[str]) -> Iterator[Aligned]:
        """Each text aligned; empty where a side does not spell a space and the text."""
        cut = [self._chunks(text) for text in texts]
        known = self._known(set().union(*cut))
        apart = {chunk for chunk, found in known.items() if found is None}
        whole = [i for i, chunks in enumerate(cut) if not chunks or apart and not apart.isdisjoint(chunks)]
        read = dict(zip(whole, _encoded([texts[i] for i in whole], self.a, self.b)))
        for i in read:
            cut[i] = []
        for i, joined in enumerate(_joined(cut, {chunk: found for chunk, found in known.items() if found is not None})):
            if read.get(i) is not None:
                pairs, common = aligned(*read[i])
                joined = Aligned(len(read[i][0].ids), len(common), pairs, self.writer.written(*read[i], common)[0])
            yield joined

    def _chunks(self, text: str) -> list[str]:
        """The chunks of a space and a text, or none if it is read whole."""
        chunks = _CHUNK.findall(" " + text) if text and self.a.chunked and self.b.chunked else []
        return chunks if len(text) <= LONG_CHUNK * len(chunks) else []

    def _known(self, chunks: set[str]) -> dict[str, tuple[int, int, bytes, str] | None]:
        """What is known of chunks. Those that did not come for long are forgotten."""
        if len(self.kept) > KEPT_CHUNKS or self.chars > KEPT_CHARS:
            self.kept, self.before, self.chars = {}, self.kept, 0
        missing = chunks.difference(self.kept)
        self.chars += sum(map(len, missing))
        new = missing.difference(self.before)
        self.kept.update((chunk, self.before[chunk]) for chunk in missing.difference(new))
        # New chunks are read as one text. Behind those that only end a text nothing may follow.
        last = [chunk for chunk in new if not "!" <= chunk[-1] <= "~"]
        inner = [word for chunk in new.difference(last) for word in _led(chunk)]
        apart = self._read([inner] if inner else [])
        self._read([_led(chunk) for chunk in chain(last, dict.fromkeys(apart))])
        return dict(zip(chunks, map(self.kept.__getitem__, chunks)))

    def _read(self, runs: list[list[str]]) -> list[str]:
        """Keeps what is known of the chunks of each run. Those of runs that are not spelled come back.

        The last of them is kept as one that is not, for a run of that chunk alone.
        """
        texts = ["".join(run)[1:] for run in runs]
        apart = []
        for run, text, a, b in zip(runs, texts, self.a.whole(texts), self.b.whole(texts)):
            if a is not None and b is not None:
                pairs, common = aligned(a, b)
                sizes = map(len, run) if text.isascii() else (len(chunk.encode()) for chunk in run)
                ends = np.cumsum([*sizes])
                n_a, n_b, n_groups = (np.searchsorted(own, ends, side="right") for own in (a.ends, b.ends, common))
                if np.array_equal(common[n_groups - 1], ends):
                    written, at = self.writer.written(a, b, common)
                    own_pairs = _slices(pairs.tobytes(), pairs.itemsize * (n_a + n_b - n_groups))
                    own_groups = _slices(written, at[n_a + n_b - 1])
                    counts = (np.diff(n, prepend=0).tolist() for n in (n_a, n_groups))
                    self.kept.update(zip(run, zip(*counts, own_pairs, own_groups)))
                    continue
            self.kept[run[-1]] = None
            apart += run
        return apart


def _joined(cut: list[list[str]], known: dict[str, tuple[int, int, bytes, str]]) -> Iterator[Aligned]:
    """Texts from what is known of their chunks."""
    n_a, n_groups, packed, groups = zip(*known.values()) if known else ((), (), (), ())
    number = dict(zip(known, range(len(known))))
    at = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64)
    bounds = np.cumsum([0, *map(len, cut)])
    pairs = np.frombuffer(b"".join(packed), dtype=_U)
    sizes = np.array([*map(len, packed)], dtype=np.int64) // pairs.itemsize
    first, size = (np.cumsum(sizes) - sizes)[at], sizes[at]
    ends = np.cumsum(size)
    pairs = pairs[np.repeat(first - ends + size, size) + np.arange(size.sum())]
    tokens, shared, links = (
        np.append(0, np.cumsum(np.array(n, dtype=np.int64)[at]))[bounds].tolist() for n in (n_a, n_groups, sizes)
    )
    written = dict(zip(known, groups))
    for i, chunks in enumerate(cut):
        own = pairs[links[i] : links[i + 1]]
        yield Aligned(tokens[i + 1] - tokens[i], shared[i + 1] - shared[i], own, "".join(map(written.__getitem__, chunks)))


def _led(chunk: str) -> list[str]:
    """A chunk behind one that it may follow."""
    return [chunk] if chunk[0] == " " else [_STEM, chunk]


def _slices(whole: bytes | str, ends: np.ndarray) -> list:
    """What lies between one end and the next."""
    at = [0, *ends.tolist()]
    return [whole[s:e] for s, e in zip(at, at[1:])]


@lru_cache(maxsize=1)
def _aligner(first: bytes, second: bytes) -> Aligner:
    """The tasks that a Python worker runs one after another share what is known of chunks."""
    return Aligner(byte_level(first), piece_level(second))


def _cut(first: bytes, second: bytes):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(first, second)
        number = TaskContext.get().partitionId() << 32
        docs, links, size = [], [], 0
        for doc_ids, texts in _portions(batches):
            for doc_id, found in zip(doc_ids, aligner.align(texts)):
                pairs = found.pairs
                if docs and (size + len(pairs) > BLOCK_LINKS or len(docs) == BLOCK_DOCS):
                    yield _block(number, docs, links)
                    number += 1
                    docs, links, size = [], [], 0
                # Each end of either side ends a link, and those that both share are groups' ends.
                n_b = len(pairs) + found.n_groups - found.n_a
                digest = sha256(found.groups[:-1].encode()).hexdigest() if found.groups else ""
                counts = dict(zip(_DOC_FIELDS, (found.n_a, n_b, found.n_groups, len(pairs))))
                docs.append({"doc_id": doc_id, **counts, "groups_sha256": digest})
                links.append(pairs)
                size += len(pairs)
        if docs:
            yield _block(number, docs, links)

    return cut


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about _BATCH_CHARS characters at a time."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in each(batch, "doc_id", "text"):
            doc_ids.append(doc_id)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= _BATCH_CHARS or len(texts) == 1000:
                yield doc_ids, texts
                doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, texts


_RUN_SCHEMA = pa.schema(
    [("radix", pa.int32()), ("block", pa.int64()), ("pairs", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary()))]
)
_RUN_DDL = "radix int, block long, pairs array<binary>, counts array<binary>"


def _run(radix: int, block: int, pairs: np.ndarray, counts: np.ndarray) -> dict:
    """A sorted run: frames of pairs, each as gaps from zero, and frames of their counts."""
    cuts = range(0, len(pairs), FRAME_PAIRS)
    return {
        "radix": radix,
        "block": block,
        "pairs": [frozen(_gaps(pairs[c : c + FRAME_PAIRS])) for c in cuts],
        "counts": [frozen(counts[c : c + FRAME_PAIRS].astype(np.uint64)) for c in cuts],
    }


def _bounds(pairs: np.ndarray) -> np.ndarray:
    """Where each radix begins among pairs in a block's order, with the end."""
    return np.searchsorted((pairs >> _U(_SECOND_BITS)) % _U(RADIX), np.arange(RADIX + 1, dtype=_U))


def _spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each block, one per radix partition."""
    for row in rows_of(batches):
        pairs, held = thawed(row["pairs"], _U), thawed(row["held"], np.uint32)
        at = _bounds(pairs)
        rows = [_run(r, row["block"], pairs[at[r] : at[r + 1]], held[at[r] : at[r + 1]]) for r in range(RADIX) if at[r] < at[r + 1]]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_RUN_SCHEMA)


class _Reader:
    """A run, read frame by frame."""

    def __init__(self, pairs: list[bytes], counts: list[bytes]) -> None:
        self.frames = zip(pairs, counts)
        self.next()

    def next(self) -> bool:
        frame = next(self.frames, None)
        if frame is None:
            self.pairs = np.empty(0, dtype=_U)
            return False
        self.pairs, self.counts = np.cumsum(thawed(frame[0], _U)), thawed(frame[1], _U)
        return True

    def until(self, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of this frame up to ``last``, taken away."""
        cut = int(np.searchsorted(self.pairs, _U(last), side="right"))
        taken = self.pairs[:cut], self.counts[:cut]
        self.pairs, self.counts = self.pairs[cut:], self.counts[cut:]
        return taken


def merged(runs: list[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct pairs of all runs and the sums of their counts, part by part.

    A heap holds the last pair of each run's frame in memory. Up to the least of them
    nothing more can come, so that much is taken from all runs and added up; the run whose
    frame is used up reads its next. Memory: one frame per run.
    """
    readers = [_Reader(*run) for run in runs]
    heap = [(int(r.pairs[-1]), i) for i, r in enumerate(readers) if len(r.pairs)]
    heapq.heapify(heap)
    while heap:
        last = heap[0][0]
        parts = [r.until(last) for r in readers if len(r.pairs) and r.pairs[0] <= last]
        while heap and heap[0][0] == last:
            i = heapq.heappop(heap)[1]
            if readers[i].next():
                heapq.heappush(heap, (int(readers[i].pairs[-1]), i))
        pairs, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        sums = np.zeros(len(pairs), dtype=_U)
        np.add.at(sums, place, np.concatenate([c for _, c in parts]))
        yield pairs, sums


def _merge(rows: pa.Table) -> pa.Table:
    """One run from all runs of a group."""
    runs = list(zip(rows["pairs"].to_pylist(), rows["counts"].to_pylist()))
    radix, block = rows["radix"][0].as_py(), min(rows["block"].to_pylist())
    parts = list(merged(runs))
    run = _run(radix, block, *(np.concatenate(column) for column in zip(*parts)))
    return pa.Table.from_pylist([run], schema=_RUN_SCHEMA)


def pair_counts(blocks: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One run per radix partition, with the number of documents of each pair.

    A task merges up to about ``fan_in`` runs; rounds of merges follow until one is left.
    """
    runs = blocks.select("block", "pairs", "held").mapInArrow(_spill, _RUN_DDL)
    left = blocks.count()
    while True:
        parts = -(-left // fan_in)
        part = F.pmod(F.xxhash64("block"), F.lit(max(parts, 1))).alias("part")
        runs = stored(runs.groupBy("radix", part).applyInArrow(_merge, _RUN_DDL), "pair-runs")
        if parts <= 1:
            return runs
        left = parts


def best_of(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Marks the pairs whose count is the highest of their first id. Pairs are sorted."""
    if not len(pairs):
        return np.empty(0, dtype=bool)
    first = pairs >> _U(_SECOND_BITS)
    starts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    highest = np.maximum.reduceat(counts, starts)
    return counts == np.repeat(highest, np.diff(np.append(starts, len(pairs))))


_ANSWER_SCHEMA = pa.schema([("block", pa.int64()), ("radix", pa.int32()), ("counts", pa.binary()), ("best", pa.binary())])
_ANSWER_DDL = "block long, radix int, counts binary, best binary"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and marks for the runs of blocks, each behind the merged run of its radix partition."""
    pairs = counts = best = None
    for row in rows_of(batches):
        frames = [np.cumsum(thawed(f, _U)) for f in row["pairs"]]
        own = np.concatenate(frames)
        if row["merged"]:
            pairs, counts = own, np.concatenate([thawed(f, _U) for f in row["counts"]])
            best = best_of(pairs, counts)
            continue
        at = np.searchsorted(pairs, own)
        found = {"block": row["block"], "radix": row["radix"], "counts": frozen(counts[at]), "best": frozen(best[at].view(np.uint8))}
        yield pa.RecordBatch.from_pylist([found], schema=_ANSWER_SCHEMA)


def _answers(blocks: DataFrame, counted: DataFrame, n_blocks: int) -> DataFrame:
    """Per block: the counts and marks of its pairs, by radix partition."""
    salts = 1 + n_blocks // ANSWERED
    runs = blocks.select("block", "pairs", "held").mapInArrow(_spill, _RUN_DDL)
    asked = runs.select(
        "radix", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"), F.lit(False).alias("merged"), "block", "pairs",
        F.expr("cast(array() AS array<binary>)").alias("counts"),
    )
    told = counted.select(
        "radix", F.expr(f"explode(sequence(0L, {salts - 1}L))").alias("salt"), F.lit(True).alias("merged"),
        "block", "pairs", "counts",
    )
    return (
        asked.unionByName(told)
        .repartition("radix", "salt")
        .sortWithinPartitions("radix", "salt", F.desc("merged"))
        .mapInArrow(_answer, _ANSWER_DDL)
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("radix", "counts", "best"))).alias("answers"))
    )


_RESULT = [("doc_id", pa.int64()), *((n, pa.int64()) for n in _DOC_FIELDS), ("n_best", pa.int64()), ("count_sum", pa.int64())]
_RESULT_SCHEMA = pa.schema([*_RESULT, ("groups_sha256", pa.string())])
_RESULT_DDL = ", ".join(f"{n} long" for n, _ in _RESULT) + ", groups_sha256 string"


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a block's documents, from its records and the answers on its pairs."""
    for row in rows_of(batches):
        docs, answers = row["docs"], row["answers"] or []
        n_best = count_sum = np.zeros(len(docs))
        if answers:
            counts = np.concatenate([thawed(a["counts"], _U) for a in answers]).astype(np.int64)
            best = np.concatenate([thawed(a["best"], np.uint8) for a in answers])
            records, times = thawed(row["records"], np.uint32), thawed(row["times"], np.uint32).astype(np.int64)
            at = np.append(0, np.cumsum([d["distinct"] for d in docs]))
            sums = [np.append(0, np.cumsum(times * values[records])) for values in (best, counts)]
            n_best, count_sum = (s[at[1:]] - s[at[:-1]] for s in sums)
        columns = [pa.array([d["doc_id"] for d in docs], pa.int64())]
        columns += [pa.array([d[n] for d in docs], pa.int64()) for n in _DOC_FIELDS]
        columns += [pa.array(np.asarray(v).astype(np.int64)) for v in (n_best, count_sum)]
        columns.append(pa.array([d["groups_sha256"] for d in docs], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, schema=_RESULT_SCHEMA)


def read_file(path: str) -> bytes:
    """A vocabulary file, read on the driver; tasks get its bytes, a few megabytes at most."""
    with open(path, "rb") as file:
        return file.read()


def alignment_blocks(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Blocks of aligned documents, bucketed by block."""
    cut = _cut(read_file(byte_bpe), read_file(piece_bpe))
    return bucketed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _BLOCK_DDL), "block")


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side A is a byte-level BPE of a space and the text, side B a SentencePiece BPE of the
    text. Texts that are null or empty, or whose tokens on a side do not spell a space and
    the text (as text with U+2581 does), have no tokens: zeros and an empty digest.
    ``count_sum`` adds up, over a document's links, the number of documents that hold the
    link's pair of ids; ``n_best`` counts the links whose pair has the highest number of
    all pairs with its A id. Rows that repeat are documents of their own; rows without a
    doc_id too. Other columns are not looked at. An empty table gives no rows.
    """
    session_of(docs)
    blocks = alignment_blocks(docs, byte_bpe, piece_bpe)
    counted = pair_counts(blocks, fan_in)
    answers = _answers(blocks, counted, blocks.count())
    return blocks.join(answers, "block", "left").select("block", "docs", "records", "times", "answers").mapInArrow(
        _contributions, _RESULT_DDL
    )


def id_pairs(counted: DataFrame) -> DataFrame:
    """The pairs of ids that documents link: a, b, n_docs, best. From ``pair_counts``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            pairs = np.concatenate([np.cumsum(thawed(f, _U)) for f in row["pairs"]])
            counts = np.concatenate([thawed(f, _U) for f in row["counts"]])
            a, b = pairs >> _U(_SECOND_BITS), pairs & _U((1 << _SECOND_BITS) - 1)
            columns = [pa.array(x.astype(np.int64)) for x in (a, b, counts)] + [pa.array(best_of(pairs, counts))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n_docs", "best"])

    return counted.mapInArrow(rows, "a long, b long, n_docs long, best boolean")
