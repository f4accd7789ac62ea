"""Cross-tokenizer alignment against a version that compares all token spans."""

import json
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from brute import SMALL

from newsflow.llm import token_pairs
from newsflow.llm.queries import QUERIES


@pytest.fixture(scope="module")
def sides():
    """Token bytes of a text by each tokenizer, through the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(token_pairs.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=token_pairs.PIECE_BPE)
    # the fixed letters of byte-level vocabularies, from the library's own alphabet
    from tokenizers import pre_tokenizers

    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {}
    for byte in range(256):
        spelled = level.pre_tokenize_str(bytes([byte]).decode("latin-1"))[0][0]
        encoded = bytes([byte]).decode("latin-1").encode()
        for letter, value in zip(spelled, encoded):
            letters[letter] = value
    for code in range(0x80, 0x110000, 61):  # lead and trail bytes of longer sequences
        if not 0xD800 <= code <= 0xDFFF:
            for letter, value in zip(level.pre_tokenize_str(chr(code))[0][0], chr(code).encode()):
                letters[letter] = value
    by_id = {i: t for t, i in json.loads(open(token_pairs.BYTE_BPE).read())["model"]["vocab"].items()}

    def first(text):
        return [(i, bytes(letters[c] for c in by_id[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def second(text):
        found = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            found.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return found

    return first, second


def spans(tokens):
    at, found = 0, []
    for i, data in tokens:
        found.append((i, at, at + len(data)))
        at += len(data)
    return found


def brute(rows, sides):
    docs = []
    for doc, text in rows:
        a, b = (side(text or "") for side in sides)
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(d for _, d in side) != whole for side in (a, b)):
            docs.append((doc, 0, 0, 0, [], ""))
            continue
        a, b = spans(a), spans(b)
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for end in common:
            sides_of = ([str(i) for i, s, e in side if start <= s and e <= end] for side in (a, b))
            groups.append("|".join(",".join(side) for side in sides_of))
            start = end
        docs.append((doc, len(a), len(b), len(groups), links, sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for d in docs for pair in set(d[4]))
    highest = {}
    for (i, _), n in counts.items():
        highest[i] = max(highest.get(i, 0), n)
    return Counter(
        (doc, n_a, n_b, n_groups, len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), digest)
        for doc, n_a, n_b, n_groups, links, digest in docs
    )


def found(frame):
    assert frame.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return Counter(map(tuple, frame.collect()))


def short(spark):
    """Documents of the given table that all pairs of spans can be compared for."""
    return spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 4000")


def test_as_all_spans(spark, sides):
    docs = short(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) > 100
    expected = brute(rows, sides)
    assert found(token_pairs.align(docs)) == expected
    assert found(token_pairs.align(docs.repartition(7), fan_in=2)) == expected


def test_odd_texts(spark, sides, tricky, nothing):
    rows = [(r.doc_id, r.text if r.text is None or len(r.text) < 9000 else r.text[:900]) for r in tricky.collect()]
    rows += [(i, t) for i, t in enumerate(["<|endoftext|> a", "<s> x </s>", "▁", "a▁b", "\t\n \x00 é🎉", " ", "ﬁ ﷺ", "<0x41>", "퟿"], 100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", *(f"'x' AS {n}" for n in "block docs pairs held records times radix counts answers".split())
    )
    assert found(token_pairs.align(frame)) == brute(rows, sides)
    assert token_pairs.align(nothing).count() == 0
    assert token_pairs.align(frame.where("text IS NULL")).first().groups_sha256 == ""


def test_long_text(spark):
    """The long documents of the fixture have a block of their own; the sums add up."""
    rows = QUERIES["op12_cross_tokenizer_alignment"](spark, SMALL).collect()
    assert len(rows) == 200
    for r in rows:
        assert r.n_links == r.n_a + r.n_b - r.n_groups and r.n_best <= r.n_links <= max(r.count_sum, 0)


def test_runs_are_merged_frame_by_frame(monkeypatch):
    monkeypatch.setattr(token_pairs, "FRAME_PAIRS", 3)
    rng = np.random.default_rng(5)
    whole = Counter()
    runs = []
    for _ in range(20):
        pairs = np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64)
        counts = rng.integers(1, 9, len(pairs)).astype(np.uint64)
        whole.update(dict(zip(pairs.tolist(), counts.tolist())))
        run = token_pairs._run(0, 0, pairs, counts)
        runs.append((run["pairs"], run["counts"]))
    parts = list(token_pairs.merged(runs))
    pairs, sums = (np.concatenate(c).tolist() for c in zip(*parts))
    assert pairs == sorted(whole) and dict(zip(pairs, sums)) == whole and len(parts) > 3


def test_id_pairs(spark):
    blocks = token_pairs.alignment_blocks(short(spark).repartition(3))
    rows = token_pairs.id_pairs(token_pairs.pair_counts(blocks)).collect()
    highest = {}
    for r in rows:
        highest[r.a] = max(highest.get(r.a, 0), r.n_docs)
    assert rows and all(r.best == (r.n_docs == highest[r.a]) for r in rows)


def test_words_give_the_ids_of_whole_texts():
    """Kept words are joined to what the libraries give for all texts of the larger table."""
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    texts += ["", " ", "  a", "a  b ", "a \n\n b\n", "it's I'll 'tis ''s", "x\t\ty", "3.14 a1b2", "\r\n", "¿Qué? «a»", "a" * 300]
    files = token_pairs.read_file(token_pairs.BYTE_BPE), token_pairs.read_file(token_pairs.PIECE_BPE)
    for side in (token_pairs.byte_level(files[0]), token_pairs.piece_level(files[1])):
        plain = [t for t in texts if token_pairs._PLAIN.fullmatch(t)]
        assert len(plain) > len(texts) / 2
        for text, ids, found in zip(plain, side.encode(plain), side.tokens(plain)):
            if text:
                assert found.ids.tolist() == ids


def test_new_words_are_checked_at_once(monkeypatch):
    pieces = [b"a", b"b", b"c", b" "]
    wrong = {"ab": "a", "c": "bc", "ba": "ca"}  # the first two spell the same bytes together

    def ids(words):
        return [["abc ".index(letter) for letter in wrong.get(word, word)] for word in words]

    calls = []
    check = token_pairs.Vocabulary._spells
    monkeypatch.setattr(token_pairs.Vocabulary, "_spells", lambda *args: calls.append(1) or check(*args))

    def side():
        return token_pairs.Vocabulary(pieces, lambda texts: ids([" " + t for t in texts]), lambda t: f" {t}".split(" ")[1:], ids)

    right, some = side(), side()
    assert [t.ids.tolist() for t in right.tokens(["aa bb cc acb", "", "bb aa"])] == [[0, 0, 1, 1, 2, 2, 0, 2, 1], [], [1, 1, 0, 0]]
    assert len(calls) == 1 and not right.unspelled
    found = some.tokens(["aa", "aa ab c", "ba bb", "bb cc"])
    assert [None if t is None else t.ids.tolist() for t in found] == [[0, 0], None, None, [1, 1, 2, 2]]
    assert some.unspelled == {"ab", "c", "ba"}


def libraries():
    return token_pairs.byte_level(token_pairs.read_file(token_pairs.BYTE_BPE)), token_pairs.piece_level(token_pairs.read_file(token_pairs.PIECE_BPE))


def test_chunks_give_what_whole_texts_give(monkeypatch):
    monkeypatch.setattr(token_pairs, "KEPT_CHUNKS", 300)
    a, b = libraries()
    aligner, read = token_pairs.Aligner(a, b), []
    monkeypatch.setattr(token_pairs, "_encoded", lambda texts, *_: [read.append(t) or pair(t) for t in texts])
    rng = np.random.default_rng(7)
    parts = [*"aZé日🎉 ▁", *"    \n\t\r\x85\xa0\u3000\x1c\x00\u0301\u200b", *"'(.,;_-<>~!19", "'s", "'ll", "the", "ing", " of", " don't", ");\r\n", "<|endoftext|>", "<s>", "<0x41>"]

    def pair(text):
        sides = [side.whole([text])[0] for side in (a, b)]
        return None if not text or None in sides else sides

    spelled = 0
    for _ in range(60):
        odds = np.array([0.02 if p == "▁" else 1 for p in parts])
        texts = ["".join(rng.choice(parts, rng.integers(0, 40), p=odds / odds.sum())) for _ in range(20)] + ["x" * 200, "", "a "]
        for text, found in zip(texts, aligner.align(texts)):
            sides = pair(text)
            if sides is None:
                assert (found.n_a, found.n_groups, len(found.pairs), found.groups) == (0, 0, 0, "")
                continue
            spelled += 1
            pairs, common = token_pairs.aligned(*sides)
            assert found.pairs.tolist() == pairs.tolist() and (found.n_a, found.n_groups) == (len(sides[0].ids), len(common))
            assert found.groups == aligner.writer.written(*sides, common)[0]
    assert spelled > 1000 and aligner.before is not aligner.kept
    assert {t for t in read if "▁" not in t} == {"x" * 200, ""}


def test_frequent_words_are_encoded_once(monkeypatch):
    import pyarrow as pa

    seen, sides = [], libraries()
    for side in sides:
        monkeypatch.setattr(side, "encode", lambda texts, encode=side.encode: seen.extend(texts) or encode(texts))
    monkeypatch.setattr(token_pairs, "byte_level", lambda _: sides[0])
    monkeypatch.setattr(token_pairs, "piece_level", lambda _: sides[1])
    monkeypatch.setattr(token_pairs, "TaskContext", type("Task", (), {"get": classmethod(lambda c: c), "partitionId": lambda: 0}))
    text = "These words, and these; come in (every) text. "
    rows = pa.RecordBatch.from_pydict({"doc_id": [*range(2500)], "text": [text * 3] * 2500})
    blocks = [row for batch in token_pairs._cut(b"", b"")(iter([rows])) for row in batch.to_pylist()]
    assert sum(len(row["docs"]) for row in blocks) == 2500 and len({d["groups_sha256"] for row in blocks for d in row["docs"]}) == 1
    assert sum(map(len, seen)) < 1000


def test_vocabularies_with_entries_across_chunks_are_not_cut():
    def side(pieces, **controls):
        return token_pairs.Vocabulary(pieces, lambda texts: [[] for _ in texts], **controls)

    assert side([b" a", b"ing", b"\xc3(", b"1.", b" (a"]).chunked
    assert not side([b"a b"]).chunked and not side([b". "]).chunked and not side([b"a("]).chunked
    assert side([b"<s>"], controls=frozenset([0])).chunked
