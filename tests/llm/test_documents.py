"""Operators on documents against brute-force versions."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
import sentencepiece
from brute import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from newsflow.llm import blocks, kneser_ney, licenses, line_dedup, near_dedup, pieces, quality, toxicity
from newsflow.llm.queries import QUERIES


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# --- line dedup ------------------------------------------------------------------------


def test_minimal_perfect_hash():
    random_ = np.random.default_rng(1)
    low, high = random_.integers(-(2**63), 2**63, (2, 5000), dtype=np.int64)
    low[:50] = 7  # equal first halves
    arrays = line_dedup.HashArrays.build(low, high, last=np.arange(5000))
    arrays = line_dedup.HashArrays.from_bytes(arrays.to_bytes())
    index = arrays.find(low, high)
    assert sorted(index) == list(range(5000))
    assert (arrays.arrays["last"][index] == np.arange(5000)).all()
    assert (arrays.find(low, high + 1) == -1).all()
    empty = line_dedup.HashArrays.build(low[:0], high[:0])
    assert (empty.find(low, high) == -1).all()


def test_line_dedup_on_odd_rows(tricky, nothing):
    found = {r.doc_id: r for r in line_dedup.dedup_lines(tricky).collect() if r.doc_id is not None}
    assert (found[1].text, found[1].n_lines, found[1].n_dropped) == ("", 1, 0)
    for i in range(5):
        assert (found[10 + i].text, found[10 + i].n_lines, found[10 + i].n_dropped) == (str(i), 3, 2)
    assert found[15].n_dropped == 0 and found[15].text.count("\n") == 2
    assert line_dedup.dedup_lines(tricky).count() == tricky.count()
    assert line_dedup.dedup_lines(nothing).count() == 0


# --- near-dedup ------------------------------------------------------------------------


@pytest.mark.parametrize("block", [near_dedup.BLOCK_SHINGLES, 1500])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)
    docs = documents(spark)
    random_ = random.Random(5)
    base = [f"t{i}" for i in range(120)]
    family = []
    for i in range(60):
        words = list(base)
        for _ in range(random_.randrange(8)):
            words[random_.randrange(120)] = f"x{random_.random()}"
        family.append((10_000 + i, " ".join(words)))
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(family, "doc_id long, text string"))
    want = brute.near_components({r.doc_id: r.text for r in docs.collect()}, 4, 80)
    found = near_dedup.near_duplicates(docs, words=4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want


def test_near_duplicates_on_odd_rows(tricky, nothing):
    found = {}
    rows = near_dedup.near_duplicates(tricky).collect()
    assert len(rows) == tricky.count()
    for r in rows:
        found[r.doc_id] = (r.n_shingles, r.component_id, r.kept)
    assert found[1] == (0, 1, True) and found[2] == (0, 2, True) and found[3] == (0, 3, True)
    assert found[4] == (2996, 4, True) and found[5][1] == 4 and found[6][1:] == (4, False)
    assert found[7] == (1, 7, True) and found[8] == (1, 7, False)
    assert found[None][1:] == (None, True)
    assert near_dedup.near_duplicates(nothing).count() == 0
    assert near_dedup.without_near_copies(tricky).columns == tricky.columns


# --- quality and toxicity --------------------------------------------------------------


def test_kneser_ney(spark):
    text = "the theory of the other thing that they think of"
    counts = Counter(text[i : i + 3] for i in range(len(text) - 2))
    frame = spark.createDataFrame([("g", k, v) for k, v in counts.items()], "group string, gram string, c long")
    found = {r.gram: r.p for r in kneser_ney.probabilities(frame, 3).collect()}
    assert found == pytest.approx(brute.kneser_ney(counts, 3))


def test_quality(spark, tricky, nothing):
    rows = [(r.doc_id, r.lang, r.text) for r in documents(spark).collect()]
    want = brute.quality(rows, quality.ORDER, quality.BELOW, quality.ABOVE, quality.LEAST_SPREAD)
    found = quality.quality(documents(spark)).collect()
    assert len(found) == len(rows)
    for r in found:
        base, failed, value, kept = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == failed and r.log_perplexity == pytest.approx(value, abs=1e-3)
        assert r.kept == kept
    odd = quality.quality(tricky).collect()
    assert len(odd) == tricky.count()
    for r in odd:
        if r.doc_id is not None:
            text = next(t.text for t in tricky.collect() if t.doc_id == r.doc_id) or ""
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(text)
    assert quality.quality(nothing).count() == 0


def test_bands_reach_documents_without_a_shuffle_by_language(spark, monkeypatch):
    docs = documents(spark)
    frame = quality.quality(docs)
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    want = {r.doc_id: r.kept for r in frame.collect()}
    monkeypatch.setattr(quality, "SMALL_TABLE_BYTES", -1)
    assert {r.doc_id: r.kept for r in quality.quality(docs).collect()} == want


def test_questions_to_one_shard_are_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(blocks, "QUESTIONS_PER_TASK", 100)
    rows = [(b, "g", [f"k{(b * 7 + i) % 60:02d}" for i in range(50)], [1] * 50) for b in range(40)]
    asked = spark.createDataFrame(rows, "block long, group string, grams array<string>, counts array<long>")
    model = spark.createDataFrame([("g", f"k{i:02d}", float(i)) for i in range(60)], "group string, gram string, value double")
    answers, shards = blocks.answers(asked, model)
    assert shards == 1
    found = {r.block: r.answers for r in answers.collect()}
    assert len(found) == 40
    for block, group, grams, _ in rows:
        values = np.frombuffer(found[block][0]["values"], dtype=np.float32)
        assert values.tolist() == [float(g[1:]) for g in grams]
    text = answers._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shard" in text and re.search(r"hashpartitioning\(shard#\d+, salt#\d+", text)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op3_toxicity"](spark, folder).join(labels, "doc_id", "left").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    assert right > sum(r.toxic == 0 for r in held) / len(held)
    pairs = [(a.score, b.score) for a in held if a.toxic for b in held if not b.toxic]
    assert sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs) > 0.75


def test_toxicity_on_odd_rows(spark, tricky, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(tricky, labels).collect()
    assert len(rows) == tricky.count()
    assert all(r.score is not None and r.held_out is not None for r in rows)
    none = toxicity.toxicity(tricky, labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1
    assert toxicity.toxicity(nothing, labels).count() == 0


# --- licenses --------------------------------------------------------------------------


def longest(values):
    best = [0] * len(values)
    for i, v in enumerate(values):
        best[i] = 1 + max((best[j] for j in range(i) if values[j] < v), default=0)
    return max(best, default=0)


def test_increasing():
    random_ = random.Random(3)
    for _ in range(200):
        values = random_.sample(range(30), random_.randrange(12))
        found = [values[i] for i in licenses.increasing(values)]
        assert found == sorted(found) and len(found) == longest(values)


def test_license_scan(spark, tricky, nothing):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    changed = mit.replace("Software", "Work", 3).replace("free of charge", "without charge")
    rows = [
        (1, "Some words. " + mit),
        (2, f"{changed}\nmiddle words here\n{changed}"),
        (3, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
        (4, "the license of the public under a version"),
        (5, None),
        (6, "word " * 5000 + "This work is licensed under the GNU General Public License, version 3."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit("clash"))
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    names = {doc: [s.license for s in r.licenses] for doc, r in found.items()}
    assert names == {1: ["MIT"], 2: ["MIT", "MIT"], 3: ["Apache-2.0", "MIT"], 4: [], 5: [], 6: ["GPL-3.0"]}
    assert found[1].coverage == 1 and 0.8 <= found[2].coverage < 1 and found[4].license is None
    assert found[6].licenses[0].first == 5000
    assert licenses.scan_licenses(tricky).count() == tricky.count()
    assert licenses.scan_licenses(nothing).count() == 0


def test_license_siblings_are_told_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)

    def names(text):
        return [s["license"] for s in scanner.scan(f"some words before. {text} and some words after")]

    for text in (
        "Licensed under the BSD License.",
        "Licensed under CC BY-XX 4.0.",
        "Licensed under CC BY 3.0.",
        "This work is licensed under the GNU General Public License, version 1.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under the Apache License, Version 1.1.",
    ):
        assert names(text) == [], text
    for name, text in licenses.TEMPLATES:
        assert names(text) == [name], text
        assert names(text.replace("Licensed", "Released").replace("work", "text"))[:1] == [name], text
    gpl = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and len(t) > 100)
    assert names(gpl.replace("version 3", "version 4")) == []
    assert names("Licensed under CC BY-NC-ND 4.0. Licensed under CC BY 4.0.") == ["CC-BY-NC-ND-4.0", "CC-BY-4.0"]


def test_license_keys_are_adjacent():
    template = licenses.words_of("under the MIT License here")
    keys = licenses.key_places(template, ["MIT License", "absent words"])
    assert keys == [range(2, 4)]
    assert licenses.keys_hold(licenses.align(template, template), keys)
    for text in ("under the MIT zero License here", "under the License here"):
        assert not licenses.keys_hold(licenses.align(licenses.words_of(text), template), keys)


def test_license_scan_finds_edited_copies():
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    words = licenses.words_of(mit)
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    once = [w for w in words if words.count(w) == 1]
    random_ = random.Random(4)
    for lost in (once[:3], once[3:6], once[-3:], random_.sample(once, 12)):
        edited = " ".join("other" if w in lost else w for w in words)
        found = scanner.scan(f"{mit} some words between the two {edited}")
        assert [(s["license"], s["matched"]) for s in found] == [("MIT", len(words)), ("MIT", len(words) - len(lost))]
        away = " ".join("x" if i % 500 else random_.choice(lost) for i in range(6000))
        found = scanner.scan(f"{' '.join(lost)} {away} {edited}")
        assert [(s["license"], s["matched"]) for s in found] == [("MIT", len(words) - len(lost))]
    for at in (10, len(words) // 2, len(words) - 10):
        inserted = " ".join(words[:at] + ["put"] * 70 + words[at:])
        (found,) = scanner.scan("x " * 300 + inserted + " x" * 300)
        assert (found["first"], found["last"], found["coverage"]) == (300, 300 + len(words) + 69, 1)


# --- SentencePiece ---------------------------------------------------------------------


def test_encoding_equals_the_library(spark, tricky, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    more = ["a  b", " ", "x" * 700, "日本語" * 200, "a\n\n b \t", "".join(map(chr, range(1, 300)))]
    extra = spark.createDataFrame(list(enumerate(more, 900)), "doc_id long, text string")
    docs = tricky.select("doc_id", "text").unionByName(extra).unionByName(documents(spark).select("doc_id", "text"))
    want = Counter((r.doc_id, tuple(library.encode(r.text or "")), r.text or "") for r in docs.collect())
    found = pieces.encode(docs.withColumn("ids", F.lit("clash"))).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in found) == want
    assert pieces.encode(nothing).count() == 0
    small = spark.createDataFrame(
        [(r.doc_id, list(r.ids)) for r in found[:30]], "doc_id long, ids array<int>"
    )
    decoded = Counter((r.doc_id, r.text) for r in pieces.decode(small, pieces.piece_table(spark)).collect())
    assert decoded == Counter((r.doc_id, r.text) for r in found[:30])


def test_viterbi(spark):
    scores = {"a": -1.0, "b": -1.5, "ab": -1.2, "ba": -2.0, "aba": -1.9, "bb": -4.0}
    rows = [(i, p, s, "normal") for i, (p, s) in enumerate(scores.items())]
    table = spark.createDataFrame(rows, "id int, piece string, score double, kind string")
    words = ["a", "ab", "abab", "aabbab", "bbaba", "axb"]
    units = spark.createDataFrame([(w,) for w in words], "unit string")
    by_id = F.map_from_arrays(
        F.array(*(F.lit(i) for i, *_ in rows)), F.array(*(F.lit(s) for *_, s, _ in rows))
    )
    edges = pieces.lattice(units, table, 3)
    found = edges.select("unit", pieces.viterbi(F.col("edges"), by_id, F.length("unit")).alias("ids")).collect()

    def best(word):
        if not word:
            return 0.0
        options = [scores[word[:n]] + best(word[n:]) for n in (1, 2, 3) if word[:n] in scores and len(word) >= n]
        return max(options, default=-20.0 + best(word[1:]))

    names = list(scores)
    assert len(found) == len(words)
    for r in found:
        total = sum(-20.0 if i < 0 else scores[names[i]] for i in r.ids)
        assert total == pytest.approx(best(r.unit))


# --- pipeline --------------------------------------------------------------------------


def test_pipeline(spark):
    """Each stage does on all that its predecessor kept what its brute-force version does."""
    rows = {r.doc_id: r for r in documents(spark).collect()}
    verdict = brute.quality([(r.doc_id, r.lang, r.text) for r in rows.values()], quality.ORDER, quality.BELOW, quality.ABOVE, quality.LEAST_SPREAD)
    kept = [d for d in rows if verdict[d][3]]
    largest = {rows[d].text: max(e for e in kept if rows[e].text == rows[d].text) for d in kept}
    kept = sorted(set(largest.values()))
    near = brute.near_components({d: rows[d].text for d in kept}, 5, 80)
    kept = [d for d in kept if near[d][1] == d]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = {d: library.encode(rows[d].text) for d in kept}
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: list(r.ids) for r in found} == want and len(found) == len(want)


def test_pipeline_gives_the_position_in_the_mix(spark):
    source = {r.doc_id: r.source or "" for r in documents(spark).collect()}
    found = {r.doc_id: r.position for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert found == brute.mix({d: source[d] for d in found}, 0.7, 1000, 64)


def test_toxicity_follows_from_the_text_alone(spark):
    """Copies of documents, held out or not, labelled or not, have one score."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    copies = docs.unionByName(docs.selectExpr("doc_id + 1000003 AS doc_id", "text"))
    scores = {}
    for r in toxicity.toxicity(copies, labels).join(copies, "doc_id").collect():
        scores.setdefault(r.text, set()).add(r.score)
    assert len(scores) > 100 and all(len(s) == 1 for s in scores.values())
