"""Exact dedup, mixing and chat formatting."""

import hashlib
from collections import Counter
from fractions import Fraction

import pytest
from compare import connect, differences
from brute import SMALL
from pyspark.sql import functions as F

from newsflow.llm import chat, exact_dedup, mixing
from newsflow.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


def brute_exact(rows, keep):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    pick = {"largest": max, "smallest": min}[keep]
    found = []
    for doc, text in rows:
        ids = [d for d in groups[text or ""] if d is not None]
        best = pick(ids) if ids else None
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        found.append((doc, best, len(groups[text or ""]), doc == best, digest))
    return Counter(found)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("hashed", [exact_dedup.content_hash, lambda text: F.unhex(F.lit("00"))])
def test_exact_dedup_compares_bytes(tricky, keep, hashed):
    """The second hash puts all texts under one key: only the bytes tell them apart."""
    rows = [(r.doc_id, r.text) for r in tricky.collect()]
    found = exact_dedup.exact_dedup(tricky, keep, hashed)
    assert Counter(map(tuple, found.collect())) == brute_exact(rows, keep)


def test_without_copies(tricky, nothing):
    kept = exact_dedup.without_copies(tricky)
    assert kept.columns == tricky.columns
    rows = kept.collect()
    assert len({r.text or "" for r in rows}) == len(rows)
    assert exact_dedup.without_copies(nothing).count() == 0
    assert exact_dedup.exact_dedup(nothing).count() == 0


@pytest.mark.parametrize("parts", [{"a": 1}, {"a": 3, "b": 1}, {"a": 7, "b": 5, "c": 11, "d": 1, "e": 1}])
def test_frame_stays_within_one_block(spark, parts):
    rows = mixing.frame_plan(spark.createDataFrame(list(parts.items()), "source string, parts int")).collect()
    whole = sum(parts.values())
    assert sorted(r.slot for r in rows) == list(range(whole))
    for name, p in parts.items():
        slots = sorted(r.slot for r in rows if r.source == name)
        assert len(slots) == p
        for t in range(whole + 1):
            assert abs(sum(s < t for s in slots) - Fraction(p * t, whole)) < 1


def test_mix(tricky, nothing, spark):
    parts = spark.createDataFrame([("a", 2), ("b", 1), ("z", 4)], "source string, parts int")
    rows = mixing.mix(tricky, parts, block_rows=2, rows_per_bucket=2).collect()
    assert sorted(r.position for r in rows) == list(range(tricky.count()))
    unplanned = [r for r in rows if r.slot is None]
    assert {r.source for r in unplanned} == {"", "c"}
    assert min(r.position for r in unplanned) > max(r.position for r in rows if r.slot is not None)
    by_slot = sorted((r for r in rows if r.slot is not None), key=lambda r: r.position)
    assert [r.slot for r in by_slot] == sorted(r.slot for r in by_slot)
    assert mixing.mix(nothing, parts).count() == 0 and mixing.mix(nothing).count() == 0
    ordered = mixing.in_mixed_order(tricky, parts, block_rows=2)
    assert ordered.columns == tricky.columns and ordered.count() == tricky.count()


def test_mixed_order_gives_each_row_its_position(tricky, spark):
    parts = spark.createDataFrame([("a", 2), ("b", 1), ("z", 4)], "source string, parts int")
    want = Counter((r.doc_id, r.source, r.position) for r in mixing.mix(tricky, parts, block_rows=2).collect())
    rows = mixing.in_mixed_order(tricky, parts, block_rows=2, position="position").collect()
    assert Counter((r.doc_id, r.source or "", r.position) for r in rows) == want
    assert [r.position for r in rows] == list(range(tricky.count()))


def test_mix_refuses_too_many_parts(spark):
    parts = spark.createDataFrame([("a", mixing.MOST_PARTS), ("b", 1)], "source string, parts int")
    with pytest.raises(Exception, match="parts add up"):
        mixing.frame_plan(parts).collect()


def fold(events):
    """Plain fold of one conversation's events."""
    texts, roles = {}, {}
    for seq, message, role, kind, text in sorted(set(events), key=lambda e: (e[0], e[3], e[4] or "")):
        if message is None or kind not in ("delta", "edit", "regenerate"):
            continue
        if kind == "regenerate":
            for later in [m for m in texts if m > message]:
                del texts[later], roles[later]
            texts[message] = ""
        elif kind == "edit":
            texts[message] = text or ""
        else:
            texts[message] = texts.get(message, "") + (text or "")
        roles[message] = role if role is not None else roles.get(message, "")
    return [(m, roles[m], texts[m]) for m in sorted(texts)]


def test_event_log(spark):
    events = [
        (1, 1, 1, "user", "delta", "Hel"),
        (1, 2, 1, None, "delta", "lo"),
        (1, 2, 1, None, "delta", "lo"),
        (1, 3, 2, "assistant", "delta", "dra"),
        (1, 4, 2, "assistant", "delta", "ft"),
        (1, 5, 3, "user", "delta", "gone"),
        (1, 6, 2, "assistant", "regenerate", None),
        (1, 7, 2, "assistant", "delta", "final"),
        (1, 8, 1, "user", "edit", "Hi"),
        (1, 9, 1, "user", "delta", "!"),
        (1, 10, 3, "user", "delta", "again"),
        (1, 11, None, "user", "delta", "lost"),
        (1, 12, 3, "user", "shout", "lost"),
        (2, 1, 5, None, "edit", None),
        (None, 1, 1, "user", "delta", "x"),
    ]
    log = spark.createDataFrame(
        events, "conv_id long, seq long, message long, role string, kind string, text string"
    ).withColumn("void_to", F.lit("clash"))
    found = {}
    for r in chat.reconstruct(log).collect():
        found.setdefault(r.conv_id, []).append((r.message, r.role, r.text))
    for conv in (1, 2, None):
        want = fold([e[1:] for e in events if e[0] == conv])
        assert sorted(found[conv]) == want
    assert chat.reconstruct(log.limit(0)).count() == 0


def test_template_is_reversible(spark):
    odd = ["", "<", "<|", "<||im_end|>", "<|im_end|>\n<|im_start|>assistant\n", "|im_end|>", "a\n\n", "<<||>|", "\\n", "🎉" * 300]
    rows = [(i, j, role, text) for i, role in enumerate(odd) for j, text in enumerate(odd)]
    rows += [(100, 0, "assistant", t) for t in odd] + [(101, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in found[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert found[conv].loss == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert chat.format_conversations(turns.limit(0)).count() == 0
