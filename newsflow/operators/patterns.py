"""Whitelists of any length: rows whose text holds any line of a pattern table.

Most lines of a domain list are plain: letters and dots, where a dot stands for any
character. Their longest part without dots is looked for by Aho-Corasick automata; a line
whose part is found is then tried as a whole. The lines are dealt into shards by the first
characters of that part, and a text goes only to the shards of the character runs that it
has, so neither the lines nor the texts ever meet as a whole. The few lines that are real
patterns are tried in the JVM.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# First characters of a line's part that name its shard; shorter parts go to a shard of their
# own, which all texts visit.
RUN = 3
LINES_PER_SHARD = 2000
TEXTS_PER_SALT = 500_000
_SHORT = -1
# Java's dot matches all but these.
_DOT = "[^\n\r\u0085\u2028\u2029]"


class Automaton:
    """An Aho-Corasick automaton as arrays: a transition table over the characters in use.

    States are numbered breadth first, so a state's fallback is always filled in before it.
    """

    def __init__(self, words: list[str]) -> None:
        self.words = sorted(set(words))
        codes = [np.array([ord(c) for c in w], dtype=np.int64) for w in self.words]
        self.alphabet = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *codes]))
        width = len(self.alphabet) + 1  # the last column is for all other characters
        at = np.zeros(len(self.words), dtype=np.int64)
        tables = [np.zeros((1, width), dtype=np.int64)]
        fallbacks, ends = [np.zeros(1, dtype=np.int64)], {}
        first, size = 0, 1  # the states of the level before
        for depth in range(max(map(len, codes), default=0)):
            own = np.array([i for i, c in enumerate(codes) if len(c) > depth])
            column = np.searchsorted(self.alphabet, np.array([codes[i][depth] for i in own]))
            edges, place = np.unique(at[own] * width + column, return_inverse=True)
            parent, column = np.divmod(edges, width)
            states = first + size + np.arange(len(edges))
            whole = np.concatenate(tables)
            # where the parent's fallback goes on the same character, before the new edges exist
            fallback = whole[fallbacks[-1][parent - first], column] if depth else np.zeros(len(edges), dtype=np.int64)
            tables[-1][parent - first, column] = states
            tables.append(np.concatenate(tables)[fallback])
            fallbacks.append(fallback)
            at[own] = states[place]
            ends.update((int(at[i]), i) for i in own if len(codes[i]) == depth + 1)
            first, size = first + size, len(edges)
        self.table = np.concatenate(tables)
        self.fallback = np.concatenate(fallbacks)
        self.ends = ends
        self.ending = np.zeros(len(self.table), dtype=bool)
        self.ending[list(ends)] = True
        for state in range(1, len(self.table)):
            self.ending[state] |= self.ending[self.fallback[state]]

    def found(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        """(text, word) for each word that a text holds, each once, all texts stepping at once."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        column = np.searchsorted(self.alphabet, codes)
        known = np.append(self.alphabet, -1)[column] == codes
        column = np.where(known, column, len(self.alphabet))
        state = np.zeros(len(texts), dtype=np.int64)
        seen: set[tuple[int, int]] = set()
        for step in range(int(lengths.max(initial=0))):
            live = order[: np.searchsorted(-lengths[order], -step)]  # texts longer than that
            state[live] = self.table[state[live], column[starts[live] + step]]
            for text in live[self.ending[state[live]]].tolist():
                node = int(state[text])
                while node:
                    if node in self.ends:
                        seen.add((text, self.ends[node]))
                    node = int(self.fallback[node])
        yield from seen


def _plain_parts(escape: bool) -> tuple[Column, Column]:
    """Whether a line is plain, and its longest part without dots."""
    if escape:
        return F.lit(True), F.col("line")
    parts = F.filter(F.split("line", r"\."), lambda p: p != "")
    longest = F.reduce(parts, F.lit(""), lambda best, p: F.when(F.length(p) > F.length(best), p).otherwise(best))
    return ~F.col("line").rlike(r"[\\^$|?*+()\[\]{}]"), longest


def _shard(run: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(shards)).cast("int")


def _held(escape: bool):
    """Texts that hold a line, from rows sorted so that a shard's lines come before its texts."""

    def compiled(line: str) -> re.Pattern:
        return re.compile(re.escape(line) if escape else _DOT.join(map(re.escape, line.split("."))))

    def matched(lines: dict[str, list[str]], automaton: Automaton, texts: list[str], tried: dict) -> list[str]:
        held = set()
        for text, word in automaton.found(texts):
            if text not in held:
                for line in lines[automaton.words[word]]:
                    if line not in tried:
                        tried[line] = compiled(line)
                    if tried[line].search(texts[text]):
                        held.add(text)
                        break
        return [texts[i] for i in held]

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lines, automaton, tried = None, {}, None, {}
        for batch in batches:
            columns = batch.to_pydict()
            keys = list(zip(columns["shard"], columns["salt"]))
            start = 0
            while start < len(keys):
                end = start
                kind = columns["is_text"][start]
                while end < len(keys) and keys[end] == keys[start] and columns["is_text"][end] == kind:
                    end += 1
                if keys[start] != key:
                    key, lines, automaton, tried = keys[start], {}, None, {}
                if not kind:
                    for line, part in zip(columns["value"][start:end], columns["part"][start:end]):
                        lines.setdefault(part, []).append(line)
                    automaton = None
                elif lines:
                    automaton = automaton or Automaton(list(lines))
                    yield pa.RecordBatch.from_pydict({"text": pa.array(matched(lines, automaton, columns["value"][start:end], tried), pa.string())})
                start = end

    return held


def holding_any(
    texts: DataFrame,
    lines: DataFrame,
    text: str = "domain",
    escape: bool = False,
    lines_per_shard: int = LINES_PER_SHARD,
    texts_per_salt: int = TEXTS_PER_SALT,
) -> DataFrame:
    """The distinct texts (as column ``text``) in which any line of ``lines`` (``line``) is found.

    Lines are patterns as for ``rlike``, or plain text with ``escape``; null and empty lines
    are left out. A null text holds nothing. Only the lines that are real patterns are
    gathered in one place, as one pattern.
    """
    chosen = texts.select(F.col(text).alias("value")).where("value IS NOT NULL").distinct()
    plain, part = _plain_parts(escape)
    told = lines.where("line <> ''").select("line").distinct().select("line", plain.alias("plain"), part.alias("part"))
    # lines of dots alone have no part: they are patterns
    simple, rest = told.where("plain AND part <> ''"), told.where("NOT (plain AND part <> '')")
    shards, salts = 1 + simple.count() // lines_per_shard, 1 + chosen.count() // texts_per_salt
    own = F.when(F.length("part") < RUN, F.lit(_SHORT)).otherwise(_shard(F.substring("part", 1, RUN), shards))
    dealt_lines = simple.select(
        own.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.lit(False).alias("is_text"), F.col("line").alias("value"), "part",
    )
    runs = F.when(
        F.length("value") >= RUN,
        F.transform(F.sequence(F.lit(1), F.length("value") - (RUN - 1)), lambda i: _shard(F.substring(F.col("value"), i, F.lit(RUN)), shards)),
    ).otherwise(F.expr("cast(array() AS array<int>)"))
    visited = F.array_distinct(F.concat(runs, F.array(F.lit(_SHORT))))
    dealt_texts = chosen.select(
        F.explode(visited).alias("shard"), F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int").alias("salt"),
        F.lit(True).alias("is_text"), "value", F.lit(None).cast("string").alias("part"),
    )
    by_automaton = (
        dealt_lines.unionByName(dealt_texts)
        .repartition("shard", "salt")
        .sortWithinPartitions("shard", "salt", "is_text")
        .mapInArrow(_held(escape), "text string")
    )
    grouped = F.concat(F.lit("(?:"), F.col("line"), F.lit(")"))
    pattern = rest.agg(F.array_join(F.collect_list(grouped), "|").alias("pattern")).scalar()
    # no lines: a pattern that matches nothing
    pattern = F.coalesce(F.nullif(pattern, F.lit("")), F.lit("(?!)"))
    by_pattern = chosen.where(F.rlike(F.col("value"), pattern)).select(F.col("value").alias("text"))
    return by_automaton.unionByName(by_pattern).distinct().withColumnRenamed("text", text)
