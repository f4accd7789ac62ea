"""License scans by patience alignment of texts with license templates.

A template and a stretch of text are aligned on the words that occur exactly once in both:
of these the longest run in the same order (a longest increasing subsequence) is kept, and
the gaps between the kept words are aligned the same way. The share of the template's
words that find a partner is its coverage. Stretches are taken around each occurrence of
the template's rarest words in the text: of so many that a copy which lacks them all would
not reach the coverage. So each copy of a repeated license has its own stretches.

Coverage alone does not tell a license from its siblings, which differ in a word or two. The
words that name a license (its version, its conditions) are its keys: they have to be aligned
one by one, with nothing put between them.
"""

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import each, session_of, whole_text

COVERAGE = 0.8
_WORD = re.compile(r"[^\W_]+")

# Wording of licenses and license notices, by SPDX name.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT "
        'HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        'notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]

# The words that tell a license from its siblings. Those that a template of the
# license has must be found whole.
KEYS: dict[str, list[str]] = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0"],
    "GPL-2.0": ["GNU General Public License", "version 2"],
    "GPL-3.0": ["GNU General Public License", "version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License", "version 2.1"],
    "AGPL-3.0": ["GNU Affero General Public License", "version 3"],
    "BSD-3-Clause": ["nor the names of its contributors may be used to endorse"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
        back[i] = piles[pile - 1] if pile else -1
    found = []
    at = piles[-1] if piles else -1
    while at >= 0:
        found.append(at)
        at = back[at]
    return found[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matching places (in the text, in the template) of a patience alignment."""
    found: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, a_end, b, b_end = work.pop()
        while a < a_end and b < b_end and text[a] == template[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            found.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        once = _unique(text, a, a_end)
        pairs = sorted(
            (once[word], place) for word, place in _unique(template, b, b_end).items() if word in once
        )
        kept = [pairs[i] for i in increasing([place for _, place in pairs])]
        if not kept:
            continue
        found += kept
        starts = [(a, b), *((i + 1, j + 1) for i, j in kept)]
        ends = [*kept, (a_end, b_end)]
        work += [(s, e, t, f) for (s, t), (e, f) in zip(starts, ends)]
    return sorted(found)


def _unique(words: list[str], start: int, end: int) -> dict[str, int]:
    places: dict[str, int] = {}
    for i in range(start, end):
        places[words[i]] = -1 if words[i] in places else i
    return {word: place for word, place in places.items() if place >= 0}


def key_places(template: list[str], keys: list[str]) -> list[range]:
    """Where the keys stand in a template; keys that it does not have are left out."""
    found = []
    for key in map(words_of, keys):
        starts = [i for i in range(len(template) - len(key) + 1) if template[i : i + len(key)] == key]
        found += [range(i, i + len(key)) for i in starts]
    return found


def keys_hold(pairs: list[tuple[int, int]], keys: list[range]) -> bool:
    """Whether all words of all keys are aligned, those of a key with adjacent words."""
    at = {place: i for i, place in pairs}
    return all(
        key[0] in at and all(at.get(place) == at[key[0]] + place - key[0] for place in key) for key in keys
    )


class Scanner:
    """Finds licenses in one text after the other."""

    def __init__(
        self, templates: list[tuple[str, str]], coverage: float, keys: dict[str, list[str]] = KEYS
    ) -> None:
        self.coverage = coverage
        self.templates = [(name, words) for name, text in templates if (words := words_of(text))]
        self.sets = [frozenset(words) for _, words in self.templates]
        self.places = [_places(words) for _, words in self.templates]
        self.keys = [key_places(words, keys.get(name, [])) for name, words in self.templates]
        self.key_words = [
            frozenset(words[i] for key in found for i in key)
            for (_, words), found in zip(self.templates, self.keys)
        ]
        self.vocabulary = frozenset().union(*self.sets)

    def scan(self, text: str) -> list[dict]:
        """Licenses in page order; of those that overlap the one with most words found."""
        words = words_of(text)
        present = self.vocabulary.intersection(words)
        spans = []
        places: dict[str, list[int]] | None = None
        parts = zip(self.templates, self.sets, self.places, self.keys, self.key_words)
        for (name, template), distinct, own, keys, key_words in parts:
            if not key_words <= present:
                continue
            here = present & distinct
            if len(here) < len(distinct) and sum(w in here for w in template) < self.coverage * len(template):
                continue
            if places is None:
                places = _places(words, present)
            spans += self._found(name, template, own, keys, words, places)
        return sorted(_apart(spans), key=lambda s: s["first"])

    def _found(
        self, name: str, template: list[str], own: dict, keys: list[range], words: list[str], places: dict
    ) -> list[dict]:
        size = len(template)
        slack, wide = 5 + size // 4, 5 + size
        hits = sorted(i for word in own for i in places.get(word, ()))
        counts = Counter(template)
        found, wider, done = {}, {}, -1
        for at in sorted(self._starts(size, own, places)):
            if at <= done:
                continue  # the same stretch, within the slack
            done = at + slack // 2
            near = None
            for left, right in ((slack, slack), (slack, wide), (wide, slack), (wide, wide)):
                start, end = max(0, at - left), max(0, at + size + right + slack // 2)
                first, last = bisect_left(hits, start), bisect_left(hits, end)
                if last - first < self.coverage * size:
                    continue
                here = Counter(words[i] for i in hits[first:last])
                if (here & counts).total() < self.coverage * size:
                    continue
                pairs = align(words[start:end], template)
                if len(pairs) < self.coverage * size or not keys_hold(pairs, keys):
                    continue
                ends = start + pairs[0][0], start + pairs[-1][0]
                span = {
                    "license": name,
                    "first": ends[0],
                    "last": ends[1],
                    "matched": len(pairs),
                    "coverage": round(len(pairs) / size, 6),
                }
                if (left, right) == (slack, slack):
                    found[ends] = near = span
                elif near is None or len(pairs) > near["matched"]:
                    wider[ends] = near, span
                if len(pairs) == size:
                    break
        # Wider stretches are for copies with long insertions; none may reach into another copy.
        spans, kept = list(found.values()), _apart(list(found.values()))
        for near, span in sorted(wider.values(), key=lambda pair: _best_first(pair[1])):
            rest = [k for k in kept if k is not near]
            if all(_disjoint(span, k) for k in rest):
                kept = [*rest, span]
                spans.append(span)
        return spans

    def _starts(self, size: int, own: dict, places: dict) -> set[int]:
        """Where the text would have the template's first word if nothing were changed before
        a seed. A copy may lack ``spare`` of the template's words, so one more are seeds."""
        spare = size - self.coverage * size - sum(len(own[word]) for word in own if word not in places)
        starts: set[int] = set()
        for word in sorted((w for w in own if w in places), key=lambda w: (len(places[w]), own[w][0])):
            starts.update(at - place for at in places[word] for place in own[word])
            spare -= len(own[word])
            if spare < 0:
                break
        return starts


def _best_first(span: dict) -> tuple:
    return -span["matched"], -span["coverage"], span["first"], span["last"], span["license"]


def _disjoint(one: dict, other: dict) -> bool:
    return one["last"] < other["first"] or one["first"] > other["last"]


def _apart(spans: list[dict]) -> list[dict]:
    """Of spans that overlap, the best."""
    kept: list[dict] = []
    for span in sorted(spans, key=_best_first):
        if all(_disjoint(span, k) for k in kept):
            kept.append(span)
    return kept


def _places(words: list[str], wanted: frozenset[str] | None = None) -> dict[str, list[int]]:
    places: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        if wanted is None or word in wanted:
            places.setdefault(word, []).append(i)
    return places


_SPAN = pa.struct(
    [
        ("license", pa.string()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("matched", pa.int64()),
        ("coverage", pa.float64()),
    ]
)


def _scan(templates: list[tuple[str, str]], coverage: float, keys: dict[str, list[str]]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage, keys)
        for batch in batches:
            found = [scanner.scan(text) for (text,) in each(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.list_(_SPAN))], names=["doc_id", "licenses"]
            )

    return scan


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    coverage: float = COVERAGE,
    keys: dict[str, list[str]] = KEYS,
) -> DataFrame:
    """One row per document: doc_id, license, coverage, licenses.

    ``licenses`` lists each license found with its first and last word (from 0) and its
    coverage; ``license`` and ``coverage`` are those of the best covered one (the first
    of equals), null without any. A copy is found if the words put between those of the
    template are no more than about a quarter of it, or about all of it on either side of
    words that it keeps, and none are put into its ``keys``. Words are runs of letters and digits, in lower case. A null text
    is empty. Repeated rows are scanned each. Other columns are not looked at. An empty table gives no rows.
    """
    session_of(docs)
    rows = docs.select("doc_id", whole_text().alias("text"))
    found = rows.mapInArrow(
        _scan(templates, coverage, keys),
        "doc_id long, licenses array<struct<license: string, first: bigint, last: bigint, "
        "matched: bigint, coverage: double>>",
    )
    best = F.array_max("licenses.coverage")
    chosen = F.get(F.filter("licenses", lambda s: s["coverage"] == best), F.lit(0))
    return found.select(
        "doc_id", chosen["license"].alias("license"), chosen["coverage"].alias("coverage"), "licenses"
    )
