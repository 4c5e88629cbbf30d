"""License scans by patience alignment of texts with license templates.

Texts and templates are compared as words. A template's places in a text are windows of the template's length where many of its words
occur; in each, words that are unique in window and template are anchors, the longest increasing run of anchors is kept, and the gaps between
them are aligned in the same way. A place is a find if the aligned words cover at least 80 % of the template and lie close together. Of overlapping finds
the one with more aligned words stays.

Edge cases: a null or wordless text has no finds; long texts are scanned whole; ties between templates go to the first name; repeated rows are scanned each;
null ids pass through; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.common import query, table

WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")
COVERAGE = 0.8
DENSITY = 0.6

# Public license texts and notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed
        under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution.""",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the
        Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be
        useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
        notice and this permission notice appear in all copies.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in
        the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
        notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "MIT-notice": "Released under the MIT License",
}


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience piles."""
    tops, piles, back = [], [], [-1] * len(places)
    for i, x in enumerate(places):
        k = bisect_left(tops, x)
        back[i] = piles[k - 1] if k else -1
        if k == len(tops):
            tops.append(x), piles.append(i)
        else:
            tops[k], piles[k] = x, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], increasing in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        left, right = Counter(a[i:i_end]), Counter(b[j:j_end])
        where = {w: k for k, w in enumerate(b[j:j_end], j) if right[w] == 1}
        anchors = [(k, where[w]) for k, w in enumerate(a[i:i_end], i) if left[w] == 1 and w in where]
        if not anchors:
            continue
        anchors = [anchors[k] for k in increasing([x[1] for x in anchors])]
        found += anchors
        for (x, y), (x_end, y_end) in zip([(i - 1, j - 1), *anchors], [*anchors, (i_end, j_end)]):
            todo.append((x + 1, x_end, y + 1, y_end))
    return sorted(found)


class Scanner:
    """Finds of all templates in a text as (name, start word, end word, aligned words, template words)."""

    def __init__(self, templates: dict[str, str]):
        self.templates = [(name, words_of(t)) for name, t in sorted(templates.items())]
        self.templates = [(name, t, frozenset(t)) for name, t in self.templates if t]

    def __call__(self, text: str | None) -> list[tuple[str, int, int, int, int]]:
        words = words_of(text)
        there, finds = set(words), []
        for name, template, own in self.templates:
            n = len(template)
            # words of the template that occur at all bound what can be aligned
            if len(own - there) > (1 - COVERAGE) * n or sum(w in there for w in template) < COVERAGE * n:
                continue
            finds += [(name, *x, n) for x in self._places(template, own, words)]
        kept: list = []
        for find in sorted(finds, key=lambda f: (-f[3], f[1], f[0])):
            if all(find[2] <= k[1] or find[1] >= k[2] for k in kept):
                kept.append(find)
        return sorted(kept, key=lambda f: (f[1], f[0]))

    def _places(self, template: list[str], own: frozenset, words: list[str]):
        n = len(template)
        hits = np.concatenate([[0], np.cumsum([w in own for w in words])])
        width, starts = n + n // 4 + 1, np.arange(len(words))
        inside = hits[np.minimum(starts + width, len(words))] - hits[starts]
        at = 0
        while at < len(inside):
            good = np.flatnonzero(inside[at:] >= COVERAGE * n)
            if not len(good):
                return
            first = at + int(good[0])
            run = inside[first:first + width]
            start = first + int(np.argmax(run))
            low, high = max(start - n // 4, at), min(len(words), start + width + n // 4)
            pairs = patience(template, words[low:high])
            if pairs:
                begin, end = low + pairs[0][1], low + pairs[-1][1] + 1
                if len(pairs) >= COVERAGE * n and len(pairs) >= DENSITY * (end - begin):
                    yield begin, end, len(pairs)
                    at = max(end, first + 1)
                    continue
            at = first + 1 if start == first else start


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, finds) of each row of docs (doc_id, text); finds are structs of license, start, end, coverage."""
    fields = [("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]

    def run(batches):
        scanner = Scanner(templates or TEMPLATES)
        for batch in batches:
            made = [[{"license": f[0], "start": f[1], "end": f[2], "coverage": f[3] / f[4]} for f in scanner(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.struct(fields)))], names=["doc_id", "finds"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInArrow(run, "doc_id long, finds array<struct<license: string, start: bigint, end: bigint, coverage: double>>")


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    said = F.transform("finds", lambda f: F.concat_ws(":", f["license"], f["start"], f["end"], F.round(100 * f["coverage"]).cast("int")))
    return found.select("doc_id", F.size("finds").cast("long").alias("n_licenses"), F.array_join(said, ",").alias("licenses"))
