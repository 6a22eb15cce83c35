"""License scans by conditional compression (operator 10).

A template can only be present where all its *fixed* words (license name, version, clause)
are; the rarest of them in a text, wherever it stands, gives the places to look at, so line
ends and the length of a line or paragraph do not matter.  The words around such a place, as
many as the template with its differences may take, are a *candidate block*.

1. Every candidate block is compressed with zstandard alone and with the template as a raw
   dictionary.
2. The candidates of a text are ranked by the bytes that the dictionary saves.
3. In that order each template is confirmed by its wording: it is aligned with the block (least
   number of missing, added and changed words, fixed words untouched) and the differences have
   to stay within ``MAX_DIFFERENCE`` of its words.  A confirmed template takes its fixed words
   in the text; candidates behind it that need one of them are left out.

No candidate is dropped for its rank.  A license reports its finding with the fewest
differences.  After a kept one and a conjunction ("the MIT License or the Apache License,
Version 2.0") the next words are read once more behind its opening words.

Null and empty texts have no findings.  Very long texts are scanned whole.  Rows are kept one
to one, also with null or repeated ids; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.session import ship_package

c = F.col

MAX_DIFFERENCE = 0.25
CONJUNCTIONS = {"or", "and", "and/or"}

# License notices (id, words that must not differ, text).  In fixed words and
# texts case and punctuation do not count.
TEMPLATES = [
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2.0 as basis",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("Apache-2.0", "spdx apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "mit", "Released under the MIT License."),
    ("MIT", "mit", "Licensed under the MIT License."),
    ("MIT", "spdx mit", "SPDX-License-Identifier: MIT"),
    ("MIT", "without restriction sublicense",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so."),
    ("BSD", "bsd", "Licensed under the BSD License."),
    ("BSD", "source binary forms",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met."),
    ("ISC", "with or without fee",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-2.0", "gnu general 2", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "gnu general 3", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "gnu general 3",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("LGPL-3.0", "gnu lesser 3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "gnu affero 3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "mozilla 2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "cc by 4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by-sa 4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "cc by-nc 4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "cc by-nd 4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "attribution-noncommercial 4.0",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "attribution 4.0",
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "public domain", "This work is dedicated to the public domain."),
]

WORD = re.compile(r"[\w.\-/]*\w")
FINDING = "array<struct<license:string,template:int,saved:double,differences:int,wording:array<string>,line:int>>"


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def align(a: list[str], b: list[str], fixed: set[str], most: int):
    """Least changes that turn all of ``a`` into a prefix of ``b``, fixed words kept, at most
    ``most``: (changes, [(word of a or None, word of b or None)]), or None."""
    if not a:
        return 0, []
    none = most + 1
    table = [[j if j <= most else none for j in range(min(len(b), most) + 1)]]    # row i: j from max(0, i - most)
    for i, x in enumerate(a, 1):
        before, old = table[-1], max(0, i - 1 - most)
        lo, hi = max(0, i - most), min(len(b), i + most)
        edit = none if x in fixed else 1
        row = []
        for j in range(lo, hi + 1):
            best = none
            if old <= j < old + len(before):
                best = before[j - old] + edit
            if j and old <= j - 1 < old + len(before):
                best = min(best, before[j - 1 - old] + (0 if x == b[j - 1] else edit))
            if row:
                best = min(best, row[-1] + 1)
            row.append(min(best, none))
        if not row or min(row) > most:
            return None
        table.append(row)
    at = lambda i, j: table[i][j - max(0, i - most)] if 0 <= j - max(0, i - most) < len(table[i]) else none
    i = len(a)
    changes = min(table[i])
    j = max(0, i - most) + table[i].index(changes)
    out = []
    while i or j:
        edit = none if i and a[i - 1] in fixed else 1
        now = at(i, j)
        if i and j and a[i - 1] == b[j - 1] and at(i - 1, j - 1) == now:
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif i and j and at(i - 1, j - 1) + edit == now:
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif i and at(i - 1, j) + edit == now:
            i -= 1
            out.append((a[i], None))
        else:
            j -= 1
            out.append((None, b[j]))
    return changes, out[::-1]


def wording(pairs: list[tuple]) -> list[str]:
    """The differences of an alignment, one per run."""
    out, gone, new = [], [], []
    for x, y in [*pairs, ("", "")]:
        if x != y:
            gone += [x] if x is not None else []
            new += [y] if y is not None else []
        elif gone or new:
            op = "replace" if gone and new else "delete" if gone else "insert"
            out.append(f"{op}: {' '.join(gone)} -> {' '.join(new)}")
            gone, new = [], []
    return out


class Scanner:
    def __init__(self, templates=TEMPLATES):
        self.templates = []
        for name, fixed, text in templates:
            w = words(text)
            self.templates.append((name, set(words(fixed)) & set(w), w, zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                write_content_size=False)))
        self.longest = max((int((1 + MAX_DIFFERENCE) * len(t[2])) for t in self.templates), default=0)
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False)

    def confirm(self, text: list[str], i: int, p: int, q: int):
        """(start, end, changes, alignment) of template i with its word q at word p of the text, or None."""
        _, fixed, w, _ = self.templates[i]
        most = int(MAX_DIFFERENCE * len(w))
        if len(set(w).difference(text[max(0, p - q - most):p + len(w) - q + most])) > most:
            return None
        left = align(w[:q][::-1], text[max(0, p - q - most):p][::-1], fixed, most)
        right = left and align(w[q + 1:], text[p + 1:p + len(w) - q + most], fixed, most - left[0])
        if not right:
            return None
        lo = p - sum(y is not None for _, y in left[1])
        hi = p + 1 + sum(y is not None for _, y in right[1])
        return lo, hi, left[0] + right[0], [*left[1][::-1], (w[q], text[p]), *right[1]]

    def candidates(self, text: list[str]) -> list[tuple]:
        """(bytes saved, share, template, template word, place) of every candidate block, those
        that save most bytes first."""
        have, out, plain = set(text), [], {}
        for i, (_, fixed, w, _) in enumerate(self.templates):
            if not fixed <= have:
                continue
            rare = min(sorted(fixed), key=text.count)
            q, p, most = w.index(rare), -1, int(MAX_DIFFERENCE * len(w))
            for _ in range(text.count(rare)):
                p = text.index(rare, p + 1)
                span = (max(0, p - q - most), p + len(w) - q + most)
                raw = " ".join(text[span[0]:span[1]]).encode()
                if span not in plain:
                    plain[span] = len(self.alone.compress(raw))
                saved = plain[span] - len(self.templates[i][3].compress(raw))
                out.append((saved, saved / plain[span], i, q, p))
        return sorted(out, key=lambda x: (-x[0], x[2], x[4]))

    def matches(self, text: list[str]):
        """The confirmed templates of a list of words, in the order of their candidates."""
        for saved, share, i, q, p in self.candidates(text):
            found = self.confirm(text, i, p, q)
            if found is None:
                continue
            name, fixed, _, _ = self.templates[i]
            lo, hi, _, pairs = found
            at = [k for k, (x, y) in zip(_places(pairs, lo), pairs) if x in fixed]
            yield {"license": name, "template": i, "saved": share, "lo": lo, "hi": hi, "fixed": at, "wording": wording(pairs)}

    def listed(self, text: list[str], m: dict) -> list[dict]:
        """Templates that are confirmed if the words after ``m`` and a conjunction are read
        behind the opening words of ``m``, those before its first fixed word."""
        if m["hi"] >= len(text) or text[m["hi"]] not in CONJUNCTIONS:
            return []
        lead, after = m["lead"], m["hi"] + 1
        rest = text[after:after + self.longest]
        if lead[-1:] == ["the"] and rest[:1] == ["the"]:
            lead = lead[:-1]
        out = []
        for x in self.matches(lead + rest):
            if x["lo"] < len(lead) and x["fixed"][0] >= len(lead):
                move = after - len(lead)
                out.append({**x, "lo": after, "hi": x["hi"] + move, "fixed": [k + move for k in x["fixed"]], "lead": m["lead"]})
        return out

    def kept(self, text: list[str]) -> list[dict]:
        """The confirmed templates that no better one shares a fixed word with."""
        used, out = set(), []
        for m in self.matches(text):
            if used.isdisjoint(m["fixed"]):
                used.update(m["fixed"])
                out.append({**m, "lead": text[m["lo"]:m["fixed"][0]]})
        for m in out:                       # grows while it is read
            for x in self.listed(text, m):
                if used.isdisjoint(x["fixed"]):
                    used.update(x["fixed"])
                    out.append(x)
        return out

    def scan(self, text: str) -> list[dict]:
        """Findings of a text, one per license, in order of first appearance."""
        found = self.kept(words(text)) if text else []
        if not found:
            return []
        last = list(accumulate(len(words(x)) for x in text.split("\n")))     # words up to the end of each line
        best: dict[str, dict] = {}
        for m in sorted(found, key=lambda m: (len(m["wording"]), m["lo"])):
            best.setdefault(m["license"], {
                "license": m["license"], "template": m["template"], "saved": round(m["saved"], 6),
                "differences": len(m["wording"]), "wording": m["wording"], "line": bisect_right(last, m["lo"])})
        return sorted(best.values(), key=lambda x: (x["line"], x["license"]))


def _places(pairs: list[tuple], start: int) -> list[int]:
    """Word of the text at which each pair of an alignment stands."""
    return list(accumulate((y is not None for _, y in pairs[:-1]), initial=start))


def _scanning(batches):
    scanner = Scanner()
    kind = pa.list_(pa.struct([("license", pa.string()), ("template", pa.int32()), ("saved", pa.float64()),
                               ("differences", pa.int32()), ("wording", pa.list_(pa.string())), ("line", pa.int32())]))
    for batch in batches:
        texts = batch.column(1)
        _, offsets = tb.utf8(texts)
        for i, j in tb.blocks(offsets):
            found = [scanner.scan(t or "") for t in texts.slice(i, j - i).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(found, kind)],
                                             names=["doc_id", "findings"])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, licenses (confirmed, sorted), n_findings, findings."""
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(c(id_col).alias("doc_id"), c(text_col).alias("text")).mapInArrow(
        _scanning, f"doc_id {kind}, findings {FINDING}")
    return found.select("doc_id", F.array_sort("findings.license").alias("licenses"),
                        F.size("findings").cast("long").alias("n_findings"), "findings")
