"""License scans by patience alignment of whole texts with license notices.

Words that are unique in both the text region and the template are anchors; the longest increasing
subsequence of their positions is kept, and the gaps between anchors are aligned in the same way.
Coverage is the share of the template's words that the alignment matches. The words that tell a
license from its relatives must be among them, with nothing between that could make it another one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.common import map_batches, named

#: Notices of public licenses, as their authors ask them to be given.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-notice": "Released under the MIT License.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.",
    "all-rights-reserved": "All rights reserved.",
}
#: Words of a template, in order, that must be matched whatever the coverage.
KEYS = {
    "apache-2.0": "apache 2 0", "apache-2.0-header": "apache 2 0", "mit-notice": "mit", "gpl-3.0-notice": "gnu general public license 3", "gpl-3.0-header": "gnu general public license 3",
    "cc-by-4.0": "cc by 4 0", "cc-by-sa-4.0": "cc by sa 4 0", "cc-by-nc-4.0": "cc by nc 4 0", "cc0-1.0": "cc0 1 0", "all-rights-reserved": "all rights reserved",
}
#: Words that may be inserted in templates of at most ``ONE_LINE`` words, and between neighbours that are both keys.
NEUTRAL = frozenset("a an and conditions gpl international licence license of software terms the v version".split())
ONE_LINE = 12
#: Words by which a place that a single hit implies is widened, for what is inserted there.
WIDER = 4
#: Most words of a region, as a multiple of the template's; what reaches further joins two notices.
STRETCH = 1.25
COVERAGE = 0.8
#: A version like v3 is two words.
WORD = re.compile(r"v(?=\d)|[^\W_]+")


def increasing(values: list[int]) -> list[int]:
    """Indices of the longest strictly increasing subsequence, by patience sorting."""
    tops, ends, back = [], [], []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        tops[pile : pile + 1] = [v]
        ends[pile : pile + 1] = [i]
        back.append(ends[pile - 1] if pile else -1)
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text, template) positions in order. Gaps wait on a stack, so depth never grows the call stack."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        left, right = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(text[a:b], a) if left[w] == 1}
        pairs = [(at[w], j) for j, w in enumerate(template[c:d], c) if right[w] == 1 and w in at]
        anchors = [pairs[i] for i in increasing([p[0] for p in pairs])]
        for i, j in anchors:
            todo.append((a, i, c, j))
            out.append((i, j))
            a, c = i + 1, j + 1
        if anchors:
            todo.append((a, b, c, d))
    return sorted(out)


class Scanner:
    """Finds every template in whole texts.

    Only regions around a template's word pairs are aligned. A covered template has such a pair: with
    eight tenths of its words matched in order, some two neighbours are matched, side by side unless
    the text puts words between all of them.
    """

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE, keys: dict[str, str] | None = None):
        self.coverage = coverage
        self.templates = {k: WORD.findall(t.lower()) for k, t in templates.items()}
        self.vocabulary = {w for t in self.templates.values() for w in t}
        self.pairs: dict[tuple[str, str], list[tuple[str, int]]] = {}
        self.keys: dict[str, set[int]] = {}
        for k, t in self.templates.items():
            for at, p in enumerate(zip(t, t[1:], strict=False)):
                self.pairs.setdefault(p, []).append((k, at))
            at, self.keys[k] = -1, set()
            for w in (keys or {}).get(k, "").split():
                at = t.index(w, at + 1)
                self.keys[k].add(at)

    def valid(self, matched: list[tuple[int, int]], words: list[str], name: str) -> bool:
        """Covered, with every key, and with no more words inserted than are missing, neutral ones aside."""
        keys, template = self.keys[name], self.templates[name]
        if len(matched) < self.coverage * len(template) or not keys <= {c for _, c in matched}:
            return False
        for (i, c), (j, d) in zip(matched, matched[1:], strict=False):
            if j - i > d - c and (len(template) <= ONE_LINE or c in keys and d in keys) and sum(w not in NEUTRAL for w in words[i + 1 : j]) >= d - c:
                return False
        return True

    def found(self, words: list[str], name: str, hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(matched words, first, last) of the valid regions. Where copies follow one another no word is unique, and a
        stray word may stand for one of the notice, so then the places that single hits imply are aligned by themselves."""
        out, template, at = {}, self.templates[name], 0
        known = set(template)

        def look(a: int, b: int, again: bool = True) -> bool:
            part = words[a:b]
            if sum(w in known for w in part) < self.coverage * len(template):
                return False
            matched = align(part, template)
            apart = [k for k, ((i, c), (j, d)) in enumerate(zip(matched, matched[1:], strict=False)) if j - i > d - c + WIDER]
            first = max((k + 1 for k in apart if k + 1 <= len(matched) // 5), default=0)
            last = min((k + 1 for k in apart if k + 1 >= len(matched) - len(matched) // 5), default=len(matched))
            if again and last - first < len(matched):  # stray words at the ends: the place that the others imply
                (i, c), (j, d) = matched[first], matched[last - 1]
                return look(max(0, a + i - c), a + j + len(template) - d, again=False)
            if not self.valid(matched, part, name) or matched[-1][0] - matched[0][0] >= STRETCH * len(template) + WIDER:
                return False
            out[len(matched), a + matched[0][0], a + matched[-1][0]] = None
            return True

        for a, b in self.regions(words, name, hits):
            starts = {}
            while at < len(hits) and hits[at][0] < b:
                starts[hits[at][0] - hits[at][1]] = None
                at += 1
            if not look(a, b) or len(starts) > 1:
                for start in starts:
                    for wider in (0, WIDER, len(template) // 5):
                        look(max(0, start - wider), max(0, start + len(template) + wider))
        return list(out)

    def regions(self, words: list[str], name: str, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
        reach, out = len(self.templates[name]), []
        for i, _ in hits:
            if out and i - reach <= out[-1][1]:
                out[-1][1] = min(len(words), i + reach)
            else:
                out.append([max(0, i - reach), min(len(words), i + reach)])
        return [tuple(r) for r in out]

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, matched words, start, end) of every region, in code points of the text. Of regions that
        overlap, only the one with the most matched words counts, of equal ones the shortest, then the first."""
        if not text:
            return []
        low = text.replace("\u0130", "i").lower()  # the only character whose lower case is longer, so places stay
        words = WORD.findall(low)
        known = self.vocabulary.intersection(words)
        able = {k for k, t in self.templates.items() if sum(w in known for w in t) >= self.coverage * len(t)}
        if not able:
            return []
        hits: dict[str, list[tuple[int, int]]] = {}
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            for k, at in self.pairs.get(pair, ()):
                if k in able:
                    hits.setdefault(k, []).append((i, at))
        found = [(-n, -n / len(self.templates[k]), b - a, a, b, k) for k, pairs in hits.items() for n, a, b in self.found(words, k, pairs)]
        places, out, taken = None, [], []
        for n, share, _, a, b, k in sorted(found):
            at = bisect_left(taken, (a, b))
            if at and taken[at - 1][1] >= a or at < len(taken) and taken[at][0] <= b:
                continue
            taken.insert(at, (a, b))
            places = places or [m.span() for m in WORD.finditer(low)]
            out.append((k, round(-share, 6), -n, places[a][0], places[b][1]))
        return sorted(out, key=lambda r: (r[3], r[0]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id: str = "doc_id", text: str = "text", keys: dict[str, str] | None = None) -> DataFrame:
    """(id, license, coverage, n_matched, start, end): every region of a document's text that covers a template.

    ``keys`` are the words that must be matched in ``templates`` of one's own.
    One row for a document and region; regions don't overlap; documents without a license have none.
    Null and empty texts have none. Repeated rows give repeated results, null ids stay, ids may be of any
    type, other columns are not read, an empty table gives an empty table. Texts are read whole; the regions
    that are aligned are at most a few templates long unless hits follow one another. No shuffle.

    A region has at most ``STRETCH`` times the template's words and ``WIDER`` more: what covers a template only over a
    longer stretch is not told, as it is two notices, or one with as much put in as a quarter of it.
    """
    scanner = Scanner(templates or TEMPLATES, coverage, keys if templates else KEYS)
    names = ("license", "coverage", "n_matched", "start", "end")

    def setup():
        def work(texts):
            found = [(row, *r) for row, t in enumerate(texts) for r in scanner.scan(t)]
            rows, *lists = zip(*found, strict=True) if found else [()] * 6
            return rows, dict(zip(names, lists, strict=True))

        return work

    kinds = list(zip(names, ("string", "double", "long", "long", "long"), strict=True))
    return map_batches(docs.select(named(id).alias("id"), named(text).cast("string").alias("text")), setup, kinds).withColumnRenamed("id", id)
