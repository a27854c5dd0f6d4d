"""License scan by conditional compression (dealt operator 8).

A candidate block is the stretch of text around words of license language,
across line feeds, of at most ``BLOCK_WORDS`` words (longer stretches are several blocks that
overlap by more than any notice).  A block is compressed with zstandard alone and
with every template as raw dictionary, and the templates are ranked by size
reduction.  In that order each is confirmed by the exact differences in
wording: a notice is a run of the block's words of which, aligned with the
template's, at most a tenth of the template's words are missing or changed,
and at most as many added.  The first template that is confirmed wins: its
notices leave the block (but those that another template has with fewer
differences), and what remains is compressed and ranked anew, until no template
is confirmed.
"""

from __future__ import annotations

import re
from string import punctuation

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# License statements and notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
)
# White space as str.split() sees it and the marks of comment lines, the same for Python's and Java's patterns.
GAP = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000*#/;%|>-]+"
LANGUAGE = (r"(?i)licen[cs]|copyright|copyleft|public domain|permission is hereby|redistribut|rights reserved|free software|spdx"
            r"|permission to use|\bCC0\b|\bCC BY").replace(" ", GAP)
CONFIRMED = 0.1      # share of a template's words that may differ
BEFORE, AFTER = 20, 60   # least words of a block before and after a word of license language
BLOCK_WORDS = 600        # most words of a block
LEVEL = 9                # of compression
MARKS = punctuation + "\u2018\u2019\u201c\u201d\u00ab\u00bb\u2022\u00b7\u2013\u2014\u2026"
WORD = re.compile(r"\S+")


def wording(text: str) -> list[str]:
    """Words without case and without punctuation at their ends."""
    return [w for w in (x.strip(MARKS).lower() for x in text.split()) if w]


def candidate_blocks(text: str, before: int = BEFORE, after: int = AFTER) -> list[tuple[list[str], list[tuple[int, int]]]]:
    """(words, their places in the text) of the stretches around license language; overlapping ones are one stretch."""
    hits = [m.start() for m in re.finditer(LANGUAGE, text)]
    if not hits:
        return []
    words, at = [], []
    for m in WORD.finditer(text):
        word = m[0].strip(MARKS).lower()
        if word:
            words.append(word)
            at.append(m.span())
    spans: list[list[int]] = []
    word = 0
    for hit in hits:
        while word < len(at) - 1 and at[word][1] <= hit:
            word += 1
        a, b = max(0, word - before), min(len(at), word + after)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    return [(words[a:b], at[a:b]) for a, b in spans]


class Scanner:
    def __init__(self, templates=TEMPLATES, ranked: bool = True):
        self.templates, self.ranked = [], ranked
        for name, text in templates:
            known = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self.templates.append((name, wording(text), zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)))
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        self.limit = [int(CONFIRMED * len(want)) for _, want, _ in self.templates]
        self.longest = max((len(want) + d for (_, want, _), d in zip(self.templates, self.limit, strict=True)), default=0)
        self.before, self.after = max(BEFORE, self.longest), max(AFTER, self.longest)   # a stretch holds any notice around its hit whole
        # d words missing and d added leave one of 2 d + 1 pieces of a template as it is
        self.pieces: list[dict[str, list[tuple[int, list[str]]]]] = []
        for i, (_, want, _) in enumerate(self.templates):
            n, own = 2 * self.limit[i] + 1, {}
            cuts = [len(want) * j // n for j in range(n + 1)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b:
                    own.setdefault(want[a], []).append((a, want[a:b]))
            self.pieces.append(own)
        self.places = []     # of each template: word -> bits of its places
        for _, want, _ in self.templates:
            bits: dict[str, int] = {}
            for j, w in enumerate(want):
                bits[w] = bits.get(w, 0) | 1 << j
            self.places.append(bits)

    def ranking(self, block: str) -> list[tuple[float, int]]:
        """(size reduction, template) of every template, the largest reduction first, of equals the first template."""
        data = block.lower().encode()
        alone = len(self.plain.compress(data))
        gains = [1 - len(c.compress(data)) / alone if self.ranked else 0.0 for _, _, c in self.templates]
        return sorted(((g, i) for i, g in enumerate(gains)), key=lambda x: (-x[0], x[1]))

    def notices(self, words: list[str | None], number: int) -> list[tuple[int, int, int]]:
        """(differing words, start, end) of a template's notices that share no word: fewest differences first."""
        own, tried, found = self.pieces[number], set(), set()
        for q, w in enumerate(words):
            for p, piece in own.get(w, ()) if w is not None else ():
                if q - p not in tried and words[q:q + len(piece)] == piece:
                    tried.add(q - p)
                    notice = self.confirm(words, number, q - p)
                    if notice:
                        found.add(notice)
        kept: list[tuple[int, int, int]] = []
        last: dict[int, int] = {}            # word -> 1 for words of kept notices
        for differ, a, b in sorted(found):
            if not any(x in last for x in range(a, b)):
                kept.append((differ, a, b))
                last.update((x, 1) for x in range(a, b))
        return kept

    def confirm(self, words: list[str], number: int, begin: int) -> tuple[int, int, int] | None:
        """(differing words, start, end) of the notice that starts within the template's limit of ``begin``.

        Differing are words that are missing or changed, or added inside; the
        alignment is the longest common subsequence, one bit a template word.
        None if too many differ; of equals the shortest.
        """
        m, d, bits = len(self.templates[number][1]), self.limit[number], self.places[number]
        full, best = (1 << m) - 1, None
        for a in range(max(0, begin - d), min(len(words), begin + d + 1)):
            if words[a] not in bits:
                continue
            open_ = full
            for b in range(a, min(len(words), a + m + d)):
                at = bits.get(words[b], 0)
                if not at:
                    continue
                hit = open_ & at
                open_ = ((open_ + hit) | (open_ - hit)) & full
                differ = max(m, b + 1 - a) - (m - open_.bit_count())
                if differ <= d and (best is None or (differ, b + 1 - a) < (best[0], best[2] - best[1])):
                    best = differ, a, b + 1
        return best

    def scan(self, text: str) -> tuple[int, list[tuple[str, float, int, int, int]]]:
        """(stretches of license language, (license, reduction, differing words, start, end) of each notice)."""
        stretches, found = candidate_blocks(text, self.before, self.after), []
        for whole, at in stretches:
            words: list[str | None] = list(whole)
            step = max(1, BLOCK_WORDS - 2 * self.longest)
            for begin in range(0, max(1, len(words) - 2 * self.longest), step):
                self._block(words, begin, min(len(words), begin + step + 2 * self.longest), text, at, found)
        return len(stretches), found

    def _block(self, words, begin, end, text, at, found) -> None:
        """Compress, rank and confirm until nothing is confirmed; notices found leave ``words``."""
        while True:
            rest = " ".join(text[at[i][0]:at[i][1]] for i in range(begin, end) if words[i] is not None)
            if not rest:
                return
            ranked, held = self.ranking(rest), words[begin:end]
            for gain, i in ranked:
                won = self.notices(held, i)
                if any(n[0] for n in won):   # words that another template has with fewer differences are left to it
                    better = [n for _, j in ranked if j != i for n in self.notices(held, j)]
                    won = [n for n in won if not any(m[0] < n[0] and m[1] < n[2] and n[1] < m[2] for m in better)]
                if won:
                    break
            else:
                return
            for differ, a, b in won:
                a, b = a + begin, b + begin
                found.append((self.templates[i][0], gain, differ, at[a][0], at[b - 1][1]))
                words[a:b] = [None] * (b - a)


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(row, n_blocks, licenses, n_exact, best_reduction) per row of ``docs`` (text).

    ``licenses`` are the confirmed names, sorted and comma-joined, empty if
    none; n_exact counts notices whose wording has no difference;
    best_reduction is the largest size reduction of a block by a template confirmed in it, 0 if
    none.  Null and empty texts have no block; texts are scanned whole;
    repeated rows get equal results; ``row`` is the whole input row.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.when(text.rlike(LANGUAGE), text).alias("text"))

    def run(batches):
        scanner = Scanner(templates)
        for batch in batches:
            n, names, exact, gain = [], [], [], []
            for value in batch.column("text"):
                blocks, found = scanner.scan(value.as_py()) if value.is_valid else (0, [])
                n.append(blocks)
                names.append(",".join(sorted({f[0] for f in found})))
                exact.append(sum(f[2] == 0 for f in found))
                gain.append(max((f[1] for f in found), default=0.0))
            yield pa.record_batch({"row": batch.column("row"), "n_blocks": pa.array(n, pa.int64()),
                                   "licenses": pa.array(names, pa.string()), "n_exact": pa.array(exact, pa.int64()),
                                   "best_reduction": pa.array(gain, pa.float64())})

    return rows.mapInArrow(run, T.StructType([rows.schema["row"]]).add("n_blocks", "long").add("licenses", "string")
                           .add("n_exact", "long").add("best_reduction", "double"))
