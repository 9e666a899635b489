r"""License scans by conditional compression.

Candidate blocks are runs of lines with license wording, at most `GAP` other lines apart; of a line longer than `SPAN`
characters so many words on each side of its cues are read that no notice with a cue in it is cut. A block of many words is read in windows that overlap by half; words of a notice
that is found are taken for all of them, and a notice that begins in the second half waits for the next window, so none is
cut and none found twice.

Method: a block is compressed alone and with each template as zstandard raw dictionary; templates rank by how much
smaller that makes it. Down the rank, templates are compared word by word: one is confirmed if its words stand in the
block, with few missing and foreign ones (those whose words the block lacks can't be, and are passed over). The first
confirmed one that stands there word for word wins, with the verdict exact, else the first confirmed one, unless a longer
one covers its words and more. The words of a winner are taken out and what remains is ranked again,
until nothing is confirmed: a block has a row for each of its notices. Placeholders, in angle brackets, stand for any words.

Defined cases: null and empty texts and texts without license wording give no rows; equal ranks go by template name;
repeated documents give repeated rows; an empty table gives no rows; other columns are ignored, whatever their names;
texts are read whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Customary notices of public licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-4.0-deed": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "reserved": "All rights reserved.",
    "reserved-copyright": "Copyright <year> <owner>. All rights reserved.",
}
CUES = ("licens", "licenc", "copyright", "permission", "warrant", "redistribut", "public domain", "spdx", "creative commons", "rights reserved")
GAP, SPAN, LEVEL, STEP = 3, 4096, 9, 256
#: A winner misses at most this share of its words, and has at most as many foreign ones among them.
MISSING = 0.2
WORD = re.compile(r"<\w+>|\w+(?:\.\w+)*")
CUE = re.compile("|".join(map(re.escape, CUES)))


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def blocks(text: str, reach: int = STEP) -> Iterator[tuple[int, int]]:
    """(begin, end) of candidate blocks; reach: words on each side of a cue that are read of a line longer than SPAN."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    runs: list[list[int]] = []
    line, at = (-1, -1), []  # a long line, and the bounds of its words
    for m in CUE.finditer(low):
        begin = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.end())
        end = len(text) if end < 0 else end
        if end - begin > SPAN:
            if (begin, end) != line:
                line, at = (begin, end), [w.span() for w in WORD.finditer(text, begin, end)]
            nth = bisect_right(at, (m.start(), end)) - 1
            begin, end = at[max(0, nth - reach)][0], at[min(len(at) - 1, nth + reach)][1]
        if runs and (begin <= runs[-1][1] or text.count("\n", runs[-1][1], begin) <= GAP and begin - runs[-1][1] <= SPAN):
            runs[-1][1] = max(runs[-1][1], end)
        else:
            if runs:
                yield runs[-1][0], runs[-1][1]
            runs = [[begin, end]]
    for begin, end in runs:
        yield begin, end


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.words = {n: words(t) for n, t in templates.items()}
        #: Words from one window to the next: a notice that begins in the first half of a window ends within it.
        self.step = max([STEP, *(2 * len(w) for w in self.words.values())])
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.given = {}
        for name, text in templates.items():
            data = zstandard.ZstdCompressionDict(" ".join(self.words[name]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=data)

    def ranked(self, block: list[str | None]) -> list[tuple[float, str]]:
        """(reduction, name), largest first; None stands for a word that is taken."""
        data = " ".join(w for w in block if w is not None).encode()
        size = len(self.alone.compress(data))
        return sorted(((1 - len(c.compress(data)) / size, n) for n, c in self.given.items()), key=lambda x: (-x[0], x[1]))

    def possible(self, block: list[str | None]) -> set[str]:
        """Templates that miss few words wherever those stand in the block: no other one can be confirmed."""
        have = Counter(block)
        return {n for n, want in self.words.items() if sum((Counter(w for w in want if w[0] != "<") - have).values()) <= MISSING * len(want)}

    def differences(self, name: str, block: list[str | None]) -> tuple[int, int, frozenset[int]]:
        """(missing, foreign) words of the template's closest stretch of the block, and the places of those found."""
        want = self.words[name]
        match = SequenceMatcher(None, want, block, autojunk=False)
        parts = [m for m in match.get_matching_blocks() if m.size]
        if not parts:
            return len(want), 0, frozenset()
        # the stretch about the longest match that is as long as the template, with some room
        main = max(parts, key=lambda m: (m.size, -m.b))
        loose = sum(w[0] == "<" for w in want)
        room = len(want) // 4 + 4 * loose
        begin, end = main.b - main.a - room, main.b - main.a + len(want) + room + 1
        inside = [m for m in parts if begin <= m.b and m.b + m.size <= end]
        found = frozenset(k for m in inside for k in range(m.b, m.b + m.size))
        missing = len(want) - len(found) - loose
        # words between the ends that stand where a placeholder does are its own, taken ones another notice's
        gaps = [(a, b) for a, b in zip(inside, inside[1:]) if not any(w[0] == "<" for w in want[a.a + a.size : b.a])]
        foreign = sum(w is not None for a, b in gaps for w in block[a.b + a.size : b.b])
        return max(0, missing), foreign, found

    def winner(self, rank: list[tuple[float, str]], block: list[str | None], possible: set[str], before: int) -> tuple | None:
        """(license, reduction, missing, foreign, places): the first template down the rank that is confirmed, begins before a
        place and has no words that a longer one covers with others besides."""
        held: list[tuple] = []
        for gain, name in rank:
            if name not in possible:
                continue
            missing, foreign, places = self.differences(name, block)
            if not places or max(missing, foreign) > MISSING * len(self.words[name]) or min(places) >= before:
                continue
            held.append((name, gain, missing, foreign, places))
        held = [x for x in held if not any(x[-1] < y[-1] for y in held)]
        # one that stands there word for word is not a changed other one with it inside
        return next((x for x in held if x[2] == x[3] == 0), held[0]) if held else None

    def scan(self, text: str) -> Iterator[tuple]:
        """(begin, length, license, reduction, missing, foreign, verdict) of each notice, or of a block without one."""
        for begin, end in blocks(text, self.step):
            every: list[str | None] = list(words(text[begin:end]))
            gains = [0.0]
            found = False
            for at in range(0, len(every), self.step):
                window = slice(at, at + 2 * self.step)
                last = window.stop >= len(every)
                while True:
                    block = every[window]
                    possible = self.possible(block)
                    if not possible and (found or at):
                        break  # no template can be confirmed
                    rank = self.ranked(block)
                    gains.append(rank[0][0])
                    best = self.winner(rank, block, possible, len(block) if last else self.step)
                    if best is None:
                        break
                    found = True
                    name, gain, missing, foreign, places = best
                    yield begin, end - begin, name, gain, missing, foreign, "modified" if missing or foreign else "exact"
                    for k in places:
                        every[at + k] = None
                if last:
                    break
            if every and not found:
                yield begin, end - begin, None, max(gains[1:]), None, None, "unknown"


def license_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per notice, or candidate block without one: (id, start, length, license, reduction, missing, foreign, verdict); a map without a shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "start", "length", "license", "reduction", "missing", "foreign", "verdict"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            rows = [(i, *r) for i, text in enumerate(batch.column(1).to_pylist()) if text for r in scanner.scan(text)]
            cols = list(zip(*rows)) if rows else [()] * 8
            types = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], types))], names=names)

    asked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = asked.mapInArrow(run, f"id {kind}, start long, length long, license string, reduction double, missing long, foreign long, verdict string")
    return out.withColumnRenamed("id", id_col)
