"""License scans by conditional compression.

Around each cue in a block of a text that speaks of licensing, a window a little longer than a template on either side is
compressed with zstandard, plain and with the template as a raw dictionary. A template that the window repeats makes it much
smaller, by a good part of the template's own size; each such template is compared with the window word by word, and the one
with the fewest differences is confirmed if no word differs that tells licenses apart. Its words are then taken out of the block,
and what is left is searched again until nothing is confirmed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, replace
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import table

#: Wording of common license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("BSD-2-Clause", 'Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
)
TEMPLATES += tuple((name, f"SPDX-License-Identifier: {name}") for name in dict.fromkeys(n for n, _ in TEMPLATES) if name != "BSD")
#: Parts of words that make a line a candidate, and words that tell licenses apart.
CUES = ("licen", "permission is hereby", "redistribution and use", "redistribute it", "public domain", "creative commons", "mozilla public", "cc by", "cc0", "permission to use", "as is", "as-is", "eclipse public", "unencumbered", "prior written permission")
TELLING = set("apache mit bsd gnu general lesser affero mozilla mpl gpl lgpl agpl cc cc0 by sa nc nd 1 2 3 4 0 isc eclipse epl boost unlicense attribution sharealike noncommercial noderivatives".split())
DENYING = {"not", "never", "no"}  # in the three words before a notice: it does not hold
WORD = re.compile(r"[^\W_]+")
BREAK = re.compile(r"\s*\n[^\w\n]*")  # the end of a line, with the marks of a comment that begin the next
CUE = re.compile("|".join(f"(?={re.escape(c)})".replace("\\ ", r"[\W_]+") for c in CUES))
LEVEL = 19
AROUND = 4  # words that a window has more than the template on either side of a cue
LEAST = 0.15  # of the compressed size of the window or, if smaller, of the template itself that a template saves, at least
REMEMBERED = 16_000_000  # characters of windows that a worker remembers
DIFFER = 0.2  # of the template's words that may differ, at most


@dataclass
class Match:
    block: str
    license: str
    reduction: float
    missing: list[str]
    extra: list[str]
    confirmed: bool


def wording(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Scanner:
    def __init__(self, templates=TEMPLATES):
        self.templates = [(name, text, wording(text)) for name, text in templates]
        self.known = {w for _, _, words in self.templates for w in words}
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, text in templates]
        self.own = [len(self.plain.compress(text.lower().encode())) for _, text in templates]
        self.seen: dict[tuple[str, int], tuple] = {}
        self.held = 0

    def blocks(self, text: str) -> list[str]:
        """Runs of lines: one in which a cue begins, and those around it most of whose words stand in some template (all of them in lines of
        fewer than four words); an empty line is passed if a line of four such words follows it."""
        lowered = text.lower()
        flat = BREAK.sub(" ", lowered) if "\n" in lowered else lowered
        if not any(c in flat for c in CUES):
            return []
        lines = text.split("\n")
        low = [line.lower() for line in lines]
        starts = [any(c in line for c in CUES) for line in low]
        for i in range(len(low) - 1):  # cues that a line break cuts
            if not starts[i] and not starts[i + 1] and any(c in BREAK.sub(" ", f"{low[i]}\n{low[i + 1]}") for c in CUES):
                starts[i] = True

        def alike(k: int, least: int = 1) -> bool:
            words = wording(lines[k])
            known = sum(w in self.known for w in words)
            return len(words) >= least and known >= (0.8 * len(words) if len(words) >= 4 else len(words))

        def further(k: int, step: int, stop: int) -> int:
            """The next line on that belongs to the block, or ``k``."""
            at = k + step
            if at == stop or alike(at):
                return k if at == stop else at
            return at + step if not wording(lines[at]) and at + step != stop and alike(at + step, 4) else k

        out, taken = [], -1
        for i, cue in enumerate(starts):
            if i <= taken or not cue:
                continue
            a = b = i
            while (k := further(a, -1, taken)) != a:
                a = k
            while (k := further(b, 1, len(lines))) != b:
                b = k
            taken = b
            out.append(" ".join(" ".join(lines[a : b + 1]).split()))
        return out

    def compared(self, window: str, k: int) -> tuple[tuple, Match, int, int]:
        """A window against a template: rank, match and where the words that match begin and end; windows met before are remembered."""
        if (found := self.seen.get((window, k))) is not None:
            return found
        name, _, wanted = self.templates[k]
        raw, words = window.lower().encode("utf-8", "replace"), wording(window)
        alone = len(self.plain.compress(raw))
        reduction = (alone - len(self.given[k].compress(raw))) / min(alone, self.own[k])
        missing, extra, inside = [], [], []
        inner = SequenceMatcher(None, wanted, words, autojunk=False).get_opcodes() if reduction >= LEAST else [("replace", 0, len(wanted), 0, 0)]
        for n, (kind, i, j, a, b) in enumerate(inner):
            # words before or after the whole template do not differ from it, they surround it
            if kind in ("insert", "replace") and n in (0, len(inner) - 1):
                a, b = (max(a, b - (j - i)), b) if n == 0 else (a, min(b, a + (j - i)))
            missing += wanted[i:j] if kind in ("delete", "replace") else []
            extra += words[a:b] if kind in ("insert", "replace") else []
            inside += [a, b] if kind == "equal" else []
        telling = TELLING.intersection(missing) or TELLING.intersection(extra)
        denied = inside and DENYING.intersection(words[max(0, inside[0] - 3) : inside[0]]) and wanted[0] not in DENYING
        confirmed = not telling and not denied and len(missing) + len(extra) <= DIFFER * len(wanted) and reduction >= LEAST
        rank = (not confirmed, len(missing) + len(extra), -len(wanted), -reduction)
        self.held += len(window)
        if self.held > REMEMBERED:
            self.seen, self.held = {}, 0
        self.seen[window, k] = found = (rank, Match("", name, reduction, missing, extra, bool(confirmed)), *((inside[0], inside[-1]) if inside else (0, 0)))
        return found

    def matches(self, block: str) -> list[Match]:
        """All templates confirmed in a block, in the order of certainty, or else the best one, not confirmed."""
        spans = [m.span() for m in WORD.finditer(block)]
        if not spans:
            return []
        starts, lowered = [a for a, _ in spans], block.lower()
        if len(lowered) != len(block):  # letters that are longer in lower case would move the cues
            lowered = "".join(c if len(c) == 1 else "?" for c in map(str.lower, block))
        cues = {max(0, bisect_right(starts, m.start()) - 1) for m in CUE.finditer(lowered)}
        reach = max(len(wanted) for _, _, wanted in self.templates) + AROUND
        free = dict.fromkeys(cues, (0, len(spans)))

        def best(c: int) -> tuple:
            low, high = free[c]
            options = []
            for k, (_, _, wanted) in enumerate(self.templates):
                a, b = max(low, c - len(wanted) - AROUND), min(high, c + len(wanted) + AROUND + 1)
                rank, found, first, last = self.compared(block[spans[a][0] : spans[b - 1][1]], k)
                options.append((rank, a + first, a + last, k, found))
            return min(options, key=lambda o: o[:4])

        chosen, out = {c: best(c) for c in sorted(cues)}, []
        while chosen:
            rank, a, b, _, found = min(chosen.values(), key=lambda o: o[:4])
            if not out or found.confirmed:
                out.append(replace(found, block=block))
            if not found.confirmed:
                break
            for c in list(chosen):
                low, high = free[c]
                if a <= c < b:
                    del chosen[c]
                elif c >= b > low:
                    free[c] = (b, high)
                elif c < a < high:
                    free[c] = (low, a)
                if c in chosen and (low, high) != free[c] and (c - reach <= b and c + reach >= a):
                    chosen[c] = best(c)
        return out


def license_blocks(docs: DataFrame, templates=TEMPLATES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``blocks`` of each row: per candidate block all its confirmed licenses, or the best one if none is, each with the
    block's text and number, reduction (the share of the compressed size of the window or the template that is saved), missing and
    extra words and whether it is confirmed.

    The whole text is searched, however long; a window never holds more than a few hundred words. Null, empty and unlicensed texts
    have no blocks. Repeated rows have equal blocks. All other columns of ``docs`` are left out.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    block = pa.struct([("number", pa.int32()), ("text", pa.string()), ("license", pa.string()), ("reduction", pa.float64()), ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string())), ("confirmed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for t in batch.column(1).to_pylist():
                    found = [(i, m) for i, b in enumerate(scanner.blocks(t or "")) for m in scanner.matches(b)]
                    rows.append([{"number": i, "text": m.block, "license": m.license, "reduction": m.reduction, "missing": m.missing, "extra": m.extra, "confirmed": m.confirmed} for i, m in found])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(block))], names=["doc_id", "blocks"])

    schema = f"doc_id {kind}, blocks array<struct<number:int,text:string,license:string,reduction:double,missing:array<string>,extra:array<string>,confirmed:boolean>>"
    return docs.select(doc_id, text).mapInArrow(run, schema)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many candidate blocks, the confirmed licenses (sorted, comma-joined) and the words that differ in them."""
    found = license_blocks(table(spark, sf_dir, "documents"))
    sure = F.filter("blocks", lambda b: b["confirmed"])
    return found.select(
        "doc_id",
        F.size(F.array_distinct(F.transform("blocks", lambda b: b["number"]))).cast("long").alias("n_blocks"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda b: b["license"]))), ",").alias("licenses"),
        F.aggregate(sure, F.lit(0).cast("long"), lambda n, b: n + F.size(b["missing"]) + F.size(b["extra"])).alias("n_differing_words"),
    )
