"""License scans by conditional compression.

A license word is a cue, and the text around it a candidate block. The block is compressed with each
template as a raw zstandard dictionary, and the templates are ranked by the size that is left. In that
order their wording is held against the text at the cue, word by word; the first template whose
differences are few enough is the notice, and the differences are reported exactly. Text that a notice
holds is not looked at again. Blocks have a bounded size, so a text costs as much as it has cues. One
pass, no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Wordings of common public license notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
        "the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "all-rights-reserved": "All rights reserved.",
}
#: Words of which every template holds one.
CUES = ("licen", "copyright", "permission", "warrant", "redistribut", "rights reserved", "gnu general", "mozilla public")
#: Characters on either side of a cue that make a block.
REACH = 400
#: Words of a template that may be missing or replaced, and words that may stand between, in its length.
SLACK = 0.1
#: From this level zstandard parses optimally, so that a notice of three words already saves bytes.
LEVEL = 15

_CUE = re.compile("|".join(map(re.escape, CUES)))
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


@dataclass
class Template:
    name: str
    words: list[str]
    counts: Counter
    places: dict[str, list[int]]
    slack: int
    compressor: zstandard.ZstdCompressor


@lru_cache(1)
def _templates() -> tuple[zstandard.ZstdCompressor, list[Template]]:
    longest = max(map(len, TEMPLATES.values()))
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=2 * REACH + longest, dict_size=longest)
    found = []
    for name, text in TEMPLATES.items():
        data = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        told = [w for w, _, _ in words(text)]
        places = defaultdict(list)
        for at, word in enumerate(told):
            places[word].append(at)
        compressor = zstandard.ZstdCompressor(compression_params=params, dict_data=data)
        found.append(Template(name, told, Counter(told), places, int(len(told) * SLACK), compressor))
    return zstandard.ZstdCompressor(compression_params=params), found


def cues(text: str) -> list[int]:
    """Where license words start."""
    lower = text.lower()
    if len(lower) != len(text):  # some capitals lower to two characters
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return [m.start() for m in _CUE.finditer(lower)] if any(c in lower for c in CUES) else []


def confirm(block: list[str], at: int, template: Template) -> tuple[int, int, list[str], int] | None:
    """(first, last, missing, added) of the template's wording around the word at ``at``: the block's words
    first..last-1 hold it but for the ``missing`` template words and with ``added`` others between. Of several
    places that of the fewest differences; None where there are more than the slack, or a missing word holds
    a digit, as a version must be the template's own."""
    n, slack, found = len(template.words), template.slack, []
    for place in template.places.get(block[at], ()):
        lo, hi = max(0, at - place - slack), min(len(block), at - place + n + slack)
        there = Counter(block[lo:hi])
        if sum(min(many, there[w]) for w, many in template.counts.items()) < n - slack:
            continue
        parts = [p for p in SequenceMatcher(None, block[lo:hi], template.words, autojunk=False).get_matching_blocks() if p.size]
        hit = {p.b + i for p in parts for i in range(p.size)}
        first, last = lo + parts[0].a, lo + parts[-1].a + parts[-1].size
        missing, added = [w for i, w in enumerate(template.words) if i not in hit], last - first - len(hit)
        if first <= at < last and len(missing) <= slack and added <= slack and not any(c.isdigit() for w in missing for c in w):
            found.append((len(missing) + added, first, last, missing, added))
    return min(found)[1:] if found else None


def scan_text(text: str | None) -> list[tuple[str, int, int, float, int, int]]:
    """(license, start, end, reduction, missing, added) of the notices of a whole text, by start; no two overlap."""
    text = text or ""
    plain, templates = _templates()
    found, told, starts, done = [], [], [], 0
    packed = lambda lo, hi: text[max(done, lo) : hi].lower().encode("utf-8", "surrogatepass")
    for cue in cues(text):
        if cue < done:
            continue
        if not told:
            told = words(text)
            starts, block, done_word = [w[1] for w in told], [w[0] for w in told], 0
        at = bisect_right(starts, cue) - 1
        if at < done_word:
            continue
        raw = packed(cue - REACH, cue + REACH)
        ranked = sorted(templates, key=lambda t: (len(t.compressor.compress(raw)), -len(t.words), t.name))
        reach = max(len(t.words) + t.slack for t in templates)
        first_word = max(done_word, at - reach)
        near = block[first_word : at + reach]
        for template in ranked:
            place = confirm(near, at - first_word, template)
            if place:
                first, last, missing, added = place
                start, end = starts[first_word + first], told[first_word + last - 1][2]
                around = packed(start - REACH, end + REACH)
                alone = len(plain.compress(around))
                found.append((template.name, start, end, (alone - len(template.compressor.compress(around))) / alone, len(missing), added))
                done, done_word = end, first_word + last
                break
    return found


def scan(docs: DataFrame) -> DataFrame:
    """doc_id long, license string, start long, end long (code points), reduction double (of the
    compressed size of the notice and REACH around it), missing int, added int (words): a row for each notice of each row of docs.

    Null, empty and notice-free texts give no row. Repeated rows and rows with a null doc_id give
    theirs; other columns are not read; an empty table gives no rows.
    """
    names = ["doc_id", "license", "start", "end", "reduction", "missing", "added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)) for hit in scan_text(text.as_py())
            ]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, license string, start long, end long, reduction double, missing int, added int")
