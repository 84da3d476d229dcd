"""Operator 10: licence scans by the Dice coefficient over word bigrams.

Texts and templates are normalised alike: words of ASCII letters and digits in lower case. The
units of a text are its lines, the sentences of its lines, its blocks between blank lines, and the
whole text. A unit is held against those templates alone whose number of bigrams allows a Dice
coefficient at the threshold; the best template of a unit counts, and of a document the best unit
for each licence.

Notices wrapped over lines, with comment marks or inside a longer paragraph fill no unit. Licences that
no unit gave are looked for in windows of the words of the whole text, whatever stands between them:
all windows that start and end at a bigram of a template, of notices and of whole licences alike. A
window counts as no shorter than its template, so that what it leaves out, such as another version,
still counts against it. Of windows that overlap, the one that shares most bigrams stands.

Defined results: null, empty and one-word texts match nothing; a repeated row is scanned as often
as it stands there; ties between templates go to the first name; columns other than id and text
are ignored. All work on a text stays in the task that reads it; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import slices, text_of
from apptlake.llm.license_texts import BODIES

#: Licence notices and texts (fixed values, as their publishers word them).
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License.",
    ],
    "bsd-2-clause": [
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ],
}

#: Least Dice coefficient, in percent.
THRESHOLD = 80

_WORD = re.compile("[A-Za-z0-9]+")
_SENTENCE = re.compile("([.!?]) +")
_BLANK = re.compile("\n[ \t\r]*\n")


def bigrams(text: str) -> set[tuple[str, str]]:
    words = [w.lower() for w in _WORD.findall(text)]
    return set(zip(words, words[1:]))


def units(text: str) -> Iterator[tuple[str, int, str]]:
    """Kind, number and text of every unit; a unit equal to a larger one is left to that."""
    yield "text", 0, text
    blocks = _BLANK.split(text)
    if len(blocks) > 1:
        yield from (("block", k, b) for k, b in enumerate(blocks))
    lines = text.split("\n")
    if len(lines) > 1:
        yield from (("line", k, x) for k, x in enumerate(lines))
    for k, line in enumerate(lines):
        sentences = _SENTENCE.sub("\\1\n", line).split("\n")
        if len(sentences) > 1:
            yield from (("sentence", k, s) for s in sentences)


class Scanner:
    """Templates by their bigrams; ``best`` finds the template nearest to a unit."""

    def __init__(
        self,
        templates: dict[str, list[str]],
        threshold: int,
        bodies: dict[str, list[str]] | None = None,
    ):
        self.threshold = threshold
        self.sets = [(name, bigrams(t)) for name in sorted(templates) for t in templates[name]]
        self.known = frozenset().union(*(b for _, b in self.sets))
        sizes = [len(b) for _, b in self.sets]
        # Dice is at most 2 * smaller / (smaller + larger): sizes beyond these bounds cannot reach it.
        self.bounds = [
            (-(-n * threshold // (200 - threshold)), n * (200 - threshold) // threshold)
            for n in sizes
        ]
        # For windows: bigrams to share at least, most bigrams of a window, name and bigrams.
        whole = self.sets + [(n, bigrams(t)) for n, texts in (bodies or {}).items() for t in texts]
        self.wanted = sorted(
            (
                (-(-len(b) * threshold // 100), len(b) * (200 - threshold) // threshold, n, b)
                for n, b in whole
            ),
            key=lambda x: (x[0], x[2]),
        )
        self.known_whole = frozenset().union(*(b for _, b in whole))
        self.least, self.most = min(b[0] for b in self.bounds), max(b[1] for b in self.bounds)

    def best(self, unit: str) -> tuple[float, str] | None:
        words = _WORD.findall(unit)
        if len(words) <= self.least:
            return None
        low = [w.lower() for w in words]
        pairs = set(zip(low, low[1:]))
        if not self.least <= len(pairs) <= self.most:
            return None
        shared = pairs & self.known
        if 200 * len(shared) < self.threshold * (len(shared) + self.least):
            return None
        found = None
        for (name, template), (least, most) in zip(self.sets, self.bounds, strict=True):
            if least <= len(pairs) <= most:
                common, total = len(shared & template), len(pairs) + len(template)
                if 200 * common >= self.threshold * total:
                    dice = 2 * common / total
                    if found is None or dice > found[0]:
                        found = dice, name
        return found

    def scan(self, text: str) -> dict[str, tuple[float, str, int]]:
        """Best unit for each licence found: Dice coefficient, kind and number of the unit."""
        found: dict[str, tuple[float, str, int]] = {}
        for kind, number, unit in units(text):
            hit = self.best(unit)
            if hit and (hit[1] not in found or hit[0] > found[hit[1]][0]):
                found[hit[1]] = hit[0], kind, number
        return found

    def windows(self, text: str) -> dict[str, tuple[float, int]]:
        """Best window for each licence: Dice coefficient, and number of its first word."""
        low = [w.lower() for w in _WORD.findall(text)]
        shared = self.known_whole.intersection(zip(low, low[1:]))
        likely = []
        for need, most, name, template in self.wanted:
            if need > len(shared):
                break
            if len(shared & template) >= need:
                likely.append((most, name, template))
        if not likely:
            return {}
        pairs = list(zip(low, low[1:]))
        last, before = {}, []
        for k, pair in enumerate(pairs):
            before.append(last.get(pair, -1))
            last[pair] = k
        before = np.array(before)
        candidates = []
        for most, name, template in likely:
            hits = np.fromiter((p in template for p in pairs), bool, len(pairs))
            n = len(template)
            for start in np.flatnonzero(hits).tolist():
                width = 2 * most + 16
                while True:
                    # A bigram counts where it stands first in the window.
                    new = before[start : start + width] < start
                    sizes = np.cumsum(new)
                    if sizes[-1] > most or start + width >= len(pairs):
                        break
                    width *= 2
                common = np.cumsum(new & hits[start : start + width])
                total = n + np.maximum(sizes, n)
                k = int(np.argmax(common / total))
                if 200 * common[k] >= self.threshold * total[k]:
                    dice = float(2 * common[k] / total[k])
                    candidates.append((-int(common[k]), -dice, name, start, start + k + 1))
        found: dict[str, tuple[float, int]] = {}
        taken = bytearray(len(pairs))
        for _, dice, name, start, end in sorted(candidates):
            if 1 not in taken[start:end]:
                taken[start:end] = b"\1" * (end - start)
                if name not in found or -dice > found[name][0]:
                    found[name] = -dice, start
        return found

    def find(self, text: str) -> dict[str, tuple[float, str, int]]:
        """What units give, and further licences that windows give, by the line they start in."""
        found = self.scan(text)
        for name, (dice, word) in self.windows(text).items():
            if name not in found:
                at = next(islice(_WORD.finditer(text), word, None)).start()
                found[name] = dice, "window", text.count("\n", 0, at)
        return found


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, list[str]] = TEMPLATES,
    threshold: int = THRESHOLD,
    bodies: dict[str, list[str]] = BODIES,
) -> DataFrame:
    """A row for each document and licence found: ``doc_id``, ``license``, ``dice``, and the
    ``unit`` and ``position`` (number of the line or block) where it matches best. ``bodies`` are
    further templates, for windows alone."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold, bodies)
        for batch in batches:
            for part in slices(batch, "_text"):
                keys, hits = [], []
                for k, text in enumerate(part.column("_text").to_pylist()):
                    for name, (dice, unit, number) in sorted(scanner.find(text).items()):
                        keys.append(k)
                        hits.append((name, dice, unit, number))
                columns = list(zip(*hits, strict=True)) or [(), (), (), ()]
                kinds = [pa.string(), pa.float64(), pa.string(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(keys, pa.int64()))]
                    + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["doc_id", "license", "dice", "unit", "position"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, license string, dice double, unit string, position int")
