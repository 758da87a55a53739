"""License texts inside documents: MinHash bands over overlapping windows, then exact containment.

Texts are sequences of shingles of five words, without case and punctuation. Templates are put into
classes by size: a class of size n has windows of 2n shingles, each next one n further, so a
template's whole text always lies in some window. A window that holds ``CONTAINED`` of a template has
at least a certain Jaccard similarity with it (``least_similarity``); the number of bands is the
smallest for which such a window shares a band with the template with probability ``CERTAINTY`` or
more. Windows without any template's shingle can share no band and get no signature. Windows and
templates that share a band are compared shingle by shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import texts
from smeltery.llm.words import Terms, hashes_of, plain_words, words_of

SHINGLE = 5
CONTAINED = 0.8
CERTAINTY = 1 - 1e-6
ROWS = 1  # of a band

# Customary notices and headers of licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
)


def least_similarity(template: int, window: int, contained: float = CONTAINED) -> float:
    """Jaccard similarity of a window that holds just ``contained`` of a template, both without repeats."""
    held = math.ceil(contained * template)
    return held / (window + template - held)


def bands_for(similarity: float, rows: int = ROWS, certainty: float = CERTAINTY) -> int:
    """The fewest bands that sets of this similarity share one of with the certainty asked for."""
    if similarity >= 1:
        return 1
    return math.ceil(math.log(1 - certainty) / math.log(1 - similarity**rows))


class _Class:
    """Templates of one size, with their bands."""

    def __init__(self, step: int, members: list[tuple[str, np.ndarray]]) -> None:
        self.step, self.window, self.members = step, 2 * step, members
        least = min(least_similarity(len(s), self.window) for _, s in members)
        self.bands = bands_for(least)
        seeds = np.random.default_rng(step).integers(1, 2**63, self.bands * ROWS, dtype=np.uint64)
        self.seeds = seeds[:, None]
        self.places: dict[tuple, set[int]] = {}
        for number, (_, shingles) in enumerate(members):
            for band in self.signature(shingles):
                self.places.setdefault(band, set()).add(number)
        self.shingles = np.unique(np.concatenate([s for _, s in members]))

    def signature(self, shingles: np.ndarray) -> list[tuple]:
        least = texts.mixed(shingles[None, :] ^ self.seeds).min(axis=1).reshape(self.bands, ROWS)
        return [(i, *row) for i, row in enumerate(least.tolist())]

    def matches(self, shingles: np.ndarray) -> Iterator[tuple[int, float]]:
        """Templates that a window contains, and the share of their shingles that it holds."""
        own = np.unique(shingles)
        for number in sorted(set().union(*(self.places.get(b, ()) for b in self.signature(own)))):
            wanted = self.members[number][1]
            held = np.isin(wanted, own, assume_unique=True).mean()
            if held >= CONTAINED:
                yield number, float(held)


def classes_of(templates) -> list[_Class]:
    by_step: dict[int, list] = {}
    for name, text in templates:
        shingles = np.unique(texts.rolling(hashes_of(plain_words(text)), SHINGLE))
        if not len(shingles):
            raise ValueError(f"a template of {name} has fewer than {SHINGLE} words")
        by_step.setdefault(1 << (len(shingles) - 1).bit_length(), []).append((name, shingles))
    return [_Class(step, members) for step, members in sorted(by_step.items())]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """``key, license, containment, first_word, windows`` for each row of ``docs`` and license it holds.

    ``containment`` is the largest over the license's templates and the document's windows,
    ``first_word`` the start of the first such window, ``windows`` the number of windows that match.
    Null texts and texts of fewer than five words hold none. Repeated rows give repeated results; an
    empty table gives an empty table. The templates go with the tasks.
    """
    classes = classes_of(templates)
    known = [Terms.of(c.shingles) for c in classes]
    names = [key, "license", "containment", "first_word", "windows"]

    def scan(batch: pa.RecordBatch) -> Iterator[tuple]:
        words, first = words_of(batch.column(1))
        shingles = texts.rolling(words, SHINGLE)
        found: dict[tuple[int, str], list] = {}
        for group, terms in zip(classes, known):
            places, _ = terms.find(shingles)
            doc = np.searchsorted(first, places, "right") - 1
            inside = places + SHINGLE <= first[doc + 1]
            places, doc = places[inside], doc[inside]
            at = (places - first[doc]) // group.step
            wanted = np.unique(np.stack((np.tile(doc, 2), np.concatenate((at, np.maximum(at - 1, 0)))), axis=1), axis=0)
            for d, number in wanted.tolist():
                start = int(first[d]) + number * group.step
                end = min(start + group.window, int(first[d + 1]) - SHINGLE + 1)
                for template, held in group.matches(shingles[start:end]):
                    seen = found.setdefault((d, group.members[template][0]), [0.0, number * group.step, 0])
                    seen[0] = max(seen[0], held)
                    seen[1] = min(seen[1], number * group.step)
                    seen[2] += 1
        for (d, name), row in sorted(found.items()):
            yield batch.column(0)[d].as_py(), name, *row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = [row for batch in texts.groups(whole, "text") for row in scan(batch)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, license string, containment double, first_word bigint, windows bigint")
