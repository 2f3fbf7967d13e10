"""Operator 6: license notices in documents, retrieved by MinHash bands of windows and verified by containment."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm.common import Words, gram_codes, mixed, ship, slices

# Customary notices of public licenses.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Words of a shingle that is hashed, and of one that verifies.
HASHED, VERIFIED = 2, 5
#: Share of a notice's verifying shingles that a document must hold in one place.
CONTAINMENT = 0.8
#: Words of the smallest half window.
HALF = 8
#: A notice with at least CONTAINMENT of its words unchanged in a window at most four times as long collides with
#: this probability in some band (of one row, as the similarity is low).
RECALL = 0.99999


def bands(similarity: float = 0.2, recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity))


def verifying(codes: np.ndarray) -> np.ndarray:
    if len(codes) >= VERIFIED:
        return gram_codes(codes, VERIFIED)
    return mixed(gram_codes(codes, len(codes)) + np.uint64(len(codes)))


class Templates:
    """MinHash values of all notices, by the half window in which the notice fits."""

    def __init__(self, notices: tuple[tuple[str, str], ...]) -> None:
        self.factors = mixed(np.arange(1, bands() + 1, dtype=np.uint64)) | np.uint64(1)
        self.names, self.sizes, self.sets, self.halves, self.values = [], [], [], [], []
        for name, text in notices:
            codes = Words(pa.array([text]), plain=True).codes
            if len(codes) < HASHED:
                continue
            self.names.append(name)
            self.sizes.append(len(codes))
            self.sets.append(np.unique(verifying(codes)))
            self.halves.append(HALF * 2 ** max(0, math.ceil(math.log2(len(codes) / HALF))))
            grams = gram_codes(codes, HASHED)
            self.values.append([(grams * f).min() for f in self.factors])
        self.levels = sorted(set(self.halves))

    def found(self, words: Words) -> list[tuple[int, str, int, float]]:
        """Text, license, first word of the window and containment of all verified notices, the best for each."""
        codes = words.codes
        if len(codes) < HASHED:
            return []
        grams = gram_codes(codes, HASHED)
        best: dict[tuple[int, str], tuple[float, int]] = {}
        minima, starts, owner = [], None, None
        for half in self.levels:
            # Halves of each text; a window is a half and the next one of the same text.
            many = -(-words.count // half)
            owner = np.repeat(np.arange(len(many)), many)
            inner = (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * half
            starts = words.firsts[owner] + inner
            if not minima:
                cut = np.minimum(starts, len(grams) - 1)
                minima = [np.minimum.reduceat(grams * f, cut) for f in self.factors]
            else:
                fine_starts = np.searchsorted(fine, starts)
                minima = [np.minimum.reduceat(m, fine_starts) for m in minima]
            fine = starts
            follows = np.append(owner[1:] == owner[:-1], False)
            mine = [t for t, h in enumerate(self.halves) if h == half]
            for t in mine:
                hit = np.zeros(len(starts), bool)
                for m, value in zip(minima, self.values[t]):
                    own = m == value
                    hit |= own
                    hit[:-1] |= own[1:] & follows[:-1]
                for w in np.flatnonzero(hit):
                    # Notices may reach a word into what lies around because shingles do.
                    stop = min(words.firsts[owner[w] + 1], starts[w] + 2 * half)
                    here = codes[starts[w] : stop]
                    have = gram_codes(here, VERIFIED) if self.sizes[t] >= VERIFIED else mixed(gram_codes(here, self.sizes[t]) + np.uint64(self.sizes[t]))
                    share = float(np.isin(self.sets[t], have).mean())
                    key = (int(owner[w]), self.names[t])
                    if share >= CONTAINMENT:
                        best[key] = max(best.get(key, (0.0, 0)), (share, -int(inner[w])))
        return [(text, name, -first, share) for (text, name), (share, first) in sorted(best.items())]


def license_notices(documents: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """All licenses whose notices documents hold: doc_id, license, first_word (of the window), containment.

    Every document is cut into overlapping windows, twice as long as the notices looked for (in steps of powers of two),
    so that some window holds each notice whole. Windows that share a MinHash value with a notice are compared with it
    exactly: CONTAINMENT of its 5-word shingles (of a shorter notice, all words) must lie in the window. Words are
    compared in lower case and without marks. One pass without a shuffle; the templates are a fixed small list. Null, empty
    and wordless texts hold nothing; rows are judged one by one, null and repeated ids too; other columns are not read.
    """
    ship(documents.sparkSession)
    templates = Templates(notices)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                found = templates.found(Words(batch.column(1).slice(start, stop - start), plain=True))
                if found:
                    text, name, first, share = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, stop - start).take(pa.array(text)), pa.array(name),
                         pa.array(first, pa.int64()), pa.array(share)], ["doc_id", "license", "first_word", "containment"])

    return documents.select("doc_id", "text").mapInArrow(scan, "doc_id long, license string, first_word long, containment double")


def op6_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    return license_notices(spark.read.parquet(f"{folder}/documents.parquet"))
