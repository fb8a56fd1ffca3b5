"""Licence scans: TF-IDF cosine of lines and whole files to templates, then inheritance by directory.

Every line of a text, and the text as a whole, is compared with every template. A unit's vector has a
weight (count times inverse line frequency) for each of its terms; terms that no template has only count
for its length, at the weight of a term seen once, so only the templates' terms need corpus counts and
the table that is sent to the tasks is as small as the templates. A file's own licence is the best match
that reaches the threshold.

A file without a licence of its own takes that of the nearest directory above it whose licence file has
one. Directories, not files, are joined with their ancestors, so a directory with any number of files is
one row there.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import bundled, texts
from gristmill.session import Scope

THRESHOLD = 0.6
# Files whose licence holds for their directory and all below.
LICENCE_FILE = r"(?i)^(un)?licen[sc]e|^copying|^notice"

# The wording of licence notices, by SPDX identifier.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0 Universal.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "proprietary": ("All rights reserved.",),
}

_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_FOUND = "own_licence string, own_score double"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters and digits, A-Z in lower case."""
    return text.translate(_TERM).split()


class Matcher:
    """Template vectors over their own terms; ``weights[i]`` is the inverse line frequency of term i."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]]) -> None:
        self.names = [name for name, wordings in templates.items() for _ in wordings]
        split = [terms_of(text.encode()) for wordings in templates.values() for text in wordings]
        self.terms = {t: k for k, t in enumerate(sorted({t for own in split for t in own}))}
        self.counts = np.zeros((len(split), len(self.terms)))
        for row, own in enumerate(split):
            for t in own:
                self.counts[row, self.terms[t]] += 1

    def weighted(self, frequency: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Unit template vectors, term weights, and the weight of a term that no template has."""
        weights = np.log((lines + 1) / (frequency + 1)) + 1
        rows = self.counts * weights
        return rows / np.linalg.norm(rows, axis=1, keepdims=True), weights, float(np.log((lines + 1) / 2) + 1)


def _units(values: list[bytes], terms: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers (-1: in no template) of all lines, the line of each, and the document of each line."""
    get = terms.get
    numbers: list[int] = []
    sizes: list[int] = []
    owners: list[int] = []
    for row, value in enumerate(values):
        for line in value.split(b"\n"):
            own = line.translate(_TERM).split()
            if own:
                numbers += [get(t, -1) for t in own]
                sizes.append(len(own))
                owners.append(row)
    size = np.array(sizes, np.int64)
    return np.array(numbers, np.int64), np.repeat(np.arange(len(size)), size), np.array(owners, np.int64)


def line_frequencies(files: DataFrame, matcher: Matcher, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many lines of all files each template term occurs, and the number of lines."""
    size = len(matcher.terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for _, values in texts(batches):
            number, line, owners = _units(values, matcher.terms)
            known = number >= 0
            total[:size] += np.bincount(np.unique(line[known] * size + number[known]) % size, minlength=size)
            total[size] += len(owners)
        yield pa.RecordBatch.from_pydict({"term": pa.array(range(size + 1), pa.int32()), "n": pa.array(total)})

    rows = files.select(F.col(text_col).cast("string").alias("text")).mapInArrow(counted, "term int, n long")
    total = np.zeros(size + 1, np.int64)
    for term, n in rows.groupBy("term").agg(F.sum("n")).collect():
        total[term] = n
    return total[:size], int(total[size])


def cosines(number: np.ndarray, unit: np.ndarray, units: int, weighted: tuple) -> np.ndarray:
    """The cosine of every unit with every template."""
    vectors, weights, unseen = weighted
    size = len(weights)
    known = number >= 0
    cell, counts = np.unique(unit[known] * size + number[known], return_counts=True)
    of, term = np.divmod(cell, size)
    weight = counts * weights[term]
    square = np.bincount(of, weight**2, minlength=units) + unseen**2 * np.bincount(unit[~known], minlength=units)
    dots = np.stack([np.bincount(of, weight * vector[term], minlength=units) for vector in vectors], axis=1)
    return dots / np.sqrt(np.where(square > 0, square, 1))[:, None]


def match_licences(
    files: DataFrame,
    text_col: str = "text",
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``files`` with ``own_licence`` and ``own_score``; both null if no template reaches ``threshold``.

    Ties go to the first template. A null or empty text has no licence.
    """
    matcher = Matcher(templates)
    weighted = matcher.weighted(*line_frequencies(files, matcher, text_col))
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in files.schema if f.name != text_col)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, values in texts(batches, "__text"):
            number, line, owners = _units(values, matcher.terms)
            by_line = cosines(number, line, len(owners), weighted)
            whole = cosines(number, owners[line] if len(line) else line, len(values), weighted)
            np.maximum.at(whole, owners, by_line)
            best = whole.argmax(axis=1)
            score = whole[np.arange(len(values)), best]
            reached = score >= threshold
            names = [matcher.names[b] if ok else None for b, ok in zip(best, reached, strict=True)]
            keep = [k for k, name in enumerate(piece.schema.names) if name != "__text"]
            columns = [piece.column(k) for k in keep]
            scores = [float(s) if ok else None for s, ok in zip(score, reached, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*(piece.schema.names[k] for k in keep), "own_licence", "own_score"],
            )

    rows = files.withColumn("__text", F.col(text_col).cast("string")).drop(text_col)
    return rows.mapInArrow(matched, f"{fields}{', ' if fields else ''}{_FOUND}")


def parent(path: Column) -> Column:
    """The directory of a path; the root is the empty string."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def inherit(
    files: DataFrame, scope: Scope, path_col: str = "path", licence_file: str = LICENCE_FILE
) -> DataFrame:
    """``files`` with ``licence``, and ``inherited_from``: the directory it comes from, null if it is the file's own.

    ``files`` has ``own_licence`` and ``own_score``. Of several licence files in a directory the best score
    counts (ties: the smaller name). Without a path, or a licence above it, a file has only its own.
    """
    files = scope.stage(files.withColumn("__dir", parent(F.col(path_col))), "files")
    name = F.regexp_extract(F.col(path_col), "[^/]*$", 0)
    notices = files.filter(name.rlike(licence_file) & F.col("own_licence").isNotNull())
    ranked = notices.groupBy("__dir", "own_licence").agg(F.max("own_score").alias("own_score"))
    top = ranked.groupBy("__dir").agg(F.max("own_score").alias("own_score"))
    chosen = ranked.join(top, ["__dir", "own_score"]).groupBy("__dir").agg(F.min("own_licence").alias("licence"))
    chosen = chosen.withColumnRenamed("__dir", "ancestor")
    parts = F.split("__dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, F.lit(1), n)))
    every = F.array_distinct(F.concat(F.array(F.lit("")), above))
    directories = files.filter(F.col("__dir").isNotNull()).select("__dir").distinct()
    found = directories.withColumn("ancestor", F.explode(every)).join(chosen, "ancestor")
    nearest = found.groupBy("__dir").agg(
        F.max_by(F.struct("licence", "ancestor"), F.length("ancestor")).alias("__from")
    )
    joined = files.join(nearest, "__dir", "left")
    own = F.col("own_licence").isNotNull()
    return joined.withColumns(
        {
            "licence": F.coalesce("own_licence", "__from.licence"),
            "inherited_from": F.when(~own, F.col("__from.ancestor")),
        }
    ).drop("__dir", "__from")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text") -> tuple[DataFrame, Scope]:
    """``match_licences`` and ``inherit`` of ``(path, text)`` files.

    Other columns pass through, the text does not; one that bears the name of an added column is replaced.
    Rows that repeat are rows of their own.
    """
    scope = Scope(files.sparkSession)
    # Columns of the files travel in one, so that they may bear any name.
    own = files.select(F.col(path_col).alias("path"), F.col(text_col).alias("text"), bundled(files, text_col).alias("row"))
    found = inherit(match_licences(own), scope)
    added = ["own_licence", "own_score", "licence", "inherited_from"]
    passed = [F.col("row")[name].alias(name) for name in files.columns if name not in (text_col, *added)]
    return found.select(*passed, *added), scope
