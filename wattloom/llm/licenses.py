"""License scans: sparse TF-IDF cosine of lines and licence files to templates, then inheritance along directories."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statements by which files name their licence; a caller may give others.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
}
_GNU = ("{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
        "Free Software Foundation, either version {version} of the License, or (at your option) any later version")
#: Standard headers, and what whole licence texts hold, beside the statements; the relatives of a licence are there to be told apart.
HEADERS = {
    "AGPL-3.0": [_GNU.format(what="This program", name="Affero General Public License", version="3"),
                 "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International Public License",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "GPL-2.0": [_GNU.format(what="This program", name="General Public License", version="2"),
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": [_GNU.format(what="This program", name="General Public License", version="3"),
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1": [_GNU.format(what="This library", name="Lesser General Public License", version="2.1"),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": [_GNU.format(what="This library", name="Lesser General Public License", version="3"),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "Mozilla Public License Version 2.0 1. Definitions"],
}
TEMPLATES = {n: [*([TEMPLATES[n]] if n in TEMPLATES else []), *HEADERS.get(n, [])] for n in sorted({*TEMPLATES, *HEADERS})}
LICENSE_FILE = r"(?i)^(?:licen[cs]e|copying|notice)(?:[.-][a-z0-9.-]*)?$"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class _Space:
    """Vectors over the templates' terms; any other word is a term of its own with the largest weight."""

    def __init__(self, templates: dict[str, str | list[str]]):
        texts = [(n, t) for n in sorted(templates) for t in ([templates[n]] if isinstance(templates[n], str) else templates[n])]
        self.names = [n for n, _ in texts]
        words = [self.words(t.encode()) for _, t in texts]
        self.lengths = [len(w) for w in words]
        self.terms = {w: i for i, w in enumerate(sorted({x for w in words for x in w}))}
        self.tf = np.zeros((len(self.names), len(self.terms)))
        for row, w in zip(self.tf, words):
            for x in w:
                row[self.terms[x]] += 1

    @staticmethod
    def words(raw: bytes) -> list[bytes]:
        return _WORD.findall(raw.lower())

    def counts(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Term counts of each segment, and its number of other words."""
        words = [self.words(s) for s in segments]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter((self.terms.get(w, -1) for ws in words for w in ws), np.int64, int(sizes.sum()))
        row = np.repeat(np.arange(len(words)), sizes)
        n = len(self.terms)
        inside = at >= 0
        tf = np.bincount(row[inside] * n + at[inside], minlength=len(words) * n).reshape(len(words), n)
        return tf, sizes - tf.sum(axis=1)

    def cosines(self, tf: np.ndarray, others: np.ndarray, idf: np.ndarray, most: float) -> np.ndarray:
        w, t = tf * idf, self.tf * idf
        length = np.sqrt((w * w).sum(axis=1) + others * most * most)
        return (w @ t.T) / np.maximum(length, 1e-12)[:, None] / np.sqrt((t * t).sum(axis=1))[None, :]

    def runs(self, raw: bytes, idf: np.ndarray, most: float, least: float, present: np.ndarray) -> np.ndarray:
        """Best cosine of a text's runs of words, each as long as the template; 0 where none reaches ``least``.

        ``present`` tells which terms the text has.  A bound on them rules out
        most templates, and one on sums over runs most places: both hold for sure.
        """
        t, out = self.tf * idf, np.zeros(len(self.names))
        length = np.sqrt((t * t).sum(axis=1))
        able = np.flatnonzero(np.sqrt((t * t * present).sum(axis=1)) >= (least - 1e-9) * length)
        if not len(able):
            return out
        words = self.words(raw)
        at = np.fromiter((self.terms.get(w, -1) for w in words), np.int64, len(words))
        weight = np.where(at >= 0, idf[at], most)
        squares = np.concatenate([[0], np.cumsum(weight * weight)])
        for k in able:
            n = min(self.lengths[k], len(words))
            dots = np.concatenate([[0], np.cumsum(np.where(at >= 0, t[k][at] * idf[at], 0))])
            dot = dots[n:] - dots[:-n]
            bound = dot / np.sqrt(np.maximum(squares[n:] - squares[:-n], 1e-12)) / length[k]
            for i in np.flatnonzero(bound >= least - 1e-6):
                own = at[i:i + n]
                tf = np.bincount(own[own >= 0], minlength=len(self.terms)) * idf
                norm = np.sqrt((tf * tf).sum() + (own < 0).sum() * most * most)
                out[k] = max(out[k], tf @ t[k] / norm / length[k])
        return np.where(out >= least, out, 0)


def _segments(raw: bytes | None, whole: bool) -> list[bytes]:
    """Lines of a text, and the text itself where it is a licence file."""
    return [*(raw or b"").split(b"\n"), *([raw] if whole and raw else [])]


def _portions(batch, size: int = 1_000_000):
    """Row ranges of a batch with about ``size`` bytes of text."""
    lengths = [len(x.as_py() or "") for x in batch.column("text")]
    at = held = 0
    for i, n in enumerate(lengths):
        held += n
        if held >= size or i == len(lengths) - 1:
            yield at, i + 1
            at, held = i + 1, 0


def _texts(column) -> list:
    return [None if x is None else x.encode() for x in column.to_pylist()]


def _frequencies(space: _Space):
    """In how many segments each term stands; the last row counts the segments."""
    def run(batches):
        found, segments = np.zeros(len(space.terms), np.int64), 0
        for batch in batches:
            for at, to in _portions(batch):
                part = batch.slice(at, to - at)
                lines = [s for raw, whole in zip(_texts(part.column("text")), part.column("whole").to_pylist()) for s in _segments(raw, whole)]
                if lines:
                    tf, _ = space.counts(lines)
                    found += (tf > 0).sum(axis=0)
                    segments += len(lines)
        values = [*found.tolist(), segments]
        yield pa.record_batch([pa.array(range(len(values)), pa.int32()), pa.array(values, pa.int64())], ["term", "n"])
    return run


def _best(space: _Space, idf: np.ndarray, most: float, least: float):
    """Each file's best template over its segments and its runs of words."""
    def run(batches):
        for batch in batches:
            for at, to in _portions(batch):
                part = batch.slice(at, to - at)
                names, scores = [], []
                for raw, whole in zip(_texts(part.column("text")), part.column("whole").to_pylist()):
                    tf, others = space.counts(_segments(raw, whole))
                    cosines = space.cosines(tf, others, idf, most).max(axis=0)
                    if raw:
                        cosines = np.maximum(cosines, space.runs(raw, idf, most, least, tf.any(axis=0)))
                    best = int(np.argmax(np.round(cosines, 9)))
                    names.append(space.names[best])
                    scores.append(float(cosines[best]))
                yield pa.record_batch([part.column("doc_id"), part.column("path"), part.column("whole"), pa.array(names, pa.string()),
                                       pa.array(scores, pa.float64())], ["doc_id", "path", "whole", "template", "score"])
    return run


def directory(path: Column) -> Column:
    """Directory of a path, empty at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """A directory, its parents, and the top, as ``(folder, depth)``."""
    parts = F.filter(F.split(folder, "/"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        F.array_join(F.slice(parts, F.lit(1), i), "/").alias("folder"), i.alias("depth")))


def scan_licenses(files: DataFrame, *, templates: dict[str, str | list[str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """The licence each file states, or inherits from the nearest directory above that has one.

    ``files``: ``doc_id``, ``path``, ``text``.  Every line of a text, the
    whole text of a licence file (by its name), and every run of words as long
    as a template, across lines and within one, is compared with the
    ``templates`` (a text or several for a licence): cosine of term counts weighted by inverse document
    frequency, counted over all lines and whole licence files.  Runs under
    ``least`` do not add to the score.  Words outside the
    templates count with the largest weight.  A file states the template with
    the largest cosine, by name where equal, if it is at least ``least``.

    A directory has the licence of its licence file with the largest cosine
    (then the first path).  A file without a statement takes the licence of
    its own directory or of the nearest one above.  Directories, not files,
    are joined with their ancestors, so a directory of many files asks once.

    Returns a row per row of ``files``: ``doc_id``, ``path``, ``stated``,
    ``score``, ``license`` and ``inherited_from`` (a directory, "" for the
    top, null if stated or none).  Null texts state nothing; a null path
    inherits nothing and is no licence file.  Repeated rows get equal results;
    other columns are not read; an empty table gives none.
    """
    context = files.sparkSession.sparkContext
    space = _Space(templates)
    files = files.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string"),
                         F.coalesce(F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENSE_FILE), F.lit(False)).alias("whole"))
    counted = files.select("text", "whole").mapInArrow(_frequencies(space), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = dict(counted.collect())  # one row per template term
    total = found.get(len(space.terms), 0)
    most = float(np.log(1 + total))
    idf = np.array([np.log((1 + total) / (1 + found.get(i, 0))) + 1e-3 for i in range(len(space.terms))])
    scored = files.mapInArrow(_best(space, idf, most + 1e-3, least), "doc_id long, path string, whole boolean, template string, score double")
    scored = scored.withColumn("stated", F.when(F.col("score") >= least, F.col("template"))).withColumn("folder", _normal(directory(F.col("path"))))

    licensed = scored.where("whole and stated is not null").groupBy("folder").agg(
        F.min_by("stated", F.struct(-F.col("score"), F.col("path"))).alias("license"))
    asked = scored.where("stated is null and folder is not null").select("folder").distinct() \
        .select("folder", F.explode(ancestors(F.col("folder"))).alias("a"))
    nearest = asked.join(licensed.toDF("above", "license"), F.col("a.folder") == F.col("above")).groupBy("folder").agg(
        F.max_by(F.struct("license", "above"), F.col("a.depth")).alias("near"))
    out = scored.join(nearest, "folder", "left")
    inherits = F.col("stated").isNull() & F.col("near").isNotNull()
    return out.select("doc_id", "path", "stated", "score", F.when(inherits, F.col("near.license")).otherwise(F.col("stated")).alias("license"),
                      F.when(inherits, F.col("near.above")).alias("inherited_from"))


def _normal(folder: Column) -> Column:
    """A directory without empty parts."""
    return F.array_join(F.filter(F.split(folder, "/"), lambda x: x != ""), "/")
