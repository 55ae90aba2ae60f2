"""Licence scans: TF-IDF cosine to templates, then inheritance along directories.

Two sorts of windows of a text are compared with the licence templates as
sparse TF-IDF vectors; a window of cosine >= ``threshold`` is a header. Every run
of as many terms as a template has, wherever lines end, is compared with that
template (a shorter text as a whole); and every line, alone and with the lines
after it up to the length of the longest template, with all of them. The header
stands on the line of the window's first term that the template has. Document
frequencies of template terms are counted over all texts; other terms weigh like
a term of no text. Windows without a telling term need no comparison: for each
template the terms of highest weight are telling until the rest alone can't reach
the threshold (Cauchy-Schwarz). Nor do runs whose cosine would be too small if no
term were repeated, which is an upper bound. So no such window is missed.

A file is a licence file if its path says so or its header stands on the first
line that isn't blank. Directories get the licence of their best licence file;
a file without a header inherits from its nearest ancestor directory that has
one, found by joining the distinct directories' ancestors. Directories are
grouped before joining, so that a hot directory is one row.

Null or empty text has no header; a null path has no directory. Ties go to the
smaller template name, line and path. Repeated rows each get their result. An
empty table gives an empty result. Input columns named like an output column
are replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

#: Short notices by which works name their licence.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}

LICENSE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
_WORD = re.compile(r"\w+(?:[-.]\w+)*")


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def template_terms() -> list[str]:
    return sorted({t for texts in TEMPLATES.values() for x in texts for t in terms(x)})


class Matcher:
    """Best template of the windows of a text."""

    def __init__(self, frequency: dict[str, int], n_docs: int, threshold: float):
        self.threshold = threshold
        self.idf = {t: math.log((n_docs + 1) / (frequency.get(t, 0) + 1)) + 1 for t in template_terms()}
        self.other = math.log(n_docs + 1) + 1
        self.templates, self.lengths, telling = [], [], set()
        for name in sorted(TEMPLATES):
            for text in TEMPLATES[name]:
                w = {t: c * self.idf[t] for t, c in Counter(terms(text)).items()}
                norm = math.sqrt(sum(v * v for v in w.values()))
                w = {t: v / norm for t, v in w.items()}
                self.templates.append((name, w))
                self.lengths.append(len(terms(text)))
                rest = 1.0
                for t, v in sorted(w.items(), key=lambda x: (-x[1], x[0])):
                    if rest < threshold ** 2 - 1e-9:
                        break
                    telling.add(t)
                    rest -= v * v
        self.telling = sorted(telling)
        self.longest = max(len(terms(x)) for texts in TEMPLATES.values() for x in texts)

    def cosine(self, window: list[str], templates=None) -> tuple[float, str, dict]:
        """Cosine, name and terms of the best template."""
        tf = Counter(window)
        w = {t: c * self.idf.get(t, self.other) for t, c in tf.items()}
        norm = math.sqrt(sum(v * v for v in w.values())) or 1.0
        best = (0.0, "", {})
        for name, tw in templates or self.templates:
            dot = sum(v * w[t] for t, v in tw.items() if t in w) / norm
            if dot > best[0] + 1e-12:
                best = dot, name, tw
        return best

    def runs(self, words: list[str]):
        """(start, length, template) of the runs that may reach the threshold."""
        weight = np.array([self.idf.get(t, self.other) for t in words])
        square = np.r_[0.0, np.cumsum(weight * weight)]
        at: dict[str, list[int]] = {}
        for k, t in enumerate(words):
            if t in self.idf:
                at.setdefault(t, []).append(k)
        for (name, tw), length in zip(self.templates, self.lengths, strict=True):
            if not any(t in at for t in tw):
                continue
            gain = np.zeros(len(words))
            for t, v in tw.items():
                if t in at:
                    gain[at[t]] = v * self.idf[t]
            n = min(length, len(words))
            gain = np.r_[0.0, np.cumsum(gain)]
            bound = (gain[n:] - gain[:-n]) / np.sqrt(square[n:] - square[:-n])
            for s in np.flatnonzero(bound >= self.threshold - 1e-6).tolist():
                yield s, n, (name, tw)

    def header(self, text: str) -> tuple[str, float, int, bool] | None:
        """(licence, cosine, line, on the first line that isn't blank) of the best window."""
        low = text.lower()
        if not any(t in low for t in self.telling):
            return None
        lines = text.split("\n")
        first = next((i for i, x in enumerate(lines) if x.strip()), 0)
        of_line = [terms(x) for x in lines]
        words = [t for x in of_line for t in x]
        line_of = [i for i, x in enumerate(of_line) for _ in x]
        starts = np.r_[0, np.cumsum([len(x) for x in of_line])].tolist()
        telling, best = set(self.telling), None
        near = [i for i, x in enumerate(of_line) if not telling.isdisjoint(x)]

        def compare(start, end, templates=None):
            nonlocal best
            score, name, tw = self.cosine(words[start:end], templates)
            if score >= self.threshold:
                line = line_of[next(k for k in range(start, end) if words[k] in tw)]
                key = -round(score, 12), name, line
                if best is None or key < best[0]:
                    best = key, (name, score, line, line == first)

        for s, n, template in self.runs(words) if near else ():
            compare(s, s + n, [template])
        for i in range(len(lines)):
            k = bisect_left(near, i)
            if k == len(near):
                break
            if near[k] > i and (not lines[i].strip() or starts[near[k]] - starts[i] >= self.longest):
                continue  # no window from here reaches a telling term
            j = i
            while True:
                if j >= near[k]:
                    compare(starts[i], starts[j + 1])
                j += 1
                if j >= len(lines) or starts[j] - starts[i] >= self.longest or not lines[j].strip():
                    break
        return best and best[1]


def headers(df: DataFrame, text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """``df`` with header_license, header_score, header_line and header_first (null: none)."""
    common.python_ready(df)
    text = common.text_of(f"`{text_col}`")

    @F.pandas_udf("array<string>")
    def known(texts):
        vocabulary = set(template_terms())
        return texts.map(lambda t: sorted(vocabulary.intersection(terms(t))))

    counted = (df.select(F.explode(known(text)).alias("t"))
               .groupBy("t").count().collect())  # at most a row per template term
    frequency, n = {r[0]: r[1] for r in counted}, df.count()

    @F.pandas_udf("struct<license:string,score:double,line:int,first:boolean>")
    def find(texts):
        import pandas as pd

        m = Matcher(frequency, n, threshold)
        found = [m.header(t) or (None, None, None, None) for t in texts]
        return pd.DataFrame({c: pd.array([x[k] for x in found], kind) for k, (c, kind) in enumerate(
            [("license", "string"), ("score", "Float64"), ("line", "Int32"), ("first", "boolean")])})

    out = common.with_replaced(df.withColumn("__h", find(text)), {
        "header_license": F.col("__h.license"), "header_score": F.col("__h.score"),
        "header_line": F.col("__h.line"), "header_first": F.col("__h.first")}, drop=("__h",))
    return out


def _directory(path):
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherit(found: DataFrame, path_col: str = "path") -> DataFrame:
    """``found`` (with headers) plus license, license_from ('header', the
    directory inherited from, or null) and license_distance (directories up)."""
    path = F.col(f"`{path_col}`")
    rows = found.withColumn("__dir", F.when(path.contains("/"), _directory(path))
                            .when(path.isNotNull(), F.lit("")))
    is_file = F.col("header_license").isNotNull() & (F.col("header_first") | path.rlike(LICENSE_NAME))
    own = (rows.filter(is_file & F.col("__dir").isNotNull()).groupBy("__dir")
           .agg(F.min(F.struct((-F.col("header_score")).alias("s"), path.alias("p"),
                               F.col("header_license").alias("l"))).getField("l").alias("__l"))
           .select(F.col("__dir").alias("__up"), "__l"))
    parts = F.split("__dir", "/")
    dirs = (rows.select("__dir").filter(F.col("__dir").isNotNull()).distinct()
            .withColumn("__k", F.explode(F.when(F.col("__dir") == "", F.array(F.lit(0)))
                                         .otherwise(F.sequence(F.lit(0), F.size(parts)))))
            .withColumn("__up", F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - F.col("__k"), F.lit(0))), "/")))
    nearest = (dirs.join(own, "__up").groupBy("__dir")
               .agg(F.min(F.struct("__k", "__up", "__l")).alias("__n")))
    joined = rows.join(nearest, "__dir", "left")
    has = F.col("header_license").isNotNull()
    return common.with_replaced(joined, {
        "license": F.when(has, F.col("header_license")).otherwise(F.col("__n.__l")),
        "license_from": F.when(has, F.lit("header")).otherwise(F.col("__n.__up")),
        "license_distance": F.when(has, F.lit(0)).otherwise(F.col("__n.__k"))}, drop=("__dir", "__n"))
