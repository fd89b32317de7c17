"""Licence scans: lines and texts against licence templates by Dice coefficient over word bigrams.

A text and each of its lines are normalised (A-Z to a-z, words are runs of a-z and 0-9) and
compared as sets of word bigrams: 2 * common / (size + size).  A coefficient of t or more
needs sizes within a factor (2 - t) / t of each other, so a line is compared only with
templates whose size passes these bounds, and most lines with none.  A word by itself has
no bigram; it is a set of its own, so one-word lines never match templates.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.common import add_columns

#: Notices by which common licences are applied, with their SPDX identifiers.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": ["Released under CC0 1.0 Universal, public domain dedication."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}

#: Dice coefficient from which a line or text is a licence notice.
THRESHOLD = 0.8

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
_WORD = np.frombuffer(_FOLD, np.uint8) != 32
_NEWLINE = 10


def bigrams(line: bytes) -> set:
    """Word bigrams of a line; a single word stands for itself."""
    words = line.translate(_FOLD).split()
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else set(words)


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Scanner:
    """Best template of each line whose number of words leaves a match possible."""

    def __init__(self, templates: dict[str, list[str]], threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold must lie in (0, 1]")
        self.threshold = threshold
        self.sets = sorted(
            (name, i, bigrams(text.encode())) for name, texts in templates.items() for i, text in enumerate(texts)
        )
        ratio = (2 - threshold) / threshold
        self.bounds = [
            (math.ceil(len(s) / ratio - 1e-9), math.floor(len(s) * ratio + 1e-9)) for _, _, s in self.sets
        ]
        # repeated bigrams make a line's words more than its bigrams, never fewer
        self.fewest = min((lo for lo, _ in self.bounds), default=1)
        self.starts = {w for _, _, s in self.sets for pair in s for w in pair}
        self.known: dict[bytes, tuple[str, float] | None] = {}

    def match(self, line: bytes) -> tuple[str, float] | None:
        """Name and coefficient of the best template from the threshold on; ties to the first name."""
        own = bigrams(line)
        best = None
        for (name, _, other), (lo, hi) in zip(self.sets, self.bounds, strict=True):
            if lo <= len(own) <= hi:
                score = dice(own, other)
                if score >= self.threshold and (best is None or score > best[1]):
                    best = (name, score)
        return best

    def scan(self, text: bytes) -> list[tuple[int, str, float]]:
        """Line number (0: the whole text), licence and coefficient of every match."""
        out = []
        lines = text.split(b"\n")
        for number, line in enumerate([text, *lines]) if len(lines) > 1 else enumerate(lines, 1):
            # a text without any common word with the templates has no common bigram
            if len(line) < 2 * self.fewest:
                continue
            found = self._cheap(line)
            if found is not None:
                out.append((number, *found))
        return out

    def _cheap(self, line: bytes) -> tuple[str, float] | None:
        words = line.translate(_FOLD).split()
        # distinct bigrams are no fewer than distinct words less one, and no more than words less one
        if len(words) - 1 < self.fewest:
            return None
        most = max(hi for _, hi in self.bounds)
        if len(words) - 1 > most and len(set(words)) - 1 > most:
            return None
        if len(self.starts.intersection(words)) < 2:
            return None
        return self.match(line)


def scan(
    df: DataFrame, text: str = "text", out: str = "licenses",
    templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """Append ``out``: an array of (line, license, dice) for every matching line of a text.

    Lines end at line feeds and count from 1; line 0 stands for a whole text of several
    lines.  Null and empty texts, and texts without a match, have an empty array.  Equal
    coefficients go to the first licence by name.  A column called ``out`` is replaced.
    Templates are a parameter of bounded size that goes to every task.
    """
    chosen = TEMPLATES if templates is None else templates
    kind = pa.list_(pa.struct([("line", pa.int64()), ("license", pa.string()), ("dice", pa.float64())]))

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        scanner = Scanner(chosen, threshold)
        rows: Iterable = pc.fill_null(columns[0].cast(pa.large_string()), "").cast(pa.large_binary())
        return [pa.array(
            [[{"line": n, "license": name, "dice": d} for n, name, d in scanner.scan(t.as_py())] for t in rows], kind
        )]

    return add_columns(df, [text], f"`{out}` array<struct<line: bigint, license: string, dice: double>>", work)


def oracle(templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> str:
    """The same scan over ``documents`` as DuckDB SQL: doc_id, line, license, dice."""
    chosen = TEMPLATES if templates is None else templates
    quoted = ", ".join(
        "('{}', {}, '{}')".format(name, i, text.replace("'", "''"))
        for name, texts in chosen.items() for i, text in enumerate(texts)
    )
    sets = (
        "CASE WHEN len({w}) > 1 THEN list_distinct([{w}[i] || ' ' || {w}[i + 1] FOR i IN range(1, len({w}))]) "
        "ELSE {w} END"
    )
    norm = "list_filter(string_split_regex(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""
WITH templates(name, nr, body) AS (VALUES {quoted}),
tw AS (SELECT name, nr, {norm.format(t='body')} AS w FROM templates),
ts AS (SELECT name, nr, {sets.format(w='w')} AS s FROM tw),
lines AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
  UNION ALL
  SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))),
lw AS (SELECT doc_id, line, {norm.format(t='t')} AS w FROM lines),
ls AS (SELECT doc_id, line, {sets.format(w='w')} AS s FROM lw WHERE len(w) > 0 AND len(list_distinct(w)) < 2000),
scored AS (
  SELECT doc_id, line, name AS license, nr,
    2 * len(list_intersect(ls.s, ts.s)) / CAST(len(ls.s) + len(ts.s) AS DOUBLE) AS dice
  FROM ls JOIN ts ON len(ls.s) <= {(2 - threshold) / threshold} * len(ts.s) + 1e-9
    AND len(ts.s) <= {(2 - threshold) / threshold} * len(ls.s) + 1e-9)
SELECT doc_id, line, license, round(dice, 6) AS dice FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license, nr) AS r
  FROM scored WHERE dice >= {threshold}) WHERE r = 1
"""
