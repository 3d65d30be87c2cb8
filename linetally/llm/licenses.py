"""License scan (native): text segments against license templates.

Segments are the lines of a text and its paragraphs of several lines (blank
lines divide paragraphs). A segment and a template are normalised alike (A-Z
lower-cased, every run of other characters than a-z and 0-9 one space) and
compared by the Dice coefficient of their sets of word bigrams,
``2 |A & B| / (|A| + |B|)``. It can reach the threshold ``t`` only if
``t / (2 - t) <= |A| / |B| <= (2 - t) / t``; a template outside these bounds is
not compared, and a segment too short for every template gets no bigrams.

One projection with an explode: no shuffle, no join; the templates are
literals (their number and length bound the expression).

Results for odd input: null and empty texts have no segments and so no
matches; segments of fewer than two words have no bigrams and never match;
repeated lines and rows match each time; among equally similar templates the
first in the list is named; very long lines and texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, lower_ascii, whole_text

THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    license: str
    text: str

    @property
    def bigrams(self) -> list[str]:
        w = re.sub(r"[^a-z0-9]+", " ", self.text.lower()).split()
        return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


_CLAUSES = (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
_GNU = (("GPL-2.0", "", "2"), ("LGPL-3.0", "Lesser", "3"), ("LGPL-2.1", "Lesser", "2.1"), ("AGPL-3.0", "Affero", "3"))

# Public license notices, in their usual wording.
TEMPLATES = (
    Template("MIT", "Released under the MIT License."),
    Template("MIT", "Licensed under the MIT License."),
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                    "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                    "furnished to do so, subject to the following conditions:"),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                           "except in compliance with the License. You may obtain a copy of the License at"),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                        "the License, or (at your option) any later version."),
    Template("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met:"),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0."),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Template("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("all-rights-reserved", "All rights reserved."),
    # variants of the above by clause and version, so that the nearest one is named
    *(Template(f"CC-{short}-{version.split()[0]}",
               f"This work is licensed under a Creative Commons {name} {version} License.")
      for version in ("4.0 International", "3.0 Unported") for short, name in _CLAUSES if (short, version[:3]) != ("BY", "4.0")),
    *(Template(f"CC-{short}-{version}", f"Licensed under CC {short} {version}.")
      for version in ("4.0", "3.0") for short, _ in _CLAUSES
      if version == "3.0" or short not in ("BY", "BY-SA", "BY-NC")),
    *(Template(spdx, f"This work is licensed under the GNU {name} General Public License, version {version}.")
      for spdx, name, version in _GNU),
    *(Template(spdx, f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU "
                     f"{name} General Public License as published by the Free Software Foundation, either version "
                     f"{version} of the License, or (at your option) any later version.")
      for spdx, name, version in _GNU
      for thing, mark in ((("program", ":"),) if name in ("", "Affero") else (("library", ";"), ("program", ":")))),
    # further licenses
    Template("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                           "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                           "or implied."),
    Template("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    Template("BSD", "Licensed under the BSD License."),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    Template("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    Template("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    Template("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    Template("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
                     "and to alter it and redistribute it freely, subject to the following restrictions:"),
    Template("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    Template("Unlicense", "This is free and unencumbered software released into the public domain."),
    Template("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                        "rights to this work."),
)


def bigrams(w: Column, least: int) -> Column:
    """Distinct bigrams of a word array (a plain column: it is read for every
    element); none if it has fewer words than ``least`` bigrams need."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)))
    return F.when(F.size(w) > F.lit(max(1, least)), F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def scan_licenses(docs: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row for each segment that is similar enough to a template: the
    columns of ``docs`` but ``text``, then ``kind`` (``line`` or
    ``paragraph``), ``segment`` (its 0-based number among its kind), ``license``,
    ``template`` (number in the list), ``dice`` and ``segment_text``. Input columns of these names
    are replaced."""
    made = ("kind", "segment", "segment_text", "license", "template", "dice")
    keep = [F.col(f"`{c}`") for c in carried(docs, (*made, text))]
    body = whole_text(text)
    lines = F.transform(F.split(body, "\n", -1),
                        lambda x, i: F.struct(F.lit("line").alias("kind"), i.alias("segment"), x.alias("t")))
    blocks = F.transform(F.split(body, r"\n[\x20\x09\x0D]*\n", -1),
                         lambda x, i: F.struct(F.lit("paragraph").alias("kind"), i.alias("segment"), x.alias("t")))
    blocks = F.filter(blocks, lambda x: F.contains(F.btrim(x["t"], F.lit("\n")), F.lit("\n")))
    rows = docs.select(*keep, F.explode(F.concat(lines, blocks)).alias("_s"))
    grams = [t.bigrams for t in templates]
    sizes = [len(g) for g in grams]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    norm = F.btrim(F.regexp_replace(lower_ascii(F.col("_s.t")), "[^a-z0-9]+", " "))
    rows = rows.withColumn("_w", F.split(norm, " "))
    # explode() of one value: later filters on it stay above, so it is computed once
    grams_of = bigrams(F.col("_w"), int(min(sizes, default=1) * low))
    rows = rows.select(*keep, "_s", F.explode(F.array(grams_of)).alias("_b"))
    size = F.size("_b")
    rows = rows.where((size >= min(sizes, default=1) * low) & (size <= max(sizes, default=0) * high))
    scored = []
    for i, g in enumerate(grams):
        if not g:
            continue
        shared = F.size(F.array_intersect(F.col("_b"), F.array(*[F.lit(x) for x in g])))
        dice = F.lit(2.0) * shared / (size + len(g))
        in_bounds = (size >= len(g) * low) & (size <= len(g) * high)
        scored.append(F.struct(F.when(in_bounds, dice).otherwise(F.lit(0.0)).alias("dice"), F.lit(-i).alias("order"),
                               F.lit(templates[i].license).alias("license")))
    best = F.array_max(F.array(*scored)) if scored else F.lit(None).cast("struct<dice:double,order:int,license:string>")
    rows = rows.select(*keep, "_s", F.explode(F.array(best)).alias("_best"))
    return rows.where(F.col("_best.dice") >= threshold).select(
        *keep, F.col("_s.kind").alias("kind"), F.col("_s.segment").cast("int").alias("segment"),
        F.col("_best.license").alias("license"), (-F.col("_best.order")).alias("template"),
        F.col("_best.dice").alias("dice"), F.col("_s.t").alias("segment_text"))
