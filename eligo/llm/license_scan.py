"""License scan by MinHash bands over overlapping text windows (DataFrame functions only).

Texts and templates become word shingles (five words) and their 64-bit hashes.  Window
sizes go by the templates': for each size class, windows of half as much again slide by a
quarter.  A window's band keys are minima of its shingles' hashes, rehashed for
each band; a template's are the same of its own shingles.  A band of one row
collides with probability J, the Jaccard similarity of window and template, so ``bands`` bands
miss one window with probability (1 - J) ** bands: a template held whole has J of 0.33 or more in some
window (miss 0.0016 at 16 bands), one that keeps 80 % of its shingles 0.25 (miss 0.01); most occurrences
lie in two windows.  Candidates are verified exactly: the share of the template's shingles
inside the window and its margins must reach ``min_containment``.

A band key of a window comes from one of its shingles; so a text without any
template shingle cannot collide and stops there, before any band is made, and of a text with some only the windows
that hold one are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import content_key, pick

#: Notices, headers and grants as their publishers word them.
TEMPLATES = {
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "AGPL-3.0-notice": "Licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice-2": "This project is licensed under the Apache License 2.0.",
    "BSD-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "BSD-2-Clause-conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "BSD-3-Clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice-2": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide."),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version."),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-2": "Licensed under the MIT License.",
    "MIT-notice-3": "This project is licensed under the MIT License.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense-grant": "This is free and unencumbered software released into the public domain.",
}
MAX_TEMPLATE_SHINGLES = 200_000
GATE_SHINGLES = 4_096


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also inside further lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, n: int) -> Column:
    """Hashes of the n-word shingles, in order; a text of fewer words, but not none, is one."""
    def hashes(w: Column) -> Column:
        last = F.greatest(F.size(w) - n + 1, F.lit(1))
        return F.when(F.size(w) > 0, F.transform(
            F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice(w, i, n), " "))))

    return _let(words, hashes)


def _band_keys(shingles: Column, bands: int) -> Column:
    """One minimum for each band, each under its own rehash."""
    return F.transform(F.lit(list(range(bands))),
                       lambda i: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, i))))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                 text_col: str = "text", shingle_words: int = 5, bands: int = 16,
                 min_containment: float = 0.8) -> DataFrame:
    """One row for each row of ``docs``: ``id_col, licenses, n_licenses, best_containment``.

    ``licenses`` are the names of the templates found, sorted; null and empty texts have none.
    Templates without a word are refused.  Repeated rows are scanned each.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    raw = (spark.createDataFrame(sorted(templates.items()), "name string, body string")
           .select("name", F.array_distinct(_shingles(_words(F.col("body")), shingle_words)).alias("sh")).collect())
    if any(not r.sh for r in raw) or sum(len(r.sh) for r in raw) > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"each template needs a word, all together at most {MAX_TEMPLATE_SHINGLES} shingles")
    src = pick(docs, id=id_col, text=text_col)
    # A text's id and content name its row in the join of the findings.
    named = F.struct(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
                     *[k.alias(f"k{i}") for i, k in enumerate(content_key(F.col("text")))])
    scanned = src.select(named.alias("row"), _shingles(_words(F.col("text")), shingle_words).alias("sh"))
    if not raw:
        return src.select(F.col("id").alias(id_col), F.array().cast("array<string>").alias("licenses"),
                          F.lit(0).alias("n_licenses"), F.lit(0.0).alias("best_containment"))
    classes = sorted({1 << (len(r.sh) - 1).bit_length() for r in raw})
    known = sorted({h for r in raw for h in r.sh})
    may = F.arrays_overlap("sh", F.lit(known)) if len(known) <= GATE_SHINGLES else F.col("sh").isNotNull()

    def windows(size: Column) -> Column:
        """(class, margin, keys) of each window of a class that holds a template's shingle."""
        width, step = size + F.shiftright(size + 1, 1), F.greatest(F.shiftright(size, 2), F.lit(1))
        last = F.floor((F.greatest(F.size("sh") - width + step, F.lit(1)) - 1) / step).cast("int")
        # window k begins at 1 + k step; position p is in those from (p - width) / step to (p - 1) / step
        at = F.array_distinct(F.flatten(F.transform("held", lambda p: F.sequence(
            F.least(F.greatest(F.ceil((p - width) / step).cast("int"), F.lit(0)), last),
            F.least(F.floor((p - 1) / step).cast("int"), last)))))
        return F.transform(at, lambda k: _let(k * step + 1, lambda s: F.struct(
            size.alias("size"), F.slice("sh", F.greatest(s - size, F.lit(1)), size * 4).alias("margin"),
            _let(F.slice("sh", s, width), lambda w: _band_keys(w, bands)).alias("keys"))))

    # Positions of shingles that a template has; any of them where there are too many templates for the gate.
    held = F.filter(F.sequence(F.lit(1), F.size("sh")), lambda i: F.array_contains(F.lit(known), F.get("sh", i - 1))) \
        if len(known) <= GATE_SHINGLES else F.sequence(F.lit(1), F.size("sh"))
    near = scanned.where(may).select("row", "sh", held.alias("held"))
    # A window carries its own margin and not the text: rows stay small however long the text is.
    cut = near.select("row", F.explode(F.flatten(F.transform(F.lit(classes), windows))).alias("w"))
    probe = cut.select("row", "w.size", "w.margin", F.posexplode("w.keys").alias("band", "key"))
    known_rows = spark.createDataFrame([(r.name, list(r.sh), 1 << (len(r.sh) - 1).bit_length()) for r in raw],
                                       "name string, tsh array<bigint>, size int")
    keys = known_rows.select("name", "tsh", "size", F.posexplode(_band_keys(F.col("tsh"), bands)).alias("band", "key"))
    # Broadcast: bounded by MAX_TEMPLATE_SHINGLES, checked above.
    hits = probe.join(F.broadcast(keys), ["size", "band", "key"])
    share = F.size(F.array_intersect(F.col("margin"), F.col("tsh"))) / F.size("tsh")
    found = (hits.select("row", "name", share.alias("share")).where(F.col("share") >= min_containment)
             .groupBy("row", "name").agg(F.max("share").alias("share"))
             .groupBy("row").agg(F.array_sort(F.collect_list("name")).alias("licenses"), F.max("share").alias("best")))
    return (src.select(named.alias("row"), "id")
            .join(found, "row", "left").select(
                F.col("id").alias(id_col), F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
                F.coalesce(F.size("licenses"), F.lit(0)).alias("n_licenses"),
                F.coalesce("best", F.lit(0.0)).alias("best_containment")))
