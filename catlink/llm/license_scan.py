"""License scans (operator 4), in DataFrame functions only.

Words are the runs between ASCII characters other than letters and digits, after lower-casing.
Texts and templates are compared by their five-word shingles.  For a template of s shingles, texts are
read in overlapping windows of 2 s shingles at steps of s, so every run of s shingles lies in one.

* *Retrieval.*  ``BANDS`` MinHash bands of one row: a window and a template meet if the smallest hash of
  their shingles is equal under one of the bands' hash functions.  A window that holds the share
  c = 0.8 of a template has a Jaccard similarity of at least 0.8 s / (2 s + 0.2 s) = 0.36, so 24
  bands miss it with probability 0.64 ** 24 < 0.00003, and a verbatim copy (0.5) with 0.5 ** 24.
  A meeting needs a template's shingle, so documents and windows without any are left out before
  signatures are made; this loses nothing.
* *Verification.*  The window must hold ``containment`` of the template's distinct shingles, compared as
  words, not hashes.

The templates are a list that the caller gives or the fixed one here (notices, and the texts of short
licenses; for long ones the notice that files carry).  Their hashes are one array in the plan and their band
table is broadcast: some hundred kilobytes for a thousand templates, whatever the documents.  Documents are
never shuffled before the final aggregate of matches.

For a template of few shingles the bands amount to a look-up of its shingles: a window of one shingle has
that one as its minimum in every band.

Cases: ids may be of any type; null and empty texts, and texts of fewer than five words, match nothing; templates have five
words at least; rows with equal ids are reported together; a very long text is one row, held whole by
one task; an empty table gives an empty result; other columns of the input are ignored, whatever their
names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE, BANDS = 5, 24
#: Everything in ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
#: Notices and texts by SPDX identifier, and what they are where there are several.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Apache-2.0/notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the "
        "License."
    ),
    "AGPL-3.0/notice": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    "BSD-2-Clause/text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS "
        "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "BSD-3-Clause/text": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce "
        "the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written "
        "permission."
    ),
    "BSL-1.0/text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
        "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to "
        "whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, "
        "this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such "
        "copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0/notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0/notice": "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    "GPL-3.0/notice": "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "LGPL-2.1/notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    "LGPL-3.0/notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    "MIT/licensed": "This project is licensed under the MIT License",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE."
    ),
    "MPL-2.0/notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense/text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either "
        "in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib/text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this "
        "software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to "
        "the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. 2. Altered source versions "
        "must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
}


def words(text: Column) -> Column:
    """Lower-cased words of a text."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), SEPARATORS, " "), " "), lambda w: w != "")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where the optimiser moves the expression."""
    return F.get(F.transform(F.array(value), use), 0)


def _hashes(tokens: Column) -> Column:
    """Hash of each shingle, by position."""
    n = F.size(tokens) - SHINGLE
    at = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(SHINGLE)]))


def _shingles(tokens: Column) -> Column:
    """The shingles themselves, distinct."""
    at = F.sequence(F.lit(1), F.greatest(F.size(tokens) - SHINGLE + 1, F.lit(1)))
    return F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(tokens, i, F.lit(SHINGLE)), " ")))


def _signature(hashes: Column) -> Column:
    """(band, smallest hash) for each band."""
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    return F.transform(bands, lambda b: F.struct(b.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))).alias("low")))


def _windows(s: int, any_of: Column) -> Column:
    """Windows of 2 s shingles at steps of s that hold one of the given shingles."""

    def held(at: Column) -> Column:
        return F.slice("x.h", at + 1, F.lit(2 * s))

    starts = F.filter(F.sequence(F.lit(0), F.size("x.h") - 1, F.lit(s)), lambda at: F.arrays_overlap(held(at), any_of))
    return F.transform(
        starts, lambda at: F.struct(F.lit(s).alias("s"), at.alias("at"), _signature(held(at)).alias("signature"), F.slice("x.t", at + 1, F.lit(2 * s + SHINGLE - 1)).alias("words"))
    )


def _table_of(hashes: set[int]) -> Column:
    """The hashes as one array, folded from one string, however many there are."""
    return F.split(F.lit(",".join(map(str, sorted(hashes)))), ",").cast("array<bigint>")


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", *, containment: float = 0.8) -> DataFrame:
    """Returns (id, license, containment, first_word) for each document and license it holds: the best window of its templates, the first of equals.

    templates: texts by license identifier; what follows a slash tells several templates of one license apart.
    """
    spark = docs.sparkSession
    listed = sorted((templates or TEMPLATES).items())
    given = F.from_json(F.lit(json.dumps([{"license": k.split("/")[0], "notice": t} for k, t in listed])), "array<struct<license string, notice string>>")
    known = spark.range(1).select(F.explode(given).alias("x")).select("x.*").withColumn("tokens", words(F.col("notice")))
    known = known.withColumn("h", F.array_distinct(_hashes(F.col("tokens")))).withColumn("own", _shingles(F.col("tokens"))).withColumn("s", F.size("own"))
    # as many rows as there are templates, each of a fixed size
    held = known.select("s", "h").collect()
    if any(len(r["h"]) == 0 for r in held):
        raise ValueError(f"templates have {SHINGLE} words at least")

    own = docs.select(F.col(id_col).alias("_i"), _bind(words(F.col(text_col)), lambda t: F.struct(t.alias("t"), _hashes(t).alias("h"))).alias("x"))
    own = own.filter(F.arrays_overlap("x.h", _table_of({x for r in held for x in r["h"]})))
    sizes = [_windows(s, _table_of({x for r in held if r["s"] == s for x in r["h"]})) for s in sorted({r["s"] for r in held})]
    windows = own.select("_i", F.explode(F.concat(*sizes)).alias("w")).select("_i", "w.*")
    meeting = windows.select("_i", "s", "at", "words", F.explode("signature").alias("b")).select("_i", "s", "at", "words", "b.band", "b.low")
    table = known.select("license", "s", "own", F.explode(_signature(F.col("h"))).alias("b")).select("license", "s", "own", "b.band", "b.low")
    met = meeting.join(F.broadcast(table), ["s", "band", "low"])
    share = F.size(F.array_intersect(_shingles(F.col("words")), F.col("own"))) / F.col("s")
    # equal matches of several bands fall together in the aggregate
    best = met.select("_i", "license", share.alias("share"), "at").filter(F.col("share") >= containment)
    best = best.groupBy("_i", "license").agg(F.max(F.struct("share", (-F.col("at")).alias("before"))).alias("x"))
    return best.select(F.col("_i").alias(id_col), "license", F.col("x.share").alias("containment"), (-F.col("x.before")).cast("long").alias("first_word"))
