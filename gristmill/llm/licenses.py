"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

Templates are the vocabulary and the collection that idf is taken from; a term of no template has the highest idf and
only lengthens a vector. A text's units are its whole, its paragraphs, lines and sentences. A file without a licence of
its own has that of the licence file in the nearest directory at or above its own, found by joins of paths. An SPDX tag
states its licence outright, with cosine 1; units that deny a licence ("not licensed under") grant none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gristmill.llm.common import columns_not_in, stored

MIN_COSINE = 0.75
#: Files of a directory are dealt over so many tasks when they get the directory's licence.
SALTS = 16
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|copyright|unlicense|notice)([.-][^/]*)?$"

#: Licence identifiers with the notices that grant them.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain worldwide under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    # heads of licence files, whose bodies are too long to hold here
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    # whole licence files
    ("MIT", """MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("ISC", """ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
]
_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_SENTENCE = re.compile(r"(?<=[.!?;])\s+|\s\|\s")
_PARAGRAPH = re.compile(r"\n\s*\n")
_SPDX = re.compile(r"(?i)spdx-license-identifier:[ \t]*(\(?[a-z0-9.+-]+(?:[ \t]+(?:and|or|with)[ \t]+\(?[a-z0-9.+-]+\)?)*)")
_DENIED = re.compile(r"(?i)\b(?:not|never|no longer|isn't|aren't|wasn't)\s+(?:\w+\s+){0,2}(?:licen[sc]ed|released|distributed|available|offered|covered|governed)\s+(?:under|by|as)\b")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Templates:
    """Sparse TF-IDF vectors of templates, by term; ``cosines`` compares a unit with those that share a telling term."""

    def __init__(self, templates: Sequence[tuple[str, str]], min_cosine: float = MIN_COSINE):
        counts = [Counter(terms(t)) for _, t in templates]
        df = Counter(t for c in counts for t in c)
        n = len(templates)
        self.names = [name for name, _ in templates]
        self.idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in df.items()}
        self.unknown = math.log(1 + n) + 1
        self.by_term: dict[str, list[tuple[int, float]]] = {}
        for i, c in enumerate(counts):
            v = {t: k * self.idf[t] for t, k in c.items()}
            length = math.sqrt(sum(x * x for x in v.values()))
            for t, x in v.items():
                self.by_term.setdefault(t, []).append((i, x / length))

        self.by_name = {name.lower(): name for name in self.names}
        # with U words of no template, a unit is at least unknown * sqrt(U) long beside the part that its other K words span
        c = min(min_cosine, 0.999)
        self.reach = c * c / (1 - c * c) * (self.unknown / max([1.0, *self.idf.values()])) ** 2
        self.least = min_cosine

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """Highest cosine, if it reaches the least one, and its licence; ties go to the first template."""
        known = sum(map(self.idf.__contains__, words))
        if known * known < self.reach * (len(words) - known):
            return None
        counts = Counter(words)
        inner = outer = 0.0
        for t, k in counts.items():
            w = self.idf.get(t)
            if w is None:
                outer += k * k
            else:
                inner += (k * w) ** 2
        length = inner + outer * self.unknown**2
        if inner < self.least**2 * length:  # the cosine with any template is at most that with the span of their terms
            return None
        dots: dict[int, float] = {}
        for t, k in counts.items():
            for i, x in self.by_term.get(t, ()):
                dots[i] = dots.get(i, 0.0) + k * self.idf[t] * x
        if not dots:
            return None
        i, dot = max(dots.items(), key=lambda p: (p[1], -p[0]))
        cosine = dot / math.sqrt(length)
        return (cosine, self.names[i]) if cosine >= self.least else None


def units(text: str) -> Iterator[tuple[str, list[str]]]:
    """The sentences, lines and paragraphs of a text, and last its whole, each with its terms."""
    whole: list[str] = []
    n = 0
    for paragraph in _PARAGRAPH.split(text):
        n += 1
        of_paragraph: list[str] = []
        lines = paragraph.split("\n")
        for line in lines:
            sentences = _SENTENCE.split(line)
            of_line: list[str] = []
            for sentence in sentences:
                found = terms(sentence)
                of_line += found
                if len(sentences) > 1:
                    yield sentence, found
            yield line, of_line
            of_paragraph += of_line
        if len(lines) > 1:
            yield paragraph, of_paragraph
        whole += of_paragraph
    if n > 1:
        yield text, whole


def scan_text(text: str | None, templates: Templates) -> tuple[str | None, float, float]:
    """Licence of a text, its cosine, and the cosine of the whole text where that reaches the least one (else 0).

    The unit with the highest cosine decides, of equal ones the first. An SPDX tag has cosine 1.
    """
    if not text:
        return None, 0.0, 0.0
    licence, cosine, whole = None, 0.0, 0.0
    if "icense-" in text.lower() and (tag := _SPDX.search(text)):
        stated = tag[1].strip("()")
        licence, cosine = templates.by_name.get(stated.lower(), stated), 1.0
        if terms(text) == terms(tag[0]):
            whole = 1.0
    for unit, words in units(text):
        found = templates.best(words) if words else None
        if found and not _DENIED.search(unit):
            if len(unit) == len(text):
                whole = found[0]
            if found[0] > cosine:
                cosine, licence = found
    return licence, cosine, whole


FOUND = StructType([StructField("path", StringType()), StructField("licence", StringType()), StructField("cosine", DoubleType()), StructField("whole", DoubleType())])


def scan(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, min_cosine: float = MIN_COSINE) -> DataFrame:
    """path, licence (null for none), cosine and whole (that of the whole text, if it is a licence, else 0) of every row
    of ``files`` (path, text). One pass, no shuffle."""
    templates = list(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, min_cosine)
        for batch in batches:
            for part in (batch.slice(at, 1000) for at in range(0, batch.num_rows, 1000)):
                rows = [scan_text(t, known) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], FOUND.names)

    return files.select(files["path"].cast("string").alias("path"), files["text"].cast("string").alias("text")).mapInArrow(run, FOUND)


def directory(path: Column) -> Column:
    """All before the last slash; the empty string is the root."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def inherit(found: DataFrame, by_text: bool = False) -> DataFrame:
    """``found`` (path, licence, cosine, whole) with the licence that holds for each path.

    Adds holds, origin (``own``, ``inherited`` or ``none``) and from_path. A licence file has a name like LICENSE or,
    with ``by_text``, a whole text that is a licence. Of several licence files in a directory the one with the highest
    cosine counts, then the first by path. Directories, not files, are joined with their ancestors, so that the rows
    joined don't grow with the files of a directory; the files of a directory are dealt over SALTS tasks.
    """
    rows = found.withColumn("dir", directory(F.coalesce("path", F.lit(""))))
    named = F.col("path").rlike(LICENCE_NAME)
    granting = rows.where(F.col("licence").isNotNull() & ((named | (F.col("whole") > 0)) if by_text else named))
    best = F.min(F.struct((-F.col("cosine")).alias("order"), "path", "licence")).alias("m")
    grants = granting.groupBy("dir").agg(best).select(F.col("dir").alias("above"), F.col("m.licence").alias("granted"), F.col("m.path").alias("granted_by"))
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, 1, k), "/").alias("above")))
    above = F.when(F.col("dir") == "", F.slice(above, 1, 1)).otherwise(above)
    dirs = rows.select("dir").distinct().select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.above")
    nearest = dirs.join(grants, "above").groupBy("dir").agg(F.max(F.struct("depth", "granted", "granted_by")).alias("m")).select("dir", "m.granted", "m.granted_by")
    nearest = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    out = rows.join(nearest, ["dir", "salt"], "left").drop("dir", "salt")
    own = F.col("licence").isNotNull()
    return (
        out.withColumn("holds", F.coalesce("licence", "granted"))
        .withColumn("origin", F.when(own, "own").when(F.col("granted").isNotNull(), "inherited").otherwise("none"))
        .withColumn("from_path", F.when(own, F.col("path")).otherwise(F.col("granted_by")))
        .drop("granted", "granted_by")
    )


def licences(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, min_cosine: float = MIN_COSINE, by_text: bool = False) -> DataFrame:
    """Licences of ``files`` (path, text): path, licence, cosine, whole, holds, origin, from_path, a row for each row.

    A null or empty text has no licence of its own but may inherit one; a null path lies in the root. Very long texts
    are scanned whole, unit by unit. Ties between templates go to the first, between units to the first. Repeated rows
    give repeated rows; other columns are ignored; an empty table gives none.
    """
    return inherit(stored(scan(files, templates, min_cosine), "licences"), by_text)


def document_licences(docs: DataFrame) -> DataFrame:
    """Licences of ``docs`` (doc_id, text, lang, source), filed under ``source/lang/doc_id.txt``, with doc_id.

    Documents have no file names: one whose whole text is a licence counts as the licence file of its directory.
    """
    (path,) = columns_not_in(docs, "path")
    where = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("_")), F.lit(".txt")))
    found = licences(docs.select(where.alias("path"), docs["text"].alias("text")), by_text=True)
    return found.select(F.expr("try_cast(regexp_extract(path, '([^/]*)[.]txt$', 1) as bigint)").alias("doc_id"), "path", "licence", "cosine", "holds", "origin", "from_path")
