"""License scans: sparse TF-IDF cosine of headers, notices and whole licence files to templates, then inheritance from the nearest
directory with a licence file, in DataFrame functions alone.

A text is compared in units: the whole of it, its paragraphs, lines and sentences (which may run over lines), and words
around each anchor (NEAR on either side, and as many as short templates have), so that a notice inside a long line is a unit too.  A unit is a vector over its words
(a-z and digits, dots and hyphens inside, so SPDX ids are words), weighted by term frequency and ln((1 + T) / (1 + df)) + 1, with
df counted over the T templates.  Weights don't depend on the corpus, so a notice scores alike whatever its size.

Notices of different licenses share most of their words, so names and versions must agree: a unit matches a template only if it holds all words
that the template says it must, none of OTHERS that the template hasn't, and no denial ("not licensed under").  Every match holds one of the
``anchors``, which follow from the templates, whatever they are; texts and units without an anchor are left out and nothing is lost.

Cosines have four decimals.  A unit takes the template of the greatest cosine if that is at least ``cosine``.  A document's own
license is that of its best unit.  A licence file (by name, or a document of which that unit is at least half) licenses its
directory; a document without a unit of its own inherits from its nearest such ancestor directory.

Defined results: a null or empty text has no units and may inherit.  A null path is in no directory.  Ties go to the greater
cosine, then to the license first by name, then to the shorter unit.  A unit that names several licenses has one of them.  Repeated rows get equal results; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, release

class Template(NamedTuple):
    """A text of a license.  ``must``: words that a match has to hold, the name and version as a rule, the rarest first."""

    license: str
    text: str
    must: str = ""


# Licenses and their SPDX ids, notices, headers and texts; of the long texts the title and what opens them.
_NOTICES = (
    ("Apache-1.1", "apache 1.1", "Licensed under the Apache Software License, Version 1.1."),
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "applicable warranties permissions", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "apache 2.0", "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Artistic-2.0", "artistic 2.0", "Licensed under the Artistic License 2.0."),
    ("BSD-2-Clause", "bsd 2-clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "redistributions binary disclaimer", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "bsd 3-clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "bsd-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "bsd 3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("BSD-3-Clause", "redistributions binary disclaimer endorse", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-4-Clause", "bsd 4-clause", "Licensed under the BSD 4-Clause License."),
    ("BSL-1.0", "boost software", "Licensed under the Boost Software License."),
    ("BSL-1.0", "boost 1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("CC0-1.0", "cc0 1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal."),
    ("CDDL-1.0", "distribution development 1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License, Version 1.0."),
    ("EPL-1.0", "eclipse v1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0."),
    ("EPL-2.0", "eclipse 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL-2.0", "eclipse 2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("EUPL-1.2", "eupl 1.2", "Licensed under the EUPL, Version 1.2."),
    ("GPL-2.0", "gplv2", "Licensed under the GPLv2."),
    ("GPL-3.0", "gplv3", "Licensed under the GPLv3."),
    ("ISC", "isc license", "Licensed under the ISC License."),
    ("ISC", "permission fee hereby granted", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "license mit", "Released under the MIT License."),
    ("MIT", "license mit", "Licensed under the MIT License."),
    ("MIT", "licensed mit", "Licensed under MIT."),
    ("MIT", "license mit", "MIT License"),
    ("MIT", "license mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License."),
    ("MIT", "hereby charge sublicense", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-1.1", "mozilla 1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1."),
    ("MPL-2.0", "mozilla 2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "mozilla 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "mozilla 2.0", "Mozilla Public License, v. 2.0"),
    ("Unlicense", "unencumbered", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "zlib license", "Licensed under the zlib License."),
    ("Zlib", "as-is liable damages", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("proprietary", "reserved all rights", "All rights reserved."),
    ("proprietary", "reserved all rights", "Copyright. All rights reserved."),
    ("proprietary", "proprietary confidential", "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited."),
)
# The licenses of the GNU project: SPDX id, name, version and date.
_GNU = (
    ("GPL-2.0", "General Public License", "2", "June 1991"),
    ("GPL-3.0", "General Public License", "3", "29 June 2007"),
    ("LGPL-2.0", "Library General Public License", "2", "June 1991"),
    ("LGPL-2.1", "Lesser General Public License", "2.1", "February 1999"),
    ("LGPL-3.0", "Lesser General Public License", "3", "29 June 2007"),
    ("AGPL-3.0", "Affero General Public License", "3", "19 November 2007"),
)
_GNU_TEXTS = (
    "This work is licensed under the GNU {name}, version {version}.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.",
    "GNU {name} Version {version}, {date}",
)
# The kinds of Creative Commons licenses, and the versions with what they call themselves.
_CC = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = {"3.0": "Unported", "4.0": "International"}
NOTICES = (
    *(Template(name, text, must) for name, must, text in _NOTICES),
    *(Template(spdx, text.format(name=name, version=version, date=date), f"gnu {version} {name.lower()}") for spdx, name, version, date in _GNU for text in _GNU_TEXTS),
    *(Template(f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.", f"{v} cc {kind.lower()}") for kind in _CC for v in _CC_VERSIONS),
    *(Template(f"CC-{kind}-{v}", f"This work is licensed under a Creative Commons {name} {v} {of} License.", f"creative commons {v} {name.lower()}") for kind, name in _CC.items() for v, of in _CC_VERSIONS.items()),
)
TEMPLATES = NOTICES + tuple(
    Template(name, f"SPDX-License-Identifier: {name}{more}", f"spdx-license-identifier {name.lower()}{more}")
    for name in sorted({t.license for t in NOTICES} - {"proprietary"})
    for more in (("", "-only", "-or-later") if "GPL" in name else ("",))
)
#: Words that name another license than the one whose other words stand around them.
OTHERS = frozenset("0bsd 1-clause 2-clause 3-clause 4-clause affero eclipse lesser library noncommercial noderivatives sharealike clear expat patent x11".split())
LICENSE_NAME = r"(?i)^(?:un)?(?:licen[sc]e|copying|notice)(?:[.\-].*)?$"
TOKEN = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
_BLANK = "\n[ \t]*\n"
_STOP = "([.!?;])[ \t\n]+"
#: A denied notice: its verb and up to seven words of its clause become a word that no template has.
DENIED = "(^|[^a-z0-9.-])(?:not|never|no longer)[ \t\n]+(?:been[ \t\n]+|be[ \t\n]+|being[ \t\n]+)?(licensed|released|covered|governed|distributed|available|subject|under)(?:[ \t]+[^ \t\n.;!?,]+){0,7}"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COSINE = 0.7
#: Words on either side of an anchor that are a unit with it, and the words of a template up to which its own place around the anchor is one too: notices inside long lines.
NEAR, SHORT = (4, 10, 24), 40


def _words(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def idf(templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[str, float], float]:
    """Weights of the templates' words and of any other word."""
    df = Counter(w for t in templates for w in set(_words(t.text)))
    weight = lambda n: math.log((1 + len(templates)) / (1 + n)) + 1
    return {w: weight(n) for w, n in df.items()}, weight(0)


def anchors(templates: tuple[Template, ...] = TEMPLATES, cosine: float = COSINE) -> frozenset[str]:
    """Words of which a unit holds one at least if it matches any template: a word that a match must hold or, where the template has none, its
    weightiest words, until the others together can't reach ``cosine`` (the cosine of a unit is at most the share that its words have of the template's norm).
    """
    weights, found = idf(templates)[0], set()
    for t in templates:
        if t.must:
            found.add(t.must.split()[0])
            continue
        parts = {w: (n * weights[w]) ** 2 for w, n in Counter(_words(t.text)).items()}
        rest = total = sum(parts.values())
        for w in sorted(parts, key=lambda w: (-parts[w], w)):
            if math.sqrt(max(rest, 0) / total) < cosine - 0.001:
                break
            found.add(w)
            rest -= parts[w]
    return frozenset(found)


def spans(templates: tuple[Template, ...] = TEMPLATES, cosine: float = COSINE) -> list[tuple[str, int, int]]:
    """(anchor, words before it, words after it) of the units around anchors: NEAR, and where the anchor stands in short templates."""
    found = anchors(templates, cosine)
    made = {(a, n, n) for a in found for n in NEAR}
    for t in templates:
        words = _words(t.text)
        made |= {(w, i, len(words) - 1 - i) for i, w in enumerate(words) if w in found and len(words) <= SHORT}
    return sorted(made)


def _forms(templates: tuple[Template, ...]) -> list[tuple[int, str, str, float, float, int, int, int]]:
    """(form, license, word, weight, norm of the form, 1 if the word must be there, 1 if it is one of OTHERS, words that must be there)."""
    weights, rows = idf(templates)[0], []
    for i, t in enumerate(templates):
        parts, must = {w: n * weights[w] for w, n in Counter(_words(t.text)).items()}, set(t.must.split())
        if not must <= set(parts):
            raise ValueError(f"words that a match must hold are not in the template: {t}")
        norm = math.sqrt(sum(v * v for v in parts.values()))
        rows += [(i, t.license, w, v, norm, int(w in must), int(w in OTHERS), len(must)) for w, v in parts.items()]
    return rows


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _dir_of(path: Column) -> Column:
    """The directory of a path, without the last slash; the root is empty."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def _in_lower_case(text: Column) -> Column:
    """The text with A-Z lowered and denied notices made words of their own."""
    return F.regexp_replace(F.translate(text, _UPPER, _LOWER), DENIED, "$1not-$2")


def _anchored(words: frozenset[str]) -> str:
    return "(?:^|[^a-z0-9.-])(?:" + "|".join(re.escape(w).replace("\\-", "-") for w in sorted(words)) + ")(?:$|[^a-z0-9])"


def units(low: Column, words: Column, around: list[tuple[str, int, int]]) -> Column:
    """The distinct units of a text (in lower case, and its words) that hold an anchor: their words, spaced.

    Both must be columns of the frame: as expressions they would be evaluated anew for each word.
    """
    parts = F.concat(F.array(low), F.split(low, _BLANK, -1), F.split(low, "\n", -1), F.split(F.regexp_replace(low, _STOP, "$1\u0001"), "\u0001", -1))
    names = sorted({a for a, _, _ in around})
    anchored = F.array(*[F.lit(a) for a in names])
    sides = F.create_map(*[x for a in names for x in (F.lit(a), F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("m")) for b, n, m in around if a == b]))])
    at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*names), F.struct((i + 1).alias("i"), w.alias("w")))), lambda x: x.isNotNull())
    near = F.flatten(F.transform(at, lambda x: F.transform(F.element_at(sides, x["w"]), lambda s: F.slice(words, F.greatest(F.lit(1), x["i"] - s["n"]), F.least(x["i"], s["n"] + 1) + s["m"]))))
    cued = F.filter(F.concat(F.transform(parts, _tokens), near), lambda x: F.arrays_overlap(x, anchored))
    return F.array_distinct(F.transform(cued, lambda x: F.array_join(x, " ")))


def match_units(distinct: DataFrame, templates: tuple[Template, ...] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """For distinct units (uid, unit): rows (uid, license, score) for those that match."""
    spark = distinct.sparkSession
    weights, other = idf(templates)
    # as many rows as the templates have words: their size is that of a constant
    known = F.broadcast(spark.createDataFrame(sorted(weights.items()), "term string, idf double"))
    forms = F.broadcast(spark.createDataFrame(_forms(templates), "form int, license string, term string, tw double, tnorm double, must int, of_others int, n_must int"))
    counted = distinct.select("uid", F.explode(F.split("unit", " ")).alias("term")).groupBy("uid", "term").agg(F.count("*").alias("tf"))
    differs = (F.col("term").isin(*sorted(OTHERS)) | F.col("term").startswith("not-")).cast("int").alias("differs")
    weighted = cut(counted.join(known, "term", "left").select("uid", "term", (F.col("tf") * F.coalesce("idf", F.lit(other))).alias("w"), differs), "license-terms")
    norms = weighted.groupBy("uid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("differs").alias("n_differs"))
    dots = weighted.join(forms, "term").groupBy("uid", "form", "license", "tnorm", "n_must").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sum("must").alias("held"), F.sum("of_others").alias("agreed"))
    dots = dots.where(F.col("held") == F.col("n_must"))
    scored = dots.join(norms, "uid").where(F.col("n_differs") == F.col("agreed")).withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 4)).where(F.col("score") >= cosine)
    best = scored.groupBy("uid").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    made = cut(best.select("uid", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score")), "license-matched")
    release(weighted)
    return made


def scan(docs: DataFrame, path: Column, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """Per row: key, path, license, found (``header``, ``inherited`` or null) and score."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    named = docs.select(docs[key].alias("key"), path.cast("string").alias("path"), _in_lower_case(body).alias("low"))
    anchored = anchors(templates, cosine)
    # texts without an anchor are neither cut into words nor into units
    worded = named.withColumn("own_words", F.when(F.col("low").rlike(_anchored(anchored)), _tokens(F.col("low"))))
    made = F.when(F.col("own_words").isNotNull(), units(F.col("low"), F.col("own_words"), spans(templates, cosine)))
    rows = cut(worded.select(F.monotonically_increasing_id().alias("rid"), "key", "path", F.size("own_words").alias("words"), made.alias("units")), "license-rows")
    each = rows.where(F.col("units").isNotNull()).select("rid", "words", F.explode("units").alias("unit"))
    distinct = cut(each.select("unit").distinct().withColumn("uid", F.monotonically_increasing_id()), "license-units")
    matched = cut(distinct.join(match_units(distinct, templates, cosine), "uid").select("unit", "license", "score", F.size(F.split("unit", " ")).alias("unit_words")), "license-lines")
    # a row for each matched unit of a document; a unit of very many documents is split as any skewed join
    own = each.join(matched, "unit").groupBy("rid", "words").agg(F.min(F.struct((-F.col("score")).alias("s"), "license", "unit_words")).alias("b"))
    own = cut(own.select("rid", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), (2 * F.col("b.unit_words") >= F.col("words")).alias("mostly")), "license-own")
    release(distinct, matched)

    name = F.regexp_extract("path", "[^/]*$", 0)
    placed = rows.where(F.col("path").isNotNull()).select("rid", "path", _dir_of(F.col("path")).alias("dir"))
    files = placed.join(own, "rid").where(F.col("mostly") | name.rlike(LICENSE_NAME))
    licensed = cut(files.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")).select("dir", F.col("b.license").alias("up_license"), (-F.col("b.s")).alias("up_score")), "license-dirs")
    # ancestors are looked up once a directory, not once a document: its prefixes that end before a slash, itself and the root
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    seeking = placed.select("dir").distinct().select(F.col("dir").alias("of"), F.explode(F.array_distinct(above)).alias("dir"))
    nearest = seeking.join(licensed, "dir").groupBy("of").agg(F.max(F.struct(F.length("dir").alias("d"), "up_license", "up_score")).alias("up"))
    nearest = cut(nearest.select(F.col("of").alias("dir"), "up"), "license-nearest")
    out = rows.select("rid", "key", "path", _dir_of(F.col("path")).alias("dir")).join(own.drop("mostly"), "rid", "left").join(nearest, "dir", "left")
    found = F.when(F.col("license").isNotNull(), "header").when(F.col("up").isNotNull(), "inherited")
    return out.select(F.col("key").alias(key), "path", F.coalesce("license", "up.up_license").alias("license"), found.alias("found"), F.coalesce("score", "up.up_score").alias("score"))


def oracle(templates: tuple[Template, ...] = TEMPLATES, cosine: float = COSINE) -> str:
    """The scan of ``documents`` in SQL, with paths of source / language / hundred of ids / id."""
    weights, other = idf(templates)
    known = ", ".join(f"('{w}', {v!r}::DOUBLE)" for w, v in sorted(weights.items()))
    forms = ", ".join(f"({i}, '{name}', '{w}', {v!r}::DOUBLE, {norm!r}::DOUBLE, {must}, {of_others}, {n_must})" for i, name, w, v, norm, must, of_others, n_must in _forms(templates))
    cues = "[" + ", ".join(f"'{c}'" for c in sorted(anchors(templates, cosine))) + "]"
    around = ", ".join(f"('{a}', {n}, {m})" for a, n, m in spans(templates, cosine))
    others = "[" + ", ".join(f"'{c}'" for c in sorted(OTHERS)) + "]"
    return f"""
    WITH docs AS (
      SELECT row_number() OVER () AS rid, doc_id, regexp_replace(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '{DENIED}', '\1not-\2', 'g') AS t,
        concat_ws('/', source, lang, CAST(doc_id // 100 AS VARCHAR), CAST(doc_id AS VARCHAR)) AS path FROM documents
    ), worded AS (SELECT rid, t, regexp_extract_all(t, '{TOKEN}') AS w FROM docs),
    around(anchor, n, m) AS (VALUES {around}),
    placed AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE list_has_any(w, {cues})),
    pieces AS (
      SELECT rid, unnest(list_transform(list_concat([t], list_concat(string_split_regex(t, '\n[ \t]*\n'), list_concat(string_split(t, chr(10)), string_split(regexp_replace(t, '([.!?;])[ \t\n]+', '\1' || chr(1), 'g'), chr(1))))),
          lambda x: regexp_extract_all(x, '{TOKEN}'))) AS u
      FROM worded
      UNION ALL SELECT rid, w[greatest(1, i - n):i + m] FROM placed JOIN around ON anchor = w[i]
    ), each AS (
      SELECT DISTINCT rid, array_to_string(u, ' ') AS unit, len(u) AS unit_words FROM pieces WHERE list_has_any(u, {cues})
    ), terms AS (
      SELECT unit, term, count(*) AS tf FROM (SELECT unit, unnest(string_split(unit, ' ')) AS term FROM (SELECT DISTINCT unit FROM each)) GROUP BY ALL
    ), known(term, idf) AS (VALUES {known}),
    forms(form, license, term, tw, tnorm, must, of_others, n_must) AS (VALUES {forms}),
    weighted AS (
      SELECT unit, term, tf * COALESCE(idf, {other}::DOUBLE) AS w, list_contains({others}, term) OR starts_with(term, 'not-') AS differs FROM terms LEFT JOIN known USING (term)
    ), norms AS (SELECT unit, sqrt(sum(w * w)) AS norm, count(*) FILTER (WHERE differs) AS n_differs FROM weighted GROUP BY unit),
    scored AS (
      SELECT unit, license, round(sum(w * tw) / (any_value(norm) * any_value(tnorm)), 4) AS score
      FROM weighted JOIN forms USING (term) JOIN norms USING (unit) GROUP BY unit, form, license
      HAVING sum(must) = any_value(n_must) AND sum(of_others) = any_value(n_differs)
    ), best AS (
      SELECT * FROM scored WHERE score >= {cosine} QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, license) = 1
    ), own AS (
      SELECT rid, license, score, unit_words AS covered
      FROM each JOIN best USING (unit) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, license, unit_words) = 1
    ), dirs AS (
      SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license, score FROM own JOIN docs USING (rid) JOIN worded USING (rid)
      WHERE 2 * covered >= len(w) OR regexp_matches(regexp_extract(path, '[^/]*$'), '{LICENSE_NAME}')
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1
    ), up AS (
      SELECT docs.rid AS rid, dirs.license AS license, dirs.score AS score FROM docs JOIN dirs ON starts_with(docs.path, dirs.dir || '/')
      WHERE docs.rid NOT IN (SELECT rid FROM own) QUALIFY row_number() OVER (PARTITION BY docs.rid ORDER BY length(dirs.dir) DESC) = 1
    )
    SELECT doc_id, path, COALESCE(own.license, up.license) AS license, CASE WHEN own.license IS NOT NULL THEN 'header' WHEN up.license IS NOT NULL THEN 'inherited' END AS found, COALESCE(own.score, up.score) AS score
    FROM docs LEFT JOIN own USING (rid) LEFT JOIN up USING (rid)"""
