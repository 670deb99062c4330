"""Licence notices in documents by the Dice coefficient over word bigrams.

Text is normalised to words of a-z and 0-9 in lower case. A unit is the whole
text, a paragraph, a line, or a window at any place; its score against a template
is ``2 * |A & B| / (|A| + |B|)`` over the sets of their word bigrams. Windows have
as many words as a template and lie where one of its ``telling_bigrams`` in the
text would stand in it, so notices inside running text, over several paragraphs
or wrapped lines are units too. For a threshold ``t`` a unit can only reach it
with ``|A|`` between ``|B| * t / (2 - t)`` and ``|B| * (2 - t) / t``, so a unit
meets just the templates whose bounds admit its size, as an equality join on the
size; its bigrams counted with repeats must keep the upper bound as well.

A unit's bigrams are among its document's, so a document that shares fewer than
``|B| * t / (2 - t)`` bigrams with every template holds no match; it is not cut
into units. So many bigrams can only be shared by a text with one of the
``telling_words``, which is looked for first. Both tests are exact, as are all
scores. Bigrams are compared by 64-bit hash.

A place is reported once. Of matches of one template that cover half of the
shorter or more, the one with the highest score stays (then fewer words, earlier
start). Of these, templates that share half of the smaller one's bigrams or more are
rivals for a place that their matches cover in the same way: the one with most
shared bigrams stays (then the score, smaller template number), so a notice of one version is
not reported as the other and a long notice not as its beginning too. NULL and empty
texts match nothing; rows that share a key are reported together, each with its
own notices.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerloom.llm.common import text_or_empty

DEFAULT_THRESHOLD = 0.8

#: Public licence notices, as their authors word them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "agpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Affero General Public License for more details.",
    ),
    (
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution.",
    ),
    (
        "bsd-3-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission.",
    ),
    (
        "bsd-3-clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    (
        "bsl-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "cc-by-nc-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "cc0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions",
    ),
)


def normalised(text: Column) -> Column:
    """Words of a-z and 0-9, one space apart."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    """Hash of each word with the next; repeats stay."""
    following = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(words, F.lit(1), F.size(following)), following, lambda a, b: F.xxhash64(a, b))
    return pairs


def _needed(n_grams: int, threshold: float) -> int:
    """Shared bigrams without which a template of ``n_grams`` can't reach the threshold."""
    return math.ceil(round(n_grams * threshold / (2 - threshold), 9))


def template_words(text: str) -> list[str]:
    """A template's normalised words."""
    return re.sub("[^a-z0-9]+", " ", "".join(c.lower() if c.isascii() else c for c in text)).split()


def rival_templates(templates: tuple[tuple[str, str], ...]) -> list[list[int]]:
    """For each template the numbers of those that share half of the smaller one's bigrams with it."""
    grams = [set(pairwise(template_words(text))) for _, text in templates]
    return [
        [j for j, b in enumerate(grams) if i != j and a and b and 2 * len(a & b) >= min(len(a), len(b))]
        for i, a in enumerate(grams)
    ]


def telling_words(templates: tuple[tuple[str, str], ...], threshold: float) -> list[str]:
    """Words of which every text that reaches the threshold has at least one.

    For each template they touch so many of its bigrams that too few are left
    without them. Long words that serve many templates are taken first.
    """
    grams = [set(pairwise(template_words(text))) for _, text in templates]
    spare = [len(g) - _needed(len(g), threshold) + 1 for g in grams]
    chosen: list[str] = []
    while True:
        gain: dict[str, int] = {}
        for left, over in zip(grams, spare, strict=True):
            if left and over > 0:
                for word in {w for pair in left for w in pair}:
                    gain[word] = gain.get(word, 0) + min(over, sum(word in pair for pair in left))
        if not gain:
            return sorted(chosen)
        best = max(gain, key=lambda w: (min(len(w), 5), gain[w], len(w), w))
        chosen.append(best)
        for i, left in enumerate(grams):
            rest = {pair for pair in left if best not in pair}
            spare[i] -= len(left) - len(rest)
            grams[i] = rest


def telling_bigrams(templates: tuple[tuple[str, str], ...], threshold: float) -> list[tuple[str, str, int, int]]:
    """Two words, their place in a template and its number of words.

    Of each template's bigrams so many, the longest first, that no unit reaches
    the threshold without one of them.
    """
    out = set()
    for _, text in templates:
        words = template_words(text)
        pairs = list(pairwise(words))
        distinct = sorted(set(pairs), key=lambda p: (-len(p[0]) - len(p[1]), p))
        telling = set(distinct[: len(distinct) - _needed(len(distinct), threshold) + 1]) if distinct else set()
        out |= {(*pair, place, len(words)) for place, pair in enumerate(pairs) if pair in telling}
    return sorted(out)


def _longs(values: Iterable[int]) -> Column:
    """A literal array, built in one call."""
    return F.expr(f"array({', '.join(f'CAST({v} AS BIGINT)' for v in sorted(values))})")


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _spans(edges: Column) -> Column:
    """Each edge with the next."""
    steps = F.greatest(F.size(edges) - 1, F.lit(0))
    return F.zip_with(
        F.slice(edges, F.lit(1), steps),
        F.slice(edges, F.lit(2), steps),
        lambda a, b: F.struct(a.alias("start"), b.alias("stop")),
    )


def _layout_spans(breaks: Column, n_words: Column) -> Column:
    """Lines, paragraphs and the whole text, from the number of words before each line break."""
    steps = F.greatest(F.size(breaks) - 1, F.lit(0))
    empty_lines = F.filter(
        F.zip_with(
            F.slice(breaks, F.lit(1), steps), F.slice(breaks, F.lit(2), steps), lambda a, b: F.when(a == b, a)
        ),
        lambda x: x.isNotNull(),
    )
    ends = F.array(F.lit(0)), F.array(n_words)
    lines = F.array_distinct(F.concat(ends[0], breaks, ends[1]))
    paragraphs = F.array_distinct(F.concat(ends[0], empty_lines, ends[1]))
    return F.concat(_bound(lines, _spans), _bound(paragraphs, _spans), _spans(F.concat(*ends)))


def _window_spans(grams: Column, n_words: Column, telling: Column) -> Column:
    """Where templates would lie for each telling bigram of the text."""
    wanted = F.array_intersect(F.transform(telling, lambda e: e["gram"]), grams)
    hits = _bound(
        wanted,
        lambda seen: F.filter(
            F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("place"))),
            lambda x: F.array_contains(seen, x["gram"]),
        ),
    )
    starts = F.transform(
        hits,
        lambda x: F.transform(
            F.filter(telling, lambda e: e["gram"] == x["gram"]),
            lambda e: F.struct((x["place"] - e["place"]).alias("first"), e["words"].alias("words")),
        ),
    )
    return F.transform(
        F.array_distinct(F.flatten(starts)),
        lambda w: F.struct(
            F.greatest(w["first"], F.lit(0)).alias("start"),
            F.least(w["first"] + w["words"], n_words).alias("stop"),
        ),
    )


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...], threshold: float) -> DataFrame:
    """One row per template and admissible unit size ``admitted``, of at most ``high`` bigrams."""
    rivals = rival_templates(templates)
    raw = spark.createDataFrame(
        [(i, name, rivals[i], text) for i, (name, text) in enumerate(templates)],
        "template int, licence string, rivals array<int>, text string",
    ).select(
        "template",
        "licence",
        "rivals",
        F.array_distinct(bigrams(F.split(normalised(F.col("text")), " "))).alias("grams"),
    )
    low = F.ceil(F.round(F.size("grams") * threshold / (2 - threshold), 9)).cast("int")
    high = F.floor(F.round(F.size("grams") * (2 - threshold) / threshold, 9)).cast("int")
    return (
        raw.where(F.size("grams") > 0)
        .withColumn("high", high)
        .select("*", F.explode(F.sequence(low, F.col("high"))).alias("admitted"))
    )


def _units(text: Column, telling: Column, shortest: int, longest: int) -> Column:
    """Spans of words to be scored, with their distinct bigrams."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    spaced = F.regexp_replace(F.regexp_replace(lowered, r"[^a-z0-9\n]+", " "), r"\n", " \n ")
    tokens = F.filter(F.split(spaced, " +"), lambda t: t != "")

    def cut(words: Column, breaks: Column, grams: Column) -> Column:
        spans = F.concat(_layout_spans(breaks, F.size(words)), _window_spans(grams, F.size(words), telling))
        fitting = F.filter(
            F.array_distinct(spans), lambda s: (s["stop"] - s["start"] - 1).between(F.lit(shortest), F.lit(longest))
        )
        return F.transform(
            fitting,
            lambda s: F.struct(
                s["start"].alias("start"),
                s["stop"].alias("stop"),
                F.array_distinct(F.slice(grams, s["start"] + 1, s["stop"] - s["start"] - 1)).alias("grams"),
            ),
        )

    def breaks_of(stream: Column) -> Column:
        places = F.filter(F.transform(stream, lambda t, i: F.when(t == "\n", i)), lambda p: p.isNotNull())
        return F.transform(places, lambda p, nth: p - nth)

    return _bound(
        tokens,
        lambda stream: _bound(
            F.filter(stream, lambda t: t != "\n"),
            lambda words: _bound(
                breaks_of(stream), lambda breaks: _bound(bigrams(words), lambda grams: cut(words, breaks, grams))
            ),
        ),
    )


def licence_notices(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """One row per notice: ``key``, ``licence``, ``template``, ``start`` and ``stop`` in words, ``dice``."""
    spark = docs.sparkSession
    table = template_table(spark, templates, threshold)
    known = table.groupBy("template").agg(  # as many as were passed in
        F.first("grams").alias("grams"), F.min("admitted").alias("low"), F.first("high").alias("high")
    ).collect()
    if not known:
        raise ValueError("no template has two words")

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    words = telling_words(templates, threshold)
    # as a lambda over one element the text is lowered once, not once per word
    rows = rows.where(
        F.exists(F.array(F.lower("text")), lambda t: reduce(lambda a, b: a | b, [t.contains(w) for w in words]))
    )

    def reachable(grams: Column) -> Column:
        return reduce(
            lambda a, b: a | b,
            [
                F.size(F.array_intersect(grams, _longs(row["grams"])))
                >= _needed(len(row["grams"]), threshold)
                for row in known
            ],
        )

    union = _longs({g for row in known for g in row["grams"]})
    shared = F.array_intersect(bigrams(F.split(normalised(text_or_empty("text")), " ")), union)
    rows = rows.where(F.exists(F.array(shared), reachable))

    entries = telling_bigrams(templates, threshold)  # words of a-z and 0-9 need no quoting
    structs = [f"struct(xxhash64('{a}', '{b}') AS gram, {place} AS place, {n} AS words)" for a, b, place, n in entries]
    telling = F.expr(f"array({', '.join(structs)})")
    longest = max(row["high"] for row in known)
    units = _units(F.col("text"), telling, min(row["low"] for row in known), longest)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # beneath the explode: one per text
    sized = numbered.select("row", "key", F.explode(units).alias("u")).select(
        "row", "key", "u.start", "u.stop", "u.grams", F.size("u.grams").alias("size")
    )
    side = F.broadcast(  # a few thousand rows, fixed by the templates
        table.select("template", "licence", "rivals", F.col("grams").alias("wanted"), "high", "admitted")
    )
    scored = (
        sized.join(side, (F.col("size") == F.col("admitted")) & (F.col("stop") - F.col("start") - 1 <= F.col("high")))
        .withColumn("shared", F.size(F.array_intersect("grams", "wanted")))
        .withColumn("dice", 2 * F.col("shared") / (F.col("size") + F.size("wanted")))
        .where(F.col("dice") >= threshold)
        .select("row", "key", "licence", "template", "rivals", "start", "stop", "shared", "dice")
    )

    def covers(other: Column) -> Column:
        common = F.least(other["stop"], F.col("stop")) - F.greatest(other["start"], F.col("start"))
        return 2 * common >= F.least(other["stop"] - other["start"], F.col("stop") - F.col("start"))

    def better_place(other: Column) -> Column:
        mine = F.struct(-F.col("dice"), F.col("stop") - F.col("start"), F.col("start"))
        theirs = F.struct(-other["dice"], other["stop"] - other["start"], other["start"])
        return (other["template"] == F.col("template")) & covers(other) & (theirs < mine)

    def better_template(other: Column) -> Column:
        mine = F.struct(-F.col("shared"), -F.col("dice"), F.col("template"))
        theirs = F.struct(-other["shared"], -other["dice"], other["template"])
        return F.array_contains("rivals", other["template"]) & covers(other) & (theirs < mine)

    # all that can overlap a match start within the longest unit of it
    around = Window.partitionBy("row").orderBy("start").rangeBetween(-longest - 1, longest + 1)
    near = F.collect_list(F.struct("template", "start", "stop", "shared", "dice")).over(around)
    best = scored.withColumn("near", near).where(~F.exists("near", better_place)).drop("near")
    best = best.withColumn("near", near).where(~F.exists("near", better_template))
    return best.select("key", "licence", "template", "start", "stop", "dice")


def licence_scan(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """``key``, ``licence``, ``dice`` of its best notice and ``n_notices``."""
    found = licence_notices(docs, key=key, text=text, templates=templates, threshold=threshold)
    return found.groupBy("key", "licence").agg(F.max("dice").alias("dice"), F.count("*").alias("n_notices"))
