"""License scan by diagonal voting, DataFrame functions only.

All rolling word k-grams of a text are joined by hash to the k-grams of license templates. A hit at text word p and
template word t votes for the diagonal p - t: a copy of the template makes all its k-grams vote for one diagonal, an
inserted or missing word moves the rest to a neighbouring one. Votes are added up per diagonal, neighbouring diagonals are
merged, and a merged span counts if it is verified: enough of the template's k-grams, within little more than its length.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tcelake.llm.common import texts_of

K = 3
#: Phrases whose full occurrences are the base places.
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: Further templates; a copy with small changes counts as well.
TEMPLATES = {
    "gpl-3": ["licensed under the gnu general public license version 3"],
    "gpl-2": ["under the terms of the gnu general public license version 2"],
    "lgpl": ["gnu lesser general public license as published by the free software foundation"],
    "mpl-2": ["subject to the terms of the mozilla public license v 2 0"],
    "bsd-3": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee"],
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "apache-2": ["you may not use this file except in compliance with the license"],
    "cc-by-sa": ["licensed under a creative commons attribution sharealike"],
    "cc0": ["to the extent possible under law has waived all copyright and related rights"],
}

#: Bodies and header notices as they are published, without names and years.
BODIES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-3": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY
        THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
        THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
        (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "gpl-3": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
}
#: Largest template table (rows, one per k-gram) that is broadcast; a larger one is joined by exchange.
BROADCAST_ROWS = 100_000

def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, then runs of ASCII letters, digits and all characters beyond ASCII."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def k_grams(words: Column, k: int = K) -> Column:
    """All k-grams of consecutive words, in order."""
    places = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)]))


def plain_words(text: str) -> list[str]:
    """:func:`words_of` of a template."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def template_grams(spark: SparkSession, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """``gram, gram_hash, template, label, is_base, t, n_grams`` of the base phrases and the templates
    ``(label, text)`` (``None``: the fixed ones), and the empty gram, which every text has once (it carries texts without a
    hit through the join). Templates of fewer than five words are never found, as they have no more than two k-grams."""
    if templates is None:
        templates = [(label, text) for label, texts in TEMPLATES.items() for text in texts] + list(BODIES.items())
    named = [(label, text, True) for label, text in BASE.items()]
    named += [(label, text, False) for label, text in templates]
    rows = [("", None, None, False, 0, 1)]
    for number, (label, text, is_base) in enumerate(named):
        words = plain_words(text)
        n = len(words) - K + 1
        rows += [(" ".join(words[t:t + K]), number, label, is_base, t, n) for t in range(n)]
    schema = "gram string, template int, label string, is_base boolean, t int, n_grams int"
    table = spark.createDataFrame(rows, schema).withColumn("gram_hash", F.xxhash64("gram"))
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def scan(docs: DataFrame, coverage: float = 0.7, drift: int = 2, stretch: float = 1.5, slack: float = 0.05,
         templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``; other columns are ignored): ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``.

    ``coverage``: share of a template's k-grams that a merged span must hold; ``drift``: largest distance of neighbouring
    diagonals that are merged, or ``slack`` times the template's k-grams where that is more (long bodies have whole phrases
    put in or left out); ``stretch``: longest span, in template lengths. ``score`` is the largest coverage of a
    verified span (a base place: 1), else 0. Null and empty texts have no words and no places. Repeated rows each give a
    row; an empty table gives an empty one."""
    spark = docs.sparkSession
    words = texts_of(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    grams = (words.select("row", "doc_id", F.size("words").alias("n_words"),
                          F.posexplode(F.concat(F.array(F.lit("")), k_grams(F.col("words")))).alias("p", "own"))
             .withColumn("own_hash", F.xxhash64("own")))
    # The table is broadcast up to BROADCAST_ROWS. The text's words stand behind the hash in the join condition.
    table = template_grams(spark, templates)
    hits = grams.join(table, (grams.own_hash == table.gram_hash) & (grams.own == table.gram))
    # One exchange by row; everything below groups within it. Only hits and one row per text get here.
    hits = (hits.select("row", "doc_id", "n_words", "template", "label", "is_base", "n_grams", (F.col("p") - 1).alias("p"),
                        (F.col("p") - 1 - F.col("t")).alias("diagonal")).repartition("row"))
    votes = hits.groupBy("row", "template", "diagonal").agg(
        F.count("*").alias("votes"), F.min("p").alias("first"), F.max("p").alias("last"),
        *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "is_base", "n_grams")])
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    votes = votes.withColumn("full", F.col("is_base") & (F.col("votes") == F.col("n_grams")))
    votes = votes.withColumn("span", F.sum(F.when(step <= F.greatest(F.lit(drift), F.floor(slack * F.col("n_grams"))), 0).otherwise(1)).over(order))
    spans = votes.groupBy("row", "template", "span").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum(F.col("full").cast("long")).alias("n_base"),
        F.min(F.when(F.col("full"), F.col("diagonal"))).alias("first_base"),
        F.max(F.when(F.col("full"), F.col("diagonal"))).alias("last_base"),
        *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "is_base", "n_grams")])
    covered = F.least(F.col("votes") / F.col("n_grams"), F.lit(1.0))
    near = F.col("last") - F.col("first") + K <= stretch * (F.col("n_grams") + K - 1)
    verified = F.col("template").isNotNull() & ((F.col("n_base") > 0) | (near & (F.col("n_grams") > 2) & (covered >= coverage)))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"),
        F.sum("n_base").alias("n_base"), F.min("first_base").cast("long").alias("first_word"),
        F.max("last_base").cast("long").alias("last_word"), joined(F.when(F.col("n_base") > 0, F.col("label"))).alias("base_labels"),
        joined(F.when(verified, F.col("label"))).alias("labels"),
        F.max(F.when(F.col("n_base") > 0, 1.0).when(verified, covered).otherwise(0.0)).alias("score")).drop("row")
