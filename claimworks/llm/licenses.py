"""Licence scans: normalised passages against licence templates by Dice over word bigrams, without Python code in tasks."""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimworks.llm.common import stored, table

THRESHOLD = 0.8
BROADCAST_ROWS = 2_000_000  # texts worth a search are broadcast up to this number, else joined by shuffle

# Notices and paragraphs of public licences, with the licence they stand for.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied. See the License for the specific language governing permissions and limitations under the "
                   "License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("GPL-3.0", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
                "License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def full_texts() -> list[tuple[str, str]]:
    """Whole licence texts, one file each, named after the licence."""
    return [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]


def plain_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def plain_bigrams(text: str) -> set[str]:
    words = plain_words(text)
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def words_of(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing; everything else separates."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def bigrams_of(words: Column) -> Column:
    return F.array_distinct(F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    ))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates=None, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per line and template that reach ``threshold``: rid, key, line (from 0), template, license, dice.

    The Dice coefficient is twice the common distinct word bigrams over the sum of both counts.  A template of
    t bigrams can only reach the threshold on lines of t * threshold / (2 - threshold) to
    t * (2 - threshold) / threshold bigrams; lines outside all these ranges are left out before any bigram is
    compared, and a pair outside its own range does not join.  Lines of a single word have no bigram and match
    nothing, as do null and empty texts; repeated rows are scanned each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    known = [
        (i, name, gram, len(grams))
        for i, (name, body) in enumerate(templates if templates is not None else TEMPLATES)
        for grams in [plain_bigrams(body)] for gram in sorted(grams)
    ]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = {t[3] for t in known}
    index = spark.createDataFrame(known, "template int, license string, gram string, t int")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"), F.col(text).cast("string").alias("t"))
    lines = rows.select("rid", "key", F.posexplode(F.split("t", "\n")).alias("line", "body"))
    words = lines.select("rid", "key", "line", words_of(F.col("body")).alias("words"))
    # distinct bigrams are at most words - 1, so the lower bound can be applied before they are made
    grams = words.where(F.size("words") - 1 >= (min(sizes) * low if sizes else 0)).select(
        "rid", "key", "line", bigrams_of(F.col("words")).alias("grams")
    ).withColumn("n", F.size("grams"))
    fits = F.lit(False)
    for t in sorted(sizes):
        fits = fits | F.col("n").between(F.lit(t * low), F.lit(t * high))
    pairs = (
        grams.where(fits).select("rid", "key", "line", "n", F.explode("grams").alias("gram"))
        .join(F.broadcast(index), "gram")  # the templates: a table of fixed size
        .where(F.col("n").between(F.col("t") * low, F.col("t") * high))
    )
    return (
        pairs.groupBy("rid", "key", "line", "n", "template", "license", "t").agg(F.count("*").alias("common"))
        .withColumn("dice", 2 * F.col("common") / (F.col("n") + F.col("t")))
        .where(F.col("dice") >= threshold).select("rid", "key", "line", "template", "license", "dice")
    )


def let(value: Column, then) -> Column:
    """``then`` of ``value``, which is worked out once however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def apart(found: Column, order) -> Column:
    """Structs with ``s`` and ``e`` (inclusive), taken in ``order`` unless they overlap one taken before."""
    ranked = F.transform(F.array_sort(F.transform(found, lambda x: F.struct(order(x).alias("o"), x.alias("x")))), lambda y: y["x"])
    return let(ranked, lambda r: F.aggregate(r, F.slice(r, 1, 0), lambda kept, x: F.when(
        F.exists(kept, lambda k: (k["s"] <= x["e"]) & (x["s"] <= k["e"])), kept).otherwise(F.concat(kept, F.array(x)))))


def passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates=None, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per passage that reaches ``threshold``: rid, key, line (from 0, of its first word), template, license, dice.

    A passage is a run of the normalised words of a document, across line breaks and inside longer lines.  With
    t bigrams in a template it needs t * threshold / (2 - threshold) distinct ones of them, so texts with fewer are
    left out first.  A bigram of the template next to a passage never lowers its Dice coefficient, so passages begin
    and end where an unbroken run of template bigrams does; every such pair is tested on its distinct bigrams, up to
    t * (2 - threshold) / threshold bigrams beside those that the template itself repeats.  Of the overlapping
    passages of one template the one of highest Dice stays (then the shorter, the first); of overlapping
    passages of several templates the one with most bigrams in common (then of highest Dice, the shorter, the
    first template).  Templates are by default the notices and the whole texts.  Null and empty texts match
    nothing; repeated rows are scanned each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    known, holders = [], {}
    for name, body in templates if templates is not None else TEMPLATES + full_texts():
        grams = plain_bigrams(body)
        for gram in grams:
            holders.setdefault(gram, []).append(len(known))
        t, repeated = len(grams), max(0, len(plain_words(body)) - 1 - len(grams))
        need = max(1, math.ceil(t * threshold / (2 - threshold) - 1e-9))
        known.append((len(known), name, t, need, math.floor(t * (2 - threshold) / threshold + 1e-9) + repeated))
    # both are tables of fixed size
    index = F.broadcast(spark.createDataFrame(sorted(holders.items()), "gram string, ids array<int>"))
    sizes = F.broadcast(spark.createDataFrame(known, "template int, license string, t int, need int, reach int"))

    body = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("key"), body.alias("t"), F.xxhash64(body).alias("digest"))
    worth = (
        rows.select(F.monotonically_increasing_id().alias("rid"), "digest", words_of(F.col("t")).alias("words"))
        .where(F.size("words") > 1).select("rid", "digest", F.explode(bigrams_of(F.col("words"))).alias("gram"))
        .join(index, "gram").select("rid", "digest", F.explode("ids").alias("template"))
        .groupBy("rid", "digest", "template").agg(F.count("*").alias("common"))
        .join(sizes, "template").where("common >= need")
        .groupBy("digest").agg(F.collect_set("template").alias("templates"))
    )
    worth = stored(worth, "licenses")
    few = worth.count() <= BROADCAST_ROWS
    picked = rows.join(F.broadcast(worth) if few else worth, "digest").withColumn("rid", F.monotonically_increasing_id())

    words = F.flatten(F.transform(F.split("t", "\n"), lambda x, i: F.transform(
        F.filter(words_of(x), lambda w: w != ""), lambda w: F.struct(w.alias("w"), i.alias("line")))))
    grams = let(words, lambda ws: F.zip_with(
        F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))),
        lambda a, b: F.struct(F.concat_ws(" ", a["w"], b["w"]).alias("gram"), a["line"].alias("line")),
    ))
    placed = picked.select("rid", "key", "templates", F.posexplode(grams).alias("pos", "g")).select(
        "rid", "key", "templates", "pos", "g.gram", "g.line"
    ).repartition("rid")
    # where the same bigram stood last: a bigram is the first of its kind in a passage that begins later
    last = F.coalesce(F.lag("pos").over(Window.partitionBy("rid", "gram").orderBy("pos")), F.lit(-1))
    whole = (
        placed.withColumn("prev", last).join(index, "gram", "left").groupBy("rid").agg(
            F.first("key").alias("key"), F.first("templates").alias("templates"),
            F.array_sort(F.collect_list(F.struct("pos", "prev", "line", "ids"))).alias("all"),
        )
    )
    each = whole.select("rid", "key", "all", F.explode("templates").alias("template")).join(sizes, "template")

    def tested(hits):
        begin = F.filter(hits, lambda x: F.coalesce(F.get(hits, x["i"] - 1)["pos"], F.lit(-2)) < x["pos"] - 1)
        end = F.filter(hits, lambda x: F.coalesce(F.get(hits, x["i"] + 1)["pos"], F.lit(2**31 - 1)) > x["pos"] + 1)
        return let(F.zip_with(begin, end, lambda b, e: F.struct(
            b["pos"].alias("s"), b["i"].alias("si"), e["pos"].alias("e"), e["i"].alias("ei"))), pairs)

    def fresh(rows, at, n, s):
        return F.size(F.filter(F.slice(rows, at + 1, n), lambda y: y["prev"] < s))

    def pairs(runs):
        def best(r, k):
            fit = F.filter(F.slice(runs, k + 1, F.col("reach")), lambda x: (
                (x["e"] - r["s"] < F.col("reach")) & (x["ei"] - r["si"] + 1 >= F.col("need"))))
            sized = F.transform(fit, lambda x: F.struct(
                fresh(F.col("hits"), r["si"], x["ei"] - r["si"] + 1, r["s"]).alias("c"),
                fresh(F.col("all"), r["s"], x["e"] - r["s"] + 1, r["s"]).alias("n"), x["e"].alias("e")))
            scored = F.transform(sized, lambda x: F.struct(
                (2 * x["c"] / (x["n"] + F.col("t"))).alias("dice"), (-x["e"]).alias("short"), x["c"].alias("c")))
            return let(F.array_max(F.filter(scored, lambda x: x["dice"] >= threshold)), lambda x: F.when(
                x.isNotNull(), F.struct(r["s"].alias("s"), (-x["short"]).alias("e"), x["c"].alias("c"), x["dice"].alias("dice"))))

        return F.filter(F.transform(runs, best), lambda x: x.isNotNull())

    hits = F.transform(F.filter("all", lambda x: F.array_contains(x["ids"], F.col("template"))), lambda x, i: F.struct(
        x["pos"].alias("pos"), x["prev"].alias("prev"), i.alias("i")))
    # exploded, so that what is worked out once is not repeated where it is named
    found = each.select("*", F.explode(F.array(hits)).alias("hits")).select(
        "rid", "key", "all", "template", "license", F.explode(F.array(tested(F.col("hits")))).alias("found"))
    found = found.select("rid", "key", F.transform(
        apart(F.col("found"), lambda x: F.struct(-x["dice"], x["e"] - x["s"], x["s"])),
        lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), x["c"].alias("c"), x["dice"].alias("dice"), F.col("template").alias("template"),
            F.col("license").alias("license"), F.get(F.col("all"), x["s"])["line"].alias("line")),
    ).alias("found"))
    per_text = found.groupBy("rid").agg(F.first("key").alias("key"), F.flatten(F.collect_list("found")).alias("found"))
    kept = apart(F.col("found"), lambda x: F.struct(-x["c"], -x["dice"], x["e"] - x["s"], x["template"], x["s"]))
    return per_text.select("rid", "key", F.explode(kept).alias("x")).select(
        "rid", "key", "x.line", "x.template", "x.license", "x.dice"
    )


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=None) -> DataFrame:
    """Per passage of a licence its first line, licence and Dice; key, line, license, dice."""
    return passages(docs, key, text, templates).select("rid", "key", "line", "license", "dice")


def op7_licenses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = licenses(docs).groupBy(F.col("key").alias("doc_id")).agg(
        F.countDistinct("line").alias("n_lines"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
        F.round(F.max("dice"), 9).alias("best_dice"),
    )
    return (
        docs.select("doc_id").join(found, "doc_id", "left")
        .select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("licenses", F.lit("")).alias("licenses"), "best_dice")
    )


QUERIES = {"op7_licenses": op7_licenses}

_ROWS = ",\n  ".join("({}, '{}', '{}')".format(i, n, " ".join(plain_words(b))) for i, (n, b) in enumerate(TEMPLATES))

SQL = {
    "op7_licenses": f"""
WITH templates(template, license, body) AS (VALUES
  {_ROWS}
), lines AS (
  SELECT doc_id, unnest(list_transform(string_split(text, chr(10)),
    lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')))) AS body,
    generate_subscripts(string_split(text, chr(10)), 1) AS line
  FROM documents
), cut AS (
  SELECT doc_id, line, string_split(body, ' ') AS w FROM lines
), grams AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM cut WHERE len(w) > 1
), tgrams AS (
  SELECT template, license,
    list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM (SELECT template, license, string_split(body, ' ') AS w FROM templates)
), pairs AS (
  SELECT a.doc_id, a.line, a.n, t.template, t.license, t.n AS m, count(*) AS common
  FROM (SELECT doc_id, line, len(g) AS n, unnest(g) AS gram FROM grams) a
  JOIN (SELECT template, license, len(g) AS n, unnest(g) AS gram FROM tgrams) t USING (gram)
  GROUP BY ALL
), best AS (
  SELECT *, 2 * common / (n + m)::DOUBLE AS dice,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY 2 * common / (n + m)::DOUBLE DESC, template) AS r
  FROM pairs WHERE 2 * common / (n + m)::DOUBLE >= {THRESHOLD}
), found AS (
  SELECT doc_id, count(*) AS n_lines, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
    round(max(dice), 9) AS best_dice
  FROM best WHERE r = 1 GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(licenses, '') AS licenses, best_dice
FROM documents d LEFT JOIN found USING (doc_id)
""",
}
