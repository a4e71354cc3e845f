"""Exact duplicates: fixed-size blocks sorted into integer names, adjacent pairs of names named again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.common import stored, table, width

BLOCK = 4096  # bytes
PART_BITS = 20  # names are ranks inside 2**20 parts
RANK_BITS = 40


def hot_keys(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """Hashes of the keys that more than a task's fair share of the rows hold: fewer than there are tasks."""
    counts = stored(rows.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count("*").alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > max(2, total // width(rows.sparkSession))).select("h")
    return hot, not hot.isEmpty()


def named(rows: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """``rows`` with the keys replaced by ``name``: a whole number, the same for equal keys and for no others.

    Rows are dealt by a hash of their keys, sorted and numbered: part and rank make the name, so every row
    moves once and nothing is joined.  Keys that many rows share are named beforehand from their distinct
    values (negative names, broadcast: fewer than there are tasks); their rows move without their keys,
    dealt by ``spread``.
    """
    part = F.shiftrightunsigned(F.xxhash64(*keys), 64 - PART_BITS)
    hot, any_hot = hot_keys(rows, keys)
    rank = F.shiftleft("part", RANK_BITS) + F.dense_rank().over(Window.partitionBy("part").orderBy(*keys)).cast("long")
    if not any_hot:
        return rows.withColumn("part", part).withColumn("name", rank).drop("part", *keys)
    first = (
        rows.select(*keys).join(F.broadcast(hot), F.xxhash64(*keys) == F.col("h"), "left_semi").distinct()
        .withColumn("hot_name", -F.row_number().over(Window.orderBy(*keys)).cast("long"))
    )
    known = rows.join(F.broadcast(first), keys, "left")
    cold = F.col("hot_name").isNull()
    deal = F.shiftrightunsigned(F.xxhash64(*spread), 64 - PART_BITS)
    dealt = known.withColumn("part", F.when(cold, part).otherwise(deal))
    dealt = dealt.select(*[F.when(cold, F.col(k)).alias(k) if k in keys else F.col(k) for k in dealt.columns])
    return dealt.withColumn("name", F.coalesce("hot_name", rank)).drop("part", "hot_name", *keys)


def blocks(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """Every fixed-size block of every row: row, pos, n (blocks of the row), key and sha (on the first), block."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("n"), F.lit(1)) - 1),
        lambda i: F.substring(F.col("body"), i * BLOCK + 1, F.lit(BLOCK)),
    )
    first = F.col("pos") == 0
    return (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), body.alias("t"))
        .select("row", "key", F.sha2(F.col("t").cast("binary"), 256).alias("sha"), F.col("t").cast("binary").alias("body"))
        .withColumn("n", F.ceil(F.octet_length("body") / BLOCK).cast("int"))
        .select("row", "key", "sha", F.greatest(F.col("n"), F.lit(1)).alias("n"), F.posexplode(parts).alias("pos", "block"))
        .select("row", "pos", "n", F.when(first, F.col("key")).alias("key"), F.when(first, F.col("sha")).alias("sha"), "block")
    )


def identities(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """row, key, sha, level and name per row; rows have the same level and name if their texts are equal, only then.

    A text of n blocks has its one name after log2(n) levels, and texts of other lengths in levels than that
    end elsewhere; an odd block at the end is paired with nothing (0, which no name is).
    """
    base = stored(named(blocks(docs, key, text), ["block"], ["row", "pos"]), "blocks")
    longest = base.agg(F.max("n")).first()[0] or 1
    level, names = base.select("row", "pos", "n", "name"), []
    for depth in range((longest - 1).bit_length() + 1):
        names.append(level.where("n = 1").select("row", F.lit(depth).alias("level"), "name"))
        if depth == (longest - 1).bit_length():
            break
        even = F.col("pos") % 2 == 0
        pairs = stored(
            level.where("n > 1").groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.ceil(F.max("n") / 2).cast("int").alias("n"), F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(0)).alias("right"),
            ), "pairs",
        )
        level = stored(named(pairs, ["left", "right"], ["row", "pos"]), "names")
    found = names[0]
    for more in names[1:]:
        found = found.unionByName(more)
    return base.where("pos = 0").select("row", "key", "sha").join(found, "row")


def exact_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row.

    Texts are equal if they are identical after ``normalise``; null counts as empty, and empty texts are
    equal.  Of equal texts the row with the largest key stays, and of repeated rows with that key exactly
    one; a null key is smaller than any other.  Texts of any length are compared whole, no hash decides.
    An empty table gives no rows; other columns are ignored.
    """
    rows = stored(identities(docs, key, normalise(F.col(text))), "identities")
    best = F.max(F.struct("key", (-F.col("row")).alias("row"))).alias("best")
    groups = stored(rows.groupBy("level", "name").agg(F.count("*").alias("size"), best).where("size > 1"), "groups")
    share = max(2, rows.count() // width(docs.sparkSession))
    few = F.broadcast(groups.where(F.col("size") > share))  # fewer groups than tasks
    large = rows.join(few, ["level", "name"])
    others = rows.join(few.select("level", "name"), ["level", "name"], "left_anti").join(
        groups.where(F.col("size") <= share), ["level", "name"], "left"
    )
    alone = F.col("size").isNull()
    return large.unionByName(others).select(
        F.col("key").alias(key), F.when(alone, F.col("key")).otherwise(F.col("best.key")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == -F.col("best.row"))).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def op13_exact_dedup(spark, sf_dir):
    return exact_copies(table(spark, sf_dir, "documents"))


QUERIES = {"op13_exact_dedup": op13_exact_dedup}

SQL = {
    "op13_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""",
}
