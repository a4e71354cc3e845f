"""Document fingerprints from closed syncmers, compared by position."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import table, width
from claimworks.llm.words import MIX1, STEP, mix

K = 12  # code points of a k-mer
S = 4  # code points of the inner substrings
SIZE = 192  # anchors kept of a text at least, those with the smallest hashes, or all if it has fewer
BOUND = 2**64 // 8  # every anchor below this hash is kept as well, so that fingerprints grow with their texts
EMPTY = "-"


def anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers of a text given as code points.

    A k-mer is chosen if the smallest of its inner s-mers is its first or last one; the choice depends on
    the k-mer alone, so an edit moves only anchors that touch it.  A text shorter than a k-mer is one
    anchor.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    points = points.astype(np.uint64)
    if n < K:
        acc = np.uint64(n)
        for p in points.tolist():
            acc = mix(np.array([acc ^ np.uint64(p)], np.uint64) * STEP)[0]
        return np.zeros(1, np.int64), np.array([acc], np.uint64)
    with np.errstate(over="ignore"):
        inner = np.zeros(n - S + 1, np.uint64)
        for j in range(S):
            inner = inner * MIX1 + points[j:n - S + 1 + j] * STEP
        inner = mix(inner)
        count = n - K + 1
        span = K - S  # the last inner substring of a k-mer starts here
        # sliding minimum by doubling
        low, have = inner, 1
        while have * 2 <= span + 1:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        rest = span + 1 - have
        if rest:
            low = np.minimum(low[:-rest], low[rest:])
        low = low[:count]
        chosen = np.flatnonzero((inner[:count] == low) | (inner[span:span + count] == low))
        whole = np.zeros(len(chosen), np.uint64)
        for j in range(0, K, S):
            whole = whole * MIX1 + inner[chosen + j]
        return chosen, mix(whole)


def sketch(text: str) -> list[tuple[int, int]]:
    """(hash, position) of the anchors below ``BOUND``, at least the ``SIZE`` smallest ones or all there are.

    A repeated anchor counts at its first place.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at, hashes = anchors(points)
    if not len(at):
        return []
    values, first = np.unique(hashes, return_index=True)
    n = max(SIZE, int(np.searchsorted(values, np.uint64(BOUND))))
    return list(zip(values[:n].tolist(), at[first[:n]].tolist()))


def complete_to(fingerprint: list[tuple[int, int]]) -> int:
    """The hash below or at which a fingerprint holds every anchor of its text."""
    return max(fingerprint[-1][0], BOUND - 1) if len(fingerprint) >= SIZE else 2**64


def shown(fingerprint: list[tuple[int, int]]) -> str:
    """The fingerprint as text: hash and position of each anchor in hexadecimal, ``-`` for no anchor."""
    return ".".join(f"{h >> 32:08x}:{p:x}" for h, p in fingerprint) or EMPTY


def likeness(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> float:
    """Share of anchors that two fingerprints have in common in the same order, 0 to 1.

    Both are cut to the hashes that either could hold, so that texts of different size are compared fairly;
    of the common anchors the longest run with rising positions in both counts.  Equal fingerprints, two
    empty ones included, give 1, and one empty fingerprint gives 0.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    edge = min(complete_to(a), complete_to(b))
    left, right = {h: p for h, p in a if h <= edge}, {h: p for h, p in b if h <= edge}
    pairs = sorted((p, right[h]) for h, p in left.items() if h in right)
    tails: list[int] = []
    for _, p in pairs:
        at = bisect_left(tails, p)
        tails[at:at + 1] = [p]
    return 2 * len(tails) / (len(left) + len(right))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many (or all) first ones of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


COLUMNS = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]


def described(text, mine, following, theirs):
    changed = edited(text, following)
    after = mine if changed == text else sketch(changed)
    return (
        len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), shown(mine), shown(after),
        likeness(mine, after), likeness(mine, theirs),
    )


def walk(batches):
    """Rows of a partition in order of their part, then descending key; guests only end a part."""
    held = None  # the row whose follower is awaited: part, key, text, sketch
    for batch in batches:
        parts, keys, guests, texts = (batch.column(i).to_pylist() for i in range(4))
        out_keys, out = [], []
        for part, key, guest, text in zip(parts, keys, guests, texts):
            text = text or ""
            mine = None
            if held is not None and held[0] == part:
                mine = sketch(text)
                out_keys.append(held[1])
                out.append(described(held[2], held[3], text, mine))
                held = None
            if not guest:
                held = (part, key, text, sketch(text) if mine is None else mine)
        cols = list(zip(*out)) or [()] * len(COLUMNS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_keys, batch.schema.field(1).type), *(pa.array(c, t) for c, (_, t) in zip(cols, COLUMNS))],
            ["doc_id", *(n for n, _ in COLUMNS)],
        )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", rows_per_part: int = 4096) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, with their likeness and that to the next text.

    The next row is the one before it in ascending order of the integer key, the last one's is the first; a
    single row is its own next.  Null texts are empty; rows with equal keys follow one another by text, and
    rows with null keys come last.  Equal texts have equal fingerprints.  An empty table gives no rows, and
    other columns are ignored.

    The key range is cut by counted histogram into parts of bounded size.  One shuffle brings every text to
    its part, and the first row of each part is sent to the part before it as well, so that a row meets its
    follower without any global order in one task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    low, high, total = rows.agg(F.min("k"), F.max("k"), F.count("*")).first()
    parts = max(1, min(-(-total // rows_per_part), 100_000))
    if low is None:
        low = high = 0
    # equi-depth bounds over the keys, at most one number per part
    bounds = rows.agg(
        F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], 10 * parts).alias("b")
    ).first()["b"] or []
    bounds = spark.sparkContext.broadcast(np.array(sorted(set(bounds)), np.int64))  # one number per part

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        """Part 0 holds the largest keys; null keys come after all others."""
        n = len(bounds.value)
        known = n - np.searchsorted(bounds.value, keys.fillna(0).astype("int64"), "left")
        return pd.Series(np.where(keys.isna(), n + 1, known).astype("int32"))

    placed = rows.withColumn("p", part_of("k"))
    heads = [
        (r["p"], r["m"]) for r in placed.groupBy("p").agg(F.max("k").alias("m")).orderBy("p").collect()
    ]  # one row per part
    guests = spark.createDataFrame(
        [(heads[i - 1][0], p, m) for i, (p, m) in enumerate(heads)], "before int, p int, m long"
    )
    visits = (
        placed.join(F.broadcast(guests), "p")  # one row per part
        .select(
            F.explode(
                F.when(
                    F.col("k").eqNullSafe(F.col("m")),
                    F.array(
                        F.struct(F.col("p").alias("p"), F.lit(False).alias("g")),
                        F.struct(F.col("before").alias("p"), F.lit(True).alias("g")),
                    ),
                ).otherwise(F.array(F.struct(F.col("p").alias("p"), F.lit(False).alias("g"))))
            ).alias("v"), "k", "t",
        )
        .select(F.col("v.p").alias("p"), "k", F.col("v.g").alias("g"), "t")
    )
    # tasks grow with the table: about one part each
    ordered = visits.repartition(max(width(spark), len(heads)), "p").sortWithinPartitions(
        "p", "g", F.col("k").desc_nulls_last(), F.coalesce("t", F.lit(""))
    )
    types = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    return ordered.mapInArrow(walk, "doc_id long, " + ", ".join(f"{n} {types[t]}" for n, t in COLUMNS))


def op6_fingerprints(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op6_fingerprints": op6_fingerprints}
