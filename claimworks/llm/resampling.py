"""Target-distribution importance resampling: n-gram spans from overlapped regular expressions, counted by CRC."""

from __future__ import annotations

import zlib
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import stored, table, width

BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
ROWS_A_BATCH = 256  # documents whose features leave a task together

# Word bytes (digits, letters without case, everything beyond ASCII) stay, all others become a blank.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
BLANKS = regex.compile(rb" {2,}")


def gram_pattern(size: int) -> regex.Pattern:
    """``size`` words one blank apart, found at every word by an overlapped scan."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (size - 1))


def collapsed(text: bytes) -> bytes:
    """Words in lower case, one blank between them."""
    return BLANKS.sub(b" ", text.translate(FOLD))


def feature_task(longest: int, buckets: int):
    """Texts -> number of words, and the bucket of every n-gram of 1 to ``longest`` words, as bytes."""
    patterns = [gram_pattern(size) for size in range(1, longest + 1)]
    step = np.uint16 if buckets <= 1 << 16 else np.uint32
    span = itemgetter(0)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_A_BATCH):
                part = batch.slice(start, ROWS_A_BATCH)
                words, features = [], []
                for text in part.column(part.num_columns - 1):
                    line = collapsed((text.as_py() or "").encode())
                    grams = [list(map(zlib.crc32, map(span, p.finditer(line, overlapped=True)))) for p in patterns]
                    words.append(len(grams[0]))
                    found = np.concatenate([np.array(g, np.int64) for g in grams])
                    features.append((found % buckets).astype(step).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(words, pa.int64()), pa.array(features, pa.binary())],
                    [*part.schema.names[:-1], "words", "features"],
                )

    return run


def count_task(buckets: int):
    """Features of a partition -> one row per bucket that occurs: bucket, n."""
    step = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for features in batch.column(0):
                total += np.bincount(np.frombuffer(features.as_buffer(), step), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return run


def weight_task(gains: np.ndarray, buckets: int):
    """Features -> number of features and sum of their gains."""
    step = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        for batch in batches:
            sizes, weights = [], []
            for features in batch.column(batch.num_columns - 1):
                found = np.frombuffer(features.as_buffer(), step)
                sizes.append(len(found))
                weights.append(int(gains[found].sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())],
                [*batch.schema.names[:-1], "n_features", "weight"],
            )

    return run


def featured(rows: DataFrame, text: str, longest: int, buckets: int, key: str | None = None) -> DataFrame:
    """words and features of every row, and ``k`` where a key is named; null texts have no words."""
    columns = [F.col(key).alias("k")] if key else []
    plain = rows.select(*columns, F.col(text).cast("string").alias("t"))
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema[:-1]] + ["words long", "features binary"])
    return stored(plain.mapInArrow(feature_task(longest, buckets), ddl), "features")


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    counts = features.select("features").mapInArrow(count_task(buckets), "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of every bucket, both with one occurrence added per bucket."""
    both = (
        source.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full_outer")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    counts = both.toArrow()  # one row per bucket
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    held = counts.column("bucket").to_numpy()
    s[held], t[held] = counts.column("s").to_numpy(), counts.column("t").to_numpy()
    above = (t + 1).astype(float) * float(s.sum() + buckets)
    below = (s + 1).astype(float) * float(t.sum() + buckets)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) with u drawn from a hash of the key."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def ranked(rows: DataFrame, order: list[Column], percent: int) -> DataFrame:
    """``rows`` and their rank 1, 2, 3... in the given order, null beyond ``percent`` of them.

    Rows are sorted in ranges; a row's rank is its place in its range and the sizes of the ranges before.
    Only the sizes reach the driver, one number per range.
    """
    spark = rows.sparkSession
    # the place inside a range is the lower part of the id that Spark gives a sorted row
    placed = stored(
        rows.repartitionByRange(width(spark), *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "ranked",
    )
    piece = F.shiftright("place", 33)
    sizes = sorted(placed.groupBy(piece.alias("p")).count().collect())
    total = sum(n for _, n in sizes)
    before, shifts = 0, []
    for p, n in sizes:
        shifts.append((p, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(shifts, "piece long, before long"))  # one row per range
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        placed.withColumn("piece", piece).join(offsets, "piece").withColumn("rank", rank)
        .withColumn("rank", F.when(F.col("rank") <= percent * total // 100, F.col("rank"))).drop("place", "piece", "before")
    )


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    Features are the runs of 1 to ``longest`` words of a whole text, hashed to ``buckets``; weights are sums
    of log ratios of target and source shares; a draw without replacement takes the highest scores (weight
    plus Gumbel noise from a hash of the key) among rows of ``min_words`` or more.  ``rank`` is null for rows that
    are not drawn.  A null or empty text has no features and weight 0; a null key is hashed as an empty one and
    comes last among equal scores; of repeated rows each is drawn by itself; an empty table gives no rows, an
    empty target counts as no features; other columns are ignored.
    """
    features = featured(docs, text, longest, buckets, key)
    aim = featured(target, target_text, longest, buckets)
    gains = gains_of(bucket_counts(features, buckets), bucket_counts(aim, buckets), buckets)
    ddl = f"k {features.schema['k'].dataType.simpleString()}, words long, n_features long, weight long"
    scored = stored(
        features.mapInArrow(weight_task(gains, buckets), ddl).withColumn("score", F.col("weight") + gumbel(F.col("k"), seed)),
        "scores",
    )
    out = ["k", "n_features", "weight", "score", "rank"]
    long_enough = F.col("words") >= min_words
    order = [F.desc("score"), F.asc_nulls_last("k"), F.asc("weight"), F.asc("n_features")]
    drawn = ranked(scored.where(long_enough), order, percent=percent).select(*out)
    rest = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long")).select(*out)
    return drawn.unionByName(rest).withColumnRenamed("k", key)


def op12_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op12_resampling": op12_resampling}

SQL = {
    "op12_resampling": """
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT side, id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM texts
), spelled AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)
), hashed AS (
  SELECT w, xor(4294967295, list_reduce(
    list_transform(range(0, len(h) // 2), lambda i:
      16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295)) % 10000 AS bucket
  FROM spelled, crc
), counted AS (
  SELECT bucket, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS s, sum(side) AS t FROM words JOIN hashed USING (w) GROUP BY bucket
), sums AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM counted
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counted, sums
), weights AS (
  SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights ON doc_id = id
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
""",
}
