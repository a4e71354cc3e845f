"""Exact top-k inner-product search by columnar branch-and-bound."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimworks.llm.common import stored, table

K = 10
SCALE = 1024.0
BLOCK_ROWS = 8192  # candidates of one work unit
QUERY_ROWS = 256  # queries of one work unit
DIM_BLOCK = 16  # dimensions added before the next compaction
EXACT = float(2**52)  # below this, sums in double precision are exact


def quantised(batches):
    """Rows with a usable vector: id and floor(1024 x) per component, as doubles in bytes."""
    for batch in batches:
        ids, col = batch.column(0), batch.column(1)
        out_id, out_vec, out_norm = [], [], []
        values = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
        nulls = np.asarray(col.values.is_null()) if col.values.null_count else None
        offsets = col.offsets.to_numpy()
        valid = np.asarray(col.is_valid()) & np.asarray(ids.is_valid())
        keys = ids.to_pylist()
        for i in np.flatnonzero(valid):
            a, b = offsets[i], offsets[i + 1]
            if nulls is not None and nulls[a:b].any():
                continue
            x = values[a:b]
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                q = np.floor(x * SCALE)
            if not np.isfinite(q).all():
                q = np.floor(np.clip(x, -1e300, 1e300) * SCALE)
            out_id.append(keys[i])
            out_vec.append(q.tobytes())
            out_norm.append(float(np.dot(q, q)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_id, pa.int64()), pa.array(out_vec, pa.binary()), pa.array(out_norm, pa.float64())],
            ["vec_id", "vec", "norm2"],
        )


def matrix(blobs) -> np.ndarray:
    rows = [np.frombuffer(b, np.float64) for b in blobs]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def saturated(row: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Scores too large for double precision, by Python's integers, held to 64 bits."""
    query = [int(v) for v in row]
    top = 2**63 - 1
    return np.array(
        [max(-top - 1, min(top, sum(a * int(b) for a, b in zip(query, other) if a))) for other in others],
        dtype=object,
    )


def block_topk(queries, q_ids, q_rids, cands, c_ids, c_rids, k):
    """The k best candidates of each query inside one block.

    Vertical layout: dimensions are ordered by their weight and added block by block.  After a block,
    Cauchy-Schwarz over the dimensions still open bounds what a candidate can gain or lose; candidates
    whose upper bound lies below the k-th best lower bound leave, and the survivors are compacted.
    """
    dims = max(queries.shape[1], cands.shape[1])
    queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    cands = np.pad(cands, ((0, 0), (0, dims - cands.shape[1])))
    order = np.argsort(-(cands**2).sum(axis=0) if dims else np.zeros(0))
    columns = np.ascontiguousarray(cands[:, order].T)
    queries = queries[:, order]
    biggest = np.sqrt((queries**2).sum(axis=1).max(initial=0) * (cands**2).sum(axis=1).max(initial=0))
    exact = biggest * max(1, dims) < EXACT
    cuts = list(range(0, dims, DIM_BLOCK)) + [dims]
    # mass that is still open after each block of dimensions
    c_open = [np.sqrt((columns[c:] ** 2).sum(axis=0)) for c in cuts[1:]]
    first = cuts[1] if dims else 0
    start = queries[:, :first] @ columns[:first]
    out = []
    for i, row in enumerate(queries):
        if not exact:
            alive = np.arange(len(c_ids))
            scores = saturated(row, columns.T)
        else:
            alive, partial = None, start[i]
            for j in range(1, len(cuts)):
                if j > 1:
                    a, b = cuts[j - 1], cuts[j]
                    block = columns[a:b] if alive is None else columns[a:b, alive]
                    partial = partial + row[a:b] @ block
                if len(partial) > k and cuts[j] < dims:
                    rest = np.sqrt((row[cuts[j]:] ** 2).sum())
                    slack = rest * (c_open[j - 1] if alive is None else c_open[j - 1][alive]) + 1.0
                    # own row may sit among the best, so one more lower bound is asked for
                    at = len(partial) - (k + 1)
                    floor = np.partition(partial - slack, at)[at] if at >= 0 else -np.inf
                    keep = np.flatnonzero(partial + slack >= floor)
                    if len(keep) < 0.8 * len(partial):
                        alive = keep if alive is None else alive[keep]
                        partial = partial[keep]
            if alive is None:
                alive = np.arange(len(c_ids))
            scores = np.rint(partial) if dims else np.zeros(len(alive))
        other = c_rids[alive] != q_rids[i]
        alive, scores = alive[other], scores[other]
        if len(alive) > 4 * k and exact:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = scores >= edge
            alive, scores = alive[near], scores[near]
        best = sorted(zip((-s for s in scores.tolist()), c_ids[alive].tolist(), c_rids[alive].tolist()))[:k]
        out.extend((int(q_rids[i]), int(q_ids[i]), int(c), int(r), int(-s)) for s, c, r in best)
    return out


def unit_topk(k):
    schema = pa.schema(
        [("q_rid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("rid", pa.int64()),
         ("score", pa.int64())]
    )

    def run(unit: pa.Table) -> pa.Table:
        flag = unit.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
        ids, rids = unit.column("vec_id").to_numpy(), unit.column("rid").to_numpy()
        vecs = unit.column("vec").to_pylist()
        rows = []
        if flag.any() and not flag.all():
            q, c = np.flatnonzero(flag), np.flatnonzero(~flag)
            rows = block_topk(
                matrix([vecs[i] for i in q]), ids[q], rids[q], matrix([vecs[i] for i in c]), ids[c], rids[c], k
            )
        cols = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(col, f.type) for col, f in zip(cols, schema)], schema=schema)

    return run


def topk(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = 100,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Best ``k`` other rows by integer inner product for every row whose id is divisible by ``every``.

    Columns: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id, then to the row read
    first.  Rows whose id or vector is null, or whose vector holds a null or non-finite component, take no
    part.  Vectors of different length are compared as if the shorter ended in zeros.  Repeated rows are
    separate candidates, and a repeated query row is answered once per row.  Scores beyond 64 bits are held
    at the end of the range.  An empty table gives no rows; other columns are ignored.

    The query set meets all rows in blocks: a work unit holds at most about ``block_rows`` candidates and
    ``query_rows`` queries, so its memory does not depend on the table's size.
    """
    spark = vectors.sparkSession
    rows = stored(
        vectors.select(F.col(id_col).cast("long").alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
        .mapInArrow(quantised, "vec_id long, vec binary, norm2 double")
        .withColumn("rid", F.monotonically_increasing_id()),
        "vectors",
    )
    is_query = F.col("vec_id") % every == 0
    total, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    parts = max(1, -(-total // block_rows))
    q_parts = max(1, -(-asked // query_rows))
    spread = F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int")
    q_spread = F.pmod(F.xxhash64("rid", F.lit(7)), F.lit(q_parts)).cast("int")
    keep = ["rid", "vec_id", "vec"]
    cands = rows.select(
        *keep, F.lit(False).alias("is_query"), spread.alias("cb"),
        F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1))).alias("qb"),
    )
    queries = rows.where(is_query).select(
        *keep, F.lit(True).alias("is_query"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("cb"),
        q_spread.alias("qb"),
    )
    units = parts * q_parts
    found = (
        cands.unionByName(queries)
        .repartition(max(1, min(units, 4 * spark.sparkContext.defaultParallelism, 100_000)), "cb", "qb")
        .groupBy("cb", "qb")
        .applyInArrow(unit_topk(k), "q_rid long, query_id long, vec_id long, rid long, score long")
    )
    best = Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "rid")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_exact_topk(spark, sf_dir):
    return topk(table(spark, sf_dir, "embeddings"))


QUERIES = {"op8_exact_topk": op8_exact_topk}

SQL = {
    "op8_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
""",
}
