"""Toxic passages as maximum-scoring segments of token log-odds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import stored, table, tidy
from claimworks.llm.words import slab_ranges, text_bytes, word_hashes, word_places

WORD_SLOTS = 1 << 20  # counts are kept per hashed word: a table of fixed size whatever the corpus
PREFIX_SLOTS = 1 << 18  # and per hashed word beginning
PREFIX_BYTES = 4
PRIOR = 4.0  # documents that the prior of a word weighs
PENALTY = 2.0  # taken from every token's log-odds, so that clean text scores below zero
THRESHOLD = 0.7
BINS = 256
SLAB_BYTES = 1 << 20
BROADCAST_LABELS = 1_000_000  # more labelled rows than this are joined by shuffle

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes (A-Z and the capitals of Latin-1) and which bytes belong to words."""
    low = data.copy()
    low[(low >= 65) & (low <= 90)] += 32
    inside = LETTER[low]
    if len(data) > 1:
        after_c3 = np.concatenate([[False], data[:-1] == 0xC3])
        low[after_c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
        # general punctuation (E2 80 xx) and the signs of Latin-1 (C2 xx) are no letters
        at = np.flatnonzero((data[:-1] == 0xE2) & (data[1:] == 0x80))
        for k in range(3):
            inside[np.minimum(at + k, len(data) - 1)] = False
        at = np.flatnonzero(data[:-1] == 0xC2)
        inside[at] = False
        inside[at + 1] = False
    return low, inside


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Document, word slot and prefix slot of every word, and its byte range."""
    low, inside = folded(data)
    edge = np.array([False, True])
    starts, ends, doc = word_places(inside.astype(np.uint8), offsets, edge)
    words = word_hashes(low, starts, ends)
    heads = word_hashes(low, starts, np.minimum(ends, starts + PREFIX_BYTES))
    return doc, (words >> np.uint64(44)).astype(np.int64), (heads >> np.uint64(46)).astype(np.int64), starts, ends


def count_task(batches):
    """(slot, toxic documents, clean documents, clean occurrences); prefix slots follow the word slots."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for a, b in slab_ranges(offsets, SLAB_BYTES):
            part = data[offsets[a]:offsets[b]]
            doc, words, heads, _, _ = tokens(part, offsets[a:b + 1] - offsets[a])
            slots = np.concatenate([words, WORD_SLOTS + heads])
            docs = np.concatenate([doc, doc])
            label = toxic[a:b]
            seen = np.unique(docs * (WORD_SLOTS + PREFIX_SLOTS) + slots)
            who, which = np.divmod(seen, WORD_SLOTS + PREFIX_SLOTS)
            keys, place = np.unique(which, return_inverse=True)
            bad = np.bincount(place, weights=label[who], minlength=len(keys))
            good = np.bincount(place, weights=~label[who], minlength=len(keys))
            clean = slots[~label[docs]]
            times = np.zeros(len(keys))
            np.add.at(times, np.searchsorted(keys, clean), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int32)), *(pa.array(x.astype(np.int64)) for x in (bad, good, times))],
                ["slot", "bad", "good", "times"],
            )


def karlin_lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1, for a background that scores below zero on average."""
    if not weights.sum() or not (scores[weights > 0] > 0).any():
        return 1.0
    p = weights / weights.sum()
    if (p * scores).sum() >= 0:
        return 0.1
    low, high = 0.0, 0.1
    while (p * np.exp(np.minimum(high * scores, 700))).sum() < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * scores, 700))).sum() < 1 else (low, mid)
    return max(0.1, (low + high) / 2)


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first token, one past the last) by the linear Ruzzo-Tompa scan."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, end
    for i in np.flatnonzero(scores > 0).tolist():
        left, right, first = float(total[i]), float(total[i + 1]), i
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j -= 1
            if j < 0 or stack[j][1] >= right:
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((left, right, first, i + 1))
    return [(r - b, f, e) for b, r, f, e in stack]


def repeated(doc: np.ndarray, words: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Tokens in a word's favour that the document has shown before: evidence is counted by document."""
    at = np.flatnonzero(score > 0)
    _, first = np.unique(doc[at] * WORD_SLOTS + words[at], return_index=True)
    later = np.ones(len(at), bool)
    later[first] = False
    return at[later]


def passage_task(model, keep):
    """Word count and the segments of every text, with their code point ranges."""
    def run(batches):
        words_score, heads_score = (np.frombuffer(b, np.float32) for b in model.value)
        for batch in batches:
            data, offsets = text_bytes(batch.column(keep))
            for a, b in slab_ranges(offsets, SLAB_BYTES):
                base = offsets[a:b + 1] - offsets[a]
                part = data[offsets[a]:offsets[b]]
                doc, words, heads, starts, ends = tokens(part, base)
                score = words_score[words]
                unseen = np.isnan(score)
                score[unseen] = heads_score[heads[unseen]]
                again = repeated(doc, words, score)
                score[again] = 0.0
                cuts = np.searchsorted(doc, np.arange(b - a + 1))
                # code points before each byte
                points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                found = []
                for i in range(b - a):
                    lo, hi = cuts[i], cuts[i + 1]
                    zero = points[base[i]]
                    found.append([
                        {"score": s, "start": int(points[starts[lo + f]] - zero), "stop": int(points[ends[lo + e - 1]] - zero)}
                        for s, f, e in segments(score[lo:hi].astype(np.float64))
                    ])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in range(keep)), pa.array(np.diff(cuts).astype(np.int64)),
                     pa.array(found, pa.list_(pa.struct(
                         [("score", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())])))],
                    [*batch.schema.names[:keep], "n_words", "segments"],
                )

    return run


PASSAGES = "n_words long, segments array<struct<score:double,start:long,stop:long>>"


class Model:
    """Scores of hashed words, and the constants of the calibration."""

    def __init__(self, words, heads, lam=1.0, log_k=0.0, a=0.0, b=0.0):
        self.words, self.heads = words.astype(np.float32), heads.astype(np.float32)
        self.lam, self.log_k, self.a, self.b = lam, log_k, a, b

    def passages(self, docs: DataFrame, keys: list[str], text: str) -> DataFrame:
        spark = docs.sparkSession
        shipped = spark.sparkContext.broadcast((self.words.tobytes(), self.heads.tobytes()))  # fixed size
        picked = docs.select(*keys, F.col(text).cast("string").alias("__text"))
        types = ", ".join(f"`{k}` {picked.schema[k].dataType.simpleString()}" for k in keys)
        return picked.mapInArrow(tidy(passage_task(shipped, len(keys))), f"{types}, {PASSAGES}")

    def surplus(self):
        """Sum over segments of what their score exceeds the extreme-value level of a clean text that long."""
        level = self.log_k + F.log(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
        over = F.transform("segments", lambda s: F.greatest(F.lit(0.0), s["score"] * self.lam - level))
        return F.log1p(F.aggregate(over, F.lit(0.0), lambda x, y: x + y))

    def probability(self):
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.a) + F.lit(self.b) * self.surplus())))


def logit(p):
    return np.log(p) - np.log1p(-p)


def word_scores(bad, good, n_bad, n_good):
    """Posterior log-odds of each slot against the base rate; a word's prior is what its beginning says.

    Beta priors, the two-class Dirichlet: ``PRIOR`` documents at the rate of the word's beginning, whose own
    prior is ``PRIOR`` documents at the base rate.
    """
    rate = (n_bad + 1) / (n_bad + n_good + 2)
    prefix = (bad[WORD_SLOTS:] + PRIOR * rate) / (bad[WORD_SLOTS:] + good[WORD_SLOTS:] + PRIOR)
    heads = logit(prefix) - logit(rate) - PENALTY
    b, g = bad[:WORD_SLOTS], good[:WORD_SLOTS]
    with np.errstate(divide="ignore", invalid="ignore"):
        words = np.where(b + g > 0, logit((b + PRIOR * rate) / (b + g + PRIOR)) - logit(rate) - PENALTY, np.nan)
    return words, heads


def logistic(x, bad, good):
    """Slope >= 0 and level of a logistic curve through counted bins, held by one pseudo row of each class.

    Newton steps on the penalised likelihood, each halved until it gains.
    """
    x = np.concatenate([x, [x.max(initial=1.0) or 1.0, 0.0]])
    bad, good = np.concatenate([bad, [1.0, 0.0]]), np.concatenate([good, [0.0, 1.0]])
    scale = max(1e-9, float(np.abs(x).max()))
    design = np.stack([np.ones_like(x), x / scale], axis=1)

    def loss(beta):
        z = design @ beta
        return float((bad * np.logaddexp(0, -z) + good * np.logaddexp(0, z)).sum() + 1e-3 * beta @ beta)

    beta = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        grad = design.T @ (bad - (bad + good) * p) - 2e-3 * beta
        hess = (design * ((bad + good) * p * (1 - p))[:, None]).T @ design + 2e-3 * np.eye(2)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(beta + size * step) > loss(beta):
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    if beta[1] < 0:
        return float(logit((bad.sum()) / (bad.sum() + good.sum()))), 0.0
    return float(beta[0]), float(beta[1] / scale)


def fit(rows: DataFrame, fold) -> Model:
    """Learn from ``rows`` (text, toxic boolean); ``fold`` is true for the quarter that calibrates.

    Counts run over all other labelled rows and reach the driver as a table of fixed size; the calibrating
    quarter is scored with them and reaches it as the counts of ``BINS`` bins.  Without a row of either class
    all scores are the base rate.
    """
    rows = rows.withColumn("__cal", fold)
    # one pass for the size of both classes and the counts of all slots
    n = {bool(r[0]): r[1] for r in rows.where(~F.col("__cal")).groupBy("toxic").count().collect()}
    n_bad, n_good = n.get(True, 0), n.get(False, 0)
    counts = (
        rows.where(~F.col("__cal")).select(F.col("text").cast("string"), F.col("toxic"))
        .mapInArrow(tidy(count_task), "slot int, bad long, good long, times long")
        .groupBy("slot").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.sum("times").alias("times"))
    )
    got = counts.toArrow()  # at most WORD_SLOTS + PREFIX_SLOTS rows
    bad, good, times = (np.zeros(WORD_SLOTS + PREFIX_SLOTS) for _ in range(3))
    at = got.column("slot").to_numpy()
    for array, name in ((bad, "bad"), (good, "good"), (times, "times")):
        array[at] = got.column(name).to_numpy()
    words, heads = word_scores(bad, good, n_bad, n_good)
    model = Model(words, heads)
    seen = ~np.isnan(words)
    model.lam = karlin_lambda(words[seen], times[:WORD_SLOTS][seen])
    base = (n_bad + 1) / (n_bad + n_good + 2)
    model.a = float(logit(base))
    if not n_bad or not n_good:
        return model
    trial = stored(model.passages(rows.where("__cal"), ["toxic"], "text"), "toxicity")
    best = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0)) * model.lam
    spread = best - F.log(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
    mean = trial.where(~F.col("toxic")).agg(F.avg(spread)).first()[0]
    # mean of the extreme-value law: log K + Euler's constant
    model.log_k = float(mean) - 0.5772156649 if mean is not None else 0.0
    bin_ = F.floor(model.surplus() * 32).cast("int")
    hist = trial.groupBy(F.least(bin_, F.lit(BINS - 1)).alias("x")).agg(
        F.count(F.when(F.col("toxic"), 1)), F.count(F.when(~F.col("toxic"), 1))
    ).collect()
    if hist:
        x, b, g = (np.array(c, float) for c in zip(*hist))
        model.a, model.b = logistic(x / 32, b, g)
    return model


def remainder(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary"))


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts with a label: key, text, toxic.  Rows with a null label or key take no part."""
    marks = labels.select(F.col(key).alias("k"), (F.col("toxic") == 1).alias("toxic")).where("k is not null and toxic is not null")
    if marks.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    return docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(marks, "k")


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``score`` (0 to 1) and ``segments`` (score, start, stop in code points) per row.

    Labels are learned only from rows whose crc32 of the key as text leaves another remainder than 1 by 3.
    Only the text is an input of a score; a null or empty text has no segments and gets the level of such
    texts.  Repeated rows are scored each, rows with a null key are scored and not held out, an empty table
    gives no rows, and other columns are ignored.
    """
    rest = remainder("k")
    rows = labelled(docs, labels, key, text).where(rest % 3 != 1)
    model = fit(rows, F.floor(rest / 3) % 4 == 0)
    found = model.passages(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), ["k"], "t")
    held = F.coalesce(rest % 3 == 1, F.lit(False))
    return found.select(
        F.col("k").alias(key), held.alias("held_out"), model.probability().alias("score"), "segments"
    )


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below ``THRESHOLD``; learned as ``score`` does."""
    rest = remainder("k")
    model = fit(labelled(docs, labels, key, text).where(rest % 3 != 1), F.floor(rest / 3) % 4 == 0)
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = model.passages(docs.toDF(*names), names, names[docs.columns.index(text)])
    return found.where(model.probability() < THRESHOLD).select(*names).toDF(*docs.columns)


def op10_toxicity(spark, sf_dir):
    rows = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op10_toxicity": op10_toxicity}
