"""Jaccard join over word shingles: T-occurrence search with DivideSkip inside bounded work units."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import discard, stored, table, tidy, width
from claimworks.llm.words import STEP, mix, slab_ranges, text_bytes, word_hashes, word_places

WORDS = 5
NUMERATOR, DENOMINATOR = 4, 5  # sets link at this Jaccard similarity or more
SLAB_BYTES = 2 << 20
UNIT_MASS = 1 << 21  # shingles of one work unit; a larger group is split over several units
LEADERS = 8  # sets of a split group that every one of its units sees
ROUNDS = 3  # least hashes by which sets meet, before the exact pass over what these meetings leave open
COMMON_HOLDERS = 8  # sets that make a shingle a common one
COMMON = 1 << 20  # the most common shingles, put last in the global order; an order, not a filter
DOMINANT = 16  # members from which the largest component of a group is visited instead of sent along
BROADCAST_ROWS = 2_000_000  # more surviving texts than this are found by a shuffle
SCALE_STEP = 1.3  # sizes are compared by their place on this scale; partners differ by less than a step
SKIP_MU = 0.0085  # DivideSkip's balance between merging and probing

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def least_overlap(n: int) -> int:
    """Shingles a set of ``n`` must share with any partner."""
    return -(-NUMERATOR * n // DENOMINATOR)


def slack(n: int) -> int:
    return max(1, n // 10)


def shingle_sets(data: np.ndarray, offsets: np.ndarray):
    """For every document of a slab its distinct shingle hashes in ascending order."""
    starts, ends, doc = word_places(data, offsets, IS_WORD)
    low = data.copy()
    low[(low >= 65) & (low <= 90)] += 32
    words = word_hashes(low, starts, ends)
    cuts = np.searchsorted(doc, np.arange(len(offsets)))
    sizes = np.diff(cuts)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for j in range(WORDS):
            rolled = (rolled ^ words[j:j + len(rolled)]) * np.uint64(0x9FB21C651E98DF25) + STEP
            rolled ^= rolled >> np.uint64(29)
        rolled = mix(rolled)
        for i, n in enumerate(sizes.tolist()):
            at = cuts[i]
            if n >= WORDS:
                yield np.unique(rolled[at:at + n - WORDS + 1])
            elif n:
                whole = np.uint64(n)
                for w in words[at:at + n]:
                    whole = mix(np.array([(whole ^ w) * np.uint64(0xD6E8FEB86659FD93) + STEP], np.uint64))[0]
                yield np.array([whole])
            else:
                yield np.zeros(0, np.uint64)


def set_id(hashes: np.ndarray) -> int:
    """64 bits that stand for a set."""
    if not len(hashes):
        return 0
    with np.errstate(over="ignore"):
        both = mix(hashes + STEP).sum(dtype=np.uint64) ^ mix(np.bitwise_xor.reduce(hashes, keepdims=True) + np.uint64(len(hashes)))
    return int(both.view(np.int64)[0])


def prefix_size(n: int) -> int:
    return n - least_overlap(n) + slack(n)


def needed(n: int) -> int:
    """Shared prefix shingles without which a set of ``n`` has no partner (partners hold 0.8 n or more)."""
    return slack(least_overlap(n))


SCAN = pa.schema([
    ("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("cid", pa.int64()), ("tkey", pa.int64()),
    ("bucket", pa.int32()), ("slab", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary()), ("cids", pa.binary()),
])
SCAN_DDL = (
    "kind int, doc_id long, n long, cid long, tkey long, bucket int, slab long, tokens binary, owners binary, cids binary"
)
META, BLOB, LOCAL, HOT = range(4)


def scan_rows(kind, **cols) -> pa.RecordBatch:
    size = len(next(iter(cols.values())))
    arrays = [
        pa.array([kind] * size, pa.int32()) if f.name == "kind"
        else pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(size, f.type)
        for f in SCAN
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=SCAN)


def slab_numbers():
    """Numbers for the slabs of a task that no other task gives."""
    context = TaskContext.get()
    return itertools.count((context.partitionId() if context else 0) << 32)


def scan_task(buckets):
    """One pass over the texts.

    META: size and set id of every document.  BLOB: prefix shingles by bucket, cut to 32 bits, as this only
    narrows down who may have a partner.  LOCAL: shared prefix shingles already seen in the slab.
    """
    def run(batches):
        numbers = slab_numbers()
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            data, offsets = text_bytes(batch.column(2))
            for a, b in slab_ranges(offsets, SLAB_BYTES):
                sets = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                sizes, cids, own, parts = [], [], {}, []
                for hashes in sets:
                    n, cid = len(hashes), set_id(hashes)
                    sizes.append(n)
                    cids.append(cid if n else None)
                    if n and cid not in own:
                        own[cid] = len(own)
                        parts.append(hashes[:prefix_size(n)])
                yield scan_rows(META, doc_id=ids.slice(a, b - a), n=sizes, cid=cids, tkey=keys.slice(a, b - a))
                if parts:
                    yield from prefix_rows(parts, np.fromiter(own, np.int64, len(own)), buckets, next(numbers))

    return run


def prefix_rows(parts, cids, buckets, slab, hot=False):
    tokens = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p) for p in parts])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    heads = np.flatnonzero(first)
    count = np.diff(np.append(heads, len(tokens)))
    rank = np.arange(len(tokens)) - np.repeat(heads, count)
    # of a shingle shared inside the slab two holders travel; the others know already that it is shared
    known = owner[rank >= 2]
    if len(known):
        who, times = np.unique(known, return_counts=True)
        yield scan_rows(LOCAL, slab=[slab], cids=[cids[who].tobytes()], tokens=[times.astype(np.uint32).tobytes()])
    more = count > 2
    if hot and more.any():
        names = short_key(tokens[heads[more]], buckets)
        yield scan_rows(HOT, slab=[slab], cids=[names.tobytes()], tokens=[(count[more] - 2).astype(np.uint32).tobytes()])
    travel = rank < 2
    tokens, owner = tokens[travel], owner[travel]
    bucket = bucket_of(tokens, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, tokens, owner = bucket[order], tokens[order], owner[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
    rows = {"bucket": [], "tokens": [], "owners": [], "cids": []}
    for k in range(buckets):
        lo, hi = cuts[k], cuts[k + 1]
        if lo < hi:
            who, place = np.unique(owner[lo:hi], return_inverse=True)
            rows["bucket"].append(k)
            rows["tokens"].append(tokens[lo:hi].astype(np.uint32).tobytes())
            rows["owners"].append(place.astype(np.uint32 if len(who) > 0xFFFF else np.uint16).tobytes())
            rows["cids"].append(cids[who].tobytes())
    yield scan_rows(BLOB, slab=[slab] * len(rows["bucket"]), **rows)


def whole_task(buckets):
    """BLOB, LOCAL and HOT rows for all shingles of the sets."""
    def run(batches):
        numbers = slab_numbers()
        for batch in batches:
            cids, parts, held, names = batch.column(0).to_pylist(), [], 0, []
            for i, cid in enumerate(cids):
                parts.append(np.frombuffer(batch.column(1)[i].as_py(), np.uint64))
                names.append(cid)
                held += len(parts[-1])
                if held > SLAB_BYTES // 4 or i + 1 == len(cids):
                    yield from prefix_rows(parts, np.array(names, np.int64), buckets, next(numbers), hot=True)
                    parts, names, held = [], [], 0

    return run


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def short_key(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and low half of a shingle: what the first pass knows it by."""
    return (bucket_of(tokens, buckets) << 32) | (tokens & np.uint64(0xFFFFFFFF)).astype(np.int64)


def sums_of(names: list, counts: list) -> pa.RecordBatch:
    who, place = np.unique(np.concatenate(names), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(who), pa.array(total)], ["cid", "n"])


SHARES = "kind int, slab long, cids binary, tokens binary"


def share_task(hot):
    """Rows in order of bucket -> for every slab how many shingles of its sets other sets hold too; common shingles."""
    def row(kind, slab, names, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], pa.int32()), pa.array([slab], pa.int64()), pa.array([names.astype(np.int64).tobytes()], pa.binary()),
             pa.array([counts.astype(np.uint32).tobytes()], pa.binary())], ["kind", "slab", "cids", "tokens"],
        )

    def closed(bucket, parts):
        tokens = np.concatenate([p[1] for p in parts])
        cids = np.concatenate([p[2][p[3]] for p in parts])
        part = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        order = np.argsort(tokens, kind="stable")
        tokens, cids, part = tokens[order], cids[order], part[order]
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        size = np.diff(np.append(heads, len(tokens)))
        varied = np.repeat(np.minimum.reduceat(cids, heads) != np.maximum.reduceat(cids, heads), size)
        many = size >= COMMON_HOLDERS
        if hot and many.any():
            yield row(HOT, bucket, (np.int64(bucket) << 32) | tokens[heads[many]].astype(np.int64), size[many])
        cids, part = cids[varied], part[varied]
        order = np.lexsort((cids, part))
        cids, part = cids[order], part[order]
        if len(cids):
            heads = np.flatnonzero(np.concatenate([[True], (cids[1:] != cids[:-1]) | (part[1:] != part[:-1])]))
            times, cids, part = np.diff(np.append(heads, len(cids))), cids[heads], part[heads]
            cuts = np.searchsorted(part, np.arange(len(parts) + 1)).tolist()
            for i, (slab, *_) in enumerate(parts):
                if cuts[i] < cuts[i + 1]:
                    yield row(LOCAL, slab, cids[cuts[i]:cuts[i + 1]], times[cuts[i]:cuts[i + 1]])

    def run(batches):
        held, parts = None, []
        for batch in batches:
            for bucket, slab, tokens, owners, cids in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if bucket != held and parts:
                    yield from closed(held, parts)
                    parts = []
                held = bucket
                tokens, cids = np.frombuffer(tokens, np.uint32), np.frombuffer(cids, np.int64)
                step = np.uint16 if len(owners) == 2 * len(tokens) else np.uint32
                parts.append((slab, tokens, cids, np.frombuffer(owners, step)))
        if parts:
            yield from closed(held, parts)

    return run


def sum_task(batches):
    """Rows in order of slab (slab, cids, counts) -> cid, n: one row per set and slab."""
    held, names, counts = None, [], []
    for batch in batches:
        for slab, cids, times in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if slab != held and names:
                yield sums_of(names, counts)
                names, counts = [], []
            held = slab
            names.append(np.frombuffer(cids, np.int64))
            counts.append(np.frombuffer(times, np.uint32))
    if names:
        yield sums_of(names, counts)


SETS = "cid long, n long, labels array<long>, shingles binary"


def set_task(batches):
    """Sets with the labels by which they meet: the least hash of their shingles, under several hashes."""
    seeds = mix(np.arange(1, ROUNDS, dtype=np.uint64) * STEP)
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for a, b in slab_ranges(offsets, SLAB_BYTES):
            rows = {"cid": [], "n": [], "labels": [], "shingles": []}
            for hashes in shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]):
                if len(hashes):
                    rows["cid"].append(set_id(hashes))
                    rows["n"].append(len(hashes))
                    labels = [hashes[0], *(mix(hashes ^ seed).min() for seed in seeds)]
                    rows["labels"].append(np.array(labels, np.uint64).view(np.int64))
                    rows["shingles"].append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["cid"], pa.int64()), pa.array(rows["n"], pa.int64()),
                 pa.array(rows["labels"], pa.list_(pa.int64())), pa.array(rows["shingles"], pa.binary())], list(rows),
            )


def prefix_task(common, buckets):
    """Sets -> cid, n, token, near: the prefix in the global order, common shingles last and the most common at the end.

    Partners share ``needed`` shingles of this prefix, and one of its first part (``near``).
    """
    def run(batches):
        names, rank = (np.frombuffer(part, np.int64) for part in common.value)
        for batch in batches:
            owners, sizes, tokens, near = [], [], [], []
            for cid, n, shingles in zip(*(batch.column(i).to_pylist() for i in range(3))):
                hashes = np.frombuffer(shingles, np.uint64)
                late = np.zeros(n, np.int64)
                if len(names):
                    keys = short_key(hashes, buckets)
                    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
                    late = np.where(names[at] == keys, rank[at], 0)
                prefix = hashes[np.argsort(late, kind="stable")[:prefix_size(n)]]
                owners.append(np.full(len(prefix), cid))
                sizes.append(np.full(len(prefix), n))
                tokens.append(prefix.view(np.int64))
                near.append(np.arange(len(prefix)) <= n - least_overlap(n))
            if owners:
                columns = [pa.array(np.concatenate(c)) for c in (owners, sizes, tokens, near)]
                yield pa.RecordBatch.from_arrays(columns, ["cid", "n", "token", "near"])

    return run


# ---- search inside one work unit


def similar(shared, n, m):
    return DENOMINATOR * shared >= NUMERATOR * (n + m - shared)


class Index:
    """Inverted lists over the shingles of a unit's sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        self.values, place = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.argsort(place, kind="stable")
        self.holders = owner[order]  # ascending inside each list
        self.ends = np.cumsum(np.bincount(place, minlength=len(self.values)))
        self.places = np.split(place, np.cumsum(self.sizes)[:-1]) if sets else []

    def lists(self, places):
        ends = self.ends[places]
        return np.where(places > 0, self.ends[places - 1], 0), ends

    def known(self, tokens: np.ndarray) -> np.ndarray:
        """Places of those of some shingles that the index holds."""
        if not len(self.values):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.values, tokens), len(self.values) - 1)
        return at[self.values[at] == tokens]

    def overlaps(self, places: np.ndarray) -> np.ndarray:
        """Shingles shared with every set, one pass over all sets: cheap only for a few queries."""
        marked = np.zeros(len(self.values), np.int64)
        marked[places] = 1
        total = np.concatenate([[0], np.cumsum(marked[np.concatenate(self.places)])])
        ends = np.cumsum(self.sizes)
        return total[ends] - total[ends - self.sizes]

    def search(self, places: np.ndarray, n: int, open_: np.ndarray) -> list[int]:
        """Sets marked ``open_`` that share the required overlap with a query of ``n`` shingles.

        DivideSkip: the L longest lists are set aside, the others are merged and counted, sets that occur
        often enough to get there with L more are looked up in the long lists by binary search.
        """
        least = least_overlap(n)
        if len(places) < least:
            return []
        starts, ends = self.lists(places)
        length = ends - starts
        order = np.argsort(length, kind="stable")
        starts, ends, length = starts[order], ends[order], length[order]
        long = min(int(least / (SKIP_MU * math.log2(max(2, length[-1])) + 1)), least - 1)
        short = len(places) - long
        merged = np.concatenate([self.holders[s:e] for s, e in zip(starts[:short].tolist(), ends[:short].tolist())])
        merged = merged[open_[merged]]
        found, count = np.unique(merged, return_counts=True)
        keep = count >= least - long
        found, count = found[keep], count[keep]
        fits = (DENOMINATOR * self.sizes[found] >= NUMERATOR * n) & (NUMERATOR * self.sizes[found] <= DENOMINATOR * n)
        found, count = found[fits], count[fits]
        for k, (s, e) in enumerate(zip(starts[short:].tolist(), ends[short:].tolist())):
            if not len(found):
                return []
            # shortest long lists first; sets that can no longer get there leave
            at = np.searchsorted(self.holders[s:e], found)
            count = count + (self.holders[s:e][np.minimum(at, e - s - 1)] == found)
            alive = count + (long - k - 1) >= least
            found, count = found[alive], count[alive]
        return found[similar(count, n, self.sizes[found])].tolist()


def join_unit(comps, sets, guests=()) -> list[tuple[int, int]]:
    """Links between components, enough to connect all whose sets are linked.

    ``guests`` (component, set) are compared with the unit's sets only, not with one another.
    """
    names, roots = np.unique([*comps, *(g[0] for g in guests)], return_inverse=True)
    if len(names) < 2:
        return []
    index, m, made = Index(sets), len(sets), []
    own = roots.copy()

    def join(a, b):
        if roots[a] != roots[b]:
            made.append((int(names[own[a]]), int(names[own[b]])))
            roots[roots == roots[b]] = roots[a]

    if guests:
        for g, (_, tokens) in enumerate(guests, m):
            open_ = roots[:m] != roots[g]
            if open_.any():
                for j in index.search(index.known(tokens), len(tokens), open_):
                    join(g, j)
        return made
    # the sets whose shingles are most common in the unit tend to be what the others were copied from
    common = np.diff(np.concatenate([[0], index.ends]))
    weight = np.array([common[p].mean() for p in index.places])
    tried = np.argsort(-weight, kind="stable")[:3].tolist()
    for i in tried:
        shared = index.overlaps(index.places[i])
        for j in np.flatnonzero(similar(shared, index.sizes[i], index.sizes)).tolist():
            join(i, j)
    most = np.bincount(roots).argmax()
    for i in range(m):
        if roots[i] != most and i not in tried:
            for j in index.search(index.places[i], int(index.sizes[i]), roots != roots[i]):
                join(i, j)
    return made


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def unit_task(batches):
    """Rows in order of unit (label, sub): comp, guest, shingles -> links between components."""
    def closed(rows):
        own = [r for r in rows if not r[1]]
        guests = [(r[0], np.frombuffer(r[2], np.int64)) for r in rows if r[1]]
        if len(own) + len(guests) < 2 or not own:
            return
        edges = join_unit([r[0] for r in own], [np.frombuffer(r[2], np.int64) for r in own], guests)
        if edges:
            a, b = zip(*edges)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=EDGES)

    held, rows = None, []
    for batch in batches:
        for label, sub, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (label, sub) != held:
                yield from closed(rows)
                held, rows = (label, sub), []
            rows.append(row)
    yield from closed(rows)


def in_units(rows: DataFrame) -> DataFrame:
    """Rows (label, sub, cid, comp, guest, shingles) brought together by unit and searched: links a, b."""
    return (
        rows.select("label", "sub", "comp", "guest", "shingles", "cid").repartition(width(rows.sparkSession), "label", "sub")
        .sortWithinPartitions("label", "sub", "guest", "cid").drop("cid").mapInArrow(tidy(unit_task), "a long, b long")
    )


def shares_of(scan: DataFrame, buckets: int, hot: bool = False) -> DataFrame:
    """What the buckets tell the slabs, and the common shingles."""
    blobs = scan.where(F.col("kind") == BLOB).select("bucket", "slab", "tokens", "owners", "cids")
    found = blobs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(share_task(hot)), SHARES)
    return stored(found.unionByName(scan.where(F.col("kind").isin(LOCAL, HOT)).select("kind", "slab", "cids", "tokens")), "shares")


def summed(shares: DataFrame, kind: int) -> DataFrame:
    """cid, n: the counts of each slab (or bucket) added up inside a task."""
    rows = shares.where(F.col("kind") == kind).select("slab", "cids", "tokens")
    return rows.repartition("slab").sortWithinPartitions("slab").mapInArrow(sum_task, "cid long, n long")


def shared_counts(shares: DataFrame) -> DataFrame:
    """cid, shared: how many of its travelling shingles a set shares with any other set (the same in every slab)."""
    return summed(shares, LOCAL).groupBy("cid").agg(F.max("n").alias("shared"))


def common_shingles(shares: DataFrame) -> tuple[bytes, bytes]:
    """Short keys of the most common shingles, ascending, and their rank by number of holders, from 1."""
    often = stored(summed(shares, HOT).groupBy("cid").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_HOLDERS), "common")
    total, kept = often.count(), often
    if total > COMMON:
        edge = often.agg(F.percentile_approx("n", 1 - COMMON / total, 100_000)).first()[0]
        kept = often.where(F.col("n") > edge)
    rows = kept.toArrow()  # about COMMON rows at most
    names, n = rows.column("cid").to_numpy(), rows.column("n").to_numpy()
    discard(often)
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort((names, n))] = np.arange(1, len(n) + 1)
    order = np.argsort(names)
    return names[order].tobytes(), rank[order].tobytes()


def least() -> Column:
    """``least_overlap`` of column n."""
    return F.floor((F.lit(NUMERATOR) * F.col("n") + (DENOMINATOR - 1)) / DENOMINATOR)


def survivors(scan: DataFrame, buckets: int) -> DataFrame:
    """One text per class of equal sets that may have a partner: enough shared prefix shingles."""
    classes = (
        scan.where(F.col("kind") == META).where("cid is not null").groupBy("cid").agg(F.min("n").alias("n"), F.min("tkey").alias("tkey"))
    )
    need = F.greatest(F.lit(1), F.floor(least() / 10))
    shares = shares_of(scan, buckets)
    found = stored(classes.join(shared_counts(shares), "cid").where(F.col("shared") >= need).select("cid", "tkey"), "survivors")
    discard(shares)
    return found


def few(keys: DataFrame) -> DataFrame:
    """Broadcast keys that were counted and found few; others are left to a shuffle."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def linked_sets(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """META rows of all documents, and the component of every set that may have a partner (cid, comp)."""
    spark = docs.sparkSession
    buckets = width(spark)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(body).alias("tkey"), body.alias("t"))
    scan = stored(rows.mapInArrow(tidy(scan_task(buckets)), SCAN_DDL), "shingles")
    alive = survivors(scan, buckets)
    meta = stored(scan.where(F.col("kind") == META).select("doc_id", "n", "cid", "tkey"), "meta")
    discard(scan)
    texts = rows.join(few(alive.select("tkey")), "tkey", "left_semi").dropDuplicates(["tkey"]).select("t")
    first_sets = stored(texts.mapInArrow(tidy(set_task), SETS), "sets")
    # now over all shingles: a set with a partner shares four fifths of its own
    whole = stored(first_sets.select("cid", "shingles").mapInArrow(tidy(whole_task(buckets)), SCAN_DDL), "shingles")
    shares = shares_of(whole, buckets, hot=True)
    discard(whole)
    close = stored(
        first_sets.select("cid", "n").join(shared_counts(shares), "cid").where(F.col("shared") >= least()).select("cid"), "survivors"
    )
    sets = stored(first_sets.join(few(close), "cid", "left_semi"), "sets")
    discard(first_sets, alive, close)
    common = spark.sparkContext.broadcast(common_shingles(shares))
    discard(shares)
    comps = merged(sets.select("cid", F.col("cid").alias("comp")), meetings(sets))
    prefix_rows_of = sets.select("cid", "n", "shingles").mapInArrow(tidy(prefix_task(common, buckets)), "cid long, n long, token long, near boolean")
    open_ = still_open(stored(prefix_rows_of, "prefixes"), comps)
    if not open_.isEmpty():
        comps = merged(comps, last_look(sets, open_))
    discard(open_, sets)
    return meta, comps


def roots_of(links: DataFrame) -> DataFrame:
    """node, root: nodes of an edge list (a, b) have the same root if they are connected, only then.

    Every round each node joins the neighbour of the least hash, if that is less than its own, and edges are
    redrawn between what remains; a hash order leaves a share of the nodes at most, whatever the shape.
    """
    edges = stored(links.where("a <> b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ordered = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("x"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("x"))
        up = stored(both.groupBy("a").agg(F.min(ordered).alias("m")).select(F.col("a").alias("n"), F.least("m", own)["x"].alias("up")), "parents")
        to = up.select(F.col("n").alias("b"), F.col("up").alias("to"))
        redrawn = edges.join(up.withColumnRenamed("n", "a"), "a").join(to, "b").select(F.col("up").alias("a"), F.col("to").alias("b"))
        if roots is None:
            roots = up.select(F.col("n").alias("node"), F.col("up").alias("root"))
        else:
            moved = roots.join(up, F.col("root") == F.col("n"), "left")
            roots = stored(moved.select("node", F.coalesce("up", "root").alias("root")), "roots")
        edges = stored(redrawn.where("a <> b").distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (cid, comp) after links between components."""
    found = comps.join(roots_of(links), F.col("comp") == F.col("node"), "left").select("cid", F.coalesce("root", "comp").alias("comp"))
    return stored(found, "components")


def still_open(prefixes: DataFrame, comps: DataFrame) -> DataFrame:
    """cid, n, token, near, comp of the prefix shingles that sets of several components hold.

    Sets with fewer of them than a pair of partners shares have no partner outside their component.
    """
    held = prefixes.select("cid", "n", "token", "near").join(comps, "cid")
    mixed = held.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    found = stored(held.join(mixed, "token").select("cid", "n", "token", "near", "comp"), "open")
    need = F.greatest(F.lit(1), F.floor(least() / 10))
    able = found.groupBy("cid", "n").agg(F.count("*").alias("k")).where(F.col("k") >= need).select("cid")
    kept = stored(found.join(able, "cid"), "open")
    discard(prefixes, found)
    return kept


def meetings(sets: DataFrame) -> DataFrame:
    """Links between sets (cid, n, labels, shingles) that have a label in common.

    A set is in one unit per label; a group of too large a mass is split over several, which all see the same
    few leaders.  What this misses the last look finds.
    """
    named = sets.select("cid", "n", "shingles", F.posexplode("labels").alias("turn", "hash")).withColumn("label", F.xxhash64("turn", "hash"))
    leaders = [F.min(F.struct(F.xxhash64("cid", F.lit(j)).alias("h"), F.col("cid").alias("c")))["c"] for j in range(LEADERS)]
    big = named.groupBy("label").agg(F.sum("n").alias("mass"), F.array(*leaders).alias("leaders")).where(F.col("mass") > UNIT_MASS)
    placed = named.join(big.withColumn("subs", F.ceil(F.col("mass") / UNIT_MASS).cast("int")), "label", "left")
    sub = F.pmod(F.xxhash64("cid"), F.coalesce("subs", F.lit(1))).cast("int")
    leads = F.coalesce(F.array_contains("leaders", F.col("cid")), F.lit(False))
    visits = F.when(leads, F.sequence(F.lit(0), F.col("subs") - 1)).otherwise(F.array(sub))
    rows = placed.select(
        "label", F.explode(visits).alias("sub"), "cid", F.col("cid").alias("comp"), F.lit(False).alias("guest"), "shingles"
    )
    return stored(in_units(rows), "links")


def blocks_of(mass: str):
    return F.ceil(F.col(mass) / UNIT_MASS).cast("int")


def block(count: str):
    """The block a set is dealt to."""
    return F.pmod(F.xxhash64("cid"), F.col(count)).cast("int")


def every(count: str):
    return F.explode(F.sequence(F.lit(0), F.col(count) - 1))


def last_look(sets: DataFrame, open_: DataFrame) -> DataFrame:
    """Links among sets of different components that hold an open prefix shingle: all that the turns missed.

    Sets meet by shingle and size (partners differ by less than a step of the scale).  Sets that such
    meetings connect, however indirectly, travel once and are searched as one unit if their mass allows.
    """
    scale = F.floor(F.log(F.col("n").cast("double")) / math.log(SCALE_STEP)).cast("int")
    held = open_.where("near").select("cid", "n", "comp", "token", F.explode(F.array(scale, scale + 1)).alias("s")).select(
        "cid", "n", "comp", F.xxhash64("token", "s").alias("gid")
    )
    mixed = held.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("cid").alias("first")).where("lo < hi")
    met = stored(held.join(mixed.select("gid", "first"), "gid"), "groups")
    clusters = roots_of(met.select(F.col("cid").alias("a"), F.col("first").alias("b")))
    named = met.select("cid", "n", "comp").distinct().join(clusters, F.col("cid") == F.col("node")).select("cid", "n", "comp", "root")
    mass = named.groupBy("root").agg(F.sum("n").alias("mass"))
    placed = stored(named.join(mass, "root"), "clusters")
    whole = placed.where(F.col("mass") <= UNIT_MASS).select(
        F.col("root").alias("label"), F.lit(0).alias("sub"), "cid", "comp", F.lit(False).alias("guest")
    )
    links = stored(in_units(whole.join(sets.select("cid", "shingles"), "cid")), "links")
    large = placed.where(F.col("mass") > UNIT_MASS).select("cid")
    if not large.isEmpty():
        links = links.unionByName(in_blocks(sets, met.drop("first").join(large, "cid")))
    discard(placed)
    return links


def in_blocks(sets: DataFrame, held: DataFrame) -> DataFrame:
    """Links among sets that share a group (cid, n, comp, gid), for sets too many for one unit.

    Where one component has most members of a group, the others visit that component's sets, which travel
    once however many groups they are in; the others of a group meet in a unit of their own.  Groups too large
    for a unit are cut into blocks that meet in pairs, so a set is copied once per block and never per partner.
    """
    per_comp = held.groupBy("gid", "comp").agg(F.count("*").alias("members"))
    tops = per_comp.groupBy("gid").agg(
        F.sum("members").alias("total"), F.max(F.struct("members", "comp")).alias("top"), F.count("*").alias("comps")
    ).where("comps > 1").select(
        "gid", F.when((F.col("top.members") >= DOMINANT) & (F.col("top.members") * 2 > F.col("total")), F.col("top.comp")).alias("host")
    )
    groups = stored(held.join(tops, "gid"), "groups")
    hosts = groups.where("comp = host").select("cid", "n", "comp", "host").distinct()
    guests = groups.where("comp <> host").select("cid", "n", "comp", "host").distinct()
    # hosts and guests of a component in blocks
    sizes = hosts.groupBy("host").agg(F.sum("n").alias("host_mass")).join(guests.groupBy("host").agg(F.sum("n").alias("guest_mass")), "host")
    sizes = sizes.select("host", blocks_of("host_mass").alias("rows"), blocks_of("guest_mass").alias("cols"))
    sub = (F.col("i") * F.col("cols") + F.col("j")).cast("int")
    at_home = hosts.join(sizes, "host").select("*", block("rows").alias("i"), every("cols").alias("j"))
    visiting = guests.join(sizes, "host").select("*", block("cols").alias("j"), every("rows").alias("i"))
    visits = [
        frame.select(F.col("host").alias("label"), (-1 - sub).alias("sub"), "cid", "comp", F.lit(guest).alias("guest"))
        for frame, guest in ((at_home, False), (visiting, True))
    ]
    # the others of a group among themselves; of groups with the same sets one is enough
    rest = groups.where("host is null or comp <> host").select("gid", "cid", "n", "comp")
    many = (
        rest.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k"),
                                F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("mass"))
        .where("lo < hi").groupBy("k", "s").agg(F.min("gid").alias("gid"), F.min("mass").alias("mass"))
        .select("gid", blocks_of("mass").alias("blocks"))
    )
    dealt = rest.join(many, "gid").withColumn("i", block("blocks"))
    whole = dealt.where("blocks = 1").withColumn("sub", F.lit(0))
    pairs = dealt.where("blocks > 1").withColumn("j", every("blocks")).where("i <> j")
    pairs = pairs.withColumn("sub", (F.least("i", "j") * F.col("blocks") + F.greatest("i", "j")).cast("int"))
    visits += [frame.select(F.col("gid").alias("label"), "sub", "cid", "comp", F.lit(False).alias("guest")) for frame in (whole, pairs)]
    routes = visits[0]
    for more in visits[1:]:
        routes = routes.unionByName(more)
    return stored(in_units(routes.join(sets.select("cid", "shingles"), "cid")), "links")


def classified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, n_shingles, component_id, cid (id of the set, null if empty), comp, tkey (hash of the text) per row."""
    meta, groups = linked_sets(docs, key, text)
    per_set = meta.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("least"))
    named = per_set.join(groups, "cid", "left").select("cid", "least", F.coalesce("comp", "cid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "comp").select("cid", "comp", "component_id")
    return meta.select("doc_id", F.col("n").alias("n_shingles"), "cid", "tkey").join(ids, "cid", "left").withColumn(
        "component_id", F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )


def similarity_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two documents link when the Jaccard similarity of their shingle sets is 0.8 or more; the component id is
    the smallest key reachable over links.  Words are runs of other bytes than blanks (0x20, 0x09 to 0x0D) with
    A-Z in lower case; texts of fewer than five words are one shingle.  A null, empty or blank text has no
    shingles and stands alone.  Repeated rows link with one another, a null key takes the smallest key of
    its component, if any; an empty table gives no rows; other columns are ignored.

    Shingles and sets are known by 64-bit hashes.  Equal sets are joined as one.  A first pass keeps only
    sets that share enough of their prefix with any other set (an exact condition).  The surviving sets meet
    in work units of bounded mass, by three least hashes that most partners share; sets whose prefix
    shingles no other component holds are settled then.  What is left meets once more by prefix shingles,
    rare ones first in the global order: every pair that could link is searched.
    """
    return classified(docs, key, text).select("doc_id", "n_shingles", "component_id")


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each similarity class, all columns: a row with the class's smallest key.

    Rows without any word are classes of their own and all stay.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    speaks = body.rlike(r"[^\x20\x09-\x0D]")
    chosen = stored(
        classified(docs, key, text).where(F.col("cid").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("comp", "tkey").agg(F.first("doc_id").alias("__id"), F.count("*").alias("copies"))
        .groupBy("comp").agg(F.min(F.struct("tkey", "__id", "copies")).alias("c"))
        .select("c.__id", F.col("c.tkey").alias("__tkey"), "c.copies"),
        "chosen",
    )
    rows = docs.where(speaks).withColumn("__tk", F.xxhash64(body))
    same = F.col(key).cast("long").eqNullSafe(F.col("__id")) & (F.col("__tk") == F.col("__tkey"))
    # texts move only where a chosen row is there more than once
    single = rows.join(few(chosen.where("copies = 1")), same, "left_semi")
    several = rows.join(few(chosen.where("copies > 1")), same, "left_semi").dropDuplicates([key, "__tk"])
    return single.select(*docs.columns).unionByName(several.select(*docs.columns)).unionByName(docs.where(~speaks))


def op1_ngram_join(spark, sf_dir):
    return similarity_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op1_ngram_join": op1_ngram_join}

SQL = {
    "op1_ngram_join": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
    list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a
)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
""",
}
