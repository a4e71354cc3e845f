"""Best-fit packing of token pieces by bin completion over the histogram of lengths."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimworks.llm.bpe import WORD, Encoder, Vocabulary, byte_symbols, public_vocabulary, slabs
from claimworks.llm.common import bounded_batches, stored, table, tidy

CAPACITY = 2048
SEARCH_WORK = 200_000  # distinct lengths looked at, and steps of the walks, to beat best fit or prove it


# ---- the plan: patterns (times, [(length, count), ...]) from a histogram of lengths


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing with multiplicities: equal bins are kept as one (times, content) entry."""
    open_bins: dict[int, list] = {}  # free room -> entries
    closed = []

    def put(times, content, room):
        if times:
            (open_bins.setdefault(room, []) if room else closed).append([times, content])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in open_bins if r >= size):
            fit = room // size
            entries = open_bins.pop(room)
            while entries and left:
                times, content = entries.pop()
                full = min(times, left // fit)
                put(full, {**content, size: content.get(size, 0) + fit}, room - fit * size)
                left -= full * fit
                times -= full
                if times and left:
                    put(1, {**content, size: content.get(size, 0) + left}, room - left * size)
                    times, left = times - 1, 0
                put(times, content, room)
            for times, content in entries:
                put(times, content, room)
            if not left:
                break
        fit = capacity // size
        put(left // fit, {size: fit}, capacity - fit * size)
        if left % fit:
            put(1, {size: left % fit}, capacity - (left % fit) * size)
    return [(t, c) for entries in [closed, *open_bins.values()] for t, c in entries]


class Budget:
    """Work that the search may still do."""

    def __init__(self, work: int):
        self.left = work

    def spend(self, work: int) -> bool:
        self.left -= work
        return self.left >= 0


def reachable(sizes: list[int], counts: dict[int, int], room: int) -> list[int]:
    """For each i the sums up to ``room`` that items of ``sizes[i:]`` make, as bits of an integer."""
    full = (1 << (room + 1)) - 1
    sums = [1]
    for s in reversed(sizes):
        bits, left, step = sums[-1], min(counts[s], room // s), 1
        while left:
            take = min(step, left)
            bits |= (bits << (take * s)) & full
            left, step = left - take, step * 2
        sums.append(bits)
    return sums[::-1]


def fillings(size: int, counts: dict[int, int], capacity: int, most_waste: int, budget: Budget):
    """All undominated ways to fill a bin that holds one item of ``size``, least waste first, one by one.

    A filling is dominated if an item left out still fits, or fits in place of a smaller one that is in.  Sums
    that can be reached tell which branches end in a filling, so none is walked in vain.  Ends early when the
    budget is used up.
    """
    others = {s: n - (s == size) for s, n in counts.items()}
    room = capacity - size
    sizes = [s for s in sorted(others, reverse=True) if others[s] and s <= room]
    sums = reachable(sizes, others, room)
    budget.spend(len(sizes))

    def undominated(content, free):
        return not any(
            others[s] > content.get(s, 0) and (s <= free or any(t < s <= t + free for t in content)) for s in sizes
        )

    for free in range(min(most_waste, room) + 1):
        if not sums[0] >> (room - free) & 1:
            continue
        walk = [(0, room - free, ())]
        while walk:
            i, target, chosen = walk.pop()
            if not budget.spend(1):
                return
            if not target:
                content = dict(chosen)
                if free and not budget.spend(len(sizes)):
                    return
                if not free or undominated(content, free):
                    yield {**content, size: content.get(size, 0) + 1}
                continue
            while not (sizes[i] <= target and sums[i] >> target & 1):
                i += 1
            s = sizes[i]
            # many of the largest size first: pushed last
            for n in range(min(others[s], target // s) + 1):
                if sums[i + 1] >> (target - n * s) & 1:
                    walk.append((i + 1, target - n * s, (*chosen, (s, n)) if n else chosen))


def bound(counts: dict[int, int], capacity: int) -> int:
    """Bins needed at least: total mass, and for each threshold k the items too large to share a bin.

    Items above capacity - k are alone, those above half need a bin each, and items of k to half the capacity
    fill what these leave open.
    """
    number = np.zeros(capacity + 2, np.int64)
    for s, n in counts.items():
        number[s] = n
    sizes = np.arange(capacity + 2)
    items, mass = np.cumsum(number), np.cumsum(number * sizes)
    half = capacity // 2
    k = np.arange(0, half + 1)
    top = capacity - k
    alone = items[-1] - items[top]
    large = items[top] - items[half]
    spare = large * capacity - (mass[top] - mass[half])
    small = mass[half] - np.where(k > 0, mass[np.maximum(k - 1, 0)], 0)
    need = alone + large + np.maximum(0, -(-(small - spare) // capacity))
    return int(max(-(-mass[-1] // capacity), need.max()))


def search(counts: dict[int, int], capacity: int = CAPACITY, work: int = SEARCH_WORK):
    """(patterns that hold all items, proven): best fit as incumbent, then bin completion while it can be beaten.

    ``proven`` says that no packing needs fewer bins: the lower bound is met, or the tree was searched to its
    end.  Only ``work`` ends the search before that; then the best packing found stands.
    """
    counts = {s: n for s, n in counts.items() if n}
    incumbent = best_fit(counts, capacity)
    used = sum(t for t, _ in incumbent)
    least, mass = bound(counts, capacity), sum(s * n for s, n in counts.items())
    budget = Budget(work)

    def branches(left, done, bins, waste):
        """What is left after each filling of the bin of the largest item, taken as often as it can be, and once."""
        for content in fillings(max(left), left, capacity, waste, budget):
            times = min(left[s] // n for s, n in content.items())
            free = capacity - sum(s * n for s, n in content.items())
            if free:
                times = min(times, waste // free)
            for n in dict.fromkeys((times, 1)):
                after = {s: c - n * content.get(s, 0) for s, c in left.items()}
                yield {s: c for s, c in after.items() if c}, done + [(n, content)], bins + n

    # depth-first over what is still to be tried at each level
    levels = [iter([(counts, [], 0)])]
    while levels and used > least and budget.left > 0:
        node = next(levels[-1], None)
        if node is None:
            levels.pop()
            continue
        left, done, bins = node
        budget.spend(20 + len(left))
        # waste bound: all bins of a better packing together may waste no more than this
        rest = sum(s * n for s, n in left.items())
        waste = (used - 1 - bins) * capacity - rest
        if waste < 0 or bins + bound(left, capacity) >= used:
            continue
        closing = best_fit(left, capacity)
        total = bins + sum(t for t, _ in closing)
        if total < used:
            incumbent, used = done + closing, total
            waste -= capacity
        if left and waste >= 0 and bins + bound(left, capacity) < used:
            levels.append(branches(left, done, bins, waste))
    return incumbent, used <= least or budget.left > 0


def plan(counts: dict[int, int], capacity: int = CAPACITY, work: int = SEARCH_WORK):
    """The patterns that ``search`` found."""
    return search(counts, capacity, work)[0]


def layout(patterns) -> dict[int, tuple]:
    """For each length the ranks of its items, laid out over the plan's bins.

    Arrays of a length: first rank, first bin, items per bin, offset in the bin.
    """
    by_size: dict[int, list] = {}
    first_bin, given = 0, {}
    for times, content in patterns:
        offset = 0
        for size in sorted(content, reverse=True):
            n = content[size]
            start = given.get(size, 0)
            by_size.setdefault(size, []).append((start, first_bin, n, offset))
            given[size] = start + times * n
            offset += n * size
        first_bin += times
    return {s: tuple(np.array(c, np.int64) for c in zip(*rows)) for s, rows in by_size.items()}


def place(rows, size: int, ranks: np.ndarray):
    start, first_bin, n, offset = rows
    at = np.searchsorted(start, ranks, "right") - 1
    inner = ranks - start[at]
    return first_bin[at] + inner // n[at], offset[at] + (inner % n[at]) * size


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The items with ``sequence_id``, ``offset`` and ``fewest``: as few sequences of ``capacity`` as the search finds.

    ``fewest`` is true on all rows if it is proven that no packing needs fewer sequences, and false on all if the
    search ended because its work was used up.

    Lengths must lie between 1 and ``capacity``; others, and null lengths, raise.  Equal items may repeat, an
    empty frame stays empty, and other columns are passed through.  Only the histogram of lengths, at most
    ``capacity`` rows, reaches the driver; the plan made from it is at most a few patterns per length.  Each
    item finds its place from its rank among the items of its length, and ranks come from counts per written
    partition, so that a length shared by most items is no hot key.
    """
    size = F.col(length).cast("int")
    numbered = stored(items.withColumn("__size", size).mapInArrow(
        rank_in_task(items.columns),
        items.select("*").schema.add("__size", "integer").add("__task", "long").add("__rank", "long"),
    ), "pack-items")
    counts = {r[0]: r[1] for r in numbered.groupBy("__size").count().collect()}
    if any(s is None or not 1 <= s <= capacity for s in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    patterns, proven = search(counts, capacity)
    places = items.sparkSession.sparkContext.broadcast(layout(patterns))
    before = Window.partitionBy("__size").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        numbered.groupBy("__task", "__size").agg(F.count("*").alias("n"))
        .withColumn("__base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    )
    ranked = numbered.join(base, ["__task", "__size"]).withColumn("__rank", F.col("__rank") + F.col("__base"))
    names = [c for c in items.columns if c not in ("sequence_id", "offset", "fewest")]
    out = ranked.select(*names, "__size", "__rank")
    schema = items.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return out.mapInArrow(place_rows(places, len(names)), schema).withColumn("fewest", F.lit(proven))


def rank_in_task(names):
    """Adds the task's number and each row's rank among the task's rows of its size."""
    def run(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            ranks = []
            for s in batch.column(len(names)).to_pylist():
                n = seen.get(s, 0)
                seen[s] = n + 1
                ranks.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(ranks), pa.int64()), pa.array(ranks, pa.int64())],
                [*batch.schema.names, "__task", "__rank"],
            )

    return run


def place_rows(places, keep):
    def run(batches):
        for batch in batches:
            sizes, ranks = batch.column(keep).to_numpy(), batch.column(keep + 1).to_numpy()
            bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for s in np.unique(sizes):
                at = np.flatnonzero(sizes == s)
                bins[at], offsets[at] = place(places.value[int(s)], int(s), ranks[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(keep)), pa.array(bins), pa.array(offsets)],
                [*batch.schema.names[:keep], "sequence_id", "offset"],
            )

    return run


# ---- pieces of documents


class Ranked:
    """Ids of chunks of a byte-level BPE file, by its merge order."""

    def __init__(self, vocabulary: str):
        model = json.loads(vocabulary)
        bytes_of = byte_symbols()
        special = {a["content"] for a in model["added_tokens"]}
        self.vocab = Vocabulary(model)
        ids = {bytes(bytes_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        # byte-pair ranks may stand for merge order only if ids grow with the merges
        self.fast = None
        if (np.diff(self.vocab.merged) > 0).all() and len(ids) == 256 + len(self.vocab.merged):
            import tiktoken

            self.fast = tiktoken.Encoding("pieces", pat_str=WORD, mergeable_ranks=ids, special_tokens={})


class PieceEncoder(Encoder):
    """The encoder with new chunks encoded by a tokenizer library, where the vocabulary allows it."""

    def __init__(self, vocabulary: str):
        ranked = Ranked(vocabulary)
        super().__init__(ranked.vocab)
        self.fast = ranked.fast

    def learn(self, chunks):
        if self.fast is None:
            return super().learn(chunks)
        encode = self.fast.encode_ordinary
        return [np.array(encode(chunk), np.int32).tobytes() for chunk in chunks]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full, but the first one may be shorter."""
    first = n % capacity or capacity
    out, start = [], 0
    while start < n:
        size = first if not start else capacity
        out.append((start, size))
        start += size
    return out


PIECES = "piece int, start long, length long, ids binary"


def piece_task(vocabulary, end_id, capacity):
    end = np.int32(end_id).tobytes()

    def run(batches):
        encoder = PieceEncoder(vocabulary.value)
        for batch in batches:
            keys, text = batch.column(0), batch.column(1)
            for a, b in slabs(text):
                docs = encoder.encode([t or "" for t in text.slice(a, b - a).to_pylist()])
                rows, held = [], 0
                for i, ids in enumerate(docs):
                    ids += end
                    for j, (start, size) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((a + i, j, start, size, ids[4 * start:4 * (start + size)]))
                        held += 4 * size
                    if held > 16 << 20:
                        yield piece_batch(keys, rows)
                        rows, held = [], 0
                if rows:
                    yield piece_batch(keys, rows)

    return run


def piece_batch(keys, rows):
    at, piece, start, size, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
         pa.array(size, pa.int64()), pa.array(ids, pa.binary())],
        ["doc_id", "piece", "start", "length", "ids"],
    )


def pieces(
    docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
    capacity: int = CAPACITY,
) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every document's tokens and ``end_id``.

    A null or empty text is the end id alone.  Only documents longer than ``capacity`` are cut.  Rows that
    repeat give their pieces again, and a null key stays null.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())  # one file of fixed size
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(tidy(piece_task(shipped, end_id, capacity)), f"doc_id {kind}, {PIECES}")


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places and the checksum of their ids."""
    bounded_batches(docs.sparkSession)
    found = pieces(docs, vocabulary_path, capacity=capacity)
    # written first, so that a task of the next step does not keep a second Python worker beside the encoder
    rows = stored(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(rows, "length", capacity)


def op3_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_vocabulary())


QUERIES = {"op3_packing": op3_packing}
