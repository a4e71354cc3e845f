"""Byte-level BPE over a pair occurrence index, and its decoding."""

from __future__ import annotations

import heapq
import json
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import table, tidy

#: Fixed: how byte-level BPE cuts a text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_CHUNKS = 200_000  # remembered chunks of a task; the store is emptied when it is full
SLAB_CHARS = 4 << 20  # texts encoded together
NONE = np.int64(1) << 60
MARKS = frozenset(",.;:!?")  # one of these after letters is a word of its own


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary file, by rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table_ = {chr(b): b for b in plain}
    table_ |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return table_


class Vocabulary:
    """A byte-level BPE vocabulary file: ids of bytes, merges as arrays, bytes of ids."""

    def __init__(self, source: str | dict):
        model = json.loads(source) if isinstance(source, str) else source
        bytes_of = byte_symbols()
        ids = model["model"]["vocab"]
        self.tokens = {i: bytes(bytes_of[c] for c in t) for t, i in ids.items() if all(c in bytes_of for c in t)}
        self.special = {a["content"]: a["id"] for a in model["added_tokens"]}
        self.tokens |= {i: t.encode() for t, i in self.special.items()}
        self.byte_id = np.zeros(256, np.int32)
        for char, b in bytes_of.items():
            if char in ids:
                self.byte_id[b] = ids[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.left, self.right = left.astype(np.int32), right.astype(np.int32)
        key = (left << 32) | right
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]
        # bytes of all ids end to end, for decoding
        top = max(self.tokens, default=0) + 1
        self.sizes = np.array([len(self.tokens.get(i, b"")) for i in range(top)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.blob = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(top)), np.uint8)

    def ranks(self, left, right):
        """Merge rank of each pair, NONE where there is no merge."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NONE)


class PairIndex:
    """Pair (by merge rank) -> all its positions in the words of one slab."""

    def __init__(self):
        self.places: dict[int, list] = {}
        self.active: list[int] = []

    def add(self, ranks, positions):
        known = ranks < NONE
        ranks, positions = ranks[known], positions[known]
        if not len(ranks):
            return
        if len(ranks) == 1:
            self.put(int(ranks[0]), positions)
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = (np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(ranks)]):
            self.put(int(ranks[a]), positions[a:b])

    def put(self, rank, part):
        if rank in self.places:
            self.places[rank].append(part)
        else:
            self.places[rank] = [part]
            heapq.heappush(self.active, rank)

    def lowest(self):
        """The lowest active rank and its positions in ascending order; None when no pair is left."""
        if not self.active:
            return None
        rank = heapq.heappop(self.active)
        parts = self.places.pop(rank)
        places = np.sort(np.concatenate(parts) if len(parts) > 1 else parts[0])
        if len(places) > 1:
            fresh = places[1:] != places[:-1]
            if not fresh.all():
                places = places[np.concatenate([[True], fresh])]
        return rank, places


def encode_words(words: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """Token ids of every word.  Active ranks are applied in ascending order, each to all its positions."""
    if not words:
        return []
    sizes = np.array([len(w) for w in words], np.int64)
    sym = vocab.byte_id[np.frombuffer(b"".join(words), np.uint8)].astype(np.int32)
    n = len(sym)
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    nxt = np.arange(1, n + 1, dtype=np.int64)
    prv = np.arange(-1, n - 1, dtype=np.int64)
    edge = np.flatnonzero(word[1:] != word[:-1]) if n else np.zeros(0, np.int64)
    nxt[edge], prv[edge + 1] = -1, -1
    if n:
        nxt[-1] = -1
    alive = np.ones(n, bool)
    index = PairIndex()
    first = np.flatnonzero(nxt >= 0)
    index.add(vocab.ranks(sym[first], sym[nxt[first]]), first)
    while (found := index.lowest()) is not None:
        rank, pos = found
        left, right = vocab.left[rank], vocab.right[rank]
        after = nxt[pos]
        good = alive[pos] & (sym[pos] == left) & (after >= 0)
        pos, after = pos[good], after[good]
        good = sym[after] == right
        pos, after = pos[good], after[good]
        if not len(pos):
            continue
        if left == right and len(pos) > 1:
            # in a run of one symbol every other place merges, from the left
            linked = np.concatenate([[False], after[:-1] == pos[1:]])
            run = np.cumsum(~linked) - 1
            heads = np.flatnonzero(~linked)
            take = (np.arange(len(pos)) - heads[run]) % 2 == 0
            pos, after = pos[take], after[take]
        sym[pos] = vocab.merged[rank]
        alive[after] = False
        beyond = nxt[after]
        nxt[pos] = beyond
        has = beyond >= 0
        prv[beyond[has]] = pos[has]
        before = prv[pos]
        had = before >= 0
        lefts, rights = before[had], pos[has]
        index.add(
            np.concatenate([vocab.ranks(sym[lefts], sym[pos[had]]), vocab.ranks(sym[rights], sym[beyond[has]])]),
            np.concatenate([lefts, rights]),
        )
    ids = sym[alive]
    ends = np.cumsum(np.bincount(word[alive], minlength=len(words))).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


CHUNK_EDGE = re.compile(r"(?<=\S)(?= )")
BLANK_PAIR = re.compile(r"\s ")


def chunks_of(text: str) -> list[str]:
    """Pieces that encode on their own: a text may be cut before any blank that follows a non-blank."""
    if text[:1] == " " or BLANK_PAIR.search(text):
        return CHUNK_EDGE.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + piece for piece in rest]]


class Encoder:
    """Texts to ids.  Chunks seen before come from a bounded store, new ones are encoded together."""

    def __init__(self, vocab: Vocabulary, limit: int = CACHE_CHUNKS):
        self.vocab, self.limit = vocab, limit
        self.number: dict[str, int] = {}  # chunk -> place in ids
        self.ids: list[bytes] = []
        self.word = regex.compile(WORD)
        self.special = re.compile("(" + "|".join(map(re.escape, vocab.special)) + ")") if vocab.special else None

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that are new, all their words merged in one pair index."""
        words, plan = {}, []
        for chunk in chunks:
            body = chunk[1:] if chunk[:1] == " " else chunk
            if body.isalpha():
                found = [chunk]
            elif body[-1:] in MARKS and body[:-1].isalpha():
                found = [chunk[:-1], chunk[-1]]
            else:
                found = self.word.findall(chunk)
            plan.append([words.setdefault(w, len(words)) for w in found])
        ids = [i.tobytes() for i in encode_words([w.encode("utf-8", "surrogatepass") for w in words], self.vocab)]
        return [ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p]) for p in plan]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        number = self.number
        if len(number) > self.limit:
            number.clear()
            self.ids.clear()
        if not number:
            for text, i in self.vocab.special.items():
                number[text] = len(self.ids)
                self.ids.append(np.int32(i).tobytes())
        known, cut = len(number), []
        for text in texts:
            parts = self.special.split(text) if self.special and self.special.search(text) else [text]
            pieces = []
            for i, part in enumerate(parts):
                if i % 2:
                    pieces.append(part)
                elif part:
                    pieces.extend(chunks_of(part))
            cut.append(array("i", [number.setdefault(c, len(number)) for c in pieces]))
        if len(number) > known:
            self.ids.extend(self.learn(list(islice(number, known, None))))
        ids = self.ids
        return [b"".join([ids[c] for c in pieces]) for pieces in cut]


def slabs(column, limit=SLAB_CHARS):
    """Row ranges of a batch whose texts hold about ``limit`` characters together; one text at least."""
    sizes = pa.compute.fill_null(pa.compute.utf8_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def int_lists(parts: list[bytes]) -> pa.Array:
    lengths = np.array([len(p) // 4 for p in parts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encoder_task(vocabulary, keep):
    def run(batches):
        encoder = Encoder(Vocabulary(vocabulary.value))
        for batch in batches:
            text = batch.column(keep)
            for a, b in slabs(text):
                texts = [t or "" for t in text.slice(a, b - a).to_pylist()]
                ids = int_lists(encoder.encode(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(keep)), ids],
                    [*batch.schema.names[:keep], "ids"],
                )

    return run


def encode(docs: DataFrame, vocabulary_path: str, keys=("doc_id",), text: str = "text") -> DataFrame:
    """``keys`` and ``ids`` (array of int) of every row: the byte-level BPE of its whole text.

    Equal to what the tokenizers library gives for the same vocabulary file without added special tokens;
    a special token's string inside a text becomes its id.  A null text is empty and gives no ids.  Rows may
    repeat, keys may be null, other columns do not matter, an empty table gives no rows.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())  # one file of fixed size
    rows = docs.select(*[F.col(k) for k in keys], F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInArrow(tidy(encoder_task(shipped, len(keys))), f"{schema}, ids array<int>")


def decode_flat(ids: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all ids end to end, and the size of each id's bytes; ids outside the vocabulary give none."""
    ok = (ids >= 0) & (ids < len(vocab.sizes))
    safe = np.where(ok, ids, 0)
    sizes = np.where(ok, vocab.sizes[safe], 0)
    total = int(sizes.sum())
    begin = np.repeat(vocab.starts[safe] - (np.cumsum(sizes) - sizes), sizes)
    return vocab.blob[begin + np.arange(total)], sizes


def decoder_task(vocabulary, keep):
    def run(batches):
        vocab = Vocabulary(vocabulary.value)
        for batch in batches:
            column, start, held, out = batch.column(keep), 0, 0, []
            for i in range(batch.num_rows):
                row = column[i].values
                if row is None or not len(row):
                    out.append("")
                else:
                    flat, _ = decode_flat(row.to_numpy(zero_copy_only=False), vocab)
                    out.append(flat.tobytes().decode("utf-8", "replace"))
                    held += len(flat)
                if held > SLAB_CHARS or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(j).slice(start, len(out)) for j in range(keep)), pa.array(out, pa.string())],
                        [*batch.schema.names[:keep], "decoded"],
                    )
                    start, held, out = i + 1, 0, []

    return run


def decode(rows: DataFrame, vocabulary_path: str, keys=("doc_id",), ids: str = "ids") -> DataFrame:
    """``keys`` and ``decoded``: the text of each id list, special tokens included.

    Bytes that are no UTF-8 become U+FFFD.  A null or empty list gives an empty text.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shipped = rows.sparkSession.sparkContext.broadcast(f.read())
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    picked = rows.select(*[F.col(k) for k in keys], F.col(ids).alias("__ids"))
    return picked.mapInArrow(tidy(decoder_task(shipped, len(keys))), f"{schema}, decoded string")


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark, sf_dir):
    path = public_vocabulary()
    ids = encode(table(spark, sf_dir, "documents"), path)
    digest = ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids",
    )
    keys = ("doc_id", "n_tokens", "ids_sha256")
    return decode(digest, path, keys).select(*keys, F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op4_bpe": op4_bpe}
