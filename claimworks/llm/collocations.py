"""Phrase collocations by Toivonen mining: a sample proposes phrases, full passes count them and their negative border."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.common import stored, table, width
from claimworks.llm.words import STEP, mix, ragged, slab_ranges, text_bytes, word_hashes, word_places

LONGEST = 3  # words of a phrase
SUPPORT = 10
SAMPLE = 4  # one document in so many proposes phrases
SAMPLE_SUPPORT = 2  # below SUPPORT / SAMPLE, so that few frequent phrases stay out of the sample's
ABSORBED = 50  # per cent of a phrase's occurrences inside one longer phrase that drop it
TOP = 2000
NO_LANG = "und"
SLAB_BYTES = 3 << 20
LEAST_BITS, MOST_BITS = 16, 28  # a filter is 8 kB to 32 MB, whatever the corpus
CHUNK_BITS = 16

PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IS_WORD = ~PIECE_END
IS_WORD[[0x20, 0x09]] = False


# ---- phrases of a slab


class Slab:
    """Words of a few documents, and phrase keys: 62 bits of a hash of language and words, then 2 bits for k."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = text_bytes(texts)
        low = data.copy()
        low[(low >= 65) & (low <= 90)] += 32
        self.data = low
        self.starts, self.ends, doc = word_places(low, offsets, IS_WORD)
        self.langs = langs.dictionary_encode()
        self.lang_of = self.langs.indices.to_numpy()[doc] if len(doc) else np.zeros(0, np.int64)
        piece = np.cumsum(PIECE_END[low])[self.starts] if len(doc) else np.zeros(0, np.int64)
        same = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        #: whether a phrase of k words starts at a word, by k
        self.whole = {1: np.ones(len(doc), bool)}
        for k in range(2, LONGEST + 1):
            self.whole[k] = self.whole[k - 1][:-1] & same[k - 2:]

    def keys(self) -> dict[int, np.ndarray]:
        """Keys of the phrases of k words at every place (not all of them whole), by k."""
        seeds = np.array([xxhash.xxh64_intdigest(name.encode()) for name in self.langs.dictionary.to_pylist()], np.uint64)
        first = word_hashes(self.data, self.starts, self.ends)
        if len(first):
            first = mix(first ^ seeds[self.lang_of])
        found, rolled = {1: first}, first
        with np.errstate(over="ignore"):
            for k in range(2, LONGEST + 1):
                rolled = mix(rolled[:-1] * np.uint64(0x9FB21C651E98DF25) + first[k - 1:] + STEP * np.uint64(k))
                found[k] = rolled
        return {k: rolled & ~np.uint64(3) | np.uint64(k) for k, rolled in found.items()}


class Filter:
    """A set of keys in a bit table of bounded size: no key of the set is missed, others may pass."""

    def __init__(self, table_bytes: bytes):
        self.bits = np.frombuffer(table_bytes, np.uint8)
        self.shift = np.uint64(64 - (len(self.bits) * 8).bit_length() + 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> self.shift
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 != 0


def slabs(batches):
    for batch in batches:
        texts, langs = batch.column(0), batch.column(1)
        _, offsets = text_bytes(texts)
        for a, b in slab_ranges(offsets, SLAB_BYTES):
            yield Slab(texts.slice(a, b - a), langs.slice(a, b - a))


def proposed(keys: dict, whole: dict, k: int, sieve: Filter) -> np.ndarray:
    """Places where both parts of one word less are in the set: proposed phrases and their negative border."""
    shorter = sieve(keys[k - 1])
    return whole[k] & shorter[:-1] & shorter[1:]


def count_task(filters, sizes):
    """Phrases at every place -> key, n per slab.

    Without filters all phrases of the given sizes count.  With filters, phrases whose parts the last one
    holds and no earlier one held; single words only in the first pass, for they have no parts.
    """
    def run(batches):
        sieves = [Filter(f.value) for f in filters]
        for slab in slabs(batches):
            keys = slab.keys()
            for k in sizes:
                take = slab.whole[k]
                if sieves and k > 1:
                    take = proposed(keys, slab.whole, k, sieves[-1])
                    for earlier in sieves[:-1]:
                        take &= ~proposed(keys, slab.whole, k, earlier)
                found, n = np.unique(keys[k][take], return_counts=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    return run


def counted(docs: DataFrame, filters: list, sizes: list[int], support: int) -> DataFrame:
    rows = docs.mapInArrow(count_task(filters, sizes), "key long, n long")
    return stored(rows.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= support), "phrase-keys")


def outside_task(sieve):
    def run(batches):
        holds = Filter(sieve.value)
        for batch in batches:
            yield batch.filter(pa.array(~holds(batch.column(0).to_numpy().view(np.uint64))))

    return run


def bits_task(bits):
    """Sorted distinct slots of whole chunks -> chunk, bytes of its part of the table."""
    def closed(chunk, slots):
        marks = np.zeros(1 << min(CHUNK_BITS, bits), np.uint8)
        marks[np.concatenate(slots) & (len(marks) - 1)] = 1
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([np.packbits(marks, bitorder="little").tobytes()])], ["chunk", "table"]
        )

    def run(batches):
        held, slots = None, []
        for batch in batches:
            all_slots = batch.column(1).to_numpy()
            chunks = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(chunks)) + 1
            for part in np.split(np.arange(len(chunks)), cuts):
                if len(part):
                    if chunks[part[0]] != held and slots:
                        yield closed(held, slots)
                        slots = []
                    held = int(chunks[part[0]])
                    slots.append(all_slots[part])
        if slots:
            yield closed(held, slots)

    return run


def filter_of(keys: DataFrame):
    """A broadcast bit table over column ``key``: 16 bits a key, within fixed bounds."""
    spark = keys.sparkSession
    bits = max(LEAST_BITS, min(MOST_BITS, (16 * keys.count()).bit_length()))
    slots = (
        keys.select(F.shiftrightunsigned("key", 64 - bits).alias("slot")).distinct()
        .select(F.shiftright("slot", CHUNK_BITS).alias("chunk"), "slot")
        .repartition("chunk").sortWithinPartitions("chunk")
    )
    whole = bytearray(1 << (bits - 3))
    size = 1 << (min(CHUNK_BITS, bits) - 3)
    for chunk, part in slots.mapInArrow(bits_task(bits), "chunk long, table binary").collect():
        whole[chunk * size:chunk * size + len(part)] = part
    return spark.sparkContext.broadcast(bytes(whole))


# ---- exact counts of the phrases found


def joined(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slab's words, a blank after each: bytes, starts, ends."""
    sizes = slab.ends - slab.starts
    data = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    data[ragged(starts, sizes)] = slab.data[ragged(slab.starts, sizes)]
    return data, starts, starts + sizes


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[ragged(starts, sizes)]))


COUNTS = "lang string, k int, phrase string, n long"


def phrase_task(sieve):
    """lang, k, phrase, n of phrases whose keys the filter holds; k = 0: all words of a language.

    Phrases are told apart by their words, not by their keys: words are numbered by a dictionary of the
    slab, longer phrases by the pair of the phrase without its last word and that word.
    """
    def run(batches):
        holds = Filter(sieve.value)
        for slab in slabs(batches):
            names, count = slab.langs.dictionary, len(slab.starts)
            if not count:
                continue
            data, starts, ends = joined(slab)
            langs, n = np.unique(slab.lang_of, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(langs)), pa.array(np.zeros(len(langs), np.int32)), pa.array([""] * len(langs)), pa.array(n)],
                ["lang", "k", "phrase", "n"],
            )
            word = strings(data, starts, ends).dictionary_encode().indices.to_numpy().astype(np.int64)
            code = word * len(names) + slab.lang_of
            keys = slab.keys()
            for k in range(1, LONGEST + 1):
                if k > 1:
                    code = code[:-1] * (int(word.max()) + 1) + word[k - 1:]
                at = np.flatnonzero(slab.whole[k] & holds(keys[k]))
                _, first, times = np.unique(code[at], return_index=True, return_counts=True)
                if k < LONGEST:
                    code = np.unique(code, return_inverse=True)[1]  # small numbers again, so that products fit
                if len(at):
                    first = at[first]
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(slab.lang_of[first])), pa.array(np.full(len(first), k, np.int32)),
                         strings(data, starts[first], ends[first + k - 1]), pa.array(times)],
                        ["lang", "k", "phrase", "n"],
                    )

    return run


def frequent_phrases(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", support: int = SUPPORT
) -> DataFrame:
    """lang, k, phrase, n: every phrase of 1 to 3 words that occurs ``support`` times or more in its language, with
    its exact count; and per language one row with k = 0 and n the number of its words.

    1. Words and pairs of words that occur ``SAMPLE_SUPPORT`` times in every fourth document are proposed.
    2. A pass over all documents counts all single words, and longer phrases whose parts are proposed: the
       proposed phrases and their negative border.
    3. Frequent words and pairs of the border, which the sample missed, join the proposals; a further pass counts
       what this adds to the border, until nothing frequent lies outside the proposals.
    These passes count 64-bit keys and can only overstate; the last one counts the phrases themselves.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(body.alias("t"), F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("l"), F.col(key).alias("k"))
    sample = rows.where(F.pmod(F.xxhash64("k"), F.lit(SAMPLE)) == 0).select("t", "l")
    rows = rows.select("t", "l")
    low = min(SAMPLE_SUPPORT, support)
    known = counted(sample, [], list(range(1, LONGEST)), low).select("key")
    filters, found = [filter_of(known)], None
    while True:
        more = counted(rows, filters, list(range(1 if found is None else 2, LONGEST + 1)), support)
        found = more if found is None else found.unionByName(more)
        missed = stored(
            more.where(F.col("key").bitwiseAND(F.lit(3)) < LONGEST).select("key").mapInArrow(outside_task(filters[-1]), "key long"), "missed"
        )
        if missed.isEmpty():
            break
        known = known.unionByName(missed)
        filters.append(filter_of(known))
    counts = rows.mapInArrow(phrase_task(filter_of(found.select("key"))), COUNTS).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    return stored(counts.where((F.col("k") == 0) | (F.col("n") >= support)), "phrases")


def collocations(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", support: int = SUPPORT,
    absorbed: int = ABSORBED, top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 and 3 words.

    A phrase's score is floor(1000000 a a / (l r)) of its weakest cut.  Phrases that occur for ``absorbed``
    per cent or more inside one longer phrase are left out.  A null text is empty, a null language is ``und``;
    repeated rows count each, a null key only takes part in sampling; an empty table gives no rows; other
    columns are ignored.
    """
    counts = frequent_phrases(docs, key, text, lang, support)
    words = F.split("phrase", " ")
    parts = counts.where("k between 1 and 2").select("lang", F.col("phrase").alias("part"), F.col("n").alias("m"))
    phrases = counts.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    cuts = phrases.select(
        "lang", "k", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    ).select(
        "lang", "k", "phrase", "a", "cut", F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("tail"),
    )
    both = cuts.join(parts.select("lang", F.col("part").alias("head"), F.col("m").alias("l")), ["lang", "head"]).join(
        parts.select("lang", F.col("part").alias("tail"), F.col("m").alias("r")), ["lang", "tail"]
    )
    exact = {c: f"cast({c} as decimal(15,0))" for c in "alr"}
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * ({exact['a']} * {exact['a']})) div ({exact['l']} * {exact['r']})")
    best = both.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("k").alias("k"), F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("c")
    )
    inside = (
        phrases.where("k > 2").withColumn("w", words)
        .select("lang", "a", F.explode(F.array(*[F.array_join(F.slice("w", i, LONGEST - 1), " ") for i in (1, 2)])).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    kept = best.join(inside, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {absorbed} * a"))
    totals = counts.where("k = 0").select("lang", "n")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of every hashed share of a language first, so that no task sees all phrases of a language
    share = F.pmod(F.xxhash64("phrase"), F.lit(width(docs.sparkSession)))
    shares = kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score", share.alias("share"))
    first = shares.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op11_collocations": op11_collocations}

SQL = {
    "op11_collocations": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) sizes(k)
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), cuts AS (
  SELECT lang, phrase, f AS a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS tail
  FROM counts JOIN (VALUES (1), (2)) c(cut) ON cut < k
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, h.f AS l, t.f AS r, ((1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase, max(f) AS m
  FROM counts, (VALUES (1), (2)) p(i) WHERE k = 3 GROUP BY ALL
), ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN longer USING (lang, phrase) WHERE m IS NULL OR 100 * m < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
