"""Operators on texts against brute force, on awkward rows and on empty tables."""

import hashlib
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import docs, long_text, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimworks.llm import bpe, licenses, ngram_join, packing, pii, syncmers, toxicity

PATH = bpe.public_vocabulary()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def same(got, want):
    return Counter(map(tuple, got)) == Counter(want)


# ---- n-gram join


def shingles(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if comp[j] == comp[i] and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(keys) if keys else None))
    return out


def test_join_on_awkward_rows(spark):
    rows = texts()
    assert same(ngram_join.similarity_classes(docs(spark)).collect(), brute_classes(rows))


def test_join_over_split_units(spark, monkeypatch):
    """Small work units: one family of near copies, chained families and copies, over many units."""
    import random

    random.seed(5)
    rows, key = [], 0
    for family in range(6):
        words = long_text(120, 100 + family).split(" ")
        for _ in range(14):
            copy = words[:]
            for _ in range(random.randint(0, 3)):
                copy[random.randrange(len(copy))] = f"edit{random.randrange(10**6)}"
            key += 1
            rows.append((key, " ".join(copy)))
    common = " ".join(long_text(60, 999).split(" "))
    rows += [(1000 + i, common + " " + long_text(20 + 15 * i, 2000 + i)) for i in range(12)]
    random.shuffle(rows)
    monkeypatch.setattr(ngram_join, "UNIT_MASS", 400)
    monkeypatch.setattr(ngram_join, "LEADERS", 1)
    assert same(ngram_join.similarity_classes(docs(spark, rows)).collect(), brute_classes(rows))


@pytest.mark.parametrize("mass, dominant", [(300, 2), (1 << 21, 2), (300, 10**6)])
def test_last_look_alone_finds_all_links(spark, monkeypatch, mass, dominant):
    """One turn with a label that is the same for next to no two sets: prefix shingles must bring the rest together."""
    import random

    random.seed(11)
    rows = []
    for family in range(4):
        words = long_text(70 + 30 * family, 300 + family).split(" ")
        for _ in range(25):
            copy = words[:]
            for _ in range(random.randint(0, 4)):
                copy[random.randrange(len(copy))] = f"edit{random.randrange(30)}"
            rows.append((len(rows), " ".join(copy)))
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "UNIT_MASS", mass)
    monkeypatch.setattr(ngram_join, "DOMINANT", dominant)
    monkeypatch.setattr(ngram_join, "set_task", unlike_labels(ngram_join.set_task))
    assert same(ngram_join.similarity_classes(docs(spark, rows)).collect(), brute_classes(rows))


def unlike_labels(task):
    def run(batches):
        for batch in task(batches):
            own = [[cid] for cid in batch.column(0).to_pylist()]
            columns = [*batch.columns[:2], pa.array(own, pa.list_(pa.int64())), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def test_roots_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(150)] + [(500, i) for i in range(501, 560)] + [(700, 701), (701, 702), (702, 700), (9, 9), (700, 701)]
    got = {r.node: r.root for r in ngram_join.roots_of(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = [range(151), range(500, 560), (700, 701, 702)]
    assert set(got) == {n for g in groups for n in g}
    assert [len({got[n] for n in g}) for g in groups] == [1, 1, 1] and len(set(got.values())) == 3
    assert ngram_join.roots_of(spark.createDataFrame([(9, 9)], "a long, b long")).count() == 0


def test_family_of_copies_that_do_not_link_moves_few_rows(spark, monkeypatch):
    """2000 copies with so many edits that hardly any two link: sets travel a bounded number of times."""
    import random

    random.seed(3)
    words = long_text(60, 8).split(" ")
    rows = []
    for i in range(2000):
        copy = words[:]
        for at in random.sample(range(len(copy)), 3):
            copy[at] = f"edit{random.randrange(40)}"
        rows.append((i, " ".join(copy)))
    moved, first = [], ngram_join.in_units
    monkeypatch.setattr(ngram_join, "in_units", lambda frame: moved.append(frame.count()) or first(frame))
    got = ngram_join.similarity_classes(docs(spark, rows)).collect()
    assert same(got, brute_classes_fast(rows))
    assert sum(moved) < 8 * len(rows)


def brute_classes_fast(rows):
    sets = [shingles(t) for _, t in rows]
    known = {}
    for s in sets:
        for g in s:
            known.setdefault(g, len(known))
    grid = np.zeros((len(sets), len(known)), np.float32)
    for i, s in enumerate(sets):
        grid[i, [known[g] for g in s]] = 1
    size, shared = grid.sum(1), grid @ grid.T
    linked = 100 * shared >= 80 * (size[:, None] + size[None] - shared)
    comp = np.arange(len(sets))
    while True:
        least = np.where(linked, comp[None], len(sets)).min(1)
        if (least >= comp).all():
            return [(rows[i][0], len(s), rows[int(comp[i])][0]) for i, s in enumerate(sets)]
        comp = np.minimum(comp, least)


def test_divide_skip_finds_what_counting_finds():
    rng = np.random.default_rng(3)
    core = rng.integers(0, 10**9, 60)
    sets = [np.unique(np.concatenate([rng.permutation(core)[:rng.integers(40, 60)], rng.integers(0, 10**9, rng.integers(0, 12))]))
            for _ in range(80)]
    index = ngram_join.Index(sets)
    for i, s in enumerate(sets):
        want = {j for j, t in enumerate(sets)
                if 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))}
        assert set(index.search(index.places[i], len(s), np.ones(len(sets), bool))) == want


def test_one_per_class(spark):
    kept = [r.doc_id for r in ngram_join.one_per_class(docs(spark)).select("doc_id").collect()]
    assert sorted(k for k in kept if k is not None) == [1, 3, 5, 6, 7, 8, 10, 11, 12, 14, 15, 16]
    assert kept.count(None) == 1


# ---- byte-level BPE


def test_bpe_equals_the_library(spark, tokenizer):
    rows = [(i, t) for i, t in enumerate(
        [t for _, t in texts()] + ["aaaaaaaaaaaaaaa", "a  b   c ", "日本語テスト", "\x1c\x85 \x00", "١٢٣ 12345", "...", " \n \n", "we'll we'LL I'm"]
    )]
    ids = bpe.encode(docs(spark, rows), PATH)
    got = {r.doc_id: r.ids for r in ids.collect()}
    for key, text in rows:
        assert got[key] == tokenizer.encode(text or "", add_special_tokens=False).ids, text
    back = {r.doc_id: r.decoded for r in bpe.decode(ids, PATH).collect()}
    assert back == {k: t or "" for k, t in rows}


def test_bpe_cache_overflow_changes_nothing(tokenizer):
    vocab = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    encoder = bpe.Encoder(vocab, limit=50)
    for seed in range(4):
        text = long_text(300, seed)
        ids = np.frombuffer(encoder.encode([text, text])[1], np.int32).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_decode_of_broken_bytes(spark, tokenizer):
    frame = spark.createDataFrame([(1, [255, 100, 50256]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(frame, PATH).collect()}
    assert got == {1: tokenizer.decode([255, 100, 50256], skip_special_tokens=False), 2: "", 3: ""}


# ---- packing


def test_packing(spark, tokenizer):
    rows = texts()
    got = packing.pack_documents(docs(spark), PATH).collect()
    want = Counter()
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for j, (start, size) in enumerate(packing.cut(len(ids), 2048)):
            part = np.array(ids[start:start + size], np.uint32).tobytes()
            want[(key, j, start, size, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 2048
    assert len(bins) == packing.bound(Counter(r.length for r in got), 2048)


@pytest.mark.parametrize("seed", range(12))
def test_plans_hold_all_items_and_small_ones_are_best(seed):
    import random

    random.seed(seed)
    capacity = random.choice([10, 17, 30])
    counts = Counter(random.randint(1, capacity) for _ in range(random.randint(1, 9)))
    patterns, proven = packing.search(dict(counts), capacity)
    assert proven
    held = Counter()
    for times, content in patterns:
        assert sum(s * n for s, n in content.items()) <= capacity
        for s, n in content.items():
            held[s] += times * n
    assert held == counts
    items = sorted(counts.elements(), reverse=True)

    def fits(rest, rooms):
        if not rest:
            return True
        seen = set()
        for i, room in enumerate(rooms):
            if room >= rest[0] and room not in seen:
                seen.add(room)
                if fits(rest[1:], rooms[:i] + [room - rest[0]] + rooms[i + 1:]):
                    return True
        return False

    used = sum(t for t, _ in patterns)
    assert used == 1 or not fits(items, [capacity] * (used - 1))


def test_searches_beat_best_fit_and_say_when_work_is_used_up():
    # best fit pairs 6 with 4 and leaves the threes; 6+3+1 and 4+4+2 waste nothing
    counts = {6: 2, 4: 2, 3: 2, 2: 1, 1: 2}
    assert sum(t for t, _ in packing.search(counts, 10)[0]) == packing.bound(counts, 10) == 3
    rng = np.random.default_rng(5)
    counts = Counter(rng.integers(300, 1100, 150).tolist())
    patterns, proven = packing.search(counts, 2048, work=1)
    assert not proven and sum(t for t, _ in patterns) == sum(t for t, _ in packing.best_fit(counts, 2048))
    beaten = 0
    for seed in range(40):
        counts = Counter(np.random.default_rng(seed).integers(5, 60, 25).tolist())
        plain = sum(t for t, _ in packing.best_fit(counts, 100))
        patterns, proven = packing.search(counts, 100)
        used = sum(t for t, _ in patterns)
        beaten += used < plain
        assert used <= plain and (proven or used > packing.bound(counts, 100))
    assert beaten


def test_all_undominated_fillings_come_least_waste_first():
    from itertools import product

    counts = {9: 1, 7: 3, 4: 2, 3: 4, 2: 1}
    got = [tuple(sorted(c.items())) for c in packing.fillings(9, counts, 23, 23, packing.Budget(10**6))]
    want = []
    for ns in product(*(range(n + 1) for n in counts.values())):
        content = {s: n for s, n in zip(counts, ns) if n}
        free = 23 - sum(s * n for s, n in content.items())
        if content.get(9) != 1 or free < 0:
            continue
        out = [s for s in counts if counts[s] > content.get(s, 0)]
        if not any(s <= free or any(t != 9 and t < s <= t + free for t in content) for s in out):
            want.append((free, tuple(sorted(content.items()))))
    assert sorted(got) == sorted(c for _, c in want) and len(set(got)) == len(got)
    wastes = [23 - sum(s * n for s, n in c) for c in got]
    assert wastes == sorted(wastes)


def test_pack_keeps_other_columns_and_refuses_wrong_lengths(spark):
    items = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (3, None, 3)], "length int, tag string, offset int")
    out = packing.pack(items, capacity=8).collect()
    assert sorted((r.length, r.tag or "") for r in out) == [(3, ""), (5, "a"), (5, "b")]
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(9,)], "length int"), capacity=8)


# ---- personal data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return tuple(out)


AWKWARD = [
    "a@b.c_d@e.f a@b.c.d@e.f a@b.c._x@e.f x@y z@1.2.3.4.5", "+1 (017) 555-7713 ++1 22 33 44 55 66  +12",
    "😀😀 1.2.3.4 é 256.1.1.1 1.2.3.4.5.6.7.8 00000255.1.1.1 4111 1111-1111 1111 4111111111111111 4111111111111112",
    "9" * 5000 + " " + "a" * 20000 + "@b.c", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "+1.2.3.4 5.6.7.8-9", "a.b@c.d." * 200,
]


def test_base_spans_equal_the_patterns(spark):
    rows = texts() + [(100 + i, t) for i, t in enumerate(AWKWARD)]
    got = pii.spans(docs(spark, rows)).collect()
    assert same(
        [(r.key, tuple((s.kind, s.start, s.stop) for s in r.found if s.base)) for r in got],
        [(k, base_spans(t or "")) for k, t in rows],
    )


def test_trees_add_spans_that_do_not_overlap(spark):
    """Enough labelled numbers: loose card numbers with a sound check sum outside the base patterns."""
    def number(i, good):
        head = f"4{i:014d}"
        return next(head + str(d) for d in range(10) if luhn(head + str(d)) == good)

    rows = [(i, f"pay card {number(i * 7919, i % 4 != 0)} now") for i in range(400)]
    dotted = number(12345, True)
    rows.append((1000, "card " + ".".join(dotted[j:j + 4] for j in (0, 4, 8, 12)) + " and " + dotted))
    for r in pii.spans(docs(spark, rows)).collect():
        ordered = sorted((s.start, s.stop) for s in r.found)
        assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
        assert [(s.kind, s.start, s.stop) for s in r.found if s.base] == list(base_spans(dict(rows)[r.key]))


@pytest.mark.parametrize("copies", [1, 40])
def test_loose_spans_do_not_hang_on_the_size_of_the_table(spark, copies):
    """The same spans are added to a few documents and to many, and prose, times and years are left alone."""
    found = [
        ("email", "jane.roe [at] mail [dot] org", "mail"), ("ip", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "host"),
        ("card", "4111.1111.1111.1111", "card"), ("phone", "(212) 555 0147", "call"),
    ]
    left = ["available at github.com", "look at home.Then", "12:30:45:10", "2001/2002/2003/2004", "2010 2011 2012"]
    rows = [(i, f"{word} {value} here") for i, (_, value, word) in enumerate(found)]
    rows += [(100 + i, f"it is {value} now") for i, value in enumerate(left)]
    rows += [(1000 + i, f"note {i} of mail n{i}x@web{i}.org and 10.0.{i % 256}.7 since {1000 + i}") for i in range(copies * 5 - 5)]
    got = {r.key: [(s.kind, s.start, s.stop) for s in r.found if not s.base] for r in pii.spans(docs(spark, rows)).collect()}
    assert [got[i] for i in range(len(found))] == [[(k, 5, 5 + len(v))] for k, v, _ in found]
    assert [got[100 + i] for i in range(len(left))] == [[]] * len(left)


def test_redaction(spark):
    rows = [(1, "é mail a@b.cd, ip 1.2.3.4!"), (2, None), (3, ""), (4, "nothing"), (1, "é mail a@b.cd, ip 1.2.3.4!")]
    got = [(r.doc_id, r.text) for r in pii.redact(docs(spark, rows)).collect()]
    want = [(k, t.replace("a@b.cd", "[EMAIL]").replace("1.2.3.4", "[IP]") if t else t) for k, t in rows]
    assert same(got, want)


# ---- fingerprints


def test_every_labelled_candidate_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(pii, "STRATUM", 5)
    rows = [(i, f"mail a{i}@example.org and 4111.1111.1111.{i:04d}") for i in range(40)]
    found = pii.candidates(docs(spark, rows), "doc_id", "text").where("kind is not null")
    known = pii.labelled(found.withColumn("base", ~F.col("loose") & pii.sound()))
    alike = pii.added_up(known).collect()
    assert sum(r.n for r in alike) == known.count() >= 80
    weights = {}
    for r in alike:
        key = r.kind, r.loose, r.label
        weights[key] = weights.get(key, 0) + r.weight
    assert weights["email", False, 1.0] == pytest.approx(5) and max(weights.values()) <= 5 + 1e-9


@pytest.mark.parametrize("part", [3, 4096])
def test_fingerprints(spark, part):
    rows = [(k, t) for k, t in texts() if k is not None and k != 13]
    got = {r.doc_id: r for r in syncmers.fingerprints(docs(spark, rows), rows_per_part=part).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        changed = text[:len(text) - n] + following[:n]
        mine, after = syncmers.sketch(text), syncmers.sketch(changed)
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (syncmers.shown(mine), syncmers.shown(after))
        assert r.near_edited == syncmers.likeness(mine, after)
        assert r.near_next == syncmers.likeness(mine, syncmers.sketch(following))
    assert got[8].fingerprint != got[9].fingerprint


def test_repeated_and_null_keys_are_all_fingerprinted(spark):
    assert syncmers.fingerprints(docs(spark)).count() == len(texts())


def test_syncmers_do_not_depend_on_what_stands_around():
    text = np.frombuffer(long_text(300).encode("utf-32-le"), np.uint32)
    at, hashes = syncmers.anchors(text)
    shifted_at, shifted = syncmers.anchors(np.concatenate([text[:500][::-1], text]))
    inside = {(int(a) + 500, int(h)) for a, h in zip(at, hashes)}
    assert inside <= {(int(a), int(h)) for a, h in zip(shifted_at, shifted)}
    for pos in at[:50]:
        window = text[pos:pos + syncmers.K]
        assert len(syncmers.anchors(window)[0]) == 1


def mixed(z):
    """The 64-bit finaliser, one number at a time."""
    m = 2**64 - 1
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & m
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & m
    return z ^ (z >> 31)


def plain_anchor_places(text):
    """Places of the closed syncmers by their definition: each k-mer with all its inner substrings."""
    step, first, m = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 2**64 - 1
    inner = []
    for i in range(len(text) - syncmers.S + 1):
        z = 0
        for c in text[i:i + syncmers.S]:
            z = (z * first + ord(c) * step) & m
        inner.append(mixed(z))
    out = []
    for i in range(len(text) - syncmers.K + 1):
        window = inner[i:i + syncmers.K - syncmers.S + 1]
        if min(window) in (window[0], window[-1]):
            out.append(i)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_anchors_against_their_definition(seed):
    text = long_text(300, seed) + "aaaaaaaaaaaaaaaaaaaa \u00e9\U0001f600 end of it"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at, hashes = syncmers.anchors(points)
    assert at.tolist() == plain_anchor_places(text)
    by_kmer = {}
    for p, h in zip(at.tolist(), hashes.tolist()):
        assert by_kmer.setdefault(text[p:p + syncmers.K], h) == h
    assert len(set(by_kmer.values())) == len(by_kmer)


def test_small_edits_of_very_long_texts_show_in_the_fingerprint():
    import random

    for seed in range(10):
        random.seed(seed)
        text = "".join(random.choice("abcdefgh ") for _ in range(100_000))
        at = random.randrange(99_000)
        other = text[:at] + "".join(random.choice("stuvwxyz ") for _ in range(300)) + text[at + 300:]
        mine, theirs = syncmers.sketch(text), syncmers.sketch(other)
        assert mine != theirs
        # the share of all anchors that both texts have is what the fingerprints estimate
        full = [set(syncmers.anchors(np.frombuffer(t.encode("utf-32-le"), np.uint32))[1].tolist()) for t in (text, other)]
        share = 2 * len(full[0] & full[1]) / (len(full[0]) + len(full[1]))
        assert abs(syncmers.likeness(mine, theirs) - share) < 0.01 and syncmers.likeness(mine, theirs) < 1.0


def test_likeness_bounds():
    a = syncmers.sketch(long_text(500, 1))
    b = syncmers.sketch(long_text(500, 2))
    assert syncmers.likeness(a, a) == 1.0 and syncmers.likeness([], []) == 1.0 and syncmers.likeness(a, []) == 0.0
    assert 0.0 <= syncmers.likeness(a, b) < 0.3


# ---- licences


def test_licenses_against_brute_force(spark):
    rows = texts() + [
        (50, "RELEASED!! UNDER!! THE!! MIT!! LICENSE!!"), (51, "licensed under cc by-nc 4.0"),
        (52, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY 4.0."), (53, "the the the the"),
    ]
    got = licenses.scan(docs(spark, rows)).collect()
    want = Counter()
    for key, text in rows:
        for line, body in enumerate((text or "").split("\n")):
            grams = licenses.plain_bigrams(body)
            for i, (name, template) in enumerate(licenses.TEMPLATES):
                other = licenses.plain_bigrams(template)
                if grams and 2 * len(grams & other) / (len(grams) + len(other)) >= licenses.THRESHOLD:
                    want[(key, line, i, name)] += 1
    assert Counter((r.key, r.line, r.template, r.license) for r in got) == want
    assert want[(15, 1, [n for n, _ in licenses.TEMPLATES].index("MIT") , "MIT")] or any(k[0] == 15 for k in want)


def test_licenses_across_lines_and_inside_longer_ones(spark):
    whole = dict(licenses.full_texts())
    grant = next(b for n, b in licenses.TEMPLATES if n == "MIT" and len(b) > 300)
    rows = [
        (1, "Some words first.\n" + textwrap.fill(grant, 80) + "\nand some words after."),
        (2, "This project is released under the MIT License, see LICENSE."),
        (3, "Copyright (c) 2020 Someone\n\n" + whole["BSD-2-Clause"]),
        (4, "# Notes\n\nof the work and of the license\n\n" + whole["GPL-3.0"] + "\n\nof the program"),
        (5, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\nReleased under the MIT License."),
        (6, "the licence of the software is under the counter " * 30), (7, None), (8, ""),
    ]
    got = sorted((r.key, r.line, r.license, r.dice) for r in licenses.licenses(docs(spark, rows)).collect())
    assert [g[:3] for g in got] == [
        (1, 1, "MIT"), (2, 0, "MIT"), (3, 2, "BSD-2-Clause"), (4, 4, "GPL-3.0"),
        (5, 0, "CC-BY-NC-4.0"), (5, 1, "MIT"), (5, 2, "MIT"),
    ]
    assert all(g[3] > 0.99 for g in got)


# ---- toxicity


def all_segments(scores):
    """Maximal scoring segments by their definition, recursively."""
    best = (0.0, None)
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best[0] + 1e-12:
                best = (total, (i, j + 1))
    if best[1] is None:
        return []
    a, b = best[1]
    return all_segments(scores[:a]) + [(best[0], a, b)] + [(s, f + b, e + b) for s, f, e in all_segments(scores[b:])]


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(1)
    for _ in range(60):
        scores = rng.integers(-4, 4, rng.integers(0, 25)).astype(float) + rng.random() * 0.01
        got = [(round(s, 6), f, e) for s, f, e in toxicity.segments(scores)]
        assert got == [(round(s, 6), f, e) for s, f, e in all_segments(scores.tolist())]


def labelled_docs(spark, n=600):
    bad = ["vilesco", "grumbad", "snarlot", "hatefit"]
    rows, marks = [], []
    for i in range(n):
        words = long_text(40 + i % 30, i + 1).split(" ")
        toxic = i % 5 == 0
        if toxic:
            words[5:5] = [bad[i % 4], bad[(i + 1) % 4], "and", bad[(i + 2) % 4]]
        rows.append((i, " ".join(words)))
        if i % 3:
            marks.append((i, 1, int(toxic), "x"))
    return rows, spark.createDataFrame(marks + [(None, 0, 1, "x"), (3, 0, None, "x")], "doc_id long, quality int, toxic int, text string")


def test_held_out_accuracy_and_spans(spark):
    rows, labels = labelled_docs(spark)
    got = toxicity.score(docs(spark, rows + [(None, None), (9001, ""), (9002, "VILESCO!! grumbad***")]), labels).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    right = sum((r.score >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in held)
    assert right / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    texts_of = dict(rows)
    hit = next(r for r in held if r.doc_id % 5 == 0)
    best = max(hit.segments, key=lambda s: s.score)
    assert any(w in texts_of[hit.doc_id][best.start:best.stop] for w in ("vilesco", "grumbad", "snarlot", "hatefit"))


def test_labels_of_the_held_out_third_do_not_matter(spark):
    rows, labels = labelled_docs(spark, 200)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), flipped).collect()}
    assert a == b


def test_without_toxic_keeps_columns_and_clean_rows(spark):
    rows, labels = labelled_docs(spark)
    frame = docs(spark, rows)
    kept = toxicity.without_toxic(frame, labels)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {i for i in range(600) if i % 5} <= ids and len(ids & {i for i in range(600) if i % 5 == 0}) < 12


def test_one_class_or_no_labels_give_one_level(spark):
    frame = docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len({r.score for r in toxicity.score(frame, none).collect()}) == 1


# ---- empty tables


def test_empty_tables(spark):
    empty = docs(spark, [])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        ngram_join.similarity_classes(empty), ngram_join.one_per_class(empty), bpe.encode(empty, PATH),
        bpe.decode(bpe.encode(empty, PATH), PATH), packing.pack_documents(empty, PATH), pii.spans(empty), pii.redact(empty),
        syncmers.fingerprints(empty), licenses.scan(empty), licenses.licenses(empty), toxicity.score(empty, none),
        toxicity.without_toxic(empty, none),
    ):
        assert out.count() == 0
