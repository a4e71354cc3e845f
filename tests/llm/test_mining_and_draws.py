"""Collocations, resampling and exact copies against brute force, on awkward rows and on empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import docs, long_text, texts

from claimworks.llm import collocations, exact_dedup, resampling


def same(got, want):
    return Counter(map(tuple, got)) == Counter(want)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- collocations


def brute_collocations(rows, support=10, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    counts = {p: n for p, n in counts.items() if n >= support}
    out = []
    for lang in totals:
        found = []
        for (name, phrase), a in counts.items():
            if name != lang or len(phrase) == 1:
                continue
            if any(name == lang and len(q) == 3 and len(phrase) == 2 and phrase in (q[:2], q[1:]) and 100 * n >= 50 * a
                   for (name, q), n in counts.items()):
                continue
            cuts = []
            for cut in range(1, len(phrase)):
                left, right = counts[lang, phrase[:cut]], counts[lang, phrase[cut:]]
                cuts.append((1000000 * a * a // (left * right), cut, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def tongues(seed, n):
    rnd = random.Random(seed)
    names = ["en", "de", None, "und", ""]
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünter", "naïve", "a", "A", "😀"]
    rows = []
    for i in range(n):
        words = rnd.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rnd.randrange(0, 40))
        gaps = rnd.choices([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "], weights=[20, 2, 1, 1, 1, 1, 1, 1], k=len(words))
        rows.append((i if i % 7 else None, "".join(w + g for w, g in zip(words, gaps)), rnd.choice(names)))
    return rows + [(1, None, "en"), (2, "", None), (3, " .,; ", "xx"), (4, "w0 w1 " * 3000, "en"), (4, "w0 w1 " * 3000, "en")]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_are_those_of_a_full_count(spark, seed, monkeypatch):
    rows = tongues(seed, 300)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as k", "'x' as phrase", "2 as n")
    want = brute_collocations([(t, la) for _, t, la in rows])
    assert want and same(collocations.collocations(frame).collect(), want)
    # slabs of one document each, a sample that proposes next to nothing, tables that let much through
    monkeypatch.setattr(collocations, "SLAB_BYTES", 1)
    monkeypatch.setattr(collocations, "SAMPLE_SUPPORT", 10_000)
    monkeypatch.setattr(collocations, "LEAST_BITS", 5)
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    assert same(collocations.collocations(frame).collect(), want)
    top = collocations.collocations(frame, top=3).collect()
    assert same(top, brute_collocations([(t, la) for _, t, la in rows], top=3))


def test_a_border_failure_leads_to_further_passes(spark, monkeypatch):
    # no document is in the sample: words come first, then pairs of frequent words, then triples
    calls = []
    first = collocations.counted
    monkeypatch.setattr(collocations, "counted", lambda *a: calls.append(a[2]) or first(*a))
    monkeypatch.setattr(collocations, "SAMPLE_SUPPORT", 10**9)
    frame = spark.createDataFrame([(i, "x y z", "en") for i in range(40)], "doc_id long, text string, lang string")
    monkeypatch.setattr(collocations, "SUPPORT", 10)
    got = collocations.frequent_phrases(frame, support=12).collect()
    assert same(got, [("en", 0, "", 120)] + [("en", p.count(" ") + 1, p, 40) for p in ("x", "y", "z", "x y", "y z", "x y z")])
    assert len(calls) >= 2 and calls[0] == [1, 2]


def test_filters_miss_no_key(spark):
    rng = np.random.default_rng(5)
    keys = rng.integers(-2**63, 2**63 - 1, 5000)
    table = collocations.filter_of(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    holds = collocations.Filter(table.value)
    assert holds(keys.view(np.uint64)).all()
    assert holds(rng.integers(0, 2**63, 20000).astype(np.uint64)).mean() < 0.1


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(1, None), (2, "")])).count() == 0


# ---- resampling


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))


def brute_resampling(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    def features(text):
        words = words_of(text)
        return [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets
                for k in range(1, longest + 1) for i in range(len(words) - k + 1)]

    source, aim = Counter(), Counter()
    for _, text in rows:
        source.update(features(text))
    for text in target:
        aim.update(features(text))
    s_all, t_all = sum(source.values()), sum(aim.values())
    scored = []
    for key, text in rows:
        held = features(text)
        weight = sum(
            math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in held
        )
        digits = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8]
        noise = math.floor(-1000 * math.log(-math.log((int(digits, 16) + 0.5) / 4294967296)))
        scored.append((key, len(held), weight, weight + noise, len(words_of(text))))
    order = sorted((r for r in scored if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(order[:percent * len(order) // 100])]
    rest = order[percent * len(order) // 100:] + [r for r in scored if r[4] < least]
    return drawn + [(*r[:4], None) for r in rest]


def many(n=150):
    rnd = random.Random(9)
    pool = long_text(400, 5).split(" ") + ["Ünter", "naïve", "l’été", "😀", "a-b_c", "don't"]
    rows = [(i, rnd.choice([" ", "\n", "--", ", "]).join(rnd.choices(pool, k=rnd.randrange(0, 60)))) for i in range(100, 100 + n)]
    return rows + texts()


@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (3, 70_000), (2, 97)])
def test_resampling_equals_brute_force(spark, longest, buckets):
    rows, target = many(), [t for _, t in texts()] + [long_text(300, 4)]
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, k int")
    got = resampling.resample(docs(spark, rows), aim, longest=longest, buckets=buckets).collect()
    assert same(got, brute_resampling(rows, target, longest, buckets))
    assert sum(r["rank"] is not None for r in got) > 10


def test_overlapped_scan_finds_every_run():
    line = resampling.collapsed("  The don't\tÜber--x 42 ".encode())
    found = [m[0].decode() for m in resampling.gram_pattern(2).finditer(line, overlapped=True)]
    assert found == ["the don", "don t", "t Über", "Über x", "x 42"]


def test_resampling_of_empty_tables(spark):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.resample(docs(spark, []), nothing).count() == 0
    got = resampling.resample(docs(spark, many(30)), nothing).collect()
    assert same(got, brute_resampling(many(30), []))


def test_ranks_run_over_ranges_with_ties(spark):
    rows = [(i % 3, i) for i in range(500)]
    frame = spark.createDataFrame(rows, "score long, k long").repartition(7)
    got = resampling.ranked(frame, [frame["score"].desc(), frame["k"].asc()], percent=50).collect()
    want = {k: i + 1 for i, (s, k) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    assert all(r["rank"] == (want[r.k] if want[r.k] <= 250 else None) for r in got) and len(got) == 500


# ---- exact copies


def brute_copies(rows):
    groups = {}
    for i, (key, text) in enumerate(rows):
        groups.setdefault(text or "", []).append((-math.inf if key is None else key, -i))
    out = []
    for i, (key, text) in enumerate(rows):
        group = groups[text or ""]
        best = max(group)
        out.append((key, best[0] if best[0] > -math.inf else None, len(group),
                    None, hashlib.sha256((text or "").encode()).hexdigest()))
    return out, len(groups)


def copies():
    long = long_text(9000, 3)
    rows = texts() + [(i, "hot " * 3000) for i in range(200, 320)] + [(i, long) for i in range(400, 405)]
    edges = [long[:cut] for cut in (4095, 4096, 4097, 8191, 8192, 8193, 12288, 12289)]
    rows += [(500 + i, t) for i, t in enumerate(edges * 2)]
    rows += [(600, long[:20000] + "x" + long[20001:40000]), (601, long[:40000]), (602, long[:8192] + "\0"), (603, long[:8192])]
    return rows + [(None, "one two"), (None, "alone without key"), (None, "alone without key")]


@pytest.mark.parametrize("block", [4096, 8, 64])
def test_copies_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK", block)
    rows = copies() if block > 8 else [r for r in copies() if len(r[1] or "") < 40_000]
    got = exact_dedup.exact_copies(docs(spark, rows)).collect()
    want, groups = brute_copies(rows)
    assert same([(r.doc_id, r.keep_id, r.group_size, None, r.text_sha256) for r in got], want)
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_names_are_equal_for_equal_keys_only(spark):
    rows = [(i, (i * 7) % 50 if i % 3 else 1, i % 2) for i in range(3000)]
    frame = spark.createDataFrame(rows, "row long, a long, b long").selectExpr("*", "a as x", "b as y")
    got = exact_dedup.named(frame, ["a", "b"], ["row"]).collect()
    by_name, by_key = {}, {}
    for r in got:
        by_name.setdefault(r["name"], set()).add((r.x, r.y))
        by_key.setdefault((r.x, r.y), set()).add(r["name"])
    assert all(len(v) == 1 for v in by_name.values()) and all(len(v) == 1 for v in by_key.values())
    assert any(n < 0 for n in by_name)  # the hot key was named beforehand


def test_copies_after_normalising_and_of_empty_tables(spark):
    from pyspark.sql import functions as F

    got = exact_dedup.exact_copies(docs(spark, [(1, "A b"), (2, "a B"), (3, "c")]), normalise=F.lower).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)}
    assert exact_dedup.exact_copies(docs(spark, [])).count() == 0
