"""Vectors, archives and pages; connected components; the registered queries and the pipeline."""

import base64
import gzip
import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

from claimworks.llm import common, html_text, registry, topk, warc
from claimworks.session import scratch_dir

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare, connect  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# ---- top-k


def brute_topk(rows, k, every):
    out = []
    ok = [(i, [int(__import__("math").floor(1024 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and x == x and abs(x) != float("inf") for x in v)]
    for a, (i, q) in enumerate(ok):
        if i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, c)), j) for b, (j, c) in enumerate(ok) if a != b)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows,query_rows", [(8192, 256), (40, 3)])
def test_topk(spark, block_rows, query_rows):
    random.seed(2)
    rows = [(i, [random.gauss(0, 1) for _ in range(40)]) for i in range(300)]
    rows += [(300, None), (400, [1.0, None]), (500, [float("nan")] * 40), (600, [float("inf")] * 40), (None, [0.5] * 40),
             (700, []), (800, [0.25] * 3), (1, rows[5][1]), (2, rows[5][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    kept = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = topk.topk(frame, every=50, block_rows=block_rows, query_rows=query_rows).collect()
    assert sorted(map(tuple, got)) == brute_topk(kept, 10, 50)


def test_topk_huge_components_and_empty(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, -1.0]), (2, [-1e30, 2.0]), (3, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = 2**63 - 1
    assert [tuple(r) for r in topk.topk(frame).orderBy("rank").collect()] == [(0, 1, 1, top), (0, 2, 3, 0), (0, 3, 2, -top - 1)]
    assert topk.topk(frame.limit(0)).count() == 0


# ---- WARC


PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (3, None, None), (4, "http://d/\r\nX: y", ""),
    (None, "http://e/", "<p>one</p>"), (5, "http://f/", "é" * 70000), (6, "http://g/", "WARC/1.1\r\n\x1f\u008b\b" * 40),
    (7, "http://h/", "x"), (7, "http://h/", "x"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(i, u, h, "k", "r") for i, u, h in rows], "page_id long, url string, html string, key string, ref string")


@pytest.mark.parametrize("split", [64, 999, 1 << 25])
def test_warc_round_trip(spark, split):
    path = scratch_dir(spark, "warc")
    warc.write_warc(pages(spark), path)
    got = []
    for r in warc.read_warc(spark, path, split).collect():
        key = r.headers["warc-record-id"][len("<urn:page:"):-1]
        got.append((key, r.headers["warc-type"], r.headers.get("warc-refers-to", "")[len("<urn:page:"):-1],
                    bytes(r.payload), r.http_headers["content-length"], r.headers["warc-payload-digest"]))
    first = {}
    for i, _, h in sorted((p for p in PAGES if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(h or "", i)
    want = []
    for i, _, h in PAGES:
        body = (h or "").encode()
        original = first[h or ""] == i
        digest = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((str(i), "response" if original else "revisit", "" if original else str(first[h or ""]),
                     body if original else b"", str(len(body)), digest))
    assert sorted(got) == sorted(want)


def test_small_payloads_stay_responses(spark):
    path = scratch_dir(spark, "warc")
    warc.write_warc(pages(spark), path, min_revisit_bytes=5)
    kinds = {r.headers["warc-record-id"]: r.headers["warc-type"] for r in warc.read_warc(spark, path).collect()}
    assert kinds["<urn:page:4>"] == "response" and kinds["<urn:page:2>"] == "revisit"


def test_reader_takes_foreign_archives(spark, tmp_path):
    """Noise between members, a member without a record, a stored member full of magic, a cut-off end."""
    records = [warc.record(i, "http://x/", bytes([i]) * (i * 50), None, warc.DATE) for i in range(20)]
    blob = b""
    for i, r in enumerate(records):
        blob += gzip.compress(r, 0 if i % 5 == 0 else 6) + (b"\x1f\x8b\x08junk" if i % 3 == 0 else b"")
    blob += gzip.compress(b"no record") + gzip.compress(warc.MAGIC * 500, 0) + gzip.compress(records[0])[:-9]
    (tmp_path / "a.warc.gz").write_bytes(blob)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    for split in (17, 300, 1 << 20):
        got = sorted(r.headers["warc-record-id"] for r in warc.read_warc(spark, str(tmp_path), split).collect())
        assert got == sorted(f"<urn:page:{i}>" for i in range(20))


def test_empty_archive(spark):
    path = scratch_dir(spark, "warc")
    warc.write_warc(pages(spark, []), path)
    assert warc.read_warc(spark, path).count() == 0


# ---- HTML


SHELL = (
    '<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></li>'
    '<li><a href=y>News</a></li></ul></nav><div class="ad">Buy now</div><article><h1>{title}</h1>{body}</article>'
    "<footer>&copy; someone</footer></body></html>"
)


def page(i):
    paras = [f"Sentence {j} of page {i}, with some words, and more &amp; more. It goes on for a while." for j in range(2 + i % 5)]
    html = SHELL.format(title=f"Title {i}", body="".join(f"<p>{p}<br>next  line</p>" for p in paras))
    return html, "\n\n".join([f"Title {i}"] + [p.replace("&amp;", "&") + " next line" for p in paras])


def test_main_text_of_known_pages(spark):
    made = [page(i) for i in range(60)]
    rows = [(i, "u", h) for i, (h, _) in enumerate(made)] + [(100, "u", None), (101, None, ""), (None, "u", made[0][0])]
    got = {(r.page_id, r.url): r.text for r in html_text.extract(pages(spark, rows)).collect()}
    assert all(got[(i, "u")] == t for i, (_, t) in enumerate(made))
    assert got[(100, "u")] == "" and got[(101, None)] == "" and got[(None, "u")] == made[0][1]


def test_other_templates():
    model = html_text.train([page(i)[0] for i in range(60)])
    para = "A long paragraph with several words, some commas, and a full stop. And another sentence follows here."
    html = (
        '<body><div id="page"><div class="topnav menu"><a href=x>Home</a></div><div class="cookie-banner"><p>We use cookies.</p></div>'
        f'<div class="post-content"><h1>Head</h1><p>{para}</p><form><label>Name</label><input></form><p>{para}</p></div>'
        '<aside>Related</aside><div id="comments"><p>Nice read, thanks a lot for it, really.</p></div></div></body>'
    )
    dom = html_text.parsed(html)
    text = html_text.decode(dom, html_text.boosting.predict(model, html_text.features(dom)))
    assert text == f"Head\n\n{para}\n\n{para}"


@pytest.mark.parametrize("html", ["", "  ", "plain", "<", "<p", "</p></p>", "<div>" * 3000, "<b><i>x", "<!-- c", "&#xD800;&bogus;", "<script>x"])
def test_broken_markup_does_not_crash(html):
    dom = html_text.parsed(html)
    x = html_text.features(dom)
    assert isinstance(html_text.decode(dom, html_text.fallback(x)), str)


@pytest.mark.parametrize("left_open", [
    "<html><head><title>x</title><body><article>{}</article>", "<html><head><meta charset=x><article>{}</article>",
    "<head><noscript><img src=x><body><article>{}</article></body>", "<body><div><button>Menu</div><article>{}</article></body>",
    "<body><svg><path d=x><article>{}</article></body>", "<body><select><option>a<option>b<article>{}</article></body>",
    "<body><noscript><article>{}</article></body>", "<body><noscript><dialog><div>{}</div>",
    "<body><form action=x><input name=state><article>{}</article></form></body>", "<body><form action=x><article>{}</article>",
])
def test_elements_left_open_do_not_swallow_the_page(left_open):
    dom = html_text.parsed(left_open.format("<h1>Head</h1><p>One sentence, and more.</p>"))
    assert html_text.decode(dom, html_text.fallback(html_text.features(dom))) == "Head\n\nOne sentence, and more."


NAMED_WRAPPERS = [
    "<body class='right-sidebar'><nav><a href=x>Home</a></nav><article>{}</article></body>",
    "<body><div class='content with-sidebar'>{}</div><div class='sidebar'><a href=x>Other</a></div></body>",
    "<body><div class='nav'><a href=x>Home</a></div><div class='post-content social'>{}</div></body>",
    "<body><div class='search-page'><div class='nav'><a href=x>Home</a></div><main>{}</main></div></body>",
]


@pytest.mark.parametrize("shell", NAMED_WRAPPERS)
@pytest.mark.parametrize("trained", [True, False])
def test_a_name_does_not_empty_a_page(shell, trained):
    model = html_text.train([page(i)[0] for i in range(60)]) if trained else None
    para = "A long paragraph with several words, some commas, and a full stop. And another sentence follows here."
    head = "<header class='entry-header'><h1>Head</h1></header>"
    dom = html_text.parsed(shell.format(head + f"<p>{para}</p>" * 4))
    x = html_text.features(dom)
    text = html_text.decode(dom, html_text.boosting.predict(model, x) if trained else html_text.fallback(x))
    assert text == "\n\n".join(["Head"] + [para] * 4)


def test_a_name_costs_a_finite_amount():
    dom = html_text.parsed("<body><div class=related>" + "<p>a</p>" * 9 + "</div>" + "<p>b</p>" * 9 + "</body>")
    import numpy as np

    assert "a" in html_text.decode(dom, np.full(len(dom.tag), 2.0))
    assert "a" not in html_text.decode(dom, np.full(len(dom.tag), 1.0))


def test_end_tags_of_deep_elements_close_nothing_else():
    deep = "<div>" * 300 + "x" + "</div>" * 300
    dom = html_text.parsed(f"<div><section>{deep}<p>after</p></section></div>")
    assert dom.tag[dom.parent[dom.tag.index("p")]] == "section"
    dom = html_text.parsed("<div><noscript><div>x</div><span></noscript><p>y</p></div>")
    assert dom.tag[dom.parent[dom.tag.index("p")]] == "div" and not any("x" in t for ts in dom.text for t in ts)


def test_rejected_ancestor_takes_its_descendants():
    dom = html_text.parsed("<div><section><p>a</p><p>b</p></section><p>c</p></div>")
    odds = {"#root": 1, "div": 1, "section": -5}
    score = [odds.get(t, 1.0) for t in dom.tag]
    import numpy as np

    assert html_text.decode(dom, np.array(score, float)) == "c"


# ---- components


def test_components_of_paths_stars_and_cycles(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(0, 120)] + [(500, i) for i in range(501, 560)] + [(700, 701), (701, 702), (702, 700), (9, 9), (700, 701)]
    random.shuffle(edges)
    frame = spark.createDataFrame(edges + [(None, 3), (4, None)], "a long, b long")
    got = {r.node: r.component for r in common.components(frame).collect()}
    want = {i: 0 for i in range(121)} | {i: 500 for i in range(500, 560)} | {i: 700 for i in (700, 701, 702)}
    assert got == want
    assert common.components(frame.limit(0)).count() == 0


# ---- registered queries


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in registry.oracle_sql()])
def test_queries_equal_their_sql(spark, name):
    assert compare(registry.queries()[name](spark, SF), connect(SF), registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in registry.oracle_sql()])
def test_other_queries_return_all_rows(spark, name):
    source = "pages" if name.startswith(("op2_", "op9_")) else "documents"
    rows = registry.queries()[name](spark, SF)
    total = common.table(spark, SF, source).count()
    assert rows.count() >= total


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = common.table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
            after = docs.count()
            assert after <= before and (name != "pii" or after == before)
            before = after
        if name == "pii":
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    assert docs.select("doc_id").distinct().count() == before
