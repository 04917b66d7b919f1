"""Language identification, quality scores, decontamination, near duplicates and page text."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_helpers import VOCAB, clash, corpus, frame, prose
from pyspark.sql import functions as F

from ridelake.llm import decontaminate, html_text, langid, near_dup, quality_pu
from ridelake.llm.common import stored


@pytest.fixture(scope="module")
def docs(spark):
    return stored(frame(spark, corpus()), "test-docs")


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# ---- language identification

@pytest.fixture(scope="module")
def net():
    rng = random.Random(3)
    net = langid.BiGru(["de", "en"])
    net.fit({k: [prose(rng, 60, k).encode() for _ in range(60)] for k in ("de", "en")}, steps=60, batch=64, length=32)
    return net


def test_gradients_match_finite_differences():
    net = langid.BiGru(["a", "b", "c"], hidden=3, seed=2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    codes, labels = rng.integers(60, 70, (5, 4)).astype(np.uint8), np.array([0, 1, 2, 0])
    _, g = net.gradients(codes, labels)
    for k in net.p:
        for at in list(np.ndindex(net.p[k].shape))[60 * 9:60 * 9 + 3] if k[0] == "X" else list(np.ndindex(net.p[k].shape))[:3]:
            was, eps = net.p[k][at], 1e-3
            net.p[k][at] = was + eps
            up = net.gradients(codes, labels)[0]
            net.p[k][at] = was - eps
            down = net.gradients(codes, labels)[0]
            net.p[k][at] = was
            assert g[k][at] == pytest.approx((up - down) / (2 * eps), abs=2e-4)


def test_documents_agree_with_one_at_a_time(net):
    rng = random.Random(4)
    raws = [prose(rng, n, "de").encode() for n in (1, 5, 40, 300)] + [b"x", b"12"]
    together = net.documents(raws)
    for raw, row in zip(raws, together):
        assert net.documents([raw])[0] == pytest.approx(row, abs=1e-5)
    assert together[:4].argmax(axis=1).tolist() == [0] * 4 and together[-1].sum() == 0


def test_language_edge_cases(spark, docs, empty, net):
    out = langid.identify(clash(docs), net)
    rows = {r.doc_id: r for r in out.where("doc_id IS NOT NULL").collect()}
    assert out.count() == docs.count()
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (103, 104, 105, 106))
    right = [rows[i].lang_pred == ("de" if i % 3 == 0 else "en") for i in range(60)]
    assert np.mean(right) > 0.95 and all(0 <= r.score <= 1 for r in rows.values())
    assert langid.identify(empty, net).count() == 0
    assert langid.train(empty) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    kept = langid.recognised(clash(docs), net)
    assert kept.columns == clash(docs).columns
    assert {r.doc_id for r in kept.collect()} >= set(range(60)) and kept.where("doc_id IN (103, 104, 105, 106)").count() == 0


def test_language_sample_is_bounded(spark, docs):
    got = langid.sample(docs, per_lang=5)
    assert set(got) == {"de", "en"} and all(0 < len(v) <= 5 for v in got.values())
    assert langid.sample(docs, per_lang=5) == got


def test_foreign_and_noise_documents_are_rejected(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(20, 120), "de" if i % 2 else "en"), "de" if i % 2 else "en", "s", 0) for i in range(500)]
    unsure = [prose(rng, 30, "en") + "\n" + prose(rng, 30, "de"), prose(rng, 3, "en"), prose(rng, 2, "de").upper(), "water " * 500, prose(rng, 10, "de") + " 12 ### 34" * 20]
    polish = "że się nie jest jak przez tylko ale już być może bardzo kiedy więc dlaczego wszystko człowiek życie zawsze miasto".split()
    russian = "и в не на я что он с как это все она так его но да ты к у же вы за бы по только человек город время".split()
    planted = [" ".join(rng.choice(v) for _ in range(80)) for v in (polish, russian) for _ in range(5)]
    planted += ["".join(rng.choice("bcdfghjklmnpqrstvwxz  ") for _ in range(500)) for _ in range(5)]
    rows += [(1000 + i, t, None, "s", 0) for i, t in enumerate(unsure)] + [(2000 + i, t, None, "s", 0) for i, t in enumerate(planted)]
    docs = frame(spark, rows)
    net = langid.train_filter(docs, steps=60, batch=64, length=32)
    kept = {r.doc_id for r in langid.recognised(docs, net).collect()}
    assert kept == set(range(500)) | {1000 + i for i in range(len(unsure))}
    assert all(0 < x < 1 for x in net.sure)


def test_rows_for_calibration_are_not_learned_from(spark, docs):
    learned, spare = langid.sample(docs, spare=False), langid.sample(docs, spare=True)
    assert all(spare.values()) and set(learned) == {"de", "en"} and not set().union(*learned.values()) & set().union(*spare.values())


# ---- quality

def quality_rows(n=1200):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        t = prose(rng, rng.randint(30, 120)) if good else " ".join([rng.choice(VOCAB["en"]).upper() + "!!"] * rng.randint(20, 60))
        docs.append((i, t, "en", "s", 0))
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    return docs, labels


def test_quality_separates_held_out_documents(spark, empty):
    rows, labels = quality_rows()
    docs, labels = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    net = quality_pu.train(docs, labels)
    out = quality_pu.score_quality(clash(docs), net).collect()
    assert len(out) == len(rows)
    right = [r.predicted == int(r.doc_id % 5 != 0) for r in out]
    assert np.mean(right) > 0.95 and all(0 <= r.score <= 1 for r in out)
    odd = frame(spark, corpus(6))
    assert quality_pu.score_quality(odd, net).where("score IS NULL").count() == 0
    assert quality_pu.score_quality(empty, net).count() == 0
    assert quality_pu.train(empty, labels) is None
    assert quality_pu.score_quality(odd, None).where("score <> 0.5").count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(0)
    pos = rng.normal(0, 1, (1500, quality_pu.FEATURES))
    bad = rng.normal(2.5, 1, (600, quality_pu.FEATURES))
    unl = np.vstack((rng.normal(0, 1, (1400, quality_pu.FEATURES)), bad))
    assert quality_pu.estimate_prior(pos, unl[rng.permutation(2000)]) == pytest.approx(0.7, abs=0.08)


# ---- decontamination

def brute_hits(text, items):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = norm(text), set(), set()
    for item, t in items:
        v = norm(t)
        k = min(13, len(v))
        for j in range(len(v) - k + 1 if v else 0):
            for i in range(len(w) - k + 1):
                if w[i:i + k] == v[j:j + k]:
                    hit |= set(range(i, i + k))
                    ids.add(str(item) if item is not None else "")
    return len(w), len(hit), sorted(ids)


def test_decontamination_matches_brute_force(spark, docs, empty):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.choice([3, 13, 20, 40]))) for i in range(12)] + [(3, "one two"), (None, "word"), (50, ""), (51, None), (10, "é😀 Word")]
    rows = corpus(12)
    for i in range(8):
        t = items[i][1].upper().replace(" ", ";  ")
        rows.append((500 + i, f"{prose(rng, 30)}\n{t} ü {prose(rng, 10)}", "en", "s", 0))
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame_ = clash(frame(spark, rows))
    for size in (1 << 20, 200):
        out = decontaminate.find(frame_, bench, block_bytes=size).collect()
        assert len(out) == len(rows)
        for r in out:
            n, hit, ids = brute_hits(r.text, items)
            assert (r.n_words, r.n_hit, r.n_items, r.items) == (n, hit, len(ids), ids)
            assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
            assert r.contaminated == (hit > 0 and 20 * hit >= n)
    r = next(r for r in decontaminate.find(frame_, bench).collect() if r.doc_id == 500)
    assert any(items[0][1].upper().replace(" ", ";  ").strip(".,") in r.text[a:b] for a, b in r.hit_spans) or len(items[0][1].split()) < 13
    assert decontaminate.find(empty, bench).count() == 0
    none = bench.where("false")
    assert decontaminate.find(frame_, none).where("n_hit > 0").count() == 0
    kept = decontaminate.clean_documents(frame_, bench)
    assert kept.columns == frame_.columns and kept.where("doc_id = 107").count() == 0


# ---- near duplicates

def brute_components(rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if a is not None and b is not None and sa and sb and 100 * len(sa & sb) >= 85 * len(sa | sb):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in root}, sets


def near_rows():
    rng = random.Random(9)
    rows = corpus(15)
    for g in range(3):  # chains: every copy changes a few words of the last one
        words = prose(rng, 150).split()
        for k in range(25):
            rows.append((1000 + 100 * g + k, " ".join(words), "en", "s", 0))
            words = list(words)
            for _ in range(rng.choice([0, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_match_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = near_rows()
    want, sets = brute_components(rows)
    out = near_dup.near_duplicates(clash(frame(spark, rows))).collect()
    assert len(out) == len(rows)
    sizes = {d: len(s) for d, s in sets if d is not None}
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], sizes[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_edge_cases(spark, empty):
    assert near_dup.near_duplicates(empty).count() == 0
    rows = [(5, "a b c d e f g", None, None, 0), (5, "completely other words in this second text", None, None, 0),
            (7, "A B c d e f g", None, None, 0), (9, "completely other words in this second TEXT", None, None, 0), (11, None, None, None, 0)]
    out = {(r.doc_id, r.component_id) for r in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert out == {(5, 5), (7, 5), (9, 5), (11, 11)}
    docs = clash(frame(spark, rows))
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [5, 5, 11]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 103), (103, 101)], "a long, b long")
    got = {r.node: r.component for r in near_dup.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(1, 2**63, 2000, dtype=np.uint64)
    for same in (1900, 1700):
        a, b = np.unique(base[:same + 100]), np.unique(np.concatenate((base[:same], rng.integers(1, 2**63, 100, dtype=np.uint64))))
        x, y = (np.frombuffer(near_dup.odd_sketch(near_dup.signature(s)), np.uint8) for s in (a, b))
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert near_dup.similarity(int(np.bitwise_count(x ^ y).sum())) == pytest.approx(exact, abs=0.08)


def test_differing_bits_natively(spark):
    rng = np.random.default_rng(2)
    a, b = rng.bytes(near_dup.BITS // 8), rng.bytes(near_dup.BITS // 8)
    df = spark.createDataFrame([(bytearray(a), bytearray(b))], "a binary, b binary")
    got = df.select(near_dup.differing_bits(F.col("a"), F.col("b")).alias("n")).first().n
    assert got == int(np.bitwise_count(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).sum())


def test_shingle_sets_of_long_texts(monkeypatch):
    text = prose(random.Random(1), 4000)
    whole = near_dup.shingle_set(text)
    monkeypatch.setattr(near_dup, "PIECE", 100)
    assert (near_dup.shingle_set(text) == whole).all()


# ---- page text

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header>Site name</header>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies. Accept, please.</div>
<div id="wrap"><div class="post"><h1>Title &amp; more</h1><p>First   paragraph, with
<b>bold</b>text. And a second sentence, too.<p>Short.</p><ul><li>item one</li><li>item <a href="x">two</a></li></ul>
<div class="ad">Buy now!</div><p>Last paragraph, &lt;done&gt;; really.</p></div>
<aside>Other stories, of interest.</aside><section id="comments"><p>Nice article, thanks. I liked it.</p></section></div>
<form><input name="q"><button>Go</button></form><footer>&copy; us</footer><script>var a = "<p>no</p>";</script></body></html>"""


def test_page_text():
    want = "Title & more First paragraph, with boldtext. And a second sentence, too. Short. item one item two Last paragraph, <done>; really."
    assert html_text.main_text(PAGE) == want


@pytest.mark.parametrize("page,want", [(None, ""), ("", ""), ("<html></html>", ""), ("just text", "just text"), ("<p>a<p>b", "a b"),
                                       ("<script>x", ""), ("a < b &am; &amp c", "a < b &am; & c"), ("<!-- x --><p>y</p></div></p>", "y")])
def test_odd_pages(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'data-state="hidden"', 'title="The hidden cost"', 'data-id="sidebar-1"', "data-hidden",
                                   "title='a role=menu b'", "x=y data-class=ad", 'title = "id=sidebar"'])
def test_values_and_longer_names_leave_nothing_out(attrs):
    assert html_text.main_text(f"<div {attrs}><p>One, two.</p><p>Three, four.</p></div>") == "One, two. Three, four."


@pytest.mark.parametrize("attrs", ["hidden", 'class="x" HIDDEN=""', "id=sidebar", "class='a'id='sidebar-1'", 'role="menu"', 'aria-hidden="true"'])
def test_attributes_leave_out(attrs):
    assert html_text.main_text(f"<div><p>One, two.</p><p>Three, four.</p></div><div {attrs}><p>No, no.</p></div>") == "One, two. Three, four."


def test_ids_of_headings_and_paragraphs():
    page = '<div><h2 id="search">Search</h2><p id="comment-on-method">On the method, first.</p><ul><li id="related">Item.</ul></div>'
    assert html_text.main_text(page) == "Search On the method, first. Item."


def test_linked_blocks_of_the_article_stay():
    body = '<h1><a href="/x">The linked title</a></h1><p>First, a paragraph of text.</p><ol><li><a href="1">Source one</a><li><a href="2">Source two</a></ol>'
    want = "The linked title First, a paragraph of text. Source one Source two"
    for wrap in ("article", "main", "div"):
        assert html_text.main_text(f"<body><{wrap}>{body}</{wrap}></body>") == want


def test_menus_outside_an_article_element_go():
    page = '<body><h1><a href="/x">Title, linked</a></h1><ul><li><a href="/">Home, start</a><li><a href="/b">Blog, all</a></ul><p>One, two.</p><p>Three, four.</p></body>'
    assert html_text.main_text(page) == "Title, linked One, two. Three, four."


def test_links_are_counted_decoded():
    links = [b.link for b in html_text.blocks("<p><a>&amp;&amp;\n      &amp;&amp;</a> and text</p>")]
    assert links == [5]


def test_sections_beside_the_largest_stay():
    long = "".join(f"<p>Paragraph {i}, of the long section, with text.</p>" for i in range(40))
    page = f"<body><div><div>{long}</div><div><p>Epilogue, the last words.</p><p>The end, at last.</p></div></div><ul><li><a href='/'>Home</a></ul></body>"
    out = html_text.main_text(page)
    assert out.startswith("Paragraph 0,") and out.endswith("with text. Epilogue, the last words. The end, at last.")


def test_extract_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", "<p>" + "word " * 50000 + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine")).withColumn("n_chars", F.lit("x"))
    out = html_text.extract(pages).collect()
    assert len(out) == 4 and all(r.n_chars == len(r.text) for r in out)
    assert html_text.extract(pages.where("false")).count() == 0


# ---- pages that are large and broken

@pytest.mark.parametrize("piece,times", [('<p x="', 100000), ("<a ", 200000), ("<div><p>a", 50000), ("<!x", 200000), ("<h1>a", 100000),
                                         ("<x>", 150000), ("</x>", 150000), ("<script>", 80000), ("<!--", 150000), ("<li><b>a</li>", 50000)])
def test_broken_pages_take_time_in_proportion(piece, times):
    import time
    took = []
    for n in (times // 4, times):
        start = time.process_time()
        html_text.main_text(piece * n)
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 0.5  # sixteen times, were it quadratic


def test_tags_whose_quotes_swallow_the_rest_end_at_their_first_bracket():
    page = '<article><p>One good sentence, here.</p><p class="broken>Two follows, of course.</p><p>Three ends it, surely.</p></article>'
    assert html_text.main_text(page) == "One good sentence, here. Two follows, of course. Three ends it, surely."
    assert html_text.main_text("a < b and c > d, it says.") == "a < b and c > d, it says."
