"""Embedding dedup, n-gram join, wrappers and the pipeline against brute force."""

import math
import os
import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest

from martlet.llm import embedding_dedup, html_wrappers, line_dedup, mixing, ngram_join, pieces, quality
from martlet.llm.embedding_dedup import forest, links


def vectors():
    r = np.random.default_rng(3)
    base = r.standard_normal((60, 16))
    rows = [base[i % 60] + r.standard_normal(16) * (0.09 if i % 3 else 0.2) for i in range(300)]
    out = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    out += [(400 + i, out[7][1]) for i in range(30)] + [(9, out[9][1])]
    out += [(500, None), (501, [0.0] * 16), (502, [math.nan] + [1.0] * 15), (503, [None] + [1.0] * 15), (504, [math.inf] * 16), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (507, [])]
    return out


@pytest.mark.parametrize("tile", [50, 4096])
def test_embedding_dedup(spark, tile):
    rows = vectors()
    d = spark.createDataFrame([*((*r, 1) for r in rows), (None, rows[0][1], 1)], "vec_id long, embedding array<float>, rep int")
    out = {r.vec_id: r for r in embedding_dedup.embedding_dedup(d, tile=tile).collect()}
    rows = dict(rows)
    good = [i for i, v in rows.items() if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {i: {j for j in good if j != i and len(rows[i]) == len(rows[j]) and np.dot(rows[i], rows[j]) / math.sqrt(np.dot(rows[i], rows[i]) * np.dot(rows[j], rows[j])) >= 0.95} for i in good}
    assert max(map(len, near.values())) > 30
    for i in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (len(near.get(i, ())), min(seen), min(seen) == i), i
    assert out[None].n_links == 0 and out[None].kept and len(out) == len(rows) + 1
    assert embedding_dedup.embedding_dedup(d.limit(0)).count() == 0


def test_links_equal_full_precision():
    r = np.random.default_rng(1)
    x, y = r.standard_normal((200, 24)), r.standard_normal((150, 24))
    cosine = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
    for t in (-0.2, 0.0, 0.3, 0.6):
        assert set(zip(*links(x, y, t), strict=True)) == set(zip(*np.nonzero(cosine >= t), strict=True))
    assert forest(5, np.array([4, 1]), np.array([3, 2])).tolist() == [0, 1, 1, 3, 3]


def letters(n):
    return "".join(chr(97 + int(c)) for c in str(n))


def near_copies(spark):
    rnd, rows = random.Random(6), []
    for i in range(12):
        w = [f"g{i}w{k}" for k in range(rnd.choice((12, 30, 90, 200)))]
        for _ in range(15):
            v = list(w)
            for _ in range(rnd.choice((0, 1, 1, 2, 6))):
                v[rnd.randrange(len(v))] = f"n{letters(rnd.randrange(10**9))}"
            rows.append((len(rows), " ".join(v) + " common tail of every text"))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize(("tile", "percent"), [(4096, 90), (7, 90), (7, 60)])
def test_ngram_join_matches_sql(spark, in_duckdb, same_rows, tile, percent):
    d = near_copies(spark)
    got = ngram_join.ngram_join(d, percent=percent, tile=tile).select("doc_id", "n_shingles", "component_id")
    same_rows(got, in_duckdb(d, ngram_join.oracle(percent=percent)))


def test_ngram_join_edge_cases(documents, in_duckdb, same_rows):
    known = documents.where("doc_id is not null")
    got = ngram_join.ngram_join(known).select("doc_id", "n_shingles", "component_id")
    same_rows(got, in_duckdb(known, ngram_join.oracle()))
    rows = [r for r in ngram_join.ngram_join(documents).collect() if r.doc_id is None]
    assert [(r.n_shingles, r.component_id) for r in rows] == [(2, None)]
    stays = ngram_join.one_of_each(documents)
    assert stays.columns == documents.columns
    assert sorted(r.doc_id or 0 for r in stays.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15]
    assert ngram_join.ngram_join(documents.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home {n}</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy {n}</div>{notice}
<article><h1>Head &lt;{n}&gt;</h1><p>One  <b>bo</b>ld &amp; {n}<p>Second<br>line &eacute;</p>{more}</article>
<section id="comments"><article><p>I disagree {n}</p></article></section><form>Mail<input></form><aside>See also</aside><footer>&copy; {n}</footer></body></html>"""


def test_wrappers(spark):
    rows = []
    for n in range(30):
        more = "".join(f"<p>Extra {k}</p>" for k in range(n % 4)) + ("<dl><dt>k<dd>v<dt>l<dd>w</dl>" if n % 5 == 0 else "")
        rows.append((n, f"http://Site{n % 2}.example/x/{n}", PAGE.format(n=n, more=more, notice='<div class="cookie-notice">We use</div>' * (n % 3 == 0))))
    rows += [(100, "http://site1.example/cut", rows[1][2][:rows[1][2].index("Second") + 6]), (101, None, None), (102, "x", ""), (103, "http://only.example", "<p>bare &am text")]
    d = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, wrapper string")
    out = {r.page_id: r for r in html_wrappers.main_text(d).collect()}
    for n in range(30):
        extra = "".join(f" Extra {k}" for k in range(n % 4)) + (" k v l w" if n % 5 == 0 else "")
        assert out[n].text == f"Head <{n}> One bold & {n} Second line é" + extra and out[n].n_chars == len(out[n].text)
    assert out[100].text == "Head <1> One bold & 1 Second"
    assert out[101].text == "" and out[102].text == "" and out[103].text == "bare &am text"
    assert html_wrappers.main_text(d.limit(0)).count() == 0


def test_wrapper_inference():
    def show(x):
        body = "" if x[0] == "#" else "[" + " ".join(map(show, x[2])) + "]"
        return x[0] + ("" if x[1] == "1" else x[1]) + body

    a = html_wrappers.skeleton(html_wrappers.parse("<div><h1>a</h1><p>b<p>c</div>"))
    b = html_wrappers.skeleton(html_wrappers.parse("<div><p>b</p><ul><li>x</ul></div>"))
    w = html_wrappers.merged(a, b)
    assert show(w) == "html[div[h1?[#] p+[#] ul?[li[#]]]]"
    assert show(html_wrappers.merged(w, b)) == show(w)
    assert html_wrappers.extract("<div>" * 5000 + "deep", None, 0) == "deep"
    menu = "<div>" + "".join(f"<li><a>m{i}</a></li>" for i in range(3)) + "<p>text <a>link</a></p></div>"
    assert html_wrappers.extract(menu, html_wrappers.skeleton(html_wrappers.parse(menu)), 1) == "text link"


def texts_of(spark, pages):
    d = spark.createDataFrame([(i, "http://one.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_wrappers.main_text(d).collect()}


def test_only_whole_texts_of_different_pages_are_constant(spark):
    intro = " ".join(f"standing{k}" for k in range(70))
    pages = [f"<section>{intro} own {n}</section><div><p>{intro}</p></div><blockquote><b>Same:</b> after {n}</blockquote>" for n in range(25)]
    assert texts_of(spark, pages) == {n: f"{intro} own {n} Same: after {n}" for n in range(25)}
    copies = ["<h1>Head</h1><div>One body</div>"] * 40
    assert texts_of(spark, copies) == dict.fromkeys(range(40), "Head One body")


def test_wrapper_takes_part_within_article(spark):
    page = "<article><h1>Head {n}</h1><div><span>{more}</span></div><p>Body {n}</p><p>of <b>Note:</b> {n}</p></article>"
    boiler = "Read all of it at our partner site"
    pages = [page.format(n=n, more=boiler) for n in range(25)]
    assert texts_of(spark, pages) == {n: f"Head {n} Body {n} of Note: {n}" for n in range(25)}
    few = [page.format(n=n, more=boiler) for n in range(19)]
    assert texts_of(spark, few * 2)[20] == f"Head 1 {boiler} Body 1 of Note: 1"
    varied = [page.format(n=n, more=f"{boiler} {n}") for n in range(25)]
    assert texts_of(spark, varied)[3] == f"Head 3 {boiler} 3 Body 3 of Note: 3"


def test_self_closing_foreign_elements_are_empty():
    page = '<article><p>One <svg class="x"/>two<math/> three</p><svg><text>no</text></svg><p>four</p></article>'
    assert html_wrappers.extract(page, None, 0) == "One two three four"


@pytest.mark.parametrize("most", [1, 4, 50])
def test_long_stretches_are_aligned_alike(monkeypatch, most):
    rnd = random.Random(5)
    for _ in range(60):
        x, y = ([["()", "+", [[rnd.choice("ab"), "1", [], None]], None] if rnd.random() < 0.2 else [rnd.choice("pquv"), "1", [], None]
                 for _ in range(rnd.randrange(30))] for _ in "xy")
        monkeypatch.setattr(html_wrappers, "MAX_ALIGN", 1 << 22)
        whole = html_wrappers.align(x, y)
        monkeypatch.setattr(html_wrappers, "MAX_ALIGN", most)
        assert len(html_wrappers.align(x, y)) == len(whole)


def test_pipeline_is_its_operators_in_order(spark, documents, in_duckdb, tmp_path):
    import corpus_pipeline

    names = ["doc_id", "text", "lang", "source", "n_chars"]
    d = documents.select(names).unionByName(near_copies(spark).selectExpr(
        "doc_id + 1000 as doc_id", "text", "'en' as lang", "concat('s', doc_id % 3) as source", "1L as n_chars"))
    own = [(2000 + i, " ".join(f"{letters(97 * i + k)}x{letters(k)}" for k in range(60 + i))) for i in range(40)]  # nothing in common
    d = d.unionByName(spark.createDataFrame(own, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' as lang", "concat('s', doc_id % 3) as source", "1L as n_chars"))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or -1, r.n_pieces, r.ids_crc32) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "mixing", "sentencepiece"]

    def frame(rows):
        return spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, source string")

    kept = {r["doc_id"] for r in in_duckdb(d, quality.oracle()) if r["kept"]}
    rows = [(r.doc_id, r.text, r.source) for r in d.collect() if r.doc_id in kept]
    source = {r[0]: r[2] for r in rows}
    rows = [(r["doc_id"], r["text"], source[r["doc_id"]]) for r in in_duckdb(frame(rows), line_dedup.oracle())]
    stay = {r["doc_id"] for r in in_duckdb(frame(rows), ngram_join.oracle(width=5, percent=80)) if r["doc_id"] == r["component_id"]}
    rows = [r for r in rows if r[0] in stay]
    text = {r[0]: r[1] for r in rows}
    want = []
    for r in in_duckdb(frame(rows), mixing.oracle()):
        one = pieces.lattice().best([text[r["doc_id"]]])[0][0]
        want += [(r["doc_id"], len(one), zlib.crc32(one.astype("<u4").tobytes()))] * (r["taken"] // max(1, r["size"]))
    assert len(got) > 20 and [g for g in got if g[1]] == [w for w in sorted(want) if w[1]]


def thue_morse(n=2048):
    """Two texts whose polynomial hashes modulo 2**64 agree, without a common word."""
    t = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return t, t.translate(str.maketrans("ab", "ba"))


def test_texts_that_collide_by_construction_do_not_link(spark, in_duckdb, same_rows):
    d = spark.createDataFrame(list(enumerate(thue_morse())), "doc_id long, text string")
    got = ngram_join.ngram_join(d).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == [(0, 1, 0), (1, 1, 1)]


def test_rows_of_one_id_with_near_copies(spark, in_duckdb, same_rows):
    near = near_copies(spark)
    d = near.union(near.where("doc_id % 3 = 0")).union(near.where("doc_id % 7 = 0"))
    a = {r.doc_id: r.component_id for r in ngram_join.ngram_join(near).collect()}
    b = {(r.doc_id, r.component_id) for r in ngram_join.ngram_join(d, tile=7).collect()}
    assert dict(b) == a and len(b) == len(a)


def test_vectors_of_any_size(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.01]), (3, [1e-200, 2e-200]), (4, [1e200, 2e200]), (5, [-1e308, 1e300]), (6, [5e-324, 0.0]), (7, [3.0, 0.0]), (8, [1e308, 1e308])]
    out = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    # 8 and the first four: cosine 3 / sqrt(10) = 0.9487
    assert out == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("depth", [3, 125, 4000])
def test_pages_of_any_depth(depth):
    down, up = "<div>" * depth, "</div>" * depth
    assert html_wrappers.extract(f"<div><article>{down}deep{up}<p>more</p></article></div>", None, 0) == "deep more"
    page = f"{down}<nav>menu</nav><article><p>a<b>b</b></p><div class='share'>no<article>never</article></div>c</article>{up}tail"
    assert html_wrappers.extract(page, None, 0) == "ab c"
    assert html_wrappers.extract(f"<article>{'<span>' * depth}x{'</i>' * depth}<p>y", None, 0) == "x y"


def test_attributes_are_read_by_name():
    for page, text in [('<p data-id="share">Kept text</p>', "Kept text"), ('<a href="/q?id=share-price">price</a>', "price"), ("<p id=share>gone</p>x", "x"),
                       ('<p title="a > b" class=\'x share\'>gone</p>x', "x"), ("<p CLASS = Share >gone</p>x", "x"), ('<p alt=\'class="share"\'>stays</p>', "stays")]:
        assert html_wrappers.extract(f"<article>{page}</article>", None, 0) == text


def test_headers_of_the_page_and_of_the_article():
    page = ('<header class="site-header"><p>Site</p></header><article><header class="entry-header"><h1>Title</h1><nav>n</nav></header>Body'
            '<footer>f</footer><section class="comments"><article><header>Someone</header>said</article></section></article>')
    assert html_wrappers.extract(page, None, 0) == "Title Body"


def test_pages_against_an_independent_reader(spark):
    """All pages of the smallest table: the standard library's parser, text of article but for what is named as furniture."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.skip, self.blocks, self.void = 0, [], [""], {"br", "hr", "img", "input", "meta", "link"}

        def handle_starttag(self, tag, attrs):
            named = " ".join(v or "" for k, v in attrs if k in ("class", "id"))
            bad = tag in ("nav", "aside", "footer", "form", "button", "script", "style") or any(w in named for w in ("comment", "share", "related", "ad-", "promo", "newsletter", "notice"))
            if tag not in self.void and (self.skip or bad):
                self.skip.append(tag)
            if tag == "article" and not self.skip:
                self.inside += 1
            if tag not in ("b", "i", "em", "strong", "a", "span", "code"):
                self.blocks.append("")

        def handle_endtag(self, tag):
            if self.skip and tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            elif tag == "article":
                self.inside -= 1
            if tag not in ("b", "i", "em", "strong", "a", "span", "code"):
                self.blocks.append("")

        def handle_data(self, data):
            if self.inside > 0 and not self.skip:
                self.blocks[-1] += data

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_wrappers.main_text(pages).collect()}
    for r in pages.collect():
        reader = Reader()
        reader.feed(r.html or "")
        reader.close()
        assert got[r.page_id] == " ".join(t for t in (" ".join(b.split()) for b in reader.blocks) if t), r.page_id


def test_ngram_hashes_are_shuffled_once(spark, monkeypatch):
    """Shared hashes are counted as the rest of those that one document holds, without a join of all hashes."""
    plans, cut = [], ngram_join.cut
    monkeypatch.setattr(ngram_join, "cut", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), cut(df))[1])
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(reversed(words))), (3, " ".join(words[:58])), (4, None)]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 58): 1, (2, 57): 1, (3, 58): 1, (3, 56): 1, (4, 0): 4}
    likely = next(p for p in plans if "alone" in p or "holders" in p)
    assert "explode(keys" in likely and "LeftSemi" not in likely


def test_components_cuts_small_plans(spark, monkeypatch):
    """No plan that a round leaves to be cut grows with the copies of its edges."""
    from martlet.llm import common

    leaves, cut = [], common.cut
    monkeypatch.setattr(common, "cut", lambda df: (leaves.append(df._jdf.queryExecution().analyzed().collectLeaves().size()), cut(df))[1])
    monkeypatch.setattr(common, "HUB_EDGES", 3)  # hubs, too
    monkeypatch.setattr(common, "HUBS", 2)
    edges = [(1, k) for k in range(2, 40)] + [(k, k + 1) for k in range(50, 60)] + [(60, 50), (70, 70), (None, 3), (80, None), (5, 1), (5, 1)]
    got = {(r.node, r.component) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 1) for k in range(1, 40)} | {(k, 50) for k in range(50, 61)}
    assert max(leaves) <= 10


def passages(n=120):
    """Texts of their own words, each with a passage of the text before and one of the next; every tenth has a near copy."""
    rnd, rows = random.Random(8), []
    for i in range(n):
        own = [f"o{i}x{k}" for k in range(60)]
        text = [f"p{i}x{k}" for k in range(25)] + own + [f"p{i + 1}x{k}" for k in range(25)]
        rows.append((2 * i, " ".join(text)))
        if i % 10 == 0:
            text[rnd.randrange(30, 80)] = "other"
            rows.append((2 * i + 1, " ".join(text)))
    return rows


def test_texts_of_near_copies_only_are_sent(spark, monkeypatch, tmp_path, in_duckdb, same_rows):
    """Passages join all texts into one group of many tiles; texts without a near copy stay where they are."""
    compare, at = ngram_join._compare, str(tmp_path)

    def counted(width, percent):
        run = compare(width, percent)

        def count(key, table):
            with open(f"{at}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(table.num_rows))
            return run(key, table)

        return count

    monkeypatch.setattr(ngram_join, "_compare", counted)
    monkeypatch.setattr(ngram_join, "LEAD_PERCENT", 1)
    d = spark.createDataFrame(passages(), "doc_id long, text string")
    got = ngram_join.ngram_join(d, tile=8).select("doc_id", "n_shingles", "component_id").localCheckpoint()
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == 24
    assert {(r.doc_id, r.component_id) for r in got.collect() if r.doc_id != r.component_id} == {(20 * i + 1, 20 * i) for i in range(12)}
    same_rows(got, in_duckdb(d, ngram_join.oracle()))


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_sketches_part_no_linked_pair(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for n in (1, 2, 9, 31, 32, 33, 120, 500, 511, 512, 700, 2000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for cut in (0, 0, n // 20, n // 8, n // 4, n // 2):
            sets.append(np.unique(np.concatenate([base[cut:], rng.integers(0, 1 << 63, cut // 3, dtype=np.uint64)])))
    order = rng.permutation(len(sets))
    sets = [sets[i] for i in order]
    size = np.array([len(s) for s in sets])
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * (o := ngram_join.overlap(sets[i], sets[j])) >= percent * (size[i] + size[j] - o)]
    for side in (np.zeros(len(sets), dtype=int), np.arange(len(sets)) % 2):
        root = ngram_join.sketch_roots(size, [ngram_join.sketch(s) for s in sets], side, percent)
        assert len(linked) > 20 and all(root[i] == root[j] for i, j in linked if not side.any() or side[i] != side[j])
        assert len(set(root.tolist())) >= 6  # not all in one


def test_buckets_return_what_several_nodes_hold(monkeypatch):
    rng = np.random.default_rng(3)
    node = rng.integers(0, 1 << 48, 40)
    node[7] = node[5]  # copies
    keys = [np.unique(rng.integers(-(1 << 63), 1 << 63, 300)[:rng.integers(0, 40)]) for _ in node]
    keys[7] = keys[5]
    for i in range(0, 40, 4):
        keys[i] = np.unique(np.concatenate([keys[i], keys[(i + 3) % 40][:5], keys[1][:i % 3]]))
    holders = {}
    for n, some in zip(node.tolist(), keys, strict=True):
        for k in some.tolist():
            holders.setdefault(k, set()).add(n)
    want = sorted(sorted(h) for h in holders.values() if len(h) > 1)
    monkeypatch.setattr(ngram_join, "BUCKET_KEYS", 10)  # several rows for a batch
    frames = [pa.RecordBatch.from_pydict({"node": pa.array(node[a:a + 16]), "keys": pa.array([k.tolist() for k in keys[a:a + 16]], pa.list_(pa.int64()))}) for a in (0, 16, 32)]
    rows = [r for b in ngram_join._deal(7)(iter(frames)) for r in b.column(0).to_pylist()]
    assert len(rows) > 3 and {len(r) for r in rows} == {7}
    got = {}
    for k in range(7):
        found = ngram_join._shared((pa.scalar(k),), pa.table({"holders": pa.array([r[k] for r in rows], pa.binary())}))
        for r in found.to_pylist():
            got.setdefault(r["key"], []).append(r["node"])
    assert sorted(sorted(v) for v in got.values()) == want


def test_files_of_hashes_are_deleted(spark, monkeypatch):
    """What the join no longer reads leaves the disk before texts are sent."""
    paths, cut = [], ngram_join.cut

    def noted(df):
        done = cut(df)
        at = done._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
        paths.append((done.columns, at, [os.path.exists(p.removeprefix("file:")) for c, p, _ in paths if "keys" in c]))
        return done

    monkeypatch.setattr(ngram_join, "cut", noted)
    ngram_join.ngram_join(near_copies(spark)).collect()
    assert "keys" in paths[0][0] and paths[1][2] == [True] and paths[-1][2] == [False]


@pytest.mark.parametrize("most", [0, 10**6])
def test_components_in_rounds_and_in_one_task(spark, monkeypatch, most):
    from martlet.llm import common

    monkeypatch.setattr(common, "ONE_TASK", most)
    r = random.Random(12)
    edges = [(r.randrange(-60, 60), r.randrange(-60, 60)) for _ in range(50)] + [(k + 1, k) for k in range(500, 530)] + [(900, k) for k in range(700, 720)] + [(5, 5), (None, 3), (2000, None)]
    low = {}

    def find(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low[max(find(a), find(b))] = min(find(a), find(b))
    got = [(x.node, x.component) for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert sorted(got) == sorted((x, find(x)) for x in low)
