"""Hash tree sharding, word runs and term search against slow versions on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import hash_tree, term_tree, word_runs
from martlet.llm.hash_tree import Leaf

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---- sharding

def draw(key, level, i):
    return (int(hashlib.md5(f"{key}/{level}/{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def slow_place(key, tree):
    """The descent written out: the child with the least -ln(u) / weight at every level."""
    at = {}
    for level in ("region", "rack", "shard"):
        tree = [x for x in tree if all(getattr(x, k) == v for k, v in at.items())]
        weight = Counter()
        for x in tree:
            weight[getattr(x, level)] += x.weight
        at[level] = min((i for i, w in weight.items() if w > 0), key=lambda i: -math.log(draw(key, level, i)) / weight[i])
    return at["region"], at["rack"], at["shard"]


def test_shards_of_odd_rows(spark, documents):
    tree = hash_tree.balanced()
    got = hash_tree.shards(documents).collect()
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    key = lambda i: "" if i is None else str(i)
    want = Counter()
    for r in rows:
        data = (r.text or "").encode()
        want[(r.doc_id, len(data) + 8, zlib.crc32(data), slow_place(key(r.doc_id), tree), slow_place(key(r.doc_id), hash_tree.grown(tree))[2])] += 1
    assert Counter((g.doc_id, g.size, g.text_crc32, (g.region, g.rack, g.shard), g.grown_shard) for g in got) == want
    for s in {g.shard for g in got}:
        mine = sorted((g for g in got if g.shard == s), key=lambda g: g.slot)
        assert [g.slot for g in mine] == list(range(len(mine)))
        order = [(g.doc_id is not None, g.doc_id or 0, g.text_crc32, g.size) for g in mine]
        assert order == sorted(order)
    assert all(g.grown_shard in (g.shard, 24) for g in got)


def test_shards_of_an_empty_table(spark, documents):
    assert hash_tree.shards(documents.limit(0)).collect() == []


def placed(spark, tree, n=4000):
    df = spark.range(n).select("id", hash_tree.place(F.col("id").cast("string"), tree).alias("at"))
    return {r.id: tuple(r.at) for r in df.collect()}


def test_weights_share_and_growth_moves_only_into_the_new_shard(spark):
    tree = [Leaf(0, 0, 0, 3.0), Leaf(0, 0, 1), Leaf(0, 1, 2), Leaf(1, 2, 3, 2.0), Leaf(1, 2, 4, 0.0), Leaf(1, 3, 5)]
    old = placed(spark, tree)
    assert old[17] == slow_place("17", tree)
    share = Counter(s for _, _, s in old.values())
    for x in tree:
        assert abs(share[x.shard] / 4000 - x.weight / 8) < 0.03
    for more in (1, 2, 5):
        new = placed(spark, hash_tree.grown(tree, more))
        moved = [k for k in old if new[k] != old[k]]
        assert moved and all(new[k][2] > 5 for k in moved)


def test_a_changed_weight_moves_rows_only_on_its_path(spark):
    tree = hash_tree.balanced()
    old = placed(spark, tree)
    heavier = [Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else x.weight) for x in tree]  # region 0, rack 1
    new = placed(spark, heavier)
    moved = [(old[k], new[k]) for k in old if new[k] != old[k]]
    assert moved and any(n[2] == 5 for _, n in moved)
    for o, n in moved:
        assert n[0] == 0                              # only into the region that gained weight
        if o[0] == 0:
            assert n[1] == 1                          # within it only into its rack
        if o[:2] == (0, 1):
            assert n[2] == 5                          # within that only into the shard
    with pytest.raises(ValueError, match="weight"):
        hash_tree.place(F.lit("x"), [Leaf(0, 0, 0, 0.0)])


def test_saved_shards_hold_whole_rows(spark, documents, tmp_path):
    back = hash_tree.save(documents, f"{tmp_path}/shards")
    assert back.count() == documents.count() and set(documents.columns) <= set(back.columns)
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, documents.select("doc_id", "text").collect()))


# ---- runs

def slow_runs(words, min_words=6, min_periods=4):
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, min_periods * q):
                found.setdefault((i, j + q), q)       # smallest period of the stretch
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def slow_digest(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def test_digests_of_odd_rows(spark, documents):
    ids = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rnd = random.Random(3)
    more = [(i, " ".join(rnd.choice("ab c d e".split()) for _ in range(rnd.randrange(0, 90)))) for i in ids]
    more += [(1000, "w " * 5), (1001, "w " * 6), (1002, "a b " * 4), (1003, "a b " * 4 + "a"), (1004, "x " * 9 + "y z " * 5 + "x " * 9), (-3, "é ü " * 7)]
    df = documents.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = [tuple(r) for r in word_runs.digests(df).collect()]
    assert Counter(got) == Counter(slow_digest(r.doc_id, r.text) for r in df.collect())
    assert sum(g[1] for g in got) > 30
    assert word_runs.digests(df.limit(0)).collect() == []


def joined(texts):
    size = np.array([len(t) for t in texts])
    upto, at = np.cumsum(size), np.repeat(np.arange(len(texts)), size)
    return at * 10 + np.concatenate([np.array(t, dtype=np.int64) for t in texts]), (upto - size)[at], upto[at], upto - size


@pytest.mark.parametrize("least", [(6, 4), (1, 2), (3, 3)])
def test_runs_of_random_words(least):
    rnd = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            k, n = rnd.choice([1, 2, 2, 3, 5]), rnd.randint(0, 60)
            x = [rnd.randrange(k) for _ in range(n)]
            a, p = rnd.randrange(n + 1), rnd.randint(1, 8)
            texts.append([x[i] if i < a or rnd.random() < 0.02 else x[min(a + (i - a) % p, n - 1)] for i in range(n)])
        codes, begin, end, first = joined(texts)
        want = [(s + int(f), length, q) for t, f in zip(texts, first, strict=True) for s, length, q in slow_runs(t, *least)]
        assert word_runs.runs_of(codes, begin, end, 10 * len(texts), *least) == want


def test_suffix_arrays_of_random_words():
    rnd = random.Random(2)
    for _ in range(200):
        texts = [[rnd.randrange(3) for _ in range(rnd.randint(0, 40))] for _ in range(3)]
        codes, _, end, _ = joined(texts)
        order, rank = word_runs.suffix_array(codes, end, 30)
        assert order.tolist() == sorted(range(len(codes)), key=lambda i: codes[i:end[i]].tolist())
        lcp = word_runs.common_prefixes(codes, end, order)
        for k in range(1, len(codes)):
            a, b = codes[order[k - 1]:end[order[k - 1]]], codes[order[k]:end[order[k]]]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_very_long_stretches():
    n = 200_000
    one = lambda x: word_runs.runs_of(x, np.zeros(n, np.int64), np.full(n, n), int(x.max()) + 1)
    assert one(np.zeros(n, np.int64)) == [(0, n, 1)]
    block = np.random.default_rng(0).integers(0, 1000, 5000)
    assert one(np.tile(block, n // 5000)) == [(0, n, 5000)]
    steps = np.zeros(n, np.int64)
    steps[::449] = 1
    assert one(steps)[0] == (0, n, 449) and len(one(steps)) == 1 + -(-n // 449)


# ---- search

def slow_search(docs, items, best):
    words = [(i, [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in TERM.findall(t or "")]) for i, t in docs]
    total, n_docs = sum(len(w) for _, w in words), sum(bool(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in TERM.findall(t or ""))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, w in words:
            tf = Counter(w)
            m = 50 + 50 * len(w) * n_docs // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in ts if tf[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:best])]
    return out


@pytest.mark.parametrize("tree_docs, block_bytes", [(4096, 1 << 22), (3, 200), (1, 40)])
def test_search_of_random_and_odd_rows(spark, documents, tree_docs, block_bytes):
    rnd = random.Random(5)
    vocabulary = [f"t{i}" for i in range(30)] + ["É", "naïve", "x1", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    made = [(100 + i // 2, " ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(0, 40)))) for i in range(120)]  # ids twice
    made += [(900 + i, "t1 t2 t2, T3!") for i in range(40)] + [(None, "t1 t2 t2 t3"), (None, "t9")]                  # copies: ties by id
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    items = spark.createDataFrame([(1, "t1 t2; t9 unknown"), (1, "t3 T1"), (2, "É-naïve 日本 x1"), (3, None), (4, ""), (None, "word shared"),
                                   (5, "nothing-known"), (6, " ".join(vocabulary))], "item_id long, text string").withColumn("doc_id", F.lit("own"))
    got = [tuple(r) for r in term_tree.term_search(docs, items, 7, tree_docs, block_bytes).collect()]
    want = slow_search([tuple(r) for r in docs.collect()], [tuple(r)[:2] for r in items.collect()], 7)
    assert Counter(got) == Counter(want) and len(got) > 20


def test_search_of_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert term_tree.term_search(documents.limit(0), items).collect() == []
    assert term_tree.term_search(documents, items.limit(0)).collect() == []
    assert term_tree.term_search(documents, items.select("item_id", F.lit(None).cast("string").alias("text"))).collect() == []


def test_tree_bounds_hold_and_prune():
    rnd = random.Random(6)
    docs = [(i, [rnd.choice("abcdefghij") + str(rnd.randrange(4)) for _ in range(rnd.randint(1, 30))]) for i in range(400)]
    n_docs, total = len(docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    wanted = {k: {rnd.choice(list(df)) for _ in range(4)} for k in range(5)}
    some = {t.encode(): n for t, n in df.items() if any(t in ts for ts in wanted.values())}
    items = term_tree.Items.of({k: {t.encode() for t in ts} for k, ts in wanted.items()}, some, n_docs, total)
    vectors, ids = [], []
    for i, w in docs:
        known = [items.number[t.encode()] for t in w if t.encode() in items.number]
        if known:
            term, tf = np.unique(np.array(known), return_counts=True)
            vectors.append((term, tf.astype(np.int64), items.length_norm(len(w))))
            ids.append(i)
    root = term_tree.term_tree(vectors)

    def below(node):
        if node.doc is not None:
            return [node.doc]
        found = [d for c in node.children for d in below(c)]
        bound = items.scores(node.term, node.tf, node.m)
        for d in found:
            assert (items.scores(*vectors[d]) <= bound).all()
        paths = {tuple(vectors[d][0][:1]) for d in found}
        assert node is root or len(paths) == 1        # a subtree shares the beginning of its path
        return found

    assert sorted(below(root)) == list(range(len(vectors)))
    search = term_tree.Search(items, 3)
    search.tree(root, ids)
    nodes = []
    open_ = [root]
    while open_:
        nodes.append(open_.pop())
        open_ += nodes[-1].children
    assert search.visited < len(nodes) / 2
