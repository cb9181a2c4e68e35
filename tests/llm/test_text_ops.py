"""Operators that SQL does not express, against brute force, the libraries and held-out labels."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from martlet.llm import pieces, texthash, token_counts, token_files, toxicity
from martlet.llm.common import components


def brute(g, unit):
    out = []

    def go(i, s, ids):
        if i == len(unit):
            out.append((s, tuple(ids)))
            return
        for j in range(i + 1, len(unit) + 1):
            if unit[i:j] in g.scores:
                go(j, s + g.scores[unit[i:j]], [*ids, g.ids[unit[i:j]]])
        if unit[i] not in g.scores:
            go(i + 1, s + g.unknown, [*ids, *(g.byte_ids[b] for b in unit[i].encode())])

    go(0, 0.0, [])
    return sorted(out, reverse=True)


@pytest.mark.parametrize("text", ["hello world", " a  b", "ab①c xx", "the theath of", "\nno\t go", "a", "it it it", "日本 x", "ends  "])
def test_n_best_is_the_n_best(text):
    g = pieces.lattice()
    want, got = brute(g, pieces.MARK + text.replace(" ", pieces.MARK)), g.n_best(text)
    assert [round(s, 6) for s, _ in got] == [round(s, 6) for s, _ in want[:g.n]]
    assert len({tuple(i) for _, i in got}) == len(got) and {tuple(i) for _, i in got} <= {i for _, i in want}
    assert all(g.decode(i) == text for _, i in got)
    ids, scores = g.best([text])[0]
    assert np.allclose(scores, [s for s, _ in got]) and (round(scores[0], 6), tuple(ids.tolist())) in {(round(s, 6), i) for s, i in want}


def test_long_texts_in_segments(monkeypatch):
    g = pieces.Lattice()
    text = "the th  ea " * 2000
    whole = g.best([text, "x y", None])
    monkeypatch.setattr(pieces, "SEGMENT", 100)
    for (a, s), (b, t) in zip(whole, g.best([text, "x y", None]), strict=True):
        assert (a == b).all() and np.allclose(s, t)


def test_pieces_round_trip(documents):
    rows = pieces.encode(documents)
    assert all(r.round_trip for r in rows.collect())
    back = {(r.doc_id, r.text) for r in pieces.decode(rows).collect()}
    assert back == {(r.doc_id, (r.text or "").replace("▁", " ")) for r in documents.collect()}
    assert pieces.encode(documents.limit(0)).count() == 0


def test_token_counts_are_the_librarys(documents):
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in documents.collect())
    rows = token_counts.token_counts(documents).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)
    assert token_counts.token_counts(documents.limit(0)).count() == 0


def test_pre_tokens_sum_up():
    c = token_counts._counter(None)
    rnd = random.Random(3)
    for _ in range(2000):
        t = "".join(rnd.choice("ab.▁  \n\tété<s>") for _ in range(rnd.randint(0, 14)))
        assert c.count(t) == len(c.model.encode(t)), repr(t)


def test_token_files(spark, documents, tmp_path):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = f"{tmp_path}/shards"
    token_files.write(documents, path, shard_ids=200)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    rows = sorted(documents.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start = 0
    assert len(got) == len(rows)
    for g, r in zip(got, rows, strict=True):
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.token_files(documents.limit(0)).count() == 0


def test_encoder_equals_library():
    e, rnd = token_files._Encoder(None), random.Random(1)
    texts = ["<|endoftext|> a", "I'm 's é ß œ", "x\x1fy \xa0z 12三", "  lead", "trail  ", "\n\n a", "é×÷", "--- a ---b", "\r\n a\r\nb   "]
    texts += ["".join(rnd.choice("ab1! \n\té.") for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    for s, x in zip(texts, e.encode([s.encode() for s in texts]), strict=True):
        assert x.tolist() == e.model.encode(s, add_special_tokens=False).ids, repr(s)


def test_grammar_round_trip_and_random_access():
    rnd = np.random.default_rng(5)
    for data in (np.zeros(10), np.array([]), np.array([1, 1, 1, 1, 1, 2, 2] * 50), rnd.integers(0, 30, 5000), rnd.integers(0, 50257, 300)):
        data = data.astype(np.uint16)
        docs = np.array_split(data, 7)
        s = token_files.Shard(token_files.pack([None, *range(6)], docs, first=50257))
        assert (s.ids() == data).all() and s.doc_ids == [None, *range(6)]
        for a in range(0, len(data), 97):
            assert (s.read_ids(a, min(40, len(data) - a)) == data[a:a + 40]).all()
    assert len(token_files.compress(np.array([1, 2] * 500, dtype=np.uint16))[0]) < 20


def test_rules_until_no_pair_is_frequent():
    block = np.random.default_rng(3).integers(0, 50257, 3000).astype(np.uint16)
    for data in (np.zeros(1 << 16, dtype=np.uint16), np.tile(block, 40)):
        seq, rules, firsts = token_files.compress(data, first=50257)
        assert np.unique(np.stack([seq[:-1], seq[1:]]), axis=1, return_counts=True)[1].max(initial=0) < token_files.MIN_COUNT
        assert (token_files.expand(seq, rules, firsts) == data).all()


def test_word_hashes():
    texts = [b"a b  c", None, b"", b"\n x\ty", b"long " * 200_000 + b"end", b"a"]
    seen = {}
    for first, counts, h in texthash.batches(texts, "spaces, A-Z lowered"):
        for i, x in enumerate(np.split(h, np.cumsum(counts)[:-1])):
            seen[first + i] = x
    assert [len(seen[i]) for i in range(6)] == [3, 0, 0, 2, 200_001, 1]
    assert seen[5][0] == seen[0][0] and len(set(seen[4].tolist())) == 2


def test_word_hashes_are_polynomials_modulo_the_prime():
    rnd = random.Random(0)
    words = [bytes(rnd.choice(b"abcXYZ019\xc3\xa9") for _ in range(rnd.randint(1, 70))) for _ in range(200)]

    def slow(word):
        v = sum(int(texthash._values[texthash._lower[b]]) * pow(texthash._BASE, i, texthash.PRIME) for i, b in enumerate(word)) % texthash.PRIME
        return int(texthash.mix(np.array([v + (len(word) << 40)], dtype=np.uint64))[0])

    for before in (0, 17, 250_000):
        start, h = texthash.hash_words(b" " * before + b" ".join(words), "spaces, A-Z lowered")
        assert start[0] == before and h.tolist() == [slow(w) for w in words]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, i) for i in range(2001, 2300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    df = spark.createDataFrame([*edges, (None, 1), (5, None)], "a long, b long")
    got = components(df).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(df.limit(0)).count() == 0


def test_toxicity_held_out(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 1
        w = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(20, 120))]
        if toxic:
            w[rnd.randint(0, len(w) - 1)] = rnd.choice(("Nasty,", "vile", "awful."))
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame([*rows, (5000, None, "x"), (5001, "", "x"), (None, "nasty vile", "x")], "doc_id long, text string, score string")
    out = {r.doc_id: r for r in toxicity.toxicity(d, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out == (i in set(held)) for i, _ in labels)
    right = sum(out[i].predicted == dict(labels)[i] for i in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert out[5000].score == out[5001].score and not out[None].held_out


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(documents, none).collect()} == {0.5}


def test_parts_that_collide_by_construction():
    """Thue-Morse words over two letters and their complements: equal under any polynomial hash modulo 2**64."""
    t = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    pair = [t, t.translate(str.maketrans("ab", "ba"))]
    e = token_files._Encoder(None)
    for s, x in zip(pair, e.encode([s.encode() for s in pair]), strict=True):
        assert x.tolist() == e.model.encode(s, add_special_tokens=False).ids
    g = pieces.lattice()
    for s, (ids, _) in zip(pair, g.best(pair), strict=True):
        assert g.decode(ids.tolist()) == s
    (_, _, h), = texthash.batches([s.encode() for s in pair], "spaces, A-Z lowered")
    assert h[0] != h[1]


def test_known_parts_start_anew():
    made = []

    def make(parts):
        made.append(list(parts))
        return np.array([len(p) for p in parts for _ in p], dtype=np.int32), np.array([len(p) for p in parts]), None

    k = texthash.Known(np.int32, 3, 100)
    for parts in (["a", "bb", "a"], ["bb", "ccc"], ["dd", "a", "dd"], ["x" * 200], ["a"]):
        runs, upto = k.runs(k.rows(parts, make))
        assert [r.tolist() for r in np.split(runs, upto[:-1])] == [[len(p)] * len(p) for p in parts]
        assert len(k.row) <= 3
    assert made == [["a", "bb"], ["ccc"], ["dd", "a"], ["x" * 200], ["a"]]


def test_checked_parts_compare_bytes(monkeypatch):
    def rows(k, text):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        edge = np.flatnonzero(raw == 32)
        start, end = np.concatenate(([0], edge + 1)), np.append(edge, len(raw))
        made = k.rows(raw, start, end, lambda a, b: (np.concatenate([raw[i:j] for i, j in zip(a, b, strict=True)]).astype(np.uint16), b - a))
        return None if made is None else [bytes(x.astype(np.uint8)).decode() for x in np.split(k.runs(made)[0], k.runs(made)[1][:-1])]

    k = texthash.Checked(np.uint16, 4, 40)
    for text in ("a bb a", "bb ccc bb a", "dd e a f", "zz zz", "a bb"):
        assert rows(k, text) == text.split(" ") and k.n <= 4
    monkeypatch.setattr(texthash, "hash_spans", lambda high, low, start, end: np.full(len(start), 5, dtype=np.uint64))
    k.forget()
    assert rows(k, "a a") == ["a", "a"] and rows(k, "b") is None and rows(k, "a b") is None and rows(k, "aa a") is None
    e = token_files._Encoder(None)
    assert [x.tolist() for x in e.encode([b"one two", b"two three"])] == [e.library(b"one two").tolist(), e.library(b"two three").tolist()]


def test_search_of_a_long_part_keeps_its_order():
    g = pieces.lattice()
    rnd = random.Random(8)
    word = "".join(rnd.choice("abcdefghijklmnop") for _ in range(60_000))
    (ids, scores), = g.best([word])
    assert g.decode(ids.tolist()) == word and scores == sorted(scores, reverse=True) and len(scores) == g.n


def test_segmentations_of_the_n_best(spark, tmp_path, monkeypatch):
    texts = ["Hello unbelievable worlds", "a", "", None, "  two  spaces and tokenization ", "日本 語 internationalization", "one"]
    g = pieces.lattice()
    for t, found in zip(texts, g.segmentations(texts), strict=True):
        slow = g.n_best(t)
        assert np.allclose([s for s, _ in found], [s for s, _ in slow]) and found[0][1].tolist() == slow[0][1]
        # equal sums may come in another order
        assert sorted(x.tolist() for s, x in found if s > found[-1][0] + 1e-6) == sorted(i for s, i in slow if s > slow[-1][0] + 1e-6)
        assert len({tuple(x.tolist()) for _, x in found}) == len(found)
        assert all(g.decode(x.tolist()) == (t or "") for _, x in found)
    long = " ".join(texts[:2] * 40)
    whole = [(s, x.tolist()) for s, x in g.segmentations([long])[0]]
    monkeypatch.setattr(pieces, "SEGMENT", 100)  # the alternatives lie in several segments
    parted = [(s, x.tolist()) for s, x in g.segmentations([long])[0]]
    assert np.allclose([s for s, _ in parted], [s for s, _ in whole]) and len({tuple(x) for _, x in parted}) == len(whole)
    score = {i: g.scores[p] for p, i in g.ids.items()}
    assert all(np.isclose(sum(score[i] for i in x), s) and g.decode(x) == long for s, x in whole + parted)
    from martlet.llm.queries import op4_sentencepiece

    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op4_sentencepiece(spark, str(tmp_path)).collect():
        assert r.round_trip and len(r.segmentations) == len(r.scores) and r.segmentations[0] == r.ids and len(r.ids) == r.n_pieces


def test_toxicity_learns_one_text_of_each_id(spark):
    rows = [(1, f"copy {i}", "x") for i in range(500)] + [(2, "fine words", "x"), (3, "vile", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    one = toxicity.toxicity(d, labels).collect()
    few = toxicity.toxicity(spark.createDataFrame([(1, "copy 0", "x"), *rows[-2:]], d.schema), labels).collect()
    assert {r.doc_id: r.score for r in one if r.doc_id > 1} == {r.doc_id: r.score for r in few if r.doc_id > 1} and len(one) == 502


def _labelled(spark, rows):
    return (spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"),
            spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    rnd = random.Random(11)
    rows = [(i, " ".join([f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(20, 60))] + ["vile"] * (i % 5 == 1)), int(i % 5 == 1)) for i in range(10400)]
    docs, labels = _labelled(spark, rows)
    stored = toxicity.stored_parts(docs, labels)
    want = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5}
    assert {r.id for r in stored.select("id").collect()} == want and stored.count() == len(want) > 8000
    monkeypatch.setattr(toxicity, "PART_ROWS", 2000)
    stored = toxicity.stored_parts(docs, labels)
    assert {r.id for r in stored.select("id").collect()} == want and stored.select("part").distinct().count() > 2
    out = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, labels).collect()}  # parts averaged each round
    held = [(i, y) for i, _, y in rows if i not in want]
    assert sum(out[i] == y for i, y in held) >= 0.97 * len(held)


def test_toxicity_learns_from_long_documents(spark):
    rows = [(i, ("plain words " if i % 2 else "vile words ") * 2000, 1 - i % 2) for i in range(60)]
    out = toxicity.toxicity(*_labelled(spark, rows)).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in out)


def test_toxicity_pieces_of_long_texts():
    words = np.random.default_rng(3).integers(0, 1 << 60, 5000).astype(np.uint64)
    m = toxicity.Cnn()
    whole, pieces_ = m.peaks(words), m.peaks(words, 64)
    assert np.allclose(whole[0], pieces_[0], rtol=1e-5) and (whole[1] == pieces_[1]).all()


def test_token_files_spread_rows_of_one_id(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    d = spark.range(4000, numPartitions=8).selectExpr("cast(null as long) doc_id", "concat('text ', id % 7) text")
    try:
        token_files.write(d, f"{tmp_path}/s", shard_ids=50)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = spark.read.parquet(f"{tmp_path}/s").groupBy("part").sum("n_ids").collect()
    assert len(parts) > 4 and max(r[1] for r in parts) < 4 * sum(r[1] for r in parts) / len(parts)
    got = sorted(token_files.read(spark, f"{tmp_path}/s").collect(), key=lambda r: r.start)
    assert len(got) == 4000 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))


def test_short_pieces_come_from_one_pass(monkeypatch):
    """Short parts are not searched one by one, and give the search's best ids and N best scores, ties included."""
    import random

    r = random.Random(7)
    parts = ["".join(r.choice(letters) for _ in range(r.randrange(1, 40))) for letters in ("abc", "aeth", "日本é😀▁ab", "\n\tx0") for _ in range(60)]
    parts += ["x" * pieces.SHORT, "ab" * pieces.SHORT, pieces.MARK, "z"]
    g = pieces.Lattice()
    wanted = [g.search(p) for p in parts]
    searched = []
    monkeypatch.setattr(g, "search", lambda p, f=g.search: (searched.append(p), f(p))[1])
    ids, sizes, scores = g._of_parts(parts)
    assert searched == ["ab" * pieces.SHORT]
    at = 0
    for found, n, s in zip(wanted, sizes.tolist(), scores.tolist(), strict=True):
        assert ids[at:at + n].tolist() == list(found[0][1]) and [x for x in s if x > float("-inf")] == [h[0] for h in found]
        at += n
    assert at == len(ids)


def test_pieces_return_their_text():
    g = pieces.lattice()
    for t in ("two words", " lead\n日本 ▁ é😀 ", ""):
        ids = np.array(g.n_best(t)[0][1], dtype=np.int32)
        assert g.returns(t, [ids, ids]) and not g.returns(t + "x", [ids])
        assert not g.returns(t, [ids, np.append(ids, g.ids["x"])])
    assert g.returns(None, [np.zeros(0, dtype=np.int32)])


def test_parts_are_found_by_their_bytes_all_at_once(monkeypatch):
    made = []

    def make(parts):
        made.extend(parts)
        return np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.int32), np.array([len(p) for p in parts]), None

    def rows(k, parts):
        ends = np.cumsum([len(p) for p in parts])
        runs, upto = k.runs(k.spans(b"".join(parts), ends - [len(p) for p in parts], ends, make))
        return [bytes(x.astype(np.uint8)) for x in np.split(runs, upto[:-1])]

    rnd = random.Random(12)
    parts = [b"a", b"a\0", b"a\0\0", b"\0", "é▁".encode(), b"x" * 32, b"x" * 33, b"x" * 31 + b"y", b"x" * 32 + b"y", b"12345678", b"123456789"]
    parts += [bytes(rnd.choices(b"ab ", k=rnd.randrange(1, 12))) for _ in range(5000)]
    k = texthash.Packed(np.int32, 100_000, 1 << 20)
    assert rows(k, parts) == parts == rows(k, parts) and sorted(made) == sorted(set(parts))
    assert all(len(p) > 8 * texthash.WORDS for p in k.row) and k.n == len(set(parts))
    k, made[:] = texthash.Packed(np.int32, 3, 100), []
    for some in (parts[:2], parts[1:3], parts[6:8], [b"z" * 200], parts[:1], parts):
        assert rows(k, some) == some
    assert made[:7] == [b"a", b"a\0", b"a\0\0", b"x" * 33, b"x" * 31 + b"y", b"z" * 200, b"a"]
    monkeypatch.setattr(texthash.Packed, "_path", lambda self, words, size: (np.zeros(len(size), dtype=np.int64), np.ones(len(size), dtype=np.int64)))
    k = texthash.Packed(np.int32, 1000, 1 << 20)  # all in one place of the table
    assert rows(k, parts[:60]) == parts[:60] == rows(k, parts[:60])


def test_pieces_of_many_texts_are_decoded_together(monkeypatch):
    g = pieces.Lattice()
    texts = ["two words", None, " lead\n日本 ▁ é😀 ", "", "x"] * 20
    runs = [[x for _, x in found] for found in g.segmentations(texts)]
    asked = []
    monkeypatch.setattr(g, "returns", lambda t, r, f=g.returns: (asked.append(t), f(t, r))[1])
    assert g.all_return(texts, runs) == [True] * 100 and not asked and g.all_return([], []) == []
    runs[7] = [*runs[7][:-1], np.append(runs[7][-1], g.ids["x"])]
    assert g.all_return(texts, runs) == [i != 7 for i in range(100)]
    one, two = (g.n_best(t)[0][1] for t in ("a", "b c"))
    assert g.all_return(["a b", "c"], [[np.array(one)], [np.array(two)]]) == [False, False]
    monkeypatch.setattr(pieces, "DECODED", 10)
    assert g.all_return(texts, runs) == [i != 7 for i in range(100)]
