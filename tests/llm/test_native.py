"""Line dedup, quality rules and mixing against their SQL, edge cases included."""

import random

import pytest
from pyspark.sql import functions as F

from martlet.llm import line_dedup, mixing, quality


def test_line_dedup_matches_sql(spark, documents, in_duckdb, same_rows):
    got = line_dedup.line_dedup(documents.select("doc_id", "text"))
    same_rows(got, in_duckdb(documents, line_dedup.oracle()))


def test_line_dedup_removes_only_later_chunks_and_keeps_columns(documents):
    out = line_dedup.line_dedup(documents)
    assert out.columns == [*documents.columns, "n_chunks", "n_removed"]
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[6].n_removed == 0 and rows[7].n_removed >= 1
    assert "Other" in rows[7].text and rows[6].text.count("shared line") == 12 > rows[7].text.count("shared line")
    assert rows[4].text is None and rows[5].text == ""


def test_passages_go_whole_wherever_they_stand(spark, in_duckdb, same_rows):
    """Passages of two lines and more among other lines, at any offset: all lines of all but the first go."""
    rows, rnd = [], random.Random(4)
    own = iter(range(10**6))
    passages = [[f"passage {p} line {k} with some words of its own" for k in range(2 + p % 7)] for p in range(40)]
    for doc in range(120):
        body = []
        for p in rnd.sample(range(40), 3):
            body += [f"only here {next(own)} and nowhere else, so it stays" for _ in range(rnd.randrange(1, 5))]
            body += [x for line in passages[p] for x in ([line, ""] if p % 5 == 0 else [line])]
        rows.append((doc, "\n".join([*body, f"the end {next(own)} of this document, too"])))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.line_dedup(d).collect()}
    seen = set()
    for doc, text in rows:
        kept = out[doc].text.split("\n")
        assert [x for x in kept if x.startswith(("only", "the end"))] == [x for x in text.split("\n") if x.startswith(("only", "the end"))]
        here = {int(x.split()[1]) for x in text.split("\n") if x.startswith("passage")}
        assert {int(x.split()[1]) for x in kept if x.startswith("passage")} == here - seen
        assert all(kept.count(line) == 1 for p in here - seen for line in passages[p])
        seen |= here
    same_rows(line_dedup.line_dedup(d), in_duckdb(d, line_dedup.oracle()))


def test_first_copies_of_lines_stay(spark, in_duckdb, same_rows):
    a, b, c, e = (f"{x} line of more than twenty characters" for x in "abce")
    rows = [(1, f"{a}\n{b}"), (2, f"{c}\n{a}\n{b}\n{c}\n{e}"), (3, f"{b}\n{c}"), (4, "\n".join([e] * 5)), (5, f"x\n\n{a}\n \n\n{b}\n\ny"), (6, f"{a}\nshort"),
            (6, f"{a}\nshort"), (7, "ab\ncd"), (8, "ab\ncd"), (None, f"{a}\n{b}")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    out = {(r.doc_id, r.text) for r in line_dedup.line_dedup(d).collect()}
    assert out == {(1, ""), (2, f"{c}\n{c}\n{e}"), (3, ""), (4, e), (5, "x\n\n\ny"), (6, f"{a}\nshort"), (7, "ab\ncd"), (8, "ab\ncd"), (None, f"{a}\n{b}")}
    assert {x for _, t in out for x in t.split("\n")} >= {x for r in rows for x in r[1].split("\n") if x.strip()}
    same_rows(line_dedup.line_dedup(d), in_duckdb(d, line_dedup.oracle()))


def test_quality_matches_sql(documents, in_duckdb, same_rows):
    same_rows(quality.quality(documents), in_duckdb(documents, quality.oracle()))


def test_quality_counts_by_hand(documents):
    rows = {r.doc_id: r for r in quality.quality(documents).collect()}
    assert rows[8].n_words == 160 and rows[8].n_repeat_words == 160 and rows[8].base_failed
    assert rows[14].n_symbols == 6 and rows[14].n_dup_lines == 1
    assert rows[4].n_words == 0 and not rows[4].kept
    assert rows[1].kept and rows[3].kept


def boilerplate(spark):
    letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits would be one in normal forms
    own = lambda i: " ".join(f"own{letters(i)}x{letters(k)}" for k in range(60))
    rows = [(i, f"{own(i)}\nAll  Rights reserved {i}\n{own(i)[::-1]}", "h", 1) for i in range(30)]
    rows += [(100 + i, "all rights reserved 7\n" + " ".join(f"w{k}" for k in range(5)) + f" {i}", "h", 1) for i in range(3)]
    rows += [(200, rows[0][1], "h", 1), (0, rows[0][1], "h", 1), (201, "all rights reserved 9 " + own(201), "other", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


def test_boilerplate_lines_go_and_depleted_documents_are_rejected(spark, in_duckdb, same_rows):
    d = boilerplate(spark)
    same_rows(quality.quality(d), in_duckdb(d, quality.oracle()))
    out = {r.doc_id: r for r in quality.clean(d).collect()}
    assert set(out) == {*range(30), 200, 201}
    assert "ights" not in out[5].text and out[5].n_chars == len(out[5].text) and "rights" in out[201].text


def test_mixing_matches_sql(documents, in_duckdb, same_rows):
    got = mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken")
    same_rows(got, in_duckdb(documents, mixing.oracle()))


def test_mixing_targets_and_takes(spark):
    rows = [(i, "w " * (1 + i % 40), "abc"[i % 7 % 3]) for i in range(4000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixing.mix(d).collect()
    assert sorted(first) == sorted(mixing.mix(d.repartition(7)).collect())
    total = sum(r.size for r in first)
    targets = {r.source: (r.target, r.source_size) for r in first}
    assert abs(sum(t for t, _ in targets.values()) - 1.5 * total) < 1e-6 * total
    for s, (target, size) in targets.items():
        assert target <= 2 * size and abs(sum(r.taken for r in first if r.source == s) - target) <= 40
    assert all(r.taken in (0, r.size, 2 * r.size) for r in first)
    assert mixing.mixed(d).count() == sum(r.copies for r in first)


def test_inclusion_odds_of_documents(spark):
    """The rank decides, not the random number: important documents are taken in proportion to their odds."""
    rows = [(i, "w w w", "a", 9.0 if i % 2 else 1.0) for i in range(6000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    got = {r.doc_id: r.copies - 1 for r in mixing.mix(d, importance="quality").collect()}  # one whole copy, half another
    u = {r.doc_id: r.u for r in mixing.with_odds(d).collect()}
    rank = {i: u[i] / (1 - u[i]) / (9.0 if i % 2 else 1.0) for i in u}
    taken = sum(got.values())
    assert taken == 3000 and {i for i, n in got.items() if n} == set(sorted(rank, key=rank.get)[:taken])
    assert {i for i, n in got.items() if n} != set(sorted(u, key=u.get)[:taken])
    # Pareto sampling gives nearly the wanted probabilities: odds 9 to 1 around one half
    heavy = sum(n for i, n in got.items() if i % 2) / 3000
    assert abs(heavy - 0.75) < 0.03
    even = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    assert sum(r.copies - 1 for r in mixing.mix(even).collect()) == 3000


def test_many_sources_are_not_gathered_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 64, raising=False)
    sizes = {f"h{i:04}": (i * i) % 977 for i in range(2000)} | {None: 500}
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: mixing.WEIGHTS[k % 3] for k, x in enumerate(names)}
    free, full = mixing.SHARE * sum(sizes.values()), set()
    while True:  # share out, fix those above their limit, share out the rest
        left, sharing = free - sum(100 * mixing.LIMIT * sizes[x] for x in full), sum(weight[x] for x in names if x not in full)
        more = {x for x in names if x not in full and 100 * mixing.LIMIT * sizes[x] * sharing <= left * weight[x]}
        if not more:
            break
        full |= more
    want = {x: float(mixing.LIMIT * sizes[x]) if x in full else left / 100.0 / sharing * weight[x] for x in names}
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        got = t.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert 0 < len(full) < len(names) == len(got)
    assert {r.source: (r.weight, round(r.target, 6)) for r in got} == {x: (weight[x], round(want[x], 6)) for x in names}
    parts = [r.part for r in got]
    assert max(map(parts.count, set(parts))) < len(got) / 2


def test_mixed_keeps_columns_and_repeats(documents):
    out = mixing.mixed(documents)
    assert out.columns == documents.columns
    assert out.count() == sum(r.copies for r in mixing.mix(documents).collect())


@pytest.mark.parametrize("op", [line_dedup.line_dedup, quality.quality, quality.clean, mixing.mix, mixing.mixed])
def test_empty_tables(documents, op):
    assert op(documents.limit(0)).count() == 0


def test_line_dedup_shuffles_the_texts_once(spark):
    long = "a line that is long enough to count, of document"
    rows = [(i, f"{long} {i}\nhead {i}\n{long} shared\n{long} shared too\ntail {i}") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(c, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = line_dedup.line_dedup(d)
        assert sum(r.n_removed for r in out.collect()) == 2 * 39
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # two joins with texts, the second and the query's own reuse the first one's shuffle
        assert plan.count("ReusedExchange") >= 2
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
