"""Line dedup by content-defined chunks of lines.

Every line with a visible character has a 64-bit hash. A rolling hash over the
hashes of two such neighbours stands for the pair; blank lines between the two
belong to it. A chunk is a stretch of lines whose rolling hashes are all
repeated somewhere in the corpus; its boundaries lie where the rolling hash
stops being a repeated one. So they depend on the chunk's own lines only: a
passage of two lines or more comes out whole wherever it stands and whatever
surrounds it. (Boundaries at minima of the rolling hash, which the first
version had, depend on lines around a passage, so most passages of two to five
lines held no whole chunk.)

Pairs of MIN_CHARS characters or more count. The first occurrence of a pair
(smallest doc_id, null first, then place in the text) stays; the lines of all
later ones go with their line breaks and the blank lines within, also where a
line begins or ends the first occurrence of another pair. A copy of every
removed line stands earlier, so the first of all copies of a line stays.
Hashes only find candidates; what is removed has been compared byte for byte.
A single repeated line among others that differ stays: that is the method's
limit.

Built-in functions only. The hashes of all pairs are grouped as small rows,
reduced to a smallest and a largest place before the shuffle; the places of those
that stand once go to their documents, and the pairs left are the repeated ones.
Their texts are grouped, one of each kept by a task before the shuffle, and the
first places go to their documents: every other repeated pair is a later copy.
The documents are shuffled once for both, so the texts are on disk once.
A passage that a third of all documents share is one row of each task.

Null and empty texts have no pair and stay as they are. Rows alike in id and
text are one document: they are cleaned alike, and neither removes the
other. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import let

MIN_CHARS = 40


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def pairs(text: Column) -> Column:
    """Array of (at, to, a, b): line numbers and lines of every two neighbours with a visible character."""
    def of(seen: Column) -> Column:
        return F.filter(F.zip_with(seen, F.slice(seen, 2, F.size(seen)), lambda x, y: F.struct(
            x["i"].alias("at"), y["i"].alias("to"), x["x"].alias("a"), y["x"].alias("b"))), lambda p: p["to"].isNotNull())

    visible = F.filter(F.transform(lines(text), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(r"[^\x09-\x0D\x20]"))
    return let(visible, lambda v: F.filter(of(v), lambda p: F.length(p["a"]) + F.length(p["b"]) >= MIN_CHARS))


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text, ...)`` with text cleaned, plus n_chunks and
    n_removed: the stretches of lines and the lines that were removed;
    n_chars, if there, follows the text."""
    names = docs.columns
    base = docs.withColumn("_copy", F.unhex(F.md5("text")))
    place = F.struct("id", "copy", "no")

    def with_numbers(rows: DataFrame, places: DataFrame, out: str) -> DataFrame:
        """``rows`` with the numbers of their pairs among ``places (id, copy, no)``."""
        p = places.groupBy(F.col("id").alias("_i"), F.col("copy").alias("_c")).agg(F.collect_list("no").alias("_no"))
        # null-safe on both, so this side's shuffle is the same one in every join and is written once
        joined = rows.join(p, F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("_copy").eqNullSafe(F.col("_c")), "left")
        return joined.withColumn(out, F.coalesce("_no", F.array().cast("array<int>"))).drop("_i", "_c", "_no")

    rolling = F.transform(pairs(F.col("text")), lambda p: F.xxhash64(F.xxhash64(p["a"]), F.xxhash64(p["b"])))
    keys = base.select(F.col("doc_id").alias("id"), F.col("_copy").alias("copy"), F.posexplode(rolling).alias("no", "key"))
    once = (keys.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
            .where(F.col("lo").eqNullSafe(F.col("hi"))).select("lo.*"))
    d = with_numbers(base, once, "_once")

    def repeated(p: Column) -> Column:
        """Numbers of the pairs whose hash stands elsewhere, too."""
        return F.array_except(F.transform(p, lambda x, i: i), "_once")

    # the texts of these only, to compare bytes
    texts = let(pairs(F.col("text")), lambda p: F.transform(repeated(p), lambda n: F.struct(
        n.alias("no"), F.concat(F.get(p, n)["a"], F.lit("\n"), F.get(p, n)["b"]).alias("pair"))))
    again = d.select(F.col("doc_id").alias("id"), F.col("_copy").alias("copy"), F.explode(texts).alias("s")).select("id", "copy", "s.no", "s.pair")
    first = again.groupBy("pair").agg(F.min(place).alias("first")).select("first.*")
    d = with_numbers(d, first, "_first")
    later = let(pairs(F.col("text")), lambda p: F.array_distinct(F.flatten(F.transform(
        F.array_except(repeated(p), "_first"), lambda n: F.sequence(F.get(p, n)["at"], F.get(p, n)["to"])))))
    d = d.withColumn("_gone", F.when(F.size(later) > 0, later))
    left = let(lines(F.col("text")), lambda l: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(l) - 1), "_gone"), lambda i: F.get(l, i)), "\n"))
    chunks = F.size(F.array_except("_gone", F.transform("_gone", lambda i: i + 1)))
    new = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)
    d = d.withColumns({"text": new, "_n": F.coalesce(F.when(F.col("_gone").isNotNull(), chunks), F.lit(0)).cast("long"),
                       "_r": F.coalesce(F.when(F.col("_gone").isNotNull(), F.size("_gone")), F.lit(0)).cast("long")})
    if "n_chars" in names:
        d = d.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return d.select(*names, F.col("_n").alias("n_chunks"), F.col("_r").alias("n_removed"))


def _sql(docs: str) -> str:
    """CTEs of the cleaned rows: l_out (rid, kept_text, n_chunks, n_removed)."""
    return f"""
l_rows as (select row_number() over () as rid, md5(text) as copy, doc_id, text from {docs}),
l_line as (select rid, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i, unnest(string_split(text, chr(10))) as line from l_rows where text is not null),
l_seen as (select rid, i, line, lead(i) over w as j, lead(line) over w as other from l_line
  where regexp_matches(line, '[^\\x09-\\x0D\\x20]') window w as (partition by rid order by i)),
l_pair as (select s.rid, i, j, line || chr(10) || other as pair, r.doc_id, r.copy from l_seen s join l_rows r using (rid)
  where j is not null and length(line) + length(other) >= {MIN_CHARS}),
l_rank as (select *, dense_rank() over (partition by pair order by doc_id nulls first, copy, i) as no from l_pair),
l_gone as (select distinct rid, unnest(range(i, j + 1)) as i from l_rank where no > 1),
l_mark as (select l.rid, l.i, l.line, g.i is not null as gone, lag(g.i is not null, 1, false) over (partition by l.rid order by l.i) as before
  from l_line l left join l_gone g on l.rid = g.rid and l.i = g.i),
l_out as (select rid, coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '') as kept_text,
    count(*) filter (where gone and not before) as n_chunks, count(*) filter (where gone) as n_removed from l_mark group by rid)"""


def oracle(docs: str = "documents") -> str:
    """DuckDB SQL for the query: pairs of lines by window functions, repeated ones by their text."""
    return f"""with {_sql(docs)}
select r.doc_id, case when r.text is not null then o.kept_text end as text, coalesce(o.n_chunks, 0) as n_chunks, coalesce(o.n_removed, 0) as n_removed
from l_rows r left join l_out o using (rid)"""
