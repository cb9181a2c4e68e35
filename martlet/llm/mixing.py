"""Mixing sources to target weights by Pareto order sampling.

Sizes are words. Sources in code point order (null last) get the weights
cyclically; together they are to supply ``share`` percent of all words, and
no source more than ``limit`` times its own (water filling: the target of a
source is min(limit * size, level * weight)). A source whose target is r
times its size takes floor(r) whole copies of each document for certain.
The rest r - floor(r) is the share p of one copy more, for which documents
are sampled with unequal probabilities: a document's inclusion odds are those
of p times its importance over the mean importance of its source. By default
importance is the size (documents of many words are likelier, as in sampling
with probability proportional to size); any positive column can take its
place. Documents are ranked by the odds of a random number in (0, 1) divided
by their inclusion odds (Pareto order sampling), and in each source the first
of that order are taken up to its missing words, the last one if that brings
the total nearer.

The random numbers are digests of seed and doc_id, so reruns agree. A source
that holds most rows is not sorted in one task: its missing words are located
in sums by BINS slices of the rank, and only the documents of the one slice
where the target falls are put in order.

Null text: size 0. Importance below 1 or null counts as 1. Null source: a source of its own. Null doc_id: a random
number like any other (all null ids share it). Rows alike in id, source and
size are ordered arbitrarily among themselves, which does not change the
multiset of results. Empty input gives an empty result. Sources are hosts:
they are numbered and filled in ranges, and only one row per SLICE of them
is gathered in a single window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import SPACES, cut, words
from martlet.operators.sequence import sequence_within

WEIGHTS = (3, 1, 2)
SHARE = 150
LIMIT = 2
BINS = 4096
SLICE = 4096
SEED = "mix-1"


def with_odds(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Adds size (words) and u, the document's number in (0, 1)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return docs.withColumns({"size": F.size(words(F.col("text"))).cast("long"), "u": u})


def targets(sources: DataFrame, weights=WEIGHTS, share: int = SHARE, limit: int = LIMIT) -> DataFrame:
    """``sources (source, source_size)`` -> with weight and target (words, double).

    The water level is found among the sources in the order in which they
    reach their limit: those before are full, the rest share what is left by
    weight.
    """
    s = sequence_within(sources.withColumn("none", F.col("source").isNull()), [], ["none", "source"], "no")
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), ((F.col("no") - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w).withColumn("ratio", F.col("source_size") / F.col("weight"))
    s = sequence_within(s, [], ["ratio", "none", "source"], "no_")
    s = cut(s.withColumn("slice", F.floor((F.col("no_") - 1) / SLICE)))
    # one row per SLICE sources: what the slices before hold
    slices = s.groupBy("slice").agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights"))
    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    slices = slices.select(
        F.col("slice").alias("of"), F.sum("words").over(total).alias("all_words"), F.sum("weights").over(total).alias("all_weights"),
        F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("words"), F.coalesce(F.sum("weights").over(upto), F.lit(0)).alias("weights"))
    before = Window.partitionBy("slice").orderBy("no_").rowsBetween(Window.unboundedPreceding, -1)
    s = s.join(slices, F.col("slice") == F.col("of"))
    s = s.withColumns({
        "left": F.col("all_words") * share - (F.col("words") + F.coalesce(F.sum("source_size").over(before), F.lit(0))) * limit * 100,
        "sharing": F.col("all_weights") - F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "cap": F.col("source_size") * limit,
    })
    # full: its limit lies at or below the level that the sources not yet full would reach
    s = cut(s.withColumn("full", F.col("cap") * 100 * F.col("sharing") <= F.col("left") * F.col("weight")))
    first = s.where(~F.col("full")).agg(F.min(F.struct("no_", "left", "sharing")).alias("first")).first()["first"]
    cap = F.col("cap").cast("double")
    target = cap if first is None else F.when(F.col("full"), cap).otherwise(
        F.least(cap, (F.lit(first["left"]).cast("double") / 100.0) / F.lit(first["sharing"]).cast("double") * F.col("weight")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: int = SHARE, limit: int = LIMIT, seed: str = SEED, importance: str | None = None) -> DataFrame:
    """``docs (doc_id, text, source, ...)`` -> doc_id, source, size, source_size, target, copies, taken.

    importance: a column of ``docs`` to use for a document's inclusion odds instead of its size.
    """
    own = F.col(importance) if importance else F.lit(None)
    rows = with_odds(docs.select("doc_id", "text", "source", own.cast("double").alias("own")), seed).drop("text")
    rows = cut(rows.withColumn("importance", F.greatest(F.lit(1.0), F.col("own") if importance else F.col("size").cast("double"))).drop("own"))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    mean = rows.groupBy(F.col("source").alias("m")).agg(F.avg("importance").alias("mean"))
    plan = targets(sums, weights, share, limit).withColumn(
        "ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = plan.withColumns({"whole": F.floor("ratio").cast("long"), "p": F.col("ratio") - F.floor("ratio")})
    plan = plan.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = cut(plan.withColumnRenamed("source", "of").join(mean, F.col("of").eqNullSafe(F.col("m"))).drop("m"))

    odds, least = F.col("u") / (1 - F.col("u")), F.lit(1e-300)  # p may be 0: then nothing is missing
    inclusion = F.greatest(F.col("p") / (1 - F.col("p")), least) * (F.col("importance") / F.col("mean"))
    rows = (rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("rank", odds / inclusion)
            .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int")))
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    cutting = cut(bins.where("words > 0 and missing > 0 and before < missing and before + words >= missing")
                  .select(F.col("source").alias("c"), F.col("bin").alias("cut_bin"), "before"))

    rows = rows.join(cutting, F.col("source").eqNullSafe(F.col("c")), "left").drop("c")
    inside = rows.where("bin = cut_bin")
    run = Window.partitionBy("source", "bin").orderBy("rank", F.col("doc_id"), "size")
    inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(
        run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    inside = inside.withColumn("more", (2 * F.col("upto") - F.col("size") <= 2 * F.col("missing")))
    outside = rows.where("cut_bin is null or bin <> cut_bin").withColumn(
        "more", F.coalesce(F.col("bin") < F.col("cut_bin"), F.lit(False)))
    keep = ["doc_id", "source", "size", "source_size", "target", "whole", "more"]
    out = inside.select(keep).unionByName(outside.select(keep))
    copies = F.col("whole") + F.col("more").cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns."""
    names = docs.columns
    key = ["_id", "_source", "_size", "_no"]

    def numbered(df: DataFrame, order) -> DataFrame:
        return df.withColumn("_no", F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy(order)))

    taken = mix(docs, **how).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies")
    taken = numbered(taken, F.desc("copies")).select(*[F.col(c).alias(f"{c}_") for c in key], F.col("copies").alias("_copies"))
    d = numbered(docs.withColumns({"_id": F.col("doc_id"), "_source": F.col("source"), "_size": F.size(words(F.col("text"))).cast("long")}), F.col("text"))
    on = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in key]
    both = d.join(taken, on[0] & on[1] & on[2] & on[3]).where("_copies > 0")
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(names)


def oracle(docs: str = "documents") -> str:
    """DuckDB SQL for ``mix`` (columns of the query); ``docs`` names the input relation."""
    return f"""
with recursive d as (
  select doc_id, source,
         cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda x: x <> '')) as bigint) as size,
         (cast(('0x' || substr(md5('{SEED}:' || coalesce(cast(doc_id as varchar), 'null')), 1, 12)) as bigint) + 0.5::double)
           / {float(1 << 48)!r}::double as u
  from {docs}),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, list_extract([{', '.join(map(str, WEIGHTS))}], cast((row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1 as int)) as weight from s),
-- share out, fix the sources above their limit, share out the rest among the others, until none is above
r(turn, source, source_size, weight, fixed, done) as (
  select 0, source, source_size, weight, false, false from w
  union all
  select turn + 1, source, source_size, weight,
         fixed or {LIMIT} * 100 * source_size * free_weight <= free * weight,
         not bool_or(not fixed and {LIMIT} * 100 * source_size * free_weight <= free * weight) over ()
  from (select *, sum(case when fixed then 0 else weight end) over () as free_weight,
               {SHARE} * sum(source_size) over () - 100 * sum(case when fixed then {LIMIT} * source_size else 0 end) over () as free
        from r where not done and turn < 100000)),
t as (select source, source_size, case when fixed then {LIMIT}.0::double * source_size else
        least({LIMIT}.0::double * source_size, ((cast({SHARE} * sum(source_size) over () - 100 * sum(case when fixed then {LIMIT} * source_size else 0 end) over () as double) / 100.0::double)
        / cast(sum(case when fixed then 0 else weight end) over () as double)) * weight) end as target
      from (select * from r qualify turn = max(turn) over ())),
m as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole,
        case when source_size > 0 then target / source_size - floor(target / source_size) else 0 end as p,
        (select avg(greatest(1, size)::double) from d where d.source is not distinct from t.source) as mean from t),
k as (select d.*, m.* exclude (source), (u / (1 - u)) / (greatest(p / (1 - p), 1e-300) * (greatest(1, size)::double / mean)) as rank
      from d join m on d.source is not distinct from m.source),
o as (select doc_id, size, source_size, target, whole, target - whole * source_size as missing,
        sum(size) over (partition by source order by rank, doc_id nulls first, size rows unbounded preceding) as upto from k)
select doc_id, size, source_size, target,
       cast(size * (whole + case when missing > 0 and 2 * upto - size <= 2 * missing then 1 else 0 end) as bigint) as taken
from o"""
