"""Quality rules: statistics of each text, and cross-document line frequency.

A line's key is the digest of its normal form (lower case, each run of
digits one 0, white space runs one space, trimmed). For every host
(``source``; null is a host too) the documents holding a line are counted,
exact copies of a text as one document. A line is boilerplate of its host if
more than MAX_DOCUMENTS of them and more than MAX_PERCENT of the host's
documents hold it. Such lines are removed; a document is depleted, and
rejected, if over MAX_REMOVED_PERCENT of its words go or fewer than MIN_WORDS
stay. Documents that fail the base rules are rejected as well.

Only built-in functions run. All statistics of a text come from array
functions on its own row, so texts are not shuffled for them; what is
shuffled are one small row for each distinct line of a text and one for each
text, with minima and counts taken before the shuffle, so a hot host or a hot
line spreads over all tasks.

Null and empty texts: no words, base_failed, not kept. Null ids are ids like
others. Rows alike in id, host and text are judged alike, each in its own
row. Other columns are ignored (``quality``) or passed on (``clean``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import SPACES, cut, let, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_DOCUMENTS = 20
MAX_PERCENT = 2
MAX_REMOVED_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def _repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, first included.

    Sorting the windows' hashes with their positions puts equal ones side by
    side; the repeated positions, in order, cover WINDOW words each less what
    neighbours share. Texts without a repeated window stop at a distinct count.
    """
    n = F.size(w)
    hashes = F.when(n >= WINDOW, F.transform(
        F.arrays_zip(F.slice(w, 1, n - 2).alias("a"), F.slice(w, 2, n - 2).alias("b"), F.slice(w, F.lit(3), n - 2).alias("c")),
        lambda x: F.xxhash64(x["a"], x["b"], x["c"]))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: let(
            F.array_sort(F.transform(
                F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                         | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])),
            lambda p: F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                                             lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
                                  F.lit(0), lambda acc, x: acc + x)))

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def base_stats(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(text, F.lit(""))

    def lines_twice(x: Column) -> Column:
        full = F.filter(F.split(x, "\n", -1), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
        return let(full, lambda f: F.size(f) - F.size(F.array_distinct(f)))

    return let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.size(F.split(t, f"[{SYMBOLS}]", -1)) - 1).cast("long").alias("n_symbols"),
        lines_twice(t).cast("long").alias("n_dup_lines"),
        _repeat_words(w).cast("long").alias("n_repeat_words"),
    ))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def normal_lines(text: Column) -> Column:
    """The normal form of each line, in order."""
    t = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(_lines(t), lambda l: F.btrim(l, F.lit(" ")))


def _digest(x: Column) -> Column:
    return F.unhex(F.md5(x))


def line_rows(docs: DataFrame) -> DataFrame:
    """(id, host, copy, line, n) for every line with a word: digests of the text and of the line, words in it."""
    each = docs.where("text is not null").select(
        F.col("doc_id").alias("id"), F.col("source").alias("host"), _digest(F.col("text")).alias("copy"),
        F.explode(normal_lines(F.col("text"))).alias("l")).where("l <> ''")
    return each.select("id", "host", "copy", _digest(F.col("l")).alias("line"),
                       (F.length("l") - F.length(F.replace(F.col("l"), F.lit(" "), F.lit(""))) + 1).cast("long").alias("n"))


def frequent_lines(rows: DataFrame, max_documents: int = MAX_DOCUMENTS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """(host, line) of the boilerplate lines among ``line_rows``."""
    # one row of each distinct text of a host speaks for its copies
    held = (rows.select("host", "copy", "line").distinct()
            .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_documents))
    size = rows.select("host", "copy").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    return (held.join(size.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
            .where(F.col("n") * 100 > F.col("all") * max_percent).select("host", "line"))


def removed_words(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(id, host, copy, lines, removed): for texts with boilerplate its lines, and the words of all rows alike."""
    f = frequent.select(F.col("host").alias("h"), F.col("line").alias("k"))
    hit = rows.join(f, (F.col("line") == F.col("k")) & F.col("host").eqNullSafe(F.col("h")))
    per = hit.groupBy("id", "host", "copy", "line").agg(F.sum("n").alias("n"))
    return per.groupBy("id", "host", "copy").agg(F.sum("n").alias("removed"), F.collect_list("line").alias("lines"))


def _judged(docs: DataFrame, columns: list[str], max_documents: int, max_percent: int) -> DataFrame:
    """docs with the statistics (_q_s), the words removed, the boilerplate lines found and the verdict."""
    rows = cut(line_rows(docs.select("doc_id", "source", "text")))
    removed = removed_words(rows, frequent_lines(rows, max_documents, max_percent))
    # rows alike in id, host and text repeat their lines as often: divide by their number
    times = (rows.groupBy("id", "host", "copy").agg(F.sum("n").alias("words"))
             .select(F.col("id").alias("i"), F.col("host").alias("h"), F.col("copy").alias("c"), "words"))
    removed = removed.join(times, F.col("id").eqNullSafe(F.col("i")) & F.col("host").eqNullSafe(F.col("h")) & (F.col("copy") == F.col("c")))
    removed = removed.select(*[F.col(c).alias(f"_q_{c}") for c in ("id", "host", "copy", "lines", "removed", "words")])
    d = docs.select(*[F.col(c) for c in columns], _digest(F.col("text")).alias("_q_text"), base_stats(F.col("text")).alias("_q_s"))
    d = d.join(removed, F.col("doc_id").eqNullSafe(F.col("_q_id")) & F.col("source").eqNullSafe(F.col("_q_host")) & (F.col("_q_text") == F.col("_q_copy")), "left")
    s = F.col("_q_s")
    d = d.withColumn("_q_gone", F.coalesce(F.col("_q_removed") * s["n_words"] / F.col("_q_words"), F.lit(0)).cast("long"))
    failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
    left = s["n_words"] - F.col("_q_gone")
    depleted = (F.col("_q_gone") > 0) & ((left < MIN_WORDS) | (100 * F.col("_q_gone") > MAX_REMOVED_PERCENT * s["n_words"]))
    # one comparison of both, lest a filter on it be split and the statistics be computed again below the join
    return d.withColumns({"_q_failed": failed, "_q_kept": F.greatest(failed.cast("int"), depleted.cast("int")) == 0})


def quality(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """doc_id, the statistics, base_failed, kept, n_removed_words for each row of ``docs (doc_id, text, source)``."""
    return _judged(docs, ["doc_id", "source"], max_documents, max_percent).select(
        "doc_id", "_q_s.*", F.col("_q_failed").alias("base_failed"), F.col("_q_kept").alias("kept"), F.col("_q_gone").alias("n_removed_words"))


def clean(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """The kept rows of ``docs`` without their boilerplate lines, the columns of documents; n_chars follows the text."""
    names = docs.columns
    d = _judged(docs, names, max_documents, max_percent).where("_q_kept")
    pairs = F.zip_with(_lines(F.col("text")), normal_lines(F.col("text")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    left = F.array_join(F.transform(F.filter(pairs, lambda p: ~F.array_contains(F.col("_q_lines"), _digest(p["b"]))), lambda p: p["a"]), "\n")
    same = F.col("_q_lines").isNull()
    d = d.withColumn("text", F.when(same, F.col("text")).otherwise(left))
    if "n_chars" in names:
        d = d.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return d.select(names)


def _stats_sql(docs: str) -> str:
    split = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda x: x <> '')"
    lower = f"trim(regexp_replace(regexp_replace(lower(x), '[0-9]+', '0', 'g'), '{SPACES}', ' ', 'g'))"
    return f"""
q_rows as (select row_number() over () as rid, doc_id, text, source from {docs}),
q_words as (select rid, {split} as w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as full_lines from q_rows),
q_grams as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select rid, w, unnest(range(1, len(w) - 1)) as i from q_words)),
q_hit as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from q_grams) where c > 1),
q_cover as (select rid, count(distinct i + k) as n from q_hit, (values (0), (1), (2)) as k(k) group by rid),
q_line as (select rid, md5(text) as copy, source, unnest(list_transform(string_split(text, chr(10)), lambda x: {lower})) as line,
             unnest(list_transform(string_split(text, chr(10)), lambda x: len(list_filter(regexp_split_to_array(x, '{SPACES}'), lambda y: y <> '')))) as n
           from q_rows where text is not null),
q_host as (select source, count(distinct copy) as total from q_line where n > 0 group by source),
q_freq as (select l.source, l.line from q_line l join q_host h on l.source is not distinct from h.source where l.line <> ''
           group by l.source, l.line, h.total having count(distinct l.copy) > {MAX_DOCUMENTS} and count(distinct l.copy) * 100 > h.total * {MAX_PERCENT}),
q_gone as (select l.rid, sum(l.n) as n from q_line l join q_freq f on l.line = f.line and l.source is not distinct from f.source group by l.rid),
q_stat as (select r.rid, r.doc_id, len(w) as n_words,
    length(regexp_replace(coalesce(text, ''), '{SPACES}', '', 'g')) as word_chars,
    length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{SYMBOLS}', '')) as n_symbols,
    len(full_lines) - len(list_distinct(full_lines)) as n_dup_lines,
    coalesce(c.n, 0) as n_repeat_words, cast(coalesce(g.n, 0) as bigint) as n_removed_words
  from q_rows r join q_words using (rid) left join q_cover c using (rid) left join q_gone g using (rid)),
q_fail as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from q_stat),
q_verdict as (select *, not base_failed and not (n_removed_words > 0 and (n_words - n_removed_words < {MIN_WORDS}
    or 100 * n_removed_words > {MAX_REMOVED_PERCENT} * n_words)) as kept from q_fail)"""


def oracle(docs: str = "documents") -> str:
    """DuckDB SQL for ``quality`` by windows and joins over exploded words."""
    return f"""with {_stats_sql(docs)}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words from q_verdict"""
