"""Periodic runs of words by an enhanced suffix array.

A run is a stretch of words with a smallest period q that no neighbouring
word extends, of at least ``min_words`` words and ``min_periods`` periods.

1. Texts are numbered word by word through a dictionary (no hashes) and
   joined in batches; a code holds the text and the word, so no order or
   common prefix reaches from one text into another. The suffix array comes
   from prefix doubling over the places whose order is still open; common
   prefixes are compared only where they are irreducible and read off for
   the other suffixes.
2. Every place k of the suffix array with lcp[k] = d > 0 splits its LCP
   interval in two (bounds by nearest smaller values, no tree is built).
   The suffixes i of the smaller side look up ISA[i + d] and ISA[i - d]: in
   the other side of the interval this is a square of period d that cannot be
   rotated to the right (branching), so its end is the end of a run. That
   looks at n log n suffixes at most. An interval with fewer suffixes than
   ``min_periods``, or whose d does not fit so often into the text, holds no
   such run.
3. A square whose left neighbours by one, two, ... periods are in the same
   interval has enough periods; it is rotated left as long as the words agree,
   which gives the start of its run. Squares of one stretch are merged into
   its smallest period, multiples of a period are skipped before they are
   rotated.

A task holds one batch (BATCH_WORDS words, or one longer text): memory
grows with the longest text, about 150 bytes a word, not with the number of
texts. Nothing is shuffled, so copies, repeated ids and frequent words meet
nowhere.

Words are the stretches without space and U+0009 to U+000D. Null and empty
texts have no words: no runs, an empty collapsed text. Rows with a null
doc_id and repeated rows are treated like any other; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
MIN_PERIODS = 4
BATCH_WORDS = 1 << 17
LOOKUPS = 1 << 20  # suffixes tested at once
_LOCKSTEP = 48  # words compared side by side before pairs are finished one by one
_JUMPS = 24  # rounds of pointer jumping before the rest is walked

Rewrite = Callable[[int | None, int], np.ndarray | None]


class _Ids(dict):
    """Word -> number, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _order(keys: np.ndarray, bound: int) -> np.ndarray:
    """argsort of keys in [0, bound); equal keys stay in order."""
    n = len(keys)
    if bound < (1 << 62) // max(n, 1):
        return np.sort(keys * n + np.arange(n)) % n  # several times faster than argsort
    return np.argsort(keys, kind="stable")


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return new


def suffix_array(codes: np.ndarray, end: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, its inverse) of codes in [0, bound); the suffix at i ends before end[i], a prefix sorts first."""
    n = len(codes)
    order = _order(codes, bound)
    rank = np.empty(n, dtype=np.int64)
    new = _heads(codes[order])
    group = np.flatnonzero(new)[np.cumsum(new) - 1]  # place of the group's first suffix
    rank[order] = group
    h = 1
    places = np.arange(n)
    while True:
        several = np.ones(len(places), dtype=bool)  # in a group with others
        several[:-1] = group[1:] == group[:-1]
        several[1:] |= group[1:] == group[:-1]
        several[:1] &= len(places) > 1
        places, group = places[several], group[several]
        if not len(places):
            return order, rank
        at = order[places]
        after = at + h
        inside = after < end[at]
        key = group * (n + 1)
        key[inside] += rank[after[inside]] + 1
        o = _order(key, n * (n + 1))
        key = key[o]
        order[places] = at[o]
        new = _heads(key)
        group = places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank[order[places]] = group
        h *= 2


def common_prefixes(codes: np.ndarray, end: np.ndarray, order: np.ndarray) -> np.ndarray:
    """lcp[k] of the suffixes at places k - 1 and k of the suffix array (lcp[0] = 0)."""
    n = len(codes)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    same = before >= 0
    same[same] = end[before[same]] == end[same]
    # PLCP[i] = PLCP[i - 1] - 1 where the words before i and before its predecessor agree
    reducible = np.zeros(n, dtype=bool)
    i = np.flatnonzero(same)
    i = i[(i > 0) & (before[i] > 0)]
    reducible[i] = codes[i - 1] == codes[before[i] - 1]
    head = np.flatnonzero(~reducible)
    value = np.zeros(len(head), dtype=np.int64)
    live = np.flatnonzero(same[head])
    for step in range(_LOCKSTEP):
        i, j = head[live] + step, before[head[live]] + step
        ok = (i < end[head[live]]) & (j < end[head[live]])
        live, i, j = live[ok], i[ok], j[ok]
        live = live[codes[i] == codes[j]]
        if not len(live):
            break
        value[live] = step + 1
    for k in live.tolist():  # long ones: their sum is n log n at most
        i, j, l, size = int(head[k]), int(before[head[k]]), int(value[k]), 64
        limit = int(end[i]) - max(i, j)
        while l < limit:
            size = min(2 * size, limit - l)
            differs = np.flatnonzero(codes[i + l:i + l + size] != codes[j + l:j + l + size])
            if len(differs):
                l += int(differs[0])
                break
            l += size
        value[k] = l
    since = np.cumsum(~reducible) - 1  # the last irreducible suffix
    plcp = value[since] - (np.arange(n) - head[since])
    return plcp[order]


def _nearest(lcp: np.ndarray, at: np.ndarray, equal: bool) -> np.ndarray:
    """For each place of ``at`` (ascending) the nearest one to its left with a smaller (or, if ``equal``, no larger) value; lcp[0] is 0."""
    back = np.arange(-1, len(lcp) - 1)
    back[0] = 0
    open_ = at
    beyond = (lambda p, k: lcp[p] > lcp[k]) if equal else (lambda p, k: lcp[p] >= lcp[k])
    for _ in range(_JUMPS):
        open_ = open_[beyond(back[open_], open_)]
        if not len(open_):
            return back[at]
        back[open_] = back[back[open_]]
    for k in open_.tolist():  # ascending: all before k are final, which makes the walk linear
        p, v = back[k], lcp[k]
        while lcp[p] > v or (lcp[p] == v and not equal):
            p = back[p]
        back[k] = p
    return back[at]


def intervals(lcp: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) place of the LCP interval that each wanted place (ascending, lcp > 0) splits.

    Of equal values within an interval the leftmost splits first, so every
    pair of suffixes is parted by exactly one place.
    """
    first = _nearest(lcp, wanted, equal=True)
    n = len(lcp)
    flipped = np.concatenate(([0], lcp[:0:-1]))  # place k -> n - k
    last = n - 1 - _nearest(flipped, (n - wanted)[::-1], equal=False)[::-1]
    return first, np.where(last < 0, n - 1, last)


def branching_squares(lcp: np.ndarray, order: np.ndarray, rank: np.ndarray, size: np.ndarray, periods: int) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of the branching squares that at least ``periods - 2`` more copies of their period precede.

    size: number of words of the text that holds each suffix.
    """
    k = np.flatnonzero(lcp > 0)
    k = k[lcp[k] * periods <= size[order[k]]]
    ends, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if not len(k):
        return ends[0], found[0]
    deep = np.flatnonzero(lcp > 0)  # bounds need all places
    first, last = intervals(lcp, deep)
    pick = np.searchsorted(deep, k)
    first, last = first[pick], last[pick]
    enough = last - first + 1 >= periods
    k, first, last = k[enough], first[enough], last[enough]
    n = len(lcp)
    left = k - first <= last - k + 1  # the smaller side
    lo, many = np.where(left, first, k), np.where(left, k - first, last - k + 1)
    upto = np.cumsum(many)
    a = 0
    while a < len(k):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + LOOKUPS, side="right")))
        node = np.repeat(np.arange(a, b), many[a:b])
        i = order[lo[node] + np.arange(len(node)) - (upto[node] - many[node] - (upto[a - 1] if a else 0))]
        d = lcp[k[node]]
        other_lo, other_hi = np.where(left, k, first)[node], np.where(left, last, k - 1)[node]
        for start, partner in ((i, i + d), (i - d, i - d)):
            ok = (partner >= 0) & (partner < n)
            where = rank[np.where(ok, partner, 0)]
            ok &= (where >= other_lo) & (where <= other_hi)
            s, p, v = start[ok], d[ok], node[ok]
            for back in range(1, periods - 1):
                prior = s - back * p
                inside = prior >= 0
                where = rank[np.where(inside, prior, 0)]
                inside &= (where >= first[v]) & (where <= last[v])
                s, p, v = s[inside], p[inside], v[inside]
            ends.append(s + 2 * p)
            found.append(p)
        a = b
    return np.concatenate(ends), np.concatenate(found)


def _rotate(codes: np.ndarray, at: int, period: int, begin: int) -> int:
    """The leftmost place from which all words up to ``at`` equal the one a period later."""
    size = 16
    while at > begin:
        size = min(2 * size, at - begin)
        differs = np.flatnonzero(codes[at - size:at] != codes[at - size + period:at + period])
        if len(differs):
            return at - size + int(differs[-1]) + 1
        at -= size
    return begin


def runs_of(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, bound: int, min_words: int = MIN_WORDS,
            min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, sorted by start and period, in joined texts; begin and end are those of each word's text."""
    if not len(codes):
        return []
    order, rank = suffix_array(codes, end, bound)
    lcp = common_prefixes(codes, end, order)
    ends, periods = branching_squares(lcp, order, rank, end - begin, min_periods)
    out: list[tuple[int, int, int]] = []
    here, last = [], -1  # (start, period) of the runs that end at the same word
    for o in np.lexsort((periods, ends)).tolist():
        e, p = int(ends[o]), int(periods[o])
        if e != last:
            here, last = [], e
        if any(p % q == 0 and s <= e - 2 * p for s, q in here):
            continue  # a power of a shorter period
        s = _rotate(codes, e - 2 * p, p, int(begin[e - 1]))
        here.append((s, p))
        if e - s >= max(min_words, min_periods * p):
            out.append((s, e - s, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _batches(rows: Iterator[tuple[int | None, bytes | None]], rewrite: Rewrite | None, limit: int):
    """(ids, list of the words' spellings, codes of each text) of whole texts, up to about ``limit`` words."""
    ids, seen, texts, held = [], _Ids(), [], 0
    for doc_id, text in rows:
        w = (text or b"").split()
        code = np.fromiter(map(seen.__getitem__, w), dtype=np.int64, count=len(w))
        new = rewrite(doc_id, len(w)) if rewrite else None
        ids.append(doc_id)
        texts.append(code if new is None else code[new])
        held += len(w)
        if held >= limit or len(ids) >= limit:
            yield ids, list(seen), texts
            ids, seen, texts, held = [], _Ids(), [], 0
    if ids:
        yield ids, list(seen), texts


def _find(min_words: int, min_periods: int, rewrite: Rewrite | None):
    def one(ids: list, spelling: list[bytes], texts: list[np.ndarray]) -> pa.RecordBatch:
        size = np.array([len(t) for t in texts])
        upto = np.cumsum(size)
        text = np.repeat(np.arange(len(texts)), size)
        flat = np.concatenate(texts)
        begin, end = (upto - size)[text], upto[text]
        kinds = max(len(spelling), 1)
        runs = runs_of(text * kinds + flat, begin, end, len(texts) * kinds, min_words, min_periods)
        drop = np.zeros(len(flat) + 1, dtype=np.int64)
        found: list[list[dict]] = [[] for _ in texts]
        for s, length, p in runs:
            t = int(text[s])
            found[t].append({"start": s - int(upto[t] - size[t]), "length": length, "period": p})
            drop[s + p] += 1
            drop[s + length] -= 1
        kept = np.cumsum(drop[:-1]) == 0
        rest = []
        for t, n, codes in zip(upto.tolist(), size.tolist(), texts, strict=True):
            rest.append(b" ".join(map(spelling.__getitem__, codes[kept[t - n:t]].tolist())))
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(size, pa.int64()),
            "runs": pa.array(found, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            "collapsed": pa.array(rest, pa.binary())})

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i, t) for b in frames for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for batch in _batches(rows, rewrite, BATCH_WORDS):
            yield one(*batch)

    return run


def word_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, rewrite: Rewrite | None = None) -> DataFrame:
    """``docs (doc_id, text)`` -> doc_id, n_words, runs array<struct<start, length, period>>, collapsed text.

    runs: by start, then period; numbers are word numbers from 0. collapsed:
    the words outside every run's repetitions (its first period stays),
    joined by a space. rewrite: from (doc_id, number of words) the numbers of
    the words to take instead of all (None: all).
    """
    if min_periods < 2:
        raise ValueError("runs have two periods at least")
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
             .mapInArrow(_find(min_words, min_periods, rewrite),
                         "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"))
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's rewriting: the tail of every text whose id has a CRC divisible by ten is made periodic."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def digests(docs: DataFrame) -> DataFrame:
    """The query's rows: the number of runs, the run with the most periods, and digests of the runs and the collapsed text."""
    r = word_runs(docs, rewrite=planted)
    # more periods first: a.length / a.period > b.length / b.period without division
    def better(a, b):
        mine, other = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(mine != other, F.when(mine > other, -1).otherwise(1)).when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                .otherwise(F.signum(a["period"] - b["period"]).cast("int")))

    lines = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    best = F.get(F.array_sort("runs", better), F.lit(0))
    return r.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
