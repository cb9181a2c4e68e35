"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table of the frequent pre-tokens' lengths, taken
from a sample of at most about SAMPLE_ROWS documents and cut to
TABLE_ENTRIES entries of at most ENTRY_CHARS characters (a few MB whatever
the corpus). Tier two is a cache in each Python worker for the pre-tokens
that the table lacks; each is encoded once and the cache starts anew at
CACHE_ENTRIES. The table and the caches only save time: every count is the
library's, and no pre-token is shuffled.

A pre-token is a run of spaces with what follows up to the next space. The
library joins pieces only within it, since no piece of the vocabulary has
a space mark after another character; ``_Counter`` checks that and
otherwise encodes whole texts.

Null and empty texts have no token; rows with a null id and repeated rows
are counted as they stand; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 2_000
TABLE_ENTRIES = 50_000
ENTRY_CHARS = 24
CACHE_ENTRIES = 500_000
MARK = "▁"

_counters: dict[str, _Counter] = {}


class _Counter(dict):
    """Pre-token without its first space -> number of its tokens."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.whole = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.table: dict[str, int] = {}

    def __missing__(self, unit: str) -> int:
        n = self.table.get(unit)
        if n is None:
            n = len(self.model.encode(unit)) if unit else 1
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[unit] = n
        return n

    def units(self, text: str) -> list[str]:
        text = text.replace(MARK, " ")
        if text[:1] == " " or "  " in text:
            return [u[1:] for u in re.findall(r" +[^ ]*", f" {text}")]
        return text.split(" ")

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.whole:
            return len(self.model.encode(text))
        return sum(map(self.__getitem__, self.units(text)))


def _counter(path: str | None) -> _Counter:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    if path not in _counters:
        _counters[path] = _Counter(path)
    return _counters[path]


def frequent_lengths(docs: DataFrame, model: str | None = None) -> dict[str, int]:
    """The most frequent pre-tokens of a bounded sample of documents with their lengths."""

    def tally(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, seen = _counter(model), Counter()
        for b in frames:
            for t in b.column(0).to_pylist():
                seen.update(u for u in c.units(t or "") if len(u) <= ENTRY_CHARS)
        top = seen.most_common(TABLE_ENTRIES)
        yield pa.RecordBatch.from_pydict({"unit": pa.array([u for u, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64()),
                                          "length": pa.array([c[u] for u, _ in top], pa.int32())})

    rows = docs.count()
    part = docs.select("text").sample(fraction=min(1.0, SAMPLE_ROWS / max(rows, 1)), seed=1)
    seen, lengths = Counter(), {}
    found = (part.mapInArrow(tally, "unit string, n long, length int").groupBy("unit")
             .agg(F.sum("n").alias("n"), F.first("length").alias("length"))
             .orderBy(F.desc("n"), "unit").limit(TABLE_ENTRIES))
    for r in found.collect():
        seen[r.unit], lengths[r.unit] = r.n, r.length
    return lengths


def token_counts(docs: DataFrame, model: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs (doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, model))

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(model)
        c.table = sent.value
        for b in frames:
            n = [c.count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_bytes": b.column(2),
                                              "n_tokens": pa.array(n, pa.int64()),
                                              "over_limit": pa.array([x > limit for x in n], pa.bool_())})

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
