"""Token ids in grammar-compressed shard files (Re-Pair) with random access.

Each document's ids (the library's, special strings in texts as its default
has them) and the end id 0 are written in ascending doc_id order. Documents
are dealt to partitions by ranges of doc_id; every partition fills shards of
at least SHARD_IDS ids, a document never being split. A shard is one binary
record; the records are written as a Parquet table in the shared folder, so
Spark's commit protocol guards against lost executors and any store that
Spark writes will do.

Re-Pair by rounds: count the pairs of neighbouring ids in the shard, give
the most frequent ones (at least MIN_COUNT times, at most PAIRS_A_ROUND a
round) new symbols, replace them from left to right; without a frequent pair,
or once the symbols of 16 bits are all given, the rest is stored.

A shard, little endian: magic "RPR1"; u32 numbers of documents, rounds,
rules and symbols; u32 first symbol of each round; the rules as u16 pairs;
u32 expansion length of each rule; the symbols as u16; per document u8 has
an id, i64 doc_id, u64 start in the shard. ``read_ids`` decodes any range of
ids through the expansion lengths without the rest of the shard.

Encoding splits plain texts (ASCII, the letters of Latin-1) as the
vocabulary's public pattern does; the library's ids of each part are kept in
the worker by a hash and the part's own bytes, which are compared on every
use, for at most CACHE_ENTRIES parts. Texts
with other characters, an apostrophe, what might be a special string, or more
than BATCH_BYTES bytes go to the library whole.

Null and empty texts: only the end id. Null ids come first; rows with the
same id are ordered by a digest of the text, and are dealt to as many
partitions as they need. Other columns are ignored. No rows: no shard. A
vocabulary of more than 65,536 ids does not fit the symbols and is refused.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.llm.common import shared_folder
from martlet.llm.texthash import Checked

END = 0
SHARD_IDS = 1 << 20
PAIRS_A_ROUND = 4096
MIN_COUNT = 4
CACHE_ENTRIES = 2_000_000
CACHE_BYTES = 48 << 20
BATCH_BYTES = 1 << 20
MAGIC = b"RPR1"

_encoders: dict[str, _Encoder] = {}

#: Classes of bytes in plain texts: white space, letters, digits, other.
_SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_class = np.full(256, _ODD, dtype=np.uint8)
_class[32:127] = [_SPACE if c == 32 else _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _OTHER for c in range(32, 127)]
_class[[9, 10, 13]] = _SPACE
_class[0x80:0xC0] = _class[0xC3] = _LETTER  # second and first bytes of the letters from U+00C0 to U+00FF


_ASCII = bytes([9, 10, 13, *range(32, 127)])


def _plain(text: bytes) -> bool:
    """Only ASCII text and the letters from U+00C0 to U+00FF (0xC3 and a byte, but for the two signs)."""
    rest = text.translate(None, _ASCII)
    return not rest or (rest[::2] == b"\xc3" * (len(rest) - len(rest) // 2) and len(rest) % 2 == 0
                        and b"\x97" not in rest[1::2] and b"\xb7" not in rest[1::2])


def _parts(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the vocabulary's pattern starts a part, in plain texts set end to end; first: their first bytes.

    A part is a run of one class with the space before it. White space that
    another part follows leaves it its last space, and a last character
    that is no space is a part by itself.
    """
    kind = _class[raw]
    new = np.zeros(len(raw) + 1, dtype=bool)
    new[first] = new[-1] = True
    change = np.ones(len(raw), dtype=bool)
    change[1:] = (kind[1:] != kind[:-1]) | new[1:-1]
    space = kind == _SPACE
    followed = np.zeros(len(raw), dtype=bool)
    followed[:-1] = ~space[1:]
    followed &= ~new[1:]
    own = np.ones(len(raw), dtype=bool)  # no space before it that it takes
    own[1:] = (raw[:-1] != 32) | new[1:-1]
    return np.flatnonzero(np.where(space, change | followed, change & own))


class _Encoder:
    """The library's ids of texts; those of each part are kept by its bytes."""

    def __init__(self, path: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import public_tokenizers
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        if self.model.get_vocab_size() > 1 << 16:
            raise ValueError("token files hold ids of 16 bits")
        self.known = Checked(np.uint16, CACHE_ENTRIES, CACHE_BYTES)

    def library(self, text: bytes) -> np.ndarray:
        return np.array(self.model.encode(text.decode(errors="replace"), add_special_tokens=False).ids, dtype=np.uint16)

    def plain_batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of plain texts that are not empty."""
        data = b"".join(texts)
        raw, ends = np.frombuffer(data, dtype=np.uint8), np.cumsum([len(t) for t in texts])
        start = _parts(raw, np.concatenate(([0], ends[:-1])))
        end = np.append(start[1:], len(raw))

        def of_parts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ids = [x.ids for x in self.model.encode_batch_fast([data[i:j].decode() for i, j in zip(a.tolist(), b.tolist(), strict=True)], add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            return np.fromiter(chain.from_iterable(ids), dtype=np.uint16, count=sizes.sum()), sizes

        rows = self.known.rows(raw, start, end, of_parts)
        if rows is None:  # two parts with one hash
            return [self.library(t) for t in texts]
        ids, upto = self.known.runs(rows)
        return np.split(ids, upto[np.searchsorted(end, ends[:-1])])

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        out: list = [np.zeros(0, dtype=np.uint16)] * len(texts)
        held: list[int] = []
        data: list[bytes] = []
        size = 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if len(t) > BATCH_BYTES or b"<|" in t or b"'" in t or not _plain(t):
                out[i] = self.library(t)
                continue
            data.append(t)
            held.append(i)
            size += len(t)
            if size >= BATCH_BYTES:
                for k, x in zip(held, self.plain_batch(data), strict=True):
                    out[k] = x
                held, data, size = [], [], 0
        if held:
            for k, x in zip(held, self.plain_batch(data), strict=True):
                out[k] = x
        return out


def _encoder(path: str | None) -> _Encoder:
    key = path or ""
    if key not in _encoders:
        _encoders[key] = _Encoder(path)
    return _encoders[key]


def compress(ids: np.ndarray, rounds: int | None = None, first: int | None = None) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """(symbols, rules of each round as rows of two symbols, first symbol of each round)."""
    seq = ids.astype(np.uint16)
    free = int(seq.max(initial=0)) + 1 if first is None else first
    rules, firsts = [], []
    while rounds is None or len(rules) < rounds:
        room = min(PAIRS_A_ROUND, 65536 - free)
        if len(seq) < 2 or room <= 0:
            break
        pair = (seq[:-1].astype(np.uint32) << np.uint32(16)) | seq[1:]
        ordered = np.sort(pair)
        edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
        count = np.diff(edge)
        often = np.flatnonzero(count >= MIN_COUNT)
        if not len(often):
            break
        if len(often) > room:
            often = often[np.argsort(-count[often], kind="stable")[:room]]
        chosen = np.sort(ordered[edge[often]])
        heavy = np.zeros(1 << 16, dtype=bool)  # a cheap first look by a hash of the pair
        slot = ((pair * np.uint32(2654435761)) >> np.uint32(16))
        heavy[(chosen * np.uint32(2654435761)) >> np.uint32(16)] = True
        at = np.flatnonzero(heavy[slot])
        rank = np.searchsorted(chosen, pair[at])
        rank[rank == len(chosen)] = 0
        hit = chosen[rank] == pair[at]
        at, rank = at[hit], rank[hit]
        # of pairs that overlap, every second one from the left
        head = np.concatenate(([True], at[1:] != at[:-1] + 1))
        run = np.flatnonzero(head)[np.cumsum(head) - 1]
        odd = (np.arange(len(at)) - run) % 2 == 0
        at, rank = at[odd], rank[odd]
        seq[at] = (free + rank).astype(np.uint16)
        stay = np.ones(len(seq), dtype=bool)
        stay[at + 1] = False
        seq = seq[stay]
        rules.append(np.stack([chosen >> np.uint32(16), chosen & np.uint32(0xFFFF)], axis=1).astype(np.uint16))
        firsts.append(free)
        free += len(chosen)
    return seq, rules, firsts


def expand(seq: np.ndarray, rules: list[np.ndarray], firsts: list[int]) -> np.ndarray:
    for rule, first in zip(reversed(rules), reversed(firsts), strict=True):
        new = seq >= first
        where = np.arange(len(seq)) + np.cumsum(new) - new
        out = np.empty(len(seq) + int(new.sum()), dtype=np.uint16)
        out[where] = np.where(new, 0, seq)
        r = rule[seq[new].astype(np.int64) - first]
        out[where[new]] = r[:, 0]
        out[where[new] + 1] = r[:, 1]
        seq = out
    return seq


def lengths(rules: list[np.ndarray], firsts: list[int]) -> np.ndarray:
    """Expansion length of every rule, in the order of their symbols."""
    if not rules:
        return np.zeros(0, dtype=np.uint32)
    out = np.ones(firsts[-1] + len(rules[-1]), dtype=np.uint32)
    for rule, first in zip(rules, firsts, strict=True):
        out[first:first + len(rule)] = out[rule[:, 0]] + out[rule[:, 1]]
    return out[firsts[0]:]


def pack(doc_ids: list[int | None], ids: list[np.ndarray], rounds: int | None = None, first: int | None = None) -> bytes:
    """A shard of these documents' ids, end ids included."""
    data = np.concatenate([np.zeros(0, dtype=np.uint16), *ids])
    seq, rules, firsts = compress(data, rounds, first)
    sizes = [len(x) for x in ids]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if sizes else np.zeros(0)
    n = sum(map(len, rules))
    return b"".join([
        MAGIC, struct.pack("<4I", len(ids), len(rules), n, len(seq)), np.array(firsts, dtype="<u4").tobytes(),
        *[r.astype("<u2").tobytes() for r in rules], lengths(rules, firsts).astype("<u4").tobytes(), seq.astype("<u2").tobytes(),
        np.array([x is not None for x in doc_ids], dtype="u1").tobytes(), np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
        starts.astype("<u8").tobytes()])


class Shard:
    """A shard opened for reading."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a shard")
        docs, rounds, n, size = struct.unpack_from("<4I", blob, 4)
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.firsts = take("<u4", rounds).tolist()
        table = take("<u2", 2 * n).reshape(-1, 2)
        bounds = [f - self.firsts[0] for f in self.firsts] + [n]
        self.rules = [table[a:b] for a, b in zip(bounds, bounds[1:], strict=False)] if rounds else []
        self.lengths = take("<u4", n)
        self.symbols = take("<u2", size)
        known = take("u1", docs)
        self.doc_ids = [int(x) if k else None for x, k in zip(take("<i8", docs), known, strict=True)]
        self.starts = take("<u8", docs).astype(np.int64)

    def spans(self) -> np.ndarray:
        """Expansion length of every stored symbol."""
        out = np.ones(len(self.symbols), dtype=np.int64)
        if self.firsts:
            rule = self.symbols >= self.firsts[0]
            out[rule] = self.lengths[self.symbols[rule].astype(np.int64) - self.firsts[0]]
        return out

    def ids(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.firsts)

    def read_ids(self, start: int, count: int) -> np.ndarray:
        """Ids start .. start + count of the shard, expanding only the symbols that hold them."""
        ends = np.cumsum(self.spans())
        a, b = np.searchsorted(ends, [start, start + count - 1], side="right")
        before = ends[a - 1] if a else 0
        return expand(self.symbols[a:b + 1], self.rules, self.firsts)[start - before:start - before + count]


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard_ids: int = SHARD_IDS, rounds: int | None = None) -> None:
    """Writes the shards of ``docs (doc_id, text)`` to a Parquet table: part, shard, n_ids, data."""

    def shards(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, no = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        first = max(enc.model.get_vocab_size(), 1)
        end = np.array([END], dtype=np.uint16)
        names: list = []
        ids: list[np.ndarray] = []
        size = 0

        def record():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([no], pa.int32()), "n_ids": pa.array([size], pa.int64()),
                "data": pa.array([pack(names, ids, rounds, first)], pa.binary())})

        for b in frames:
            for i, x in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                names.append(i)
                ids.append(np.concatenate((x, end)))
                size += len(ids[-1])
                if size >= shard_ids:
                    yield record()
                    names, ids, size, no = [], [], 0, no + 1
        if names:
            yield record()

    # the digest and the row's place part the rows of one id, or of one id and text, among tasks
    by = [F.col("doc_id").asc_nulls_first(), "digest", "place"]
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
     .withColumns({"digest": F.md5("text"), "place": F.monotonically_increasing_id()})
     .repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
     .mapInArrow(shards, "part int, shard int, n_ids long, data binary").write.parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shard files alone."""

    def decode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            for base, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = Shard(blob.as_py())
                ids = s.ids().astype("<u4")
                ends = np.append(s.starts[1:], len(ids))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(s.doc_ids, pa.int64()), "start": pa.array(s.starts + base, pa.int64()),
                    "n_tokens": pa.array(ends - s.starts, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[x:y].tobytes()) for x, y in zip(s.starts, ends, strict=True)], pa.int64())})

    table = spark.read.parquet(path)
    # ids before each partition, then before each of its shards: one row a partition is in the window without a key
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("in_part").over(ahead), F.lit(0)).alias("before"))
    bases = (table.select("part", "shard", "n_ids").join(before, "part")
             .withColumn("base", F.col("before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))))
    return (table.select("part", "shard", "data").join(bases.select("part", "shard", "base"), ["part", "shard"])
            .select("base", "data").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the shards to a new table in the shared folder and reads them back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/token-shards-{uuid.uuid4().hex}"
    write(docs, path, tokenizer)
    return read(spark, path)
