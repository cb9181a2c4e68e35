"""N-gram Jaccard join on size-banded tiles with bitmap signatures.

A document's set holds the 64-bit hashes of its distinct word shingles, as a
sorted array. Two documents link when their sets' Jaccard similarity is
percent / 100 or more.

1. Documents with equal sets (128-bit digest and size) form a class; from
   here on each class has one representative and, as a node, 48 bits of its
   digest.
2. The l smallest hashes that two sets share lie among the first
   |A| - overlap + l of each; linked sets overlap in t |A| at least. So with l
   of LEAD_PERCENT percent of |A| (1 at least) documents with fewer than l
   hashes among their first |A| - ceil(t |A|) + l that any other class has
   among its own link with nothing. These hashes are shuffled once, packed
   (11 bytes for hash and node) and dealt over buckets by hash; a bucket
   returns the hashes that several nodes hold. Among the documents left every
   shared hash gives an edge from each holder to the smallest one; connected
   components of these edges are the groups within which all links lie.
3. Each document has a sketch, a bitmap of its hashes of 1 to 2 bits for each.
   The bits that one has and the other lacks bound their overlap from above.
   Pairs of a group whose sketches allow a link are connected; components of
   these edges are finer groups, within which all links lie, too. One shared
   passage or line joins many documents in step 2, but not here.
4. A group of at most TILE documents and BLOCK_SHINGLES shingles is one tile.
   A larger one is split by size bands (a band spans the ratio t, so links
   join the same or adjacent bands) and bands into blocks of about that size
   by a hash of the id; each pair of blocks of the same or adjacent bands is
   one tile. Step 3 uses such tiles, too, of SKETCHES times that size.
5. In a tile documents are ordered by size and compared within the size
   ratio only. The pairs that bitmaps leave are
   intersected exactly as sorted arrays. Pairs already connected within the
   tile are skipped, so a group of near copies takes about one comparison for
   each member, and a tile returns one edge for each linked document.
6. Components of these edges over all tiles.

Only texts of the finer groups travel, once by document to their group's tiles
(once for each block of the same and the adjacent bands where near copies alone
fill several tiles). A task holds at most two blocks. Within one large group
sketches of a band still meet pair by pair: this is quadratic in the documents
of a band of a group, not in the corpus; on disk that is a sketch (n / 8 to n / 4
bytes) for each block around, no text.

Null and empty texts have no set: n_shingles 0, linked with nothing, their
own component. A text with fewer words than the shingle is one shingle.
Rows with a null doc_id link with nothing and have a null component. Rows
that share a doc_id are one node of the links, each in its own class. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import components, cut, release
from martlet.llm.embedding_dedup import forest
from martlet.llm.texthash import batches, mix

SHINGLE = 3
PERCENT = 90
LEAD_PERCENT = 5
TILE = 4096
BLOCK_SHINGLES = 4 << 20
SKETCHES = 4  # sketches of a block, for each text of a block of texts
BUCKET_KEYS = 1 << 19
SENT_IDS = 500_000  # ids that are broadcast, at most
KEY_BYTES, NODE_BYTES = 5, 6  # of a hash within its bucket, of a digest
RULE = "spaces, A-Z lowered"
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingle_sets(texts: list[bytes | None], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    if width > len(_ODD):
        raise ValueError(f"shingles of at most {len(_ODD)} words")
    for _, counts, words in batches(texts, RULE):
        n = max(len(words) - width + 1, 0)
        grams = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            grams += words[k:k + n] * _ODD[k]
        grams = mix(grams)
        at = 0
        for c in counts.tolist():
            if c >= width:
                yield np.unique(grams[at:at + c - width + 1])
            elif c:
                short = np.full(1, c, dtype=np.uint64)
                for k in range(c):
                    short += words[at + k:at + k + 1] * _ODD[k]
                yield mix(short)
            else:
                yield words[:0]
            at += c


def lead(n: int) -> int:
    """Prefix hashes that linked sets of n or more hashes share at least."""
    return max(1, n * LEAD_PERCENT // 100)


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + lead(n))


def sketch(s: np.ndarray) -> bytes:
    """Bitmap of a set, of a power of two of bits: 64 at least, else over 1 and up to 2 for each hash."""
    bits = max(64, 1 << len(s).bit_length())
    out = np.zeros(bits, dtype=np.uint8)
    out[((s >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _profile(width: int, percent: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            sizes, digests, keys, sketches = [], [], [], []
            for s in shingle_sets(b.column(1).to_pylist(), width):
                sizes.append(len(s))
                # order-free digest of the set: sums of two mixes
                digests.append(int(mix(s ^ _ODD[0]).sum(dtype=np.uint64)).to_bytes(8, "little") + int(mix(s ^ _ODD[1]).sum(dtype=np.uint64)).to_bytes(8, "little"))
                keys.append(s[:prefix_length(len(s), percent)].view(np.int64) if len(s) else s.view(np.int64))
                sketches.append(sketch(s))
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "n": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.binary()),
                "node": pa.array([int.from_bytes(x[:NODE_BYTES], "little") for x in digests], pa.int64()),
                "keys": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)), "sketch": pa.array(sketches, pa.binary())})

    return run


def _deal(buckets: int):
    """(node, keys) -> for each batch an array of one string of bytes for each bucket: its hashes, each with its node."""
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            node, lists = np.asarray(b.column(0)), b.column(1)
            _, first = np.unique(node, return_index=True)  # of copies within a batch one is enough
            lists, node = lists.take(pa.array(np.sort(first))), node[np.sort(first)]
            size = np.asarray(lists.value_lengths()).astype(np.int64)
            x = mix(np.asarray(lists.flatten()).view(np.uint64) ^ _ODD[2])
            node = np.repeat(node, size)
            for at in range(0, len(x), 8 * BUCKET_KEYS):
                part, who = x[at:at + 8 * BUCKET_KEYS], node[at:at + 8 * BUCKET_KEYS]
                bucket = ((part >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order = np.argsort(bucket, kind="stable")
                raw = np.empty((len(part), KEY_BYTES + NODE_BYTES), dtype=np.uint8)
                raw[:, :KEY_BYTES] = part[order].view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
                raw[:, KEY_BYTES:] = who[order].view(np.uint8).reshape(-1, 8)[:, :NODE_BYTES]
                ends = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64)) * raw.shape[1]
                data = pa.Array.from_buffers(pa.binary(), buckets, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_pydict({"keys": pa.ListArray.from_arrays(pa.array([0, buckets], pa.int32()), data)})

    return run


def _shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The hashes of a bucket that several nodes hold, with each node once."""
    raw = np.frombuffer(b"".join(table.column("holders").to_pylist()), dtype=np.uint8).reshape(-1, KEY_BYTES + NODE_BYTES)
    wide = np.zeros((2, len(raw), 8), dtype=np.uint8)
    wide[0, :, :KEY_BYTES], wide[1, :, :NODE_BYTES] = raw[:, :KEY_BYTES], raw[:, KEY_BYTES:]
    hashes, node = wide.view(np.int64)[:, :, 0]
    order = np.lexsort((node, hashes))
    hashes, node = hashes[order], node[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (node[1:] != node[:-1])
    hashes, node = hashes[new], node[new]
    same = hashes[1:] == hashes[:-1]
    some = np.append(same, False) | np.append(False, same)
    return pa.table({"key": pa.array(hashes[some] | (key[0].as_py() << 8 * KEY_BYTES)), "node": pa.array(node[some])})


def sketch_roots(size: np.ndarray, sketches: list[bytes], side: np.ndarray, percent: int) -> np.ndarray:
    """A member for each component of the pairs whose sketches allow a link; only pairs of different sides count where side has both 0 and 1."""
    root = np.arange(len(size))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = np.argsort(size, kind="stable")
    cross = bool(side.any()) and not bool(side.all())
    parts = [order[side[order] == k] for k in (0, 1)] if cross else [order]
    for own, other in zip(parts, parts[::-1], strict=True):
        # partners: not smaller, and not larger than size / t
        lo = np.searchsorted(size[other], size[own], side="left") if cross else np.arange(1, len(own) + 1)
        hi = np.searchsorted(size[other], size[own] * 100 // percent, side="right")
        bits = np.where(lo < hi, [8 * len(sketches[i]) for i in own], 0)
        for level in np.unique(bits[bits > 0]).tolist():
            some = np.flatnonzero(bits == level)
            start, end = int(lo[some].min()), int(hi[some].max())
            maps = np.empty((end - start, level // 64), dtype=np.uint64)  # the larger sets' bitmaps folded
            for k, j in enumerate(other[start:end].tolist()):
                maps[k] = np.bitwise_or.reduce(np.frombuffer(sketches[j], dtype=np.uint64).reshape(-1, level // 64), axis=0)
            for k in some.tolist():
                i = int(own[k])
                at = int(lo[k]) + np.flatnonzero(root[other[lo[k]:hi[k]]] != find(i))  # not connected yet
                if not len(at):
                    continue
                mine, there, near = np.frombuffer(sketches[i], dtype=np.uint64), other[at], maps[at - start]
                total = size[i] + size[there]
                least = -(-percent * total // (100 + percent))
                ok = np.flatnonzero(size[i] - np.bitwise_count(mine & ~near).sum(axis=1, dtype=np.int64) >= least)
                if len(ok):
                    ok = ok[size[there[ok]] - np.bitwise_count(near[ok] & ~mine).sum(axis=1, dtype=np.int64) >= least[ok]]
                if len(ok):
                    roots = {find(j) for j in [i, *np.unique(root[there[ok]]).tolist()]}
                    root[list(roots)] = min(roots)
                    root[there[ok]] = min(roots)
    return np.array([find(i) for i in range(len(root))], dtype=np.int64)


def _near(percent: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node = np.asarray(table.column("node"))
        root = node[sketch_roots(np.asarray(table.column("n")), table.column("sketch").to_pylist(), np.asarray(table.column("side")), percent)]
        some = root != node
        return pa.table({"a": pa.array(node[some]), "b": pa.array(root[some])})

    return run


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of bits (packed into u64) for each set."""
    out = np.zeros((len(sets), bits // 64), dtype=np.uint64)
    for i, s in enumerate(sets):
        b = (s >> np.uint64(20)) & np.uint64(bits - 1)
        np.bitwise_or.at(out[i], (b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def tile_edges(sets: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """Smallest member of each set's group; only pairs of different sides are compared where side has both 0 and 1."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    root = np.arange(n)  # by place in order
    size, side, sets = size[order], side[order], [sets[i] for i in order]
    cross = bool(side.any()) and not bool(side.all())
    bits = 64
    maps = None

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        # partners: later in order and not larger than size / t
        last = int(np.searchsorted(size, size[i] * 100 // percent, side="right"))
        if last <= i + 1 or not size[i]:
            continue
        want = 1 << max(6, int(size[last - 1]).bit_length() - 1)  # about half to one bit for each hash
        if maps is None or want > bits:
            bits = want
            start = i
            upto = int(np.searchsorted(size, min(2 * bits, 1 << 62), side="left"))
            maps = bitmaps(sets[start:upto], bits)
            ones = np.bitwise_count(maps)
        # compare i with i + 1 .. last: hashes of i that j lacks, at least the bits of i that j lacks
        near = slice(i + 1 - start, last - start)
        lacks = np.bitwise_count(maps[i - start] & ~maps[near]).sum(axis=1, dtype=np.int64)
        total = size[i] + size[i + 1:last]
        least = -(-percent * total // (100 + percent))  # overlap needed: 100 o >= percent (total - o)
        ok = size[i] - lacks >= least
        extra = np.bitwise_count(maps[near] & ~maps[i - start]).sum(axis=1, dtype=np.int64) if ok.any() else lacks
        ok &= size[i + 1:last] - extra >= least
        if cross:
            ok &= side[i + 1:last] != side[i]
        for k in np.flatnonzero(ok).tolist():
            j = i + 1 + k
            a, b = find(i), find(j)
            if a != b:
                o = overlap(sets[i], sets[j])
                if 100 * o >= percent * (int(total[k]) - o):
                    root[max(a, b)] = min(a, b)
    out = np.empty(n, dtype=np.int64)
    for i in range(n):
        out[order[i]] = order[find(i)]
    return out


def _compare(width: int, percent: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rep = np.asarray(table.column("rep"))
        sets = list(shingle_sets(table.column("text").to_pylist(), width))
        root = rep[tile_edges(sets, np.asarray(table.column("side")), percent)]
        some = root != rep
        return pa.table({"a": pa.array(rep[some]), "b": pa.array(root[some])})

    return run


def _tiles(rows: DataFrame, key: str, percent: int, tile: int, shingles: int) -> DataFrame:
    """``rows (key, grp, n)`` -> (key, grp, b1, k1, b2, k2, side), once for each tile of its group that it goes to."""
    # a band is a hair wider than the ratio, so rounding cannot part linked sizes by two bands
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent) * (1 + 1e-9) + 1e-9)).cast("int")
    wanted = cut(rows.withColumn("band", band).groupBy(key, "grp", "band").agg(F.max("n").alias("n")))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(tile), F.sum("n") / F.lit(shingles))).cast("int")
    large = wanted.groupBy("grp").agg(parts.alias("parts")).where("parts > 1").select("grp")
    blocks = wanted.join(large, "grp", "left_semi").groupBy("grp", "band").agg(parts.alias("blocks"))
    blocks = cut(blocks)
    # tiles of a row: (band, block, other band, other block), the smaller first
    own = wanted.join(blocks, ["grp", "band"], "left")
    small = own.where("blocks is null").select(key, "grp", *[F.lit(0).alias(c) for c in ("b1", "k1", "b2", "k2", "side")]).distinct()
    own = own.where("blocks is not null").withColumn("block", F.pmod(F.xxhash64(key), "blocks").cast("int"))
    around = own.withColumn("to", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])))
    there = blocks.select(F.col("grp").alias("g"), F.col("band").alias("to_band"), F.col("blocks").alias("to_blocks"))
    around = around.join(there, (F.col("grp") == F.col("g")) & (F.col("to") == F.col("to_band")))
    around = around.withColumn("to_block", F.explode(F.sequence(F.lit(0), F.col("to_blocks") - 1)))
    mine, other = F.struct(F.col("band").alias("b"), F.col("block").alias("k")), F.struct(F.col("to_band").alias("b"), F.col("to_block").alias("k"))
    lo, hi = F.least(mine, other), F.greatest(mine, other)
    wide = around.select(key, "grp", lo["b"].alias("b1"), lo["k"].alias("k1"), hi["b"].alias("b2"), hi["k"].alias("k2"), (mine == hi).cast("int").alias("side"))
    return small.unionByName(wide)


def ngram_join(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, tile: int = TILE, shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``docs (doc_id, text)`` -> doc_id, n_shingles, class_id, component_id.

    class_id: smallest doc_id with an equal set; component_id: smallest
    doc_id reachable by links.
    """
    at = ("grp", "b1", "k1", "b2", "k2")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = cut(d.mapInArrow(_profile(width, percent), "doc_id long, n long, digest binary, node long, keys array<long>, sketch binary"))
    known = rows.where("n > 0 and doc_id is not null")
    classes = known.groupBy("n", "digest").agg(F.min("doc_id").alias("rep"))
    members = cut(rows.select("doc_id", "n", "digest").join(classes, ["n", "digest"], "left"))
    reps = known.join(classes, ["n", "digest"]).where("doc_id = rep").groupBy("rep", "n", "digest").agg(F.first("node").alias("node"), F.first("sketch").alias("sketch"))
    reps = cut(reps.drop("digest"))
    buckets = max(1, -(-(known.agg(F.sum(F.size("keys"))).first()[0] or 0) // BUCKET_KEYS))
    dealt = known.select("node", "keys").mapInArrow(_deal(buckets), "keys array<binary>").select(F.posexplode("keys").alias("bucket", "holders")).where("length(holders) > 0")
    held = cut(dealt.groupBy("bucket").applyInArrow(_shared, "key long, node long"))
    release(d.sparkSession, rows)
    # a partner has at least t n hashes, so it shares lead(t n) of them
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) * LEAD_PERCENT / 100))
    shared = held.groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    likely = cut(reps.join(shared, "node").where(F.col("shared") >= need).select("rep", "n", "node", "sketch"))
    held = cut(held.join(likely.select("node"), "node", "left_semi"))
    low = held.groupBy("key").agg(F.min("node").alias("low"))
    star = held.join(low, "key").select(F.col("low").alias("a"), F.col("node").alias("b"))
    groups = components(star).withColumnRenamed("component", "grp")

    tiles = _tiles(likely.join(groups, "node").select("node", "grp", "n"), "node", percent, SKETCHES * tile, SKETCHES * shingles)
    near = cut(tiles.join(likely.select("node", "n", "sketch"), "node").groupBy(*at).applyInArrow(_near(percent), "a long, b long"))
    finer = components(near).withColumnRenamed("component", "grp")
    release(d.sparkSession)

    wanted = cut(likely.join(finer, "node").select("rep", "grp", "n"))
    ids = wanted.select("rep").distinct()
    if ids.count() <= SENT_IDS:  # else all texts meet them in a shuffle
        d = d.join(F.broadcast(ids), F.col("doc_id") == F.col("rep"), "left_semi")
    sent = _tiles(wanted, "rep", percent, tile, shingles).join(d, F.col("rep") == F.col("doc_id"))
    found = cut(sent.select(*at, "side", "rep", "text").groupBy(*at).applyInArrow(_compare(width, percent), "a long, b long"))
    linked = components(found)
    release(d.sparkSession)
    out = members.join(linked, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("class_id"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` of which no linked document has a smaller id; all columns.

    Rows with the same id are one document, of which the smallest text
    stays; rows with a null id all stay.
    """
    names = docs.columns
    stay = ngram_join(docs, width, percent).where("doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    rest = F.struct(F.col("text"), *[F.col(c) for c in names if c not in ("doc_id", "text")])
    kept = (docs.join(stay, F.col("doc_id") == F.col("_stays"), "left_semi").groupBy("doc_id").agg(F.min(rest).alias("_rest"))
            .select(*[F.col("doc_id") if c == "doc_id" else F.col("_rest")[c].alias(c) for c in names]))
    return kept.unionByName(docs.where("doc_id is null"))


def oracle(docs: str = "documents", width: int = SHINGLE, percent: int = PERCENT) -> str:
    """DuckDB SQL for the query: shingles as text, overlaps by a join on every shingle, components by recursion."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with recursive n_rows as (select doc_id, list_filter(regexp_split_to_array({lower}, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from {docs}),
n_sets as (select doc_id, case when len(w) = 0 then [] when len(w) < {width} then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) end as s from n_rows),
n_class as (select min(doc_id) over (partition by list_sort(s)) as rep, doc_id, s, len(s) as n from n_sets),
n_rep as (select rep, any_value(n) as n, any_value(s) as s from n_class where n > 0 and doc_id = rep group by rep),
n_gram as (select rep, n, unnest(s) as g from n_rep),
n_link as (select a.rep as a, b.rep as b from n_gram a join n_gram b on a.g = b.g and a.rep < b.rep and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
           group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
n_both as (select a, b from n_link union all select b, a from n_link),
n_reach as (select rep as node, rep as c from n_rep union select n_both.b, n_reach.c from n_reach join n_both on n_reach.node = n_both.a),
n_comp as (select node, min(c) as c from n_reach group by node)
select doc_id, n as n_shingles, case when n = 0 then doc_id else c end as component_id
from n_class left join n_comp on n > 0 and rep = node"""
