"""Sharding by a hierarchical weighted hash tree.

Shards hang below racks and racks below regions; a node weighs what its
shards weigh together. A row descends from the root: at every node each
child draws -ln(u) / weight with u from a hash of the row's key and the
child's own name, and the least draw wins. A child wins in proportion to
its weight, and its draw depends on nothing but the key, its name and its
weight. So if a shard's weight changes, only the draws on its own path
change: rows move into (or out of) the region whose weight changed, within
that region into its rack, within that rack into the shard, and no row
moves between two children whose weights stayed.

A further shard opens a region of its own (``grown``): no old node's
weight changes, so the rows it takes are the only ones that move, however
many shards follow one another. Shards can also be added to an existing
rack by naming them in the tree; then rows move within that subtree too.

Law ``key``: the doc_id and the tree decide, nothing else. Equal texts with
different ids lie where their ids lead. Rows that share a doc_id, and rows
with a null one, lie in one shard. Within a shard, rows are numbered by
doc_id (null first), then CRC and size of the text; the numbers come from a
range partitioning on (shard, doc_id), so a shard spans as many tasks as
its rows need. Null and empty texts have 8 bytes; other columns are kept by
``assign`` and ``save`` and must not be named like the new ones, or they
are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import cut, let
from martlet.operators.sequence import sequence_within
from martlet.sources.tables import save_partitioned

ROW_BYTES = 8
REGIONS, RACKS, SHARDS = 3, 2, 4
_BITS = 13 * 4  # of a draw: 13 hex digits


@dataclass(frozen=True)
class Leaf:
    """One shard and its place; ids of racks and shards are unique in the whole tree."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def balanced(regions: int = REGIONS, racks: int = RACKS, shards: int = SHARDS) -> list[Leaf]:
    """A tree of equal shards: ``racks`` in each region, ``shards`` in each rack."""
    return [Leaf(s // (racks * shards), s // shards, s) for s in range(regions * racks * shards)]


def grown(tree: list[Leaf], more: int = 1) -> list[Leaf]:
    """The tree with ``more`` shards, each in a region and a rack of its own."""
    region, rack, shard = (1 + max((getattr(x, part) for x in tree), default=-1) for part in ("region", "rack", "shard"))
    return [*tree, *(Leaf(region + i, rack + i, shard + i) for i in range(more))]


def _children(tree: list[Leaf]) -> list[list[list[tuple[int, float]]]]:
    """For each level, by number of the parent: (number, weight) of its children."""
    levels = []
    for up, down in ((None, "region"), ("region", "rack"), ("rack", "shard")):
        below: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
        for x in tree:
            if x.weight > 0:
                below[getattr(x, up) if up else 0][getattr(x, down)] += x.weight
        levels.append([sorted(below[i].items()) for i in range(max(below, default=-1) + 1)])
    return levels


def _draw(key: Column, level: str):
    """Child -> struct(its draw, its number)."""
    def draw(c: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws("/", key, F.lit(level), c["id"].cast("string"))), 1, _BITS // 4)
        u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << _BITS))
        return F.struct((-F.log(u) / c["w"]).alias("draw"), c["id"].alias("id"))

    return draw


def place(key: Column, tree: list[Leaf]) -> Column:
    """struct(region, rack, shard) that the key descends to."""
    if not any(x.weight > 0 for x in tree):
        raise ValueError("no shard with a weight above 0")
    regions, racks, shards_ = (F.array(*[F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w")) for i, w in kids]) for kids in nodes])
                               for nodes in _children(tree))

    def least(kids: Column, level: str) -> Column:
        return F.array_min(F.transform(kids, _draw(key, level)))["id"]

    def below(region: Column) -> Column:
        return let(least(F.get(racks, region), "rack"),
                   lambda rack: F.struct(region.alias("region"), rack.alias("rack"), least(F.get(shards_, rack), "shard").alias("shard")))

    return let(least(regions[0], "region"), below)


def assign(docs: DataFrame, tree: list[Leaf] | None = None, more: int = 1, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with size, text_crc32, region, rack, shard and grown_shard; nothing is shuffled.

    grown_shard: where the row lies after ``more`` further shards.
    """
    tree = balanced() if tree is None else tree
    text, key = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    new = docs.withColumns({"size": (F.octet_length(text) + ROW_BYTES).cast("long"), "text_crc32": F.crc32(text.cast("binary")),
                            "_at": place(key, tree), "grown_shard": place(key, grown(tree, more))["shard"]})
    return new.withColumns({c: F.col("_at")[c] for c in ("region", "rack", "shard")}).drop("_at")


def shards(docs: DataFrame, tree: list[Leaf] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack of each row of ``docs (doc_id, text)``; texts stay behind."""
    # written once: the range partitioning would read all texts a second time for its sample
    rows = cut(assign(docs.select("doc_id", "text"), tree).drop("text"))
    numbered = sequence_within(rows, ["shard"], ["doc_id", "text_crc32", "size"], out="slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("slot") - 1).cast("long").alias("slot"),
                           "grown_shard", "region", "rack")


def save(docs: DataFrame, folder: str, tree: list[Leaf] | None = None) -> DataFrame:
    """Write whole rows as Parquet, one folder a shard, sorted by doc_id; a large shard has many files. Returns what was written."""
    return save_partitioned(assign(docs, tree).drop("grown_shard"), folder, "shard", ["doc_id"])


def _oracle_place(tree: list[Leaf]) -> tuple[str, str]:
    """(rows of the tree, the descent) as SQL over a table keys (k)."""
    rows = ", ".join(f"({x.region}, {x.rack}, {x.shard}, {x.weight}::double)" for x in tree)
    u = "((('0x' || substr(md5(k || '/{0}/' || {0}), 1, 13))::bigint + 0.5::double) / 4503599627370496::double)"
    draw = "row_number() over (partition by k order by -ln(" + u + ") / sum(w))"
    descent = f"""
    (with step1 as (select k, region, {draw.format('region')} as o from keys, t group by k, region),
     step2 as (select k, region, rack, {draw.format('rack')} as o from step1 join t using (region) where o = 1 group by k, region, rack),
     step3 as (select k, region, rack, shard, {draw.format('shard')} as o from step2 join t using (region, rack) where o = 1 group by k, region, rack, shard)
     select k, region, rack, shard from step3 where o = 1)"""
    return f"(values {rows}) v(region, rack, shard, w)", descent


def oracle(docs: str = "documents", tree: list[Leaf] | None = None) -> str:
    """DuckDB SQL for the query: draws by joins and window ranks, the CRC byte by byte."""
    tree = balanced() if tree is None else tree
    (old, descent), (new, _) = _oracle_place(tree), _oracle_place(grown(tree))
    return f"""
with crc as (select list(c order by i) as by_byte from (select i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i)) z),
n_rows as (select doc_id, coalesce(cast(doc_id as varchar), '') as k, octet_length(encode(coalesce(text, ''))) + {ROW_BYTES} as size,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::bigint)),
        lambda c, b: xor(c >> 8, by_byte[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32 from {docs}, crc),
keys as (select distinct k from n_rows),
now as (with t as (select * from {old}) select * from {descent} d),
then_ as (with t as (select * from {new}) select k, shard as grown_shard from {descent} d)
select doc_id, size, text_crc32, 'key' as law, shard, row_number() over (partition by shard order by doc_id nulls first, text_crc32, size) - 1 as slot,
    grown_shard, region, rack from n_rows join now using (k) join then_ using (k)"""
