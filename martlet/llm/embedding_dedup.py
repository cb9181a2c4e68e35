"""Near-duplicate vectors by int8 quantised tile products with error bounds.

Equal vectors are one class, found by grouping. The classes' vectors fall
into blocks of about TILE rows; each pair of blocks is one tile, handled in
one task from its two blocks alone. In a tile every unit vector u is
quantised as s * q with integers q from -127 to 127; with the length a of s * q
and the length e of what is lost, any two vectors satisfy
|u.v - s q.q' s'| <= a e' + e, since |u| = |v| = 1. The integer products are
exact in float32 while 127^2 * dimension < 2^24 (float64 beyond). Pairs whose
upper bound lies below the threshold are done; pairs whose lower bound lies
above it link; the others are computed in double precision from the original
components. Every vector is first scaled by the power of two that brings its
largest component between 1/2 and 1: exact, without effect on a cosine, and no
length overflows or vanishes whatever the size of the components.

A tile returns, for each vector with links, their number and one edge to
the root of its group in the tile, not the pairs, so a group of n near
copies gives a few rows for each vector and tile. All pairs of blocks are
tiles: this exact all-pairs method is quadratic in the number of different
vectors, whatever the groups; tasks and memory stay bounded.

Null, zero and non-finite vectors and vectors with null components link with
nothing. Vectors of different dimension do not link. Rows with the same id
count once (of differing vectors the smallest array). Rows with a null id
are returned with no links, null component and kept true. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import components, cut

THRESHOLD = 0.95
TILE = 4096
_ROWS = 1024


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of n nodes reaches over the edges a[i] - b[i]."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while (jump := new[new]).tolist() != new.tolist():
            new = jump
        if (new == label).all():
            return new
        label = new


def scaled(x: np.ndarray) -> np.ndarray:
    """Row vectors, none of them zero, by powers of two with the largest component between 1/2 and 1."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -exponent[:, None])


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, length of s * q, length of the error) of unit row vectors; lengths rounded up."""
    s = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / s[:, None])
    back = q * s[:, None]
    up = 1 + 1e-9
    return q.astype(np.int8), s, np.linalg.norm(back, axis=1) * up, np.linalg.norm(unit - back, axis=1) * up + 1e-12


def links(x: np.ndarray, y: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows of x, rows of y) with cosine >= threshold in double precision; y None: pairs i < j of x."""
    own = y is None
    unit_x = x / np.linalg.norm(x, axis=1)[:, None]
    qx, sx, ax, ex = quantise(unit_x)
    unit_y, (qy, sy, ay, ey) = (unit_x, (qx, sx, ax, ex)) if own else ((u := y / np.linalg.norm(y, axis=1)[:, None]), quantise(u))
    exact = np.float32 if 127 * 127 * x.shape[1] < 1 << 24 else np.float64
    right = qy.astype(exact).T.copy()
    out_a, out_b = [], []
    # over all columns: error <= ax * ey + ex <= ax * max(ey) + ex, so one comparison a row finds the few that matter
    worst = ey.max(initial=0)
    assert np.isfinite(worst) and np.isfinite(ex).all() and np.isfinite(sx).all() and np.isfinite(sy).all()
    for i in range(0, len(x), _ROWS):
        rows = slice(i, min(i + _ROWS, len(x)))
        product = qx[rows].astype(exact) @ right
        floor = (threshold - 1e-9 - ax[rows] * worst - ex[rows]) / sx[rows]
        product *= sy.astype(exact)
        a, b = np.nonzero(product >= (floor * (1 - 1e-5 * np.sign(floor)))[:, None].astype(exact))
        value = product[a, b].astype(np.float64)
        a = a + i
        if own:
            value, a, b = value[a < b], a[a < b], b[a < b]
        error = ax[a] * ey[b] + ex[a] + 1e-5
        value *= sx[a]
        sure = value - error >= threshold
        maybe = ~sure & (value + error >= threshold)
        ok = sure
        for j in np.array_split(np.flatnonzero(maybe), max(1, int(maybe.sum()) // 65536)):
            # the contract's cosine: dot product by the product of lengths, in double precision
            u, v = x[a[j]], (x if own else y)[b[j]]
            cosine = np.einsum("ij,ij->i", u, v) / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v))
            ok[j] = cosine >= threshold
        out_a.append(a[ok])
        out_b.append(b[ok])
    return np.concatenate(out_a) if out_a else np.zeros(0, int), np.concatenate(out_b) if out_b else np.zeros(0, int)


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return scaled(np.asarray(column.flatten().cast(pa.float64())).reshape(table.num_rows, -1))


def _tile(threshold: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        block = np.asarray(table.column("block"))
        order = np.argsort(block != i, kind="stable")
        table = table.take(pa.array(order))
        left = int((block == i).sum())
        rep, copies = np.asarray(table.column("rep")), np.asarray(table.column("copies"))
        x = _matrix(table)
        if i == j:
            a, b = links(x, None, threshold)
        elif left and left < len(x):
            a, b = links(x[:left], x[left:], threshold)
            b = b + left
        else:
            a = b = np.zeros(0, int)
        n = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
        root = forest(len(rep), a, b)
        some = np.flatnonzero(n)
        return pa.table({"rep": pa.array(rep[some]), "n": pa.array(n[some].astype(np.int64)), "root": pa.array(rep[root[some]])})

    return run


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``vectors (vec_id, embedding)`` -> vec_id, n_links, component_id, kept."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    ids = v.where("vec_id is not null").groupBy("vec_id").agg(F.min("v").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    good = F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    ids = cut(ids.select("vec_id", F.when(good, F.transform("v", lambda x: x + 0.0)).alias("v")))
    classes = ids.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = cut(classes.withColumn("dim", F.size("v")))
    n = classes.count()
    blocks = max(1, -(-n // tile))
    put = classes.withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))
    pair = put.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pair = pair.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    found = cut(pair.select("i", "j", "dim", "block", "rep", "copies", "v").repartition("i", "j").groupBy("i", "j", "dim")
                .applyInArrow(_tile(threshold), "rep long, n long, root long"))
    total = found.groupBy("rep").agg(F.sum("n").alias("n"))
    group = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per = (classes.drop("dim").join(total, "rep", "left").join(group, F.col("rep") == F.col("node"), "left")
           .select(F.col("v").alias("w"), F.coalesce("component", "rep").alias("component_id"),
                   (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = ids.join(per, F.col("v") == F.col("w"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    none = v.where("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
