"""Ranked lexical search by branch and bound over a tree of documents' term vectors.

1. Items (the query set) are taken in blocks of about BLOCK_BYTES of text;
   a block's terms are the vocabulary that is broadcast.
2. One pass over all texts counts documents, terms and, for each term of the
   vocabulary, the documents that hold it.
3. A second pass keeps of every document its vector of vocabulary terms (with
   tf), the most frequent term first, and its m. A task joins the vectors
   of TREE_DOCS documents to an FP-tree: vectors share the path of their
   common beginning. Paths without branches are one edge, so nodes are the
   branching points; each keeps the greatest tf of every term in its
   subtree and the least m there.
4. A node's score with these maxima and this minimum bounds what any
   document below it can reach, for each item. The search goes depth first,
   children with the highest bounds first, down with the items whose bound
   still reaches their k-th best score so far; a document's own vector gives
   its exact score. The best k are kept from tree to tree of a task.
5. Tasks return at most k rows for each item; the best k of all are ranked
   in two steps (slices of documents, then the item).

Nothing of the corpus is shuffled but these candidates. A task holds one
tree (TREE_DOCS documents, or TREE_TERMS vector entries), whatever the
length of the texts or the number of copies; copies share one path.

Scores are integers: no document is left out by rounding of a bound, since
the bound is the same integer formula at the maxima and the minimum.

Terms are the stretches of ASCII letters and digits and of any other
characters from U+0080, A-Z lowered. Null and empty texts have none: such a
document has no score, such an item no row. Rows that share an item_id are
one item with the terms of all of them, the rows with a null one too; rows
that share a doc_id are documents of their own. Equal scores rank by
doc_id, null last. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEST = 50
BLOCK_BYTES = 4 << 20
TREE_DOCS = 4096
TREE_TERMS = 1 << 20
SLICES = 32

_fold = bytearray(range(256))
for _b in range(128):
    _fold[_b] = ord(chr(_b).lower()) if chr(_b).isalnum() else 32
_FOLD = bytes(_fold)


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text, with repeats."""
    return text.translate(_FOLD).split() if text else []


@dataclass
class Items:
    """A block of items: their ids, and for each term (most frequent first) its weight and the items that hold it."""

    ids: list[int | None]
    number: dict[bytes, int]  # term -> its place by document frequency
    weight: np.ndarray
    at: np.ndarray  # term t's items are held[at[t]:at[t + 1]]
    held: np.ndarray
    documents: int
    words: int

    @classmethod
    def of(cls, wanted: dict[int | None, set[bytes]], df: dict[bytes, int], documents: int, words: int) -> Items:
        order = sorted(df, key=lambda t: (-df[t], t))
        number = {t: i for i, t in enumerate(order)}
        holders: list[list[int]] = [[] for _ in order]
        for k, ts in enumerate(wanted.values()):
            for t in ts:
                if t in number:
                    holders[number[t]].append(k)
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) for t in order]
        return cls(list(wanted), number, np.array(weight, dtype=np.int64), np.cumsum([0, *map(len, holders)]),
                   np.array([k for h in holders for k in h], dtype=np.int64), documents, words)

    def length_norm(self, n: int) -> int:
        """A document's m."""
        return 100 - 50 + (50 * n * self.documents) // self.words

    def scores(self, term: np.ndarray, tf: np.ndarray, m: int) -> np.ndarray:
        """Each item's score of a vector; exact, as sums stay below 2**53."""
        value = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        many = self.at[term + 1] - self.at[term]
        upto = np.cumsum(many)
        if not len(upto) or not upto[-1]:
            return np.zeros(len(self.ids), dtype=np.int64)
        flat = np.arange(upto[-1]) + np.repeat(self.at[term] - upto + many, many)
        return np.bincount(self.held[flat], weights=np.repeat(value, many), minlength=len(self.ids)).astype(np.int64)


@dataclass
class Node:
    """A subtree: the greatest tf of its terms and the least m; rows of one document, or children."""

    term: np.ndarray
    tf: np.ndarray
    m: int
    doc: int | None
    children: list[Node]


def _merged(children: list[Node]) -> Node:
    term = np.concatenate([c.term for c in children])
    order = np.argsort(term, kind="stable")
    term = term[order]
    first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
    tf = np.maximum.reduceat(np.concatenate([c.tf for c in children])[order], first)
    return Node(term[first], tf, min(c.m for c in children), None, children)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    return int(differs[0]) if len(differs) else n


def term_tree(vectors: list[tuple[np.ndarray, np.ndarray, int]]) -> Node:
    """The tree of some vectors (terms ascending, their tf, m); a node's documents share its path.

    Sorted vectors are inserted one after another; ``path`` holds the open
    nodes from the root down: (length of the path, children so far).
    """
    order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0].astype(">u4").tobytes(), vectors[i][2]))
    path: list[tuple[int, list[Node]]] = [(0, [])]
    last = None
    for i in order:
        term, tf, m = vectors[i]
        depth = 0 if last is None else _shared(last, term)
        while path[-1][0] > depth:  # close what the new path leaves
            length, done = path.pop()
            node = done[0] if len(done) == 1 else _merged(done)
            if path[-1][0] < depth:
                path.append((depth, [node]))
            else:
                path[-1][1].append(node)
        if path[-1][0] < depth:  # the last document's edge is parted here
            path.append((depth, [path[-1][1].pop()]))
        path[-1][1].append(Node(term, tf, m, i, []))
        last = term
    while len(path) > 1:
        _, done = path.pop()
        path[-1][1].append(done[0] if len(done) == 1 else _merged(done))
    return _merged(path[0][1])


class Search:
    """The best documents of each item so far, over one tree after another."""

    def __init__(self, items: Items, best: int):
        self.items, self.best = items, best
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in items.ids]  # the worst first: least score, null, largest doc_id
        self.floor = np.ones(len(items.ids), dtype=np.int64)  # the least score that can still count
        self.visited = 0

    def tree(self, root: Node, ids: list[int | None]) -> None:
        open_ = [(root, self.items.scores(root.term, root.tf, root.m), np.arange(len(self.items.ids)))]
        while open_:
            node, bound, alive = open_.pop()
            alive = alive[bound[alive] >= self.floor[alive]]
            if not len(alive):
                continue
            self.visited += 1
            if node.doc is not None:  # its bound is its score
                self.add(ids[node.doc], bound, alive)
                continue
            below = [(c, self.items.scores(c.term, c.tf, c.m), alive) for c in node.children]
            below.sort(key=lambda x: int((x[1][alive] - self.floor[alive]).max()))
            open_.extend(below)  # the last is taken first

    def add(self, doc_id: int | None, score: np.ndarray, alive: np.ndarray) -> None:
        for k in alive.tolist():
            heap, entry = self.heaps[k], (int(score[k]), doc_id is not None, -(doc_id or 0))
            if len(heap) < self.best:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.best:
                self.floor[k] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        found = [(i, -key if known else None, score) for i, heap in zip(self.items.ids, self.heaps, strict=True) for score, known, key in heap]
        return pa.RecordBatch.from_pydict({"item_id": pa.array([r[0] for r in found], pa.int64()),
                                           "doc_id": pa.array([r[1] for r in found], pa.int64()),
                                           "score": pa.array([r[2] for r in found], pa.int64())})


def _counts(vocabulary) -> object:
    """Documents with a term, terms, and for each vocabulary term its documents: one row for each of them in a task."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = vocabulary.value
        df = dict.fromkeys(wanted, 0)
        documents = words = 0
        for b in frames:
            for text in b.column(0).to_pylist():
                t = terms(text)
                documents += bool(t)
                words += len(t)
                for x in wanted.intersection(t):
                    df[x] += 1
        some = [(t, n) for t, n in df.items() if n]
        yield pa.RecordBatch.from_pydict({"term": pa.array([None, *(t for t, _ in some)], pa.binary()), "n": pa.array([documents, *(n for _, n in some)], pa.int64()),
                                          "words": pa.array([words, *(0 for _ in some)], pa.int64())})

    return run


def _search(sent, best: int, tree_docs: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = sent.value
        search = Search(items, best)
        vectors, ids, held = [], [], 0
        for b in frames:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = terms(text)
                known = [k for k in map(items.number.get, t) if k is not None]
                if not known:
                    continue
                term, tf = np.unique(np.array(known, dtype=np.int64), return_counts=True)
                vectors.append((term, tf.astype(np.int64), items.length_norm(len(t))))
                ids.append(doc_id)
                held += len(term)
                if len(vectors) >= tree_docs or held >= TREE_TERMS:
                    search.tree(term_tree(vectors), ids)
                    vectors, ids, held = [], [], 0
        if vectors:
            search.tree(term_tree(vectors), ids)
        yield search.rows()

    return run


def _best(found: DataFrame, best: int) -> DataFrame:
    """Rank within each item; a hot item is ranked by slices of its documents first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    sliced = found.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    near = (sliced.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "slice").orderBy(*order))).where(F.col("rank") <= best).drop("rank", "slice"))
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= best)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[dict[int | None, set[bytes]]]:
    """The items' term sets, in blocks of about so many bytes of text; rows of one id come together."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else rows
        wanted: dict[int | None, set[bytes]] = {}
        for r in part.toLocalIterator():
            wanted.setdefault(r.item_id, set()).update(terms(bytes(r.text) if r.text is not None else None))
        yield wanted


def term_search(docs: DataFrame, items: DataFrame, best: int = BEST, tree_docs: int = TREE_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of ``docs (doc_id, text)`` for each of ``items (item_id, text)``."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for wanted in _blocks(items, block_bytes):
        vocabulary = spark.sparkContext.broadcast(frozenset().union(*wanted.values()))
        counted = d.select("text").mapInArrow(_counts(vocabulary), "term binary, n long, words long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
        df, documents, words = {}, 0, 0
        for r in counted.collect():  # one row for each term of the block
            if r.term is None:
                documents, words = r.n, r.words
            else:
                df[bytes(r.term)] = r.n
        if df:
            sent = spark.sparkContext.broadcast(Items.of(wanted, df, documents, words))
            found = found.unionByName(d.mapInArrow(_search(sent, best, tree_docs), "item_id long, doc_id long, score long"))
    return _best(found, best).select("item_id", "rank", "doc_id", "score")


def oracle(docs: str = "documents", items: str = "benchmark", best: int = BEST) -> str:
    """DuckDB SQL for the query: every document's score for every item by a join on terms."""
    found = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
    return f"""
with n_docs as (select row_number() over () as r, doc_id, {found} as w from {docs}),
n_all as (select count(*) as nn, sum(len(w)) as ll from n_docs where len(w) > 0),
n_item as (select distinct item_id, unnest({found}) as t from {items}),
n_tf as (select r, doc_id, len(w) as n, t, count(*) as tf from (select r, doc_id, w, unnest(w) as t from n_docs) u group by r, doc_id, len(w), t),
n_df as (select t, count(*) as df from n_tf group by t),
n_weight as (select t, cast(floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1))) as bigint) as w from n_df, n_all),
n_part as (select r, doc_id, t, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)) as f from n_tf, n_all),
n_score as (select item_id, r, doc_id, cast(sum(w * f) as bigint) as score from n_item join n_weight using (t) join n_part using (t) group by item_id, r, doc_id),
n_rank as (select item_id, row_number() over (partition by item_id order by score desc, doc_id asc nulls last) as rank, doc_id, score from n_score where score > 0)
select item_id, rank, doc_id, score from n_rank where rank <= {best}"""
