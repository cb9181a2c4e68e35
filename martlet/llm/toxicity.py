"""Toxicity by a convolutional text classifier, trained in numpy.

Words are runs of letters and digits (bytes over 127 count as letters), A-Z
lowered. A word's embedding is the sum of the rows of two hash tables of
BUCKETS rows, so two words share it only if both hashes meet. For each filter
width in WIDTHS, FILTERS filters slide over the whole text; the largest value
of each, rectified, goes into a logistic layer. Texts are scored whole, in
pieces that overlap by the widest filter.

Training takes every labelled document, whole, whose crc32 of the id as text is
not 0 modulo 5; those with remainder 1 calibrate, the others are learnt from.
Their words are stored once, in parts of about PART_ROWS documents. In a round
each task learns one epoch (Adam, Adagrad for the tables) from its own part,
starting from the round's model, and the parameters and moments are averaged by
Spark, weighted by documents; a row of a table only over the parts that met it.
One part alone learns all epochs in one task. The driver holds the model and
its moments (about 17 MB whatever the corpus), never a text. For each language
the threshold of best F1 moves its logits so that 0.5 decides; it is read off
counts of all calibrating documents by logit, in steps of 1 / STEPS_A_LOGIT.
The language is guessed from the text itself (letters and frequent words in
FIXED values below), since lang, source, ids and labels are no inputs of a score.

Null and empty texts get the score of a text without features. Labelled ids
that repeat count once (highest label); null labels and ids are not learnt
from. Without labels of both classes every score is the prior (0.5 rows
without any label). Rows with a null id are scored, held_out false. Other
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import shared_folder
from martlet.llm.texthash import batches

BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
#: What one task learns from in a round: about so many documents, and no more words than this but for one longer document.
PART_ROWS = 8000
PART_WORDS = 1 << 23
EPOCHS = 6
MIN_STEPS = 1200
BATCH = 16
STEPS_A_LOGIT = 1024
RULE = "letters and digits, A-Z lowered"
#: Frequent words that tell the languages apart.
FREQUENT = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "be"),
    "de": ("der", "die", "und", "das", "ist", "nicht", "von", "den", "mit", "zu", "ein", "für"),
    "fr": ("le", "les", "et", "des", "est", "un", "une", "du", "que", "qui", "dans", "pour"),
    "es": ("el", "los", "y", "que", "en", "una", "las", "del", "por", "con", "para", "no"),
}
LANGUAGES = tuple(FREQUENT)


def _word_hashes(words: tuple[str, ...]) -> np.ndarray:
    return np.concatenate([h for _, _, h in batches([w.encode() for w in words], RULE)])


def language(words: np.ndarray) -> int:
    """Index in LANGUAGES of the language with most frequent words in the text; the first one of equals."""
    if not _marks:
        _marks.extend(np.sort(_word_hashes(FREQUENT[x])) for x in LANGUAGES)
    return int(np.argmax([np.isin(words, m).sum() for m in _marks]))


_marks: list[np.ndarray] = []


class Cnn:
    """The classifier's arrays and their gradients' Adam state."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        self.table = (r.standard_normal((2, BUCKETS, DIM)) * 0.02).astype(np.float32)
        self.filters = [(r.standard_normal((k, DIM, FILTERS)) * 0.3).astype(np.float32) for k in WIDTHS]
        self.dense = (r.standard_normal(len(WIDTHS) * FILTERS) * 0.3 + 0.5).astype(np.float32)
        self.bias = np.zeros(1, dtype=np.float32)
        self.shift = np.zeros(len(LANGUAGES))
        self.first = [np.zeros_like(p) for p in self.dense_parts()]
        self.second = [np.zeros_like(p) for p in (*self.table, *self.dense_parts())]
        self.step = 0

    def dense_parts(self) -> list[np.ndarray]:
        return [*self.filters, self.dense, self.bias]

    def without_moments(self) -> Cnn:
        """The model as it scores."""
        self.first, self.second = [], []
        return self

    def embed(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one = (words & np.uint64(BUCKETS - 1)).astype(np.int64)
        two = ((words >> np.uint64(32)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        return one, two, self.table[0][one] + self.table[1][two]

    def features(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest value of each filter, where) over the embedded words of one text."""
        best, at = [], []
        for w in self.filters:
            k = len(w)
            if len(x) < k:
                best.append(np.zeros(FILTERS, dtype=np.float32))
                at.append(np.full(FILTERS, -1))
                continue
            n = len(x) - k + 1
            v = sum(x[o:o + n] @ w[o] for o in range(k))
            i = v.argmax(axis=0)
            best.append(v[i, np.arange(FILTERS)])
            at.append(i)
        return np.concatenate(best), np.concatenate(at)

    def peaks(self, words: np.ndarray, piece: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """``features`` of a whole text, in pieces that overlap by the widest filter."""
        step = piece - max(WIDTHS) + 1
        best = at = None
        for a in range(0, max(len(words) - max(WIDTHS) + 1, 1), step):
            f, p = self.features(self.embed(words[a:a + piece])[2])
            p = np.where(p < 0, p, p + a)
            best, at = (f, p) if best is None else (np.maximum(best, f), np.where(f > best, p, at))
        return best, at

    def logit(self, words: np.ndarray, piece: int = 1 << 18) -> float:
        return float(np.maximum(self.peaks(words, piece)[0], 0) @ self.dense + self.bias[0])

    def score(self, words: np.ndarray) -> float:
        z = self.logit(words) + self.shift[language(words)]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def train(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int, rare: float, seed=2) -> None:
        """Epochs over these texts from the model and moments as they are; rare: weight of a toxic one."""
        r = np.random.default_rng(seed)
        params = [*self.table, *self.dense_parts()]
        second, batch = self.second, BATCH
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for a in range(0, len(order), batch):
                grads = [np.zeros_like(p) for p in params[2:]]
                rows: dict = {0: [], 1: []}
                for i in order[a:a + batch]:
                    f, at = self.peaks(texts[i])
                    # the words under each filter at its largest value
                    met = np.minimum(at[:, None] + np.arange(max(WIDTHS)), len(texts[i]) - 1)
                    one, two, x = self.embed(texts[i][met]) if len(texts[i]) else (None, None, None)
                    z = float(np.maximum(f, 0) @ self.dense + self.bias[0])
                    d = (1 / (1 + np.exp(-z)) - labels[i]) * (rare if labels[i] else 1.0) / batch
                    grads[-2] += d * np.maximum(f, 0)
                    grads[-1] += d
                    back = d * self.dense * (f > 0)
                    for j, w in enumerate(self.filters):
                        for c in range(FILTERS):
                            m = j * FILTERS + c
                            g = back[m]
                            if at[m] < 0 or g == 0:
                                continue
                            grads[j][:, :, c] += g * x[m, :len(w)]
                            for o in range(len(w)):
                                rows[0].append((one[m, o], g * w[o, :, c]))
                                rows[1].append((two[m, o], g * w[o, :, c]))
                self.step += 1
                for j, g in enumerate(grads, start=2):
                    first = self.first[j - 2] = 0.9 * self.first[j - 2] + 0.1 * g
                    second[j] = 0.999 * second[j] + 0.001 * g * g
                    params[j] -= 0.01 * (first / (1 - 0.9**self.step)) / (np.sqrt(second[j] / (1 - 0.999**self.step)) + 1e-6)
                for t in (0, 1):  # the tables: Adagrad on the rows met
                    if rows[t]:
                        at, inverse = np.unique([x for x, _ in rows[t]], return_inverse=True)
                        g = np.zeros((len(at), DIM), dtype=np.float32)
                        np.add.at(g, inverse, np.stack([v for _, v in rows[t]]))
                        second[t][at] += g * g
                        params[t][at] -= 0.1 * g / (np.sqrt(second[t][at]) + 1e-3)

    def numbers(self) -> np.ndarray:
        """Parameter, first and second moment of everything but the tables, a row for each."""
        return np.stack([np.concatenate([np.ravel(x) for x in xs]) for xs in (self.dense_parts(), self.first, self.second[2:])], axis=1)

    def set_numbers(self, at: np.ndarray, values: np.ndarray) -> None:
        flat = self.numbers()
        flat[at] = values
        for xs, column in ((self.dense_parts(), flat[:, 0]), (self.first, flat[:, 1]), (self.second[2:], flat[:, 2])):
            a = 0
            for x in xs:
                x[...] = column[a:a + x.size].reshape(x.shape)
                a += x.size

    def calibrate(self, lang: np.ndarray, step: np.ndarray, low: np.ndarray, high: np.ndarray, hits: np.ndarray, n: np.ndarray) -> None:
        """For each language the shift that puts its threshold of best F1 at 0; the overall one where few are
        labelled. Of the documents of a language and a step of logits: lowest and highest logit, toxic ones, number."""

        def threshold(mine: np.ndarray) -> float:
            steps, at = np.unique(-step[mine], return_inverse=True)
            lows, highs = np.full(len(steps), np.inf), np.full(len(steps), -np.inf)
            np.minimum.at(lows, at, low[mine])
            np.maximum.at(highs, at, high[mine])
            toxic, rows = np.bincount(at, hits[mine]), np.bincount(at, n[mine])
            k = int(np.argmax(2 * np.cumsum(toxic) / (np.cumsum(rows) + toxic.sum())))
            below = highs[k + 1] if k + 1 < len(steps) else lows[k] - 1.0
            return float(lows[k] + below) / 2

        if not 0 < hits.sum() < n.sum():
            return
        self.shift[:] = -threshold(np.ones(len(lang), dtype=bool))
        for i in range(len(LANGUAGES)):
            mine = lang == i
            if hits[mine].sum() >= 5:
                self.shift[i] = -threshold(mine)


def stored_parts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, id, toxic, fold, words of every labelled document outside the held-out fold, written once to the shared folder."""
    fold = F.crc32(F.col("id").cast("string")) % 5
    known = (labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg((F.max("toxic") > 0).cast("int").alias("toxic")).withColumn("fold", fold).where("fold <> 0"))

    def hashed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, rows = TaskContext.get().partitionId() << 32, 0, 0
        for b in frames:
            ids, parts = [], []
            for _, counts, h in batches(b.column(3).to_pylist(), RULE):
                ids += np.split(h.view(np.int64), np.cumsum(counts)[:-1])
            for x in ids:
                if rows and (held + len(x) > PART_WORDS or 2 * rows >= 3 * PART_ROWS):
                    part, held, rows = part + 1, 0, 0
                held, rows = held + len(x), rows + 1
                parts.append(part)
            yield pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.int64()), "id": b.column(0), "toxic": b.column(1),
                                              "fold": b.column(2), "words": pa.array(ids, pa.list_(pa.int64()))})

    path = f"{shared_folder(docs.sparkSession).rstrip('/')}/toxicity-{uuid.uuid4().hex}"
    (docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text")).where(fold != 0)
     .join(known, "id").groupBy("id", "toxic", "fold").agg(F.min("text").alias("text"))  # one text for each id, the smallest
     .coalesce(max(1, -(-known.count() // PART_ROWS)))
     .mapInArrow(hashed, "part long, id long, toxic int, fold long, words array<long>").write.parquet(path))
    return docs.sparkSession.read.parquet(path)


def _texts(b: pa.RecordBatch, column: int) -> list[np.ndarray]:
    words = b.column(column)
    flat, ends = np.asarray(words.flatten()).view(np.uint64), np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1])


_COLUMNS = [f"c{i}" for i in range(2 * DIM)]


def learnt(model: Cnn, stored: DataFrame, epochs: int, rare: float, seed: int | list[int]) -> None:
    """One round: each part learns from the model by itself; the model becomes their average."""
    spark = stored.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def learn(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(part: int, rows: list) -> Iterator[pa.RecordBatch]:
            rows.sort(key=lambda r: r[0])
            start = sent.value
            m = Cnn()
            m.table, m.filters, m.dense, m.bias = start.table.copy(), [x.copy() for x in start.filters], start.dense.copy(), start.bias.copy()
            m.first, m.second, m.step = [x.copy() for x in start.first], [x.copy() for x in start.second], start.step
            m.train([r[2] for r in rows], np.array([r[1] for r in rows], dtype=np.float64), epochs, rare,
                    seed if isinstance(seed, int) else [*seed, part & 0xFFFFFFFF, part >> 32])
            at, values = [], []
            for t in (0, 1):
                met = np.flatnonzero((m.second[t] != start.second[t]).any(axis=1))
                at.append(met + t * BUCKETS)
                values.append(np.concatenate([m.table[t][met], m.second[t][met]], axis=1))
            rest = m.numbers()
            at.append(np.arange(len(rest)) + 2 * BUCKETS)
            values.append(np.pad(rest, ((0, 0), (0, 2 * DIM - rest.shape[1]))))
            at, values = np.concatenate(at), np.concatenate(values).astype(np.float32)
            for a in range(0, len(at), 1 << 16):
                v = values[a:a + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"row": pa.array(at[a:a + (1 << 16)], pa.int32()), "w": pa.array(np.full(len(v), float(len(rows)))),
                                                  **{c: pa.array(np.ascontiguousarray(v[:, i])) for i, c in enumerate(_COLUMNS)}})

        part, rows = None, []
        for b in frames:
            for p, i, y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), _texts(b, 3), strict=True):
                if p != part and rows:
                    yield from flush(part, rows)
                    rows = []
                part = p
                rows.append((i, y, x.copy()))
        if rows:
            yield from flush(part, rows)

    out = (stored.where("fold <> 1").select("part", "id", "toxic", "words")
           .mapInArrow(learn, "row int, w double, " + ", ".join(f"{c} float" for c in _COLUMNS))
           .groupBy("row").agg(*[(F.sum(F.col(c).cast("double") * F.col("w")) / F.sum("w")).cast("float").alias(c) for c in _COLUMNS]).toArrow())
    sent.destroy()
    row = np.asarray(out.column("row"))
    values = np.stack([np.asarray(out.column(c)) for c in _COLUMNS], axis=1)
    for t in (0, 1):
        mine = (row >= t * BUCKETS) & (row < (t + 1) * BUCKETS)
        model.table[t][row[mine] - t * BUCKETS] = values[mine, :DIM]
        model.second[t][row[mine] - t * BUCKETS] = values[mine, DIM:]
    rest = row >= 2 * BUCKETS
    model.set_numbers(row[rest] - 2 * BUCKETS, values[rest, :3])


def fit(docs: DataFrame, labels: DataFrame) -> Cnn:
    """Learns from every labelled document outside the held-out fold."""
    stored = stored_parts(docs, labels)
    counts = stored.groupBy("part", "toxic", (F.col("fold") == 1).alias("held")).count().collect()  # four rows a part at most

    def rows(wanted) -> int:
        return sum(r["count"] for r in counts if wanted(r))

    n, toxic = rows(lambda r: not r.held), rows(lambda r: not r.held and r.toxic)
    model = Cnn()
    if not 0 < toxic < n:
        yes, all_ = rows(lambda r: r.toxic), rows(lambda r: True)
        model.dense[:] = 0
        model.bias[:] = np.log((yes + 0.5) / (all_ - yes + 0.5))
        return model.without_moments()
    rare = max(1.0, min(8.0, float(n - toxic) / max(1.0, float(toxic))))
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // n))
    if len({r.part for r in counts if not r.held}) == 1:
        learnt(model, stored, epochs, rare, 2)
    else:
        for i in range(epochs):
            learnt(model, stored, 1, rare, [2, i])
            model.step += -(-PART_ROWS // BATCH)  # only for Adam's correction of its first steps
    model.without_moments()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def logits(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            texts = _texts(b, 1)
            yield pa.RecordBatch.from_pydict({"toxic": b.column(0), "lang": pa.array([language(x) for x in texts], pa.int32()),
                                              "z": pa.array([sent.value.logit(x) for x in texts], pa.float64())})

    held = stored.where("fold = 1") if rows(lambda r: r.held) else stored
    by_step = (held.select("toxic", "words").mapInArrow(logits, "toxic int, lang int, z double")
               .groupBy("lang", F.floor(F.col("z") * STEPS_A_LOGIT).alias("step"))
               .agg(F.min("z").alias("low"), F.max("z").alias("high"), F.sum("toxic").alias("hits"), F.count(F.lit(1)).alias("n")).toArrow())
    model.calibrate(*[np.asarray(by_step.column(c)) for c in ("lang", "step", "low", "high", "hits", "n")])
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs (doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in frames:
            scores = []
            for _, counts, h in batches(b.column(2).to_pylist(), RULE):
                scores += [model.score(x) for x in np.split(h, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "held_out": b.column(1), "score": pa.array(scores, pa.float64()),
                "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32())})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int"))
