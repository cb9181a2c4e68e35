"""SentencePiece encoding and decoding with N-best segmentations.

The lattice of a text has its positions as nodes and, as edges, the model's
pieces with their scores; a character that no piece has goes through its
byte pieces at a cost beyond the lowest rank. Forward Viterbi gives the best
score from the start to each position. These scores are exact heuristics of a
backward A* search from the end: hypotheses leave the queue in order of their
total score, so the first N to reach the start are the N best.

No piece has a space mark after another character (``Lattice`` checks it), so
the lattice falls apart before each run of marks, and likewise between any
neighbours that no piece holds side by side. What lies between such cuts (a
part) is searched once in a worker and kept by its own characters (at most
CACHE_ENTRIES parts). The N best of a text are the N best sums over its
parts, found by a queue over the N - 1 parts whose second alternatives cost
least; very long texts go in segments. The search of a part holds one score
for each position, not the edges: those into a position are found again when
the search comes by, and of the hypotheses only N wait at a time. So a word of
of a million letters takes about 300 bytes a letter.

Only the best ids and the N best scores of a part are kept; for new parts of
up to SHORT letters these come from one forward pass over all of them at
once, place by place: the N highest sums into each place and its best edge.
Of ties the longest edge counts, as in the search, which gives the ids of
the other segmentations.

Ties between equal scores: the order of discovery, the same on each run.
Decoding joins pieces, turns marks into spaces and byte pieces into bytes and
drops the mark that encoding puts first; texts return as they were, except
that the mark character itself comes back as a space.

Null and empty texts: no ids, score 0, one segmentation (empty). Rows with
null ids and repeated rows are encoded as they stand; other columns are
ignored.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from bisect import insort
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.texthash import Packed

MARK = "▁"
N_BEST = 4
CACHE_ENTRIES = 400_000
CACHE_CHARACTERS = 16 << 20
SEGMENT = 1 << 18
ROWS = 500
SHORT = 64
TOGETHER = 1 << 16  # letters of short parts that go through one pass
DECODED = 1 << 15  # ids decoded together, but for those of a longer text
_KINDS = 511

_lattices: dict[tuple, Lattice] = {}


class Lattice:
    """The pieces of a model; known: parts with their best ids and N best scores."""

    def __init__(self, path: str | None = None, n: int = N_BEST):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.n = n
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.scores[p], self.ids[p] = sp.get_score(i), i
                self.bytes_of.append(p.encode())
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("pieces of this model cross spaces; units are not independent")
        # which neighbours some piece holds side by side; characters beyond the table may always be held
        self.beside = np.ones((_KINDS + 2, _KINDS + 2), dtype=bool)
        self.beside[:_KINDS + 1, :_KINDS + 1] = False
        kind = {chr(c): c for c in range(_KINDS)} | {MARK: _KINDS}
        for p in self.ids:
            for x, y in zip(p, p[1:], strict=False):
                self.beside[kind.get(x, _KINDS + 1), kind.get(y, _KINDS + 1)] = True
        self.beside[:_KINDS, _KINDS] = self.beside[_KINDS + 1, _KINDS] = False  # a mark starts a part, checked above
        self.trie: dict = {}
        self.endings: dict = {}  # the same, from the last character back
        for p, i in self.ids.items():
            for node, letters in ((self.trie, p), (self.endings, reversed(p))):
                for c in letters:
                    node = node.setdefault(c, {})
                node[None] = (self.scores[p], (i,))
        # the trie as arrays: sorted (node, letter) pairs with the node they lead to, and the piece that ends there
        letters = sorted({c for p in self.ids for c in p})
        kind = {c: k for k, c in enumerate(letters)}
        self.letters = len(letters)
        self.letter = np.full(sys.maxunicode + 1, -1, dtype=np.int16 if len(letters) < 1 << 15 else np.int32)  # number of each character
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        node = {"": 0}
        steps = []
        for p in self.ids:
            for j in range(1, len(p) + 1):
                if p[:j] not in node:
                    steps.append((node[p[:j - 1]] * len(kind) + kind[p[j - 1]], len(node)))
                    node[p[:j]] = len(node)
        self.steps, self.leads = np.array(sorted(steps), dtype=np.int64).reshape(-1, 2).T.copy()
        self.piece, self.cost = np.full(len(node), -1, dtype=np.int32), np.zeros(len(node))
        for p, i in self.ids.items():
            self.piece[node[p]], self.cost[node[p]] = i, self.scores[p]
        # the bytes of the pieces end to end, with spaces for marks
        spelt = [b.replace(MARK.encode(), b" ") for b in self.bytes_of]
        self.spelling = np.frombuffer(b"".join(spelt), dtype=np.uint8)
        self.spelling_size = np.array([len(b) for b in spelt], dtype=np.int64)
        self.spelling_at = np.cumsum(self.spelling_size) - self.spelling_size
        self.known = Packed(np.int32, CACHE_ENTRIES, CACHE_CHARACTERS, n)
        self.others: dict[str, list] = {}  # parts with the ids of their N best
        self.unknown = -sp.get_piece_size() - 10.0

    def search(self, unit: str) -> list[tuple[float, tuple[int, ...]]]:
        """N best segmentations of a string with its marks."""
        n = len(unit)
        best = [0.0] + [float("-inf")] * n
        for i in range(n):
            here, node = best[i], self.trie
            for j in range(i, n):
                node = node.get(unit[j])
                if node is None:
                    break
                if None in node:
                    v = here + node[None][0]
                    if v > best[j + 1]:
                        best[j + 1] = v
            if unit[i] not in self.scores:
                v = here + self.unknown
                if v > best[i + 1]:
                    best[i + 1] = v
        # a hypothesis: (-its total, order of discovery, node, score behind it, edge to take there, ids behind it).
        # The best edges of a node keep the total, so they are followed at once; the others wait in the queue.
        # Each hypothesis ends in a segmentation of its total, so one behind N others is never needed.
        queue: list[tuple] = [(-best[n], 0, n, 0.0, None, None)]
        least = [-best[n]]  # the N lowest first fields so far
        found, order = [], 0
        while queue and len(found) < self.n:
            _, _, at, behind, edge, tail = heapq.heappop(queue)
            while True:
                if edge is not None:
                    _, at, s, ids = edge
                    behind, tail = behind + s, (ids, tail)
                if at == 0:
                    break
                edge = None
                for e in self._into(unit, at, best):
                    if edge is None and e[0] == best[at]:
                        edge = e
                    else:
                        order += 1
                        key = -(behind + e[0])
                        if len(least) < self.n or key < least[-1]:
                            insort(least, key)
                            del least[self.n:]
                            heapq.heappush(queue, (key, order, at, behind, e, tail))
            out: list[int] = []
            while tail is not None:
                out.extend(tail[0])
                tail = tail[1]
            found.append((behind, tuple(out)))
        return found

    def _into(self, unit: str, at: int, best: list[float]) -> list[tuple]:
        """The edges that end at a node: (best score through the edge, start, score, ids), longest first.

        They are found again from the end, so the lattice of a long part is
        never held: only the best score of each node is.
        """
        edges, node = [], self.endings
        for i in range(at - 1, -1, -1):
            node = node.get(unit[i])
            if node is None:
                break
            if None in node:
                s, ids = node[None]
                edges.append((best[i] + s, i, s, ids))
        c = unit[at - 1]
        if c not in self.scores:
            edges.insert(0, (best[at - 1] + self.unknown, at - 1, self.unknown, tuple([self.byte_ids[b] for b in c.encode()])))
        edges.reverse()
        return edges

    def _cuts(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where parts start in code points, spaces taken for marks: at segments, and where no piece holds the neighbours."""
        kind = np.where(codes < _KINDS, codes, _KINDS + 1)
        kind[(codes == ord(MARK)) | (codes == 32)] = _KINDS
        cut = np.zeros(len(codes), dtype=bool)
        cut[1:] = ~self.beside[kind[:-1], kind[1:]]
        cut[first] = True
        return np.flatnonzero(cut)

    def _rows(self, segments: list[str]) -> tuple[np.ndarray, list[int], Callable[[int], str]]:
        """(cache row of every part of the segments, number of parts after each segment, the part at a place)."""
        text = "".join(segments).replace(MARK, " ")  # shorter, as bytes
        data = text.encode(errors="replace")
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        ends = np.cumsum([len(t) for t in segments])
        start = self._cuts(codes, np.concatenate(([0], ends[:-1])))
        end = np.append(start[1:], len(codes))
        after = np.searchsorted(end, ends, side="right").tolist()
        if len(data) > len(codes):
            at = np.concatenate(([0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))))
            start, end = at[start], at[end]

        def spelt(part: bytes) -> str:
            return part.decode().replace(" ", MARK)

        rows = self.known.spans(data, start, end, lambda new: self._of_parts(list(map(spelt, new))))
        return rows, after, lambda j: spelt(data[start[j]:end[j]])

    def _of_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best ids of the parts end to end, their sizes, N best scores of each part)."""
        runs, sizes, scores = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)], [np.zeros((0, self.n))]
        held: list[str] = []

        def add(*found):
            for out, x in zip((runs, sizes, scores), found, strict=True):
                out.append(x)

        def flush():
            if held:
                add(*self._short(held))
                held.clear()

        size = 0
        for p in parts:
            if len(p) <= SHORT:
                held.append(p)
                size += len(p)
            if len(p) > SHORT or size >= TOGETHER:
                flush()
                size = 0
            if len(p) > SHORT:
                found = self.search(p)
                add(np.array(found[0][1], dtype=np.int32), np.array([len(found[0][1])]),
                    np.array([[h[0] for h in found] + [-np.inf] * (self.n - len(found))]))
        flush()
        return np.concatenate(runs), np.concatenate(sizes), np.concatenate(scores)

    def _short(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for short parts, all at once; a part of n letters has n + 1 places, numbered end to end."""
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        length = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        owner = np.repeat(np.arange(len(parts)), length)  # of each letter
        last = np.cumsum(length)
        kind = self.letter[codes].astype(np.int64)
        # the edges: (letter where they start, letters, node of the trie); -1: through byte pieces
        room = last[owner] - np.arange(len(codes))
        first, node, edges = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64), []
        for j in range(int(length.max())):
            if j:
                inside = room[first] > j
                first, node = first[inside], node[inside]
            own = kind[first + j] if j else kind
            step = node * self.letters + own
            at = np.searchsorted(self.steps, step)
            at[at == len(self.steps)] = 0
            on = (self.steps[at] == step) & (own >= 0)
            if j == 0:
                alone = np.flatnonzero(~(on & (self.piece[self.leads[at]] >= 0)))
                edges.append((alone, np.ones(len(alone), dtype=np.int64), np.full(len(alone), -1)))
            first, node = first[on], self.leads[at[on]]
            if not len(first):
                break
            ends = self.piece[node] >= 0
            edges.append((first[ends], np.full(int(ends.sum()), j + 1), node[ends]))
        begin, span, node = (np.concatenate(x) for x in zip(*edges, strict=True))
        zero = last - length + np.arange(len(parts))
        into = begin + span + owner[begin]  # place where the edge ends
        far = into - zero[owner[begin]]  # its distance from the part's start
        # by distance, then place, longest first: what one step needs lies together
        order = np.argsort((far * (len(codes) + len(parts)) + into) * (2 * SHORT) - span)
        begin, span, node, into, far = begin[order], span[order], node[order], into[order], far[order]
        score = np.where(node >= 0, self.cost[node], self.unknown)
        came = into - span
        # edges into the same place have slots from 0
        head = np.flatnonzero(np.diff(into, prepend=-1))
        places, count = into[head], np.diff(head, append=len(into))
        slot = np.arange(len(into)) - np.repeat(head, count)
        sums = np.full((len(codes) + len(parts), self.n), -np.inf)
        sums[zero, 0] = 0.0
        best = np.zeros(len(places), dtype=np.int64)  # edge into each place
        bounds = np.searchsorted(far[head], np.arange(1, int(length.max()) + 2)).tolist()
        groups = [(x, y) for x, y in zip(bounds, bounds[1:], strict=False) if x < y]
        for x, y in groups:
            u, v, most = int(head[x]), int(head[y - 1] + count[y - 1]), int(count[x:y].max())
            table = np.full(((y - x) * most, self.n), -np.inf)
            table[np.repeat(np.arange(y - x) * most, count[x:y]) + slot[u:v]] = sums[came[u:v]] + score[u:v, None]
            table = table.reshape(y - x, most * self.n)
            best[x:y] = head[x:y] + table[:, ::self.n].argmax(axis=1)
            table.sort(axis=1)
            sums[places[x:y]] = table[:, :-self.n - 1:-1]
        chosen = np.zeros(len(into), dtype=bool)
        here = np.zeros(len(sums), dtype=bool)
        here[zero + length] = True
        for x, y in reversed(groups):
            own = best[x:y][here[places[x:y]]]
            chosen[own] = True
            here[came[own]] = True
        chosen = np.flatnonzero(chosen)
        chosen = chosen[np.argsort(begin[chosen])]
        begin, node = begin[chosen], node[chosen]
        spelt = node < 0
        letters = "".join(map(chr, codes[begin[spelt]].tolist()))
        size = np.ones(len(node), dtype=np.int64)
        size[spelt] = [len(c.encode()) for c in letters]
        ids = np.empty(int(size.sum()), dtype=np.int32)
        spelt = np.repeat(spelt, size)
        ids[~spelt] = self.piece[node[node >= 0]]
        ids[spelt] = np.array(self.byte_ids, dtype=np.int32)[np.frombuffer(letters.encode(), dtype=np.uint8)]
        return ids, np.bincount(owner[begin], weights=size, minlength=len(parts)).astype(np.int64), sums[zero + length]

    def best(self, texts: list[str | None]) -> list[tuple[np.ndarray, list[float]]]:
        """(ids of the best segmentation, scores of the N best) of each text."""
        return [(ids, [s for s, _ in self._sums(total, [s for s, _, _ in near])]) for ids, total, near in self._found(texts)]

    def segmentations(self, texts: list[str | None]) -> list[list[tuple[float, np.ndarray]]]:
        """(score, ids) of the N best segmentations of each text: the best one with other ids in the parts that differ."""
        out = []
        for ids, total, near in self._found(texts):
            found = []
            for score, picks in self._sums(total, [s for s, _, _ in near]):
                at, pieces = 0, []
                for place, m in sorted((near[m][1], m) for m in picks):
                    first, *_ = others = self._others(near[m][2])
                    pieces += [ids[at:place], others[picks[m]]]
                    at = place + len(first)
                found.append((score, np.concatenate([*pieces, ids[at:]]) if pieces else ids))
            out.append(found)
        return out

    def _others(self, part: str) -> list[np.ndarray]:
        """Ids of the N best segmentations of a part, kept for short parts (at most CACHE_ENTRIES / 8)."""
        found = self.others.get(part)
        if found is None:
            found = [np.array(h[1], dtype=np.int32) for h in self.search(part)]
            if len(part) <= 64:
                if len(self.others) >= CACHE_ENTRIES // 8:
                    self.others.clear()
                self.others[part] = found
        return found

    def _found(self, texts: list[str | None]) -> list[tuple[np.ndarray, float, list[tuple]]]:
        """(ids of the best segmentation, its score, the N - 1 parts whose second alternatives cost least: scores, place of
        their ids, characters) of each text."""
        ids: list[list] = [[] for _ in texts]
        totals = [0.0] * len(texts)
        near: list[list] = [[] for _ in texts]
        placed = [0] * len(texts)
        held: list[str] = []
        owner: list[int] = []

        def flush():
            rows, after, part = self._rows(held)
            runs, upto = self.known.runs(rows)
            scores = self.known.more[rows]
            cost = scores[:, 0] - scores[:, 1] if self.n > 1 else np.full(len(rows), np.inf)
            a = 0
            for i, b in zip(owner, after, strict=True):
                begin = upto[a - 1] if a else 0
                ids[i].append(runs[begin:upto[b - 1]])
                totals[i] += float(scores[a:b, 0].sum())
                # the N - 1 parts whose second alternatives cost least: any other one costs more than all of these
                k = min(self.n - 1, b - a)
                least = np.argpartition(cost[a:b], k - 1)[:k] + a if k else []
                near[i] = sorted(near[i] + [(tuple(scores[j]), placed[i] + int((upto[j - 1] if j else 0) - begin), part(j)) for j in least if np.isfinite(cost[j])],
                                 key=lambda p: p[0][0] - p[0][1])[:self.n - 1]
                placed[i] += int(upto[b - 1] - begin)
                a = b
            held.clear()
            owner.clear()

        size = 0
        for i, t in enumerate(texts):
            for part in self._segments(t):
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= 2 * SEGMENT:
                    flush()
                    size = 0
        if held:
            flush()
        none = np.zeros(0, dtype=np.int32)
        return [(np.concatenate(x) if x else none, t, c) for x, t, c in zip(ids, totals, near, strict=True)]

    def _segments(self, text: str | None) -> Iterator[str]:
        """The text with marks, in segments of about SEGMENT characters that start where a run of spaces does."""
        if not text:
            return
        text = MARK + text.replace(" ", MARK)
        at = 0
        while len(text) - at > SEGMENT:
            end = text.find(MARK, at + SEGMENT)
            while end > 0 and text[end - 1] == MARK:
                end = text.find(MARK, end + 1)
            if end < 0:
                break
            yield text[at:end]
            at = end
        yield text[at:]

    def _sums(self, total: float, near: list[tuple]) -> Iterator[tuple[float, dict[int, int]]]:
        """(sum, {place in near: its alternative}) of the N best choices of one alternative for each part."""
        done, queue, order = 0, [(0.0, 0, ())], 0
        while queue and done < self.n:
            loss, _, chosen = heapq.heappop(queue)
            done += 1
            yield total - loss, dict(chosen)
            # children: the last chosen part's next alternative, or a first one of a later part
            if chosen:
                m, k = chosen[-1]
                if k + 1 < self.n and near[m][k + 1] > float("-inf"):
                    order += 1
                    heapq.heappush(queue, (loss + near[m][k] - near[m][k + 1], order, (*chosen[:-1], (m, k + 1))))
            for m in range(chosen[-1][0] + 1 if chosen else 0, len(near)):
                order += 1
                heapq.heappush(queue, (loss + near[m][0] - near[m][1], order, (*chosen, (m, 1))))

    def n_best(self, text: str | None) -> list[tuple[float, list[int]]]:
        """The N best segmentations of a text: (score, ids), best first."""
        marked = MARK + text.replace(" ", MARK) if text else ""
        codes = np.frombuffer(marked.encode("utf-32-le", "replace"), dtype="<u4")
        cuts = [*self._cuts(codes, np.zeros(min(1, len(codes)), dtype=int)).tolist(), len(codes)]
        found = [self.search(marked[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
        more = sorted((f[0][0] - f[1][0], j) for j, f in enumerate(found) if len(f) > 1)[:self.n - 1]
        near = [tuple([h[0] for h in found[j]] + [float("-inf")] * (self.n - len(found[j]))) for _, j in more]
        out = []
        for score, picks in self._sums(sum(f[0][0] for f in found), near):
            k = {more[m][1]: a for m, a in picks.items()}
            out.append((score, list(chain.from_iterable(f[k.get(j, 0)][1] for j, f in enumerate(found)))))
        return out

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text

    def _spell(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(the bytes of the ids end to end, with spaces for marks; where those of each id end)."""
        size = self.spelling_size[ids]
        upto = np.cumsum(size)
        place = np.repeat(self.spelling_at[ids] - upto + size, size)
        place += np.arange(len(place))
        return self.spelling[place].tobytes(), upto

    def returns(self, text: str | None, runs: list[np.ndarray]) -> bool:
        """Whether each run of ids decodes to the text."""
        if not text:
            return not any(map(len, runs))
        wanted = _wanted(text)
        for ids in runs:
            at = 0
            for a in range(0, len(ids), SEGMENT):  # a few MB at a time
                spelt, _ = self._spell(ids[a:a + SEGMENT])
                if wanted[at:at + len(spelt)] != spelt:
                    break
                at += len(spelt)
            else:
                if at == len(wanted):
                    continue
            if self.decode(ids.tolist()) != text.replace(MARK, " "):
                return False
        return True

    def all_return(self, texts: list[str | None], runs: list[list[np.ndarray]]) -> list[bool]:
        """``returns`` for each text with its runs of ids; the runs of neighbours are decoded together."""
        out: list[bool] = []
        upto = np.cumsum([sum(map(len, x)) for x in runs])
        cuts = np.unique(np.append(np.searchsorted(upto, np.arange(0, upto[-1] + 1, DECODED)), len(texts))).tolist() if texts else []
        for a, b in zip([0, *cuts], cuts, strict=False):
            ids = [x for own in runs[a:b] for x in own]
            if b - a > 1 and ids:
                wanted = [w for t, own in zip(texts[a:b], runs[a:b], strict=True) for w in [_wanted(t)] * len(own)]
                spelt, ends = self._spell(np.concatenate(ids))
                ends = np.concatenate(([0], ends))[np.cumsum([*map(len, ids)])]
                if (ends == np.cumsum([*map(len, wanted)])).all() and spelt == b"".join(wanted):
                    out += [True] * (b - a)
                    continue
            out += [self.returns(t, own) for t, own in zip(texts[a:b], runs[a:b], strict=True)]
        return out


def _wanted(text: str | None) -> bytes:
    return (" " + text.replace(MARK, " ")).encode() if text else b""


def lattice(path: str | None = None, n: int = N_BEST) -> Lattice:
    if (path, n) not in _lattices:
        _lattices[path, n] = Lattice(path, n)
    return _lattices[path, n]


def _ends(lists: list) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum([len(x) for x in lists]))), pa.int32())


def _lists(runs: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(_ends(runs), pa.array(np.concatenate([np.zeros(0, np.int32), *runs])))


def encode(docs: DataFrame, model: str | None = None, n: int = N_BEST, with_ids: bool = True, with_segmentations: bool = False) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, scores (N best), round_trip and, if wanted, ids and segmentations for each row of ``docs (doc_id, text)``.

    round_trip: the decoded ids give the text back, those of each segmentation
    where they are wanted. ids_crc32: of the best ids as little-endian u32.
    segmentations: ids of the N best in the order of scores.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = lattice(model, n)
        kinds = {"n_pieces": pa.int64(), "ids_crc32": pa.int64(), "scores": pa.list_(pa.float64()), "round_trip": pa.bool_()}
        kinds |= {"ids": pa.list_(pa.int32())} if with_ids else {}
        kinds |= {"segmentations": pa.list_(pa.list_(pa.int32()))} if with_segmentations else {}
        for frame in frames:
            for at in range(0, frame.num_rows, ROWS):  # a few MB at a time
                b = frame.slice(at, ROWS)
                rows: dict = {c: [] for c in kinds}
                texts = b.column(1).to_pylist()
                if with_segmentations:
                    found = g.segmentations(texts)
                    rows["segmentations"] = [[ids for _, ids in x] for x in found]
                    best = [(x[0][1], [s for s, _ in x]) for x in found]
                else:
                    best = g.best(texts)
                for ids, scores in best:
                    rows["n_pieces"].append(len(ids))
                    rows["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    rows["scores"].append(scores)
                    if with_ids:
                        rows["ids"].append(ids)
                rows["round_trip"] = g.all_return(texts, rows["segmentations"] if with_segmentations else [[ids] for ids, _ in best])
                arrays = {c: pa.array(x, kinds[c]) for c, x in rows.items() if c not in ("ids", "segmentations")}
                arrays |= {"ids": _lists(rows["ids"])} if with_ids else {}
                if with_segmentations:
                    arrays["segmentations"] = pa.ListArray.from_arrays(_ends(rows["segmentations"]), _lists([*chain.from_iterable(rows["segmentations"])]))
                yield pa.RecordBatch.from_pydict({"doc_id": b.column(0)} | {c: arrays[c] for c in kinds})

    out = ("doc_id long, n_pieces long, ids_crc32 long, scores array<double>, round_trip boolean" + ", ids array<int>" * with_ids
           + ", segmentations array<array<int>>" * with_segmentations)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, out)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded (doc_id, ids)`` -> doc_id, text."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = lattice(model)
        for b in frames:
            texts = [g.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
