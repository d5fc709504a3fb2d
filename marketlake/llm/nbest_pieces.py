"""SentencePiece encoding and decoding with N-best segmentation.

The lattice of a text has an edge for every vocabulary piece that matches, and
for a character that no piece covers an edge to its UTF-8 bytes.  Segmentations
are ranked by the sum of the pieces' scores as the model file states them.  A
forward Viterbi pass gives the best score up to each place; a backward A* search
from the end uses these scores as its heuristic, which is exact, so it pops the
segmentations best first.

No piece spans two neighbouring characters that never stand together inside a
piece, so the lattice falls into chunks at such places.  Chunks are looked up in
a bounded cache of the worker; the new ones of a batch go through the Viterbi
passes together, as arrays.  Forward and backward scores also give the gap to a
chunk's second-best segmentation.  The N best of a text deviate only in the
N - 1 chunks of smallest gap, so A* runs on those alone.

Encoding follows the model's plain rules: a space in front, spaces as U+2581.
A literal U+2581 goes by its bytes, so ``decode`` gives back every text exactly.

Cases: null and empty texts have no pieces, score 0.0 and no alternatives (a
null decodes to the empty text); texts with fewer segmentations than N list
what there is; ties: the longer last piece first in a chunk, the earlier chunk
first in a text; repeated rows are encoded alike; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import codepoints as C
from .common import map_arrow

#: Fixed values of the format: the space mark, and how far an unknown character lies below the worst piece.
MARK, UNKNOWN_BELOW = 0x2581, 10.0
LITERAL_MARK = 0x110000  # stands for a U+2581 of the text itself
BASE = np.uint64(0x9E3779B97F4A7C15)
CACHE_CHUNKS = 400_000
CACHE_IDS = 16 * CACHE_CHUNKS  # of their best segmentations
LIST_IDS = 2 * CACHE_CHUNKS  # of their N best, as Python lists


@dataclass
class Model:
    """Pieces as arrays, for broadcast; its size is the vocabulary's."""

    pieces: list[bytes]      # UTF-8 of each id, spaces as spaces
    scores: np.ndarray
    lengths: dict            # length -> (sorted hashes, ids)
    byte_ids: np.ndarray
    unknown: float
    kinds: np.ndarray        # character -> small number, 0 for characters of no longer piece
    joined: np.ndarray       # joined[k * n + l]: characters of kinds k, l stand together in a piece
    key: str


def _char_values(cp: np.ndarray) -> np.ndarray:
    return C.mixed(cp.astype(np.uint64) + np.uint64(0x51ED270B))


class Substrings:
    """Hashes of any substring of an array of code points, from one prefix sum."""

    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, cp: np.ndarray):
        n = len(cp) + 1
        if len(Substrings._powers[0]) < n:
            inverse = pow(int(BASE), -1, 1 << 64)
            up, down = np.full(n, BASE), np.full(n, np.uint64(inverse))
            up[0] = down[0] = 1
            Substrings._powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        up, self.down = Substrings._powers
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_char_values(cp) * up[:n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def load_model(path: str) -> Model:
    """Read a model file (on the driver; workers get the arrays)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = len(sp)
    names = [sp.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    byte_ids = np.full(256, -1, np.int32)
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(names[i][3:-1], 16)] = i
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces, so not every text could be decoded exactly")
    scores = np.array([sp.get_score(i) for i in range(n)])
    lengths, chars, pairs = {}, set(), set()
    for size in sorted({len(names[i]) for i in plain}):
        own = [i for i in plain if len(names[i]) == size]
        cp = np.array([[ord(c) for c in names[i]] for i in own], np.uint32)
        at = np.arange(len(own)) * size
        h = Substrings(cp.ravel()).of(at, at + size)
        order = np.argsort(h)
        lengths[size] = (h[order], np.array(own, np.int32)[order])
        for i in own if size > 1 else []:
            chars.update(names[i])
            pairs.update(zip(names[i], names[i][1:]))
    known = {c: k + 1 for k, c in enumerate(sorted(chars))}
    kinds = np.zeros(LITERAL_MARK + 1, np.uint16)
    for c, k in known.items():
        kinds[ord(c)] = k
    width = len(known) + 1
    joined = np.zeros(width * width, bool)
    for a, b in pairs:
        joined[known[a] * width + known[b]] = True
    texts = [names[i].replace(chr(MARK), " ").encode() for i in range(n)]
    for b, i in enumerate(byte_ids):
        texts[i] = bytes([b])
    return Model(texts, scores, lengths, byte_ids, float(scores[plain].min()) - UNKNOWN_BELOW, kinds, joined, path)


# ---- lattices ------------------------------------------------------------------------------------

class Lattices:
    """Chunks side by side: chunk c has the nodes base[c] .. base[c] + size[c]."""

    def __init__(self, model: Model, cp: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.model, self.size = model, end - start
        self.first = np.cumsum(self.size) - self.size
        self.chars = cp[np.repeat(start - self.first, self.size) + np.arange(self.size.sum())]
        self.base = self.first + np.arange(len(start))
        self.last = self.base + self.size
        chunk = np.repeat(np.arange(len(start)), self.size)
        self.node = np.arange(len(self.chars)) + chunk  # of the place before each character
        left = self.size[chunk] - (np.arange(len(self.chars)) - self.first[chunk])
        subs = Substrings(self.chars)
        self.lengths = list(model.lengths)
        if 1 not in self.lengths:
            self.lengths.insert(0, 1)
        nodes = len(self.chars) + len(start)
        self.piece, self.edge = {}, {}  # by length, at the edge's first node
        for length in self.lengths:
            ids = np.full(nodes, -1, np.int32)
            at = np.flatnonzero(left >= length)
            if length in model.lengths and len(at):
                hashes, own = model.lengths[length]
                h = subs.of(at, at + length)
                spot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = hashes[spot] == h
                ids[self.node[at[hit]]] = own[spot[hit]]
            score = np.where(ids >= 0, model.scores[np.maximum(ids, 0)], -np.inf)
            if length == 1:
                free = self.node[ids[self.node] < 0]
                score[free] = model.unknown
            self.piece[length], self.edge[length] = ids, score

    def _by_place(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place, chunks that reach it), longest chunks first."""
        order = np.argsort(-self.size, kind="stable")
        falling = self.size[order]
        for p in range(1, int(falling[0]) + 1 if len(falling) else 0):
            yield p, order[:np.searchsorted(-falling, -p, "right")]

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """Best score up to each node, and the length of its last piece (the longer on ties)."""
        best = np.full(len(self.chars) + len(self.size), -np.inf)
        back = np.zeros(len(best), np.int32)
        best[self.base] = 0
        for p, own in self._by_place():
            node = self.base[own] + p
            top, how = np.full(len(own), -np.inf), np.zeros(len(own), np.int32)
            for length in self.lengths:
                if length > p:
                    break
                value = best[node - length] + self.edge[length][node - length]
                better = value >= top
                top, how = np.where(better, value, top), np.where(better & (value > -np.inf), length, how)
            best[node], back[node] = top, how
        return best, back

    def backward(self) -> np.ndarray:
        """Best score from each node to its chunk's end."""
        best = np.full(len(self.chars) + len(self.size), -np.inf)
        best[self.last] = 0
        for p, own in self._by_place():
            node = self.last[own] - p
            top = np.full(len(own), -np.inf)
            for length in self.lengths:
                if length > p:
                    break
                top = np.maximum(top, self.edge[length][node] + best[node + length])
            best[node] = top
        return best

    def paths(self, back: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, first node, length) of the pieces of all best paths, in order."""
        at, chunk, out = self.last.copy(), np.arange(len(self.size)), []
        while len(at):
            length = back[at]
            at = at - length
            out.append((chunk, at, length))
            go = at > self.base[chunk]
            at, chunk = at[go], chunk[go]
        chunk, node, length = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        order = np.argsort(node, kind="stable")
        return chunk[order], node[order], length[order]

    def gaps(self, forward: np.ndarray, backward: np.ndarray, path: tuple) -> np.ndarray:
        """How far each chunk's second-best segmentation lies below its best (inf: there is none)."""
        second = np.full(len(forward), -np.inf)
        for length in self.lengths:
            through = np.full(len(forward), -np.inf)
            at = np.arange(len(forward) - length)
            through[at] = forward[at] + self.edge[length][at] + backward[at + length]
            through[path[1][path[2] == length]] = -np.inf
            second = np.maximum(second, through)
        return forward[self.last] - np.maximum.reduceat(second, self.base) if len(self.base) else np.zeros(0)

    def ids(self, node: int, length: int) -> list[int]:
        piece = int(self.piece[length][node])
        if piece >= 0:
            return [piece]
        c = int(self.chars[np.searchsorted(self.node, node)])
        return [int(self.model.byte_ids[b]) for b in ("▁" if c == LITERAL_MARK else chr(c)).encode()]

    def search(self, chunk: int, forward: np.ndarray, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations (score, ids) of a chunk, by backward A*."""
        base, end = int(self.base[chunk]), int(self.last[chunk])
        found, count = [], 0
        heap = [(-float(forward[end]), 0, end, 0.0, None)]
        while heap and len(found) < n:
            _, _, node, done, tail = heapq.heappop(heap)
            if node == base:
                ids = []
                while tail:
                    ids += self.ids(tail[0], tail[1])
                    tail = tail[2]
                found.append((done, ids))
                continue
            for length in reversed(self.lengths):
                start = node - length
                if start >= base and self.edge[length][start] > -np.inf and forward[start] > -np.inf:
                    count += 1
                    score = done + float(self.edge[length][start])
                    heapq.heappush(heap, (-(score + float(forward[start])), count, start, score, (start, length, tail)))
        return found


# ---- batches -------------------------------------------------------------------------------------

class _Grown:
    """A growing array."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate((self.data[:self.n], np.zeros(max(self.n, len(more)) + len(more), self.data.dtype)))
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)


class Encoder:
    """Encodes batches of texts; the chunks it keeps from one batch to the next are at most ``CACHE_CHUNKS`` with
    ``CACHE_IDS`` ids, and ``LIST_IDS`` ids in lists of N best."""

    def __init__(self, model: Model, n_best: int):
        self.model, self.n_best = model, n_best
        self.width = int(np.sqrt(len(model.joined)))
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes, sorted, and where the chunk lies
        self.lists, self.listed = {}, 0
        self.ids, self.at, self.count, self.score, self.gap = _Grown(np.int32), _Grown(np.int64), _Grown(np.int64), _Grown(np.float64), _Grown(np.float64)

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the sorted distinct hashes the cache does not hold."""
        if not len(self.known):
            return np.arange(len(hashes))
        return np.flatnonzero(self.known[np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)] != hashes)

    def _learn(self, hashes: np.ndarray, cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        lattice = Lattices(self.model, cp, start, end)
        forward, back = lattice.forward()
        path = lattice.paths(back)
        chunk, node, length = path
        piece = np.full(len(node), -1, np.int32)
        for size in lattice.lengths:
            own = length == size
            piece[own] = lattice.piece[size][node[own]]
        lost = np.flatnonzero(piece < 0)
        width = np.ones(len(piece), np.int64)
        byte_ids = [lattice.ids(int(node[i]), 1) for i in lost]
        width[lost] = [len(b) for b in byte_ids]
        flat = np.repeat(piece, width)
        spot = np.cumsum(width) - width
        for i, b in zip(lost, byte_ids):
            flat[spot[i]:spot[i] + len(b)] = b
        count = np.bincount(chunk, width, len(start)).astype(np.int64)
        place = len(self.known)
        self.at.add(self.ids.n + np.cumsum(count) - count)
        self.ids.add(flat)
        self.count.add(count)
        self.score.add(forward[lattice.last])
        self.gap.add(lattice.gaps(forward, lattice.backward(), path))
        spot = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, spot, hashes)
        self.place = np.insert(self.place, spot, np.arange(place, place + len(start)))

    def encode(self, texts: list[str]) -> dict:
        """Offsets and ids of all texts, score, and per text its N best as (score, [(place, pieces dropped, ids)])."""
        if len(self.known) > CACHE_CHUNKS or self.ids.n > CACHE_IDS:
            self.forget()
        if self.listed > LIST_IDS:
            self.lists, self.listed = {}, 0
        n = len(texts)
        cp = np.frombuffer("".join(" " + t if t else "" for t in texts).encode("utf-32-le"), np.uint32)
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        at = np.concatenate(([0], np.cumsum(size)))
        cp = np.where(cp == 32, MARK, np.where(cp == MARK, LITERAL_MARK, cp)).astype(np.uint32)
        kind = self.model.kinds[cp].astype(np.int64)
        cut = np.ones(len(cp) + 1, bool)
        cut[1:-1] = ~self.model.joined[kind[:-1] * self.width + kind[1:]] if len(cp) else False
        cut[at] = True
        start = np.flatnonzero(cut[:-1])
        end = np.append(start[1:], len(cp)) if len(start) else start
        hashes = Substrings(cp).of(start, end)
        distinct, seen, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = self._unknown(distinct)
        if len(new):
            self._learn(distinct[new], cp, start[seen[new]], end[seen[new]])
        index = self.place[np.searchsorted(self.known, distinct)][inverse] if len(distinct) else np.zeros(0, np.int64)
        count = self.count.data[index]
        total = np.concatenate(([0], np.cumsum(count)))
        flat = self.ids.data[np.repeat(self.at.data[index] - total[:-1], count) + np.arange(total[-1])]
        chunk_at = np.searchsorted(start, at)
        score = np.add.reduceat(np.append(self.score.data[index], 0.0), np.minimum(chunk_at[:-1], len(index))) * (size > 0) if n else np.zeros(0)
        out = {"at": total[chunk_at], "ids": flat, "score": score}
        out["best"] = self._alternatives(cp, start, end, hashes, index, chunk_at, total, score) if self.n_best > 1 else None
        return out

    def _alternatives(self, cp, start, end, hashes, index, chunk_at, total, score) -> list[list[tuple]]:
        gap = self.gap.data[index]
        picks = []
        for a, b in zip(chunk_at[:-1].tolist(), chunk_at[1:].tolist()):
            own = gap[a:b]
            k = min(self.n_best - 1, len(own))
            if k < len(own):  # all of the k-th smallest gap, then the earliest of them
                edge = np.partition(own, k - 1)[k - 1]
                near = np.flatnonzero(own <= edge)
                near = near[np.argsort(own[near], kind="stable")[:k]]
            else:
                near = np.argsort(own, kind="stable")
            picks.append(a + near[own[near] < np.inf])
        wanted = np.unique(np.concatenate(picks)) if picks else np.zeros(0, np.int64)
        fresh = {h: i for i, h in zip(wanted.tolist(), hashes[wanted].tolist()) if h not in self.lists}
        if fresh:
            where = np.array(list(fresh.values()))
            lattice = Lattices(self.model, cp, start[where], end[where])
            forward, _ = lattice.forward()
            for c, h in enumerate(fresh):
                self.lists[h] = lattice.search(c, forward, self.n_best)
                self.listed += sum(len(ids) for _, ids in self.lists[h])
        return [self._merge(p, float(score[i]), hashes, total, int(chunk_at[i])) for i, p in enumerate(picks)]

    def _merge(self, picks: np.ndarray, best: float, hashes, total, first: int) -> list[tuple]:
        """The text's N best but the first: each a choice from the lists of its picked chunks."""
        lists = [self.lists[h] for h in hashes[picks].tolist()]
        start = (0,) * len(lists)
        heap, seen, out = [(0.0, start)], {start}, []
        while heap and len(out) < self.n_best:
            below, choice = heapq.heappop(heap)
            edits = [(int(total[picks[j]] - total[first]), int(total[picks[j] + 1] - total[picks[j]]), lists[j][c][1]) for j, c in enumerate(choice) if c]
            out.append((best - below, edits))
            for j, c in enumerate(choice):
                if c + 1 < len(lists[j]):
                    nxt = choice[:j] + (c + 1,) + choice[j + 1:]
                    if nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(heap, (sum(lists[i][0][0] - lists[i][k][0] for i, k in enumerate(nxt)), nxt))
        return out[1:]


def decode_ids(pieces: list[bytes], at: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Texts of lists of ids: the pieces' bytes without the space in front."""
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces], np.int64)
    first = np.cumsum(size) - size
    n = size[ids]
    total = np.concatenate(([0], np.cumsum(n)))
    data = joined[np.repeat(first[ids] - total[:-1], n) + np.arange(total[-1])]
    starts = total[at]
    full = np.diff(starts) > 0
    keep = np.ones(len(data), bool)
    keep[starts[:-1][full]] = False
    ends = np.concatenate(([0], np.cumsum(np.diff(starts) - full)))
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data[keep].tobytes()))


_ENCODERS: dict = {}


def _encoder(model: Model, n_best: int) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if (model.key, n_best) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model.key, n_best] = Encoder(model, n_best)
    return _ENCODERS[model.key, n_best]


EDIT = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("drop", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
ALTERNATIVE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(EDIT))])
ADDED = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("piece_score", T.DoubleType()),
         T.StructField("alternatives", T.ArrayType(ALTERNATIVE)), T.StructField("round_trip", T.BooleanType())]


def encode(docs: DataFrame, model: Model, n_best: int = 4, text: str = "text") -> DataFrame:
    """``docs`` with piece_ids and piece_score of the best segmentation, the others of the N best as edits of it
    (``at``: place among piece_ids, ``drop``: pieces replaced), and round_trip: whether the ids decode to the text."""
    docs = docs.select(*[c for c in docs.columns if c not in {f.name for f in ADDED}])
    held = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary
    edit = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])
    kind = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value, n_best)
        for batch in batches:
            for part in C.slices(batch, text, C.PIECE_BYTES):
                plain = pc.fill_null(part.column(text), "")
                got = encoder.encode(plain.to_pylist())
                back = decode_ids(encoder.model.pieces, got["at"], got["ids"])
                more = got["best"] or [[]] * part.num_rows
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.ListArray.from_arrays(pa.array(got["at"].astype(np.int32)), pa.array(got["ids"])), pa.array(got["score"]),
                    pa.array([[{"score": s, "edits": [dict(zip(("at", "drop", "ids"), e)) for e in edits]} for s, edits in m] for m in more], kind),
                    pc.equal(back, plain.cast(pa.large_string()))], names=[*part.schema.names, *[f.name for f in ADDED]])

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, *ADDED]))


def decode(df: DataFrame, model: Model, ids: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of the column of ids (a null list: null)."""
    df = df.select(*[c for c in df.columns if c != name])
    pieces = df.sparkSession.sparkContext.broadcast(model.pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids)
            at = np.concatenate(([0], np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(), dtype=np.int64)))
            texts = decode_ids(pieces.value, at, lists.flatten().to_numpy(zero_copy_only=False))
            texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.large_string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.string())], names=[*batch.schema.names, name])

    return map_arrow(df, run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))
