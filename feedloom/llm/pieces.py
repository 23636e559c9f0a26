"""SentencePiece sampling: forward filtering and backward sampling over the piece lattice; lossless decoding.

The vocabulary is that of a public SentencePiece model file; nothing is trained. A space is written as U+2581. Pieces never cross the
border before a space that follows other text, so that the lattice of a text is one lattice per segment (spaces, then characters). A character
that is no piece, and U+2581 itself, is the sequence of its byte pieces, which is its only edge. Other edges weigh
log p = -SHARPNESS * log(rank + 2), rank being the piece's place in the model (Zipf's law; single characters have their place too).

Forward filtering gives the log mass of all paths to each node of a segment; segments of equal text that a worker meets share it. Backward sampling
draws the edge into a node by its share of the node's mass, from the segment's end to its start. The draws are hashes of (row key, segment
number, step, seed), so that a row's result depends on no other row, nor on how the table is partitioned.

Null texts have null pieces, empty texts none. A null key is a key like any other. Repeated rows get equal results. Texts of any
length are sampled whole. Decoding is exact for any text.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import blocks, splitmix, table

MODEL = os.environ.get("FEEDLOOM_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
SHARPNESS = 1.0
SEED = 1
#: Nodes of lattices that a worker keeps (about 50 bytes each, with their segments).
STORED_NODES = 800_000
#: Characters whose lattices are made at a time (a single longer segment is made alone).
BUILT_CHARS = 1 << 16

_U = np.uint64
_MARK = "\u2581"
_LITERAL = 0xD800
_STEP = _U(0x9E3779B97F4A7C15)


def mix_chars(codes: np.ndarray) -> np.ndarray:
    return splitmix(codes.astype(np.uint64) * _STEP + _U(1))


class Pieces:
    """The model's pieces as a hash table over character sequences, with their weights."""

    def __init__(self, path: str = MODEL, sharpness: float = SHARPNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        self.data: list[bytes] = []
        normal = []
        for i, piece in enumerate(self.text):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.data.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.data.append(b"")
            else:
                self.data.append(piece.replace(_MARK, " ").encode())
                normal.append(i)
        self.weight = -sharpness * np.log(np.arange(n) + 2.0)
        sizes = np.array([len(self.text[i]) for i in normal])
        self.longest, self.lengths = int(sizes.max()), set(sizes.tolist())
        hashes = np.empty(len(normal), np.uint64)
        for k in self.lengths:
            at = np.flatnonzero(sizes == k)
            codes = np.frombuffer("".join(self.text[normal[i]] for i in at).encode("utf-32-le"), np.uint32)
            hashes[at] = fold(mix_chars(codes).reshape(-1, k))
        self.bits = 19
        slot = (hashes >> _U(64 - self.bits)).astype(np.int64)
        self.keys, self.ids = np.zeros((1 << self.bits) + 64, np.uint64), np.full((1 << self.bits) + 64, -1, np.int32)
        self.probes = 1
        for h, s, i in zip(hashes, slot.tolist(), normal, strict=True):
            k = 0
            while self.ids[s + k] >= 0:
                k += 1
            self.keys[s + k], self.ids[s + k] = h, i
            self.probes = max(self.probes, k + 1)
        self.flat = np.frombuffer(b"".join(self.data), np.uint8)
        self.bytes_of = np.array([len(d) for d in self.data])
        self.at = np.cumsum(self.bytes_of) - self.bytes_of

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 for none."""
        slot = (hashes >> _U(64 - self.bits)).astype(np.int64)
        found = np.where(self.keys[slot] == hashes, self.ids[slot], -1)
        for k in range(1, self.probes):
            rest = np.flatnonzero(found < 0)
            hit = self.keys[slot[rest] + k] == hashes[rest]
            found[rest[hit]] = self.ids[slot[rest[hit]] + k]
        return found

    def decode(self, ids) -> str:
        """The text of a sequence of ids. Every text that was encoded comes back as it was."""
        return b"".join([self.data[i] for i in ids]).decode("utf-8")

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """decode() of many sequences at once, as bytes: all of them one after the other, and where each ends."""
        n = self.bytes_of[ids]
        after = np.cumsum(n)
        out = self.flat[np.repeat(self.at[ids] - after + n, n) + np.arange(n.sum())]
        return out, np.concatenate([[0], after])[ends]


@functools.lru_cache(maxsize=1)
def pieces_of(path: str) -> Pieces:
    """A model, read once per worker."""
    return Pieces(path)


def fold(columns: np.ndarray) -> np.ndarray:
    """Hashes of rows of mixed characters; extend() goes on from them."""
    h = np.zeros(len(columns), np.uint64)
    for k in range(columns.shape[1]):
        h = extend(h, columns[:, k])
    return h


def extend(h: np.ndarray, chars: np.ndarray) -> np.ndarray:
    h = (h ^ chars) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class Lattice:
    """The lattices of some distinct segments: nodes 0..n of each, with the edges into each node and their shares.

    starts has the number of the first edge into each node (and one more entry), back the characters of each edge, upto the share of a node's
    edges up to each of them, to 24 bits. Shares are sums within a node, so that a segment's values are the same in whatever company it is.
    """

    def __init__(self, pieces: Pieces, segments: list[str]):
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        # Spaces are marks; a literal mark moves to a surrogate, which no text from Arrow has.
        codes = np.where(codes == 32, np.uint32(0x2581), np.where(codes == 0x2581, np.uint32(_LITERAL), codes))
        sizes = np.array([len(s) for s in segments])
        ends = np.cumsum(sizes)
        # Node numbers: character number plus segment number, and one more node at each segment's end.
        owner = np.repeat(np.arange(len(segments)), sizes)
        left = ends[owner] - np.arange(len(codes))
        mixed = mix_chars(codes)
        node = np.arange(len(codes)) + owner
        self.first, self.last = ends - sizes + np.arange(len(segments)), ends + np.arange(len(segments))
        h, at = np.zeros(len(codes), np.uint64), np.arange(len(codes))
        src, dst, ids = [], [], []
        single = np.full(len(codes), -1)
        for k in range(pieces.longest):
            keep = left[at] > k
            at, h = at[keep], h[keep]
            if not len(at):
                break
            h = extend(h, mixed[at + k])
            if k + 1 in pieces.lengths:
                found = pieces.lookup(h)
                hit = np.flatnonzero(found >= 0)
                src.append(node[at[hit]])
                dst.append(node[at[hit]] + k + 1)
                ids.append(found[hit])
                if k == 0:
                    single[at[hit]] = found[hit]
        lone = np.flatnonzero(single < 0)  # characters by their bytes: the edge names the character, as -1 - code
        src.append(node[lone])
        dst.append(node[lone] + 1)
        ids.append(-1 - codes[lone].astype(np.int64))
        src, dst, ids = np.concatenate(src), np.concatenate(dst), np.concatenate(ids).astype(np.int64)
        # The longest edge of a node comes first: it is the likeliest as a rule, so that a draw seldom looks further.
        order = len(dst) - 1 - np.argsort(dst[::-1], kind="stable")
        src, dst, ids = src[order], dst[order], ids[order]
        weight = np.where(ids >= 0, pieces.weight[np.maximum(ids, 0)], 0.0)
        n_nodes = len(codes) + len(segments)
        self.starts = np.searchsorted(dst, np.arange(n_nodes + 1))
        degree = np.diff(self.starts)
        mass = np.zeros(n_nodes)
        # Nodes in order of their place in the segment: all segments go on together.
        place = np.arange(n_nodes) - np.repeat(self.first, sizes + 1)
        by_place = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[by_place], np.arange(1, sizes.max() + 2))
        for p in range(len(bounds) - 1):
            nodes = by_place[bounds[p]:bounds[p + 1]]
            n = degree[nodes]
            offset = np.cumsum(n) - n
            edges = np.repeat(self.starts[nodes] - offset, n) + np.arange(n.sum())
            value = mass[src[edges]] + weight[edges]
            top = np.maximum.reduceat(value, offset)
            mass[nodes] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, n)), offset))
        self.back, self.ids, upto = (dst - src).astype(np.uint8), ids.astype(np.int32), np.exp(mass[src] + weight - mass[dst])
        rank = np.arange(len(dst)) - self.starts[dst]
        for r in range(1, int(degree.max(initial=0))):
            at = np.flatnonzero(rank == r)
            upto[at] += upto[at - 1]
        self.upto = upto.astype(np.float32)


class Store:
    """The lattices of the segments that a worker has met, up to a number of nodes; then it begins anew."""

    def __init__(self, pieces: Pieces, most: int = STORED_NODES):
        self.pieces, self.most = pieces, most
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.nodes = self.edges = 0
        self.first, self.last, self.starts = np.empty(0, np.int32), np.empty(0, np.int32), np.zeros(1, np.int32)
        self.back, self.ids, self.upto = np.empty(0, np.uint8), np.empty(0, np.int32), np.empty(0, np.float32)

    @staticmethod
    def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
        if at + len(values) > len(array):
            array = np.concatenate([array[:at], np.empty(max(len(values), at, 1 << 12), array.dtype)])
        array[at:at + len(values)] = values
        return array

    def rows(self, segments: list[str]) -> np.ndarray:
        """The numbers of segments; those not met so far are added."""
        look = lambda: np.fromiter(map(self.number.get, segments, itertools.repeat(-1)), np.int64, len(segments))
        found = look()
        missing = np.flatnonzero(found < 0)
        if len(missing):
            if self.nodes > self.most:
                self.clear()
                found, missing = look(), np.arange(len(segments))
            new = list(dict.fromkeys(segments[i] for i in missing))
            ends = np.cumsum([len(s) for s in new])
            for part in np.split(np.arange(len(new)), np.flatnonzero(np.diff(ends // BUILT_CHARS)) + 1):
                self._add(new[part[0]:part[-1] + 1])
            found[missing] = [self.number[segments[i]] for i in missing]
        return found

    def _add(self, new: list[str]) -> None:
        made, n = Lattice(self.pieces, new), len(self.number)
        self.number.update(zip(new, range(n, n + len(new)), strict=True))
        self.first, self.last = self._put(self.first, n, made.first + self.nodes), self._put(self.last, n, made.last + self.nodes)
        self.starts = self._put(self.starts, self.nodes, made.starts + self.edges)
        self.back = self._put(self.back, self.edges, made.back)
        self.ids, self.upto = self._put(self.ids, self.edges, made.ids), self._put(self.upto, self.edges, made.upto)
        self.nodes, self.edges = self.nodes + len(made.starts) - 1, self.edges + len(made.ids)

    def draw(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge into each node (none of them a first node), by uniform numbers below 1: the first whose share, with those before it, exceeds the number.

        A node's last edge takes what is left, whatever the sum of the shares is rounded to.
        """
        edge, last = self.starts[nodes].astype(np.int64), self.starts[nodes + 1] - 1
        open_ = np.flatnonzero((u >= self.upto[edge]) & (edge < last))
        while len(open_):
            edge[open_] += 1
            e = edge[open_]
            open_ = open_[(u[open_] >= self.upto[e]) & (e < last[open_])]
        return edge


#: Segments of a text: spaces, then other characters. Joined, they are the text.
_SEGMENT = re.compile(r" *[^ ]+| +")


def sample(store: Store, keys: np.ndarray, texts: list[str], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of some texts, one after the other, and how many each text has."""
    segments = [_SEGMENT.findall(t) for t in texts]
    counts = np.array([len(s) for s in segments], np.int64)
    if not counts.sum():
        return np.empty(0, np.int32), counts
    rows = store.rows(list(itertools.chain.from_iterable(segments)))
    nodes, first = store.last[rows].astype(np.int64), store.first[rows]
    row_key = np.asarray(keys, np.int64).view(np.uint64) ^ splitmix(np.array([seed], np.uint64))
    at = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    state = splitmix(splitmix(np.repeat(row_key, counts)) + at.astype(np.uint64) * _STEP)
    taken, owners, live = [], [], np.arange(len(rows))
    while len(live):
        state = splitmix(state + _STEP)
        e = store.draw(nodes, (state >> _U(11)).astype(np.float64) * 2.0**-53)
        taken.append(store.ids[e])
        owners.append(live)
        nodes = nodes - store.back[e]
        go = nodes > first
        nodes, first, state, live = nodes[go], first[go], state[go], live[go]
    # Edges were drawn from the end: a segment's k-th draw is its k-th piece from behind.
    owner = np.concatenate(owners)
    drawn = np.bincount(owner, minlength=len(rows))
    step = np.repeat(np.arange(len(taken)), [len(t) for t in taken])
    ids, ends = np.empty(len(owner), np.int32), np.cumsum(drawn)
    ids[ends[owner] - 1 - step] = np.concatenate(taken)
    # Edges that name a character become its byte pieces.
    text_of = np.repeat(np.repeat(np.arange(len(texts)), counts), drawn)
    ids, text_of = _bytes(store.pieces, ids, text_of)
    return ids, np.bincount(text_of, minlength=len(texts))


def _bytes(pieces: Pieces, ids: np.ndarray, owners: np.ndarray):
    lone = np.flatnonzero(ids < 0)
    if not len(lone):
        return ids, owners
    parts = [pieces.byte_ids[np.frombuffer((_MARK if c == _LITERAL else chr(c)).encode("utf-8"), np.uint8)] for c in (-1 - ids[lone]).tolist()]
    n = np.ones(len(ids), np.int64)
    n[lone] = [len(p) for p in parts]
    out = np.repeat(ids, n)
    ends = np.cumsum(n)
    out[np.repeat(ends[lone] - n[lone], n[lone]) + np.arange(n[lone].sum()) - np.repeat(np.cumsum(n[lone]) - n[lone], n[lone])] = np.concatenate(parts)
    return out, np.repeat(owners, n)


def encode_sampled(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", seed: int = SEED, model: str = MODEL) -> DataFrame:
    """key_col, n_chars, n_pieces, pieces (array<int>) and lossless (the decoded pieces equal the text), a row per document."""
    kind = docs.schema[key_col].dataType.simpleString()
    source = docs.select(F.col(key_col), F.xxhash64(F.col(key_col)), F.col(text_col).cast("string"))

    def run(batches):
        store = Store(pieces_of(model))
        for whole in batches:
            for part in blocks(whole, 2, rows=192):
                texts = part.column(2).to_pylist()
                ids, counts = sample(store, part.column(1).to_numpy(), [t or "" for t in texts], seed)
                ends = np.cumsum(counts)
                null = pa.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()), mask=null)
                back, stops = store.pieces.decode_all(ids, ends)
                begins = np.concatenate([[0], stops[:-1]]).tolist()
                same = [None if t is None else back[a:b].tobytes() == t.encode() for t, a, b in zip(texts, begins, stops.tolist(), strict=True)]
                n = [None if t is None else len(t) for t in texts]
                m = [None if t is None else k for t, k in zip(texts, counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(m, pa.int64()), lists, pa.array(same, pa.bool_())], names=[key_col, "n_chars", "n_pieces", "pieces", "lossless"])

    return source.mapInArrow(run, f"`{key_col}` {kind}, n_chars long, n_pieces long, pieces array<int>, lossless boolean")


def decode_pieces(rows: DataFrame, key_col: str = "doc_id", model: str = MODEL) -> DataFrame:
    """key_col and text of rows with pieces; null pieces give a null text."""
    kind = rows.schema[key_col].dataType.simpleString()

    def run(batches):
        pieces = pieces_of(model)
        for batch in batches:
            texts = [None if p is None else pieces.decode(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key_col, "text"])

    return rows.select(key_col, "pieces").mapInArrow(run, f"`{key_col}` {kind}, text string")


def op3_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_sampled(table(spark, sf_dir, "documents"))
