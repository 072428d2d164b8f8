"""Sampled SentencePiece segmentation by forward filtering and backward sampling.

The lattice of a text holds every way to spell it with pieces of a public
vocabulary; a piece of rank r weighs 1 / (r + OFFSET) to the power ``sharpness``,
and a character that is no piece is spelled by its UTF-8 byte pieces.  Forward
filtering sums the weights of all spellings up to each place; backward sampling
draws pieces from the end by these sums.  Draws are a hash of the row key, the
segment's number and the step: the same row gives the same pieces everywhere.

No piece holds a space after another character, so the lattice falls apart into
segments that begin with spaces, and filtering is done once per distinct segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heirloom.llm import kernels as K
from heirloom.llm.common import batches_of, small_batches, trimmed

SPACE, NO_SPACE = 0x2581, 0x110000
OFFSET = 10.0
#: Bytes of code points whose lattices are held at once; a text beyond it is one batch.
_LATTICE = 1 << 19
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Vocabulary:
    """Pieces by the hash of their code points, and the ids of the byte pieces."""

    pieces: list[bytes]
    hashes: np.ndarray
    ids: np.ndarray
    logs: np.ndarray
    longest: int
    byte0: int

    def __post_init__(self) -> None:
        self.index = K.HashIndex(self.hashes)
        # One more entry for what is spelled by bytes.
        self.all_ids, self.all_logs = np.append(self.ids, np.int32(-1)), np.append(self.logs, 0.0)

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.hashes, self.ids, self.logs, self.longest, self.byte0)


def _values(c: np.ndarray) -> np.ndarray:
    return K.mix(c.astype(np.uint64) + np.uint64(31))


def load_vocabulary(path: str = DEFAULT_MODEL, sharpness: float = 1.0) -> Vocabulary:
    """Read a SentencePiece model file on the driver; the arrays travel to the executors with the query."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    byte0 = sp.piece_to_id("<0x00>")
    spelled, hashes, ids, ranks, longest = [], [], [], [], 1
    for i in range(n):
        if sp.is_byte(i):
            spelled.append(bytes([i - byte0]))
            continue
        piece = sp.id_to_piece(i)
        spelled.append(b"" if sp.is_control(i) or sp.is_unknown(i) else piece.replace("▁", " ").encode())
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        if "▁" in piece.lstrip("▁"):
            raise ValueError(f"a piece with a space after another character: {piece!r}")
        v = _values(np.frombuffer(piece.encode("utf-32-le"), np.uint32))
        hashes.append(K.window_hashes(v, len(v))[0])
        ids.append(i)
        ranks.append(max(0.0, -sp.get_score(i)))
        longest = max(longest, len(piece))
    h = np.array(hashes, np.uint64)
    order = np.argsort(h)
    logs = -sharpness * np.log(np.array(ranks)[order] + OFFSET)
    return Vocabulary(spelled, h[order], np.array(ids, np.int32)[order], logs, longest, byte0)


class _Lattice:
    """The lattices of distinct segments: edges sorted by end, with cumulative probabilities for drawing."""

    def __init__(self, v: Vocabulary, c: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """``c``: the code points of the segments one after another."""
        n = len(c)
        begin = np.cumsum(sizes) - sizes
        room = np.arange(1, n + 1) - np.repeat(begin, sizes)
        g = K.prefix_sums(_values(c))
        _, ip = K.powers(n + 1)
        # Row p, column k: the piece of k + 1 characters that ends at place p + 1, or -1; read row by row, edges come sorted by end.
        found = np.full((n, v.longest), -1, np.int32)
        end = np.arange(1, n + 1)
        for size in range(1, v.longest + 1):
            if size > n:
                break
            if 3 * len(end) > n:  # most places have room: hash them all in one sweep
                i = v.index.find(K.mix((g[size:] - g[:-size]) * ip[: n + 1 - size]))
                i[room[size - 1 :] < size] = -1
                found[size - 1 :, size - 1] = i
                end = end[room[end - 1] > size]
                continue
            if not len(end):
                break
            found[end - 1, size - 1] = v.index.find(K.mix((g[end] - g[end - size]) * ip[end - size]))
            end = end[room[end - 1] > size]
        # A character that is no piece is spelled by bytes, each lighter than the lightest piece.
        bare = np.nonzero(found[:, 0] < 0)[0]
        found[bare, 0] = len(v.ids)
        at, size = np.nonzero(found >= 0)
        i = found[at, size]
        self.end, self.start = at + 1, at - size
        self.id, log = v.all_ids[i], v.all_logs[i]
        spelled = np.nonzero(i == len(v.ids))[0]
        log[spelled] = (v.logs.min() - 1) * _utf8_sizes(c[at[spelled]])
        # alpha[p]: log weight of all spellings from the segment's start up to just before place p.
        alpha = np.zeros(n + 1)
        depth = room[at]
        # 16-bit keys sort by radix.
        by_depth = np.argsort(depth.astype(np.int16) if depth.max() < 1 << 15 else depth, kind="stable")
        by_place = np.concatenate(([0], np.cumsum(np.bincount(depth))))
        value = np.empty(len(log))
        # A segment's start shares its place with the end of the one before, whose sum is kept apart.
        first = size + 1 == depth
        for d in range(1, len(by_place) - 1):
            edges = by_depth[by_place[d] : by_place[d + 1]]
            value[edges] = log[edges] + np.where(first[edges], 0.0, alpha[self.start[edges]])
            groups = K.group_starts(self.end[edges])
            if len(groups):
                top = np.maximum.reduceat(value[edges], groups)
                width = np.diff(np.append(groups, len(edges)))
                total = np.add.reduceat(np.exp(value[edges] - np.repeat(top, width)), groups)
                alpha[self.end[edges][groups]] = top + np.log(total)
        chance = np.exp(value - alpha[self.end])
        groups = K.group_starts(self.end)
        run = np.cumsum(chance)
        width = np.diff(np.append(groups, len(run)))
        run -= np.repeat(run[groups] - chance[groups], width)
        run[np.append(groups[1:], len(run)) - 1] = 1.0
        #: The edge of a draw u at an end: the first of its edges with ladder > u, the last one having 1.
        self.ladder = run
        self.first_edge = np.zeros(n + 1, np.int64)
        self.first_edge[self.end[groups]] = groups
        self.first = first
        self.begin, self.sizes, self.c = begin, sizes, c


def _utf8_sizes(c: np.ndarray) -> np.ndarray:
    c = np.where(c == NO_SPACE, SPACE, c)
    return 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)


def _draws(seed: np.ndarray, number: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) from the row's seed, the segment's number in the row, and the step."""
    h = K.mix(seed + K.mix(number.astype(np.uint64) * np.uint64(64) + np.uint64(step % 64) + np.uint64(step // 64 << 40)))
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def _encode(v: Vocabulary, points: list[bytes], seeds: np.ndarray) -> list[np.ndarray]:
    sep = np.array([0x20], np.uint32).tobytes()
    sizes = np.array([len(p) // 4 for p in points], np.int64)
    # A space before each text that is not empty.
    c = np.frombuffer(b"".join(sep + p for p in points if p), np.uint32).copy()
    if not len(c):
        return [np.zeros(0, np.int32) for _ in points]
    c[c == SPACE] = NO_SPACE
    c[c == 0x20] = SPACE
    has = np.nonzero(sizes > 0)[0]
    begin = np.cumsum(sizes[has] + 1) - sizes[has] - 1
    cut = c == SPACE
    cut[1:] &= c[:-1] != SPACE
    cut[begin] = True
    s = np.nonzero(cut)[0]
    e = np.append(s[1:], len(c))
    h = K.span_hashes(K.prefix_sums(_values(c)), s, e)
    _, first, of = np.unique(h, return_index=True, return_inverse=True)
    n = (e - s)[first]
    lattice = _Lattice(v, c[K.ragged(s[first], n)], s[first], n)
    first_segment = np.searchsorted(s, begin)
    row = np.repeat(np.arange(len(begin)), np.diff(np.append(first_segment, len(s))))
    number = np.arange(len(s)) - first_segment[row]
    seed = seeds[has][row]
    # Backward sampling of all segments at once.
    at, live, step = (lattice.begin + lattice.sizes)[of], np.arange(len(s)), 0
    found_segment, found_edge = [], []
    while len(live):
        edge, u = lattice.first_edge[at[live]], _draws(seed[live], number[live], step)
        low = np.nonzero(lattice.ladder[edge] <= u)[0]
        while len(low):
            edge[low] += 1
            low = low[lattice.ladder[edge[low]] <= u[low]]
        found_segment.append(live)
        found_edge.append(edge)
        at[live] = lattice.start[edge]
        live = live[~lattice.first[edge]]
        step += 1
    segment, edge = np.concatenate(found_segment), np.concatenate(found_edge)
    order = np.lexsort((-np.arange(len(segment)), segment))
    segment, edge = segment[order], edge[order]
    ids = lattice.id[edge]
    width = np.ones(len(ids), np.int64)
    bare = np.nonzero(ids < 0)[0]
    chars = lattice.c[lattice.start[edge[bare]]]
    width[bare] = _utf8_sizes(chars)
    place = np.cumsum(width) - width
    out = np.empty(int(width.sum()), np.int32)
    plain = ids >= 0
    out[place[plain]] = ids[plain]
    for p, ch in zip(place[bare].tolist(), chars.tolist(), strict=True):
        spelled = chr(SPACE if ch == NO_SPACE else ch).encode()
        out[p : p + len(spelled)] = np.frombuffer(spelled, np.uint8) + np.int32(v.byte0)
    per_row = np.bincount(row[segment], weights=width, minlength=len(has)).astype(np.int64)
    rows = iter(np.split(out, np.cumsum(per_row)[:-1]))
    return [next(rows) if z else np.zeros(0, np.int32) for z in sizes.tolist()]


def sample_pieces(v: Vocabulary, texts: list[str | None], keys: list[int | None], seed: int = 0, held: int = _LATTICE) -> list[np.ndarray]:
    """Sampled piece ids of each text; a null or empty text has none, a null key draws as key 0."""
    blobs = [(t or "").encode("utf-32-le") for t in texts]
    seeds = K.mix(np.array([(k or 0) & ((1 << 64) - 1) for k in keys], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    out: list[np.ndarray] = []
    for lo, hi in batches_of(blobs, held):
        out += _encode(v, blobs[lo:hi], seeds[lo:hi])
    return out


def join_pieces(v: Vocabulary, ids: list[int]) -> str:
    """The text of piece ids: the inverse of every segmentation."""
    return b"".join(map(v.pieces.__getitem__, ids))[1:].decode()


def _encoded(v: Vocabulary, batch: pa.RecordBatch, seed: int, held: int = _LATTICE) -> pa.RecordBatch:
    found = sample_pieces(v, batch.column("text").to_pylist(), batch.column("doc_id").to_pylist(), seed, held)
    ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))], ["doc_id", "pieces"])


def _decoded(v: Vocabulary, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, 500):
        part = batch.slice(at, 500)
        lists = part.column("pieces")
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
        texts = [None if no else join_pieces(v, flat[a:b].tolist()) for a, b, no in zip(ends, ends[1:], lists.is_null().to_pylist(), strict=False)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("pieces"), pa.array(texts, pa.string())], ["doc_id", "pieces", "decoded"])


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def encode_documents(docs: DataFrame, v: Vocabulary, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """``doc_id`` and ``pieces``, the sampled ids, for every row; other columns are not read.

    A null or empty text has no pieces, and decodes to the empty text; rows that
    share a key and a text, or have no key and one text, draw alike.  Memory grows
    with the longest text, by some hundred bytes a character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _LATTICE):
            yield _encoded(v, batch, seed)

    return _keyed(docs, key, text).mapInArrow(trimmed(run), "doc_id long, pieces array<int>")


def decode_documents(encoded: DataFrame, v: Vocabulary) -> DataFrame:
    """``doc_id, pieces, decoded``: the text that the ids spell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _decoded(v, batch)

    return encoded.select("doc_id", "pieces").mapInArrow(trimmed(run), "doc_id long, pieces array<int>, decoded string")


def round_trip(docs: DataFrame, v: Vocabulary, key: str = "doc_id", text: str = "text", seed: int = 0, held: int = _LATTICE) -> DataFrame:
    """``encode_documents`` and ``decode_documents`` in one worker: half as many hold the vocabulary.

    Lattices of ``held`` bytes of code points are held at once; the pieces are the same for any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", held):
            yield from _decoded(v, _encoded(v, batch, seed, held))

    return _keyed(docs, key, text).mapInArrow(trimmed(run), "doc_id long, pieces array<int>, decoded string")
