"""Substring dedup on the De Bruijn graph of token k-mers.

Edges are the ``window``-word k-mers of all texts, nodes their (k-1)-mers.  As
in partitioned assemblers, each edge belongs to the bucket of its minimizer, the
smallest hash among its ``seed``-word strings; a maximal run of edges with one
minimizer is a piece of a path.  A first join of chunks with buckets finds the
minimizers that occur twice; only their pieces travel.  The second join brings
equal edges together: pieces walked alike everywhere stay whole (nonbranching),
others are split into edges, and each learns the source coordinates of its
earliest occurrence.  The third join takes these back to the documents, where
pieces whose sources continue one another compact into long repeated spans.

``unitigs`` compacts the repeated graph itself by joins with pointer doubling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.llm import exchange as X
from heirloom.llm import kernels as K
from heirloom.llm.common import WORD, as_bytes
from heirloom.llm.suffix_dedup import _ids

#: Distinct pieces of one minimizer beyond which its edges travel one by one.
HOT = 4096


class Pieces:
    """The pieces of paths in a chunk's texts: minimizer, hash, document, first edge and number of edges."""

    def __init__(self, blobs: list[bytes], window: int, seed: int):
        words, self.counts = K.word_hashes(blobs)
        self.edges = K.window_hashes(words, window)
        n = len(self.edges)
        base = np.cumsum(self.counts) - self.counts
        self.base = base
        if not n:
            self.minimizer = self.hash = np.zeros(0, np.uint64)
            self.doc = self.at = self.start = self.count = np.zeros(0, np.int64)
            return
        least = K.sliding_min(K.window_hashes(words, seed), window - seed + 1)
        mark = np.zeros(n + 1, np.int8)
        long = self.counts >= window
        np.add.at(mark, base[long], 1)
        np.add.at(mark, base[long] + self.counts[long] - window + 1, -1)
        valid = np.cumsum(mark[:n], dtype=np.int8).astype(bool)
        differs = least[1:] != least[:-1]
        first, last = valid.copy(), valid.copy()
        first[1:] &= differs | ~valid[:-1]
        last[:-1] &= differs | ~valid[1:]
        s, e = np.nonzero(first)[0], np.nonzero(last)[0]
        # Minima are small: spread them anew, so that buckets of hash ranges are even.
        self.minimizer = K.mix(least[s])
        self.hash = K.span_hashes(K.prefix_sums(self.edges), s, e + 1)
        self.doc = np.searchsorted(base, s, "right") - 1
        self.doc = self._skip_empty(self.doc, s)
        self.at, self.start, self.count = s, s - base[self.doc], e - s + 1

    def _skip_empty(self, doc: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Documents without words share the base of the next; take the one that has the edge."""
        owners = np.nonzero(self.counts > 0)[0]
        return owners[np.searchsorted(self.base[owners], s, "right") - 1]


def _minimizers(p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct minimizers, sorted, which of them have two pieces or a piece with a repeated edge, and the number of distinct pieces of each."""
    order = np.lexsort((p.hash, p.minimizer))
    t, h = p.minimizer[order], p.hash[order]
    starts = K.group_starts(t)
    if not len(t):
        return t, np.zeros(0, bool), np.zeros(0, np.int64)
    many = np.diff(np.append(starts, len(t))) > 1
    # A run longer than an edge has seed places may walk in a circle.
    loops = np.unique(p.minimizer[p.count > 1][_walks_twice(p.edges, p.at[p.count > 1], p.count[p.count > 1])])
    many |= np.isin(t[starts], loops, assume_unique=True)
    fresh = np.ones(len(t), np.int64)
    fresh[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[starts], many, np.add.reduceat(fresh, starts)


def _walks_twice(edges: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which runs of edges contain an edge twice."""
    run = np.repeat(np.arange(len(at)), count)
    e = edges[K.ragged(at, count)]
    order = np.lexsort((e, run))
    twice = np.zeros(len(at), bool)
    if len(e):
        same = (e[order][1:] == e[order][:-1]) & (run[order][1:] == run[order][:-1])
        twice[run[order][1:][same]] = True
    return twice


class _Edges:
    """The edges of pieces with a hot minimizer: the distinct ones with their earliest (document, start) in the chunk."""

    def __init__(self, p: Pieces, hot: np.ndarray, ids: np.ndarray):
        self.runs = np.nonzero(hot)[0]
        n = p.count[self.runs]
        self.place = K.ragged(p.at[self.runs], n)
        e, m = p.edges[self.place], np.repeat(p.minimizer[self.runs], n)
        doc, start = np.repeat(ids[p.doc[self.runs]], n), np.repeat(p.start[self.runs], n) + K.ragged(np.zeros(len(n), np.int64), n)
        order = np.lexsort((start, doc, m, e))
        starts = K.group_starts(e[order], m[order])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        head = order[starts]
        self.edge, self.minimizer, self.doc, self.start = e[head], m[head], doc[head], start[head]

    def ask(self, chunk: int, buckets: int) -> list[tuple[int, int, bytes]]:
        """Letters to buckets after those of the pieces; a size below 0 marks them."""
        return [
            (buckets + b, chunk, np.int64(lo - hi).tobytes() + X.pack_sorted(self.edge[lo:hi]) + self.minimizer[lo:hi].tobytes() + self.doc[lo:hi].tobytes() + self.start[lo:hi].astype(np.int64).tobytes())
            for b, lo, hi in X.runs_by_bucket(self.edge, buckets)
        ]

    def sources(self, mail: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all these edges, and the source document and start of each."""
        doc, start = np.zeros(len(self.edge), np.int64), np.zeros(len(self.edge), np.int64)
        for b, lo, hi in X.runs_by_bucket(self.edge, buckets):
            doc[lo:hi], start[lo:hi] = np.frombuffer(mail[buckets + b], np.int64).reshape(2, -1)
        return self.place, doc[self.of], start[self.of]


def _earliest_edges(blobs: list[bytes]) -> list[bytes]:
    """The source of each edge asked about one by one."""
    sizes = [-int(np.frombuffer(b, np.int64, 1)[0]) for b in blobs]
    e = np.concatenate([X.unpack_sorted(b[8 : 8 + 8 * n], n) for b, n in zip(blobs, sizes, strict=True)])
    m, doc, start = (np.concatenate([np.frombuffer(b, kind, n, 8 + 8 * n * k) for b, n in zip(blobs, sizes, strict=True)]) for k, kind in ((1, np.uint64), (2, np.int64), (3, np.int64)))
    order = np.lexsort((start, doc, m, e))
    starts = K.group_starts(e[order], m[order])
    width = np.diff(np.append(starts, len(order)))
    doc[order], start[order] = np.repeat(doc[order][starts], width), np.repeat(start[order][starts], width)
    cuts = np.cumsum(sizes)[:-1]
    return [a.tobytes() + b.tobytes() for a, b in zip(np.split(doc, cuts), np.split(start, cuts), strict=True)]


class _Distinct:
    """The distinct pieces of chosen ones, each with its earliest (document, start) in the chunk."""

    def __init__(self, p: Pieces, chosen: np.ndarray, ids: np.ndarray):
        self.runs = np.nonzero(chosen)[0]
        t, h, n = p.minimizer[self.runs], p.hash[self.runs], p.count[self.runs]
        order = np.lexsort((p.start[self.runs], ids[p.doc[self.runs]], h, n, t))
        starts = K.group_starts(t[order], n[order], h[order])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        self.head = self.runs[order][starts]
        self.minimizer = p.minimizer[self.head]


def _spell(p: Pieces, d: _Distinct, ids: np.ndarray, chunk: int, buckets: int) -> list[tuple[int, int, bytes]]:
    rows = []
    for b, lo, hi in X.runs_by_bucket(d.minimizer, buckets):
        head = d.head[lo:hi]
        edges = p.edges[K.ragged(p.at[head], p.count[head])]
        blob = np.int64(hi - lo).tobytes() + X.pack_sorted(d.minimizer[lo:hi]) + p.count[head].astype(np.uint32).tobytes() + ids[p.doc[head]].tobytes() + p.start[head].astype(np.int64).tobytes() + edges.tobytes()
        rows.append((b, chunk, blob))
    return rows


def _earliest(blobs: list[bytes]) -> list[bytes]:
    """For each piece asked about, the source of its first edge, or of each edge where pieces differ."""
    if np.frombuffer(blobs[0], np.int64, 1)[0] < 0:
        return _earliest_edges(blobs)
    parts: list[list[np.ndarray]] = [[] for _ in range(5)]
    sizes = []
    for b in blobs:
        n = int(np.frombuffer(b, np.int64, 1)[0])
        at = 8
        parts[0].append(X.unpack_sorted(b[at : at + 8 * n], n))
        at += 8 * n
        for k, (kind, width) in enumerate(((np.uint32, 4), (np.int64, 8), (np.int64, 8)), 1):
            parts[k].append(np.frombuffer(b, kind, n, at).astype(np.int64))
            at += width * n
        parts[4].append(np.frombuffer(b, np.uint64, -1, at))
        sizes.append(n)
    t, count, doc, start, edges = (np.concatenate(x) for x in parts)
    begin = np.cumsum(count) - count
    h = K.span_hashes(K.prefix_sums(edges), begin, begin + count)
    order = np.lexsort((start, doc, h, count, t))
    starts = K.group_starts(t[order], count[order], h[order])
    of = np.empty(len(order), np.int64)
    of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    piece = order[starts]
    heads = K.group_starts(t[piece])
    family = np.diff(np.append(heads, len(piece)))
    branching = np.repeat(family > 1, family) | _walks_twice(edges, begin[piece], count[piece])
    several = np.nonzero(branching)[0]
    n = count[piece[several]]
    step = K.ragged(np.zeros(len(n), np.int64), n)
    e, m = edges[K.ragged(begin[piece[several]], n)], np.repeat(t[piece[several]], n)
    ed, es = np.repeat(doc[piece[several]], n), np.repeat(start[piece[several]], n) + step
    if len(e):
        o = np.lexsort((es, ed, e, m))
        g = K.group_starts(m[o], e[o])
        width = np.diff(np.append(g, len(o)))
        ed[o], es[o] = np.repeat(ed[o][g], width), np.repeat(es[o][g], width)
    at_of = np.zeros(len(piece) + 1, np.int64)
    at_of[several + 1] = n
    at_of = np.cumsum(at_of)
    out, at = [], 0
    for z in sizes:
        mine = of[at : at + z]
        split = branching[mine]
        where = K.ragged(at_of[mine[split]], count[piece[mine[split]]])
        out.append(np.packbits(split).tobytes() + doc[piece[mine]].tobytes() + start[piece[mine]].tobytes() + np.concatenate((ed[where], es[where])).tobytes())
        at += z
    return out


def _sources(p: Pieces, d: _Distinct, mail: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all chosen edges in the chunk, and the source document and start of each."""
    n = len(d.minimizer)
    doc, start, split = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    docs, starts = [], []
    for b, lo, hi in X.runs_by_bucket(d.minimizer, buckets):
        z, m = hi - lo, -(-(hi - lo) // 8)
        split[lo:hi] = np.unpackbits(np.frombuffer(mail[b], np.uint8, m), count=z)
        doc[lo:hi] = np.frombuffer(mail[b], np.int64, z, m)
        start[lo:hi] = np.frombuffer(mail[b], np.int64, z, m + 8 * z)
        rest = np.frombuffer(mail[b][m + 16 * z :], np.int64)
        docs.append(rest[: len(rest) // 2])
        starts.append(rest[len(rest) // 2 :])
    none = np.zeros(0, np.int64)
    each_doc, each_start = (np.concatenate(x) if x else none for x in (docs, starts))
    width = np.where(split, p.count[d.head], 0)
    begin = np.cumsum(width) - width
    runs, of = d.runs, d.of
    count = p.count[runs]
    place = K.ragged(p.at[runs], count)
    step = K.ragged(np.zeros(len(runs), np.int64), count)
    src_doc, src_start = np.repeat(doc[of], count), np.repeat(start[of], count) + step
    varied = np.repeat(split[of], count)
    look = K.ragged(begin[of[split[of]]], count[split[of]])
    src_doc[varied], src_start[varied] = each_doc[look], each_start[look]
    return place, src_doc, src_start


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, seed: int = 5, carry: tuple[str, ...] = ("doc_id",), each: int = X.CHUNK, hot: int = HOT
) -> DataFrame:
    """Remove every word covered by a ``window``-word string that also starts earlier.

    Earlier is a smaller key, or the same document at a smaller word.  Returns
    the columns ``carry`` and ``n_words``, ``n_removed``, ``kept`` (the remaining
    words joined by one space, UTF-8) and ``spans``: the repeated paths, each with
    its first word, number of edges, and the coordinates of its source.  Windows
    are judged on the input and never cross documents.  A null text has no words;
    a null key counts as larger than all keys.  Rows that share a key count as
    one document whose starts coincide: the same window at the same start is no
    earlier one.  Input columns of the result's names are replaced.
    """
    carry = X.result_names(carry, {"n_words", "n_removed", "kept", "spans"})
    d, buckets = X.chunked(docs, key, text, carry, each)

    def read(t: pa.Table) -> tuple[list[bytes], Pieces, np.ndarray, int]:
        blobs = as_bytes(t.column("text"))
        return blobs, Pieces(blobs, window, seed), _ids(t, "key"), t.column("chunk")[0].as_py() if t.num_rows else -1

    def chosen(p: Pieces, mail: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each piece: whether it travels whole, and whether its edges travel one by one."""
        found, _, _ = _minimizers(p)
        if not len(found):
            return np.zeros(0, bool), np.zeros(0, bool)
        twice, many = (x[np.searchsorted(found, p.minimizer)] for x in X.read_census(found, mail, buckets))
        return twice & ~many, twice & many

    def ask(t: pa.Table) -> list[tuple[int, int, bytes]]:
        _, p, _, chunk = read(t)
        return X.ask_census(*_minimizers(p), chunk, buckets)

    def spell(t: pa.Table, mail: dict[int, bytes]) -> pa.Table:
        _, p, ids, chunk = read(t)
        whole, single = chosen(p, mail)
        return X.letters(_spell(p, _Distinct(p, whole, ids), ids, chunk, buckets) + _Edges(p, single, ids).ask(chunk, buckets))

    def remove(t: pa.Table, mail: dict[int, bytes]) -> pa.Table:
        blobs, p, ids, _ = read(t)
        total = int(p.counts.sum())
        gone = np.zeros(total, bool)
        spans: list[list[dict]] = [[] for _ in blobs]
        if mail and len(p.minimizer):
            first, second = X.two_rounds(mail)
            whole, single = chosen(p, first)
            sources = (_sources(p, _Distinct(p, whole, ids), second, buckets), _Edges(p, single, ids).sources(second, buckets))
            place, src_doc, src_start = (np.concatenate(x) for x in zip(*sources, strict=True))
            order = np.argsort(place, kind="stable")
            place, src_doc, src_start = place[order], src_doc[order], src_start[order]
            owners = np.nonzero(p.counts > 0)[0]
            own = owners[np.searchsorted(p.base[owners], place, "right") - 1]
            again = (src_doc != ids[own]) | (src_start != place - p.base[own])
            place, src_doc, src_start, own = place[again], src_doc[again], src_start[again], own[again]
            step = np.bincount(place, minlength=total + 1) - np.bincount(place + window, minlength=total + 1)
            gone = np.cumsum(step)[:total] > 0
            # Edges whose sources continue one another are one path.
            heads = np.ones(len(place), bool)
            heads[1:] = (place[1:] != place[:-1] + 1) | (src_doc[1:] != src_doc[:-1]) | (src_start[1:] != src_start[:-1] + 1) | (own[1:] != own[:-1])
            at = np.nonzero(heads)[0]
            for i, n in zip(at.tolist(), np.diff(np.append(at, len(place))).tolist(), strict=True):
                source = None if src_doc[i] == np.iinfo(np.int64).max else int(src_doc[i])
                spans[own[i]].append({"word": int(place[i] - p.base[own[i]]), "edges": n, "src_key": source, "src_word": int(src_start[i])})
        kept, removed = [], []
        for b, base, n in zip(blobs, p.base.tolist(), p.counts.tolist(), strict=True):
            f = gone[base : base + n]
            words = b.split()
            removed.append(int(f.sum()))
            kept.append(b" ".join(w for w, x in zip(words, f.tolist(), strict=True) if not x) if removed[-1] else b" ".join(words))
        kind = pa.list_(pa.struct([("word", pa.int64()), ("edges", pa.int64()), ("src_key", pa.int64()), ("src_word", pa.int64())]))
        new = {"n_words": pa.array(p.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, kind)}
        return pa.table({f"c{i}": t.column(f"c{i}") for i in range(len(carry))} | new)

    seen = X.answer(X.send(d, ask), lambda blobs: X.census(blobs, hot))
    spelled = X.answer(X.meet(d, seen, spell, X.LETTER), _earliest)
    schema = X.carried(docs, carry) + "n_words long, n_removed long, kept binary, spans array<struct<word:long,edges:long,src_key:long,src_word:long>>"
    return X.named(X.meet(d, X.both(seen, spelled), remove, schema), carry)


def unitigs(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 20, times: int = 2, max_rounds: int = 40) -> DataFrame:
    """The maximal nonbranching paths of k-mers that occur ``times`` times or more.

    Returns ``words`` (the path's token sequence), ``edges``, ``occurrences`` of
    its rarest edge, and ``src_key, src_word``, where it first occurs.  Pure
    DataFrame joins: edges are counted, nodes with one edge in and one out link
    their edges, and pointer doubling finds each edge's path start and its place
    on the path.  A circle starts at its smallest edge.  The words are read from
    the source coordinates of each edge, which also verifies the path.
    """
    tokens = docs.select(F.col(key).alias("k"), F.expr(f"regexp_extract_all({text}, '{WORD}', 0)".replace("\\", "\\\\")).alias("w"))
    spots = tokens.where(F.size("w") >= k).select("k", "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("p"))
    edge = spots.select("k", "p", F.slice("w", F.col("p") + 1, k).alias("e"))
    counted = edge.groupBy("e").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "p")).alias("src")).where(F.col("n") >= times)
    graph = cut(counted.select(F.xxhash64("e").alias("id"), "e", "n", "src", F.xxhash64(F.slice("e", 1, k - 1)).alias("tail"), F.xxhash64(F.slice("e", 2, k - 1)).alias("head")))
    inside = graph.groupBy(F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("out"), F.min("id").alias("next")).where("out = 1")
    into = graph.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("in"), F.min("id").alias("prev")).where("in = 1")
    back = inside.join(into, "node").where("next <> prev").select(F.col("next").alias("id"), "prev")
    # (jump, hops, low): the edge reached going back, how far, and the smallest edge on the way.
    state = cut(graph.select("id").join(back, "id", "left").select("id", F.coalesce("prev", "id").alias("jump"), F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long").alias("hops"), F.least("id", F.coalesce("prev", "id")).alias("low")))
    for _ in range(max_rounds):
        there = state.select(F.col("id").alias("jump"), F.col("jump").alias("j2"), F.col("hops").alias("h2"), F.col("low").alias("l2"))
        step = cut(state.join(there, "jump").select("id", F.col("j2").alias("jump"), (F.col("hops") + F.col("h2")).alias("hops"), F.least("low", "l2").alias("low"), (F.col("h2") > 0).alias("moved")))
        moving = step.where("moved")
        n_moving, n_edges = moving.count(), graph.count()
        state = step.drop("moved")
        if not n_moving or (1 << _) > n_edges:
            break
    # What still jumps is a circle: it has no start, so its smallest edge is made one.
    ends = state.join(back.select(F.col("id").alias("jump"), F.lit(True).alias("loop")), "jump", "left")
    path = F.when(F.col("loop"), F.col("low")).otherwise(F.col("jump"))
    placed = ends.select("id", path.alias("path"), F.col("loop").isNotNull().alias("loop"), "hops").join(graph, "id")
    line = placed.where("not loop").groupBy("path").agg(
        F.count(F.lit(1)).alias("edges"), F.min("n").alias("occurrences"), F.min_by("e", "hops").alias("first"), F.array_sort(F.collect_list(F.struct("hops", F.element_at("e", -1).alias("last")))).alias("rest"), F.min_by("src", "hops").alias("src")
    )
    lines = line.select(F.concat(F.slice("first", 1, k - 1), F.transform("rest", lambda r: r["last"])).alias("words"), "edges", "occurrences", F.col("src.k").alias("src_key"), F.col("src.p").alias("src_word"))
    circles = placed.where("loop").select(F.col("e").alias("words"), F.lit(1).cast("long").alias("edges"), F.col("n").alias("occurrences"), F.col("src.k").alias("src_key"), F.col("src.p").alias("src_word"))
    return lines.unionByName(circles)
