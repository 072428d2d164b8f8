"""MinHash near-dedup with HyperMinHash registers.

Each of 128 buckets keeps, of the smallest hash under its own permutation, the
count of leading zeros (6 bits) and the mantissa bits after the leading one (10
bits).  Documents with equal shingle sets are one class from the start.  Bands
of four registers find candidates; the registers in common, corrected for
chance collisions, estimate the Jaccard similarity; pairs that may reach the
threshold are confirmed on their full sets.

Bands are taken up in turns, 1, 1, 2, 4, 8, 16 of the 32.  A turn looks only at
buckets that hold documents of two components or more, so what an earlier turn
has linked is not compared again.  A large bucket is split into blocks, and
each pair of blocks is one group of bounded size; within a group, pairs are
tested only across components.  Two sets of similarity 0.8 share no band with
probability 5e-8, and fall below the floor of the estimates with 3e-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heirloom.cut import cut, gathered
from heirloom.llm import kernels as K
from heirloom.llm.common import as_bytes, column, small_batches, trim, trimmed
from heirloom.operators.components import connected_components

REGISTERS, BAND, MANTISSA = 128, 4, 10
BANDS = REGISTERS // BAND
TURNS = ([0], [1], [2, 3], [4, 5, 6, 7], list(range(8, 16)), list(range(16, 32)))
#: Representatives of a bucket that one block holds, and shingles that they have together.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21
#: Deviations below the threshold at which an estimate still leads to confirmation.
DEVIATIONS = 6
#: Ids that are broadcast at most (16 MB); beyond, texts are fetched by a shuffled join.
BROADCAST_IDS = 500_000
_MULTIPLY = K._splitmix(101, REGISTERS) | np.uint64(1)
_FLIP = K._splitmix(202, REGISTERS)
_SHINGLE = K._splitmix(303, 64) | np.uint64(1)


def shingle_sets(blobs: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles, A-Z read as a-z.

    A text of fewer words is one shingle; one without words has none.
    """
    w, counts = K.word_hashes(blobs, lower=True)
    n = len(w) - words + 1
    if n > 0:
        s = np.zeros(n, np.uint64)
        for k in range(words):
            s += w[k : k + n] * _SHINGLE[k]
        s = K.mix(s)
    out, at = [], 0
    for c in counts.tolist():
        if c >= words:
            out.append(np.unique(s[at : at + c - words + 1]))
        elif c:
            out.append(K.mix((w[at : at + c] * _SHINGLE[:c]).sum(keepdims=True) + np.uint64(c)))
        else:
            out.append(w[:0])
        at += c
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers of non-empty sets, one row of 16-bit numbers each."""
    h = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    low = np.empty((REGISTERS, len(sets)), np.uint64)
    for j in range(REGISTERS):
        low[j] = np.minimum.reduceat((h ^ _FLIP[j]) * _MULTIPLY[j], starts)
    x = low.T >> np.uint64(11)
    length = np.frexp(x.astype(np.float64))[1]
    lead = np.minimum(53 - length, 53).astype(np.uint64)
    bits = (x << lead >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    return (lead << np.uint64(MANTISSA) | bits).astype("<u2")


def chance(n: np.ndarray | float, m: np.ndarray | float) -> np.ndarray | float:
    """The expected share of registers on which two disjoint sets of these sizes agree."""
    ratio = np.minimum(n, m) / np.maximum(n, m)
    return 0.169919487159739 * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray | float, m: np.ndarray | float) -> np.ndarray:
    """Collision-corrected Jaccard estimates of registers ``a`` against each row of ``b``."""
    c = chance(n, m)
    return ((a == b).mean(axis=-1) - c) / (1 - c)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """``100 * |a & b| >= percent * |a | b|`` on sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


SIGNATURES = "doc_id long, text_hash long, n_shingles long, s1 long, s2 long, sig binary"


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """``doc_id, text_hash, n_shingles, s1, s2, sig``: set size, a 128-bit hash of the set, and the registers (null if empty)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sets = shingle_sets(as_bytes(batch.column("text")), words)
            full = [s for s in sets if len(s)]
            rows = iter(registers(full)) if full else iter(())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_hash": batch.column("text_hash"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "s1": pa.array(np.array([s.sum() for s in sets], np.uint64).view(np.int64)),
                    "s2": pa.array(np.array([K.mix(s).sum() for s in sets], np.uint64).view(np.int64)),
                    "sig": pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                }
            )

    narrow = docs.select(column(key).cast("long").alias("doc_id"), column(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    return narrow.mapInArrow(trimmed(sign), SIGNATURES)


#: Members from which on a group's memory is given back at its end.
_MANY = 256


def _tidy(find: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``find``, giving memory back after a large group: workers live on between tasks."""

    def run(t: pa.Table) -> pa.Table:
        try:
            return find(t)
        finally:
            if t.num_rows >= _MANY:
                trim()

    return run


class _Group:
    """The members of a bucket, or of a pair of its blocks."""

    def __init__(self, t: pa.Table, percent: int):
        packed = b"".join(t.column("sig").to_pylist())
        self.sig = np.frombuffer(packed, "<u2").reshape(-1, REGISTERS)
        self.bands = np.frombuffer(packed, "<u8").reshape(-1, BANDS)
        self.n, self.comp = t.column("n").to_numpy(), t.column("comp").to_numpy()
        self.band, self.percent = t.column("band")[0].as_py(), percent

    def fits(self, i: int, others: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Those of ``others`` to test with ``i``: of another component, of a fitting size, and in no earlier bucket with it."""
        m = self.n[others]
        others = others[(root[others] != root[i]) & (100 * np.minimum(m, self.n[i]) >= self.percent * np.maximum(m, self.n[i]))]
        if self.band and len(others):
            others = others[~(self.bands[others, : self.band] == self.bands[i, : self.band]).any(axis=1)]
        return others

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        return estimate(self.sig[i], self.sig[others], self.n[i], self.n[others])


def _partners(percent: int, floor: float):
    def find(t: pa.Table) -> pa.Table:
        """The members that may be similar to a member of another component."""
        g = _Group(t, percent)
        everyone = np.arange(len(g.n))
        keep = np.zeros(len(g.n), bool)
        for i in range(len(g.n) - 1):
            others = g.fits(i, everyone[i + 1 :], g.comp)
            if len(others):
                others = others[g.near(i, others) >= floor]
                keep[others] = True
                keep[i] |= len(others) > 0
        return t.filter(pa.array(keep))

    return _tidy(find)


def _confirm(percent: int, floor: float, words: int):
    def find(t: pa.Table) -> pa.Table:
        """Links between components of the group, enough to join all that are linked in it."""
        g = _Group(t, percent)
        sets = shingle_sets(as_bytes(t.column("text")), words)
        root, src, dst = g.comp.copy(), [], []

        def against(i: int, others: np.ndarray) -> None:
            near = g.near(i, others)
            for j in others[np.argsort(-near, kind="stable")][: int((near >= floor).sum())]:
                if root[i] != root[j] and similar(sets[i], sets[j], percent):
                    root[root == root[j]] = root[i]
                    src.append(int(g.comp[i]))
                    dst.append(int(g.comp[j]))

        everyone = np.arange(len(root))
        # First the member most like the others: in a group of copies of one text it links nearly all of them.
        hub = int((g.sig == np.sort(g.sig, axis=0)[len(root) // 2]).sum(axis=1).argmax())
        against(hub, g.fits(hub, everyone, root))
        for i in range(len(root) - 1):
            others = g.fits(i, everyone[i + 1 :], root)
            if len(others):
                against(i, others)
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return _tidy(find)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose word-shingle sets have Jaccard similarity of ``percent`` / 100 or more.

    Returns ``doc_id, n_shingles, component_id, kept`` for every row of ``docs``:
    the smallest key that the document reaches over links, and whether it is its
    own.  Documents without words (null or blank text) have no shingles and stand
    alone.  Rows with equal sets are linked, also rows that share a key; a null
    key reaches what its set reaches and is kept only if it stands alone.  Other
    columns of the input are not read.  An empty input gives an empty result.
    """
    narrow = docs.select(column(key).cast("long").alias("doc_id"), column(text).alias("text"))
    signed = cut(signatures(narrow, "doc_id", "text", words))
    reps = cut(
        signed.where("sig is not null and doc_id is not null")
        .groupBy("s1", "s2")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("of"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
        .select("s1", "s2", F.col("of.doc_id").alias("rep"), F.col("of.text_hash").alias("text_hash"), "sig", "n")
    )
    # Rows that share a key are told apart by their texts.
    state = reps.withColumn("comp", F.col("rep"))
    moved = None
    member = "key long, band int, rep long, text_hash long, n long, sig binary, comp long, pair string"
    floor = percent / 100 - DEVIATIONS * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5
    for turn in TURNS:
        keys = F.array(*[F.struct(F.xxhash64(F.substring("sig", 1 + 2 * BAND * b, 2 * BAND), F.lit(b)).alias("key"), F.lit(b).alias("band")) for b in turn])
        in_bucket = state.select("rep", "text_hash", "comp", "n", "sig", F.inline(keys))
        mixed = in_bucket.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum("n").alias("shingles")).where("lo <> hi")
        mixed, n_mixed = gathered(mixed.select("key", F.ceil(F.greatest(F.col("m") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
        if not n_mixed:
            continue
        if n_mixed <= BROADCAST_IDS:
            members = in_bucket.join(F.broadcast(mixed), "key")
        else:  # Registers are fetched for the members alone.
            members = in_bucket.select("key", "band", "rep", "text_hash").join(mixed, "key").join(state, ["rep", "text_hash"])
        mine = F.pmod(F.xxhash64("rep", "text_hash"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        paired = members.select("key", "band", "rep", "text_hash", "n", "sig", "comp", mine.alias("mine"), other.alias("other")).withColumn(
            "pair", F.concat_ws("-", F.least("mine", "other"), F.greatest("mine", "other"))
        )
        full = paired.drop("mine", "other")
        found = cut(full.groupBy("key", "pair").applyInArrow(_partners(percent, floor), member))
        need, n_need = gathered(found.select("rep", "text_hash").distinct())
        if not n_need:
            continue
        # Bounded: at most BROADCAST_IDS numbers, counted just above.
        wanted = F.broadcast(need) if n_need <= BROADCAST_IDS else need
        told = narrow.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("text_hash"), "text")
        texts = told.join(wanted, ["rep", "text_hash"]).dropDuplicates(["rep", "text_hash"])
        links = found.join(texts, ["rep", "text_hash"]).groupBy("key", "pair").applyInArrow(_confirm(percent, floor, words), "src long, dst long")
        links, n_links = gathered(links.distinct())
        if not n_links:
            continue
        to = connected_components(links).where("id <> component").select(F.col("id").alias("comp"), F.col("component").alias("_to"))
        if moved is not None:  # What was moved before goes on with the component that it was moved to.
            on = to.select(F.col("comp").alias("_to"), F.col("_to").alias("_on"))
            to = to.unionByName(moved.join(on, "_to", "left").select("comp", F.coalesce("_on", "_to").alias("_to")))
        moved, n_moved = gathered(to)
        step = F.broadcast(moved) if n_moved <= BROADCAST_IDS else moved
        state = reps.withColumn("comp", F.col("rep")).join(step, "comp", "left").select("s1", "s2", "rep", "text_hash", "n", "sig", F.coalesce("_to", "comp").alias("comp"))
    of_set = state.select("s1", "s2", "comp")
    component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.coalesce("comp", "doc_id"))
    out = signed.join(of_set, ["s1", "s2"], "left").select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
