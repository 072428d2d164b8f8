"""Suffix-array dedup of long repeated byte strings by prefix-free parsing.

Rolling-hash triggers cut every document into phrases: the trigger of a string
of ``length`` bytes is the smallest hash of its ``trigger``-byte strings, and a
phrase is a maximal run of such strings with one trigger.  Phrases overlap by
``length - 1`` bytes, so each string of ``length`` bytes lies in exactly one
phrase of its place and equal strings have equal triggers: as in prefix-free
parsing, the dictionary of distinct phrases holds every string that matters.

Phrases travel to the bucket of their trigger.  There the dictionary is sorted
by suffix (its suffixes of at least ``length`` bytes, to that depth), and the
parse, which is the earliest document of each phrase, is combined with it:
suffixes that agree in ``length`` bytes are neighbours in corpus order and share
their earliest document.  Triggers that occur in one document only are found
first, from hashes alone, and their phrases never travel.  The strings of a trigger
with very many distinct phrases (one line in many surroundings) travel one by one
as 128 bits of hashes, each to the bucket of its own hash, so that no bucket grows
with a trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from heirloom.llm import exchange as X
from heirloom.llm import kernels as K
from heirloom.llm.common import as_bytes, batches_of

NEVER = np.iinfo(np.int64).max
_BATCH = 1 << 20
#: Strings whose suffixes are sorted at once.
_SLAB = 1 << 17
#: Distinct phrases of one trigger beyond which its strings travel one by one.
HOT = 4096
#: A second random byte table, for a hash that is independent of the first.
_SECOND = K._splitmix(1234567, 256)


class Phrases:
    """The phrases of some documents in text order: trigger, hash, document, first string and number of strings."""

    def __init__(self, blobs: list[bytes], length: int, trigger: int):
        parts = [self._of(*p, length, trigger) for p in _pieces(blobs, length)]
        names = ("trigger", "hash", "doc", "start", "count")
        kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
        for i, (n, kind) in enumerate(zip(names, kinds, strict=True)):
            setattr(self, n, np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, kind))

    @staticmethod
    def _of(pieces: list[bytes], doc: np.ndarray, offset: np.ndarray, length: int, trigger: int) -> tuple[np.ndarray, ...]:
        buf = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces], np.int64)
        begin = np.cumsum(sizes) - sizes
        n = len(buf) - length + 1
        if n <= 0:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
        g = K.prefix_sums(K.TABLE[buf])
        _, ip = K.powers(len(buf))
        least = K.sliding_min(K.mix((g[trigger:] - g[:-trigger]) * ip[: len(buf) - trigger + 1]), length - trigger + 1)
        mark = np.zeros(n + 1, np.int8)
        long = sizes >= length
        mark[begin[long]] += 1
        mark[begin[long] + sizes[long] - length + 1] -= 1
        valid = np.cumsum(mark[:n], dtype=np.int8).astype(bool)
        differs = least[1:] != least[:-1]
        first, last = valid.copy(), valid.copy()
        first[1:] &= differs | ~valid[:-1]
        last[:-1] &= differs | ~valid[1:]
        s, e = np.nonzero(first)[0], np.nonzero(last)[0]
        piece = np.searchsorted(begin, s, "right") - 1
        # Minima are small: spread them anew, so that buckets of hash ranges are even.
        return K.mix(least[s]), K.span_hashes(g, s, e + length), doc[piece], s - begin[piece] + offset[piece], e - s + 1


def _pieces(blobs: list[bytes], length: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Batches of pieces of documents with their document and offset; pieces of a long one overlap by ``length - 1``."""
    pieces, doc, offset = [], [], []
    for i, b in enumerate(blobs):
        for at in range(0, max(1, len(b) - length + 1), _BATCH):
            pieces.append(b[at : at + _BATCH + length - 1] if len(b) > _BATCH else b)
            doc.append(i)
            offset.append(at)
    doc_of, offset_of = np.array(doc, np.int64), np.array(offset, np.int64)
    for lo, hi in batches_of(pieces, _BATCH):
        yield pieces[lo:hi], doc_of[lo:hi], offset_of[lo:hi]


def _ids(t: pa.Table, key: str) -> np.ndarray:
    return t.column(key).cast(pa.int64()).fill_null(NEVER).to_numpy()


def _triggers(p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct triggers, sorted, which of them occur in two documents or more, and the number of distinct phrases of each."""
    order = np.lexsort((p.hash, p.trigger))
    t, d, h = p.trigger[order], p.doc[order], p.hash[order]
    starts = K.group_starts(t)
    if not len(starts):
        return t, np.zeros(0, bool), np.zeros(0, np.int64)
    fresh = np.ones(len(t), np.int64)
    fresh[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[starts], np.maximum.reduceat(d, starts) > np.minimum.reduceat(d, starts), np.add.reduceat(fresh, starts)


def _chosen(p: Phrases, mail: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each phrase: whether it travels whole, and whether its strings travel one by one as its trigger is hot."""
    found, _, _ = _triggers(p)
    if not len(found):
        return np.zeros(0, bool), np.zeros(0, bool)
    twice, hot = (x[np.searchsorted(found, p.trigger)] for x in X.read_census(found, mail, buckets))
    return twice & ~hot, twice & hot


class _Strings:
    """The strings of hot phrases: two hashes each, and the distinct ones with their earliest document in the chunk."""

    def __init__(self, p: Phrases, hot: np.ndarray, blobs: list[bytes], ids: np.ndarray, length: int):
        self.runs = np.nonzero(hot)[0]
        n = p.count[self.runs]
        one, two, at = [], [], 0
        ends = np.cumsum(n + length - 1)
        while at < len(self.runs):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BATCH)))
            r = self.runs[at:end]
            sizes = p.count[r] + length - 1
            buf = np.frombuffer(b"".join(blobs[i][s : s + z] for i, s, z in zip(p.doc[r].tolist(), p.start[r].tolist(), sizes.tolist(), strict=True)), np.uint8)
            starts = K.ragged(np.cumsum(sizes) - sizes, p.count[r])
            for table, out in ((K.TABLE, one), (_SECOND, two)):
                out.append(K.span_hashes(K.prefix_sums(table[buf]), starts, starts + length))
            at = end
        none = np.zeros(0, np.uint64)
        h1, h2 = (np.concatenate(x) if x else none for x in (one, two))
        owner = np.repeat(ids[p.doc[self.runs]], n)
        order = np.lexsort((h2, h1))
        starts = K.group_starts(h1[order], h2[order])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        self.h1, self.h2 = h1[order][starts], h2[order][starts]
        self.owner = np.minimum.reduceat(owner[order], starts) if len(starts) else owner

    def ask(self, chunk: int, buckets: int) -> list[tuple[int, int, bytes]]:
        """Letters to buckets after those of the phrases; a size below 0 marks them."""
        return [(buckets + b, chunk, np.int64(lo - hi).tobytes() + X.pack_sorted(self.h1[lo:hi]) + self.h2[lo:hi].tobytes() + self.owner[lo:hi].tobytes()) for b, lo, hi in X.runs_by_bucket(self.h1, buckets)]

    def least(self, mail: dict[int, bytes], buckets: int) -> np.ndarray:
        """The earliest document of every string of the hot phrases, in text order of the runs."""
        out = np.zeros(len(self.h1), np.int64)
        for b, lo, hi in X.runs_by_bucket(self.h1, buckets):
            out[lo:hi] = np.frombuffer(mail[buckets + b], np.int64)
        return out[self.of]


def _earliest_strings(blobs: list[bytes]) -> list[bytes]:
    """The earliest document of each string, strings being equal if both hashes are."""
    sizes = [-int(np.frombuffer(b, np.int64, 1)[0]) for b in blobs]
    h1 = np.concatenate([X.unpack_sorted(b[8 : 8 + 8 * n], n) for b, n in zip(blobs, sizes, strict=True)])
    h2 = np.concatenate([np.frombuffer(b, np.uint64, n, 8 + 8 * n) for b, n in zip(blobs, sizes, strict=True)])
    owner = np.concatenate([np.frombuffer(b, np.int64, n, 8 + 16 * n) for b, n in zip(blobs, sizes, strict=True)])
    order = np.lexsort((h2, h1))
    starts = K.group_starts(h1[order], h2[order])
    owner[order] = np.repeat(np.minimum.reduceat(owner[order], starts), np.diff(np.append(starts, len(order))))
    return [x.tobytes() for x in np.split(owner, np.cumsum(sizes)[:-1])]


class _Distinct:
    """The distinct phrases of chosen ones, by trigger and hash, with their earliest document."""

    def __init__(self, p: Phrases, chosen: np.ndarray, ids: np.ndarray):
        self.runs = np.nonzero(chosen)[0]
        t, h = p.trigger[self.runs], p.hash[self.runs]
        order = np.lexsort((h, t))
        starts = K.group_starts(t[order], h[order])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        self.head = self.runs[order][starts]
        self.trigger = p.trigger[self.head]
        owner = ids[p.doc[self.runs]]
        self.owner = np.minimum.reduceat(owner[order], starts) if len(starts) else np.zeros(0, np.int64)


def _ask_phrases(p: Phrases, d: _Distinct, blobs: list[bytes], chunk: int, buckets: int, length: int) -> list[tuple[int, int, bytes]]:
    rows = []
    for b, lo, hi in X.runs_by_bucket(d.trigger, buckets):
        head = d.head[lo:hi]
        sizes = (p.count[head] + length - 1).astype(np.uint32)
        texts = b"".join(blobs[i][s : s + n] for i, s, n in zip(p.doc[head].tolist(), p.start[head].tolist(), sizes.tolist(), strict=True))
        rows.append((b, chunk, np.int64(hi - lo).tobytes() + X.pack_sorted(d.trigger[lo:hi]) + sizes.tobytes() + d.owner[lo:hi].tobytes() + texts))
    return rows


def suffix_order(buf: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The suffix array of the suffixes of ``buf`` at ``starts``, sorted by their first ``depth`` bytes."""
    rows = np.lib.stride_tricks.sliding_window_view(buf, depth)[starts]
    return np.argsort(np.ascontiguousarray(rows).view(f"S{depth}").reshape(-1), kind="stable")


def _combine(blobs: list[bytes], length: int) -> list[bytes]:
    """Sort the bucket's dictionary by suffix and give every phrase the earliest document of each of its strings."""
    if np.frombuffer(blobs[0], np.int64, 1)[0] < 0:
        return _earliest_strings(blobs)
    trigger, size, owner, texts, counts = [], [], [], [], []
    for b in blobs:
        n = int(np.frombuffer(b, np.int64, 1)[0])
        trigger.append(X.unpack_sorted(b[8 : 8 + 8 * n], n))
        size.append(np.frombuffer(b, np.uint32, n, 8 + 8 * n).astype(np.int64))
        owner.append(np.frombuffer(b, np.int64, n, 8 + 12 * n))
        texts.append(np.frombuffer(b, np.uint8, -1, 8 + 20 * n))
        counts.append(n)
    t, z, o, buf = (np.concatenate(x) for x in (trigger, size, owner, texts))
    begin = np.cumsum(z) - z
    h = np.empty(len(z), np.uint64)
    at = 0
    while at < len(z):  # hashed in batches: prefix sums take many times the bytes
        end = max(at + 1, int(np.searchsorted(begin, begin[at] + _BATCH)))
        part = slice(begin[at], begin[end - 1] + z[end - 1])
        h[at:end] = K.span_hashes(K.prefix_sums(K.TABLE[buf[part]]), begin[at:end] - begin[at], begin[at:end] - begin[at] + z[at:end])
        at = end
    order = np.lexsort((h, z, t))
    starts = K.group_starts(t[order], z[order], h[order])
    of = np.empty(len(order), np.int64)
    of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    phrase = order[starts]
    first = np.minimum.reduceat(o[order], starts)
    # A trigger with one distinct phrase needs no sorting: all its strings share their documents.
    heads = K.group_starts(t[phrase])
    family = np.diff(np.append(heads, len(phrase)))
    several = np.nonzero(np.repeat(family > 1, family))[0]
    strings = z[phrase[several]] - length + 1
    of_string = np.repeat(several, strings)
    place = K.ragged(begin[phrase[several]], strings)
    least = first[of_string]
    # Equal strings have one trigger, so the array is sorted in slabs of whole families.  A family has at most HOT
    # phrases, each of length - trigger + 1 strings but where a text repeats itself in less than that.
    family_of = np.repeat(np.cumsum(np.repeat(family > 1, family) & np.isin(np.arange(len(phrase)), heads))[several], strings)
    at = 0
    while at < len(place):
        end = min(at + _SLAB, len(place))
        end = int(np.searchsorted(family_of, family_of[end - 1], "right"))
        slab = place[at:end]
        array = suffix_order(buf, slab, length)
        fresh = np.ones(len(array), bool)
        for lo in range(1, len(array), _SLAB // 8):
            one, two = (np.lib.stride_tricks.sliding_window_view(buf, length)[slab[array[lo - k : lo - k + _SLAB // 8]]] for k in (0, 1))
            n = min(len(one), len(two))
            fresh[lo : lo + n] = (one[:n] != two[:n]).any(axis=1)
        begins = np.nonzero(fresh)[0]
        low = np.minimum.reduceat(least[at:end][array], begins)
        sorted_low = np.repeat(low, np.diff(np.append(begins, len(array))))
        least[at + array] = sorted_low
        at = end
    string_at = np.zeros(len(phrase) + 1, np.int64)
    np.add.at(string_at, several + 1, strings)
    string_at = np.cumsum(string_at)
    width = np.diff(string_at)
    if len(place):
        flat = np.nonzero(width)[0]
        lo, hi = np.minimum.reduceat(least, string_at[flat]), np.maximum.reduceat(least, string_at[flat])
        even = lo == hi
        first[flat[even]] = lo[even]
        width[flat[even]] = 0
    out, at = [], 0
    for n in counts:
        mine = of[at : at + n]
        varied = width[mine] > 0
        strings_of = K.ragged(string_at[mine[varied]], width[mine[varied]])
        out.append(np.packbits(varied).tobytes() + first[mine].tobytes() + (least[strings_of].tobytes() if len(strings_of) else b""))
        at += n
    return out


def _covered(p: Phrases, d: _Distinct, hot: _Strings, ids: np.ndarray, sizes: np.ndarray, mail: dict[int, bytes], buckets: int, length: int) -> np.ndarray:
    """A flag for every byte of the chunk's documents in order: it is in a string that an earlier document holds."""
    first, varied = np.zeros(len(d.trigger), np.int64), np.zeros(len(d.trigger), bool)
    rest = []
    for b, lo, hi in X.runs_by_bucket(d.trigger, buckets):
        n, m = hi - lo, -(-(hi - lo) // 8)
        varied[lo:hi] = np.unpackbits(np.frombuffer(mail[b], np.uint8, m), count=n)
        first[lo:hi] = np.frombuffer(mail[b], np.int64, n, m)
        rest.append(np.frombuffer(mail[b][m + 8 * n :], np.int64))
    each = np.concatenate(rest) if rest else np.zeros(0, np.int64)
    widths = np.where(varied, p.count[d.head], 0) if len(d.head) else np.zeros(0, np.int64)
    begin = np.cumsum(widths) - widths
    base = np.cumsum(sizes) - sizes
    runs, of = d.runs, d.of
    own = ids[p.doc[runs]]
    place = base[p.doc[runs]] + p.start[runs]
    whole = ~varied[of] & (first[of] < own)
    lo, hi = [place[whole]], [place[whole] + p.count[runs][whole] - 1 + length]
    mixed = varied[of]
    n = p.count[runs][mixed]
    values = each[K.ragged(begin[of[mixed]], n)] if len(n) else each[:0]
    strings = K.ragged(place[mixed], n)[values < np.repeat(own[mixed], n)] if len(n) else np.zeros(0, np.int64)
    alone = p.count[hot.runs]
    one_by_one = K.ragged(base[p.doc[hot.runs]] + p.start[hot.runs], alone)[hot.least(mail, buckets) < np.repeat(ids[p.doc[hot.runs]], alone)]
    for x in (strings, one_by_one):
        lo.append(x)
        hi.append(x + length)
    total = int(sizes.sum())
    # Counted in place: sums over a chunk in 64 bits would take many times its bytes.
    step = np.zeros(total + 1, np.int32)
    for places, by in ((lo, 1), (hi, -1)):
        for x in places:
            np.add.at(step, x, np.int32(by))
    np.cumsum(step, out=step)
    return step[:total] > 0


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, trigger: int = 16, carry: tuple[str, ...] = ("doc_id",), each: int = X.CHUNK, as_text: bool = False, hot: int = HOT
) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts in a document with a smaller key.

    Returns the columns ``carry`` of the input and ``n_bytes`` (of the text),
    ``kept`` (the remaining bytes; with ``as_text`` a string, without the parts
    of characters that were cut), ``span_start`` and ``span_len`` (the maximal
    removed runs), one row per row of ``docs``.  Strings are judged on the input;
    overlaps count; nothing matches across documents or within one.  A null text
    counts as empty, a null key as larger than all keys; rows that share a key
    do not remove each other's bytes.  Input columns of the result's names are
    replaced.  An empty input gives an empty result.
    """
    carry = X.result_names(carry, {"n_bytes", "kept", "span_start", "span_len"})
    d, buckets = X.chunked(docs, key, text, carry, each)

    def read(t: pa.Table) -> tuple[list[bytes], Phrases, np.ndarray, int]:
        blobs = as_bytes(t.column("text"))
        return blobs, Phrases(blobs, length, trigger), _ids(t, "key"), t.column("chunk")[0].as_py() if t.num_rows else -1

    def ask(t: pa.Table) -> list[tuple[int, int, bytes]]:
        _, p, _, chunk = read(t)
        return X.ask_census(*_triggers(p), chunk, buckets)

    def spell(t: pa.Table, mail: dict[int, bytes]) -> pa.Table:
        blobs, p, ids, chunk = read(t)
        whole, single = _chosen(p, mail, buckets)
        rows = _ask_phrases(p, _Distinct(p, whole, ids), blobs, chunk, buckets, length)
        return X.letters(rows + _Strings(p, single, blobs, ids, length).ask(chunk, buckets))

    def remove(t: pa.Table, mail: dict[int, bytes]) -> pa.Table:
        blobs, p, ids, _ = read(t)
        if mail:
            # The phrases asked about are those that the first answers chose.
            first, second = X.two_rounds(mail)
            whole, single = _chosen(p, first, buckets)
            sizes = np.array([len(b) for b in blobs], np.int64)
            flags = _covered(p, _Distinct(p, whole, ids), _Strings(p, single, blobs, ids, length), ids, sizes, second, buckets, length)
        else:
            flags = np.zeros(sum(map(len, blobs)), bool)
        kept, starts, lens, at = [], [], [], 0
        for b in blobs:
            f = flags[at : at + len(b)]
            at += len(b)
            if not f.any():
                kept.append(b)
                starts.append([])
                lens.append([])
                continue
            edge = np.diff(f.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
            s, e = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
            kept.append(np.frombuffer(b, np.uint8)[~f].tobytes())
            starts.append(s.tolist())
            lens.append((e - s).tolist())
        new = {
            "n_bytes": pa.array([len(b) for b in blobs], pa.int64()),
            "kept": pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
            "span_start": pa.array(starts, pa.list_(pa.int64())),
            "span_len": pa.array(lens, pa.list_(pa.int64())),
        }
        return pa.table({f"c{i}": t.column(f"c{i}") for i in range(len(carry))} | new)

    seen = X.answer(X.send(d, ask), lambda blobs: X.census(blobs, hot))
    spelled = X.answer(X.meet(d, seen, spell, X.LETTER), lambda blobs: _combine(blobs, length))
    schema = X.carried(docs, carry) + f"n_bytes long, kept {'string' if as_text else 'binary'}, span_start array<long>, span_len array<long>"
    return X.named(X.meet(d, X.both(seen, spelled), remove, schema), carry)
