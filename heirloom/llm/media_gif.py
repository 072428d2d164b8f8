"""Media columns: animated GIF as a container of 8-bit samples.

``encode`` writes GIF89a with LZW code streams; ``decode_frames`` reads any GIF:
LZW with clear codes anywhere, global and local palettes, interlacing; and
``composite`` applies transparency and disposal.  Code streams of many frames are
decoded at once: widths follow from a code's place after the last clear code, a
table entry is a stretch of the output already made, and so both the lengths of
entries and the samples come from doubling pointers into earlier output.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heirloom.llm.common import as_bytes, small_batches, trimmed
from heirloom.llm.kernels import ragged

SIDE = 24
FRAME = SIDE * SIDE
DELAY_CS = 4
#: A byte that no UTF-8 text and no filling holds: frames use it for samples that stay as they are.
SAME = 254
#: Samples of an image whose table keys and codes fit in 31 bits together.
_TOGETHER = 1700
#: Codes that are unpacked at once.
_CODES = 1 << 20
GRAY = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, axis=1)
BINS = 8


@dataclass
class Frame:
    """One image of a GIF as stored: its place, samples and timing."""

    x: int
    y: int
    width: int
    height: int
    samples: np.ndarray
    palette: np.ndarray | None = None
    delay_cs: int = 0
    disposal: int = 0
    transparent: int | None = None


def _widths(size: int, n: int) -> np.ndarray:
    """The bits of each of the ``n`` codes that follow a clear code."""
    entries = (1 << size) + 2 + np.arange(n)
    return np.clip(np.ceil(np.log2(entries)).astype(np.int64), size + 1, 12)


def _codes(samples: bytes, size: int) -> list[int]:
    """The code of each longest known string; clear codes where the table is full, an end code last."""
    clear = 1 << size
    out, table, free = [clear], {}, clear + 2
    if not samples:
        return [clear, clear + 1]
    held, put = samples[0], out.append
    for s in samples[1:]:
        key = held << 8 | s
        if key in table:
            held = table[key]
            continue
        put(held)
        table[key] = free
        free += 1
        if free == 4096:
            put(clear)
            table.clear()
            free = clear + 2
        held = s
    put(held)
    put(clear + 1)
    return out


def _codes_together(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of many images of one size, which no table outgrows, step by step through all; and the number of each.

    Every image has a table of hashed places that hold a string (code and sample) above the code of it.
    """
    n, count = rows.shape
    clear, slots = 1 << size, 1 << max(4, (4 * count - 1).bit_length() - 1)
    table = np.zeros(n * slots, np.int32)
    base = np.arange(n, dtype=np.int64) * slots
    out = np.empty((n, count + 2), np.int16)
    out[:, 0] = clear
    each = np.arange(n)
    made = np.ones(n, np.int64)
    held = rows[:, 0].astype(np.int32)
    for t in range(1, count):
        s = rows[:, t].astype(np.int32)
        key = (held << 8 | s) + 1
        place = (key * np.int32(0x9E35) >> 3) & (slots - 1)
        at = base + place
        found = table[at]
        missed = found >> 12 != key
        # Another string's place: look at the next ones.
        busy = np.nonzero(missed & (found != 0))[0]
        while len(busy):
            at[busy] = base[busy] + (at[busy] + 1 & (slots - 1))
            found[busy] = table[at[busy]]
            missed[busy] = found[busy] >> 12 != key[busy]
            busy = busy[missed[busy] & (found[busy] != 0)]
        new = np.nonzero(missed)[0]
        out[new, made[new]] = held[new]
        table[at[new]] = key[new] << 12 | (clear + 1 + made[new]).astype(np.int32)
        made[new] += 1
        held = np.where(missed, s, found & 4095)
    out[each, made] = held
    out[each, made + 1] = clear + 1
    made += 2
    return out[np.arange(count + 2) < made[:, None]].astype(np.int64), made


def lzw_encode(frames: list[bytes], size: int = 8) -> list[bytes]:
    """The LZW code streams of ``frames``, with variable code widths."""
    if not frames:
        return []
    count = len(frames[0])
    if 0 < count <= _TOGETHER and all(len(f) == count for f in frames):
        codes, sizes = _codes_together(np.frombuffer(b"".join(frames), np.uint8).reshape(-1, count), size)
        first = np.concatenate(([0], np.cumsum(sizes)))
    else:
        found = [_codes(f, size) for f in frames]
        first = np.cumsum([0] + [len(x) for x in found])
        codes = np.fromiter(chain.from_iterable(found), np.int64, int(first[-1]))
    clears = np.nonzero(codes == 1 << size)[0]
    run = np.diff(np.append(clears, len(codes)))
    place = np.arange(len(codes)) - np.repeat(clears, run)
    width = np.concatenate(([size + 1], _widths(size, int(run.max()) - 1)))[place]
    # A clear code within a stream comes where the table is full.
    width[clears[np.isin(clears, first, invert=True)]] = 12
    ends = np.cumsum(width)
    begin = np.concatenate(([0], ends))[first]
    n_bytes = -(-np.diff(begin) // 8)
    base = np.cumsum(n_bytes) - n_bytes
    bit = ends - width + np.repeat(8 * base - begin[:-1], np.diff(first))
    # Codes do not overlap; so many in turn do not begin in one byte.
    turns = -(-8 // (size + 1))
    out = np.zeros(int(n_bytes.sum()) + 3, np.uint8)
    spread, byte = codes << (bit & 7), bit >> 3
    for k in range(3):
        part = (spread >> 8 * k & 255).astype(np.uint8)
        for turn in range(turns):
            out[byte[turn::turns] + k] |= part[turn::turns]
    flat = out.tobytes()
    return [flat[a : a + n] for a, n in zip(base.tolist(), n_bytes.tolist(), strict=True)]


def lzw_decode(streams: list[bytes], size: int, count: int) -> np.ndarray:
    """``count`` samples of each LZW code stream, a row each; a broken stream ends early and is filled with 0."""
    out = np.zeros((len(streams), count), np.uint8)
    each = max(1, _CODES // (count + 2))
    for at in range(0, len(streams), each):
        _decode_some(streams[at : at + each], size, out[at : at + each])
    return out


def _decode_some(streams: list[bytes], size: int, out: np.ndarray) -> None:
    """All streams together, one stretch between clear codes after another."""
    clear, count = 1 << size, out.shape[1]
    raw = np.frombuffer(b"".join(streams) + b"\0\0\0", np.uint8)
    raw = raw[:-2] | raw[1:-1].astype(np.int32) << 8 | raw[2:].astype(np.int32) << 16
    n_bits = 8 * np.array([len(s) for s in streams], np.int64)
    base = np.cumsum(n_bits) - n_bits
    live, bit, made = np.arange(len(streams)), np.zeros(len(streams), np.int64), np.zeros(len(streams), np.int64)
    # A stretch has as many codes as its stream has room for, and as many as it may need samples.
    most = int(min(count + 2, n_bits.max(initial=0) // (size + 1) + 1))
    widths = _widths(size, most)
    offset = np.cumsum(widths) - widths
    # A code may name the entry that it completes itself, and no later one.
    entries = np.minimum(clear + 2 + np.arange(most), 4096)
    entries[0] = clear
    mask = ((1 << widths) - 1).astype(np.int32)
    while len(live):
        end = offset[-1] + widths[-1]
        if (bit[live] + end <= n_bits[live]).all():
            at = (base[live] + bit[live])[:, None] + offset
            code = raw[at >> 3] >> (at & 7).astype(np.int32) & mask
        else:
            fits = offset + widths <= (n_bits - bit)[live, None]
            at = np.where(fits, (base[live] + bit[live])[:, None] + offset, 0)
            code = np.where(fits, raw[at >> 3] >> (at & 7).astype(np.int32) & mask, clear + 1)
        stop = (code == clear) | (code == clear + 1) | (code >= entries)
        n = np.where(stop.any(axis=1), stop.argmax(axis=1), most)
        _expand(code, n, clear, live, made, out)
        at_stop = np.minimum(n, most - 1)
        again = (n < most) & (code[np.arange(len(live)), at_stop] == clear)
        bit[live] += offset[at_stop] + widths[at_stop]
        live = live[again & (made[live] < count) & (bit[live] < n_bits[live])]


def _expand(code: np.ndarray, n: np.ndarray, clear: int, live: np.ndarray, made: np.ndarray, out: np.ndarray) -> None:
    """Write the strings of the first ``n`` codes of each row of ``code`` after what its stream has made."""
    c = code[np.arange(code.shape[1]) < n[:, None]].astype(np.int32)
    if not len(c):
        return
    first = np.repeat((np.cumsum(n) - n).astype(np.int32), n)
    # Entry k is the string of code k and one sample more: lengths add up along the chain of codes.
    own = np.arange(len(c), dtype=np.int32)
    above = c >= clear + 2
    named = np.where(above, first + c - (clear + 2), own)
    parent, length = named, above.astype(np.int32)
    while (more := length[parent]).any():
        length = length + more
        parent = parent[parent]
    length += 1
    ends = np.cumsum(length, dtype=np.int32)
    start = ends - length
    # Each sample of such a string is an earlier sample of the output, and so on down to a code of one sample.
    shift = np.where(above, start - start[named], 0).astype(np.int32)
    place = np.arange(int(ends[-1]), dtype=np.int32)
    source = place - np.repeat(shift, length)
    while not ((further := source[source]) == source).all():
        source = further
    value = np.zeros(len(place), np.uint8)
    value[start[~above]] = c[~above]
    samples = value[source]
    # Rows may hold more than is asked for, or less.
    total = np.bincount(np.repeat(np.arange(len(n)), n), weights=length, minlength=len(n)).astype(np.int64)
    begin = np.cumsum(total) - total
    room = np.minimum(total, out.shape[1] - made[live])
    if (room == out.shape[1]).all() and (total == room).all() and len(live) == len(out):
        out[:] = samples.reshape(out.shape)
    else:
        flat = out.reshape(-1)
        flat[ragged(live * out.shape[1] + made[live], room)] = samples[ragged(begin, room)]
    made[live] += total


def _sub_blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(c)]) + c for c in (data[i : i + 255] for i in range(0, len(data), 255))) + b"\0"


def encode(width: int, height: int, palette: np.ndarray, frames: list[Frame], loop: int = 0) -> bytes:
    """A GIF89a file with LZW-compressed frames; palettes have 2, 4, ... or 256 colours."""
    out = bytearray(b"GIF89a" + struct.pack("<HHBBB", width, height, 0xF0 | (len(palette).bit_length() - 2), 0, 0))
    out += palette.astype(np.uint8).tobytes() + b"\x21\xff\x0bNETSCAPE2.0\x03\x01" + struct.pack("<H", loop) + b"\0"
    for f in frames:
        seen = f.transparent is not None
        out += b"\x21\xf9\x04" + struct.pack("<BHBB", f.disposal << 2 | seen, f.delay_cs, f.transparent or 0, 0)
        packed = 0 if f.palette is None else 0x80 | (len(f.palette).bit_length() - 2)
        out += b"\x2c" + struct.pack("<HHHHB", f.x, f.y, f.width, f.height, packed)
        colours = palette if f.palette is None else f.palette
        out += b"" if f.palette is None else f.palette.astype(np.uint8).tobytes()
        size = max(2, len(colours).bit_length() - 1)
        out += bytes([size]) + _sub_blocks(lzw_encode([f.samples.astype(np.uint8).tobytes()], size)[0])
    return bytes(out + b"\x3b")


HEADER = b"GIF89a" + struct.pack("<HHBBB", SIDE, SIDE, 0xF7, 0, 0) + GRAY.tobytes()


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """One GIF per payload, whose size is a multiple of 576: frames of 24 x 24 gray samples, 40 ms each, left in place.

    A sample that the frame before has at its place is stored as transparent, in frames without a sample ``SAME``.
    """
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, FRAME)
    counts = np.array([len(p) // FRAME for p in payloads], np.int64)
    first = np.cumsum(counts) - counts
    stored = samples.copy()
    if len(samples) > 1:
        stored[1:][samples[1:] == samples[:-1]] = SAME
    whole = (samples == SAME).any(axis=1)
    whole[first[counts > 0]] = True
    stored[whole] = samples[whole]
    streams = lzw_encode([x.tobytes() for x in stored])
    frame = []
    for data, opaque in zip(streams, whole.tolist(), strict=True):
        control = b"\x21\xf9\x04" + struct.pack("<BHBB", 1 << 2 | (not opaque), DELAY_CS, 0 if opaque else SAME, 0)
        frame.append(control + _IMAGE + _sub_blocks(data))
    return [HEADER + b"".join(frame[a : a + n]) + b"\x3b" for a, n in zip(first.tolist(), counts.tolist(), strict=True)]


_IMAGE = b"\x2c" + struct.pack("<HHHHB", 0, 0, SIDE, SIDE, 0) + b"\x08"


def parse(gif: bytes) -> tuple[int, int, np.ndarray | None, list[tuple[Frame, int, bytes, bool]]]:
    """Screen size, global palette, and of each image: its frame without samples, code size, code stream, interlacing."""
    width, height, packed, _, _ = struct.unpack_from("<HHBBB", gif, 6)
    at, table = 13, None
    if packed & 0x80:
        n = 2 << (packed & 7)
        table = np.frombuffer(gif, np.uint8, n * 3, at).reshape(n, 3)
        at += 3 * n
    images, control = [], (0, 0, None)
    while at < len(gif) and gif[at] != 0x3B:
        if gif[at] == 0x21:
            if gif[at + 1] == 0xF9:
                flags, delay, key = struct.unpack_from("<BHB", gif, at + 3)
                control = (delay, flags >> 2 & 7, key if flags & 1 else None)
            at += 2
            while gif[at]:
                at += gif[at] + 1
            at += 1
        elif gif[at] == 0x2C:
            x, y, w, h, packed = struct.unpack_from("<HHHHB", gif, at + 1)
            at, local = at + 10, None
            if packed & 0x80:
                n = 2 << (packed & 7)
                local = np.frombuffer(gif, np.uint8, n * 3, at).reshape(n, 3)
                at += 3 * n
            size, at, parts = gif[at], at + 1, []
            while gif[at]:
                parts.append(gif[at + 1 : at + 1 + gif[at]])
                at += gif[at] + 1
            at += 1
            frame = Frame(x, y, w, h, np.zeros(0, np.uint8), local, *control)
            images.append((frame, size, b"".join(parts), bool(packed & 0x40)))
            control = (0, 0, None)
        else:
            raise ValueError(f"not a GIF block: {gif[at]:#x} at {at}")
    return width, height, table, images


def decode_frames(gifs: list[bytes]) -> list[tuple[int, int, np.ndarray | None, list[Frame]]]:
    """Parsed GIFs with the samples of every frame."""
    parsed = [parse(g) for g in gifs]
    groups: dict[tuple[int, int], list[tuple[Frame, bytes, bool]]] = {}
    for _, _, _, images in parsed:
        for frame, size, data, laced in images:
            groups.setdefault((size, frame.width * frame.height), []).append((frame, data, laced))
    for (size, count), members in groups.items():
        for (frame, _, laced), row in zip(members, lzw_decode([d for _, d, _ in members], size, count), strict=True):
            frame.samples = row
            if laced:
                lines = [y for s, d in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(s, frame.height, d)]
                picture = np.empty((frame.height, frame.width), np.uint8)
                picture[lines] = row.reshape(frame.height, frame.width)
                frame.samples = picture.reshape(-1)
    return [(w, h, table, [f for f, *_ in images]) for w, h, table, images in parsed]


def composite(width: int, height: int, palette: np.ndarray | None, frames: list[Frame]) -> Iterator[np.ndarray]:
    """The RGBA canvas as each frame shows it, after disposal of the one before."""
    canvas = np.zeros((height, width, 4), np.uint8)
    common = _opaque(GRAY if palette is None else palette)
    for f in frames:
        kept = canvas.copy() if f.disposal == 3 else None
        colours = common if f.palette is None else _opaque(f.palette)
        index = f.samples.reshape(f.height, f.width)
        if len(colours) < 256:
            index = np.minimum(index, len(colours) - 1)
        area = canvas[f.y : f.y + f.height, f.x : f.x + f.width]
        if area.shape[:2] != index.shape:
            index = index[: area.shape[0], : area.shape[1]]
        if f.transparent is None:
            area[:] = colours[index]
        else:
            shown = index != f.transparent
            area[shown] = colours[index[shown]]
        yield canvas.copy()
        if f.disposal == 2:
            area[:] = 0
        elif kept is not None:
            canvas = kept


def _opaque(palette: np.ndarray) -> np.ndarray:
    return np.hstack([palette, np.full((len(palette), 1), 255, np.uint8)])


def histograms(canvases: np.ndarray) -> np.ndarray:
    """Of each canvas, counts of ``BINS`` equal ranges of red, then green, then blue, over the opaque pixels."""
    n = len(canvases)
    pixels = canvases.reshape(n, -1, 4)
    seen = pixels[..., 3] > 0
    first = np.arange(0, n * BINS, BINS, dtype=np.int32)[:, None]
    each = [first + (pixels[..., c] >> 5) for c in range(3)]
    every = seen.all()
    return np.hstack([np.bincount(x.reshape(-1) if every else x[seen], minlength=n * BINS).reshape(n, BINS) for x in each])


def _padded(blob: bytes) -> bytes:
    return blob + b"\xff" * (FRAME if not blob else -len(blob) % FRAME)


MEDIA = "doc_id long, n_bytes long, gif binary"


def to_media(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Store every text as a GIF: ``doc_id, n_bytes, gif``.

    The payload is the text's UTF-8 (null: empty), filled with bytes 255 up to a
    positive multiple of 576.  Other columns of the input are not read.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            blobs = as_bytes(batch.column("text"))
            gifs = encode_payloads([_padded(b) for b in blobs])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": pa.array([len(b) for b in blobs], pa.int64()), "gif": pa.array(gifs, pa.binary())})

    d = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(trimmed(store), MEDIA)


DECODED = MEDIA + ", width int, height int, samples binary, frames array<struct<start_cs:long,delay_cs:int,disposal:int,hist:array<int>>>"
_TIMED = pa.list_(pa.struct([("start_cs", pa.int64()), ("delay_cs", pa.int32()), ("disposal", pa.int32()), ("hist", pa.list_(pa.int32()))]))
#: Canvases held at once.
_SHOWN = 256


def _shown(width: int, height: int, palette: np.ndarray | None, frames: list[Frame]) -> Iterator[np.ndarray]:
    """The canvases of a GIF, some at a time."""
    held = []
    for canvas in composite(width, height, palette, frames):
        held.append(canvas)
        if len(held) == _SHOWN:
            yield np.stack(held)
            held = []
    if held:
        yield np.stack(held)


def _timed(frames: list[Frame], hists: np.ndarray) -> list[dict]:
    start, out = 0, []
    for f, h in zip(frames, hists.tolist(), strict=True):
        out.append({"start_cs": start, "delay_cs": f.delay_cs, "disposal": f.disposal, "hist": h})
        start += f.delay_cs
    return out


def decode_media(media: DataFrame) -> DataFrame:
    """Read the ``gif`` column back: size, the red of all pixels as shown, and the timed frames.

    ``frames`` has one entry per frame: its start, delay, disposal, and the
    counts of 8 ranges of red, green and blue on the canvas as shown.  A null GIF
    gives null columns; broken code streams end early, as viewers do; other bytes
    that are no GIF raise ``ValueError`` or ``struct.error``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "gif", 1 << 20):
            gifs = batch.column("gif").to_pylist()
            found = iter(decode_frames([g for g in gifs if g is not None]))
            rows: list[tuple] = []
            for g in gifs:
                if g is None:
                    rows.append((None,) * 4)
                    continue
                width, height, palette, frames = next(found)
                red, hists = [], [np.zeros((0, 3 * BINS), np.int64)]
                for canvases in _shown(width, height, palette, frames):
                    red.append(canvases[..., 0].tobytes())
                    hists.append(histograms(canvases))
                rows.append((width, height, b"".join(red), _timed(frames, np.concatenate(hists))))
            kinds = (pa.int32(), pa.int32(), pa.binary(), _TIMED)
            names = ("width", "height", "samples", "frames")
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in ("doc_id", "n_bytes", "gif")} | {n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return media.select("doc_id", "n_bytes", "gif").mapInArrow(trimmed(read), DECODED)


FRAMES = "doc_id long, frame_no int, start_cs long, delay_cs int, disposal int, rgb binary, hist array<long>"


def media_frames(media: DataFrame) -> DataFrame:
    """One row per timed frame as shown: its start, delay, disposal, RGB pixels and colour histogram."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "gif", 1 << 18):
            keep = [(d, g) for d, g in zip(batch.column("doc_id").to_pylist(), batch.column("gif").to_pylist(), strict=True) if g is not None]
            rows = []
            for (doc, _), (width, height, palette, frames) in zip(keep, decode_frames([g for _, g in keep]), strict=True):
                start = 0
                for i, (f, canvas) in enumerate(zip(frames, composite(width, height, palette, frames), strict=True)):
                    rows.append((doc, i, start, f.delay_cs, f.disposal, canvas[..., :3].tobytes(), histograms(canvas[None])[0].tolist()))
                    start += f.delay_cs
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in FRAMES.split(", ")])

    return media.select("doc_id", "gif").mapInArrow(trimmed(read), FRAMES)
