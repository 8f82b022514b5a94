"""Media columns: GIF.

``decode`` parses a GIF (87a or 89a): LZW code streams, local and global palettes,
interlacing, transparency, disposal (keep, restore to background, restore to previous),
delays and the loop count; it gives timed frames composed on the canvas, as RGBA samples,
with colour histograms.  ``encode`` writes palette images, LZW-compressed.  ``pack`` stores
bytes losslessly as 8-bit palette samples and ``unpack`` reads them back from the stored GIF.

LZW decoding is vectorised: every table entry is a substring of the output that starts
where the code before it starts, so each output byte names an earlier output byte, and
those references are resolved by pointer jumping; the codes' widths between two clear
codes follow from their position alone.

A broken or truncated stream, one with a canvas or image of more than ``MOST_CANVAS`` pixels or
with more than ``MOST_PIXELS`` in all images raises ValueError in ``parse``; ``frames`` and ``digest`` give
such a GIF one row with its ``status`` (``ok``, ``null`` or the error) and nulls.  Equal inputs give
equal outputs, so repeated rows do too.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_CANVAS, MOST_PIXELS = 1 << 26, 1 << 30  # pixels of a canvas or image; of a GIF's images in all
UNIT = 192  # a payload's bytes are a multiple of it, and a packed frame's width


# ---------------------------------------------------------------- LZW


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """GIF's LZW: codes of bits + 1 to 12 bits, a clear code when the table is full."""
    clear, end = 1 << bits, (1 << bits) + 1
    codes, marks = [clear], [0]  # marks: positions at which the table restarts
    table: dict[int, int] = {}
    nxt, get, add = end + 1, table.get, codes.append
    if data:
        cur = data[0]
        for b in data[1:]:
            key = cur << 8 | b
            found = get(key)
            if found is not None:
                cur = found
                continue
            add(cur)
            if nxt < 4096:
                table[key] = nxt
                nxt += 1
            else:
                add(clear)
                marks.append(len(codes) - 1)
                table.clear()
                nxt = end + 1
            cur = b
        add(cur)
    add(end)
    return _written(np.array(codes, np.uint32), marks, bits)


def lzw_encode_pairs(data: bytes, bits: int = 8, taught: int = 768) -> bytes:
    """A valid LZW stream, vectorised: the first ``taught`` bytes as single codes, which fill
    the table with pairs; from then on pairs in the table are one code, other bytes their own.
    The table is never cleared."""
    end = (1 << bits) + 1
    d = np.frombuffer(data, np.uint8).astype(np.int64)
    head, rest = d[:taught], d[taught:]
    table = np.full(1 << 16, -1)
    if len(rest) > 1:
        pairs = head[:-1] << 8 | head[1:]
        table[pairs[::-1]] = end + 1 + np.arange(len(pairs))[::-1]
        found = np.append(table[rest[:-1] << 8 | rest[1:]], -1)
        has = found >= 0
        # In a run of positions with a pair every other one is taken.
        at = np.arange(len(rest))
        run = np.maximum.accumulate(np.where(has & ~np.append(False, has[:-1]), at, 0))
        take = has & ((at - run) % 2 == 0)
        covered = np.append(False, take[:-1])
        rest = np.where(take, found, rest)[~covered]
    codes = np.concatenate([[1 << bits], head, rest, [end]]).astype(np.uint32)
    return _written(codes, [0], bits)


@lru_cache(64)
def _widths(bits: int, n: int) -> np.ndarray:
    """Widths of the first n codes after a clear code."""
    size = np.minimum((1 << bits) + 1 + np.arange(n), 4095)
    return np.maximum(bits + 1, np.floor(np.log2(size)).astype(np.int64) + 1)


def _written(out: np.ndarray, marks: list[int], bits: int) -> bytes:
    """Codes as a bit stream; marks: where the clear codes are, the first at 0.
    A clear code has the width of the table it ends."""
    width = np.empty(len(out), np.int64)
    for a, b in zip(marks, [*marks[1:], len(out)]):
        width[a + 1 : b] = _spread(bits, b - a - 1)
        if b < len(out):
            width[b] = _spread(bits, b - a)[-1]
    width[0] = bits + 1
    stop = np.cumsum(width)
    start = stop - width
    total = int(stop[-1])
    stream = np.zeros(total + (-total) % 8, np.uint8)
    for k in range(int(width.max())):
        own = slice(None) if k <= bits else np.flatnonzero(width > k)
        stream[start[own] + k] = out[own] >> k & 1
    return np.packbits(stream, bitorder="little").tobytes()


def _spread(bits: int, n: int) -> np.ndarray:
    base = _widths(bits, 4096)
    return base[:n] if n <= 4096 else np.append(base, np.full(n - 4096, 12))


def lzw_decode(stream: bytes, bits: int, most: int) -> bytes:
    """At most ``most`` bytes; codes past them are ignored, as are bytes past the end code."""
    clear, end = 1 << bits, (1 << bits) + 1
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    words = raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16
    at, limit, made = 0, len(stream) * 8, 0
    parts: list[np.ndarray] = []
    ended = False
    while not ended and made < most and at + bits + 1 <= limit:
        n = min(8192, (limit - at) // (bits + 1) + 1)
        while True:  # codes up to the next clear or end code; a full table may go on for long
            widths = _spread(bits, n)
            stop = np.cumsum(widths) + at
            keep = int(np.searchsorted(stop, limit, side="right"))
            pos = (stop - widths)[:keep]
            codes = (words[pos >> 3] >> (pos & 7).astype(np.uint32) & ((1 << widths[:keep]) - 1).astype(np.uint32)).astype(np.int64)
            marks = np.flatnonzero((codes == clear) | (codes == end))
            if len(marks) or keep < n:
                break
            n *= 2
        if len(marks):
            k = int(marks[0])
            ended = codes[k] == end
            at = int(stop[k])
            codes = codes[:k]
        else:
            at = limit
        if not len(codes):
            continue
        # A code gives a byte at least, so that no more of them are looked at than bytes are wanted.
        codes = codes[: most - made]
        entry = codes - end - 1  # a code's table entry: made after that code number
        index = np.arange(len(codes))
        if (entry >= index).any() or codes[0] > end:
            raise ValueError("a code that isn't in the table yet")
        # Lengths along the chains of entries, by pointer jumping.
        link, length = np.where(entry >= 0, entry, -1), np.ones(len(codes), np.int64)
        while (live := np.flatnonzero(link >= 0)).size:
            length[live] += length[link[live]]
            link[live] = link[link[live]]
        start = np.cumsum(length) - length
        wanted = int(np.searchsorted(start, most - made))  # codes that start within what is wanted
        codes, entry, length, start = codes[:wanted], entry[:wanted], length[:wanted], start[:wanted]
        total = int(length.sum())
        source = np.arange(total)
        many = np.flatnonzero(entry >= 0)
        if many.size:
            reps = length[many]
            inner = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
            source[np.repeat(start[many], reps) + inner] = np.repeat(start[entry[many]], reps) + inner
            while not np.array_equal(jumped := source[source], source):
                source = jumped
        first = np.zeros(total, np.uint8)
        single = entry < 0
        first[start[single]] = codes[single]
        parts.append(first[source])
        made += total
    return np.concatenate(parts)[:most].tobytes() if parts else b""


# ---------------------------------------------------------------- container


@dataclass
class Image:
    """An image of a GIF as stored."""

    left: int
    top: int
    width: int
    height: int
    samples: bytes
    palette: bytes
    delay: int = 0
    disposal: int = 0
    transparent: int | None = None


@dataclass
class Gif:
    width: int
    height: int
    background: int
    palette: bytes
    images: list[Image]
    loops: int | None = None


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def _size_bits(palette: bytes) -> int:
    return max(1, (len(palette) // 3 - 1).bit_length())


def encode(gif: Gif, interlace: bool = False, lzw=lzw_encode) -> bytes:
    bits = _size_bits(gif.palette) if gif.palette else 0
    head = b"GIF89a" + struct.pack("<HHBBB", gif.width, gif.height, (0x80 | 0x70 | bits - 1) if bits else 0x70, gif.background, 0)
    out = [head, gif.palette.ljust(3 << bits, b"\0") if bits else b""]
    if gif.loops is not None:
        out.append(b"\x21\xff\x0bNETSCAPE2.0\x03\x01" + struct.pack("<H", gif.loops) + b"\0")
    for im in gif.images:
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", im.disposal << 2 | (im.transparent is not None), im.delay, im.transparent or 0) + b"\0")
        own = im.palette if im.palette != gif.palette else b""
        own_bits = _size_bits(own) if own else 0
        out.append(b"\x2c" + struct.pack("<HHHHB", im.left, im.top, im.width, im.height, (0x80 | own_bits - 1 if own else 0) | 0x40 * interlace))
        out.append(own.ljust(3 << own_bits, b"\0") if own else b"")
        rows = im.samples
        if interlace:
            grid = np.frombuffer(rows, np.uint8).reshape(im.height, im.width)
            rows = grid[_interlaced(im.height)].tobytes()
        depth = max(2, own_bits or bits)
        out.append(bytes([depth]) + _blocks(lzw(rows, depth)))
    return b"".join(out) + b"\x3b"


def _interlaced(height: int) -> np.ndarray:
    return np.concatenate([np.arange(a, height, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])


def parse(data: bytes, most_canvas: int = MOST_CANVAS, most_pixels: int = MOST_PIXELS) -> Gif:
    """The images of a GIF, LZW decoded, rows in order."""
    pixels = 0
    try:
        if data[:6] not in (b"GIF87a", b"GIF89a"):
            raise ValueError("not a GIF")
        width, height, flags, background, _ = struct.unpack_from("<HHBBB", data, 6)
        if width * height > most_canvas:
            raise ValueError("more pixels than allowed")
        at, palette = 13, b""
        if flags & 0x80:
            n = 3 << (flags & 7) + 1
            palette, at = data[at : at + n], at + n
        gif = Gif(width, height, background, palette, [])
        control = (0, 0, None)

        def blocks(at: int) -> tuple[bytes, int]:
            parts = []
            while n := data[at]:
                parts.append(data[at + 1 : at + 1 + n])
                at += 1 + n
            return b"".join(parts), at + 1

        while data[at] != 0x3B:
            if data[at] == 0x21:
                kind = data[at + 1]
                body, at = blocks(at + 2)
                if kind == 0xF9:
                    f, delay, clear = struct.unpack_from("<BHB", body)
                    control = (f >> 2 & 7, delay, clear if f & 1 else None)
                elif kind == 0xFF and body[:11] == b"NETSCAPE2.0":
                    gif.loops = struct.unpack_from("<H", body, 12)[0]
            elif data[at] == 0x2C:
                left, top, w, h, f = struct.unpack_from("<HHHHB", data, at + 1)
                at, own = at + 10, palette
                if f & 0x80:
                    n = 3 << (f & 7) + 1
                    own, at = data[at : at + n], at + n
                depth = data[at]
                pixels += w * h
                if not 2 <= depth <= 8:
                    raise ValueError("a code size outside 2 to 8")
                if w * h > most_canvas or pixels > most_pixels:
                    raise ValueError("more pixels than allowed")
                body, at = blocks(at + 1)
                samples = lzw_decode(body, depth, w * h)
                if len(samples) < w * h:
                    raise ValueError("an image that ends early")
                if f & 0x40:
                    grid = np.empty((h, w), np.uint8)
                    grid[_interlaced(h)] = np.frombuffer(samples, np.uint8).reshape(h, w)
                    samples = grid.tobytes()
                gif.images.append(Image(left, top, w, h, samples, own, control[1], control[0], control[2]))
                control = (0, 0, None)
            else:
                raise ValueError("an unknown block")
        return gif
    except (IndexError, struct.error) as e:
        raise ValueError("a GIF that ends early") from e


def composed(gif: Gif):
    """For each image: start in ms, delay in ms, RGBA canvas after its drawing."""
    canvas = np.zeros((gif.height, gif.width, 4), np.uint8)
    clock = 0
    for im in gif.images:
        before = canvas.copy() if im.disposal == 3 else None
        colours = np.zeros((256, 4), np.uint8)
        n = len(im.palette) // 3
        colours[:n, :3] = np.frombuffer(im.palette, np.uint8).reshape(n, 3)
        colours[:, 3] = 255
        samples = np.frombuffer(im.samples, np.uint8).reshape(im.height, im.width)
        rows, cols = slice(im.top, min(im.top + im.height, gif.height)), slice(im.left, min(im.left + im.width, gif.width))
        view = canvas[rows, cols]
        samples = samples[: view.shape[0], : view.shape[1]]
        if im.transparent is None:
            view[:] = colours[samples]
        else:
            shown = samples != im.transparent
            view[shown] = colours[samples[shown]]
        yield clock, im.delay * 10, canvas.copy()
        clock += im.delay * 10
        if im.disposal == 2:
            view[:] = 0
        elif im.disposal == 3:
            canvas = before


def histogram(canvas: np.ndarray) -> list[int]:
    """Visible pixels by two bits of each of red, green and blue: 64 counts."""
    red, green, blue, alpha = (canvas[..., i] for i in range(4))
    key = (red >> 6 << 4) | (green >> 6 << 2) | blue >> 6
    return np.bincount(key[alpha > 0], minlength=64).tolist()


# ---------------------------------------------------------------- payloads

GREY = bytes(np.repeat(np.arange(256, dtype=np.uint8), 3))


def pack(payload: bytes, rows: int = 256) -> bytes:
    """Bytes (a positive multiple of 192) as grey samples: frames of 192 x ``rows`` at most, 100 ms each."""
    n = len(payload) // UNIT
    images = []
    for a in range(0, n, rows):
        part = payload[a * UNIT : (a + rows) * UNIT]
        images.append(Image(0, 0, UNIT, len(part) // UNIT, part, GREY, delay=10, disposal=2))
    return encode(Gif(UNIT, min(n, rows), 0, GREY, images, loops=0), lzw=lzw_encode_pairs)


def unpack(data: bytes) -> bytes:
    return b"".join(im.samples for im in parse(data).images)


def padded(text: bytes) -> bytes:
    return text + b" " * (-len(text) % UNIT if text else UNIT)


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media (the stored GIF) for every row; null is empty."""

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for a in range(0, len(texts), 64):
                part = texts[a : a + 64]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a : a + 64].cast(pa.int64()), pa.array([len(t) for t in part], pa.int64()), pa.array([pack(padded(t)) for t in part], pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def checked(data: bytes | None) -> tuple[Gif | None, str]:
    """The parsed GIF and its status."""
    if data is None:
        return None, "null"
    try:
        return parse(data), "ok"
    except ValueError as e:
        return None, f"broken: {e}"


def frames(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", *, pixels: bool = True) -> DataFrame:
    """One row per frame: id, status, frame, start_ms, delay_ms, width, height, rgba (null without
    ``pixels``), histogram (64 counts).  A null or broken GIF has one row, with its status and nulls."""
    names = ["id", "status", "frame", "start_ms", "delay_ms", "width", "height", "rgba", "histogram"]

    def run(batches):
        for batch in batches:
            types = [batch.column(0).type, pa.string(), *[pa.int64()] * 5, pa.binary(), pa.list_(pa.int64())]
            for key, data in zip(batch.column(0), batch.column(1)):
                gif, status = checked(data.as_py())
                rows = ((status, i, start, delay, gif.width, gif.height, canvas.tobytes() if pixels else None, histogram(canvas)) for i, (start, delay, canvas) in enumerate(composed(gif))) if gif else [(status, *[None] * 7)]
                for row in rows:
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((key.as_py(), *row), types)], names)

    kind = media.schema[id_col].dataType.simpleString()
    return media.select(id_col, media_col).mapInArrow(run, f"id {kind}, status string, frame long, start_ms long, delay_ms long, width long, height long, rgba binary, histogram array<long>")


def digest(media: DataFrame) -> DataFrame:
    """What the stored GIFs hold, read back: status, payload and media digests, and a feature string
    of frames, duration and the colour histogram summed over the frames' visible pixels."""

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column("media"):
                data = data.as_py()
                gif, status = checked(data)
                if gif is None:
                    rows.append((*[None] * 6, status))
                    continue
                payload = b"".join(im.samples for im in gif.images)
                total, length = np.zeros(64, np.int64), 0
                for start, delay, canvas in composed(gif):
                    total += histogram(canvas)
                    length = start + delay
                shades = ",".join(f"{k}:{v}" for k, v in enumerate(total.tolist()) if v)
                feature = f"gif {gif.width}x{gif.height} frames={len(gif.images)} ms={length} histogram={shades}"
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature, status))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "status"]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], ["doc_id", "n_bytes", *names])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, status string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)
