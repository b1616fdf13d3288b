"""PNG files by their own structure: chunks, row filters, bit depths, palettes and interlacing, read in numpy; a writer, and rows of pixels."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import image

#: Bytes of an image's unpacked rows at most; one with more is an error row.
MOST = 256 << 20
#: Pixels of a batch of rows.
ROWS = 1 << 16
#: Fixed values of the format: its first bytes, samples a pixel of each colour type, and first row, first column, row step and column step of the interlaced passes.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
PASSES = [(0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)]


def chunks(content: bytes) -> Iterator[tuple[bytes, memoryview]]:
    """(kind, data) of a file's chunks up to its end mark; a wrong signature or checksum, or a file that stops early, is a ValueError."""
    if content[:8] != SIGNATURE:
        raise ValueError("no PNG file")
    view, at = memoryview(content), 8
    while at + 12 <= len(content):
        size, kind = struct.unpack(">I4s", view[at : at + 8])
        data = view[at + 8 : at + 8 + size]
        if at + 12 + size > len(content) or zlib.crc32(data, zlib.crc32(kind)) != struct.unpack(">I", view[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a broken chunk")
        if kind == b"IEND":
            return
        yield kind, data
        at += 12 + size
    raise ValueError("a file without an end")


def unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Bytes of rows (first the row's filter, then its bytes, `step` a pixel). A byte needs those left of it, above it and left of that, so all bytes
    of one diagonal of pixels are made at once."""
    kinds, h = raw[:, 0], len(raw)
    if len(kinds) and kinds.max() > 4:
        raise ValueError("an unknown row filter")
    rows = raw[:, 1:].reshape(h, -1, step)
    w = rows.shape[1]
    out = np.empty_like(rows)
    last = older = np.zeros((h + 1, step), np.int16)  # diagonals; line 0 stands above the image
    for d in range(h + w - 1):
        y = np.arange(max(0, d - w + 1), min(h, d + 1))
        left, up, corner = last[y + 1], last[y], older[y]
        # of left, up and corner the one nearest to left + up - corner; left before up before corner
        to_left, to_up, to_corner = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        nearest = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
        guess = np.choose(kinds[y][:, None], [np.zeros_like(left), left, up, (left + up) >> 1, nearest])
        made = (rows[y, d - y] + guess) & 255
        out[y, d - y] = made
        older, last = last, np.zeros((h + 1, step), np.int16)
        last[y + 1] = made
    return out.reshape(h, -1)


def _samples(rows: np.ndarray, width: int, depth: int, per: int) -> np.ndarray:
    """(rows, width, per) samples of 8 bits or fewer; of 16 bits the upper 8."""
    if depth == 16:
        rows = rows[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(rows, axis=1).reshape(len(rows), -1, depth)
        rows = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(axis=2, dtype=np.uint8)[:, :width]
    return rows.reshape(len(rows), width, per)


def decode(content: bytes) -> np.ndarray:
    """(height, width, 3) of a PNG file's pixels, 8 bits each in the order blue, green, red; grey counts as all three, and alpha is left out."""
    head, palette, parts = None, None, []
    for kind, data in chunks(content):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"PLTE":
            palette = np.frombuffer(data, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(data)
    if head is None:
        raise ValueError("a file without a head")
    width, height, depth, colour, *_, woven = head
    if colour not in SAMPLES or depth not in DEPTHS[colour] or not width or not height or woven > 1 or (colour == 3 and palette is None):
        raise ValueError("a head that no PNG file has")
    per = SAMPLES[colour]
    step = max(1, depth * per // 8)
    passes = [p for p in (PASSES if woven else [(0, 0, 1, 1)]) if p[0] < height and p[1] < width]
    shapes = [(-(-(height - y) // dy), -(-(width - x) // dx)) for y, x, dy, dx in passes]
    line = [-(-w * depth * per // 8) + 1 for _, w in shapes]
    total = sum(h * n for (h, _), n in zip(shapes, line))
    if max(total, height * width * 3) > MOST:
        raise ValueError("too large an image")
    raw = zlib.decompressobj().decompress(b"".join(parts), total)
    if len(raw) < total:
        raise ValueError("too few rows")
    found, at = np.empty((height, width, per), np.uint8), 0
    for (y, x, dy, dx), (h, w), n in zip(passes, shapes, line):
        rows = np.frombuffer(raw, np.uint8, h * n, at).reshape(h, n)
        found[y::dy, x::dx] = _samples(unfiltered(rows, step), w, depth, per)
        at += h * n
    if colour == 3:
        if int(found.max()) >= len(palette):
            raise ValueError("a colour beyond the palette")
        return palette[found[:, :, 0]][:, :, ::-1]
    if depth < 8:
        found = found * np.uint8(255 // ((1 << depth) - 1))
    return np.repeat(found[:, :, :1], 3, axis=2) if per < 3 else found[:, :, 2::-1]


def bgr(content: bytes) -> np.ndarray:
    """decode() as pixels (n, 3), which image.relevant takes."""
    return decode(content).reshape(-1, 3)


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def filtered(rows: np.ndarray, step: int) -> bytes:
    """Rows of bytes behind their filters: each row takes the filter whose bytes, as signed ones, are least in sum; of equals the first."""
    now = rows.astype(np.int16)
    left, up, corner = np.zeros_like(now), np.zeros_like(now), np.zeros_like(now)
    left[:, step:], up[1:], corner[1:, step:] = now[:, :-step], now[:-1], now[:-1, :-step]
    to_left, to_up, to_corner = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
    nearest = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
    tried = np.stack([now - g for g in (0, left, up, (left + up) >> 1, nearest)]).astype(np.uint8)
    best = np.abs(tried.view(np.int8).astype(np.int16)).sum(axis=2, dtype=np.int64).argmin(axis=0)
    return np.column_stack([best.astype(np.uint8), tried[best, np.arange(len(rows))]]).tobytes()


def encode(pixels: np.ndarray) -> bytes:
    """A PNG file of pixels (height, width, 3), 8 bits each in the order blue, green, red."""
    h, w, _ = pixels.shape
    rows = np.ascontiguousarray(pixels[:, :, ::-1]).reshape(h, -1).astype(np.uint8)
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(filtered(rows, 3))) + chunk(b"IEND", b"")


def png_files(pixels: DataFrame, key: str = "image_id") -> DataFrame:
    """Files (path, content) of pixels (key, y, x, b, g, r), one `<key>.png` a key, as high and wide as its largest y and x say; a place without a pixel is black, and
    one with several has the largest (b, g, r). A null key, y or x has no place. A file's pixels meet in one task, as it is written whole."""
    placed = pixels.filter(f"`{key}` IS NOT NULL AND y >= 0 AND x >= 0").select(F.col(key).cast("string").alias("key"), "y", "x", F.struct(*[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in "bgr"]).alias("p"))
    held = placed.groupBy("key", "y", "x").agg(F.max("p").alias("p")).groupBy("key")
    lists = held.agg(*[F.collect_list(F.struct(F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), "p.b", "p.g", "p.r")).alias("places")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                y, x, *colours = (b.column(1)[i].values.field(c).to_numpy() for c in range(5))
                made = np.zeros((int(y.max()) + 1, int(x.max()) + 1, 3), np.uint8)
                made[y, x] = np.column_stack(colours)
                yield pa.RecordBatch.from_arrays([pa.array([f"{b.column(0)[i].as_py()}.png"]), pa.array([encode(made)], pa.binary())], names=["path", "content"])

    return lists.mapInArrow(run, "path string, content binary")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray | None, str | None]]:
    for b in batches:
        for i in range(b.num_rows):
            try:
                yield b.column(0)[i].as_py(), decode(b.column(1)[i].as_py() or b""), None
            except (ValueError, zlib.error, struct.error) as e:
                yield b.column(0)[i].as_py(), None, str(e) or type(e).__name__


def read_images(files: DataFrame) -> DataFrame:
    """(path, height, width, colorfulness, error) of files (path, content): one pass over each, where it is. A file that is no PNG file, or a broken one, has nulls and
    says why in `error`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, found, error in _decoded(batches):
            h, w, c = (None,) * 3 if found is None else (*found.shape[:2], image.colourful(found.reshape(-1, 3)))
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([h], pa.int32()), pa.array([w], pa.int32()), pa.array([c], pa.float64()), pa.array([error], pa.string())], names=["path", "height", "width", "colorfulness", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, height int, width int, colorfulness double, error string")


def read_pixels(files: DataFrame) -> DataFrame:
    """(path, y, x, b, g, r) of files (path, content), a row a pixel; broken files have none, and read_images names them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, found, _ in _decoded(batches):
            flat = np.empty((0, 3), np.uint8) if found is None else found.reshape(-1, 3)
            for k in range(0, len(flat), ROWS):
                part = flat[k : k + ROWS].astype(np.int32)
                at = np.arange(k, k + len(part))
                cols = [at // found.shape[1], at % found.shape[1], *part.T]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(part), pa.string()), *[pa.array(c, pa.int32()) for c in cols]], names=["path", "y", "x", "b", "g", "r"])

    return files.select("path", "content").mapInArrow(run, "path string, y int, x int, b int, g int, r int")
