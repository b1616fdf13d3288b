"""PNG files: every colour type and depth against a plain writer, filters, interlacing, broken files, and the rows that come back."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import image
from docloom.sources import png


def paeth(a, b, c):
    p = a + b - c
    return min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]


def plain_rows(lines, step, rng):
    """Lines of bytes, each behind a random filter, a byte at a time."""
    out, above = b"", None
    for line in lines:
        kind = int(rng.integers(5))
        above = above or bytes(len(line))
        row = []
        for i, v in enumerate(line):
            a, b, c = (line[i - step] if i >= step else 0), above[i], (above[i - step] if i >= step else 0)
            row.append((v - [0, a, b, (a + b) // 2, paeth(a, b, c)][kind]) & 255)
        out += bytes([kind, *row])
        above = line
    return out


def plain_png(samples, depth, colour, woven, rng, palette=None):
    """samples (h, w, n) as numbers of `depth` bits."""
    h, w, n = samples.shape
    data = b""
    for y, x, dy, dx in png.PASSES if woven else [(0, 0, 1, 1)]:
        part = samples[y::dy, x::dx]
        if part.size:
            lines = []
            for row in part:
                bits = "".join(f"{int(v):0{depth}b}" for v in row.ravel())
                bits += "0" * (-len(bits) % 8)
                lines.append(bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)))
            data += plain_rows(lines, max(1, depth * n // 8), rng)
    packed = zlib.compress(data)
    cut = len(packed) // 2
    return b"".join(
        [png.SIGNATURE, png.chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, woven)), png.chunk(b"tEXt", b"a\0b")]
        + ([png.chunk(b"PLTE", palette.astype(np.uint8).tobytes())] if palette is not None else [])
        + [png.chunk(b"IDAT", packed[:cut]), png.chunk(b"IDAT", packed[cut:]), png.chunk(b"IEND", b"")]
    )


@pytest.mark.parametrize("woven", [0, 1])
@pytest.mark.parametrize("colour,depth", [(c, d) for c, depths in png.DEPTHS.items() for d in depths])
def test_every_kind(colour, depth, woven):
    rng = np.random.default_rng(colour * 100 + depth)
    for h, w in ((1, 1), (3, 2), (13, 21)):
        s = rng.integers(0, 1 << depth, (h, w, png.SAMPLES[colour]))
        palette = rng.integers(0, 256, (1 << depth, 3)) if colour == 3 else None
        found = png.decode(plain_png(s, depth, colour, woven, rng, palette))
        if colour == 3:
            wanted = palette[s[:, :, 0]][:, :, ::-1]
        else:
            s = s >> 8 if depth == 16 else s * 255 // ((1 << depth) - 1)
            wanted = s[:, :, 2::-1] if s.shape[2] >= 3 else np.repeat(s[:, :, :1], 3, axis=2)
        assert found.tolist() == wanted.tolist()


def test_round_trip_takes_every_filter():
    rng = np.random.default_rng(3)
    y, x = np.mgrid[:120, :90]
    smooth = np.stack([y * 2, x * 2, y + x], axis=2).astype(np.uint8)
    photo = (np.cumsum(np.cumsum(rng.normal(0, 3, (120, 90, 3)), 0), 1) % 256).astype(np.uint8)
    used = set()
    for p in (smooth, photo, rng.integers(0, 256, (40, 33, 3)).astype(np.uint8), np.zeros((5, 7, 3), np.uint8)):
        assert (png.decode(png.encode(p)) == p).all()
        rows = np.ascontiguousarray(p[:, :, ::-1]).reshape(len(p), -1)
        used |= set(np.frombuffer(png.filtered(rows, 3), np.uint8).reshape(len(p), -1)[:, 0].tolist())
    assert len(used) >= 4


def test_files(spark):
    rng = np.random.default_rng(5)
    p = rng.integers(0, 256, (6, 5, 3)).astype(np.uint8)
    good = png.encode(p)
    files = {"a": good, "broken": good[:-20], "flipped": good[:40] + bytes([good[40] ^ 1]) + good[41:], "none": b"", "null": None, "text": b"no picture"}
    bomb = png.SIGNATURE + png.chunk(b"IHDR", struct.pack(">IIBBBBB", 1 << 20, 1 << 20, 8, 2, 0, 0, 0)) + png.chunk(b"IDAT", zlib.compress(bytes(1000))) + png.chunk(b"IEND", b"")
    files["bomb"] = bomb
    df = spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in files.items()] + [("a", bytearray(good))], "path string, content binary")
    rows = png.read_images(df).collect()
    for r in rows:
        if r.path == "a":
            assert (r.height, r.width, r.error) == (6, 5, None) and abs(r.colorfulness - image.colourful(p.reshape(-1, 3))) < 1e-9
        else:
            assert r.error and r.height is None and r.colorfulness is None
    assert len(rows) == 8 and png.read_images(df.limit(0)).count() == 0
    found = png.read_pixels(df).filter("path = 'a'").distinct().collect()
    assert {(r.y, r.x): (r.b, r.g, r.r) for r in found} == {(y, x): tuple(p[y, x].tolist()) for y in range(6) for x in range(5)}
    assert png.read_pixels(df).filter("path <> 'a'").count() == 0


def test_files_of_pixels(spark):
    rows = [("k", 0, 0, 1, 2, 3), ("k", 0, 0, 1, 2, 4), ("k", 2, 1, 9, 8, 7), ("k", None, 1, 9, 9, 9), (None, 0, 0, 9, 9, 9), ("one", 0, 0, None, 5, 6), ("k", -1, 0, 9, 9, 9)]
    df = spark.createDataFrame(rows, "image_id string, y int, x int, b int, g int, r int").withColumn("path", F.lit("clash"))
    files = {r.path: png.decode(bytes(r.content)).tolist() for r in png.png_files(df).collect()}
    black = [0, 0, 0]
    assert files == {"k.png": [[[1, 2, 4], black], [black, black], [black, [9, 8, 7]]], "one.png": [[[0, 5, 6]]]}
    assert png.png_files(df.limit(0)).count() == 0


def test_relevance_of_files():
    red = png.encode(np.tile(np.array([0, 0, 255], np.uint8), (4, 4, 1)))
    grey = png.encode(np.full((4, 4, 3), 90, np.uint8))
    for words, kept in ((10, True), (11, False)):
        rule = image.relevant(png.bgr, lambda _, n=words: "w " * n)
        assert rule(red) and rule(grey) is kept
