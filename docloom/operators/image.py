"""Which extracted images are worth keeping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An image this colourful is a picture; a dull one is text if more words are read on it.
COLOURFUL, MOST_WORDS = 10, 10
#: Pixels of a batch of rows.
ROWS = 1 << 16


def colourful(bgr: np.ndarray) -> float:
    """Spread plus 0.3 times mean of the red-green and yellow-blue opponents of pixels (n, 3) in the order blue, green, red; 0 without a pixel."""
    if not len(bgr):
        return 0.0
    b, g, r = bgr.astype(np.float64).T
    rg, yb = np.abs(r - g), np.abs(0.5 * (r + g) - b)
    return float(np.hypot(rg.std(), yb.std()) + 0.3 * np.hypot(rg.mean(), yb.mean()))


def colorfulness(pixels: DataFrame, key: str = "image_id") -> DataFrame:
    """(key, colorfulness) of pixels (key, b, g, r) as rows: the same figure as an aggregation."""
    r, g, b = (F.col(c).cast("double") for c in "rgb")
    rg, yb = F.abs(r - g), F.abs(0.5 * (r + g) - b)
    spread = F.sqrt(F.pow(F.stddev_pop(rg), 2) + F.pow(F.stddev_pop(yb), 2))
    mean = F.sqrt(F.pow(F.avg(rg), 2) + F.pow(F.avg(yb), 2))
    return pixels.groupBy(key).agg((spread + 0.3 * mean).alias("colorfulness"))


def _bgr(data: bytes | None, channels: int | None, height: int | None, width: int | None) -> np.ndarray:
    """(pixels, 3) of decoded bytes; fewer than three channels count as the first for all."""
    n = max(0, (height or 0) * (width or 0))
    if not n or not data or not channels or channels < 1:
        return np.empty((0, 3), np.uint8)
    whole = np.frombuffer(data, np.uint8)[: n * channels].reshape(-1, channels)
    return whole[:, :3] if channels >= 3 else np.repeat(whole[:, :1], 3, axis=1)


def _images(images: DataFrame, key: str, image: str) -> DataFrame:
    return images.select(F.col(key).cast("string").alias(key), *[F.col(f"{image}.{c}").alias(c) for c in ("data", "nChannels", "height", "width")])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    for b in batches:
        for i in range(b.num_rows):
            k, *rest = (c[i].as_py() for c in b.columns)
            yield k, _bgr(*rest)


def image_colorfulness(images: DataFrame, key: str = "image_id", image: str = "image") -> DataFrame:
    """(key, colorfulness) of Spark's image column: one pass over each image's bytes, where it is; 0 for an image without pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, bgr in _decoded(batches):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.string()), pa.array([colourful(bgr)])], names=[key, "colorfulness"])

    return _images(images, key, image).mapInArrow(run, f"`{key}` string, colorfulness double")


def pixels(images: DataFrame, key: str = "image_id", image: str = "image") -> DataFrame:
    """(key, b, g, r) of Spark's image column, a row per pixel; grey images count as all three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, bgr in _decoded(batches):
            for i in range(0, len(bgr), ROWS):
                part = bgr[i : i + ROWS].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(part), pa.string()), *[pa.array(part[:, c]) for c in range(3)]], names=[key, "b", "g", "r"])

    return _images(images, key, image).mapInArrow(run, f"`{key}` string, b int, g int, r int")


def keep(colour: Column, ocr_words: Column) -> Column:
    return (colour >= COLOURFUL) | (ocr_words <= MOST_WORDS)


def relevant(decode: Callable[[bytes], np.ndarray], read: Callable[[bytes], str]) -> Callable[[bytes], bool]:
    """The same rule for an image's file: decode gives its pixels (n, 3) in the order blue, green, red, and read, which only dull images go to, the text on it."""

    def rule(content: bytes) -> bool:
        return colourful(decode(content)) >= COLOURFUL or len(read(content).split()) <= MOST_WORDS

    return rule
