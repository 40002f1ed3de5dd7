"""How much of a page's strips is almost white, from the page's image.

An image is decoded once, by array operations: rows whose filter looks only to the left or only up are done row by row,
runs of rows that hold one of the other two filters along their diagonals, where no pixel depends on another. The sums
of almost white pixels over all rectangles from the corner (a summed-area table) then give each strip in four reads.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.sources.lifecycle import importable

ALMOST_WHITE, POINTS = 240, 72.0
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel by colour type: grey, colours, palette, grey and alpha, colours and alpha.
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
NONE, SUB, UP, AVERAGE, PAETH = range(5)
#: Pixels of an image that is decoded, at most.
MOST_PIXELS = 1 << 28


def chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, content) of a PNG's parts, each checked by its crc."""
    if not data.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    at = len(SIGNATURE)
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("the PNG ends early")
        size, kind = struct.unpack_from(">I4s", data, at)
        content = data[at + 8 : at + 8 + size]
        if len(content) < size or struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + content):
            raise ValueError("a broken part of a PNG")
        yield kind, content
        if kind == b"IEND":
            return
        at += 12 + size
    raise ValueError("the PNG ends early")


def unfiltered(filters: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Bytes of the rows (height, width, bytes a pixel) that the filters of each row have stored as differences."""
    height, width, _ = rows.shape
    out = np.zeros((height + 1, width + 1, rows.shape[2]), np.int16)  # with a row above and a pixel to the left
    if filters.max(initial=0) > PAETH:
        raise ValueError("an unknown filter")
    y = 0
    while y < height:
        kind = filters[y]
        if kind in (NONE, SUB, UP):
            row = rows[y].astype(np.int64)
            if kind == SUB:
                row = np.cumsum(row, 0)
            elif kind == UP:
                row = row + out[y, 1:]
            out[y + 1, 1:] = row & 255
            y += 1
            continue
        end = y + 1
        while end < height and filters[end] not in (NONE, UP):
            end += 1
        _diagonals(out, filters, rows, y, end)
        y = end
    return out[1:, 1:].astype(np.uint8)


def _diagonals(out: np.ndarray, filters: np.ndarray, rows: np.ndarray, first: int, end: int) -> None:
    """Rows ``first`` to ``end``, one diagonal after the other: all its pixels' neighbours are known by then."""
    width, kinds = rows.shape[1], filters[first:end]
    for d in range(width + end - first - 1):
        k = np.arange(max(0, d - width + 1), min(end - first, d + 1))
        y, x = first + k, d - k
        left, up, corner, kind = out[y + 1, x], out[y, x + 1], out[y, x], kinds[k][:, None]
        a, b, c = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        guess = np.where(kind == PAETH, nearest, np.where(kind == AVERAGE, (left + up) >> 1, np.where(kind == SUB, left, 0)))
        out[y + 1, x + 1] = (rows[y, x] + guess) & 255


def decoded(data: bytes) -> np.ndarray:
    """The pixels of a PNG as (height, width, 3) bytes, transparent ones on white. Interlaced images are an error."""
    head, palette, alpha, parts = None, None, None, []
    for kind, content in chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", content)
        elif kind == b"PLTE":
            palette = np.frombuffer(content, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            alpha = np.frombuffer(content, np.uint8)
        elif kind == b"IDAT":
            parts.append(content)
    if head is None:
        raise ValueError("a PNG without a head")
    width, height, depth, colour, _, _, interlaced = head
    if interlaced or colour not in SAMPLES or depth not in (1, 2, 4, 8, 16) or width * height > MOST_PIXELS:
        raise ValueError("a kind of PNG that is not read")
    samples = SAMPLES[colour]
    bits = samples * depth
    line, step = (width * bits + 7) // 8, max(1, bits // 8)
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8)
    if len(raw) != height * (line + 1):
        raise ValueError("a PNG with too few or too many pixels")
    table = raw.reshape(height, line + 1)
    rows = unfiltered(table[:, 0], table[:, 1:].reshape(height, line // step, step)).reshape(height, line)
    if depth < 8:
        each = np.unpackbits(rows, axis=1).reshape(height, -1, depth)
        values = (each << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(2).astype(np.uint8)[:, :width, None]
        if colour != 3:
            values = (values.astype(np.int64) * 255 // ((1 << depth) - 1)).astype(np.uint8)
    else:
        values = rows.reshape(height, width, bits // 8)[:, :, :: depth // 8]  # of two bytes the high one counts
    if colour == 3:
        if palette is None or values.max(initial=0) >= len(palette):
            raise ValueError("a colour that is not in the palette")
        shown, there = palette[values[:, :, 0]], None
        if alpha is not None:
            there = np.append(alpha, np.full(len(palette) - len(alpha), 255, np.uint8))[values[:, :, 0]][:, :, None]
    else:
        there = values[:, :, -1:] if samples in (2, 4) else None
        shown = values[:, :, :3] if samples >= 3 else np.repeat(values[:, :, :1], 3, 2)
    if there is None:
        return shown
    return ((shown.astype(np.int64) * there + 255 * (255 - there.astype(np.int64)) + 127) // 255).astype(np.uint8)


def white_sums(pixels: np.ndarray, above: int = ALMOST_WHITE) -> np.ndarray:
    """(height + 1, width + 1): almost white pixels above and to the left of each corner."""
    out = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1), np.int64)
    out[1:, 1:] = (pixels > above).all(2).cumsum(0).cumsum(1)
    return out


def ratios(sums: np.ndarray, boxes: np.ndarray, scale: float) -> np.ndarray:
    """Share of almost white pixels in boxes (x0, y0, x1, y1 in points), widened to whole pixels; NaN for an empty one."""
    height, width = sums.shape[0] - 1, sums.shape[1] - 1
    x0, y0 = (np.clip(np.floor(boxes[:, k] * scale), 0, n).astype(np.int64) for k, n in ((0, width), (1, height)))
    x1, y1 = (np.clip(np.ceil(boxes[:, k] * scale), 0, n).astype(np.int64) for k, n in ((2, width), (3, height)))
    every = np.maximum(0, x1 - x0) * np.maximum(0, y1 - y0)
    white = sums[y1, x1] - sums[y0, x1] - sums[y1, x0] + sums[y0, x0]
    return np.where(every > 0, white / np.maximum(every, 1), np.nan)


def strip_ratios(strips: DataFrame, images: DataFrame, dpi: float = POINTS) -> DataFrame:
    """(paper_id, page, pos, ratio, error) of strips (paper_id, page, pos, box in points), by the image (PNG) of their page.

    An image is decoded once for all of its strips. Without an image, or with one that can't be read, a strip has an error;
    one that covers no pixel has neither ratio nor error.
    """
    names, box = ["paper_id", "page", "pos", "ratio", "error"], F.struct("pos", *[F.col(f"box.{k}").cast("double").alias(k) for k in ("x0", "y0", "x1", "y1")])
    pages = strips.groupBy("paper_id", "page").agg(F.collect_list(box).alias("s")).join(images.select("paper_id", "page", "image"), ["paper_id", "page"], "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for paper, page, own, image in frame[["paper_id", "page", "s", "image"]].itertuples(index=False):
                found, error = [None] * len(own), None
                try:
                    if image is None:
                        raise ValueError("no image")
                    got = ratios(white_sums(decoded(bytes(image))), np.array([[s[k] for k in ("x0", "y0", "x1", "y1")] for s in own], float), dpi / POINTS)
                    found = [None if np.isnan(r) else float(r) for r in got]
                except Exception as e:
                    error = repr(e)
                yield pd.DataFrame([(paper, page, s["pos"], r, error) for s, r in zip(own, found, strict=True)], columns=names)

    importable(strips.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in strips.schema.fields}
    return pages.mapInPandas(run, f"paper_id {kinds['paper_id']}, page {kinds['page']}, pos {kinds['pos']}, ratio double, error string")
