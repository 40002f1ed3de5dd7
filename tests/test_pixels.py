"""Images against plain decoding and plain counting."""

import struct
import zlib

import numpy as np
import pytest

from folioflow.operators import layout, pixels

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def png(rows, depth=8, colour=2, filters=None, extra=b"", parts=3):
    """A PNG of packed rows (height, bytes), each stored by its filter, as the format says, number by number."""
    height, line = rows.shape
    step = max(1, pixels.SAMPLES[colour] * depth // 8)
    width = line * 8 // (pixels.SAMPLES[colour] * depth)
    raw = b""
    for y in range(height):
        kind = 0 if filters is None else int(filters[y])
        out = bytearray([kind])
        for x in range(line):
            a = int(rows[y, x - step]) if x >= step else 0
            b = int(rows[y - 1, x]) if y else 0
            c = int(rows[y - 1, x - step]) if y and x >= step else 0
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out.append((int(rows[y, x]) - (0, a, b, (a + b) // 2, near)[kind]) & 255)
        raw += bytes(out)
    chunk = lambda kind, content: struct.pack(">I", len(content)) + kind + content + struct.pack(">I", zlib.crc32(kind + content))
    packed = zlib.compress(raw)
    cut = -(-len(packed) // parts)
    data = b"".join(chunk(b"IDAT", packed[k : k + cut]) for k in range(0, len(packed), cut))
    return pixels.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)) + extra + chunk(b"tEXt", b"a\x00b") + data + chunk(b"IEND", b"")


@pytest.mark.parametrize("filters", [[0] * 12, [1] * 12, [2] * 12, [3] * 12, [4] * 12, [0, 1, 2, 3, 4, 4, 1, 3, 2, 1, 4, 0], [4, 3, 1, 1, 3, 4, 2, 3, 0, 4, 1, 4]])
@pytest.mark.parametrize(("colour", "depth"), [(2, 8), (0, 8), (6, 8), (2, 16)])
def test_filters(filters, colour, depth):
    rng = np.random.default_rng(sum(filters))
    n = pixels.SAMPLES[colour]
    rows = rng.integers(0, 256, (12, 17 * n * depth // 8), dtype=np.uint8)
    values = rows.reshape(12, 17, -1)[:, :, :: depth // 8].astype(int)
    if colour == 6:
        a = values[:, :, 3:]
        values = (values[:, :, :3] * a + 255 * (255 - a) + 127) // 255
    want = np.repeat(values, 3, 2) if n == 1 else values[:, :, :3]
    assert (pixels.decoded(png(rows, depth, colour, filters)) == want).all()


def test_small_depths_and_palettes():
    rows = np.array([[0b10110000], [0b01000000]], np.uint8)
    assert pixels.decoded(png(rows, 1, 0))[:, :, 0].tolist() == [[255, 0, 255, 255, 0, 0, 0, 0], [0, 255, 0, 0, 0, 0, 0, 0]]
    assert pixels.decoded(png(np.array([[0b00011011]], np.uint8), 2, 0))[0, :, 0].tolist() == [0, 85, 170, 255]
    chunk = lambda kind, content: struct.pack(">I", len(content)) + kind + content + struct.pack(">I", zlib.crc32(kind + content))
    colours = chunk(b"PLTE", bytes([1, 2, 3, 250, 251, 252])) + chunk(b"tRNS", bytes([0]))
    assert pixels.decoded(png(np.array([[0, 1]], np.uint8), 8, 3, extra=colours)).tolist() == [[[255, 255, 255], [250, 251, 252]]]
    with pytest.raises(ValueError, match="palette"):
        pixels.decoded(png(np.array([[5]], np.uint8), 8, 3, extra=colours))


@pytest.mark.parametrize("broken", [b"", b"%PDF", png(np.zeros((2, 3), np.uint8))[:-20], png(np.zeros((2, 3), np.uint8)).replace(b"tEXt", b"tEXx"), pixels.SIGNATURE])
def test_broken_images(broken):
    with pytest.raises(ValueError, match="PNG"):
        pixels.decoded(broken)


def test_a_large_page_takes_seconds():
    import time

    rows = np.random.default_rng(1).integers(0, 256, (1_100, 850, 3), dtype=np.uint8)
    began = time.monotonic()
    out = pixels.unfiltered(np.full(1_100, pixels.PAETH), rows)
    assert out.shape == rows.shape and time.monotonic() - began < 20


def test_ratios_of_strips(spark):
    rng = np.random.default_rng(6)
    page = np.where(rng.random((80, 60, 3)) < 0.9, 255, 240).astype(np.uint8)
    image = png(page.reshape(80, 180), filters=rng.integers(0, 5, 80))
    boxes = [(0.0, 0.0, 60.0, 80.0), (3.2, 4.5, 20.0, 9.1), (10.0, 10.0, 10.0, 20.0), (-5.0, 70.0, 500.0, 900.0), (30.0, 0.0, 31.0, 1.0)]
    strips = spark.createDataFrame([("a", 1, k, b) for k, b in enumerate(boxes)] + [("a", 2, 0, boxes[0]), ("b", 1, 0, boxes[0])], f"paper_id string, page int, pos int, box {BOX}")
    images = spark.createDataFrame([("a", 1, image), ("a", 2, b"no image")], "paper_id string, page int, image binary")
    got = {(r.paper_id, r.page, r.pos): (r.ratio, r.error) for r in pixels.strip_ratios(strips, images).collect()}

    def plain(x0, y0, x1, y1):
        cells = [(x, y) for y in range(80) for x in range(60) if int(np.floor(x0)) <= x < int(np.ceil(x1)) and int(np.floor(y0)) <= y < int(np.ceil(y1))]
        return sum(min(page[y, x]) > 240 for x, y in cells) / len(cells) if cells else None

    assert {k: v[0] for k, v in got.items() if k[:2] == ("a", 1)} == {("a", 1, k): pytest.approx(plain(*b)) if plain(*b) is not None else None for k, b in enumerate(boxes)}
    assert "PNG" in got["a", 2, 0][1] and "no image" in got["b", 1, 0][1] and got["a", 1, 2] == (None, None)


def test_blank_strips_are_no_regions(spark):
    """From captions and page images to regions: a strip that is white gives none."""
    white, dark = np.full((792, 612 * 3), 255, np.uint8), np.full((792, 612 * 3), 255, np.uint8)
    dark[100:140, 30:900] = 0
    pages = spark.createDataFrame([("a", n, 612.0, 792.0) for n in (1, 2, 3)], "paper_id string, page int, width double, height double")
    caps = layout.with_boundary(spark.createDataFrame([("a", n, 0, (40.0, 300.0, 280.0, 320.0)) for n in (1, 2, 3)], f"paper_id string, page int, pos int, box {BOX}"), pages)
    images = spark.createDataFrame([("a", 1, png(white, parts=1)), ("a", 2, png(dark, parts=1)), ("a", 3, b"broken")], "paper_id string, page int, image binary")
    got = layout.strips(caps)
    found = layout.fallback_regions(caps, pixels.strip_ratios(got, images))
    assert [(r.page, tuple(r.region)) for r in found.collect()] == [(2, (0.0, 0.0, 322.0, 316.0))]
