"""Pixels: image headers, indexed masks, connected components. The only Python in the library's own hot paths."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

WORK_SIZE, MOST, LEAST_RATIO = 512, 12, 2e-4
COMPONENT = "array<struct<area:long,x0:int,y0:int,x1:int,y1:int>>"


def image_size(data: bytes) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, BMP or JPEG."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data):
            if data[at] != 0xFF:
                at += 1
                continue
            mark, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            at += 2 + (size if mark not in (0xFF, 0x01) and not 0xD0 <= mark <= 0xD9 else 0)
    return None


def size_of_udf():
    @F.pandas_udf("struct<w:int,h:int>")
    def size_of(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_size(bytes(c)) or (None, None) if c is not None else (None, None) for c in content], columns=["w", "h"])

    return size_of


def decode_png(data: bytes) -> np.ndarray:
    """Rows x columns (x channels): palette images as their indices, others as their samples."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data[at + 8 : at + 21])
        elif kind == b"IDAT":
            packed += data[at + 8 : at + 8 + n]
        at += 12 + n
    w, h, depth, colour, _, _, interlaced = head
    if interlaced:
        raise ValueError("interlaced PNGs are not read")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    step, line = max(1, depth * channels // 8), (w * depth * channels + 7) // 8
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(h, line + 1)
    out = np.zeros((h, line), np.uint8)
    above = np.zeros(line, np.int32)
    for y in range(h):
        kind, row = int(raw[y, 0]), raw[y, 1:].astype(np.int32)
        if kind == 2:
            row = (row + above) & 255
        elif kind in (1, 3, 4):
            for x in range(line):
                left = row[x - step] if x >= step else 0
                corner = above[x - step] if x >= step else 0
                if kind == 1:
                    guess = left
                elif kind == 3:
                    guess = (left + above[x]) // 2
                else:
                    p = left + above[x] - corner
                    guess = min((abs(p - left), 0, left), (abs(p - above[x]), 1, above[x]), (abs(p - corner), 2, corner))[2]
                row[x] = (row[x] + guess) & 255
        out[y], above = row, row
    if depth == 16:
        pixels = out.view(">u2").astype(np.int32).reshape(h, w, channels)
    elif depth < 8:
        bits = np.unpackbits(out, axis=1).reshape(h, -1, depth)
        pixels = (bits @ (1 << np.arange(depth)[::-1]))[:, :w].astype(np.int32).reshape(h, w, 1)
    else:
        pixels = out.astype(np.int32).reshape(h, w, channels)
    return pixels[:, :, 0] if channels == 1 else pixels


def decode_bmp(data: bytes) -> np.ndarray:
    """As decode_png, of uncompressed BMPs with 8 (indices), 24 or 32 bits a pixel."""
    start, head = struct.unpack("<I", data[10:14])[0], struct.unpack("<IiiHHI", data[14:34])
    w, h, depth, packed = head[1], abs(head[2]), head[4], head[5]
    if depth not in (8, 24, 32) or packed not in (0, 3) or w <= 0:
        raise ValueError("this kind of BMP is not read")
    line, channels = (w * depth + 31) // 32 * 4, depth // 8
    rows = np.frombuffer(data, np.uint8, line * h, start).reshape(h, line)[:, : w * channels].reshape(h, w, channels).astype(np.int32)
    rows = rows[::-1] if head[2] > 0 else rows
    return rows[:, :, 0] if channels == 1 else rows[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray | None:
    """The pixels of a PNG or BMP, None if they can't be read."""
    try:
        return decode_bmp(data) if data[:2] == b"BM" else decode_png(data)
    except (ValueError, KeyError, TypeError, IndexError, struct.error, zlib.error):
        return None


def voc_palette(n: int = 256) -> np.ndarray:
    """The colour of each class index: its bits dealt over the high bits of the three channels."""
    index, out = np.arange(n), np.zeros((n, 3), np.int32)
    for k in range(8):
        for c in range(3):
            out[:, c] |= (index >> (3 * k + c) & 1) << (7 - k)
    return out


def class_indices(pixels: np.ndarray) -> np.ndarray:
    """A mask as class indices: grey values as they are, colours by the palette, other colours after the largest known."""
    if pixels.ndim == 2:
        return pixels
    rgb = pixels[:, :, :3] if pixels.shape[2] >= 3 else np.repeat(pixels[:, :, :1], 3, axis=2)
    if (rgb[:, :, 0] == rgb[:, :, 1]).all() and (rgb[:, :, 1] == rgb[:, :, 2]).all():
        return rgb[:, :, 0]
    code = rgb @ np.array([65536, 256, 1])
    known = {int(c): i for i, c in reversed(list(enumerate(voc_palette() @ np.array([65536, 256, 1]))))}
    found = [int(c) for c in np.unique(code)]
    last = max([known[c] for c in found if c in known], default=0)
    names = dict(known)
    for k, c in enumerate(c for c in found if c not in known):
        names[c] = last + 1 + k
    return np.vectorize(names.__getitem__)(code)


def label(mask: np.ndarray) -> np.ndarray:
    """4-connected labels of a boolean mask (0: background): least neighbours along runs until nothing changes."""
    h, w = mask.shape
    labels = np.where(mask, np.arange(1, h * w + 1).reshape(h, w), 0)
    while True:
        before = labels
        for axis in (0, 1):
            for _ in range(2):
                flipped = np.flip(labels, axis)
                moved = np.roll(flipped, 1, axis)
                edge = [slice(None)] * 2
                edge[axis] = slice(0, 1)
                moved[tuple(edge)] = 0
                flipped = np.where((flipped > 0) & (moved > 0), np.minimum(flipped, moved), flipped)
                labels = flipped
        flat = labels.ravel()
        roots = np.append(0, flat)
        labels = roots[flat].reshape(h, w)  # a label is the place of a pixel, so it can take that pixel's label
        if (labels == before).all():
            return labels


def components(mask: np.ndarray, most: int | None = MOST, least_ratio: float = LEAST_RATIO, work: int = WORK_SIZE) -> list[tuple[int, int, int, int, int]]:
    """(area, x0, y0, x1, y1), largest first. Large masks are sampled down; a mask with pixels always gives a box."""
    mask = np.asarray(mask, bool)
    if not mask.any():
        return []
    h, w = mask.shape
    scale = min(1.0, work / max(h, w))
    small = mask
    if scale < 1:
        ys = np.minimum((np.arange(max(1, round(h * scale))) / scale).astype(int), h - 1)
        xs = np.minimum((np.arange(max(1, round(w * scale))) / scale).astype(int), w - 1)
        small = mask[np.ix_(ys, xs)]
    labels = label(small)
    ys, xs = np.nonzero(labels)
    names, place, areas = np.unique(labels[ys, xs], return_inverse=True, return_counts=True)
    found = []
    for i in range(len(names)):
        y, x = ys[place == i], xs[place == i]
        found.append((int(areas[i]), int(x.min() / scale), int(y.min() / scale), min(w, round((x.max() + 1) / scale)), min(h, round((y.max() + 1) / scale))))
    found = sorted(found, key=lambda c: (-c[0], c[2], c[1]))[:most]
    kept = [c for c in found if c[0] >= least_ratio * small.size]
    if kept:
        return kept
    y, x = np.nonzero(mask)
    return [(int(mask.sum()), int(x.min()), int(y.min()), int(x.max()) + 1, int(y.max()) + 1)]


def components_udf(width: int):
    """A pandas UDF over flat masks (arrays of 0 and 1) of a fixed width; all components, smallest too."""

    @F.pandas_udf(COMPONENT)
    def run(masks: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("area", "x0", "y0", "x1", "y1"), c, strict=True)) for c in components(np.asarray(m).reshape(-1, width), None, 0.0)] for m in masks])

    return run


def mask_boxes_udf(background: tuple[int, ...] = (0,)):
    @F.pandas_udf("array<struct<cls:int,area:long,x0:int,y0:int,x1:int,y1:int>>")
    def mask_boxes(content: pd.Series) -> pd.Series:
        """The components of every class of a mask but the background; null if the mask can't be read."""
        out = []
        for c in content:
            pixels = decode(bytes(c)) if c is not None else None
            if pixels is None:
                out.append(None)
                continue
            index = class_indices(pixels)
            out.append([dict(zip(("cls", "area", "x0", "y0", "x1", "y1"), (int(k), *b), strict=True)) for k in np.unique(index) if int(k) not in background for b in components(index == k)])
        return pd.Series(out)

    return mask_boxes


def histogram_udf():
    @F.pandas_udf("array<struct<value:int,pixels:long>>")
    def histogram(content: pd.Series) -> pd.Series:
        out = []
        for c in content:
            pixels = decode(bytes(c)) if c is not None else None
            if pixels is None:
                out.append(None)
                continue
            values, n = np.unique(class_indices(pixels), return_counts=True)
            out.append([{"value": int(v), "pixels": int(k)} for v, k in zip(values, n, strict=True)])
        return pd.Series(out)

    return histogram
