"""Regions of striped masks against a plain flood fill."""

import numpy as np
import pytest

from loamstack.operators import stripes


def flood(mask):
    h, w = mask.shape
    seen, out = np.zeros((h, w), bool), []
    for y in range(h):
        for x in range(w):
            if mask[y, x] and not seen[y, x]:
                todo, cells = [(y, x)], []
                seen[y, x] = True
                while todo:
                    a, b = todo.pop()
                    cells.append((a, b))
                    for c, d in ((a - 1, b), (a + 1, b), (a, b - 1), (a, b + 1)):
                        if 0 <= c < h and 0 <= d < w and mask[c, d] == mask[y, x] and not seen[c, d]:
                            seen[c, d] = True
                            todo.append((c, d))
                ys, xs = zip(*cells, strict=True)
                out.append((int(mask[y, x]), len(cells), min(xs), min(ys), max(xs) + 1, max(ys) + 1))
    return sorted(out)


def masks():
    rng = np.random.default_rng(3)
    spiral = np.zeros((21, 21), int)
    y, x, dy, dx, n = 0, 0, 0, 1, 20
    while n > 0:
        for _ in range(2):
            for _ in range(n):
                spiral[y, x] = 1
                y, x = y + dy, x + dx
            dy, dx = dx, -dy
        n -= 2
    comb = np.zeros((12, 30), int)
    comb[:, ::2] = 2
    comb[-1] = 2
    return {"noise": (rng.random((40, 33)) < 0.55).astype(int), "classes": rng.integers(0, 3, (30, 30)), "spiral": spiral, "comb": comb, "full": np.ones((9, 5), int), "none": np.zeros((8, 8), int), "line": np.ones((1, 40), int)}


@pytest.mark.parametrize("height", [1, 4, 100])
def test_regions_against_flood_fill(spark, height):
    rows = [(name, k, at, m.shape[1], m[at : at + height].ravel().tolist()) for name, m in masks().items() for k, at in enumerate(range(0, len(m), height))]
    df = spark.createDataFrame([*rows, ("void", 0, 0, 0, []), ("nil", 0, 0, 4, None)], "id string, stripe int, top int, width int, pixels array<int>")
    found = stripes.regions(df)
    got = {}
    for r in found.collect():
        got.setdefault(r["id"], []).append((r["cls"], r["area"], r["x0"], r["y0"], r["x1"], r["y1"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: f for k, m in masks().items() if (f := flood(m))}
    if height == 4:
        sizes = spark.createDataFrame([(k, m.size) for k, m in masks().items()], "id string, pixels long")
        some = stripes.largest(found, sizes, 3, 0.02)
        kept = {}
        for r in some.collect():
            kept.setdefault((r["id"], r["cls"]), []).append((r["area"], r["x0"], r["y0"], r["x1"], r["y1"]))
        for k, m in masks().items():
            for cls in {c for c, *_ in flood(m)}:
                mine = sorted((f[1:] for f in flood(m) if f[0] == cls), key=lambda f: (-f[0], f[2], f[1]))
                want = [f for f in mine[:3] if f[0] >= 0.02 * m.size] or [(sum(f[0] for f in mine), min(f[1] for f in mine), min(f[2] for f in mine), max(f[3] for f in mine), max(f[4] for f in mine))]
                assert sorted(kept[k, cls]) == sorted(want)
