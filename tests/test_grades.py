"""Appearance of graded pixels against plain loops, and the vote on the order of classes."""

import numpy as np

from loamstack.operators import grades


def test_pixel_stats_and_votes(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for i in range(6):
        h, w = int(rng.integers(2, 9)), int(rng.integers(1, 9))
        rgb, mask = rng.integers(0, 256, (h, w, 3)), rng.integers(0, 4, (h, w))
        rows.append((w, (rgb[..., 0] << 16 | rgb[..., 1] << 8 | rgb[..., 2]).ravel().tolist(), mask.ravel().tolist()))
        grey = rgb @ np.array([0.299, 0.587, 0.114])
        for cls in np.unique(mask).tolist():
            d = want.setdefault(cls, [0, 0, 0.0, 0.0, 0.0, 0.0])
            d[1] += 1
            for y, x in zip(*np.nonzero(mask == cls), strict=True):
                r, g, b = map(float, rgb[y, x])
                rough = (abs(grey[y, x] - grey[y, x - 1]) if x else 0) + (abs(grey[y, x] - grey[y - 1, x]) if y else 0)
                for k, v in enumerate((1, None, (r - b) / (r + b + 1), grey[y, x], (max(r, g, b) - min(r, g, b)) / (max(r, g, b) + 1), rough)):
                    d[k] += v or 0 if k != 1 else 0
    odd = [(2, [1, 2, 3], [1, 1, 1]), (None, [1], [1]), (1, None, [1]), (1, [1, 2], [1]), (0, [], []), (1, [None], [1])]
    df = spark.createDataFrame([*rows, *odd], "width int, pixels array<int>, mask array<int>")
    got = {r["cls"]: r for r in grades.pixel_stats(df).collect()}
    assert set(got) == set(want)
    for cls, (px, imgs, *sums) in want.items():
        assert (got[cls]["px"], got[cls]["imgs"]) == (px, imgs)
        assert np.allclose([got[cls][c] for c in ("redness", "brightness", "saturation", "roughness")], np.array(sums) / px)
    vote = lambda *s: [tuple(r) for r in grades.verdict(grades.direction(spark.createDataFrame(s, "cls int, px long, imgs long, redness double, brightness double, saturation double, roughness double"))).collect()]
    assert vote((0, 1, 1, 9.0, 0.0, 0.0, 0.0), (1, 90, 9, 0.1, 90.0, 0.0, 1.0), (2, 50, 7, 0.2, 80.0, 0.0, 2.0), (3, 10, 3, 0.3, 70.0, 0.0, 1.5)) == [(4, "as_given")]
    assert vote((1, 1, 1, 0.3, 1.0, 0.0, 2.0), (2, 5, 2, 0.2, 2.0, 0.0, 1.0)) == [(0, "reversed")]
    assert vote((0, 5, 2, 0.2, 2.0, 0.0, 1.0), (1, 5, 2, 0.2, 2.0, 0.0, 1.0)) == [] and vote((1, 5, 2, 0.2, 2.0, 0.0, 1.0), (2, 4, 2, 0.3, 2.0, 0.0, 1.0)) == [(2, "unclear")]


def test_mask_values_and_the_guess(spark):
    df = spark.createDataFrame([([0, 0, 2, 2, 2, 5],), ([5, None],), (None,), ([],)], "values array<int>")
    values = grades.mask_values(df)
    assert sorted((r["value"], r["px"], r["imgs"], round(r["share"], 4)) for r in values.collect()) == [(0, 2, 1, 0.2857), (2, 3, 1, 0.4286), (5, 2, 2, 0.2857)]
    assert dict(map(tuple, grades.guessed_map(values, ("good",)).collect())) == {2: "good", 5: None}
    many = grades.mask_values(spark.createDataFrame([(list(range(14)),)], "values array<int>"))
    assert grades.guessed_map(many, ("good",)).count() == 0 and grades.mask_values(df.limit(0)).count() == 0
