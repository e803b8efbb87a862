"""Smoothing, components, gap filling and the growing zone against hand-made grids."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import morphology, stack


def grid(spark, rows, year=2000, name="v"):
    cells = [(year, x, y, None if v is None else float(v)) for y, row in enumerate(rows) for x, v in enumerate(row)]
    return spark.createDataFrame(cells, f"year int, x int, y int, {name} double")


def values(df, name="v"):
    return {(r.x, r.y): r[name] for r in df.collect()}


def test_smoothing_keeps_constants_and_leaves_edges_null(spark):
    got = values(morphology.smooth(grid(spark, [[1, 1, 1]] * 3), ["year"], ["v"]))
    assert got.pop((1, 1)) == pytest.approx(1.0) and set(got.values()) == {None} and len(got) == 8


def test_smoothing_weighs_what_is_there(spark):
    got = values(morphology.smooth(grid(spark, [[1, None, 3], [4, 5, 6], [7, 8, 9]]), ["year"], ["v"]))
    w = morphology.KERNEL
    want = (5 * w[0] + (4 + 6 + 8) * w[1] + (1 + 3 + 7 + 9) * w[2]) / (w[0] + 3 * w[1] + 4 * w[2])
    assert got[1, 1] == pytest.approx(want)


def test_a_null_centre_stays_null(spark):
    assert values(morphology.smooth(grid(spark, [[1, 2, 3], [4, None, 6], [7, 8, 9]]), ["year"], ["v"]))[1, 1] is None


def test_a_wider_kernel_smooths_more(spark):
    r = random.Random(4)
    g = grid(spark, [[r.random() for _ in range(9)] for _ in range(9)])
    spread = lambda sigma: np.var([v for v in values(morphology.smooth(g, ["year"], ["v"], sigma)).values() if v is not None])
    assert spread(1.0) < spread(0.4) < spread(0.1)


CORE = ["11100", "11100", "10000", "10000", "00000"]
CANDIDATE = ["00000", "00000", "11000", "11011", "00011"]
EXPECTED = ["00000", "00000", "11000", "11000", "00000"]


def cells(spark, rows):
    made = [(1, x, y) for y, row in enumerate(rows) for x, v in enumerate(row) if v == "1"]
    return spark.createDataFrame(made, "year int, x int, y int")


def there(df):
    return {(r.x, r.y) for r in df.collect()}


@pytest.mark.parametrize("connect", [morphology.connected_to, morphology.connected_by_rounds])
def test_components_that_touch_the_core(spark, connect):
    assert there(connect(cells(spark, CORE), cells(spark, CANDIDATE), ["year"])) == there(cells(spark, EXPECTED))
    assert there(connect(cells(spark, CORE), cells(spark, ["00000"]), ["year"])) == set()
    assert there(connect(cells(spark, ["001"]), cells(spark, ["110"]), ["year"])) == set()
    assert there(connect(cells(spark, ["10", "00"]), cells(spark, ["10", "01"]), ["year"])) == {(0, 0)}


def test_labels_of_random_grids():
    r = np.random.default_rng(3)
    for _ in range(30):
        x, y = np.nonzero(r.random((9, 9)) < 0.55)
        got = morphology.label(x, y)
        root = {(a, b): (a, b) for a, b in zip(x, y, strict=True)}
        changed = True
        while changed:
            changed = False
            for a, b in root:
                for n in ((a + 1, b), (a, b + 1), (a - 1, b), (a, b - 1)):
                    if n in root and root[n] < root[a, b]:
                        root[a, b], changed = root[n], True
        want = [root[a, b] for a, b in zip(x, y, strict=True)]
        assert len({*zip(got.tolist(), want, strict=True)}) == len(set(want)) == len(set(got.tolist()))


TRUTH = [
    ((2001, 2002, 2003), (1, None, 3), (1, 3, 3)), ((2001, 2002, 2003), (1, None, None), (1, 1, 1)), ((2001, 2002), (None, 5), (5, 5)),
    ((2001, 2002, 2003), (None, None, 5), (None, 5, 5)), ((2001, 2003), (1, None), (1, None)), ((2001, 2002, 2003), (None, None, None), (None, None, None)),
]


def test_gap_filling(spark):
    rows = [(i, y, v if v is None else float(v)) for i, (years, before, _) in enumerate(TRUTH) for y, v in zip(years, before, strict=True)]
    got = stack.fill_gaps(spark.createDataFrame(rows, "k int, year int, v double"), ["k"], ["v"]).collect()
    for i, (years, _, after) in enumerate(TRUTH):
        assert [r.v for r in sorted((r for r in got if r.k == i), key=lambda r: r.year)] == list(after), years


def test_dilation_and_erosion(spark):
    every = cells(spark, ["1" * 7] * 7)
    block = cells(spark, ["0000000", "0111110", "0111110", "0111110", "0111110", "0111110", "0000000"])
    assert there(morphology.erode(block, ["year"], 1, every)) == set(itertools.product(range(2, 5), repeat=2))
    assert there(morphology.dilate(cells(spark, ["000", "010"]), ["year"], 1)) == {(1, 0), (0, 1), (1, 1), (2, 1), (1, 2)}
    assert there(morphology.erode(every, ["year"], 2, every)) == there(every)


def test_zone_grows_over_land_only(spark):
    g = grid(spark, [[-1, -1, -1, 1, 1, 1, -1]])
    core = spark.createDataFrame([(2000, 0, 0)], "year int, x int, y int")
    grow = lambda n, **k: there(morphology.analysis_zone(core, g, ["year"], "v", n, 1, **k))
    assert grow(1) == {(0, 0), (1, 0)} and grow(64) == {(0, 0), (1, 0), (2, 0), (3, 0)} and grow(1, cap=True) == {(2, 0)}


def test_fallback_takes_few_or_missing_values_from_longer_composites(spark):
    one = spark.createDataFrame([(1, 10, 1.0), (2, 4, 1.0), (3, 9, None), (4, 2, None)], "k int, count int, v double")
    three = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "k int, v double")
    got = {r.k: r.v for r in stack.with_fallback(one, [three], ["k"], ["v"]).collect()}
    assert got == {1: 1.0, 2: 6.0, 3: 7.0, 4: None}


def test_wide_years_and_back(spark):
    df = spark.createDataFrame([(1, 2000, 0.5), (1, 2001, None), (2, 2001, 2.0)], "uid int, year int, dist double")
    wide = stack.years_as_columns(df, ["uid"], "dist", [2000, 2001], "dist_")
    assert wide.columns == ["uid", "dist_2000", "dist_2001"]
    assert {(r.uid, r.year): r.dist for r in stack.columns_as_years(wide, ["uid"]).where(F.col("dist").isNotNull()).collect()} == {(1, 2000): 0.5, (2, 2001): 2.0}
