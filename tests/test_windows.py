"""Medians in circular windows, against every pair compared, and what they shuffle."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from strandline.operators import continental


def shuffled(spark, df):
    """(rows, MB that were written to shuffles meanwhile) of a frame."""
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()

    def written():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size())) / 1e6

    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before, rows = written(), df.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return rows, written() - before


def frames(spark, centres, points):
    """Centres (cid, x, y) and points (x, y, {year: dist})."""
    c = spark.createDataFrame(centres, "cid long, x double, y double")
    p = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(points)], "uid long, x double, y double").withColumn("certainty", F.lit("good"))
    return c, p, spark.createDataFrame([(i, year, d) for i, (_, _, ds) in enumerate(points) for year, d in ds.items()], "uid long, year int, dist double")


def by_pairs(centres, points, radius):
    """({cid: n}, {(cid, year): median})"""
    n, held = {}, {}
    for cid, cx, cy in centres:
        for x, y, ds in points:
            if (x - cx) * (x - cx) + (y - cy) * (y - cy) < radius * radius:
                n[cid] = n.get(cid, 0) + 1
                for year, d in ds.items():
                    held.setdefault((cid, year), []).append(d)
    return n, {k: statistics.median(v) for k, v in held.items()}


def same(medians, want):
    got = {(r.cid, r.year): r.dist for r in medians}
    assert len(got) == len(medians) and got.keys() == want.keys()
    # rounded to two places; the last bit of a half is the library's
    assert all(abs(got[k] - want[k]) <= 0.005 + 1e-9 for k in want)


def test_large_windows_make_no_row_for_a_pair(spark):
    r = random.Random(3)
    centres = [(i, r.uniform(0, 100), r.uniform(0, 100)) for i in range(120)]
    points = [(r.uniform(0, 100), r.uniform(0, 100), {y: r.uniform(-50, 50) for y in range(2000, 2006) if r.random() < 0.8}) for _ in range(1500)]
    stats, mb = shuffled(spark, continental.hotspots(*frames(spark, centres, points), 60.0)[0])
    n, medians = by_pairs(centres, points, 60.0)
    assert {r.cid: r.n for r in stats} == {c: n.get(c, 0) for c, _, _ in centres}
    assert mb < 2  # 100,000 pairs of five years each are 4 MB and more
    fits = {c: statistics.linear_regression([y for k, y in medians if k == c], [round(d, 2) for (k, y), d in medians.items() if k == c]) for c, _, _ in centres}
    assert all(r.rate == pytest.approx(fits[r.cid].slope, abs=0.01) for r in stats)


def test_small_windows_over_many_tiles(spark):
    """Clusters on both sides of tiles' borders and of zero, places on a circle (not in it), equal places, equal values."""
    r = random.Random(5)
    spots = [(40.0 * i, 40.0 * j) for i in range(-3, 4) for j in range(-2, 3)]
    centres = [(i, x + r.choice([0.0, r.uniform(-9, 9)]), y + r.choice([0.0, r.uniform(-9, 9)])) for i, (x, y) in enumerate(spots * 6)]
    around = [(x + r.uniform(-25, 25), y + r.uniform(-25, 25)) for x, y in spots for _ in range(60)]
    exact = [(x + dx, y + dy) for x, y in spots for dx, dy in ((10, 0), (-10, 0), (0, 10), (6, 8), (-8, 6), (0, 0), (0, 0))]
    points = [(x, y, {y_: float(r.choice([r.randrange(4), r.uniform(-50, 50)])) for y_ in range(2000, 2000 + r.randrange(9))}) for x, y in around + exact]
    stats, mb = shuffled(spark, continental.hotspots(*frames(spark, centres, points), 10.0)[0])
    n, medians = by_pairs(centres, points, 10.0)
    assert {k.cid: k.n for k in stats} == {c: n.get(c, 0) for c, _, _ in centres}
    same(continental.hotspots(*frames(spark, centres, points), 10.0)[1].collect(), medians)
    # many centres in one place: their pairs are not shuffled either
    crowd = [(i, r.uniform(-5, 5), r.uniform(-5, 5)) for i in range(300)]
    points = [(r.uniform(-9, 9), r.uniform(-9, 9), {y: r.uniform(-50, 50) for y in range(2000, 2006)}) for _ in range(600)]
    stats, mb = shuffled(spark, continental.hotspots(*frames(spark, crowd, points), 10.0)[0])
    assert {k.cid: k.n for k in stats} == by_pairs(crowd, points, 10.0)[0]
    assert mb < 2


def test_window_medians_of_odd_rows(spark):
    """A cid at several places is one window, a missing year is a year, points without years count, a place must be finite."""
    inf, nan = float("inf"), float("nan")
    c = spark.createDataFrame([(1, 0.0, 0.0), (2, 500.0, 500.0), (3, 0.0, 1.0), (3, 0.0, 1.0), (3, 100.0, 0.0), (4, None, 0.0), (5, nan, 0.0), (6, inf, 0.0), (6, inf, 0.0), (None, 0.0, 2.0), (7, 300.0, 0.0)], "cid long, x double, y double")
    places = [("a", 0.0, 0.0), ("b", 1.0, 0.0), ("b", 1.0, 0.0), ("c", 100.0, 1.0), ("d", None, 0.0), ("e", nan, 0.0), ("f", inf, 0.0), ("g", 2.0, 0.0), ("h", 3.0, 0.0), ("i", 300.0, 1.0)]
    p = spark.createDataFrame(places, "uid string, x double, y double").withColumn("certainty", F.when(F.col("uid") == "h", "extreme value (> 200 m)").otherwise("good"))
    rows = [("a", 2000, 1.0), ("a", None, 4.0), ("b", 2000, 2.0), ("c", 2000, 9.0), ("c", 2001, 0.125), ("g", 2001, None), ("d", 2000, 99.0), ("e", 2000, 99.0), ("f", 2000, 99.0), ("h", 2000, 99.0)]
    stats, medians = continental.hotspots(c, p, spark.createDataFrame(rows, "uid string, year int, dist double"), 10.0)
    got = sorted(((r.cid, r.year, r.dist) for r in medians.collect()), key=str)
    # cid 3 meets a, b, b and g twice, and c once: 1, 2, 2, 1, 2, 2, 9
    assert got == sorted([(1, 2000, 2.0), (1, None, 4.0), (3, 2000, 2.0), (3, 2001, 0.12), (3, None, 4.0), (None, 2000, 2.0), (None, None, 4.0)], key=str)
    rows = [(r.cid, r.n, r.n_reg) for r in stats.collect()]
    assert sorted(rows, key=str) == sorted([(1, 4, 1), (2, 0, None), *[(3, 9, 2)] * 3, (4, 0, None), (5, 0, None), (6, 0, None), (6, 0, None), (None, 0, None), (7, 1, None)], key=str)


def test_window_medians_shuffle_no_pairs(spark):
    r = random.Random(9)
    centres = [(i, r.uniform(0, 100), r.uniform(0, 100)) for i in range(150)]
    points = [(r.uniform(0, 100), r.uniform(0, 100), {y: r.uniform(-50, 50) for y in range(2000, 2006)}) for _ in range(1200)]
    medians, mb = shuffled(spark, continental.hotspots(*frames(spark, centres, points), 50.0)[1])
    same(medians, by_pairs(centres, points, 50.0)[1])
    assert mb < 2
    # without any centre or point
    c, p, d = frames(spark, centres, points)
    assert continental.hotspots(c.where("false"), p, d, 50.0)[1].count() == 0
    assert continental.hotspots(c, p.where("false"), d, 50.0)[1].count() == 0
    assert continental.hotspots(c, p, d.where("false"), 50.0)[1].count() == 0


def test_repeated_centres_shuffle_no_pairs(spark):
    """A centre's row that is repeated as it is counts its points as often, with the same medians; a null cid is one too."""
    r = random.Random(12)
    once = [(None if i == 7 else i, r.uniform(0, 100), r.uniform(0, 100)) for i in range(20)]
    centres = [c for i, c in enumerate(once) for _ in range(1 + i % 10 * 5)]
    points = [(r.uniform(0, 100), r.uniform(0, 100), {y: r.uniform(-50, 50) for y in range(2000, 2006)}) for _ in range(1200)]
    f = frames(spark, centres, points)
    stats, mb = shuffled(spark, continental.hotspots(*f, 50.0)[0])
    n, medians = by_pairs(centres, points, 50.0)
    assert len(stats) == len(centres) and {k.cid: k.n for k in stats} == {c: n.get(c, 0) for c, _, _ in once if c is not None} | {None: 0}
    same(continental.hotspots(*f, 50.0)[1].collect(), medians)
    assert mb < 1.5
