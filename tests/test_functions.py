"""Scalar functions, geometry and statistics against values worked out by hand or by published tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import dates, geometry, indices, stats, text
from strandline.operators import contours, movement, spatial, tides


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_indices(spark):
    c = lambda v: F.lit(v).cast("double")
    r = one(spark, indices.mndwi(c(0.3), c(0.1)), indices.ndwi(c(0.3), c(0.1)), indices.nirwi(c(0.128)), indices.twndwi(c(0.1), c(0.2), c(0.3)), indices.twndwi(c(0.1), c(0.1), c(0.3)), indices.mndwi(c(0.0), c(0.0)))
    assert list(r)[:3] == pytest.approx([0.5, 0.5, 0.0])
    assert r[3] == pytest.approx(0.5 * -0.5 + 0.5 * (0.1 - 0.2) / 0.3) and r[4] == pytest.approx(0.5 * -0.5 + 0.5 * (0.128 - 0.1) / 0.228) and r[5] is None


def test_stored_form(spark):
    df = spark.createDataFrame([(1, 0.12345, 3, 0.5), (2, None, None, None), (3, 9.0, 1, 0.1)], "k int, green double, count int, green_mad double")
    stored = indices.quantize(df, ["k"]).orderBy("k").collect()
    assert [r.green for r in stored] == [1235, -32767, -32767] and [r["count"] for r in stored] == [3, None, 1]
    assert [r.green for r in indices.unscale(indices.quantize(df, ["k"]), ["k"]).orderBy("k").collect()] == [0.1235, None, None]
    assert one(spark, indices.bit_clear(F.lit(24), 8), indices.finite(F.lit(float("inf"))), indices.finite(F.lit(float("nan")))) == (False, None, None)


def test_periods(spark):
    y = spark.createDataFrame([(2000,), (2001,)], "year int")
    assert [tuple(r) for r in dates.composite_periods(y, (1, 3)).orderBy("year", "period_len").collect()] == [(2000, 1, "2000"), (2000, 3, "1999/2001"), (2001, 1, "2001"), (2001, 3, "2000/2002")]
    with pytest.raises(ValueError):
        dates.composite_label(F.col("year"), 2)
    r = one(spark, dates.middle_year(F.lit("1999/2001")), dates.middle_year(F.lit("1999")), dates.years_of_range(F.lit("1999_2001")), dates.years_of_range(F.lit("2003")))
    assert tuple(r) == (2000, 1999, [1999, 2000, 2001], [2003])


def test_times(spark):
    r = one(spark, dates.parsed(F.lit("2020-01-02T03:04:05Z")), dates.parsed(F.lit("2020-01-02T03:04:05.123456Z")), dates.parsed(F.lit("x")), dates.utc_of_local(F.to_date(F.lit("2020-07-01")), "10:30", F.lit("Pacific/Honolulu")))
    assert r[0].second == 5 and r[1].microsecond == 123456 and r[2] is None and (r[3].day, r[3].hour, r[3].minute) == (1, 20, 30)


def test_geohash(spark):
    r = one(spark, geometry.geohash(F.lit(57.64911), F.lit(10.40744), 11), geometry.geohash(F.lit(57.64911), F.lit(10.40744), 10), geometry.geohash(F.lit(90.0), F.lit(180.0), 2))
    assert tuple(r) == ("u4pruydqqvj", "u4pruydqqv", "zz")


def test_mercator(spark):
    lat, lon = F.lit(-17.5), F.lit(-179.5)
    x, y = geometry.to_mercator_x(lon), geometry.to_mercator_y(lat)
    r = one(spark, x, y, geometry.to_longitude(x), geometry.to_latitude(y), geometry.shifted_longitude(lon))
    assert r[0] == pytest.approx(math.radians(30.5) * 6378137) and r[1] == pytest.approx(-1967000, rel=0.01)
    assert r[2] == pytest.approx(-179.5) and r[3] == pytest.approx(-17.5, abs=1e-9) and r[4] == 180.5


def line(*points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def test_shapes(spark):
    square = line((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    r = one(spark, geometry.length(square), geometry.area(square), geometry.inside(F.lit(1.0), F.lit(1.0), square), geometry.inside(F.lit(5.0), F.lit(1.0), square), geometry.bounds(square), geometry.line_centroid(line((0, 0), (2, 0))), geometry.line_centroid(line((1, 1))), geometry.length(line((1, 1))))
    assert tuple(r)[:4] == (16.0, 16.0, True, False) and tuple(r[4]) == (0, 0, 4, 4) and tuple(r[5]) == (1.0, 0.0) and r[6].x is None and r[7] == 0.0
    p = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    c = one(spark, geometry.crossing(p(0, 0), p(2, 2), p(0, 2), p(2, 0)), geometry.crossing(p(0, 0), p(1, 0), p(0, 1), p(1, 1)), geometry.nearest_on_segment(F.lit(3.0), F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(0.0)))
    assert tuple(c[0]) == (1.0, 1.0) and c[1] is None and tuple(c[2]) == (2.0, 0.0)


def test_a_point_on_a_ring_is_not_in_it(spark):
    square, diamond = line((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), line((-2, 0), (0, -2), (2, 0), (0, 2), (-2, 0))
    at = [(1.0, 0.0), (0.0, 1.0), (4.0, 1.0), (1.0, 4.0), (0.0, 0.0), (4.0, 4.0)]
    assert not any(one(spark, *[geometry.inside(F.lit(x), F.lit(y), square) for x, y in at]))
    assert not any(one(spark, *[geometry.inside(F.lit(x), F.lit(y), diamond) for x, y in [(-2.0, 0.0), (0.0, -2.0), (-1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]]))
    assert all(one(spark, *[geometry.inside(F.lit(x), F.lit(y), square) for x, y in [(1.0, 1e-9), (1e-9, 4 - 1e-9), (3.0, 2.0)]], geometry.inside(F.lit(0.0), F.lit(0.0), diamond)))
    # a place on the side of two zones is in neither
    zones = spark.createDataFrame([("a", 0.0), ("b", 4.0)], "zone string, y0 double").select("zone", F.array(*[F.struct(F.lit(x).alias("x"), (F.col("y0") + dy).alias("y")) for x, dy in [(-4.0, 0.0), (4.0, 0.0), (4.0, 4.0), (-4.0, 4.0), (-4.0, 0.0)]]).alias("ring"))
    points = spark.createDataFrame([(0, 1.0, 0.0), (1, 1.0, 2.0), (2, 1.0, 4.0), (3, 1.0, 5.0), (4, -4.0, 5.0)], "i int, x double, y double")
    assert {r.i: r.zone for r in spatial.zone_at(points, zones, 3.0).collect()} == {0: "Etc/GMT", 1: "a", 2: "Etc/GMT", 3: "b", 4: "Etc/GMT"}


def test_names(spark):
    r = one(spark, text.tile_id(F.lit(7), F.lit(12)), text.pair_id(F.lit(7), F.lit(12)), text.path_safe(F.lit("1999/2001")), text.without_stage(F.lit("0-7-0_raw")), text.mgrs_code(F.lit("01KAB")), geometry.utm_epsg(F.lit(7)), geometry.proj_text(F.lit(60), F.lit("S")))
    assert tuple(r) == ("007012", "7,12", "1999_2001", "0-7-0", "MGRS-1KAB", 32607, "+proj=utm +zone=60 +south")


@pytest.mark.parametrize(("t", "df", "p"), [(2.228, 10, 0.05), (12.706, 1, 0.05), (2.845, 20, 0.01), (0.0, 5, 1.0), (1.96, 10_000, 0.05), (-2.228, 10, 0.05), (4.303, 2, 0.05), (3.182, 3, 0.05), (2.776, 4, 0.05), (1e9, 7, 0.0)])
def test_students_t(spark, t, df, p):
    got = spark.range(1).select(stats.t_test(F.lit(t), F.lit(df)).alias("p")).first().p
    assert got == pytest.approx(p, abs=2e-4)


def test_regression_and_agreement(spark):
    d = spark.createDataFrame([("a", 2000 + i, 2.0 * i + 1) for i in range(6)] + [("b", 2000, 1.0)] + [("c", 2000 + i, [0.0, 2.0, 1.0][i]) for i in range(3)], "uid string, year int, dist double")
    r = {x.uid: x for x in movement.regressions(d).collect()}
    assert r["a"].rate == pytest.approx(2) and r["a"].se == pytest.approx(0, abs=1e-6) and r["b"].rate is None and r["b"].sig is None
    assert r["c"].rate == pytest.approx(0.5) and r["c"].se == pytest.approx(math.sqrt(1.5 / 1 / 2)) and r["c"].sig == pytest.approx(1 - 2 / math.pi * math.atan(0.5 / math.sqrt(0.75)))
    v = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "v double, t double").agg(*stats.agreement("v", "t")).first()
    mean = (1.5 + 2 + 3) / 3
    assert v.n == 3 and v.mae == pytest.approx(0.5) and v.r2 == pytest.approx(1 - (0.25 + 0 + 1) / sum((t - mean) ** 2 for t in (1.5, 2, 3)))


def test_robust_regression_names_its_outliers(spark):
    d = spark.createDataFrame([("a", 2000 + i, 100.0 if i == 4 else 0.01 * (-1) ** i + i) for i in range(10)], "uid string, year int, dist double")
    r = movement.robust_regressions(d).first()
    assert r.outl == "2004" and r.rate == pytest.approx(1, abs=0.01) and r.n_reg == 9


def test_all_time_stats_and_certainty(spark):
    d = spark.createDataFrame([("a", 2001, 3.0), ("a", 2003, 5.0), ("a", 2002, None), ("a", 2004, 1.0)], "uid string, year int, dist double")
    assert tuple(movement.all_time_stats(d, 1999).first()) == ("a", 3, 4, 4.0, -2.0, 2003, 2004)
    assert tuple(movement.all_time_stats(d, 2003).first())[4] == -4.0
    c = movement.certainty
    L = lambda x: F.lit(x)  # noqa: E731, N806
    r = one(spark, c(L(300.0), L(40.0), L(3), 15), c(L(300.0), L(40.0), L(30), 15), c(L(-300.0), L(4.0), L(30), 15), c(L(1.0), L(None).cast("double"), L(15), 15))
    assert tuple(r) == ("insufficient observations", "high angular variability", "extreme value (> 200 m)", "good")


def test_points_along_a_line(spark):
    v = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 50.0, 0.0), (1, 2, 50.0, 40.0)], "line int, seq int, x double, y double")
    got = sorted(tuple(r)[1:] for r in movement.points_along(v, ["line"], 30.0).collect())
    assert got == [(0, 0.0, 0.0), (1, 30.0, 0.0), (2, 50.0, 10.0)]
    t = {r.k: r for r in movement.transects(v, ["line"], 30.0, 5.0).collect()}
    assert (t[1].ax, t[1].ay, t[1].bx, t[1].by) == (30.0, -5.0, 30.0, 5.0)


def test_movement_and_windows_find_all_pairs(spark):
    r = random.Random(8)
    a = [(i, r.uniform(-50, 50), r.uniform(-50, 50)) for i in range(60)]
    b = [(2000 + i % 3, r.uniform(-50, 50), r.uniform(-50, 50)) for i in range(200)]
    got = {(x.uid, x.year): x.dist for x in movement.annual_movements(spark.createDataFrame(a, "uid int, x double, y double"), spark.createDataFrame(b, "year int, x double, y double"), most=7.0).collect()}
    want = {}
    for uid, x, y in a:
        for year, p, q in b:
            d = math.dist((x, y), (p, q))
            if d <= 7:
                want[uid, year] = min(d, want.get((uid, year), 99))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    near = spatial.within(spark.createDataFrame(a, "cid int, x double, y double"), spark.createDataFrame(b, "year int, x double, y double"), 9.0, ["cid"]).count()
    assert near == sum(math.dist((x, y), (p, q)) < 9 for _, x, y in a for _, p, q in b)


def test_box_overlay_finds_each_pair_once(spark):
    r = random.Random(6)
    box = lambda i: (i, x := r.uniform(-30, 30), y := r.uniform(-30, 30), x + r.uniform(0.1, 25), y + r.uniform(0.1, 25))
    a, b = [box(i) for i in range(40)], [box(i) for i in range(40)]
    schema = "{} int, minx double, miny double, maxx double, maxy double"
    got = [(x.i, x.j) for x in spatial.box_overlay(spark.createDataFrame(a, schema.format("i")), spark.createDataFrame(b, schema.format("j")), 7.0).collect()]
    want = {(p[0], q[0]) for p in a for q in b if p[1] < q[3] and q[1] < p[3] and p[2] < q[4] and q[2] < p[4]}
    assert len(got) == len(set(got)) and set(got) == want


def test_contours_go_around_a_hill(spark):
    rows = [(1, x, y, 6.25 - (x - 5) ** 2 - (y - 5) ** 2) for x in range(11) for y in range(11)]
    g = spark.createDataFrame(rows, "year int, x int, y int, v double")
    lines = contours.contour_lines(g, ["year"], "v").collect()
    assert len(lines) == 1
    v = [(p.x, p.y) for p in lines[0].vertices]
    assert v[0] == pytest.approx(v[-1]) and all(math.dist(p, (5, 5)) == pytest.approx(2.5, abs=0.15) for p in v)
    assert contours.zero_crossings(g, ["year"], "v").count() == len(v) - 1


def test_a_saddle_has_two_lines(spark):
    g = spark.createDataFrame([(1, 0, 0, 1.0), (1, 1, 0, -1.0), (1, 0, 1, -1.0), (1, 1, 1, 1.5)], "year int, x int, y int, v double")
    s = contours.contour_segments(g, ["year"], "v").collect()
    assert len(s) == 2 and not any({(a.ax, a.ay), (a.bx, a.by)} == {(0.5, 0.0), (0.0, 0.5)} for a in s)


def test_bilinear_needs_only_cells_with_weight(spark):
    coarse = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0), (0, 1, 5.0)], "cx int, cy int, h double").withColumn("t", F.lit(1))
    fine = spark.createDataFrame([(1, 0.5, 0.0), (2, 0.0, 0.25), (3, 0.5, 0.5), (4, 1.0, 0.0), (5, 2.0, 0.0)], "i int, x double, y double").withColumn("t", F.lit(1))
    got = {r.i: r.h for r in tides.bilinear(fine, coarse, "h", F.col("x"), F.col("y"), ["t"]).collect()}
    assert got == {1: 2.0, 2: 2.0, 3: None, 4: 3.0, 5: None}


def test_tide_bounds(spark):
    t = spark.createDataFrame([(0, d, h) for d, h in enumerate([-4.0, -2.0, 0.0, 2.0, 4.0])], "cell int, ts int, height double")
    obs = spark.createDataFrame([(0, d, 1.0) for d in range(7)], "cell int, ts int, green double")
    got = lambda strict: {r.ts: r.green for r in tides.tide_filter(obs, t, ["cell"], ["green"], strict).collect()}
    assert got(False) == {1: 1.0, 2: 1.0, 3: 1.0} and got(True) == {1: None, 2: 1.0, 3: None}
