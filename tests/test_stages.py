"""The three stages, one after another, on a cube with an island that grows."""

import math
import random

from pyspark.sql import functions as F

from strandline import stages
from strandline.sources import sinks, tables


def scenes(spark):
    """A disk of land around (12, 12) whose radius is 4 cells in 2000 and grows half a cell a year; three scenes a year."""
    r = random.Random(1)
    rows = []
    for year in range(2000, 2006):
        for month in (2, 6, 10):
            for x in range(25):
                for y in range(25):
                    # bands change smoothly with the distance from the shore, so that contours are round
                    wet = math.dist((x, y), (12, 12)) - (4 + 0.5 * (year - 2000))
                    level = max(-1.0, min(1.0, wet / 2))
                    green, nir, swir = 0.2 + 0.1 * level, 0.2 - 0.1 * level, 0.2 - 0.1 * level
                    rows.append(("a", x, y, f"{year}-{month:02}-11 01:02:03", r.random() < 0.02, 0.1, green, 0.1, nir, swir, 0.1))
    return spark.createDataFrame(rows, "tile_id string, x int, y int, ts string, cloudy boolean, blue double, green double, red double, nir08 double, swir16 double, swir22 double").withColumn("ts", F.col("ts").cast("timestamp"))


def test_from_scenes_to_hotspots(spark, tmp_path):
    root = str(tmp_path / "mosaics")
    made = stages.mosaics(scenes(spark), ["ts"], 2000, 2005)
    sinks.write_mosaic(made, root)
    stored = tables.mosaics(spark, root)
    assert stored.count() == 2 * 6 * 625 and stored.where("period_len = 3").agg(F.max("count")).first()[0] == 9
    c = stages.shores(stored, res=30.0, first_year=2000, expansions=12, index="mndwi")
    lines = {r.year: r for r in c.lines.collect()}
    assert sorted(lines) == list(range(2000, 2006)) and len(c.lines.collect()) == 6
    radius = {y: sum(math.dist((p.x, p.y), (360, 360)) for p in r.vertices) / len(r.vertices) for y, r in lines.items()}
    assert all(abs(radius[y + 1] - radius[y] - 15) < 9 for y in range(2000, 2005))
    points = c.points.collect()
    assert len(points) > 25 and all(p.valid_obs == 6 and p.max_year == 2000 and p.certainty == "insufficient observations" for p in points)
    assert all(abs(p.rate_time - 0) < 40 and p.sig_time is not None for p in points)
    sinks.write_shore(str(tmp_path / "tile"), c.raster, c.lines, c.points)
    assert spark.read.parquet(str(tmp_path / "tile/rates_of_change")).count() == len(points)
    k = stages.continent([c], north=1e9, radii=(300.0, 100.0), first_year=2000)
    assert k.points.where("wms_good").count() == 0 and [r.year for r in k.shorelines.collect()] == list(range(2000, 2006))
    assert all(r.n == 0 and r.certainty == "insufficient points" for s in k.hotspots for r in s.collect())
    # the same from the command line
    out = str(tmp_path / "cli")
    c.distances.write.parquet(str(tmp_path / "tile/distances"))
    stages.main(spark, ["continent", f"{out}/all", str(tmp_path / "tile")])
    assert spark.read.parquet(f"{out}/all/rates_of_change").count() == len(points)
    assert spark.read.text(f"{out}/all/tiles/shorelines_annual").count() == 6


def lake_cube(spark):
    """An island that maps know, with a lake; a second one that only an addition names, in half of the years; and clouds' dirt
    that nothing is connected to."""
    rows = []
    for year in range(2000, 2006):
        for x in range(40):
            for y in range(40):
                island, lake = math.dist((x, y), (12, 12)) < 8.2, math.dist((x, y), (12, 12)) < 2.2
                second = math.dist((x, y), (30, 28)) < 4.2 and year >= 2004
                dirt = x in (33, 34) and y in (5, 6) and year == 2003
                v = -0.5 if (island and not lake) or second or dirt else 0.5
                rows.append(("a", x, y, year, v, v, v, v))
    return spark.createDataFrame(rows, "tile_id string, x int, y int, year int, twndwi double, mndwi double, ndwi double, nirwi double")


def test_lakes_go_and_added_islands_stay(spark):
    from strandline.operators import morphology

    grid = lake_cube(spark)
    cells = grid.select("tile_id", "x", "y").distinct()
    raster = spark.createDataFrame([(x, y, math.dist((x, y), (12, 12)) < 8.2) for x in range(40) for y in range(40)], "cx int, cy int, land boolean")
    ring = [(27.0, 25.0), (33.0, 25.0), (33.0, 31.0), (27.0, 31.0), (27.0, 25.0)]
    additions = spark.createDataFrame([([{"x": a, "y": b} for a, b in ring],)], "ring array<struct<x:double,y:double>>")
    land = morphology.land_masks(cells, raster, additions)
    assert land.where("mapped").count() == raster.where("land").count() and land.where("added").count() > 20
    for known, has_second in ((land, True), (morphology.land_masks(cells, raster), False)):
        got = {(r.x, r.y, r.year): r.twndwi for r in stages.shoreline_index(grid, land=known, radius=2, expansions=6).collect()}
        assert all(got[12, 12, y] is None for y in range(2000, 2006))  # the lake
        assert all(got[12, 4, y] is not None and got[12, 2, y] > 0 for y in range(2000, 2006))  # the shore
        assert all(got[33, 5, y] is None for y in range(2000, 2006))  # dirt
        assert (got[30, 28, 2005] is not None) == has_second
        assert all(got[38, 38, y] is None for y in range(2000, 2006))  # the open sea


def test_nothing_but_water_is_an_error(spark):
    import pytest

    stored = stages.mosaics(scenes(spark).withColumns({"green": F.lit(0.3), "nir08": F.lit(0.1), "swir16": F.lit(0.1)}), ["ts"], 2000, 2005)
    with pytest.raises(stages.NoShoreline):
        stages.shores(stored, first_year=2000, expansions=3, index="mndwi")


def test_large_neighbourhoods_are_those_of_offsets(spark):
    from strandline.operators import morphology

    r = random.Random(2)
    within = spark.createDataFrame([(1, x, y) for x in range(23) for y in range(19) if r.random() < 0.9], "year int, x int, y int")
    cells = within.where("pmod(hash(x, y), 17) = 0")
    there = lambda df: {(c.x, c.y) for c in df.collect()}
    held, places = there(cells), there(within)
    for radius in (5, 8):
        near = {p for p in places if any(math.dist(p, c) <= radius for c in held)}
        assert there(morphology.dilate(cells, ["year"], radius, within)) == near
        assert there(morphology.erode(within.join(cells, ["year", "x", "y"], "left_anti"), ["year"], radius, within)) == places - near


def test_polygons_of_a_raster(spark):
    from strandline.functions import geometry as g
    from strandline.operators import morphology

    rows = ["11100", "10100", "11100", "00011", "00010"]
    cells = spark.createDataFrame([(1, x, y) for y, row in enumerate(rows) for x, v in enumerate(row) if v == "1"], "year int, x int, y int")
    got = {x.n: x.rings for x in morphology.vectorized(cells, ["year"]).collect()}
    assert sorted(got) == [3, 8] and len(got[8]) == 2 and len(got[3]) == 1
    assert all((ring[0].x, ring[0].y) == (ring[-1].x, ring[-1].y) for rings in got.values() for ring in rings)
    areas = morphology.vectorized(cells, ["year"]).select("n", F.transform("rings", lambda r: g.area(r)).alias("a")).collect()
    assert {x.n: sorted(x.a) for x in areas} == {8: [1.0, 9.0], 3: [3.0]}


def test_settings():
    from strandline.settings import settings

    s = settings({"STRANDLINE_FIRST_YEAR": "2001", "STRANDLINE_PERIOD_LENGTHS": "1, 5,", "STRANDLINE_COUNTRIES": "FJ,VU"})
    assert (s.first_year, s.last_year, s.period_lengths, s.countries) == (2001, 2025, (1, 5), ("FJ", "VU"))
