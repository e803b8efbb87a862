"""Zero contours of cell grids: crossings on grid edges, segments of marching squares, and lines stitched from them."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A crossing lies at the share a / (a - b) of the way from the cell with value a to its neighbour with value b.


def right_and_up(grid: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The grid with the values of the cell to the right, the cell above and the one above right, null where there is none."""
    row, column = Window.partitionBy(*keys, "y").orderBy("x"), Window.partitionBy(*keys, "x").orderBy("y")
    wide = grid.select(*keys, "x", "y", F.col(value).alias("v")).withColumn("right", F.when(F.lead("x").over(row) == F.col("x") + 1, F.lead("v").over(row)))
    next_up = F.lead("y").over(column) == F.col("y") + 1
    return wide.withColumns({"up": F.when(next_up, F.lead("v").over(column)), "up_right": F.when(next_up, F.lead("right").over(column))})


def zero_crossings(grid: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, x, y, axis, cx, cy): where the value changes its sign between a cell and the next along x or y. Zero counts as
    not negative, nulls cross nothing."""
    wide = right_and_up(grid, keys, value)

    def along(axis: str, other: str, dx: int, dy: int) -> DataFrame:
        t = F.col("v") / (F.col("v") - F.col(other))
        met = (F.col("v") < 0) != (F.col(other) < 0)
        return wide.where(met).select(*keys, "x", "y", F.lit(axis).alias("axis"), (F.col("x") + t * dx).alias("cx"), (F.col("y") + t * dy).alias("cy"))

    return along("x", "right", 1, 0).unionByName(along("y", "up", 0, 1))


def contour_segments(grid: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, x, y, ax, ay, bx, by): the segments of the zero contour in every 2 x 2 block of non-null cells.

    A block with four crossings (a saddle) has two segments; the mean of its corners tells which corners they cut off.
    """
    w = right_and_up(grid, keys, value).where("v is not null and right is not null and up is not null and up_right is not null")
    v, r, u, d = (F.col(c) for c in ("v", "right", "up", "up_right"))
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    share = lambda a, b: F.try_divide(a, a - b)
    at = lambda px, py: F.struct(px.alias("x"), py.alias("y"))
    edge = lambda a, b, p: F.when((a < 0) != (b < 0), p)
    bottom, top = edge(v, r, at(x + share(v, r), y)), edge(u, d, at(x + share(u, d), y + 1))
    left, right = edge(v, u, at(x, y + share(v, u))), edge(r, d, at(x + 1, y + share(r, d)))
    w = w.withColumns({"e": F.array_compact(F.array(bottom, right, top, left)), "middle": (v + r + u + d) / 4})
    segment = lambda a, b: F.struct(F.col("e")[a].alias("a"), F.col("e")[b].alias("b"))
    joined_low = (F.col("middle") < 0) == (v < 0)  # the corner (x, y) is joined with the opposite one
    two = F.when(joined_low, F.array(segment(0, 1), segment(2, 3))).otherwise(F.array(segment(3, 0), segment(1, 2)))
    s = w.select(*keys, "x", "y", F.explode(F.when(F.size("e") == 4, two).when(F.size("e") == 2, F.array(segment(0, 1)))).alias("s"))
    return s.select(*keys, "x", "y", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"))


def stitch(ax: list[float], ay: list[float], bx: list[float], by: list[float]) -> list[list[tuple[float, float]]]:
    """Lines from segments that share ends; open lines first, then rings, each from its smallest end."""
    a, b = list(zip(ax, ay, strict=True)), list(zip(bx, by, strict=True))
    near = lambda p: (round(p[0], 9), round(p[1], 9))
    ends: dict[tuple[float, float], list[int]] = defaultdict(list)
    for i in range(len(a)):
        ends[near(a[i])].append(i)
        ends[near(b[i])].append(i)
    used = [False] * len(a)
    lines = []

    def follow(start: tuple[float, float]) -> list[tuple[float, float]]:
        line, here = [start], near(start)
        while nxt := [i for i in ends[here] if not used[i]]:
            i = nxt[0]
            used[i] = True
            to = b[i] if near(a[i]) == here else a[i]
            line.append(to)
            here = near(to)
        return line

    for p in sorted(ends):
        if len(ends[p]) % 2 and any(not used[i] for i in ends[p]):
            lines.append(follow(p))
    for p in sorted(ends):
        if any(not used[i] for i in ends[p]):
            lines.append(follow(p))
    return lines


def contour_lines(grid: DataFrame, keys: list[str], value: str, min_vertices: int = 5) -> DataFrame:
    """(keys, part, vertices): the zero contour's lines with at least min_vertices vertices; one group a tile and year."""
    segments = contour_segments(grid, keys, value)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in segments.select(*keys).schema)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["x", "y", "ax", "ay", "bx", "by"])
        lines = [v for v in stitch(*(frame[c].tolist() for c in ("ax", "ay", "bx", "by"))) if len(v) >= min_vertices]
        head = {k: [frame[k].iloc[0]] * len(lines) for k in keys}
        return pd.DataFrame({**head, "part": list(range(len(lines))), "vertices": [[{"x": x, "y": y} for x, y in v] for v in lines]})

    return segments.groupBy(*keys).applyInPandas(run, f"{fields}, part int, vertices array<struct<x:double,y:double>>")


def pixel_certainty(stack: DataFrame, stdev: str = "twndwi_mad", threshold: float = 0.3, low: int = 5) -> DataFrame:
    """Adds ``certainty`` to each cell and year: high spread, few observations, or good."""
    return stack.withColumn("certainty", F.when(F.col(stdev) > threshold, "tidal issues").when(F.col("count") < low, "insufficient data").otherwise("good"))


def line_certainty(lines: DataFrame, pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Adds to every line the most frequent certainty of the cells under its vertices, ties by name."""
    v = lines.select(*keys, "part", F.explode("vertices").alias("p")).select(*keys, "part", F.round("p.x").cast("long").alias("x"), F.round("p.y").cast("long").alias("y"))
    counts = v.join(pixels.select(*keys, "x", "y", "certainty"), [*keys, "x", "y"]).groupBy(*keys, "part", "certainty").agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys, "part").agg(F.max_by("certainty", F.struct("n", "certainty")).alias("certainty"))
    return lines.join(best, [*keys, "part"], "left")
