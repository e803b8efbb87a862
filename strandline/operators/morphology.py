"""Neighbourhoods on cell grids: smoothing, dilation, erosion, connected components, analysis zones and inland water.

A grid is a table with ``keys`` (a tile, a year), integer ``x`` and ``y``, and values. Small neighbourhoods are joins with
offsets; large radii and region growing within a tile run in numpy, one group a tile and year.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of a 3 x 3 Gaussian of sigma 0.799: centre, side and corner. Fixed values.
KERNEL = {0: 0.2501676, 1: 0.1249999860, 2: 0.0624581069}


def disk(radius: int) -> list[tuple[int, int]]:
    """Offsets within a radius."""
    r = range(-radius, radius + 1)
    return [(dx, dy) for dx in r for dy in r if dx * dx + dy * dy <= radius * radius]


def spread(cells: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Every row once for each offset, moved by it; the offset stays as (dx, dy)."""
    table = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets])
    moved = cells.withColumn("_o", F.explode(table))
    return moved.withColumns({"x": F.col("x") + F.col("_o.dx"), "y": F.col("y") + F.col("_o.dy"), "dx": F.col("_o.dx"), "dy": F.col("_o.dy")}).drop("_o")


def kernel_weights(sigma: float) -> dict[int, float]:
    """Weights of a 3 x 3 Gaussian by squared distance from the centre, truncated at three cells and reflected inside."""
    if abs(sigma - 0.799) < 1e-12:
        return KERNEL
    radius = int(4 * sigma + 0.5)
    line = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    line /= line.sum()
    at = lambda k: line[radius + k] if abs(k) <= radius else 0.0
    # beyond the 3 x 3 block, an impulse in its middle is reflected back at the block's edge
    centre = sum(at(k) for k in range(-radius, radius + 1) if k % 6 in (0, 3)) if radius > 1 else at(0)
    side = (1 - centre) / 2
    return {0: centre * centre, 1: centre * side, 2: side * side}


def smooth(grid: DataFrame, keys: list[str], values: list[str], sigma: float = 0.799) -> DataFrame:
    """The weighted mean of the non-null values in a 3 x 3 block; null at edges (a place of the block is missing), and where the
    middle is null.

    A cell's neighbours along x are added up in its row, then its neighbours' sums along y in its column: two sorts, and no
    row is multiplied.
    """
    weights = kernel_weights(sigma)
    row, column = Window.partitionBy(*keys, "y").orderBy("x"), Window.partitionBy(*keys, "x").orderBy("y")

    def beside(name: str, along: str, over) -> tuple[Column, Column]:  # noqa: ANN001
        there = F.col(along)
        return tuple(F.when(f(along).over(over) == there + step, f(name).over(over)) for f, step in ((F.lag, -1), (F.lead, 1)))

    zero, one = F.lit(0.0), F.lit(1)
    cells = grid.select(*keys, "x", "y", *values).withColumn("_one", one)
    sides = {"_wide": sum((F.coalesce(n, F.lit(0)) for n in beside("_one", "x", row)), F.lit(0))}
    for v in values:
        a, b = beside(v, "x", row)
        sides |= {f"_s_{v}": F.coalesce(a, zero) + F.coalesce(b, zero), f"_n_{v}": F.when(a.isNotNull(), 1).otherwise(0) + F.when(b.isNotNull(), 1).otherwise(0), f"_v_{v}": F.coalesce(v, zero), f"_h_{v}": F.when(F.col(v).isNotNull(), 1).otherwise(0)}
    wide = cells.withColumns(sides)

    def around(name: str) -> Column:
        return sum((F.coalesce(n, F.lit(0)) for n in beside(name, "y", column)), F.lit(0))

    whole = (F.col("_wide") == 2) & (around("_wide") == 4)
    out = {}
    for v in values:
        total = F.col(f"_v_{v}") * weights[0] + (F.col(f"_s_{v}") + around(f"_v_{v}")) * weights[1] + around(f"_s_{v}") * weights[2]
        weight = F.col(f"_h_{v}") * weights[0] + (F.col(f"_n_{v}") + around(f"_h_{v}")) * weights[1] + around(f"_n_{v}") * weights[2]
        out[f"_o_{v}"] = F.when(whole & F.col(v).isNotNull(), total / weight)
    return wide.withColumns(out).select(*keys, "x", "y", *[F.col(f"_o_{v}").alias(v) for v in values])


#: Beyond this radius neighbourhoods are found on a tile's raster, not by joins with offsets.
SMALL = 4


def rastered(cells: DataFrame, keys: list[str], radius: int, within: DataFrame) -> DataFrame:
    """The cells of ``within`` that are within the radius of a cell of the set, from distances on each tile's raster: first
    along y, then along x. One group a tile and year."""
    joined = within.select(*keys, "x", "y").join(cells.select(*keys, "x", "y").withColumn("_in", F.lit(True)), [*keys, "x", "y"], "left")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.select(*keys, "x", "y").schema)

    def near(frame: pd.DataFrame) -> pd.DataFrame:
        x, y = ((frame[c] - frame[c].min()).to_numpy() for c in ("x", "y"))
        there = np.zeros((int(x.max()) + 1, int(y.max()) + 1), bool)
        there[x, y] = frame["_in"].eq(True).to_numpy(bool)
        far = 1 << 20
        places = np.where(there, np.arange(there.shape[1]), -far)
        below = np.arange(there.shape[1]) - np.maximum.accumulate(places, axis=1)
        places = np.where(there, np.arange(there.shape[1]), far)
        above = np.minimum.accumulate(places[:, ::-1], axis=1)[:, ::-1] - np.arange(there.shape[1])
        along = np.minimum(below, above).astype(np.int64) ** 2
        best = along.copy()
        for d in range(1, min(radius, len(along) - 1) + 1):
            best[d:] = np.minimum(best[d:], along[:-d] + d * d)
            best[:-d] = np.minimum(best[:-d], along[d:] + d * d)
        return frame.loc[(best <= radius * radius)[x, y], [*keys, "x", "y"]]

    return joined.groupBy(*keys).applyInPandas(near, fields)


def dilate(cells: DataFrame, keys: list[str], radius: int, within: DataFrame | None = None) -> DataFrame:
    """The set of cells within the radius of a cell of the set, kept to the cells of ``within``, which a large radius needs."""
    if radius > SMALL and within is not None:
        return rastered(cells, keys, radius, within)
    grown = spread(cells.select(*keys, "x", "y"), disk(radius)).select(*keys, "x", "y").distinct()
    return grown if within is None else grown.join(within.select(*keys, "x", "y"), [*keys, "x", "y"], "left_semi")


def erode(cells: DataFrame, keys: list[str], radius: int, within: DataFrame) -> DataFrame:
    """The cells of the set with no cell outside the set within the radius. What lies beyond ``within`` counts as inside."""
    others = within.select(*keys, "x", "y").join(cells.select(*keys, "x", "y"), [*keys, "x", "y"], "left_anti")
    return cells.select(*keys, "x", "y").join(dilate(others, keys, radius, within), [*keys, "x", "y"], "left_anti")


def connected_to(core: DataFrame, candidate: DataFrame, keys: list[str]) -> DataFrame:
    """The candidate cells whose 4-neighbour component holds a core cell.

    Each tile and year is a group of its own; a component does not go over a tile's border, as in any tiled run.
    """
    joined = candidate.select(*keys, "x", "y").join(core.select(*keys, "x", "y").withColumn("core", F.lit(True)), [*keys, "x", "y"], "left")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.select(*keys, "x", "y").schema)

    def keep(frame: pd.DataFrame) -> pd.DataFrame:
        labels = label(frame["x"].to_numpy(), frame["y"].to_numpy())
        good = np.unique(labels[frame["core"].eq(True).to_numpy(bool)])
        return frame.loc[np.isin(labels, good), [*keys, "x", "y"]]

    return joined.groupBy(*keys).applyInPandas(keep, fields)


def label(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Numbers of the 4-neighbour components of cells: runs along y are joined across neighbouring x by union-find."""
    order = np.lexsort((y, x))
    xs, ys = x[order], y[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(xs) != 0) | (np.diff(ys) != 1)])
    run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(xs)]))
    parent = np.arange(len(starts))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    place = {(a, b): r for a, b, r in zip(xs.tolist(), ys.tolist(), run.tolist(), strict=True)}
    for (a, b), r in place.items():
        s = place.get((a + 1, b))
        if s is not None:
            i, j = find(r), find(s)
            parent[max(i, j)] = min(i, j)
    roots = np.array([find(i) for i in range(len(starts))])
    out = np.empty(len(x), np.int64)
    out[order] = roots[run] if len(run) else run
    return out


def connected_by_rounds(core: DataFrame, candidate: DataFrame, keys: list[str], most_rounds: int = 1000) -> DataFrame:
    """connected_to over a whole grid, across tiles: core cells take in their candidate neighbours round by round.

    Only the newest cells are spread in a round. Each round is cut from its lineage by a checkpoint.
    """
    cells = [*keys, "x", "y"]
    free = candidate.select(*cells).distinct()
    found = core.select(*cells).distinct().join(free, cells, "left_semi").checkpoint()
    new = found
    for _ in range(most_rounds):
        near = spread(new, [(1, 0), (-1, 0), (0, 1), (0, -1)]).select(*cells).distinct()
        new = near.join(free, cells, "left_semi").join(found, cells, "left_anti").checkpoint()
        if new.isEmpty():
            return found
        found = found.unionByName(new).checkpoint()
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def analysis_zone(core: DataFrame, index: DataFrame, keys: list[str], value: str = "twndwi", expansions: int = 64, radius: int = 2, cap: bool = False) -> DataFrame:
    """Grows the core over land next to it: in each step the cells of the zone with an index below 0 are dilated and added.

    ``index`` has a row for each cell. With ``cap``, returns instead the cells that one more step would add. A tile and year is a
    group; its zone is grown in numpy on the tile's raster and ends early when nothing is added.
    """
    joined = index.select(*keys, "x", "y", value).join(core.select(*keys, "x", "y").withColumn("core", F.lit(True)), [*keys, "x", "y"], "left")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.select(*keys, "x", "y").schema)
    offsets = disk(radius)

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        x, y = (frame[c].to_numpy() - frame[c].min() for c in ("x", "y"))
        shape = (int(x.max()) + 1 + 2 * radius, int(y.max()) + 1 + 2 * radius)
        land, zone = np.zeros(shape, bool), np.zeros(shape, bool)
        land[x + radius, y + radius] = frame[value].lt(0).eq(True).to_numpy(bool)
        zone[x + radius, y + radius] = frame["core"].eq(True).to_numpy(bool)
        there = np.zeros(shape, bool)
        there[x + radius, y + radius] = True

        def step(z: np.ndarray) -> np.ndarray:
            seeds, out = z & land, z.copy()
            for dx, dy in offsets:
                out[max(0, dx) : shape[0] + min(0, dx), max(0, dy) : shape[1] + min(0, dy)] |= seeds[max(0, -dx) : shape[0] - max(0, dx), max(0, -dy) : shape[1] - max(0, dy)]
            return out & there

        for _ in range(expansions):
            new = step(zone)
            if (new == zone).all():
                break
            zone = new
        if cap:
            zone = step(zone) & ~zone
        return frame.loc[zone[x + radius, y + radius], [*keys, "x", "y"]]

    return joined.groupBy(*keys).applyInPandas(grow, fields)


def consensus_land(stack: DataFrame, cell: list[str], indices: tuple[str, ...] = ("ndwi", "mndwi", "nirwi")) -> DataFrame:
    """(cell, land): whether the median over all years of each index is below 0."""
    agg = stack.groupBy(*cell).agg(*[F.median(i).alias(i) for i in indices])
    land = F.lit(True)
    for i in indices:
        land = land & F.coalesce(F.col(i) < 0, F.lit(False))
    return agg.select(*cell, land.alias("land"))


def with_masks(grid: DataFrame, values: list[str], keep: DataFrame | None = None, drop: DataFrame | None = None, cell: tuple[str, ...] = ("x", "y")) -> DataFrame:
    """Values only in the cells of ``keep`` and outside those of ``drop``; elsewhere null, and no row is lost. ``cell`` names
    what a cell is: with several tiles, the tile too; with yearly masks, the year."""
    for cells, inside in ((keep, True), (drop, False)):
        if cells is not None:
            grid = grid.join(cells.select(*cell).distinct().withColumn("_in", F.lit(True)), list(cell), "left")
            ok = F.coalesce("_in", F.lit(False)) == inside
            grid = grid.withColumns({v: F.when(ok, F.col(v)) for v in values}).drop("_in")
    return grid


def inland_water(ocean: DataFrame, index: DataFrame, keys: list[str], value: str = "twndwi", radius: int = 2, cell: tuple[str, ...] = ("x", "y")) -> DataFrame:
    """Water cells that are not connected to the ocean: water is an index of 0 or more, or no index where the consensus has
    ocean; the ocean's core is the consensus eroded. ``ocean`` has a row for each consensus ``cell``, ``index`` one a cell and key."""
    cells = [*keys, "x", "y"]
    wide = index.select(*cells, value).join(ocean.select(*cell).withColumn("ocean", F.lit(True)), list(cell), "left")
    water = wide.where((F.col(value) >= 0) | (F.col(value).isNull() & F.coalesce("ocean", F.lit(False)))).select(*cells)
    core = erode(wide.where("ocean").select(*cells), keys, radius, index)
    return water.join(connected_to(core, water, keys), cells, "left_anti")


def land_masks(cells: DataFrame, land: DataFrame | None = None, additions: DataFrame | None = None, scale: float = 1.0, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """cells (tile_id, x, y) with ``mapped`` (the cell of a land raster (cx, cy, land) that is nearest is land) and ``added``
    (the cell's centre is in one of the rings of ``additions``). A cell that the raster lacks is no land.

    ``scale`` is a cell's size in raster cells, (x0, y0) where cell (0, 0) has its centre.
    """
    out = cells.withColumns({"_px": F.col("x") * scale + x0, "_py": F.col("y") * scale + y0})
    if land is None:
        out = out.withColumn("mapped", F.lit(False))
    else:
        near = land.where("land").select(F.col("cx").cast("long").alias("_cx"), F.col("cy").cast("long").alias("_cy")).distinct().withColumn("_land", F.lit(True))
        out = out.withColumns({"_cx": F.round("_px").cast("long"), "_cy": F.round("_py").cast("long")}).join(near, ["_cx", "_cy"], "left")
        out = out.withColumn("mapped", F.coalesce("_land", F.lit(False))).drop("_land", "_cx", "_cy")
    if additions is None:
        return out.withColumn("added", F.lit(False)).drop("_px", "_py")
    from strandline.operators.spatial import with_region

    rings = additions.select("ring").withColumn("_added", F.lit(True))
    placed = with_region(out.withColumnsRenamed({"x": "_x", "y": "_y"}).withColumnsRenamed({"_px": "x", "_py": "y"}), rings, "_added")
    return placed.drop("x", "y").withColumnsRenamed({"_x": "x", "_y": "y"}).withColumn("added", F.coalesce("_added", F.lit(False))).drop("_added")


def core_land(masks: DataFrame, keys: list[str], radius: int = 60) -> DataFrame:
    """The cells of core land: mapped land without its margin, whose borders may be mapped too wide, and all added land."""
    inner = erode(masks.where("mapped"), keys, radius, masks)
    return inner.unionByName(masks.where("added").select(*keys, "x", "y")).distinct()


def vectorized(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, n, rings): a raster's true cells as polygons, one for each 4-neighbour component.

    A ring is the closed border of a component's cells, squares with whole numbers at their middles; holes are rings of their
    own, wound the other way. One group a tile and year.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.select(*keys).schema)

    def trace(frame: pd.DataFrame) -> pd.DataFrame:
        x, y = frame["x"].to_numpy(), frame["y"].to_numpy()
        labels = label(x, y)
        rows = []
        for part, which in enumerate(np.unique(labels)):
            own = set(zip(x[labels == which].tolist(), y[labels == which].tolist(), strict=True))
            onward: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for a, b in own:
                # a border runs with the cell on its left, between corners in half cells
                for (dx, dy), p, q in (((0, -1), (-1, -1), (1, -1)), ((1, 0), (1, -1), (1, 1)), ((0, 1), (1, 1), (-1, 1)), ((-1, 0), (-1, 1), (-1, -1))):
                    if (a + dx, b + dy) not in own:
                        onward.setdefault((2 * a + p[0], 2 * b + p[1]), []).append((2 * a + q[0], 2 * b + q[1]))
            rings = []
            for start in sorted(onward):
                while onward.get(start):
                    ring, here, came = [start], onward[start].pop(), start
                    while here != start:
                        ring.append(here)
                        # at a corner that two cells touch, turn left: components are joined by sides only
                        turn = lambda q, here=here, came=came: (here[0] - came[0]) * (q[1] - here[1]) - (here[1] - came[1]) * (q[0] - here[0])
                        step = max(onward[here], key=turn)
                        onward[here].remove(step)
                        came, here = here, step
                    rings.append([{"x": p / 2, "y": q / 2} for p, q in [*ring, start]])
            rows.append((part, len(own), rings))
        head = {k: [frame[k].iloc[0]] * len(rows) for k in keys}
        return pd.DataFrame({**head, "part": [r[0] for r in rows], "n": [r[1] for r in rows], "rings": [r[2] for r in rows]})

    return cells.select(*keys, "x", "y").distinct().groupBy(*keys).applyInPandas(trace, f"{fields}, part int, n int, rings array<array<struct<x:double,y:double>>>")
