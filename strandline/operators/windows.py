"""Yearly medians in circular windows, exact, without a row for a pair of a centre and a point."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A tile's side in radii. A task holds the points of (TILE + 2) x (TILE + 2) radii.
TILE = 2
#: At most so many cells to a radius, and ranges of values to a year: a table of counts has (4 x FINE) ** 2 x RANGES numbers.
FINE, RANGES = 32, 256
#: So many numbers at once in the arrays of a few centres.
AT_ONCE = 1 << 20
#: Cells are taken for whole or untouched only with this much to spare (in cells); between, each point is tested.
SPARE = 1e-6


class Grid(NamedTuple):
    x0: float
    y0: float
    side: float
    w: int
    h: int


class Spans(NamedTuple):
    """Of each centre and row of cells: [a, d) may touch the circle, [b, c) are wholly in it."""

    row: np.ndarray
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    d: np.ndarray


def grid_of(x: np.ndarray, y: np.ndarray, radius: float) -> Grid:
    """Cells that are finer the more points a window holds."""
    dx, dy = x.max() - x.min(), y.max() - y.min()
    held = len(x) * min(1.0, np.pi * radius**2 / max(dx * dy, radius**2))
    side = radius / min(FINE, max(1, round(held ** (1 / 3))))
    return Grid(x.min(), y.min(), side, int(dx / side) + 1, int(dy / side) + 1)


def spans_of(cx: np.ndarray, cy: np.ndarray, g: Grid, radius: float) -> Spans:
    reach = int(radius / g.side) + 2
    row = np.floor((cy - g.y0) / g.side).astype(np.int64)[:, None] + np.arange(-reach, reach + 1)
    low, high = g.y0 + (row - SPARE) * g.side - cy[:, None], g.y0 + (row + 1 + SPARE) * g.side - cy[:, None]
    near, far = np.maximum(0, np.maximum(low, -high)), np.maximum(np.abs(low), np.abs(high))
    met = (near <= radius) & (row >= 0) & (row < g.h)
    outer, inner = np.sqrt(np.maximum(radius**2 - near**2, 0)), np.sqrt(np.maximum(radius**2 - far**2, 0))
    at = lambda half: (cx[:, None] + half - g.x0) / g.side
    cell = lambda v: np.where(met, np.clip(v, 0, g.w), 0).astype(np.int64)
    a, d = cell(np.floor(at(-outer) - SPARE)), cell(np.floor(at(outer) + SPARE) + 1)
    b, c = cell(np.ceil(at(-inner) + SPARE)), cell(np.floor(at(inner) - SPARE))
    some = met & (far < radius) & (b < c)
    return Spans(np.where(met, row, 0), a, np.where(some, b, a), np.where(some, c, a), d)


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of [low, high), range after range."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)


def middles(cx: np.ndarray, cy: np.ndarray, x: np.ndarray, y: np.ndarray, v: np.ndarray | None, radius: float, g: Grid, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """(n, middle) of each centre: how many of the values at (x, y) are strictly within the radius, and their median (of an
    even number the mean of the two middle ones). Without values only n.

    Values are cut into ranges of equal numbers. Each row of cells has running counts by range, so the cells wholly in a circle
    cost two look-ups a row; the points of cells on its edge are tested. The counts name the range with the middle value, and
    only its points are tested in order. Tests are those of the plain join, in the same arithmetic.
    """
    m, cells, limit = len(x), g.w * g.h, radius * radius
    key = np.minimum(((y - g.y0) / g.side).astype(np.int64), g.h - 1) * g.w + np.minimum(((x - g.x0) / g.side).astype(np.int64), g.w - 1)
    r = 1 if v is None else int(min(RANGES, max(1, 8 * m // cells)))
    by_value = np.arange(m) if v is None else np.argsort(v, kind="stable")
    of = np.empty(m, np.int64)
    of[by_value] = np.arange(m) * r // m
    first = -(-np.arange(r + 1) * m // r)  # where a range begins
    running = np.zeros((g.h, g.w + 1, r), np.int32)
    np.cumsum(np.bincount(key * r + of, minlength=cells * r).reshape(g.h, g.w, r), axis=1, out=running[:, 1:])
    running = running.reshape(-1, r)
    by_cell = np.argsort(key, kind="stable")
    start = np.concatenate(([0], np.cumsum(np.bincount(key, minlength=cells))))
    xs, ys, rs = x[by_cell], y[by_cell], of[by_cell]
    xv, yv, vv = (x[by_value], y[by_value], v[by_value]) if v is not None else (x, y, x)

    def kth(who: np.ndarray, which: np.ndarray, *ks: np.ndarray) -> list[np.ndarray]:
        """Of centres the k-th values within their circles (from 0) in a range; past its end anything."""
        low, high = first[which], first[which + 1]
        at, n = ranges(low, high), high - low
        dx, dy = xv[at] - np.repeat(cx[who], n), yv[at] - np.repeat(cy[who], n)
        count = np.cumsum(dx * dx + dy * dy < limit)
        before = np.concatenate(([0], count))[np.cumsum(n) - n]
        return [vv[at[np.minimum(np.searchsorted(count, before + k + 1), len(at) - 1)]] for k in ks]

    total, middle = np.zeros(len(cx), np.int64), np.full(len(cx), np.nan)
    edge = start[spans.row * g.w + spans.b] - start[spans.row * g.w + spans.a] + start[spans.row * g.w + spans.d] - start[spans.row * g.w + spans.c]
    cost = np.cumsum(edge.sum(axis=1) + spans.row.shape[1] * r + m // r)
    for who in np.split(np.arange(len(cx)), np.flatnonzero(np.diff(cost // AT_ONCE)) + 1):
        row, a, b, c, d = (s[who] for s in spans)
        counts = (running[row * (g.w + 1) + c] - running[row * (g.w + 1) + b]).sum(axis=1, dtype=np.int64)
        low, high = np.concatenate((start[row * g.w + a], start[row * g.w + c]), axis=1), np.concatenate((start[row * g.w + b], start[row * g.w + d]), axis=1)
        at, owner = ranges(low.ravel(), high.ravel()), np.repeat(np.arange(len(who)), (high - low).sum(axis=1))
        dx, dy = xs[at] - cx[who][owner], ys[at] - cy[who][owner]
        hit = dx * dx + dy * dy < limit
        counts += np.bincount(owner[hit] * r + rs[at[hit]], minlength=len(who) * r).reshape(-1, r)
        upto = np.cumsum(counts, axis=1)
        total[who] = upto[:, -1]
        live = np.flatnonzero(upto[:, -1])
        if v is None or not len(live):
            continue
        upto, who = upto[live], who[live]
        k, l = (upto[:, -1] - 1) // 2, upto[:, -1] // 2
        kr, lr = (upto <= k[:, None]).sum(axis=1), (upto <= l[:, None]).sum(axis=1)
        before = np.concatenate((np.zeros((len(who), 1), np.int64), upto), axis=1)
        one, two = kth(who, kr, k - before[np.arange(len(who)), kr], l - before[np.arange(len(who)), kr])
        apart = np.flatnonzero(kr != lr)
        if len(apart):
            two[apart] = kth(who[apart], lr[apart], l[apart] - before[apart, lr[apart]])[0]
        middle[who] = (one + two) / 2
    return total, middle


def tile_windows(centres: pa.Table, points: pa.Table, radius: float, schema: pa.Schema) -> pa.Table:
    """(cid, n, years) of a tile's centres that have a point in their window."""
    cx, cy, x, y = (t.column(c).to_numpy() for t in (centres, points) for c in ("x", "y"))
    g = grid_of(x, y, radius)
    spans = spans_of(cx, cy, g, radius)
    n, _ = middles(cx, cy, x, y, None, radius, g, spans)
    lists = points.column("_d").combine_chunks()
    held = np.repeat(np.arange(len(x)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    years = points.column("_y").combine_chunks().flatten().dictionary_encode(null_encoding="encode")
    codes, v = years.indices.to_numpy(), lists.flatten().to_numpy()
    whose, which, value = [], [], []
    for code in range(len(years.dictionary)):
        at = np.flatnonzero(codes == code)
        found, middle = middles(cx, cy, x[held[at]], y[held[at]], v[at], radius, g, spans)
        some = np.flatnonzero(found)
        whose, which, value = [*whose, some], [*which, np.full(len(some), code)], [*value, middle[some]]
    whose, which, value = (np.concatenate([np.empty(0, np.int64), *p]) for p in (whose, which, value))
    order = np.argsort(whose, kind="stable")
    kept = np.flatnonzero(n)
    ends = np.concatenate(([0], np.cumsum(np.bincount(whose.astype(np.int64), minlength=len(cx))[kept])))
    made = pa.StructArray.from_arrays([years.dictionary.take(pa.array(which[order].astype(np.int64))), pa.array(value[order], pa.float64())], names=["year", "dist"])
    arrays = [centres.column("cid").combine_chunks().take(pa.array(kept)), pa.array(n[kept]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)]
    return pa.Table.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def placed(df: DataFrame) -> DataFrame:
    """Rows whose place (x, y) is finite."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return df.where(finite("x") & finite("y"))


def in_windows(centres: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """(cid, n, _years) of the centres (cid, x, y; each cid once) with a point strictly within the radius: how many points, and
    an array of (year, dist), the median of each year. Points are (x, y, _years), an array of (year, dist) or null; a place
    that is not finite is in no window.

    Centres go to the square tile they are in, points to every tile that they can be near to, four in the plane: what is
    shuffled grows with the points, not with the pairs.
    """
    side, reach = float(TILE * radius), radius * 1.001
    year = points.schema["_years"].dataType.elementType["year"].dataType
    c = placed(centres).select("cid", F.col("x").cast("double"), F.col("y").cast("double"), F.floor(F.col("x") / side).alias("_i"), F.floor(F.col("y") / side).alias("_j"))
    span = lambda at: F.sequence(F.floor((F.col(at) - reach) / side), F.floor((F.col(at) + reach) / side))
    part = lambda name, kind: F.transform("_years", lambda e: e[name].cast(kind)).alias("_" + name[0])
    p = placed(points).select(F.col("x").cast("double"), F.col("y").cast("double"), part("year", year), part("dist", "double"))
    p = p.withColumn("_i", F.explode(span("x"))).withColumn("_j", F.explode(span("y")))
    out = T.StructType([T.StructField("cid", centres.schema["cid"].dataType), T.StructField("n", T.LongType()), T.StructField("_years", T.ArrayType(T.StructType([T.StructField("year", year), T.StructField("dist", T.DoubleType())])))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        return tile_windows(left, right, radius, schema) if left.num_rows and right.num_rows else schema.empty_table()

    return c.groupBy("_i", "_j").cogroup(p.groupBy("_i", "_j")).applyInArrow(run, out)
