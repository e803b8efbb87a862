"""Grid construction, task lists, training tables and validation statistics."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import geometry as g
from strandline.functions.stats import agreement
from strandline.functions.text import pair_id, tile_id
from strandline.operators.spatial import box_overlay, largest_overlap

# Grid ---------------------------------------------------------------------------------------------------------------------


def grid_cells(spark, columns: range, rows: range, size: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:  # noqa: ANN001
    """(column, row, id, tile_id, minx, miny, maxx, maxy) of a rectangle of square cells."""
    c = spark.range(columns.start, columns.stop).select(F.col("id").cast("int").alias("column"))
    cells = c.withColumn("row", F.explode(F.sequence(F.lit(rows.start), F.lit(rows.stop - 1))))
    x, y = F.lit(x0) + F.col("column") * size, F.lit(y0) + F.col("row") * size
    return cells.select("column", "row", tile_id(F.col("column"), F.col("row")).alias("id"), pair_id(F.col("column"), F.col("row")).alias("tile_id"), x.alias("minx"), y.alias("miny"), (x + size).alias("maxx"), (y + size).alias("maxy"))


def best_zone(cells: DataFrame, zones: DataFrame, side: float, dropped: tuple[int, ...] = (25,)) -> DataFrame:
    """Every cell with the EPSG number of the UTM zone (zone and a box) that covers most of it; null where none does."""
    pairs = box_overlay(cells.select("column", "row", "minx", "miny", "maxx", "maxy"), zones.where(~F.col("zone").isin(*dropped)), side)
    best = largest_overlap(pairs, ["row", "column"], "zone").select("column", "row", g.utm_epsg(F.col("zone")).alias("epsg"))
    return cells.join(best, ["column", "row"], "left")


def buffered(boxes: DataFrame, by: float) -> DataFrame:
    """Boxes grown (or shrunk) by a distance with square corners."""
    return boxes.withColumns({"minx": F.col("minx") - by, "miny": F.col("miny") - by, "maxx": F.col("maxx") + by, "maxy": F.col("maxy") + by}).where("minx < maxx and miny < maxy")


def cells_in(cells: DataFrame, boxes: DataFrame, side: float) -> DataFrame:
    """The cells that share an area with any box."""
    hit = box_overlay(cells.select("column", "row", "minx", "miny", "maxx", "maxy"), boxes.select("minx", "miny", "maxx", "maxy"), side)
    return cells.join(hit.select("column", "row").distinct(), ["column", "row"], "left_semi")


def cells_outside(cells: DataFrame, boxes: DataFrame, side: float) -> DataFrame:
    hit = box_overlay(cells.select("column", "row", "minx", "miny", "maxx", "maxy"), boxes.select("minx", "miny", "maxx", "maxy"), side)
    return cells.join(hit.select("column", "row").distinct(), ["column", "row"], "left_anti")


# Tasks --------------------------------------------------------------------------------------------------------------------


def task_list(ids: DataFrame, datetimes: list[str], log: DataFrame | None = None, retry_errors: bool = True) -> DataFrame:
    """(column, row, datetime) of all tiles and periods less those in the log (column, row, datetime, status): all logged ones,
    or only the complete ones if errors are tried again."""
    tasks = ids.select("column", "row").withColumn("datetime", F.explode(F.array(*[F.lit(d) for d in datetimes])))
    if log is None:
        return tasks
    done = log.where("status = 'complete'") if retry_errors else log
    return tasks.join(done.select("column", "row", "datetime"), ["column", "row", "datetime"], "left_anti")


def tiles_by_key(tiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The tiles of a list of (column, row): one for a task, or a debug list. A list that is too large to broadcast is shuffled."""
    return tiles.join(wanted.select("column", "row").distinct(), ["column", "row"], "left_semi")


def as_json_list(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row with all rows as a JSON array, in order. For lists that are printed, so bounded by what a reader takes."""
    made = rows.agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in rows.columns if c not in order]))).alias("_all"))
    fields = F.transform("_all", lambda r: F.struct(*[r[c].alias(c) for c in rows.columns]))
    return made.select(F.to_json(fields).alias("json"))


# Training -----------------------------------------------------------------------------------------------------------------

# Training classes as code, whole number, simple number, cloud class, water class and colour.
CODES = [
    ("land", 1, 1, 0, 1, "#064a00"),
    ("clean_water", 9, 2, 0, 2, "#ff0000"),
    ("water", 2, 3, 0, 2, "#ff0000"),
    ("deep_ocean", 3, 3, 0, 2, "#ff0000"),
    ("noisy_water", 8, 7, 0, 2, "#00ffff"),
    ("surf", 4, 4, 0, 4, "#ddfeff"),
    ("coast", 5, 5, 0, 5, "#ffe48b"),
    ("cloud", 6, 6, 1, 6, "#a9a9a9"),
    ("noise", 7, 6, 1, 6, "#e16be1"),
    ("bare_terrain", 10, 8, 0, 8, "#0000ff"),
    ("built", 11, 9, 0, 9, "#ff0000"),
]
# The tiles of the validation composites; one of them is listed twice.
VALIDATION_TILES = "59NLG 56MKU 01KGU 07LFL 01KHV 56MQU 60KWF 59NLG 54LYR 01KFS 55MEM 57LXK 57NVH 58KEB 58KHF 59NQB 60KXF 60LYR".split()
PREDICTORS = ["blue", "green", "red", "nir08", "swir16", "swir22", *[f"{b}_mad" for b in ("blue", "green", "red", "nir08", "swir16", "swir22")], "count", "twndwi", "twndwi_mad", "twndwi_stdev"]


def codes(spark) -> DataFrame:  # noqa: ANN001
    return spark.createDataFrame(CODES, "code string, intcode int, simplintcode int, cloud int, unified_water int, color string")


def code_for_name(name: str, response: str = "cloud") -> int:
    """The number that a class has in a response column."""
    at = ["code", "intcode", "simplintcode", "cloud", "unified_water", "color"].index(response)
    return next(row[at] for row in CODES if row[0] == name)


def names_of_codes(codes: DataFrame, response: str = "cloud") -> DataFrame:
    """One class name for each number of a response, the first by whole number."""
    return codes.groupBy(response).agg(F.min_by("code", "intcode").alias("code"))


def validation_tiles(spark, first: int = 2017, last: int = 2024) -> DataFrame:  # noqa: ANN001
    """(tile, year): every validation tile in every year, a tile that is listed twice twice."""
    tiles = spark.createDataFrame([(t,) for t in VALIDATION_TILES], "tile string")
    return tiles.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))


def training_times(points: DataFrame, every: str = "2020/2022") -> DataFrame:
    """A row for each time of a point: "all" stands for one period, lists are split at commas and trimmed."""
    times = F.when(F.trim("time") == "all", F.lit(every)).otherwise(F.col("time"))
    return points.withColumn("time", F.explode(F.split(times, ","))).withColumn("time", F.trim("time"))


def labelled(points: DataFrame, codes: DataFrame, code: str = "code", dropped: tuple[str, ...] = ("shift",)) -> DataFrame:
    """Points with their code's columns, null for unknown codes; dropped codes are left out, points without a code stay."""
    return points.where(F.col(code).isNull() | ~F.col(code).isin(*dropped)).join(codes, code, "left")


def fit_forest(rows: DataFrame, label: str, features: list[str] = PREDICTORS, trees: int = 100, seed: int = 1) -> PipelineModel:
    """A random forest on the rows without nulls in features or label."""
    stages = [VectorAssembler(inputCols=features, outputCol="_features"), RandomForestClassifier(labelCol=label, featuresCol="_features", numTrees=trees, seed=seed)]
    return Pipeline(stages=stages).fit(rows.dropna(subset=[*features, label]))


def predict_forest(model: PipelineModel, rows: DataFrame, features: list[str] = PREDICTORS) -> DataFrame:
    """Adds ``prediction``; rows with a null feature keep a null one."""
    whole = model.transform(rows.dropna(subset=features)).drop("_features", "rawPrediction", "probability")
    missing = F.lit(False)
    for f in features:
        missing = missing | F.col(f).isNull()
    return whole.unionByName(rows.where(missing), allowMissingColumns=True)


# Validation ---------------------------------------------------------------------------------------------------------------


def since(df: DataFrame, first: int, year: str = "year", last: int | None = None) -> DataFrame:
    """Rows of a span of years; a predicate that reaches the scan."""
    return df.where(F.col(year) >= first) if last is None else df.where(F.col(year).between(first, last))


def undigitised(lines: DataFrame, by: str = "digitiser_name") -> DataFrame:
    """Lines that nobody has drawn: the automatic ones."""
    return lines.where(F.col(by).isNull())


def both_significant(rows: DataFrame, a: str = "cl_sig_time", b: str = "val_sig_time") -> DataFrame:
    """Rows in which both trends have a significance."""
    return rows.where(F.col(a).isNotNull() & F.col(b).isNotNull())


def compared(cl: DataFrame, val: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of results and validation, columns prefixed cl_ and val_, with abs and squared errors of the rates."""
    both = [c for c in cl.columns if c in val.columns and c not in keys]
    named = lambda df, p: df.select(*keys, *[F.col(c).alias(p + c) for c in both])
    out = named(cl, "cl_").join(named(val, "val_"), keys, "full")
    return out.withColumns({"mae": F.abs(F.col("cl_rate") - F.col("val_rate")), "mse": F.pow(F.col("cl_rate") - F.col("val_rate"), 2)})


def summary(rows: DataFrame, value: str = "cl_rate", truth: str = "val_rate", site: str = "set_id", limit: float = 0.01, sig: str = "cl_sig_time") -> DataFrame:
    """Agreement of all rows and of those with a significance under the limit, a row each (subset), with the number of sites."""
    tagged = rows.withColumn("subset", F.explode(F.when(F.col(sig) < limit, F.array(F.lit("all"), F.lit("significant"))).otherwise(F.array(F.lit("all")))))
    return tagged.groupBy("subset").agg(*agreement(value, truth), F.count_distinct(site).alias("n_sites"))


def by_set_and_all(rows: DataFrame, error: str = "diff", site: str = "set_id", remove_bias: bool = False) -> DataFrame:
    """n, bias, mae, rmse and sd of an error by set, and a row "all" over every set. Without bias, the set's mean is taken off."""
    if remove_bias:
        rows = rows.withColumn(error, F.col(error) - F.expr(f"avg({error}) over (partition by {site})"))
    e = F.col(error)
    out = rows.rollup(site).agg(F.count(e).alias("n"), F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.stddev_samp(e).alias("sd"), F.grouping(site).alias("_all"))
    return out.withColumn(site, F.when(F.col("_all") == 1, "all").otherwise(F.col(site).cast("string"))).drop("_all")
