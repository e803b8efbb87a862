"""Line dedup over a store of line hashes kept as levelled sorted runs. DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import BLANKS, SCRATCH, ascii_lower, delete, dropped, few, joined_to_one, scratch, written


def lines_of(text: Column) -> Column:
    """The lines of a text; null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def key_hash(key: Column) -> Column:
    """128 bits of a key, so that unequal keys do not meet even among 10**12 lines."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second half"), key).alias("h2"))


class LineRuns:
    """Sorted runs of (h1, h2, n_docs, keeper) in levels, as a log-structured merge tree holds them.

    A batch is merge-anti-joined with all runs to find which of its keys are new, and then becomes a run of level 0. When a
    level has ``fanout`` runs, they are merged into one run of the next level, so a store of n batches has about
    fanout x log(n) runs and each row is rewritten log(n) times. All runs are bucketed and sorted alike by h1, so the
    anti-joins do not shuffle what is stored already.

    A store with a ``path`` of its own lives on: ``save`` writes which runs it has, and the next LineRuns of that path begins
    with them, in this session or another. Without one it is scratch, and ``close`` takes its names out of the catalogue.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None, path: str | None = None) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or min(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: list[list[str]] = []
        self.kept = path is not None
        self.path, self.name, self.made = path or scratch(spark, "line-runs"), f"line_run_{uuid.uuid4().hex}", 0
        if path:
            self._open()

    def _open(self) -> None:
        try:
            held = self.spark.read.schema("version int, made int, buckets int, level int, run int").json(f"{self.path}/manifests").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        last = max((r.version for r in held), default=0)
        for r in sorted(r for r in held if r.version == last):
            self.made, self.buckets = r.made, r.buckets
            if r.run is not None:
                name = f"{self.name}_{r.run}"
                self.spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, n_docs BIGINT, keeper BIGINT) USING parquet CLUSTERED BY (h1) SORTED BY (h1, h2) INTO {r.buckets} BUCKETS LOCATION '{self.path}/run-{r.run}'")
                self._place(name, r.level)

    def save(self) -> None:
        """Writes which runs there are. What an earlier version had and this one has not stays on disk for its readers."""
        rows = [(self.made, self.made, self.buckets, level, int(name.rsplit("_", 1)[1])) for level, names in enumerate(self.levels) for name in names]
        schema = "version int, made int, buckets int, level int, run int"
        self.spark.createDataFrame(rows or [(self.made, self.made, self.buckets, None, None)], schema).coalesce(1).write.mode("append").json(f"{self.path}/manifests")

    def _place(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _write(self, rows: DataFrame, level: int) -> None:
        self.made += 1
        name = f"{self.name}_{self.made}"
        out = rows.repartition(self.buckets, "h1").coalesce(self.buckets).write.options(**({} if self.kept else SCRATCH))
        out.bucketBy(self.buckets, "h1").sortBy("h1", "h2").option("path", f"{self.path}/run-{self.made}").format("parquet").saveAsTable(name)
        self._place(name, level)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def fresh(self, keys: DataFrame) -> DataFrame:
        """The rows of keys (h1, h2, ...) that no run holds: one merge anti-join with each run."""
        for run in self.runs():
            keys = keys.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Takes in one batch: (h1, h2, n_docs, keeper), a key once. Keys that a run holds keep the keeper they have."""
        keys = keys.repartition(self.buckets, "h1")
        new = self.fresh(keys).select("h1", "h2", F.lit(True).alias("_new")) if any(self.levels) else None
        rows = keys if new is None else keys.join(new, ["h1", "h2"], "left").withColumn("keeper", F.when(F.col("_new"), F.col("keeper"))).drop("_new")
        self._write(rows.select("h1", "h2", "n_docs", "keeper"), 0)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                self.compact(level)

    def merged(self, names: list[str]) -> DataFrame:
        """One merge join after another. A union would not do: Spark 4.1 takes one of bucketed tables for bucketed, and drops
        the shuffle that its aggregation needs."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).withColumnsRenamed({"n_docs": "_n", "keeper": "_keeper"}).hint("merge")
            both = rows.join(more, ["h1", "h2"], "full_outer")
            rows = both.select("h1", "h2", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n_docs"), F.greatest("keeper", "_keeper").alias("keeper"))
        return rows

    def compact(self, level: int) -> None:
        names, self.levels[level] = self.levels[level], []
        self._write(self.merged(names), level + 1)
        self._drop(names)

    def all_keys(self) -> DataFrame:
        """Each key once, with the number of documents over all batches and its keeper."""
        return self.merged([name for level in self.levels for name in level])

    def close(self) -> None:
        """Takes the runs' names out of the catalogue; a scratch store's files go too."""
        self._drop([name for level in self.levels for name in level])
        self.levels = []
        if not self.kept:
            delete(self.spark, self.path)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3, carry: tuple[str, ...] = (), store: str | None = None) -> DataFrame:
    """(doc_id, *carry, text, n_lines, n_dropped): every text without the long lines that many documents share.

    A line's key is the line without blanks at its ends, A-Z in lower case. Keys of at least ``min_chars`` code points that
    ``min_docs`` documents hold lose all their lines but those of the largest doc_id with the key. The batches are ranges of
    doc_id in descending order, so the batch in which a key is new names the keeper. With a ``store`` (a path) the documents
    are the next batches after those it has seen: their keys count on from the store's, a key keeps the keeper it has there,
    and the store takes the new keys in.

    A null or empty text is one empty line, and comes out empty. Rows that share a doc_id are one document; each of its rows
    keeps the lines that it keeps. Rows without a doc_id are one document that is less than all others; if only they hold a
    key, it is one document's. An empty table gives an empty result; columns other than ``carry`` are ignored. Line hashes
    are aggregated before they are shuffled, text moves once, and no task gets all places of a frequent line: such lines, fewer
    than a thousand whatever the input, are joined from a broadcast.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", *carry, "text")
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = 1 if lo is None else (hi - lo) // batches + 1
    keys = F.array_distinct(F.transform(F.filter(F.transform(F.filter(lines_of(F.col("text")), lambda x: F.length(x) >= min_chars), line_key), lambda x: F.length(x) >= min_chars), key_hash))
    batch = F.when(F.col("doc_id").isNull(), F.lit(batches)).otherwise(F.floor((F.lit(hi) - F.col("doc_id")) / width)).cast("int")
    rows = docs.select("doc_id", batch.alias("batch"), F.explode(keys).alias("k")).select("doc_id", "batch", "k.h1", "k.h2")
    files = few(spark)
    held = written(rows.coalesce(files).sortWithinPartitions("batch"), "line-keys")  # a batch skips the row groups of others
    again = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_id"))
    if not again.isEmpty():  # a document counts once, in however many rows it holds a key
        mark = held.join(again, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
        once = written(mark.where("_id is null and doc_id is not null").drop("_id").unionByName(mark.where("_id is not null or doc_id is null").drop("_id").distinct()).coalesce(files).sortWithinPartitions("batch"), "line-keys")
        dropped(held)
        held = once
    runs = LineRuns(spark, fanout, path=store)
    try:
        for b in range(batches + 1):
            part = held.where(F.col("batch") == b)
            if b == 0 or not part.isEmpty():
                runs.add(part.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")))
        common = written(runs.all_keys().where(F.col("n_docs") >= min_docs), "common-lines")
        if store:
            runs.save()
    finally:
        runs.close()
    lost = joined_to_one(held, common, ["h1", "h2"], "n_docs", "doc_id").where("doc_id < keeper or (doc_id is null and keeper is not null)" + (" or doc_id > keeper" if store else ""))
    lost = lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))
    lines = lines_of(F.col("text"))
    stays = lambda line: (F.length(line) < min_chars) | ~F.array_contains(F.col("lost"), key_hash(line_key(line)))
    kept = docs.join(lost.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return kept.select("doc_id", *carry, F.when(F.col("lost").isNull(), lines).otherwise(F.filter(lines, stays)).alias("_kept"), F.size(lines).alias("n")).select(
        "doc_id", *carry, F.array_join("_kept", "\n").alias("text"), F.col("n").cast("long").alias("n_lines"), (F.col("n") - F.size("_kept")).cast("long").alias("n_dropped")
    )
