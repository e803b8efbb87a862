"""What several corpus operators share: scratch tables, id ranges, bounded groups and connected components."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the operators' contracts have it.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The model file of SentencePiece queries.
MODEL = os.environ.get("STRANDLINE_SENTENCEPIECE", "/opt/tokenizers/piece_bpe_32k.model")
#: The key of pseudonyms; a real run takes a secret one from its environment.
KEY = os.environ.get("STRANDLINE_PII_KEY", "not a secret").encode()


#: Rows that go to a Python worker at once in the registered queries and the pipeline. Spark's 10,000 suit narrow rows; texts are
#: long, and each batch stands in memory on both sides.
BATCH_ROWS = 1000


def for_texts(spark: SparkSession) -> None:
    """Makes a session's Arrow batches small enough for texts, unless it has a number of its own. For those who own the session
    (the registered queries, the pipeline); operators leave it as it is."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    for_texts(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir). Where that is unset, a local session
    gets a temporary folder; on a cluster there is no folder that would do, and it is an error."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='strandline-')}"
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def few(spark: SparkSession) -> int:
    """Tasks for small tables that are made after a shuffle: two a core, or an eighth of the shuffle partitions if more."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


#: Options of scratch tables, to write and to read them. Hadoop's checked local file system makes two files for one, and without
#: its native library starts a child process for each; the raw one makes one, and Parquet's page checksums are verified instead.
#: Other file systems than the local one stay as they are.
SCRATCH = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    "parquet.page.write-checksum.enabled": "true",
    "parquet.page.verify-checksum.enabled": "true",
}


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage and survives lost executors. At most ``files`` files."""
    path = scratch(df.sparkSession, name)
    (df.coalesce(files) if files else df).write.options(**SCRATCH).parquet(path)
    return df.sparkSession.read.options(**SCRATCH).schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store and all in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def dropped(df: DataFrame) -> None:
    """Deletes a table that ``written`` made and that nothing will read again."""
    for file in df.inputFiles()[:1]:
        delete(df.sparkSession, file.rsplit("/", 1)[0])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Pure ASCII takes the fast path, where lower() is the same."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, where body would otherwise repeat it inside lambdas."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


#: Cut points that id_block takes from the ids themselves; a power of two, for the search.
CUTS = 4096


def id_block(df: DataFrame, rows_a_block: int, most: int, id_col: str = "doc_id") -> Column:
    """An expression that deals ids into ordered blocks of about ``rows_a_block`` rows, never more than ``most`` + CUTS blocks.

    Up to CUTS quantiles of the ids (found to within a fraction of a block by one aggregate) are the borders, so ids that are
    hashed, dense in places or far out make no large block; the search among them is a fold over the steps of a bisection.
    Where more blocks are wanted than there are cuts, the stretch between two cuts is dealt evenly by width. A null id is in
    the first block.
    """
    n, lo, hi = df.agg(F.count(id_col), F.min(id_col), F.max(id_col)).first()
    if not n or lo == hi:
        return F.lit(0).cast("long")
    blocks = min(most, max(16, n // rows_a_block))
    parts = min(CUTS, blocks)
    cuts = df.agg(F.percentile_approx(id_col, [k / parts for k in range(1, parts)], 8 * CUTS)).first()[0]
    cuts = [lo, *sorted({c for c in cuts if c > lo})]
    table = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<long>")
    own = F.coalesce(F.col(id_col), F.lit(lo))
    steps = F.array(*[F.lit(CUTS >> k) for k in range(1, CUTS.bit_length())])
    at = F.aggregate(steps, F.lit(0), lambda p, s: F.when((p + s < len(cuts)) & (F.get(table, p + s) <= own), p + s).otherwise(p))
    inner = -(-blocks // parts)
    if inner == 1:
        return at.cast("long")
    # 2**63 and more between two cuts would overflow: halves do not
    low, high = F.get(table, at), F.coalesce(F.get(table, at + 1), F.lit(hi))
    share = F.least(F.lit(inner - 1), F.floor(((own / 2 - low / 2) / F.greatest(high / 2 - low / 2, F.lit(0.5))) * inner))
    return at.cast("long") * inner + share


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which its Python worker gives free memory back: workers wait for their next task beside the executor's heap."""

    def leaving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # not glibc
                pass

    return leaving


#: A key with more than one in HOT of all rows is hot, so there are fewer than HOT hot keys, whatever the input.
HOT = 1000
#: Rows of a key that any task can take.
SOME = 500


def joined_to_one(rows: DataFrame, ones: DataFrame, keys: list[str], count: str, spread: str) -> DataFrame:
    """rows left-joined to ``ones``, which has one row a key and says in ``count`` how many rows at least have the key.

    Hot keys are joined from a broadcast of fewer than HOT rows, and their rows are dealt by ``spread`` as well as by the key
    in the shuffled join of the rest; so no task gets all rows of a key. Where no key has many rows (SOME) it is a plain
    join. ``ones`` is read more than once: give a written table.
    """
    total, most = ones.agg(F.coalesce(F.sum(count), F.lit(0)), F.coalesce(F.max(count), F.lit(0))).first()
    values = [c for c in ones.columns if c not in keys]
    if most <= max(SOME, total / HOT):
        return rows.join(ones, keys, "left").select(*rows.columns, *values)
    least = max(SOME, total / HOT)
    hot = ones.where(F.col(count) > least).select(*keys, F.struct(*values).alias("_hot"))
    known = rows.join(F.broadcast(hot), keys, "left")
    other = ones.where(F.col(count) <= least).select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*values).alias("_cold"))
    # 0 for the rest, so that its rows meet by their keys; rows that are joined already lie anywhere
    dealt = F.when(F.col("_hot").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(spread))
    same = F.col("_hot").isNull() & (F.col("_deal") == F.col("_zero"))
    for k in keys:
        same &= F.col(k) == F.col(f"_{k}")
    met = known.withColumn("_deal", dealt).join(other.withColumn("_zero", F.lit(0).cast("long")), same, "left")
    found = F.coalesce("_hot", "_cold")
    return met.select(*rows.columns, *[found[v].alias(v) for v in values])


def split_hot(rows: DataFrame, keys: list[str], item: str, most: int, near: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Rows to be compared, with ``lo`` and ``hi``, and the links (item, rep) that are found on the way.

    Rows that meet in a (keys, lo, hi) group are to be compared. A key with up to ``most`` rows is one group. Of a larger one,
    the smallest item is the representative: what is near() it is linked to it and is one class already. Only pairs with a row
    that is far from it are left. So the near rows are dealt into slices, once each, and the far ones meet every slice; if
    even the far ones are many, they are sliced too, and slices meet pair by pair. No task holds more than two slices, and a
    large group of near copies is not multiplied. ``linked`` tells rows of the representative's class.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(F.struct(item, *[c for c in rows.columns if c not in (*keys, item)])).alias("_rep")).where(F.col("_n") > most)
    if counted.isEmpty():
        none = rows.where("false").select(F.col(item).alias("item"), F.col(item).alias("rep"))
        return rows.withColumns({"lo": F.lit(0), "hi": F.lit(0), "linked": F.lit(False)}), none
    large = written(counted, "hot-keys")
    # one row a key and salt: a slice's rows meet the representative in a task of their own
    salted = large.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / most).cast("int") - 1)))
    sliced = rows.join(large.select(*keys, "_n"), keys, "left").withColumn("_s", F.ceil(F.coalesce("_n", F.lit(1)) / most).cast("int"))
    sliced = sliced.withColumn("_salt", F.pmod(F.xxhash64(item), F.col("_s")).cast("int"))
    hot = written(sliced.where("_n is not null").drop("_n").join(salted.select(*keys, "_salt", "_rep"), [*keys, "_salt"]).withColumn("linked", near(F.col("_rep"))), "hot-rows")
    far = hot.where("not linked").groupBy(*keys).agg(F.count("*").alias("_f")).withColumn("_fs", F.ceil(F.col("_f") / most).cast("int")).select(*keys, "_fs")
    own = [c for c in rows.columns if c not in keys]
    # slices of near rows are 0 to s - 1, those of far rows s to s + fs - 1; a group is a near and a far slice or two far ones
    dealt = hot.join(far, keys).withColumn("_at", F.when(F.col("linked"), F.col("_salt")).otherwise(F.col("_s") + F.pmod(F.xxhash64(F.lit("far"), item), F.col("_fs")).cast("int")))
    meets = F.when(F.col("linked"), F.sequence(F.col("_s"), F.col("_s") + F.col("_fs") - 1)).otherwise(F.sequence(F.lit(0), F.col("_s") + F.col("_fs") - 1))
    met = dealt.withColumn("_with", F.explode(meets)).select(*keys, *own, F.least("_at", "_with").alias("lo"), F.greatest("_at", "_with").alias("hi"), "linked")
    small = sliced.where("_n is null").select(*keys, *own, F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(False).alias("linked"))
    links = hot.where("linked").select(F.col(item).alias("item"), F.col(f"_rep.{item}").alias("rep"))
    return small.unionByName(met), links


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that are alike in keys, from batches that are sorted by keys; only one group is held at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(table.slice(start, i - start))
                if held:
                    yield pa.concat_tables(held)
                held, last, start = [], row, i
        held.append(table.slice(start))
    if held:
        yield pa.concat_tables(held)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) can reach.

    Alternates the large-star and small-star steps until no root has a smaller neighbour. Aggregations have partial minima, a
    node with very many edges is joined from a broadcast (joined_to_one), tables of a round are written to the shared folder
    and deleted with the next; nothing is collected but counts.
    """
    files = few(edges.sparkSession)
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", files)

    def to_least(pairs: DataFrame, own: bool) -> tuple[DataFrame, DataFrame]:
        """pairs (a, b) with the smallest b of each a (or a itself) as m, and the table that must be kept for it."""
        m = F.min("b")
        least = written(pairs.groupBy("a").agg(m.alias("_m"), F.count("*").alias("c")).select("a", (F.least("a", "_m") if own else F.col("_m")).alias("m"), "c"), "least", files)
        return joined_to_one(pairs.withColumn("_spread", F.xxhash64("b")), least, ["a"], "c", "_spread"), least

    for _ in range(most_rounds):
        near, least = to_least(now.union(now.select("b", "a")), True)
        large = written(near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "edges", files)
        near, lower = to_least(large, False)
        small = near.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        before, now = now, written(small, "edges", files)
        for old in (before, least, large, lower):
            dropped(old)
        roots = now.select(F.col("b").alias("_b")).distinct()
        if roots.join(now, F.col("_b") == F.col("a"), "left_semi").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
