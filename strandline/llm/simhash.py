"""SimHash near-dedup: 64-bit fingerprints, and links found with a Gray-order hierarchical index."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import components, few, groups, joined_to_one, lean, split_hot, written

BITS = 64
#: Children of a node of the index.
FAN = 8
#: Rows of one key that one task compares; larger keys are cut in slices, pair by pair.
GROUP = 4096


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """A bit is 1 if more than half of the shingles' XXH64 have it. No words: 0. Fewer words than the width: one shingle."""
    words = text.lower().split()  # on bytes: A-Z only, and the ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        cuts = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist() if len(words) >= width else [len(line)], strict=True)
        hashes = np.fromiter((digest(line[a:b], seed) for a, b in cuts), np.uint64, to - at)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            fps = np.fromiter((fingerprint(x.as_py() or b"", width) for x in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of every code in the Gray sequence: neighbours in it differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A tree over codes in Gray order.

    A node stands for FAN neighbours of the level below. It holds the bits that all of them share (pattern and mask); these
    bits are taken out of the children's masks, so each bit of a code is compared once on the way down, and the differences
    add up. A subtree is left as soon as they exceed the limit.
    """

    def __init__(self, codes: np.ndarray) -> None:
        self.order = np.argsort(gray_rank(codes), kind="stable")
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        levels = [(codes[self.order], np.full(len(codes), full))]
        while len(levels[-1][0]) > FAN:
            pattern, mask = levels[-1]
            heads = np.arange(0, len(pattern), FAN)
            first = np.repeat(pattern[heads], np.diff(np.append(heads, len(pattern))))
            levels.append((pattern[heads], np.bitwise_and.reduceat(mask & ~(pattern ^ first), heads)))
        self.levels = []
        for k, (pattern, mask) in enumerate(levels):
            above = levels[k + 1][1][np.arange(len(mask)) // FAN] if k + 1 < len(levels) else np.uint64(0)
            self.levels.append((pattern, mask & ~above))

    def within(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query's place, code's place before sorting) of all pairs that differ in at most limit bits."""
        top = len(self.levels[-1][0])
        q = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        gone = np.zeros(len(q), np.uint8)
        for k in range(len(self.levels) - 1, -1, -1):
            pattern, rest = self.levels[k]
            gone = gone + np.bitwise_count((queries[q] ^ pattern[node]) & rest[node])
            keep = gone <= limit
            q, node, gone = q[keep], node[keep], gone[keep]
            if k:
                q, gone = np.repeat(q, FAN), np.repeat(gone, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                there = node < len(self.levels[k - 1][0])
                q, node, gone = q[there], node[there], gone[there]
        return q, self.order[node]


def forest(codes: np.ndarray, limit: int, linked: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that join what the links within the limit join: at most one less than there are codes. ``linked`` codes are one
    class already; only the others are looked up."""
    index = GrayIndex(codes)
    root = np.arange(len(codes))
    asked = np.arange(len(codes))
    if linked is not None and linked.any():
        root[linked] = np.flatnonzero(linked)[0]
        asked = np.flatnonzero(~linked)
    parent = root.tolist()

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges, at, step = [], 0, 8
    while at < len(asked):
        q, c = index.within(codes[asked[at : at + step]], limit)
        q = asked[q + at]
        apart = root[q] != root[c]
        if apart.any():
            pairs = np.unique(np.sort(np.stack([root[q[apart]], root[c[apart]]], 1), axis=1), axis=0)
            for a, b in pairs.tolist():
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((a, b))
            root = np.fromiter((find(i) for i in root.tolist()), np.int64, len(root))
        at, step = at + step, min(256, step * 2)
    return edges


def masks(limit: int, rows: int, a_key: int = 256) -> list[int]:
    """Masks of which at least one is equal in any two codes that differ in at most limit bits.

    Of m blocks, limit can be hit and m - limit stay whole, so all choices of m - limit blocks will do. m grows with the
    number of rows until a key has about a_key of them if bits are even: few and wide masks for few rows, more and narrower
    ones for many. Every choice finds the same links.
    """
    for blocks in range(limit + 1, limit + 4):
        kept = blocks - limit
        if rows / 2 ** (BITS * kept / blocks) <= a_key:
            break
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    return [sum(x) for x in itertools.combinations(parts, kept)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_components(fps: DataFrame, limit: int = 4) -> DataFrame:
    """(fp, component_id): for every fingerprint the smallest doc_id that links of at most ``limit`` bits reach.

    Equal fingerprints are one code with its smallest doc_id. Codes meet by each mask of masks(); within a key a Gray-order
    index finds the pairs, and a task emits a spanning forest of them, never the pairs. Of a key with more than GROUP codes,
    those within the limit of its smallest doc_id's code are linked to that at once; the others meet all slices of the key.
    """
    codes = written(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "codes", few(fps.sparkSession))
    keys = masks(limit, codes.count())
    mask = F.array(*[F.lit(signed(m)) for m in keys])
    rows = codes.select("fp", "rep", F.posexplode(mask).alias("m", "mask")).select("m", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "rep")
    rows, links = split_hot(rows, ["m", "key"], "rep", GROUP, lambda rep: F.bit_count(F.col("fp").bitwiseXOR(rep.fp)) <= limit)
    by = ["m", "key", "lo", "hi"]
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, by):
            if table.num_rows > 1:
                reps = table.column("rep").to_pylist()
                edges = forest(table.column("fp").to_numpy().view(np.uint64), limit, table.column("linked").to_numpy())
                if edges:
                    yield pa.RecordBatch.from_pydict({"a": [reps[a] for a, _ in edges], "b": [reps[b] for _, b in edges]}, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    edges = rows.select(*by, "fp", "rep", "linked").repartition(parts, *by).sortWithinPartitions(*by).mapInArrow(lean(link), "a long, b long")
    found = components(edges.unionAll(links.toDF("a", "b")))
    return codes.join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, limit: int = 4, width: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row.

    Null and empty texts, and those of blanks only, have fingerprint 0 and link like any other. Texts with fewer than
    ``width`` words are one shingle. Equal rows come out as often as they come in; a null doc_id gets the component of its
    fingerprint, null if no other row has it. An empty table gives an empty result; other columns are ignored.
    """
    fps = written(fingerprints(docs, width), "fingerprints")
    found = near_components(fps, limit)
    counts = fps.groupBy("fp").agg(F.count("*").alias("c"))
    found = written(found.join(counts, "fp"), "fingerprint-classes", few(docs.sparkSession))
    return joined_to_one(fps.withColumn("_spread", F.xxhash64("doc_id")), found, ["fp"], "c", "_spread").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, limit: int = 4, width: int = 4, links: DataFrame | None = None) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one of the smallest doc_id.

    ``links`` (doc_id, root) join documents that are near duplicates by another measure too; groups hold what both kinds of
    links reach. Of rows that share a doc_id one stays, the smallest by text. Rows without a doc_id cannot be told apart and stay.
    """
    found = written(near_duplicates(docs, limit, width), "near-duplicates", few(docs.sparkSession))
    if links is None:
        lost = found.where("doc_id <> component_id").select("doc_id").distinct()
    else:
        both = found.select("doc_id", "component_id").union(links.select("doc_id", "root")).toDF("a", "b")
        lost = components(both).where("node <> root").select(F.col("node").alias("doc_id")).distinct()
    kept = docs.join(lost, "doc_id", "left_anti").select(*docs.columns)
    again = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1").select("doc_id")
    if again.isEmpty():
        return kept
    one = kept.join(again, "doc_id", "left_semi").select(*docs.columns).withColumn("_row", F.expr("row_number() over (partition by doc_id order by text)")).where("_row = 1").drop("_row")
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
