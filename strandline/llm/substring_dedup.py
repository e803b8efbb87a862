"""Substring dedup: passages that repeat across documents, by MinHash bands of paragraphs, exact Jaccard and components.

A paragraph is any PARAGRAPH words that stand together, or a line of at least so many. Two signatures are tuned for recall:

* Every stretch of PARAGRAPH words has the smallest hash of the shingles that begin its CORE-word stretches; the band key is
  that CORE. Neighbouring stretches mostly share their minimum, so it is stored once. Equal paragraphs share their key for
  certain, wherever lines end; so do most edited ones.
* Every line of at least PARAGRAPH words has BANDS bands of ROWS MinHash values of its five-word shingles.

Colliding paragraphs are compared word by word: around a common core the whole common passage is found, edits inside it stay
in it while the exact Jaccard similarity is SIMILAR or more; lines are compared as sets of shingles. Removals are linked into
components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import components, dropped, few, groups, joined_to_one, lean, split_hot, written

#: Words of a shingle, and the Jaccard similarity of two paragraphs' shingles from which they are the same.
SHINGLE, SIMILAR = 5, 0.8
#: Words of a paragraph: the least that is removed.
PARAGRAPH = 50
#: Words that a minimum stands for, and the places in a paragraph where such a stretch can begin.
CORE = 20
PLACES = PARAGRAPH - CORE + 1
#: BANDS bands of ROWS MinHash values: lines of similarity 0.8 meet in one with probability 1 - (1 - 0.8**2)**7 = 0.999.
BANDS, ROWS = 7, 2
#: What two texts share goes on for fewer than PLACES + CORE words beyond the common cores at its ends; else it had another one.
REACH = PLACES + CORE
#: Words of a block in which a kept text goes to the texts that are compared with it.
BLOCK = 64
#: Paragraphs of one band that a task compares at once; see split_hot.
GROUP = 250
#: A place is the word's number, under 32 bits that tell texts apart whose rows share a doc_id.
VARIANT = 0x3FFFFFFF

ODD = np.uint64(0x9E3779B97F4A7C15)
_draw = np.random.default_rng(17)
FACTORS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
OFFSETS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all."""
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def combined(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of every run of width hashes."""
    n = len(hashes) - width + 1
    out = np.full(max(0, n), seed, np.uint64)
    for k in range(width):
        out = out * ODD + hashes[k : k + n] if n > 0 else out
    return mixed(out)


def words_of(text: bytes) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words of a text, A-Z in lower case, and the stretch [first, end) of words of each line."""
    words: list[bytes] = []
    lines = []
    for line in text.lower().split(b"\n"):
        own = line.split()
        lines.append((len(words), len(words) + len(own)))
        words += own
    return words, lines


def hashed(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def text_key(words: list[bytes]) -> bytes:
    """128 bits of a text's words."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """op over every run of width values, by runs of doubling length."""
    have = 1
    out = x
    while have < width:
        step = min(have, width - have)
        out = op(out[:-step], out[step:])
        have += step
    return out


def minima(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of the smallest shingle of every PARAGRAPH words: where their cores begin, each once.

    hashes are the words of several texts one after another, ends where each text ends.
    """
    if len(hashes) < PARAGRAPH:
        return np.empty(0, np.int64)
    end = np.repeat(ends, np.diff(np.r_[0, ends]))
    shingles = combined(hashes, SHINGLE, 3)
    least = sliding(np.minimum, shingles, PLACES)
    # a paragraph that goes over its text's end counts for no place
    least[np.arange(len(least)) + PARAGRAPH > end[: len(least)]] = 0
    # a place is the smallest of a paragraph if the largest of the minima of all that hold it is its own value
    beside = np.zeros(PLACES - 1, np.uint64)
    around = sliding(np.maximum, np.r_[beside, least, beside], PLACES)
    places = np.flatnonzero(around == shingles)
    # where words repeat with a period, a chain of equal shingles, its first place stays and one in each PLACES after it
    chained = np.r_[False, (shingles[places[1:]] == shingles[places[:-1]]) & (np.diff(places) <= CORE) & (end[places[1:]] == end[places[:-1]])][: len(places)]
    step = (places - np.maximum.accumulate(np.where(chained, 0, places))) // PLACES
    return places[~chained | np.r_[True, step[1:] > step[:-1]][: len(places)]]


def bands(shingles: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The band keys of many paragraphs, each from its stretch of shingles."""
    cuts = np.stack([starts, ends], 1).ravel()
    padded = np.r_[shingles, np.uint64(0)]
    out = np.zeros((len(starts), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(starts), b + 1, np.uint64)
        for r in range(b * ROWS, (b + 1) * ROWS):
            key = mixed(key * ODD + np.minimum.reduceat(padded * FACTORS[r] + OFFSETS[r], cuts)[::2])
        out[:, b] = key
    return out


def listed(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values)


LINES = "struct<first:int,n:int,k1:long,k2:long,bands:array<long>>"
UNITS = f"doc_id long, n long, t1 long, t2 long, places array<int>, cores array<long>, lines array<{LINES}>"


def units(docs: DataFrame) -> DataFrame:
    """A row per document: its words, a hash of them, the places and keys of its cores, and its long lines with their bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield unit_rows(batch.slice(at, 500))

    return docs.select("doc_id", "text").mapInArrow(lean(run), UNITS)


def unit_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    words: list[bytes] = []
    begins, texts, line_of, line_first, line_end, digests = [], [], [], [], [], []
    for i, x in enumerate(batch.column(1).cast(pa.large_binary())):
        own, lines = words_of(x.as_py() or b"")
        begins.append(len(words))
        texts.append(text_key(own))
        for first, end in lines:
            if end - first >= PARAGRAPH:
                line_of.append(i)
                line_first.append(first)
                line_end.append(end)
                digests.append(text_key(own[first:end]))
        words += own
    n = batch.num_rows
    begin = np.array(begins, np.int64)
    ends = np.r_[begin[1:], len(words)].astype(np.int64)
    h = hashed(words)
    places = minima(h, ends)
    of = np.searchsorted(ends, places, side="right")
    cores = core_keys(h[places[:, None] + np.arange(CORE)]) if len(places) else np.empty(0, np.uint64)
    per_text = np.bincount(of, minlength=n)
    key = np.frombuffer(b"".join(texts), np.int64).reshape(-1, 2)
    line_at = begin[line_of] if line_of else np.empty(0, np.int64)
    first, end = np.array(line_first, np.int64), np.array(line_end, np.int64)
    ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    keys = bands(combined(h, SHINGLE, 1), line_at + first, line_at + end - SHINGLE + 1).ravel() if digests else np.empty(0, np.uint64)
    line_bands = listed(np.full(len(digests), BANDS), pa.array(keys.view(np.int64)))
    lines = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(end - first, pa.int32()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), line_bands], ["first", "n", "k1", "k2", "bands"])
    columns = [
        batch.column(0), pa.array(ends - begin), pa.array(key[:, 0]), pa.array(key[:, 1]), listed(per_text, pa.array(places - begin[of], pa.int32())),
        listed(per_text, pa.array(cores.view(np.int64))), listed(np.bincount(np.array(line_of, np.int64), minlength=n), lines),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "t1", "t2", "places", "cores", "lines"])


def core_keys(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of hashes, in order."""
    out = np.full(len(rows), rows.shape[1], np.uint64)
    for k in range(rows.shape[1]):
        out = mixed(out * ODD + rows[:, k])
    return out


# Lines: bands, exact Jaccard, components


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def similar_pairs(sets: list[np.ndarray], least: float, linked: list[bool] | None = None) -> list[tuple[int, int]]:
    """Edges that join what pairs with a Jaccard similarity of at least ``least`` join; sets are sorted arrays.

    One set at a time is compared with all sets that it is not joined to yet, in one step. ``linked`` sets are one class already.
    """
    sizes = np.array([len(s) for s in sets])
    root = np.arange(len(sets))
    if linked is not None and any(linked):
        root[np.array(linked)] = np.flatnonzero(linked)[0]
    everything = np.concatenate(sets) if sets else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    edges = []
    for i in range(len(sets)):
        apart = root != root[i]
        apart &= np.minimum(sizes, sizes[i]) >= least * np.maximum(sizes, sizes[i])
        if not apart.any():
            continue
        look = apart[owner]
        both = np.bincount(owner[look][np.isin(everything[look], sets[i], assume_unique=False)], minlength=len(sets))
        for j in np.flatnonzero(apart & (both >= least * (sizes + sizes[i] - both))).tolist():
            if root[i] != root[j]:
                edges.append((max(i, j), min(i, j)))
                root[root == root[j]] = root[i]
    return edges


def met_lines(lines: DataFrame) -> DataFrame:
    """(key, rep, n): the distinct lines that share a band key with others, once for all keys that have the same lines.

    lines are (doc_id, start, n, k1, k2, bands); rep is the struct (doc_id, start) of a line's first occurrence.
    """
    here = F.struct("doc_id", "start")
    distinct = lines.groupBy("k1", "k2").agg(F.min(here).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    keyed = distinct.select("rep", "n", F.explode("bands").alias("key"))
    member = F.xxhash64("rep").cast("decimal(38,0)")
    shared = written(keyed.groupBy("key").agg(F.count("*").alias("c"), F.sum(member).alias("s"), F.min("rep").alias("m")).where("c > 1").groupBy("c", "s", "m").agg(F.min("key").alias("key")).select("key", "c"), "band-keys", few(lines.sparkSession))
    keyed = keyed.withColumn("_spread", F.xxhash64("rep"))
    return joined_to_one(keyed, shared, ["key"], "c", "_spread").where("c is not null").select("key", "rep", "n")


def line_links(met: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between similar lines, structs (doc_id, start); sets are (doc_id, start, shingles)."""
    spark = met.sparkSession
    node = "struct<doc_id:long,start:long>"
    rows = met.join(sets.select(F.struct("doc_id", "start").alias("rep"), "shingles"), "rep").select("key", "rep", "shingles")

    def near(rep: Column) -> Column:
        both = F.size(F.array_intersect(F.col("shingles"), rep.shingles))
        return both >= SIMILAR * (F.size("shingles") + F.size(rep.shingles) - both)

    rows, links = split_hot(written(rows, "line-sets"), ["key"], "rep", GROUP, near)
    by = ["key", "lo", "hi"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, by):
            if table.num_rows > 1:
                reps = table.column("rep").to_pylist()
                held = [np.array(x, np.int64) for x in table.column("shingles").to_pylist()]
                edges = similar_pairs(held, SIMILAR, table.column("linked").to_pylist())
                if edges:
                    kind = pa.struct([("doc_id", pa.int64()), ("start", pa.int64())])
                    yield pa.RecordBatch.from_arrays([pa.array([reps[e[k]] for e in edges], kind) for k in (0, 1)], ["a", "b"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.repartition(parts, *by).sortWithinPartitions(*by).mapInArrow(lean(link), f"a {node}, b {node}")
    return found.unionAll(links.select(F.col("item").alias("a"), F.col("rep").alias("b")))


def shingle_set(h: np.ndarray) -> np.ndarray:
    return np.unique(combined(h, SHINGLE, 1)).view(np.int64)


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, root): documents whose five-word shingles have a Jaccard similarity of SIMILAR or more with another's, directly
    or over others, and the smallest doc_id of them.

    Pairs meet as lines do in ``repeats``: by MinHash bands, then exactly. Texts with equal words count once, as the one of the
    smallest doc_id; the others, texts with fewer words than a shingle and rows without a doc_id are not returned. Of rows
    with one doc_id and different texts each counts.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                held, words, digests = [], [], []
                ends = [0]
                for i, x in enumerate(part.column(1).cast(pa.large_binary())):
                    own = (x.as_py() or b"").lower().split()
                    if len(own) >= SHINGLE:
                        held.append(i)
                        words += own
                        ends.append(len(words))
                        digests.append(text_key(own))
                if held:
                    cuts = np.array(ends, np.int64)
                    keys = bands(combined(hashed(words), SHINGLE, 1), cuts[:-1], cuts[1:] - SHINGLE + 1)
                    ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    lists = listed(np.full(len(held), BANDS), pa.array(keys.ravel().view(np.int64)))
                    columns = [part.column(0).take(pa.array(held)), pa.array(ids[:, 0] & VARIANT), pa.array(np.diff(cuts), pa.int32()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), lists]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n", "k1", "k2", "bands"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                ids, starts, found = [], [], []
                for doc_id, text, want in zip(*(c.to_pylist() for c in batch.slice(at, 100).columns), strict=True):
                    own = (text or "").encode("utf-8", "replace").lower().split()
                    start = int.from_bytes(text_key(own)[:8], "little") & VARIANT
                    if start in want:
                        ids.append(doc_id)
                        starts.append(start)
                        found.append(shingle_set(hashed(own)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "start", "shingles"])

    docs = docs.select("doc_id", "text").where("doc_id is not null")
    met = written(met_lines(written(docs.mapInArrow(lean(keyed), "doc_id long, start long, n int, k1 long, k2 long, bands array<long>"), "text-bands")), "met", few(docs.sparkSession))
    wanted = met.select("rep.doc_id", "rep.start").groupBy("doc_id").agg(F.collect_set("start").alias("want"))
    found = docs.join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "want").mapInArrow(lean(sets), "doc_id long, start long, shingles array<long>").groupBy("doc_id", "start").agg(F.first("shingles").alias("shingles"))
    links = line_links(met, found).select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b"))
    return components(links).select(F.col("node").alias("doc_id"), "root")


# Passages: cores, the words around them, the stretches that are the same


def shared_runs(cores: DataFrame, copies: DataFrame) -> DataFrame:
    """(run, doc_id, keeper, shift, lo, hi): stretches to compare with the words ``shift`` places on in the keeper.

    cores are (key, doc_id, place). Cores that several documents have are held against their first occurrence; those side by
    side are one run. ``copies`` (doc_id, place's variant) have no runs of their own.
    """
    first = cores.groupBy("key").agg(F.min(F.struct("doc_id", "place")).alias("root"), F.max("doc_id").alias("last"), F.count("*").alias("c")).where("last <> root.doc_id").select("key", "root", "c")
    first = written(first, "core-roots", few(cores.sparkSession))
    hits = joined_to_one(cores, first, ["key"], "c", "doc_id").where("root.doc_id <> doc_id")
    hits = hits.select("doc_id", "place", F.col("root.doc_id").alias("keeper"), (F.col("root.place") - F.col("place")).alias("shift"))
    hits = hits.join(copies, (hits.doc_id == copies._id) & (F.shiftright(hits.place, 32) == copies._v), "left_anti")
    by = "(partition by doc_id, keeper, shift order by place)"
    # a gap of more than two reaches ends a run: what is equal in it has cores of its own, or is under a paragraph
    new = hits.withColumn("_new", F.expr(f"coalesce(place - lag(place) over {by} > {2 * REACH}, true)").cast("int"))
    runs = new.withColumn("_run", F.expr(f"sum(_new) over {by}")).groupBy("doc_id", "keeper", "shift", "_run").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    base = F.shiftleft(F.shiftright("a", 32), 32)
    made = written(runs.select(F.monotonically_increasing_id().alias("run"), "doc_id", "keeper", "shift", F.greatest(F.col("a") - REACH, base).alias("lo"), (F.col("b") + CORE + REACH).alias("hi")), "runs", few(cores.sparkSession))
    dropped(first)
    return made


PIECES = "kind int, doc_id long, at long, n long, words binary"


def pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Word hashes of parts of the documents, each text read once: kind 0 runs (at: the run, n: the place where the words
    begin), kind 1 blocks (at: the block's number over all variants), kind 2 lines (at: the place).

    wanted is (doc_id, runs, blocks, lines) with lists of (run, lo, hi), of block numbers and of (place, n).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 50):
                rows = []
                for r in batch.slice(i, 50).to_pylist():
                    words, _ = words_of((r["text"] or "").encode("utf-8", "replace"))
                    v = int.from_bytes(text_key(words)[:8], "little") & VARIANT
                    base, h = v << 32, hashed(words)
                    for x in r["runs"] or ():
                        if x["lo"] >> 32 == v:
                            lo = x["lo"] - base
                            rows.append((0, r["doc_id"], x["run"], x["lo"], h[lo : max(lo, x["hi"] - base)].tobytes()))
                    for b in r["blocks"] or ():
                        if b * BLOCK >> 32 == v and (own := h[b * BLOCK - base : (b + 1) * BLOCK - base]).size:
                            rows.append((1, r["doc_id"], b, len(own), own.tobytes()))
                    for x in r["lines"] or ():
                        if x["place"] >> 32 == v:
                            lo = x["place"] - base
                            rows.append((2, r["doc_id"], x["place"], x["n"], h[lo : lo + x["n"]].tobytes()))
                names = ["kind", "doc_id", "at", "n", "words"]
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    # hashed on the wanted side: texts need not be sorted
    return docs.join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "runs", "blocks", "lines").mapInArrow(lean(run), PIECES)


def same_stretches(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The stretches [first, end) of at least PARAGRAPH words in which two runs of words are the same.

    Equal stretches are joined over words that differ while the shingles of both sides have a Jaccard similarity of SIMILAR or
    more; what is not long enough so, or not similar as sets, counts by its equal stretches.
    """
    edge = np.flatnonzero(np.diff(np.r_[False, a == b, False].astype(np.int8)))
    plain = [(s, e) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if e - s >= SHINGLE]
    out: list[tuple[int, int]] = []
    at = 0
    while at < len(plain):
        # shingles at equal places give the joined stretch's likeness while it grows
        common, last = plain[at][1] - plain[at][0] - SHINGLE + 1, at
        best = at
        while last + 1 < len(plain):
            last += 1
            common += plain[last][1] - plain[last][0] - SHINGLE + 1
            total = plain[last][1] - plain[at][0] - SHINGLE + 1
            if common >= SIMILAR * (2 * total - common):
                best = last
            elif plain[last][0] - plain[last - 1][1] > PARAGRAPH:
                break
        s, e = plain[at][0], plain[best][1]
        if best > at and not (e - s >= PARAGRAPH and jaccard(shingle_set(a[s:e]), shingle_set(b[s:e])) >= SIMILAR):
            out += [x for x in plain[at : best + 1] if x[1] - x[0] >= PARAGRAPH]
        elif e - s >= PARAGRAPH:
            out.append((s, e))
        at = best + 1
    return out


SPANS = "doc_id long, start long, n int, root struct<doc_id:long,start:long>"


def passages(runs: DataFrame, parts: DataFrame) -> DataFrame:
    """SPANS: the stretches of each run that are the same as the keeper's, from the words in ``parts`` (see pieces)."""
    mine = parts.where("kind = 0").select(F.col("at").alias("run"), F.col("n").alias("begin"), F.col("words").alias("own"))
    asked = runs.select("run", F.col("keeper").alias("doc_id"), F.explode(block_numbers(F.col("lo") + F.col("shift"), F.col("hi") + F.col("shift"))).alias("at"))
    counts = asked.groupBy("doc_id", "at").agg(F.count("*").alias("c"))
    blocks = written(parts.where("kind = 1").select("doc_id", "at", "words").join(counts, ["doc_id", "at"]), "blocks")
    theirs = joined_to_one(asked, blocks, ["at", "doc_id"], "c", "run").where("words is not null")
    theirs = theirs.groupBy("run").agg(F.collect_list(F.struct("at", "words")).alias("blocks"))
    rows = runs.join(mine, "run").join(theirs, "run").select("doc_id", "keeper", "shift", "begin", "own", "blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = pa.struct([("doc_id", pa.int64()), ("start", pa.int64())])
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                out = []
                for r in batch.slice(i, 100).to_pylist():
                    own = np.frombuffer(r["own"], np.uint64)
                    held = {b["at"]: b["words"] for b in r["blocks"]}
                    low = min(held)
                    other = np.frombuffer(b"".join(held[k] for k in range(low, max(held) + 1)), np.uint64)
                    # the same places on both sides
                    skip = low * BLOCK - (r["begin"] + r["shift"])
                    a, b = own[max(0, skip) :], other[max(0, -skip) :]
                    n = min(len(a), len(b))
                    for s, e in same_stretches(a[:n], b[:n]):
                        place = r["begin"] + max(0, skip) + s
                        out.append((r["doc_id"], place, e - s, {"doc_id": r["keeper"], "start": (place + r["shift"]) & 0xFFFFFFFF}))
                types = [pa.int64(), pa.int64(), pa.int32(), root]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], ["doc_id", "start", "n", "root"])

    return rows.mapInArrow(lean(compare), SPANS)


def block_numbers(lo: Column, hi: Column) -> Column:
    """The blocks of [lo, hi): numbers go on through the variants, a block is never in two."""
    bits = BLOCK.bit_length() - 1
    return F.sequence(F.shiftright(lo, bits), F.shiftright(hi - 1, bits))


def repeats(docs: DataFrame) -> DataFrame:
    """One row per row of docs: (doc_id, class_id, n_words, n_removed, keepers, spans, variant).

    Words are stretches between ASCII blanks, A-Z in lower case. Removed is what an earlier document (smaller doc_id) has: a
    passage of PARAGRAPH or more equal words, with edits inside it as long as the Jaccard similarity of five-word shingles is
    SIMILAR or more; a line of PARAGRAPH or more words with such a similarity, directly or over other lines; a whole text of
    so many words with the same words. A passage is held against the first document that has its cores; it stays where that
    one has less than PARAGRAPH words of it. spans are the stretches to remove, each with the place that is kept: first and
    end word, keeper's doc_id and first word. n_removed counts the words that spans cover, keepers are the documents that keep
    them. class_id is the smallest doc_id that is linked to the document by removals, directly or over others.

    A passage that repeats only within its own document stays. Null, empty and short texts have no paragraphs. Rows that
    share a doc_id are one document: none removes what another has; ``variant`` tells their texts apart. A null doc_id stays as
    a row, and has no spans and no class. Other columns are ignored. An empty table gives an empty result. Copies are counted,
    not paired.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    held = written(units(docs), "units")
    variant = F.col("t1").bitwiseAND(F.lit(VARIANT))
    named = held.where(f"doc_id is not null and n >= {PARAGRAPH}")
    # whole texts
    texts = written(named.groupBy("t1", "t2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")).where("c > 1"), "copies", few(spark))
    base = joined_to_one(held.select("doc_id", "n", "t1", "t2").withColumn("_spread", F.xxhash64("doc_id", "n")), texts, ["t1", "t2"], "c", "_spread")
    base = written(base.select("doc_id", "n", variant.alias("variant"), F.when(F.col("rep") < F.col("doc_id"), F.col("rep")).alias("rep")), "documents-seen", few(spark))
    copies = base.where("rep is not null").select(F.col("doc_id").alias("_id"), F.col("variant").alias("_v")).distinct()
    # cores and lines of all texts but the copies of others
    cores = named.select("doc_id", variant.alias("_v"), F.explode(F.arrays_zip("places", "cores")).alias("x")).select(F.col("x.cores").alias("key"), "doc_id", (F.shiftleft("_v", 32) + F.col("x.places")).alias("place"))
    runs = shared_runs(cores, copies)
    lines = named.select("doc_id", variant.alias("_v"), F.explode("lines").alias("x")).select("doc_id", (F.shiftleft("_v", 32) + F.col("x.first")).alias("start"), "x.n", "x.k1", "x.k2", "x.bands")
    met = written(met_lines(lines), "met", few(spark))
    # the words of all that is compared, in one reading of the texts
    no_runs, no_blocks, no_lines = (F.lit(None).cast(t).alias(n) for n, t in (("run", "struct<run:long,lo:long,hi:long>"), ("block", "long"), ("line", "struct<place:long,n:int>")))
    mine = runs.select("doc_id", F.struct("run", "lo", "hi").alias("run"), no_blocks, no_lines)
    theirs = runs.select(F.col("keeper").alias("doc_id"), no_runs, F.explode(block_numbers(F.col("lo") + F.col("shift"), F.col("hi") + F.col("shift"))).alias("block"), no_lines)
    own = met.select("rep.doc_id", no_runs, no_blocks, F.struct(F.col("rep.start").alias("place"), "n").alias("line"))
    wanted = mine.unionAll(theirs).unionAll(own).groupBy("doc_id").agg(F.collect_set("run").alias("runs"), F.collect_set("block").alias("blocks"), F.collect_set("line").alias("lines"))
    again = base.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1")
    once = docs if again.isEmpty() else docs.dropDuplicates(["doc_id", "text"])
    parts = written(pieces(once, wanted), "pieces")
    hits = passages(runs, parts)
    links = line_links(met, parts.where("kind = 2").select("doc_id", F.col("at").alias("start"), shingles_of(F.col("words")).alias("shingles")).dropDuplicates(["doc_id", "start"]))
    roots = components(links).select(F.col("node").alias("rep"), "root")
    reps = lines.groupBy("k1", "k2").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "start")).alias("rep"))
    reps = written(reps.join(roots, "rep", "left").where("c > 1 or root is not null").select("k1", "k2", "c", F.coalesce("root", "rep").alias("root")), "line-classes", few(spark))
    more = joined_to_one(lines.drop("bands"), reps, ["k1", "k2"], "c", "doc_id").where("doc_id <> root.doc_id")
    more = more.select("doc_id", "start", "n", F.struct("root.doc_id", F.col("root.start").bitwiseAND(F.lit(0xFFFFFFFF)).alias("start")).alias("root"))
    spans = written(hits.unionByName(more), "spans")
    classes = components(spans.select(F.col("doc_id").alias("a"), F.col("root.doc_id").alias("b"))).select(F.col("node").alias("_node"), F.col("root").alias("_class"))
    classes = written(classes, "components", few(spark))
    for used in (held, texts, runs, met, parts, reps):
        dropped(used)
    one = F.struct(F.col("start").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("first"), (F.col("start").bitwiseAND(F.lit(0xFFFFFFFF)) + F.col("n")).cast("int").alias("end"), F.col("root.doc_id").alias("keeper"), F.col("root.start").cast("int").alias("keeper_first"))
    per_doc = spans.groupBy(F.col("doc_id").alias("_id"), F.shiftright("start", 32).alias("_v")).agg(F.array_sort(F.collect_set(one)).alias("spans"))
    joined = base.join(per_doc, (F.col("doc_id") == F.col("_id")) & (F.col("variant") == F.col("_v")), "left")
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n").cast("int").alias("end"), F.col("rep").alias("keeper"), F.lit(0).alias("keeper_first")))
    kind = "array<struct<first:int,end:int,keeper:bigint,keeper_first:int>>"
    joined = joined.withColumn("spans", F.when(F.col("rep").isNotNull(), whole.cast(kind)).otherwise(F.coalesce(F.col("spans").cast(kind), F.array().cast(kind))))
    node = F.coalesce("rep", "doc_id").alias("_node")
    classes = written(classes.join(base.groupBy(node).agg(F.count("*").alias("c")), "_node"), "classes", few(spark))
    joined = joined_to_one(joined.select("*", node).withColumn("_spread", F.xxhash64("doc_id")), classes, ["_node"], "c", "_spread")
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda s, x: F.struct((s.n + F.greatest(F.lit(0), x.end - F.greatest(x["first"], s.to))).alias("n"), F.greatest(s.to, x.end).alias("to")),
    )
    keepers = F.array_sort(F.array_distinct(F.transform("spans", lambda x: x.keeper)))
    return joined.select("doc_id", F.coalesce("_class", "rep", "doc_id").alias("class_id"), F.col("n").alias("n_words"), covered.n.cast("long").alias("n_removed"), keepers.alias("keepers"), "spans", "variant")


def shingles_of(words: Column) -> Column:
    """The sorted distinct shingle hashes of word hashes."""

    @F.pandas_udf("array<long>")
    def made(w):  # noqa: ANN001, ANN202
        return w.map(lambda x: shingle_set(np.frombuffer(x, np.uint64)))

    return made(words)


def removed(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text): the texts without the words of their spans, as ``repeats`` gives them; the blanks before a word go with it."""
    import re

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text = r["text"]
                if text and r["all"]:
                    words, _ = words_of(text.encode("utf-8", "replace"))
                    v = int.from_bytes(text_key(words)[:8], "little") & VARIANT
                    gone = np.zeros(len(words) + 1, bool)
                    for own in r["all"]:
                        for s in own["spans"] if own["variant"] == v else ():
                            gone[s["first"] : s["end"]] = True
                    kept, at = [], 0
                    for i, m in enumerate(word.finditer(text)):
                        if not gone[i]:
                            kept.append(text[at : m.end()])
                        at = m.end()
                    text = "".join([*kept, text[at:]])
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    spans = found.where("size(spans) > 0").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct("variant", "spans")).alias("all"))
    return docs.select("doc_id", "text").join(spans, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "all").mapInArrow(lean(cut), "doc_id long, text string")
