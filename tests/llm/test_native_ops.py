"""Line dedup, sharding, SimHash and fingerprints against plain versions on small tables."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

from strandline.llm import fingerprint, line_dedup, sharding, simhash
from strandline.llm.common import components, id_block, joined_to_one, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, fp string, b long"


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(ids[i] if ids else i, t, None, None, None, "x", "y", 3) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    words = ["alpha", "Bêta", "gamma", "delta", "epsilon", "zeta", "ÉTA", "theta"]
    line = lambda n: " ".join(r.choices(words, k=n))
    common = [line(9) for _ in range(4)]
    out = ["\n".join(r.choice([line(2), line(10), r.choice(common), f"  {r.choice(common).upper()}\t"]) for _ in range(r.randrange(1, 7))) for _ in range(60)]
    return [*out, None, "", " ", "\n\n", "one", "One two\x0bthree", out[3], out[3], "x " * 30_000, "  nbsp line"]


def test_line_dedup(spark, texts):
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    lines = [(t or "").split("\n") for t in texts]
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, own in enumerate(lines):
        for k in {key(x) for x in own}:
            held.setdefault(k, []).append(i)
    want = {}
    for i, own in enumerate(lines):
        keep = [x for x in own if len(key(x)) < 40 or len(held[key(x)]) < 5 or held[key(x)][-1] == i]
        want[i] = ("\n".join(keep), len(own), len(own) - len(keep))
    assert sum(w[2] for w in want.values()) > 10
    for batches in (1, 3, 7):
        got = {r[0]: tuple(r)[1:] for r in line_dedup.dedup_lines(docs(spark, texts), batches=batches, fanout=2).collect()}
        assert got == want


def names(path):
    return {x.name for x in Path(path.removeprefix("file:")).rglob("*") if x.is_file()}


def test_scratch_tables_have_a_file_a_task_and_tell_damage(spark, tmp_path):
    df = written(spark.range(4000).repartition(3), "test")
    path = "/" + df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0].lstrip("/")
    assert len(names(path)) == 3 and all(x.startswith("part-") for x in names(path))  # Hadoop's checksum files were as many again
    assert df.agg(F.count("*"), F.sum("id")).first() == (4000, 4000 * 3999 // 2)

    keys = spark.range(500).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.lit(1).cast("long").alias("n_docs"), F.col("id").alias("keeper"))
    for store, checked in ((None, False), (f"{tmp_path}/store", True)):  # what lives on is written as any table
        runs = line_dedup.LineRuns(spark, path=store)
        runs.add(keys)
        assert any(x.endswith(".crc") for x in names("/" + runs.path.removeprefix("file:").lstrip("/"))) == checked
        assert runs.all_keys().count() == 500
        runs.close()

    for part in Path(path).iterdir():
        raw = bytearray(part.read_bytes())
        raw[len(raw) // 3] ^= 255
        part.write_bytes(raw)
    with pytest.raises(Exception, match="(?i)crc|checksum"):
        df.agg(F.sum("id")).collect()


def test_rows_that_share_an_id_are_one_document(spark):
    duckdb = pytest.importorskip("duckdb")
    from strandline.llm.queries import ORACLE_SQL

    line, other, third = "a line that is long enough to be looked at " * 2, "B" * 50, "é" * 40
    rows = [*[(1, f"{line}\n{other}")] * 5, (2, line), (3, other), (4, f"{other}\nx"), (None, other), (None, f"{other}\n{other}"), *[(i, third) for i in (5, 6, 7, 7)], (None, third), (8, None)]
    df = spark.createDataFrame([(i, t, None, None, None, "x", "y", 3) for i, t in rows], SCHEMA)
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(ORACLE_SQL["op6_line_dedup"]).fetchall()
    got = line_dedup.dedup_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(x.n_dropped for x in got) == 0  # four documents hold each
    more = df.unionAll(df.limit(1).selectExpr("9l as doc_id", "text", "lang", "source", "n_chars", "key", "fp", "b"))
    assert {x.doc_id: x.n_dropped for x in line_dedup.dedup_lines(more).collect()} == {1: 1, 2: 0, 3: 1, 4: 1, None: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0} | {None: 0}


def test_a_store_goes_on(spark, texts, tmp_path):
    whole = {r[0]: tuple(r)[1:] for r in line_dedup.dedup_lines(docs(spark, texts)).collect()}
    half = len(texts) // 2
    path = f"file://{tmp_path}/store"
    one = line_dedup.dedup_lines(docs(spark, texts[half:], list(range(half, len(texts)))), store=path).collect()
    two = line_dedup.dedup_lines(docs(spark, texts[:half]), store=path).collect()
    # lines that only both batches together make frequent stay in the batch that came first
    assert {r[0]: tuple(r)[1:] for r in two} == {i: whole[i] for i in range(half)} and sum(r.n_dropped for r in two) > 0
    assert all(r.n_dropped <= whole[r.doc_id][2] for r in one)
    again = line_dedup.dedup_lines(docs(spark, texts[:half], list(range(1000, 1000 + half))), store=path).collect()
    assert sum(r.n_dropped for r in again) >= sum(r.n_dropped for r in two)


def test_blocks_are_even_however_ids_lie(spark):
    r = random.Random(6)
    for ids in ([*range(2000), 2**60], [r.getrandbits(63) - 2**62 for _ in range(3000)], [2**40 + i // 3 for i in range(3000)], [*range(500), *range(10**15, 10**15 + 500), -(2**63), 2**63 - 1, None], [7] * 50, [None] * 5):
        df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
        block = id_block(df, 50, 10_000)
        got = df.select("doc_id", block.alias("b")).collect()
        known = sorted((x.doc_id, x.b) for x in got if x.doc_id is not None)
        assert [b for _, b in known] == sorted(b for _, b in known)
        sizes = Counter(b for _, b in known)
        assert max(sizes.values(), default=0) <= max(100, max(Counter(i for i in ids if i is not None).values(), default=0))


def test_a_null_id_moves_no_other_row(spark):
    ids = [2**60 + 3, 2**60 + 255, 2**62 + 1, -(2**62) - 1]
    alone = {r.doc_id: r.shard for r in sharding.assign(docs(spark, ["x"] * 4, ids)).collect()}
    beside = {r.doc_id: r.shard for r in sharding.assign(docs(spark, ["x"] * 5, [None, *ids]).coalesce(1)).collect()}
    assert {i: beside[i] for i in ids} == alone


def test_sharding(spark, texts):
    ids = [None, *range(-3, len(texts) - 5), 2**60 + 255]
    rows = sharding.assign(docs(spark, texts, ids), 8).collect()
    assert len(rows) == len(texts)

    def jump(key, n):
        key, b, j = (key or 0) % 2**64, -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
        return b

    by = {ids[i]: t for i, t in enumerate(texts)}
    for r in rows:
        raw = (by[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.shard, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), jump(r.doc_id, 8), jump(r.doc_id, 9))
        assert r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, texts):
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = [plain_simhash(t) for t in texts]
    assert [got[i][0] for i in range(len(texts))] == fps
    assert [got[i][1] for i in range(len(texts))] == plain_components(fps, 4)


def plain_components(codes, limit):
    root = list(range(len(codes)))
    while True:
        new = [min(root[j] for j in range(len(codes)) if (codes[i] ^ codes[j]).bit_count() <= limit) for i in range(len(codes))]
        if new == root:
            return root
        root = new


@pytest.mark.parametrize("most", [4096, 7])
def test_links_are_all_found(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "GROUP", most)
    r = random.Random(1)
    codes = []
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 3, 40])):
            x ^= sum(1 << b for b in r.sample(range(64), r.choice([0, 1, 3, 4, 5])))
            codes.append(x)
    df = spark.createDataFrame([(i, simhash.signed(c)) for i, c in enumerate(codes)], "doc_id long, fp long")
    comp = {row.fp: row.component_id for row in simhash.near_components(df).collect()}
    assert [comp[simhash.signed(c)] for c in codes] == plain_components(codes, 4)


def test_hot_keys_are_joined_from_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr("strandline.llm.common.HOT", 10)
    monkeypatch.setattr("strandline.llm.common.SOME", 20)
    r = random.Random(4)
    keys = [1] * 200 + [r.randrange(60) for _ in range(150)] + [None] * 5
    rows = spark.createDataFrame([(k, None if k is None else k * 2, i) for i, k in enumerate(keys)], "a long, b long, i long")
    ones = rows.where("a is not null and a < 50").groupBy("a", "b").count().withColumn("v", F.col("a") * 10)
    got = sorted((x.i, x.v) for x in joined_to_one(rows, ones, ["a", "b"], "count", "i").collect())
    assert got == [(i, k * 10 if k is not None and k < 50 else None) for i, k in enumerate(keys)]


def test_masks_cover_all_differences():
    r = random.Random(2)
    for rows in (0, 10**4, 10**8, 10**12):
        for _ in range(300):
            apart = sum(1 << b for b in r.sample(range(64), 4))
            assert any(not apart & m for m in simhash.masks(4, rows))


@pytest.mark.parametrize("some", [500, 5])
def test_components(spark, monkeypatch, some):
    monkeypatch.setattr("strandline.llm.common.SOME", some)
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    hub = [(9000, 5000 + i) for i in range(60)] + [(4000 + i, 9000) for i in range(0, 60, 7)]
    got = {x.node: x.root for x in components(spark.createDataFrame(hub, "a long, b long")).collect()}
    assert got == {n: 4000 for n in {x for e in hub for x in e} - {4000}}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
    structs = spark.createDataFrame(hub, "a long, b long").select(F.struct(F.col("a").alias("doc_id"), F.lit(3).alias("start")).alias("a"), F.struct(F.col("b").alias("doc_id"), F.lit(3).alias("start")).alias("b"))
    assert {x.node.doc_id: x.root.doc_id for x in components(structs).collect()} == {n: 4000 for n in {x for e in hub for x in e} - {4000}}
    for _ in range(3):
        pairs = [(r.randrange(80), r.randrange(80)) for _ in range(60)]
        root = list(range(80))
        for _ in range(80):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        got = {x.node: x.root for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert got == {i: root[i] for i in range(80) if root[i] != i}
    r.shuffle(chain)
    got = {x.node: x.root for x in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {n: t for n, t in got.items() if n != t} == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 50)}


def test_fingerprints(spark, texts):
    rows = {r.doc_id: r for r in fingerprint.fingerprint_with_edits(docs(spark, texts)).collect()}
    assert len(rows) == len(texts)

    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t.lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    real = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    off = []
    for i in range(len(texts)):
        own, nxt = texts[i] or "", texts[i - 1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + nxt[:half]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        off += [abs(rows[i].near_edited - real(shingles(own), shingles(edited))), abs(rows[i].near_next - real(shingles(own), shingles(nxt)))]
    assert sum(off) / len(off) < 0.05 and max(off) < 0.35
    assert rows[3].fingerprint == rows[len(texts) - 4].fingerprint and len(rows[3].fingerprint) == 256 and rows[60].fingerprint == ""


def plain_fingerprint(text):
    """The fingerprint step by step: shingle hashes, least of each bin, donors for empty bins, four bits a bin."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    more = lambda seed, value, kind: xxhash.xxh64_intdigest(struct.pack(kind, value), seed)
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return ""
    least = [None] * 256
    for i in range(max(1, len(words) - 4)):
        h = 42
        for w in words[i : i + 5]:
            h = more(h, w, "<q")
        h = signed(h)
        b = (h >> 56) + 128
        if h != ((b - 127) << 56) - 1:
            least[b] = h if least[b] is None else min(least[b], h)
    draw = random.Random(7)
    donors = [[draw.randrange(256) for _ in range(256)] for _ in range(fingerprint.TRIES)]
    full = []
    for b in range(256):
        own = [least[b], *(least[d[b]] for d in donors)]
        got = next((x for x in own if x is not None), None)
        if got is None:
            got = min((signed(more(more(42, b, "<i"), j, "<i")), x) for j, x in enumerate(least) if x is not None)[1]
        full.append(got)
    return "".join(f"{more(more(42, x, '<q'), b, '<i') & 15:x}" for b, x in enumerate(full))


def test_fingerprints_are_those_of_the_plain_version(spark, texts):
    r = random.Random(10)
    more = [*texts, *[" ".join(f"w{r.randrange(500)}" for _ in range(n)) for n in (1, 2, 4, 5, 6, 7, 9, 30, 300, 3000)], "É Ü\tß"]
    got = {x.doc_id: x for x in fingerprint.fingerprint_with_edits(docs(spark, more)).collect()}
    for i, t in enumerate(more):
        t = t or ""
        nxt = more[i - 1] or ""
        assert got[i].fingerprint == plain_fingerprint(t), i
        assert got[i].edited_fingerprint == plain_fingerprint(t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]), i
        a, b = got[i].fingerprint, plain_fingerprint(nxt)
        same = sum(x == y for x, y in zip(a, b, strict=False)) / 256
        assert got[i].near_next == pytest.approx(1.0 if a == b == "" else 0.0 if not (a and b) else max(0.0, (same - 1 / 16) / (15 / 16)))


def allocated(spark, df):
    """MB that the JVM's live threads allocate while a frame is made."""
    threads = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getThreadMXBean()
    held = lambda: {i: threads.getThreadAllocatedBytes(i) for i in threads.getAllThreadIds()}
    before, _ = held(), df.write.format("noop").mode("overwrite").save()
    return sum(n - before.get(i, 0) for i, n in held().items()) / 1e6


def test_fingerprints_of_short_texts_leave_little_garbage(spark):
    """Most bins of a short text are empty, and those of their donors too: only its few filled bins are ranked then."""
    r = random.Random(8)
    made = docs(spark, [" ".join(str(r.randrange(10**6)) for _ in range(14)) for _ in range(400)]).coalesce(1).select(fingerprint.fingerprint(F.col("text")).alias("fp"))
    allocated(spark, made)  # classes are loaded and code is made
    assert allocated(spark, made) / 400 < 4  # MB a text; ranking all 256 bins for each empty one took 15


def test_likeness_is_unbiased(spark):
    r = random.Random(9)
    base = [f"w{r.random()}" for _ in range(1500)]
    for share in (0.0, 0.3, 0.6, 0.9):
        other = base[: int(1500 * share)] + [f"w{r.random()}" for _ in range(1500 - int(1500 * share))]
        df = spark.createDataFrame([(" ".join(base), " ".join(other))], "a string, b string")
        near = df.select(fingerprint.fingerprint(F.col("a")).alias("a"), fingerprint.fingerprint(F.col("b")).alias("b")).select(fingerprint.likeness(F.col("a"), F.col("b"))).first()[0]
        n = max(0, int(1500 * share) - 4)
        assert abs(near - n / (2 * 1496 - n)) < 0.09


def test_empty_tables(spark):
    none = docs(spark, [])
    for f in (sharding.assign, line_dedup.dedup_lines, simhash.near_duplicates, fingerprint.fingerprint_with_edits):
        assert f(none).count() == 0
