"""Document fingerprints by one-permutation MinHash. DataFrame operations only."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import BLANKS, id_block, let

#: Bins of the one permutation: the 8 high bits of a shingle's hash.
BINS = 256
#: Low-order bits kept of each bin's minimum, and how many bins a 64-bit word holds.
LOW, A_WORD = 4, 16
#: Donor bins that an empty bin tries in turn before it takes the first of all filled bins in its own random order.
TRIES = 8

#: The largest hash of each bin: one sentinel a bin, so that sorting leaves every bin with a first value.
SENTINELS = [((b - BINS // 2 + 1) << 56) - 1 for b in range(BINS)]


def shingle_hashes(text: Column, width: int = 5) -> Column:
    """64-bit hashes of the word shingles of a text, in lower case; fewer words than the width are one shingle, none are none."""
    words = F.transform(F.filter(F.split(F.lower(text), f"[{BLANKS}]+"), lambda w: w != ""), lambda w: F.xxhash64(w))

    def rolled(h: Column) -> Column:
        n = F.size(h)
        many = F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))
        return F.when(n == 0, F.array().cast("array<long>")).otherwise(many)

    return let(words, rolled)


def signature(hashes: Column) -> Column:
    """The minimum of every bin, an array of longs; an empty bin has the value of a filled one. No hashes at all: null.

    Hashes are binned once, by sorting them together with one sentinel a bin. Densification is the optimal one: each empty bin
    has its own random sequence of donors, the same for all texts, and takes the first that is filled.
    """
    sentinels = F.array(*[F.lit(x) for x in SENTINELS])
    draw = random.Random(7)
    donors = [F.array(*[F.lit(draw.randrange(BINS)) for _ in range(BINS)]) for _ in range(TRIES)]
    bin_of = lambda x: F.shiftright(x, 56)

    def first_of_bins(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(ordered, i - 1))))

    def empty(x: Column, i: Column) -> Column:
        return x == F.get(sentinels, i)

    def dense(least: Column) -> Column:
        filled = F.transform(least, lambda x, i: F.when(~empty(x, i), x))

        def fill(v: Column) -> Column:
            # only the filled bins, once a text: where the donors fail they are few, and a short text has many such bins
            held = F.filter(F.transform(v, lambda x, j: F.when(x.isNotNull(), F.struct(j.alias("j"), x.alias("x")))), lambda s: s.isNotNull())

            def from_held(few: Column) -> Column:
                def last_way(i: Column) -> Column:
                    return F.array_min(F.transform(few, lambda s: F.struct(F.xxhash64(i, s.j).alias("r"), s.x.alias("x")))).x

                return F.transform(v, lambda x, i: F.coalesce(x, *[F.get(v, F.get(d, i)) for d in donors], last_way(i)))

            return let(held, from_held)

        return let(filled, fill)

    ordered = F.sort_array(F.concat(hashes, sentinels))
    return F.when(F.size(hashes) > 0, let(let(ordered, first_of_bins), dense))


def packed(sig: Column) -> Column:
    """LOW low-order bits of each bin, A_WORD bins a long: 16 longs, or null.

    The bits are those of the value hashed with its bin, so that a value which fills many bins of a short text does not make
    them all equal to another text's by one chance.
    """
    low = F.transform(sig, lambda x, i: F.xxhash64(x, i).bitwiseAND(F.lit((1 << LOW) - 1)))

    def words(bits: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // A_WORD - 1)), lambda k: F.aggregate(F.slice(bits, k * A_WORD + 1, A_WORD), F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, LOW).bitwiseOR(x)))

    return F.when(sig.isNotNull(), let(low, words))


def fingerprint(text: Column, width: int = 5) -> Column:
    """The packed fingerprint of a text: 256 bins of 4 bits in 16 longs, null if it has no words."""
    return let(let(shingle_hashes(text, width), signature), packed)


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard similarity that two fingerprints tell: equal bins less those equal by chance (one in 2**LOW).

    Two texts without words are alike (1.0); one with words and one without are not (0.0).
    """
    ones = F.lit(0x1111111111111111)

    def differing(x: Column) -> Column:
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(ones))

    apart = F.aggregate(F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    chance = 1 / 2**LOW
    found = F.greatest(F.lit(0.0), ((1 - apart / BINS) - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(found)


def as_text(fp: Column) -> Column:
    """256 hexadecimal digits, one a bin; empty if the text has no words."""
    return F.coalesce(F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""), F.lit(""))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fp, next_text, next_fp): every row beside the next in descending doc_id, the first after the last.

    A null text is empty. Rows with equal ids follow each other by text; a null doc_id stands with the smallest id. Text is
    shuffled once, to blocks of ids; the first rows of a block are also sent to the block before it, so no window spans the
    table. What is broadcast is one row a block, 104,096 at most. Blocks have about as many rows however the ids lie.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    block = id_block(docs, 200, 100_000)
    heads = docs.select(block.alias("b"), "doc_id").groupBy("b").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy(F.col("b").desc())
    everywhere = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(F.col("b").alias("_b"), "head", F.coalesce(F.lag("b").over(order), F.last("b").over(everywhere)).alias("before"))
    rows = docs.withColumn("fp", fingerprint(F.col("text"))).withColumn("b", block)
    sent = rows.join(F.broadcast(heads), F.col("b") == F.col("_b")).select(
        "doc_id", "text", "fp", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(F.struct("b", F.lit(False).alias("ghost")), F.struct(F.col("before").alias("b"), F.lit(True).alias("ghost")))).otherwise(F.array(F.struct("b", F.lit(False).alias("ghost"))))).alias("to")
    )
    by = Window.partitionBy("to.b").orderBy("to.ghost", F.desc("doc_id"), "text")
    return sent.select("doc_id", "text", "fp", "to.ghost", F.lead("text").over(by).alias("next_text"), F.lead("fp").over(by).alias("next_fp")).where("not ghost").drop("ghost")


def fingerprint_with_edits(docs: DataFrame) -> DataFrame:
    """Per row: fingerprints of the text and of its edited text, and how like they are to each other and to the next row's.

    The edited text has the last half of the code points replaced by as many first ones of the next document. A single row is
    its own next. An empty table gives an empty result; other columns are ignored.
    """
    rows = with_next(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fp", "next_fp", fingerprint(F.col("edited")).alias("edited_fp"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
