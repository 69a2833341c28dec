"""SimHash document fingerprints and their search (DataFrame operations only).

A term is a lower-cased word, weighted by the square of its length up to 8, so function words
do not decide. Each term hash votes on 64 signed bits. The votes are counted in packed form: one
long holds the counters of bit k and bit k + 32, so 32 sums per document replace 64 and each
counter has 31 bits, enough for 33 million words in one text. The sums are ordinary map-side
aggregates over exploded words.

``within_radius`` finds all fingerprints within a Hamming radius through permuted block tables:
64 bits in ``blocks`` blocks; two fingerprints that differ in at most ``radius`` bits agree in some
choice of ``blocks - radius`` blocks, and every choice is one table. Equal fingerprints are one
entry with a count, and a pair is kept only from the first table it agrees in.

Defined results: a text without words has the fingerprint of 64 zero bits; NULL text counts as empty;
repeated rows get equal fingerprints; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpweave.llm.text import lower_ascii, packed, words

HALF, LANES = 32, (1 << 32) | 1
LOW = (1 << 32) - 1


def term_weight(word: Column) -> Column:
    return F.pow(F.least(F.length(word), F.lit(8)), F.lit(2)).cast("long")


def simhash(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Fingerprint (long) per row of ``keys``, which must identify the rows."""
    terms = texts.select(*keys, F.explode_outer(words(lower_ascii(F.col(text)))).alias("term")).select(
        *keys, F.xxhash64("term").alias("h"),
        F.when(F.col("term").isNull(), F.lit(0).cast("long")).otherwise(term_weight(F.col("term"))).alias("w"),
    )
    votes = terms.groupBy(*keys).agg(
        F.sum("w").alias("all"),
        *[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"v{k}") for k in range(HALF)],
    )
    bits = F.lit(0).cast("long")
    for k in range(HALF):
        low, high = F.col(f"v{k}").bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(f"v{k}", 32)
        for count, place in ((low, k), (high, k + HALF)):
            bits = bits.bitwiseOR(F.when(2 * count > F.col("all"), F.lit(1 << place if place < 63 else -(1 << 63)))
                                  .otherwise(F.lit(0).cast("long")))
    return votes.select(*keys, bits.alias("bits"))


def likeness(a: Column, b: Column) -> Column:
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def fingerprint_text(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def with_next(docs: DataFrame, rows_per_bucket: int = 4096, most_buckets: int = 16384) -> DataFrame:
    """Each row with the text of the next document by descending id; after the last comes the first.

    Rows are sorted inside buckets of ids cut at quantiles. Every bucket also gets the first row of
    the bucket that follows ("guest"), so one shuffle of the texts is enough. Returns doc_id, text, next_text,
    place (a unique order key), bucket, guest.
    """
    count = docs.count()
    n = max(1, min(most_buckets, math.ceil(count / rows_per_bucket)))
    cuts: list[int] = []
    if n > 1:
        points = [i / n for i in range(1, n)]
        found = docs.agg(F.percentile_approx("doc_id", points, max(10_000, 4 * n)).alias("q")).first()["q"]
        cuts = sorted(set(found or []))
    step = max(1, math.isqrt(len(cuts)))
    ordered = packed(docs).select(
        F.col("_row.doc_id").alias("doc_id"), F.coalesce(F.col("_row.text"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    if cuts:
        all_cuts, coarse = F.array(*map(F.lit, cuts)), F.array(*map(F.lit, cuts[::step]))
        at = lambda a: F.size(F.filter(a, lambda c: c <= F.col("doc_id")))
        first = F.greatest(at(coarse) - 1, F.lit(0)) * step
        bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(first + at(F.slice(all_cuts, first + 1, step)))
    else:
        bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    ordered = ordered.withColumn("bucket", bucket.cast("int"))

    # At most one row per bucket: the head of each, handed to the bucket before it.
    heads = ordered.groupBy("bucket").agg(F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")).alias("head"))
    down = Window.orderBy(F.desc("bucket"))
    handed = heads.select(
        F.coalesce(F.lag("bucket").over(down), F.min("bucket").over(Window.partitionBy())).alias("to"),
        F.col("head.doc_id").alias("head_id"), F.col("head.tie").alias("head_tie"),
    )
    guests = ordered.join(
        F.broadcast(handed), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    ).select("doc_id", "text", "tie", F.col("to").alias("bucket"), F.lit(True).alias("guest"))
    line = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return (
        ordered.withColumn("guest", F.lit(False)).unionByName(guests)
        .select("doc_id", "text", "bucket", "guest", F.lead("text").over(line).alias("next_text"),
                F.row_number().over(line).cast("long").alias("in_bucket"))
        .withColumn("place", F.shiftleft((F.col("bucket") + 1).cast("long"), 40) + F.col("in_bucket"))
        .drop("in_bucket")
    )


def edited(text: Column, next_text: Column) -> Column:
    """The last half of the code points replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half),
                    F.substring(F.coalesce(next_text, F.lit("")), F.lit(1), half))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, bits, edited_bits, next_bits of every row."""
    pairs = with_next(docs)
    keys = ["place", "bucket", "guest", "doc_id", "n_chars", "edited_sha256", "kind"]
    change = pairs.select(
        "place", "bucket", "guest", "doc_id", F.length("text").cast("long").alias("n_chars"), "text",
        F.when(~F.col("guest"), edited(F.col("text"), F.col("next_text"))).alias("edit"),
    )
    both = change.select(
        "place", "bucket", "guest", "doc_id", "n_chars", F.sha2(F.encode("edit", "UTF-8"), 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
                          F.struct(F.lit(1).alias("kind"), F.col("edit").alias("t")))).alias("version"),
    ).select(*keys[:-1], "version.kind", "version.t").where("kind = 0 or not guest")
    prints = simhash(both, keys, "t")
    one = prints.groupBy(*keys[:-1]).agg(
        F.max(F.when(F.col("kind") == 0, F.col("bits"))).alias("bits"),
        F.max(F.when(F.col("kind") == 1, F.col("bits"))).alias("edited_bits"),
    )
    line = Window.partitionBy("bucket").orderBy("place")
    return one.select("*", F.lead("bits").over(line).alias("next_bits")).where(~F.col("guest")).select(
        "doc_id", "n_chars", "edited_sha256", "bits", "edited_bits", "next_bits"
    )


def block_masks(radius: int, blocks: int) -> list[int]:
    """One mask per choice of ``blocks - radius`` blocks of the 64 bits, as signed longs."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    masks = [sum(c) for c in itertools.combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """Pairs of distinct fingerprints: (bits, near_bits, distance, n_near), n_near rows having near_bits.

    ``queries(bits)``, ``prints(bits)``. The pair of a fingerprint with itself is included.
    """
    masks = block_masks(radius, blocks)

    def tables(df: DataFrame, name: str, *more: str) -> DataFrame:
        keys = [F.struct(F.lit(i).alias("t"), F.col(name).bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
        return df.select(name, *more, F.explode(F.array(*keys)).alias("k")).select(name, *more, "k.t", "k.key")

    asked = tables(queries.select("bits").distinct(), "bits")
    stored = tables(prints.groupBy(F.col("bits").alias("near_bits")).agg(F.count("*").alias("n_near")), "near_bits", "n_near")
    differ = F.col("bits").bitwiseXOR(F.col("near_bits"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    return (
        asked.join(stored, ["t", "key"])
        .where((F.bit_count(differ) <= radius) & (F.col("t") == first))
        .select("bits", "near_bits", F.bit_count(differ).alias("distance"), "n_near")
    )
