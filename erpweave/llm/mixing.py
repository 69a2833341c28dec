"""Mixing sources to target weights by weighted fair queueing (DataFrame operations only).

Documents of a source queue in a shuffled order, once per round (a source may be repeated twice). The virtual finish
time of a copy is the number of source tokens up to its end, divided by the source's target weight. The mix is all copies
in the order of virtual finish time, over all sources, cut where the running sum of their tokens reaches the
total budget; the copy that runs over it is cut there. No source is cut by itself: that each comes out near its target
follows from the order.

The global order is by ranges of virtual time. A range of time holds a known volume of every source (time times
target), so equal ranges are like-sized without sampling: tokens are added up per range, a running sum over the
ranges finds the one in which the budget ends, and only the copies of that range are summed one by one. The result is
one cut place, with which every copy is compared. The running sum inside a source works alike: sums per
(source, hash prefix), whose offsets are a window over at most about sqrt(rows) prefixes, and a window inside a
prefix. No window holds a whole source, so a source with a third of all rows costs no long task.

Defined results: NULL text counts 0 words and is taken with 0; NULL source is a source of its own,
last in the order; repeated rows queue each; no rows give no rows. Equal finish times go by source, then by place in the
source. One row per source is assumed to fit a task. Reruns agree: the order is by MD5 of id and seed, then by text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpweave.llm.text import BLANKS, n_words, packed
from erpweave.session import materialize

WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """Tokens per source: weighted shares of the budget, none above ``repeats`` times the source.

    ``sizes(no_source, name, total)``. What sources cannot take is shared again by weight. With the sources
    in the order of capacity per weight, the level is that of the first source it does not fill.
    """
    by_name = Window.orderBy("no_source", "name")
    by_fill = Window.orderBy("fill", "no_source", "name")
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.row_number().over(by_name) - 1) % len(weights)]
    weighted = sizes.select("*", weight.alias("weight")).withColumn("most", repeats * F.col("total").cast("double"))
    level = (
        weighted.withColumn("fill", F.col("most") / F.col("weight"))
        .withColumn("filled", F.coalesce(F.sum("most").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("budget", F.sum(F.col("total").cast("double")).over(Window.partitionBy()) * share)
        .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("rest"))
    )
    first = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(Window.partitionBy())
    return (
        level.withColumn("first", first)
        .withColumn("target", F.when(F.col("first").isNull() | (F.col("fill") < F.col("first.fill")), F.col("most"))
                    .otherwise(F.col("first.level") * F.col("weight")))
        .select("no_source", "name", F.col("total").alias("source_size"), "target")
    )


def _place(finish: Column, at: Column) -> Column:
    """A copy's place in the order of the mix; no two copies with words have the same."""
    return F.struct(finish.alias("finish"), F.col("no_source").alias("no_source"), F.col("name").alias("name"), at.alias("at"))


def _copies(queued: DataFrame, repeats: int) -> DataFrame:
    """One row per document and round with its place; documents without words take no part."""
    at = F.col("round") * F.col("source_size") + F.col("start") + F.col("size")
    return (
        queued.where("size > 0")
        .select("*", F.explode(F.array(*[F.lit(r).cast("long") for r in range(repeats)])).alias("round"))
        .withColumn("at", at)
        .withColumn("finish", F.col("at") / F.col("target"))
    )


def _cut(queued: DataFrame, share: float, repeats: int, ranges: int) -> tuple[dict, int] | None:
    """The place at which the tokens of the copies in finish order reach the total budget, and what is left for the copy there.

    ``None``: the budget is never reached, all copies are taken whole. The budget is a share of all tokens.
    """
    copies = _copies(queued.select("no_source", "name", "size", "source_size", "target", "start"), repeats)
    ranged = copies.withColumn("range", F.floor(F.col("finish") * ranges))
    totals = ranged.groupBy("range").agg(F.sum("size").alias("tokens"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    budget = F.floor(F.sum("tokens").over(Window.partitionBy()) / repeats * share).cast("long")
    last = (
        totals.withColumn("upto", F.sum("tokens").over(upto)).withColumn("budget", budget)
        .where("upto >= budget").orderBy("range").first()
    )
    if last is None:
        return None
    within = Window.orderBy("finish", "no_source", "name", "at").rowsBetween(Window.unboundedPreceding, 0)
    left = last["budget"] - (last["upto"] - last["tokens"])
    found = (
        ranged.where(F.col("range") == last["range"])
        .withColumn("upto", F.sum("size").over(within))
        .where(F.col("upto") >= left).orderBy("upto").first()
    )
    place = {c: found[c] for c in ("finish", "no_source", "name", "at")}
    return place, left - (found["upto"] - found["size"])


def schedule(
    docs: DataFrame, carry: Sequence[str] | None = None, weights: Sequence[float] = WEIGHTS,
    share: float = 1.5, repeats: int = 2, seed: str = "mix",
) -> DataFrame:
    """Each row of ``docs`` as ``_row`` (the ``carry`` columns), with size, source_size, target, and its queue place.

    ``start`` is the number of source tokens before it in a round, ``parts`` the words that the mix takes in each
    round, ``taken`` their sum.
    """
    keyed = packed(docs).select(
        F.struct(*[F.col(f"_row.`{c}`") for c in (carry or docs.columns)]).alias("_row"),
        F.col("_row.source").isNull().alias("no_source"), F.coalesce(F.col("_row.source"), F.lit("")).alias("name"),
        n_words(F.col("_row.text")).alias("size"),
        F.md5(F.concat(F.coalesce(F.col("_row.doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))).alias("place"),
        F.xxhash64("_row.text").alias("tie"),
    )
    # Written once: sums, targets and the cut are found on narrow rows; texts are read once more, for the result.
    sized = materialize(keyed.select("no_source", "name", "size", "place", "tie"), "mix-sizes")
    digits = max(1, math.ceil(math.log(max(sized.count(), 1), 16) / 2))
    keys = ["no_source", "name", "prefix"]

    def prefixed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("prefix", F.substring("place", 1, digits))

    cells = prefixed(sized).groupBy(*keys).agg(F.sum("size").alias("cell"))
    before = Window.partitionBy("no_source", "name").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(cells.groupBy("no_source", "name").agg(F.sum("cell").alias("total")), weights, share, repeats)
    offsets = materialize(
        cells.select(*keys, F.coalesce(F.sum("cell").over(before), F.lit(0)).alias("offset"))
        .join(targets, ["no_source", "name"]), "mix-offsets")
    inside = Window.partitionBy(*keys).orderBy("place", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)

    def queued(rows: DataFrame) -> DataFrame:
        return (
            prefixed(rows).withColumn("end", F.sum("size").over(inside))
            .join(offsets, keys)
            .withColumn("start", F.col("offset") + F.col("end") - F.col("size"))
        )

    found = _cut(queued(sized), share, repeats, 16 ** digits)
    taken = []
    for r in range(repeats):
        at = F.lit(r).cast("long") * F.col("source_size") + F.col("start") + F.col("size")
        part = F.col("size")
        if found:
            cut, left = found
            there = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["no_source"]).alias("no_source"),
                             F.lit(cut["name"]).alias("name"), F.lit(cut["at"]).cast("long").alias("at"))
            mine = _place(at / F.col("target"), at)
            part = F.when(mine < there, part).when(mine == there, F.lit(left).cast("long")).otherwise(F.lit(0).cast("long"))
        taken.append(F.when(F.col("size") > 0, part).otherwise(F.lit(0).cast("long")))
    return queued(keyed).select(
        "_row", "size", "source_size", "target", "start", F.array(*taken).alias("parts"),
        sum(taken[1:], taken[0]).alias("taken"),
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(F.regexp_like(text, F.lit(rf"^{BLANKS}")), 1).otherwise(0)
    return F.regexp_replace(F.array_join(F.slice(pieces, 1, n.cast("int") + lead), ""), rf"{BLANKS}$", "")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, repeats: int = 2,
        seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs`` as often as taken, in the order of virtual finish time.

    The copy that runs over the budget keeps its first words.
    """
    copies = schedule(docs, None, weights, share, repeats, seed).select(
        "*", F.posexplode("parts").alias("round", "part")
    ).where("part > 0")
    finish = (F.col("round") * F.col("source_size") + F.col("start") + F.col("size")) / F.col("target")
    rows = [
        (F.when(F.col("part") < F.col("size"), first_words(F.col("_row.text"), F.col("part")))
         .otherwise(F.col("_row.text")) if c == "text" else
         F.when(F.col("part") < F.col("size"), F.length(first_words(F.col("_row.text"), F.col("part")))).otherwise(
             F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType) if c == "n_chars" else
         F.col(f"_row.`{c}`")).alias(c)
        for c in docs.columns
    ]
    return (
        copies.withColumn("finish", finish)
        .repartitionByRange("finish", F.xxhash64("_row.doc_id"))
        .sortWithinPartitions("finish")
        .select(*rows)
    )
