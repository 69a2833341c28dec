"""Joins between documents, their headers, items, masters and follow-on documents.

Join strategy is left to Catalyst and adaptive execution unless a function says
otherwise. Two rules hold for every function here:

* a side is broadcast only when the plan's size estimate is below a limit;
* a hot key is split (``skew_safe_join``), never collected into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.functions._cols import unused
from erpweave.session import BROADCAST_LIMIT_BYTES, plan_bytes

# Key fields without which a document number is ambiguous (fixed by the ERP data model).
FISCAL_KEY = ("bukrs", "belnr", "gjahr")


def header_items(items: DataFrame, headers: DataFrame, keys: Sequence[str], tenant: str | None = None) -> DataFrame:
    """Items with their header; items without a header are dropped."""
    return items.join(headers, [*([tenant] if tenant else []), *keys], "inner")


def fiscal_join(left: DataFrame, right: DataFrame, how: str = "inner", tenant: str | None = None) -> DataFrame:
    """Join accounting documents on company, number and fiscal year - all three."""
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in FISCAL_KEY if k not in df.columns]
        if missing:
            raise ValueError(f"{side} side lacks key fields {missing}")
    return left.join(right, [*([tenant] if tenant else []), *FISCAL_KEY], how)


def enrich(fact: DataFrame, dimension: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Left join of a fact with a dimension; a mapping names (fact key -> dimension key)."""
    if isinstance(keys, Mapping):
        dimension = dimension.withColumnsRenamed({d: f for f, d in keys.items()})
        keys = list(keys)
    return fact.join(dimension, list(keys), "left")


def reduce_to_keys(df: DataFrame, driver: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``driver``; ``keys`` maps df column to driver column.

    A semi join needs no DISTINCT on the driver and never multiplies rows. An empty
    driver gives no rows.
    """
    side = driver.select(*[F.col(d).alias(f"_k{i}") for i, d in enumerate(keys.values())])
    condition = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(keys)]
    return df.join(side, condition, "left_semi")


def missing_keys(df: DataFrame, other: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``other``."""
    side = other.select(*[F.col(d).alias(f"_k{i}") for i, d in enumerate(keys.values())])
    condition = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(keys)]
    return df.join(side, condition, "left_anti")


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the estimated size allows it; otherwise return ``df`` as is.

    Estimates of joins are products and of filters the unfiltered size, so they err
    on the large side and the hint is the exception, not the rule.
    """
    return F.broadcast(df) if plan_bytes(df) <= limit_bytes else df


def lookup(
    df: DataFrame, table: DataFrame, keys: Sequence[str], limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Probe a table with unique keys per row: a hash lookup while the table is small."""
    return df.join(broadcast_if_small(table, limit_bytes), list(keys), "left")


def merge_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Both sides sorted on the key and read once, in parallel."""
    return left.join(right.hint("merge"), list(keys), how)


def skew_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    pieces: int = 32,
) -> DataFrame:
    """Inner or left join that spreads hot keys of ``left`` over ``pieces`` partitions.

    Keys holding more than ``share`` of the rows of ``left`` are hot, so there are fewer
    than ``1 / share`` of them: that list is what gets broadcast. Rows of a hot key get a
    piece number from a hash of the row, and the matching rows of ``right`` are repeated
    once per piece. Rows of ``left`` with a NULL key match nothing; an inner join drops them first, a left
    join deals them out by their hash. All other keys join as usual.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_safe_join supports inner and left joins")
    keys = list(keys)
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    if how == "inner":
        left = left.filter(~no_key)
    number, is_hot, piece = (unused(n, left.columns, right.columns) for n in ("_n", "_hot", "_piece"))
    counts = left.filter(~no_key).groupBy(*keys).agg(F.count(F.lit(1)).alias(number))
    # The threshold is a scalar subquery: one value, no join.
    threshold = left.agg(F.count(F.lit(1)) * share).scalar()
    hot = counts.filter(F.col(number) > threshold).select(*keys, F.lit(True).alias(is_hot))
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    spread = (
        left.join(F.broadcast(hot), keys, "left")
        .withColumn(
            piece,
            F.when(no_key, F.pmod(row_hash, F.lit(1 << 16))).when(F.col(is_hot), F.pmod(row_hash, F.lit(pieces)))
            .otherwise(F.lit(0)).cast("int"),
        )
        .drop(is_hot)
    )
    repeated = (
        right.join(F.broadcast(hot), keys, "left")
        .withColumn(
            piece,
            F.explode(F.when(F.col(is_hot), F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))),
        )
        .drop(is_hot)
    )
    return spread.join(repeated, [*keys, piece], how).drop(piece)


def document_chain(
    start: DataFrame, steps: Sequence[tuple[DataFrame, Mapping[str, str]]], how: str = "inner"
) -> DataFrame:
    """Follow reference fields from document to document.

    Each step is (next document, {column so far: column of the next document}). Columns
    of the steps must have distinct names; the join columns of the next document go.
    """
    chain = start
    for nxt, links in steps:
        renamed = nxt.withColumnsRenamed({n: f"_ref_{n}" for n in links.values()})
        condition = [F.col(c) == F.col(f"_ref_{n}") for c, n in links.items()]
        chain = chain.join(renamed, condition, how).drop(*[f"_ref_{n}" for n in links.values()])
    return chain


def object_key_join(accounting: DataFrame, source: DataFrame, key: Column, origin: str) -> DataFrame:
    """Accounting documents with the document they came from, by origin type and key."""
    posted = accounting.filter(F.col("awtyp") == origin)
    return posted.join(source.withColumn("_object_key", key), F.col("awkey") == F.col("_object_key")).drop(
        "_object_key"
    )


@dataclass(frozen=True)
class Association:
    """A named relation to another frame, joined only when one of its fields is selected."""

    target: DataFrame
    keys: Mapping[str, str]


@dataclass(frozen=True)
class EntityView:
    """Reusable view: renamed fields of a base frame plus associations."""

    base: DataFrame
    fields: Mapping[str, str]
    associations: Mapping[str, Association] = field(default_factory=dict)

    def select(self, *fields: str, where: Column | None = None) -> DataFrame:
        """Select view fields and ``_Association.field`` paths (alias with ``path AS name``)."""
        df = self.base.select(*[F.col(source).alias(name) for name, source in self.fields.items()])
        if where is not None:
            df = df.filter(where)
        wanted: list[Column] = []
        used: dict[str, list[str]] = {}
        for text in fields:
            path, _, name = text.partition(" AS ")
            head, dot, leaf = path.partition(".")
            if dot:
                used.setdefault(head, []).append(leaf)
                wanted.append(F.col(f"{head}__{leaf}").alias(name or leaf))
            else:
                wanted.append(F.col(path).alias(name or path))
        for head, leaves in used.items():
            assoc = self.associations[head]
            target = assoc.target.select(
                *[F.col(t).alias(f"{head}__key_{t}") for t in assoc.keys.values()],
                *[F.col(leaf).alias(f"{head}__{leaf}") for leaf in dict.fromkeys(leaves)],
            )
            condition = [F.col(s) == F.col(f"{head}__key_{t}") for s, t in assoc.keys.items()]
            df = df.join(target, condition, "left")
        return df.select(*wanted)

    def register(self, name: str) -> None:
        """Publish the view's own fields under a SQL name."""
        self.select(*self.fields).createOrReplaceTempView(name)


def expand_items(
    headers: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    page_size: int = 1000,
    spread: Column | None = None,
) -> DataFrame:
    """Headers with nested items: (header columns, ``page``, ``items``).

    Nested items come in pages, as an expanded collection with next-links does: a header
    has ``ceil(items / page_size)`` rows (one with an empty array if it has none), so that
    a document of any size never becomes one array. ``spread`` decides the page of an
    item; it defaults to a hash of the item.
    """
    keys, fields = list(keys), list(fields)
    item = F.struct(*[F.col(c) for c in fields])
    spread = spread if spread is not None else F.xxhash64(*[F.col(c) for c in fields])
    pages = items.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / page_size).cast("long").alias("_pages"))
    # An item count above one page is rare; the page count joins on the document key, which
    # adaptive execution splits when one document is hot on the item side.
    paged = items.join(pages, keys).select(*keys, F.pmod(spread, F.col("_pages")).alias("page"), item.alias("_item"))
    # Shuffle by page, not by document: grouped where the join left them, all pages of a
    # hot document would be built in one task.
    paged = paged.repartition(*keys, "page")
    nested = paged.groupBy(*keys, "page").agg(F.sort_array(F.collect_list("_item")).alias("items"))
    empty = F.array().cast(nested.schema["items"].dataType)
    return headers.join(nested, keys, "left").withColumns(
        {"page": F.coalesce("page", F.lit(0).cast("long")), "items": F.coalesce("items", empty)}
    )


def doc_flow(flow: DataFrame, kind: str) -> DataFrame:
    """Header-level follow-on documents of one kind: (predecessor, successor), once each.

    The flow table repeats a pair per item, so it says nothing about item pairs.
    """
    return (
        flow.filter(F.col("vbtyp_n") == kind)
        .select(F.col("vbelv").alias("predecessor"), F.col("vbeln").alias("successor"))
        .distinct()
    )
