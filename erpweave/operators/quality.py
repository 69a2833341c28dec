"""Data-quality rules, metrics, reconciliation and row logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave.operators.dedupe import latest_per_key


@dataclass(frozen=True)
class Rule:
    """A named condition. A row violates it when the condition is false or NULL.

    ``action`` is "drop" (violating rows go) or "warn" (they stay and are counted).
    """

    name: str
    expr: str
    action: str = "drop"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))


def expect(df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None) -> DataFrame:
    """Apply the drop rules; with an observation, count violations on the way through.

    The counters ride on the same pass as the filter. A stream takes a name instead of an ``Observation``; its
    counters come with the progress of every batch (see ``erpweave.streaming.metrics``).
    """
    if observation is not None and rules:
        counters = [F.count_if(~r.holds()).alias(r.name) for r in rules]
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *counters)
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(F.expr(rule.expr))
    return df


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row (rule, action, passed, failed) per rule, from one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(~r.holds()).alias(f"_f{i}") for i, r in enumerate(rules)]
    )
    entries = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("_rows") - F.col(f"_f{i}")).alias("passed"),
            F.col(f"_f{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))


def quality_profile(
    df: DataFrame,
    key: str,
    amount: str,
    date: str,
    as_of: Column | None = None,
    oldest: str = "2000-01-01",
    client: str = "mandt",
) -> DataFrame:
    """Clients, null keys, negative amounts, dates out of range and a score, in one scan."""
    as_of = as_of if as_of is not None else F.current_date()
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(client).alias("clients"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(F.col(amount) < 0).alias("negative_amounts"),
        F.count_if(F.col(date) > as_of).alias("future_dates"),
        F.count_if(F.col(date) < F.lit(oldest).cast("date")).alias("old_dates"),
    )
    issues = F.col("null_keys") + F.col("negative_amounts") + F.col("future_dates") + F.col("old_dates")
    return counts.withColumns(
        {
            "null_key_pct": F.round(F.try_divide(F.col("null_keys") * 100.0, F.col("total_rows")), 2),
            "quality_score": F.round((F.lit(1.0) - F.try_divide(issues, F.col("total_rows"))) * 100, 1),
        }
    )


def reconcile(source: DataFrame, target: DataFrame, value: str, tolerance: str = "0.01") -> DataFrame:
    """Row counts and exact totals of two frames side by side, with a verdict.

    Both sides are reduced to one row each before they meet.
    """
    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col(value).cast("decimal(17,2)")), F.lit(0)).alias("v")
        ).select(F.lit(side).alias("side"), "n", F.col("v").cast("decimal(38,2)").alias("v"))

    both = totals(source, "s").unionByName(totals(target, "t"))

    def pick(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    return (
        both.agg(
            pick("s", "n").alias("source_count"), pick("t", "n").alias("target_count"),
            pick("s", "v").alias("source_total"), pick("t", "v").alias("target_total"),
        )
        .withColumns(
            {
                "delta_count": F.abs(F.col("source_count") - F.col("target_count")),
                "delta_total": F.abs(F.col("source_total") - F.col("target_total")).cast("decimal(38,2)"),
            }
        )
        .withColumn(
            "consistent",
            (F.col("delta_count") == 0) & (F.col("delta_total") <= F.lit(tolerance).cast("decimal(38,2)")),
        )
    )


def assert_reconciled(source: DataFrame, target: DataFrame, value: str, tolerance: str = "0.01") -> None:
    """Raise when the two frames diverge."""
    row = reconcile(source, target, value, tolerance).first()
    if not row["consistent"]:
        raise ValueError(f"diverging totals: {row.asDict()}")


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def schema_conformance(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per column: expected type, actual type, verdict, and how many values do not fit the expected type."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    # One pass counts for all columns; the report is its single row turned into one row per column.
    entries = []
    for name in dict.fromkeys([*want, *have]):
        w, h = want.get(name), have.get(name)
        verdict = "ok" if w == h else "missing" if h is None else "unexpected" if w is None else "type"
        column = F.col(f"`{name}`")
        bad = F.count_if(column.isNotNull() & column.cast("string").try_cast(w).isNull()) if w and h else F.lit(None)
        entries.append(F.struct(
            F.lit(name).alias("column"), F.lit(w).cast("string").alias("expected"), F.lit(h).cast("string").alias("actual"),
            F.lit(verdict).alias("verdict"), bad.cast("bigint").alias("bad_values"),
        ))
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def row_status(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``status`` (E, W or S) and ``message``: the first failed rule in order.

    A drop rule is an error; a warn rule leaves the row loadable. The first error wins
    over any warning.
    """
    error = F.coalesce(*[F.when(~r.holds(), F.lit(r.name)) for r in rules if r.action == "drop"], F.lit(None))
    warning = F.coalesce(*[F.when(~r.holds(), F.lit(r.name)) for r in rules if r.action == "warn"], F.lit(None))
    return df.withColumns(
        {
            "status": F.when(error.isNotNull(), "E").when(warning.isNotNull(), "W").otherwise("S"),
            "message": F.coalesce(error, warning, F.lit("")),
        }
    )


def first_error_message(messages: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """From a message log: per key, the earliest message of type E or A; of several with one number the least."""
    return (
        messages.filter(F.col("type").isin("E", "A"))
        .groupBy(*keys)
        .agg(F.min(F.struct(seq, "message")).getField("message").alias("message"))
    )


def prevalidate_existing(df: DataFrame, existing: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Mark rows whose key is already in ``existing``: status SKIP, else NEW."""
    known = existing.select(*[F.col(e).alias(f"_k{i}") for i, e in enumerate(keys.values())]).distinct()
    condition = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(keys)]
    return (
        df.join(known.withColumn("_known", F.lit(True)), condition, "left")
        .withColumn("status", F.when(F.col("_known"), "SKIP").otherwise("NEW"))
        .drop("_known", *[f"_k{i}" for i in range(len(keys))])
    )


def failed_rows(df: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Input rows whose last logged status is an error."""
    last = latest_per_key(log.select(*keys, "run", "status"), keys, "run").filter(F.col("status") == "E")
    return df.join(last.select(*keys), list(keys), "left_semi")
