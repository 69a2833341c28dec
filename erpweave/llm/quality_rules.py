"""Quality rules by weak supervision (DataFrame operations only; EM runs on pattern counts).

Every rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of
vote patterns estimates each rule's accuracy and the share of good documents; the posterior
probability of "good" given all votes replaces an all-must-pass filter. The patterns are at most
3 ** rules rows whatever the corpus, which bounds what reaches the driver; the posterior is a sum of
log odds per vote, a plain expression over the measured columns.

Measures come from one pass over the whole texts; nothing is shuffled but the pattern counts.
Repeated 8-word windows are found inside a row: window hashes, a distinct count that settles most
rows, and a sort for the others.

Defined results: NULL and blank texts have no words, fail the base rules and are not kept;
repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.text import let, packed, words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""

    def repeated(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        same = lambda s, k: (
            (F.when(k > 0, ordered[k - 1]["h"] == s["h"]).otherwise(False))
            | (F.when(k < last, ordered[k + 1]["h"] == s["h"]).otherwise(False))
        )
        places = F.sort_array(F.transform(F.filter(ordered, same), lambda s: s["at"]))
        start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
        step = lambda acc, at: F.struct(
            (acc["total"] + at + WINDOW - F.greatest(at, acc["end"])).alias("total"), (at + WINDOW).alias("end")
        )
        return F.aggregate(places, start, step, lambda acc: acc["total"])

    ordered = F.sort_array(F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(ordered, repeated))


def repeat_words(tokens: Column) -> Column:
    """Words in 8-word windows found twice or more in the text, the first ones included."""

    def windows(w: Column) -> Column:
        starts = F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))
        return F.transform(starts, lambda first, i: F.xxhash64(first, *[w[i + k] for k in range(1, WINDOW)]))

    return let(tokens, lambda w: let(windows(w), _covered)).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """What the rules look at, per text."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_upper": F.regexp_count(text, F.lit(r"[A-Z]{2,}")).cast("long"),
        "n_marks": F.regexp_count(text, F.lit(r"!!|\?\?")).cast("long"),
        # Words of letters, at most the first one upper case, with at most one stop behind.
        "n_plain": F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])\p{L}\p{Ll}*+[.,;:]?+(?![^\x20\x09-\x0D])")).cast("long"),
        "n_pipes": F.regexp_count(text, F.lit(r" \| ")).cast("long"),
        "n_lines": let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"))),
    }


def votes() -> dict[str, Column]:
    """Rules over the measured columns: 1 good, -1 bad, 0 abstain.

    Each kind of junk has a rule that only votes bad; being free of one kind is no vote for good.
    """
    per = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))

    def bad(when: Column) -> Column:
        return F.when(when, -1).otherwise(0)

    lines = F.greatest(F.col("n_lines"), F.lit(1))
    # Short texts need more different words: the share falls with the length in any language.
    monotone = per("n_distinct") < F.when(F.col("n_words") < 500, 0.3).otherwise(0.15)
    return {
        "prose": F.when(per("n_plain") < 0.6, -1).when((per("n_plain") > 0.85) & ~monotone, 1).otherwise(0),
        "symbols": bad(per("n_symbols") > 0.25),
        "pipes": bad(per("n_pipes") > 0.15),
        "shouting": bad(per("n_upper") > 0.3),
        "marks": bad(per("n_marks") > 0.2),
        "lines": bad(F.col("n_dup_lines") / lines > 0.3),
        "repeats": bad(per("n_repeat_words") > 0.2),
        "variety": bad(monotone),
        "shape": bad((per("word_chars") > 16) | (per("word_chars") < 2.0)),
    }


def measured(docs: DataFrame) -> DataFrame:
    """doc_id with all measures of its text."""
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    split = packed(docs).select(
        F.col("_row.doc_id").alias("doc_id"), words(text).alias("w"),
        *[c.alias(name) for name, c in measures(text).items()],
    )
    return split.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"), repeat_words(F.col("w")).alias("n_repeat_words"),
        "n_symbols", "n_plain", "n_upper", "n_marks", "n_pipes",
        F.col("n_lines.all").alias("n_lines"), F.col("n_lines.again").alias("n_dup_lines"),
    )


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """EM for rules that are right with an own probability when they vote; abstaining says nothing.

    Returns the log odds of the prior and of each rule's accuracy. Accuracies start from the majority, carry a
    weak prior and stay above one half, which fixes the meaning of the two classes.
    """
    total = counts.sum()
    pseudo = 1.0 + 0.0005 * total
    balance = patterns.sum(axis=1)
    good = 1.0 / (1.0 + np.exp(-(1.0 + 2.0 * balance)))
    for _ in range(rounds):
        prior = np.clip(((good * counts).sum() + 1.0) / (total + 2.0), 0.05, 0.95)
        right = np.where(patterns == 1, good[:, None], np.where(patterns == -1, 1.0 - good[:, None], 0.0))
        fired = (patterns != 0) * counts[:, None]
        accuracy = ((right * counts[:, None]).sum(axis=0) + 0.8 * pseudo) / (fired.sum(axis=0) + pseudo)
        weights = np.log(np.clip(accuracy, 0.55, 0.99) / (1.0 - np.clip(accuracy, 0.55, 0.99)))
        bias = np.log(prior / (1.0 - prior))
        fresh = 1.0 / (1.0 + np.exp(-(bias + patterns @ weights)))
        done = np.abs(fresh - good).max() < 1e-9
        good = fresh
        if done:
            break
    return float(bias), weights


def log_odds(bias: float, weights: np.ndarray, rules: Mapping[str, Column]) -> Column:
    return sum((v * float(weights[i]) for i, v in enumerate(rules.values())), F.lit(bias))


def judge(measures_table: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Base verdict, posterior probability and decision for rows of ``measured`` (stored by the caller)."""
    rules = votes()
    counted = (
        measures_table.select(*[v.alias(name) for name, v in rules.items()])
        .groupBy(*rules).agg(F.count("*").alias("n")).toPandas()
    )
    if len(counted):
        bias, weights = fit(counted[list(rules)].to_numpy(), counted["n"].to_numpy(float))
    else:
        bias, weights = 0.0, np.zeros(len(rules))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    quality = 1.0 / (1.0 + F.exp(-log_odds(bias, weights, rules)))
    return measures_table.select("*", failed.alias("base_failed"), quality.alias("quality")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )
