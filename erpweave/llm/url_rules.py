"""URL filter by a sort-merge range join (DataFrame operations only).

A rule is one key: the labels of its host from the right, an end mark, its path. "This path and all below
it" is then a prefix of the key, and a prefix is an interval of the sort order. Rules of one host nest or
lie apart, whatever their number. A page asks once per parent domain: with the key of that domain and its own path.
The rules of a domain that fit are the intervals around that key.

One sweep over starts, ends and asked keys in key order keeps the stack of open rules: its height is the
running sum of starts less ends, and its top is the last start that reached the present height. The top is the
longest fitting rule of the asked domain; a page takes the best of its domains.

The sweep is cut into salted pieces. Each piece holds its share of the pages and all rules, one row per start and
end, and there are so few pieces that rule copies do not outnumber asked keys; a host with a third
of all pages spreads over all pieces, and repeated rows are counted before the sweep. All questions of a page lie in one piece, so
the sweep, its stack and the choice per page take one shuffle together.

Defined results: NULL url or one without ``://`` has empty host and path and the default verdict unless a rule has
the empty host; repeated rows are judged each; an empty page table gives no rows, an empty rule table gives every
page the default. Rules without host or path do not count; of the verdicts of a repeated rule the last by text does.
Of rules of equal length the one with the longer host wins, then by text. Texts are valid UTF-8, as Spark's are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpweave.llm.text import lower_ascii

MARK = "\u0001"  # followed by: 1 end of a label, 2 the character itself, 3 end of the host
LABEL_END, LITERAL, HOST_END = MARK + "\u0001", MARK + "\u0002", MARK + "\u0003"
START, ASKED, END = 0, 1, 2
COPIES = 1024  # repeated rows written back at a time


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and path, query and fragment cut off."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    none = F.lit("")
    return (
        F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), none),
        F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), none),
    )


def labels(host: Column) -> Column:
    """Labels of a host from the right."""
    return F.reverse(F.split(F.replace(host, F.lit(MARK), F.lit(LITERAL)), r"\."))


def interval_key(domain: Column, path: Column) -> Column:
    """Start of the interval of all paths below ``path`` at a domain, given by its labels from the right."""
    ended = F.transform(domain, lambda label: F.concat(label, F.lit(LABEL_END)))
    return F.concat(F.array_join(ended, ""), F.lit(HOST_END), path).cast("binary")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Verdict of the longest fitting rule per page.

    ``pages(page_id, url, ...)``, ``rules(host, path, verdict)``. Returns page_id, host, path, rule, verdict.
    """
    host, path = host_and_path(F.col("url"))
    seen = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .groupBy("page_id", "host", "path").agg(F.count("*").alias("copies"))
    )
    table = rules.dropna(subset=["host", "path"]).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    size = table.agg(F.count("*").alias("n"), F.max(F.size(labels(F.col("host")))).alias("deepest")).first()
    deepest = size["deepest"] or 1
    pieces = max(1, pages.count() // max(2 * size["n"], 1000))

    # The domains a page lies in, no more of them than the deepest rule has labels.
    asked = (
        seen.select("*", labels(F.col("host")).alias("labels"))
        .select("*", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(deepest)))).alias("depth"))
        .select(
            F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(pieces)).cast("int").alias("piece"),
            interval_key(F.slice("labels", 1, F.col("depth")), F.col("path")).alias("key"),
            F.lit(ASKED).alias("kind"), F.lit(0).alias("step"), F.lit(None).cast("struct<length:int,host_length:int,rule:string,verdict:string>").alias("own"),
            "page_id", "host", "path", "copies",
        )
    )
    begin = interval_key(labels(F.col("host")), F.col("path"))
    name = F.concat("host", "path")
    own = F.struct(F.length(name).alias("length"), F.length("host").alias("host_length"), name.alias("rule"), "verdict")
    # No text holds the byte FF: with it appended a prefix sorts behind everything that it begins.
    ends = table.select(
        begin.alias("key"), own.alias("own"),
        F.inline(F.array(F.struct(F.lit(START).alias("kind"), F.lit(1).alias("step")),
                         F.struct(F.lit(END).alias("kind"), F.lit(-1).alias("step")))),
    ).select(
        F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"),
        F.when(F.col("kind") == END, F.concat("key", F.lit(b"\xff"))).otherwise(F.col("key")).alias("key"),
        "kind", "step", F.when(F.col("kind") == START, F.col("own")).alias("own"),
        F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), F.lit(None).cast("long").alias("copies"),
    )
    order = ["key", "kind"]
    sweep = Window.partitionBy("piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("piece", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    top = F.when(F.col("height") > 0, F.last("own", ignorenulls=True).over(level))
    won = (
        ends.unionByName(asked)
        .select("*", F.sum("step").over(sweep).alias("height"))
        .select("*", top.alias("top"))
        .where(F.col("kind") == ASKED)
        .groupBy("piece", "page_id", "host", "path")
        .agg(F.max("top").alias("won"), F.first("copies").alias("copies"))
    )
    each = won.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"), F.lit(COPIES))).alias("first"))
    each = each.select("*", F.explode(F.sequence(F.col("first"), F.least("copies", F.col("first") + COPIES - 1))).alias("copy"))
    return each.select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict")
    )
