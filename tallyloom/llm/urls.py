"""URL filters: a sort-merge range join of URLs with host and path rules.

A host is turned round (``www.example.com`` becomes ``com.example.www.``), so that a rule's host with all its subdomains
is one interval of keys, and the intervals of two rules are either nested or apart. Each rule opens its interval at its
own key and closes it right after the last key that it covers. The URLs and these events, sorted by key, are swept once:
the stack of rules that are open at a URL is the stack that the last event before it left behind. The rule that wins is
the longest on that stack whose path the URL's path starts with.

The URL rows are dealt to slices by a hash of the URL and the columns that are kept (an id among them spreads even one hot
URL), so a hot host is spread over all slices; the events, of which there are two for each rule, go to every slice. A URL is shuffled once, without its page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The letters that a host is lower-cased in.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Sorts after every key that starts with the same host, as it is larger than any byte of a UTF-8 text.
AFTER = b"\xff"

RULES = T.StructType(
    [
        T.StructField("verdict", T.StringType(), False),
        T.StructField("host", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
    ]
)


def host_of(url: Column) -> Column:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels turned round, each followed by a dot, as bytes, so that the order is that of bytes."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")).cast("binary")


def rule_events(rules: DataFrame) -> DataFrame:
    """Two rows for each host that has rules: ``key`` and the ``stack`` of rules that are open from that key on.

    The stack of a host holds its own rules and those of the hosts above it, found by joining each of its suffixes with the
    hosts; a host has one suffix for each of its labels.
    """
    rules = rules.select(
        "verdict", F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path")
    ).where("host is not null and verdict is not null")
    own = rules.groupBy("host").agg(
        F.collect_set(
            F.struct(
                F.length(F.concat("host", "path")).alias("size"),
                F.concat("host", "path").alias("rule"),
                "path",
                "verdict",
            )
        ).alias("rules")
    )
    labels = F.split("host", r"\.")
    above = own.select("host", F.posexplode(labels).alias("depth", "label")).select(
        "host", "depth", F.array_join(F.slice(labels, F.col("depth") + 1, F.size(labels)), ".").alias("suffix")
    )
    chain = (
        above.join(own.select(F.col("host").alias("suffix"), "rules"), "suffix")
        .groupBy("host")
        .agg(
            F.flatten(F.collect_list("rules")).alias("inside"),
            F.flatten(F.collect_list(F.when(F.col("depth") > 0, F.col("rules")))).alias("outside"),
        )
    )
    key = host_key(F.col("host"))
    opened = chain.select(key.alias("key"), F.col("inside").alias("stack"))
    closed = chain.select(F.concat(key, F.lit(AFTER)).alias("key"), F.col("outside").alias("stack"))
    return opened.unionByName(closed)


def match_rules(
    pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = (), default: str = "allow", slices: int | None = None
) -> DataFrame:
    """Each row of ``pages`` with ``host``, ``path``, the ``rule`` that decides and its ``verdict``.

    ``keep`` names the columns of ``pages`` to hand on; they may not be called like the four. A URL that no rule fits has a
    null rule and the ``default`` verdict, as has a null or malformed one. Of two rules of equal length the smaller text
    wins, of two equal rules the smaller verdict. Repeated rows stay repeated; no rules or no pages give no matches.
    """
    slices = slices or 4 * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.xxhash64(F.col(url), *[F.col(c) for c in keep])
    urls = pages.select(
        *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.pmod(row, F.lit(slices)).cast("int").alias("slice"),
    ).withColumns({"key": host_key(F.col("host")), "is_url": F.lit(1)})
    events = (
        rule_events(rules)
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        .withColumn("is_url", F.lit(0))
    )
    swept = urls.unionByName(events, allowMissingColumns=True).withColumn(
        "open",
        F.last("stack", ignorenulls=True).over(
            Window.partitionBy("slice").orderBy("key", "is_url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    fitting = F.filter("open", lambda rule: F.col("path").startswith(rule["path"]))
    best = F.sort_array(
        F.transform(
            fitting,
            lambda rule: F.struct((-rule["size"]).alias("order"), rule["rule"].alias("rule"), rule["verdict"].alias("verdict")),
        )
    )
    chosen = F.when(F.size(best) > 0, F.element_at(best, 1))
    return (
        swept.where("is_url = 1")
        .withColumn("chosen", chosen)
        .select(
            *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
            "host",
            "path",
            F.col("chosen.rule").alias("rule"),
            F.coalesce("chosen.verdict", F.lit(default)).alias("verdict"),
        )
    )
