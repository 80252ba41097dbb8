"""URL filters: dated list entries become validity intervals, and captures are joined as of their fetch time.

Everything is DataFrame code. An entry blocks a registered domain with all hosts below it, one host, or a path prefix of
a host. Captures are first reduced to distinct pairs of pattern and fetch time, so a host with a third of all captures
meets the list once per fetch time; the verdicts go back by an equal-key join, which can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)"


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def intervals(entries: DataFrame) -> DataFrame:
    """`kind, pattern, category, valid_from, valid_to` from `kind, pattern, category, action, listed_at`.

    `action` is `add` or `remove` (others, and rows with a null, are left out). An entry holds from the day of its
    addition until the next change of the same kind, pattern and category; the last one has no end. On one day a removal
    wins over an addition, and repeated rows count once. Adding again what is listed starts a new interval.
    """
    keys = ["kind", "pattern", "category"]
    known = entries.filter(F.col("action").isin("add", "remove")).dropna(subset=[*keys, "listed_at"])
    changes = known.groupBy(*keys, "listed_at").agg(F.max(F.col("action") == "remove").alias("removed"))
    order = Window.partitionBy(*keys).orderBy("listed_at")  # as many rows as one entry has dates
    return changes.withColumn("valid_to", F.lead("listed_at").over(order)).filter("NOT removed").select(*keys, F.col("listed_at").alias("valid_from"), "valid_to")


def patterns(url: Column, depth: int) -> Column:
    """Every `kind, pattern` that can match a URL, with path prefixes of up to `depth` segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")
    upto = F.least(F.size(parts), F.lit(depth))
    prefixes = F.when(upto > 0, F.transform(F.sequence(F.lit(1), F.greatest(upto, F.lit(1))), lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")).alias("pattern")))).otherwise(F.array().cast("array<struct<kind:string,pattern:string>>"))
    return F.concat(domains, F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern"))), prefixes)


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched") -> DataFrame:
    """All columns of `captures`, then `host, blocked, n_active, kind, pattern, category, active_since`.

    `n_active` counts the entries that match the URL and hold at the fetch time (from `valid_from` on, before
    `valid_to`); the last four describe the one with the longest pattern (ties: by category, then kind), or are null.
    Columns of those names are replaced. A capture without a host or fetch time matches nothing and is not blocked;
    repeated captures get equal verdicts; without entries nothing is blocked.
    """
    made = ["host", "blocked", "n_active", "kind", "pattern", "category", "active_since"]
    captures = captures.drop(*[c for c in captures.columns if c in made])
    held = intervals(entries)
    depth = held.filter("kind = 'prefix'").agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    asked = captures.select(F.col(url).alias("__url"), F.col(at).alias("__at")).filter(host_of(F.col(url)).isNotNull()).dropna().distinct()
    asked = asked.withColumn("p", F.explode(F.array_distinct(patterns(F.col("__url"), depth)))).select("__url", "__at", F.col("p.kind").alias("kind"), F.col("p.pattern").alias("pattern"))
    pairs = asked.select("kind", "pattern", "__at").distinct()
    active = pairs.join(held, ["kind", "pattern"]).filter("valid_from <= __at AND (valid_to IS NULL OR __at < valid_to)")
    rank = F.struct((-F.length("pattern")).alias("short"), "category", "kind", "pattern", F.col("valid_from").alias("since"))
    active = active.groupBy("kind", "pattern", "__at").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("top"))
    verdicts = asked.join(active, ["kind", "pattern", "__at"]).groupBy("__url", "__at").agg(F.sum("n").alias("__n"), F.min("top").alias("__top"))
    joined = captures.join(verdicts, (F.col(url) == F.col("__url")) & (F.col(at) == F.col("__at")), "left")
    return joined.withColumns({
        "host": host_of(F.col(url)), "blocked": F.col("__n").isNotNull(), "n_active": F.coalesce("__n", F.lit(0).cast("long")),
        "kind": F.col("__top.kind"), "pattern": F.col("__top.pattern"), "category": F.col("__top.category"), "active_since": F.col("__top.since"),
    }).drop("__url", "__at", "__n", "__top")
