"""URL filter by dated lists: entries become validity intervals, and captures meet the entries active when they were fetched.

A pattern is a host (``host:www.a.example``), a domain with all its hosts (``domain:a.example``), or a path prefix of a host
(``path:www.a.example/news/``). Each entry lists or delists a pattern from a day on. Built-in functions only.

Patterns may be listed and delisted many times, and a host may hold a large part of all captures. So entries of one pattern
and day are reduced to one before they are ordered, intervals are cut at the borders of those periods in which captures ask for
their pattern, and the as-of join is by pattern *and* period, evaluated once per distinct URL and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a period.
PERIOD = 16
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)"


def intervals(entries: DataFrame, pattern: str = "pattern", day: str = "day", listed: str = "listed") -> DataFrame:
    """``pattern``, ``since``, ``until`` (the first day no longer included; null: open) of all times a pattern is listed.

    Of several entries of a pattern on one day a listing wins. Entries with a null in any of the three columns are ignored.
    """
    known = entries.select(F.col(pattern).alias("pattern"), F.col(day).try_cast("int").alias("day"), F.col(listed).try_cast("boolean").alias("listed"))
    known = known.where("pattern IS NOT NULL AND day IS NOT NULL AND listed IS NOT NULL")
    daily = known.groupBy("pattern", "day").agg(F.max("listed").alias("listed"))
    following = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    return daily.withColumn("until", following).where("listed").select("pattern", F.col("day").alias("since"), "until")


def patterns(url: Column) -> Column:
    """All patterns that match a URL: its host, the host's domains, the directories of its path. None for a null or odd URL."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    steps = F.split(F.regexp_extract(url, PATH, 1), "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(F.lit("path:"), host, F.array_join(F.slice(steps, 1, i), "/"), F.lit("/")))
    # The last step is a file, not a directory, unless it is empty.
    folders = F.slice(prefixes, 1, F.greatest(F.size(prefixes) - 1, F.lit(0)))
    all_ = F.array_distinct(F.concat(F.array(F.concat(F.lit("host:"), host)), domains, folders))
    return F.when(host != "", all_).otherwise(F.array().cast("array<string>"))


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with ``blocked`` and ``rule``, the most specific pattern (path, host, domain; then the longest) that is listed on the day of the fetch.

    Null or odd URLs, null days and days beyond 32 bits match nothing and are not blocked. Repeated rows are judged alike. An empty
    list blocks nothing. Columns of ``captures`` named ``blocked`` or ``rule`` give way to the verdict.
    """
    spans = intervals(entries)
    when = F.col(day).try_cast("int")
    asked = captures.select(F.col(url).alias("_url"), when.alias("_day")).where("_url IS NOT NULL AND _day IS NOT NULL").distinct()
    keys = asked.select("_url", "_day", F.floor(F.col("_day") / PERIOD).alias("period"), F.explode(patterns(F.col("_url"))).alias("pattern"))
    # However long an interval is, only the periods in which captures ask for its pattern count.
    wanted = keys.select("pattern", "period").distinct()
    reaches = (F.floor(F.col("since") / PERIOD) <= F.col("period")) & (
        F.col("until").isNull() | (F.floor((F.col("until").cast("bigint") - 1) / PERIOD) >= F.col("period")))
    cut = spans.join(wanted, "pattern").where(reaches)
    active = (F.col("since") <= F.col("_day")) & (F.col("until").isNull() | (F.col("_day") < F.col("until")))
    met = keys.join(cut, ["pattern", "period"]).where(active)
    kind = F.substring_index("pattern", ":", 1)
    weight = F.struct(
        F.when(kind == "path", 3).when(kind == "host", 2).otherwise(1).alias("kind"), F.length("pattern").alias("length"), "pattern")
    verdict = met.groupBy("_url", "_day").agg(F.max(weight)["pattern"].alias("rule"))
    own = [F.col(f"c.`{c}`") for c in captures.columns if c not in ("blocked", "rule")]
    same = (F.col(f"c.`{url}`") == F.col("v._url")) & (F.col(f"c.`{day}`").try_cast("int") == F.col("v._day"))
    return captures.alias("c").join(verdict.alias("v"), same, "left").select(*own, F.col("v.rule").isNotNull().alias("blocked"), F.col("v.rule").alias("rule"))
