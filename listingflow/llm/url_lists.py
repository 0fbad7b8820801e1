"""URL lists with dates, joined as of the time each page was fetched.

A list is a log: an entry was added or removed at a time. Per entry the log becomes validity intervals
[since, until). Entries are domains (which cover their subdomains), hosts, or prefixes of host and path up to a slash.
A capture has a few keys, one per suffix of its host and per directory of its path that is as deep as some entry, and is
listed if an entry with one of them was valid when it was fetched. Of several the most specific counts: the longest prefix, then the host,
then the longest domain.

The join is an equality on key and month with the interval as a condition: intervals are laid out over the months in
which anything was fetched, so a key with a long history or a third of all captures is spread over its months, and a
capture meets the few intervals of its own month instead of all. Captures travel as keys only; the page itself is
not shuffled.

Defined cases: a null URL, or one without a host, has no keys and is not listed; neither is a capture without time.
Events without entry or time are left out. Long URLs and hosts are taken whole. Of events of an entry at the same time a removal counts, then the entry
stays off until it is added again; repeated events change nothing. Captures are judged row by row, repeated or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import materialize

KINDS = ("prefix", "host", "domain")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def intervals(events: DataFrame) -> DataFrame:
    """(kind, entry, since, until) from events (kind, entry, action, at); ``until`` is null while the entry holds."""
    order = Window.partitionBy("kind", "entry").orderBy("at")
    steps = (
        events.where("entry is not null and at is not null and kind is not null")
        .groupBy("kind", "entry", "at").agg(F.max(F.col("action") == "remove").alias("removed"))
        .withColumn("_before", F.lag("removed").over(order))
        .where("_before is null or _before <> removed")
        .withColumn("until", F.lead("at").over(order))
    )
    return steps.where("not removed").select("kind", "entry", F.col("at").alias("since"), "until")


def depths(events: DataFrame) -> tuple[Column, Column]:
    """The numbers of labels that listed domains have, and the numbers of slashes of listed prefixes.

    A list of n bytes has at most about the square root of 2 n different ones, since each needs an entry of its length.
    """
    entry = F.col("entry")
    number = F.when(F.col("kind") == "domain", F.size(F.split(entry, r"\."))).otherwise(F.size(F.split(entry, "/")) - 1)
    found = events.where("entry is not null and kind in ('domain', 'prefix')").groupBy("kind").agg(
        F.collect_set(number).alias("numbers")).collect()
    by_kind = {row["kind"]: sorted(row["numbers"]) for row in found}
    return tuple(F.lit(by_kind.get(kind, [])).cast("array<int>") for kind in ("domain", "prefix"))


def keys_of(host: Column, path: Column, labels_listed: Column, slashes_listed: Column) -> Column:
    """Array of (kind, entry) under which a capture may be listed.

    Only suffixes and directories as deep as some entry are spelled out, so a long URL costs its length for each of these
    depths and not for each of its own.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    some = F.filter(labels_listed, lambda i: i <= n)
    domains = F.transform(some, lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, n - i + 1, i), ".").alias("entry")))
    parts = F.split(path, "/")
    directories = F.filter(slashes_listed, lambda i: (i >= 1) & (i < F.size(parts)))
    prefixes = F.transform(directories, lambda i: F.struct(
        F.lit("prefix").alias("kind"),
        F.concat(host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")).alias("entry")))
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("entry")))
    return F.when(F.length(host) > 0, F.concat(own, domains, prefixes))


def listed(captures: DataFrame, events: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with host, listed, kind, entry and since of the entry that holds; ``fetched`` is a date or time."""
    added = ("host", "listed", "kind", "entry", "since")
    kept = [c for c in captures.columns if c not in added]
    narrow = materialize(
        captures.select(*kept, host_of(captures[url]).alias("host"), F.monotonically_increasing_id().alias("_row")),
        "captures",
    )
    wanted = narrow.where(F.col(fetched).isNotNull()).select(
        "_row", F.col(fetched).alias("_at"), F.trunc(fetched, "month").alias("_month"),
        F.explode(keys_of(F.col("host"), path_of(F.col(url)), *depths(events))).alias("_key"),
    ).select("_row", "_at", "_month", F.col("_key.kind").alias("kind"), F.col("_key.entry").alias("entry"))
    span = narrow.agg(F.trunc(F.min(fetched), "month").alias("low"), F.trunc(F.max(fetched), "month").alias("high")).first()
    low, high = F.lit(span["low"]).cast("date"), F.lit(span["high"]).cast("date")
    first = F.greatest(F.trunc("since", "month"), low)
    last = F.least(F.trunc(F.coalesce(F.col("until"), high), "month"), high)
    spread = (
        intervals(events).where(first <= last)
        .select("*", F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_month"))
    )
    spread = materialize(spread, "list-intervals")
    rank = F.when(F.col("kind") == "prefix", 0).when(F.col("kind") == "host", 1).otherwise(2)
    best = (
        wanted.join(spread, ["kind", "entry", "_month"])
        .where((F.col("since") <= F.col("_at")) & (F.col("until").isNull() | (F.col("_at") < F.col("until"))))
        .groupBy("_row")
        .agg(F.min(F.struct(rank.alias("rank"), (-F.length("entry")).alias("short"), "entry", "kind", "since")).alias("_best"))
        .withColumnRenamed("_row", "_hit")
    )
    return narrow.join(best, F.col("_row") == F.col("_hit"), "left").select(
        *kept, "host",
        F.col("_best").isNotNull().alias("listed"), F.col("_best.kind").alias("kind"),
        F.col("_best.entry").alias("entry"), F.col("_best.since").alias("since"),
    )
