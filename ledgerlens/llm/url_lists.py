"""URL filters: a temporal join of captures with dated list entries.

Lists change: an entry is added on a day and removed on a later one, perhaps
several times.  The dated events of an entry become validity intervals, from a
day (included) to the next event of the entry (excluded).  A capture is judged
by the entries that were active on the day it was fetched, as of then, not by
the lists of today.

Entries are domains, with all hosts below them, or path prefixes of a host.
A capture has one key for each suffix of its host and each prefix of its path,
as an entry might be written, so the join is an equality on key and month; an
interval is cut at month boundaries.  That bounds the intervals that meet the
captures of one key, however often an entry changes and however many captures
a host has.  All steps are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import common


def host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots; '' if there is none."""
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.*(?::[0-9]*)?(?:[/?#]|$)", 1)


def path(url: Column) -> Column:
    """The path from its first slash, without query and fragment; '/' if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(found == "", "/").otherwise(found)


def intervals(events: DataFrame) -> DataFrame:
    """Events (list, kind, pattern, action, day) to intervals (list, kind,
    pattern, valid_from, valid_to); ``valid_to`` is null while active.

    ``action`` is 'add' or 'remove'; other events, and those without a
    pattern or day, are ignored.  Of an add and a remove on one day the remove
    counts.  Repeated adds extend nothing; a remove without an add is nothing.
    """
    days = (events.where(F.col("action").isin("add", "remove") & F.col("pattern").isNotNull() & F.col("day").isNotNull())
            .groupBy("list", "kind", "pattern", "day")
            .agg(F.max((F.col("action") == "remove").cast("int")).alias("removed")))
    w = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    turns = (days.withColumn("before", F.lag("removed", 1, 1).over(w)).where(F.col("before") != F.col("removed")))
    return (turns.withColumn("valid_to", F.lead("day").over(w)).where(F.col("removed") == 0)
            .select("list", "kind", "pattern", F.col("day").alias("valid_from"), "valid_to"))


def keys(captures: DataFrame) -> DataFrame:
    """One row per capture and key: the suffixes of its host as domains, the
    prefixes of its path, each ending with a slash or whole, below its host."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split("path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1),
                           lambda i: F.concat("host", F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
    whole = F.array(F.concat("host", "path"))
    both = F.concat(F.transform(suffixes, lambda s: F.struct(F.lit("domain").alias("kind"), s.alias("pattern"))),
                    F.transform(F.array_distinct(F.concat(prefixes, whole)),
                                lambda s: F.struct(F.lit("prefix").alias("kind"), s.alias("pattern"))))
    return (captures.where("host != ''").select("capture", "fetch_day", F.explode(both).alias("k"))
            .select("capture", "fetch_day", "k.kind", "k.pattern"))


def judge(captures: DataFrame, events: DataFrame, block: str = "block", allow: str = "allow") -> DataFrame:
    """One row per row of ``captures`` (id, url, fetch_day): id, host,
    fetch_day, n_active (entries that apply), blocked, decided_by, valid_from.

    The most specific active entry decides: a prefix before a domain, then
    the longer pattern, then the allow list.  A null or odd URL has host ''
    and, like a null day, no entry; without one nothing is blocked.  Repeated
    captures are judged one by one; clashing names cannot arise, as columns
    are chosen by name.  Empty tables give empty results, or unblocked rows.
    """
    rows = common.written(captures.select("id", host(F.coalesce("url", F.lit(""))).alias("host"),
                                          path(F.coalesce("url", F.lit(""))).alias("path"), "fetch_day",
                                          F.monotonically_increasing_id().alias("capture")), "captures")
    span = rows.agg(F.max(F.trunc("fetch_day", "month")).alias("last"), F.min(F.trunc("fetch_day", "month")).alias("first"))
    low, high = span.select("first", "last").first()
    if low is None:
        high = low = F.to_date(F.lit("1970-01-01"))
    else:
        low, high = F.lit(low), F.lit(high)
    valid = intervals(events)
    begin = F.greatest(F.trunc("valid_from", "month"), low)
    end = F.least(F.trunc(F.coalesce(F.date_sub("valid_to", 1), high), "month"), high)
    cut = (valid.where(begin <= end)
           .select("*", F.explode(F.sequence(begin, end, F.expr("INTERVAL 1 MONTH"))).alias("month")))
    asked = keys(rows).withColumn("month", F.trunc("fetch_day", "month"))
    met = (asked.join(cut, ["kind", "pattern", "month"])
           .where((F.col("fetch_day") >= F.col("valid_from"))
                  & (F.col("valid_to").isNull() | (F.col("fetch_day") < F.col("valid_to")))))
    rank = F.struct((F.col("kind") == "prefix").cast("int").alias("a"), F.length("pattern").alias("b"),
                    (F.col("list") == allow).cast("int").alias("c"), F.col("pattern"), F.col("list"), F.col("valid_from"))
    best = met.groupBy("capture").agg(F.count(F.lit(1)).alias("n_active"), F.max(rank).alias("best"))
    return (rows.join(best, "capture", "left")
            .select("id", "host", "fetch_day", F.coalesce("n_active", F.lit(0)).alias("n_active"),
                    F.coalesce(F.col("best.list") == block, F.lit(False)).alias("blocked"),
                    F.concat_ws(":", "best.list", "best.pattern").alias("decided_by"),
                    F.col("best.valid_from").alias("valid_from")))
