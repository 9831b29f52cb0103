"""URL filters with history: which list entries were active at fetch time?

Dated list events (key, list, day, action) become validity intervals. A key is
a domain, which covers its subdomains, or a host with a path prefix. Every
capture is evaluated against the entries active on its day: intervals are laid
out per key and month, so that the as-of join is an equality join on (key,
month) with one row at most on the list side; the day is then looked up among
the few intervals of that month. A hot host repeats the capture side only,
which adaptive execution can split.

Defined results: events on one day count as one, and adding wins; an entry
holds from its day on, up to the day of its removal, exclusive; null keys, days
and lists are ignored; captures with a null URL or day match nothing; repeated
captures are returned as often as they came; an empty list matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALLOW = "allow"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def path_parts(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda p: p != "")


def url_keys(url: Column, labels: int, depth: int) -> Column:
    """The host's last 1..``labels`` labels, and the host with 1..``depth``
    leading path parts: all keys that an entry of these sizes can have."""
    host, parts = host_of(url), path_parts(url)
    names = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))), lambda k: F.array_join(F.slice(names, -k, k), "."))
    some = F.least(F.size(parts), F.lit(depth))
    paths = F.when(some > 0, F.transform(F.sequence(F.lit(1), F.greatest(some, F.lit(1))), lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), k), "/"))))
    return F.when(host != "", F.array_distinct(F.concat(domains, F.coalesce(paths, F.array().cast("array<string>")))))


def entry_key(key: Column) -> Column:
    """The key with its host in lower case; the case of a path matters."""
    host = F.substring_index(key, "/", 1)
    return F.concat(F.lower(host), F.substring(key, F.char_length(host) + 1, F.char_length(key)))


def validity_intervals(events: DataFrame) -> DataFrame:
    """key, list, valid_from, valid_to (null: still valid) from dated events."""
    daily = events.select(entry_key(F.col("key")).alias("key"), "list", F.col("day").cast("date").alias("day"), (F.col("action") == "add").alias("on")).where("key is not null and list is not null and day is not null and on is not null")
    daily = daily.groupBy("key", "list", "day").agg(F.max("on").alias("on"))
    w = Window.partitionBy("key", "list").orderBy("day")
    changes = daily.withColumn("before", F.coalesce(F.lag("on").over(w), F.lit(False))).where("on <> before")
    return changes.withColumn("valid_to", F.lead("day").over(w)).where("on").select("key", "list", F.col("day").alias("valid_from"), "valid_to")


def by_month(intervals: DataFrame, last_day) -> DataFrame:
    """key, month and the intervals that touch the month: as many as lists and
    days in a month at most."""
    ends = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last_day)), F.lit(last_day))
    months = F.sequence(F.trunc("valid_from", "MM"), F.trunc(ends, "MM"), F.expr("interval 1 month"))
    rows = intervals.where(F.col("valid_from") <= F.lit(last_day)).withColumn("month", F.explode(months))
    return rows.groupBy("key", "month").agg(F.collect_list(F.struct("list", "valid_from", "valid_to")).alias("entries"))


def evaluate(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``captures`` has capture_id, url and day. Returns capture_id, day,
    n_active (entries), lists (sorted, comma-joined) and blocked: some list
    matches and none is the allow list."""
    from .common import written

    once = captures.groupBy("capture_id", "url", F.col("day").cast("date").alias("day")).agg(F.count("*").alias("copies"))
    intervals = written(validity_intervals(events), "intervals")
    sizes = intervals.agg(F.max(F.size(F.split(F.substring_index("key", "/", 1), r"\."))), F.max(F.size(F.split("key", "/")) - 1)).first()
    last = captures.agg(F.max(F.col("day").cast("date"))).first()[0]
    listed = by_month(intervals, last)
    wanted = once.withColumn("key", F.explode(url_keys(F.col("url"), sizes[0] or 1, sizes[1] or 0))).withColumn("month", F.trunc("day", "MM"))
    active = F.filter("entries", lambda e: (e["valid_from"] <= F.col("day")) & (e["valid_to"].isNull() | (e["valid_to"] > F.col("day"))))
    hits = wanted.join(listed, ["key", "month"]).select("capture_id", "url", "day", active.alias("active")).where(F.size("active") > 0)
    found = hits.groupBy("capture_id", "url", "day").agg(F.sum(F.size("active")).alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("active.list")))).alias("lists"))
    found = found.toDF("f_capture", "f_url", "f_day", "n", "lists")
    same = F.col("capture_id").eqNullSafe(F.col("f_capture")) & F.col("url").eqNullSafe(F.col("f_url")) & F.col("day").eqNullSafe(F.col("f_day"))
    out = once.join(found, same, "left").select(
        "capture_id", "day", F.coalesce("n", F.lit(0)).cast("long").alias("n_active"), F.coalesce(F.array_join("lists", ","), F.lit("")).alias("lists"),
        F.coalesce((F.size("lists") > 0) & ~F.array_contains("lists", ALLOW), F.lit(False)).alias("blocked"), "copies",
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")
