"""URL filters by a temporal join with dated lists.

List entries are dated events: a value is added to a list or removed from it. Consecutive events of one
value make validity intervals, and every capture is judged by the entries that were active when it was
fetched. An interval is filed under each time slice it touches, so captures and intervals meet by an
equality on (value, slice), which Spark may split where a host is hot, and a comparison of times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.operators.sizing import small_rows

SLICE_SECONDS = 30 * 86_400


def url_host(url: Column) -> Column:
    """The lower-case host without user and port; empty if there is none."""
    place = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":[0-9]*$", ""))


def url_path(url: Column) -> Column:
    """The path without query and fragment, starting with a slash or empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")),
                            r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def validity(events: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(list, scope, value, action, since, until): intervals [since, until) of added entries.

    `events` has (list, scope, value, action, at, added), `at` in seconds. An entry holds from its
    addition to the next event of the same list, scope and value, which may end or replace it; `until`
    is null where there is none. Of events at one time the removal comes last, equal events count once,
    and events with a null value, time or flag are left out. A value with very many events is spread
    over time slices; the first event of the next slice closes the last interval of one.
    """
    entry = ["list", "scope", "value"]
    clean = (events.select(*entry, "action", F.col("at").cast("bigint").alias("at"), "added").distinct()
             .filter("value IS NOT NULL AND at IS NOT NULL AND added IS NOT NULL")
             .withColumn("slice", F.expr(f"at div {slice_seconds}")))
    firsts = clean.groupBy(*entry, "slice").agg(F.min("at").alias("first_at"))
    nexts = firsts.withColumn("next_at", F.lead("first_at").over(
        Window.partitionBy(*entry).orderBy("slice"))).select(
        *[F.col(c).alias(f"n_{c}") for c in [*entry, "slice"]], "next_at")
    order = Window.partitionBy(*entry, "slice").orderBy("at", F.desc("added"), "action")
    inside = clean.withColumn("after", F.lead("at").over(order))
    same = None
    for c in [*entry, "slice"]:
        test = inside[c].eqNullSafe(nexts[f"n_{c}"])
        same = test if same is None else same & test
    return (inside.join(nexts, same, "left")
            .withColumn("until", F.coalesce("after", "next_at"))
            .filter("added AND (until IS NULL OR until > at)")
            .select(*entry, "action", F.col("at").alias("since"), "until"))


def candidate_values(host: Column, path: Column, labels: Column, depth: Column) -> Column:
    """(scope, value) structs a URL can be listed under: its host, parent domains and path prefixes.

    Only as many labels and path parts are formed as the longest listed value has.
    """
    parts, folders = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda p: p != "")
    domains = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), labels)),
        lambda n: F.struct(F.lit("domain").alias("scope"), F.array_join(
            F.slice(parts, F.size(parts) - n + 1, n), ".").alias("value")))
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.least(F.size(folders), depth)), lambda n: n > 0),
        lambda n: F.struct(F.lit("prefix").alias("scope"), F.concat(
            host, F.lit("/"), F.array_join(F.slice(folders, 1, n), "/")).alias("value")))
    own = F.array(F.struct(F.lit("host").alias("scope"), host.alias("value")))
    return F.when(host != "", F.concat(own, domains, prefixes)).otherwise(
        F.slice(own, 1, 0))


def _slice_number(at: Column, breaks: list[int], slice_seconds: int) -> Column:
    """How many slices with events begin up to a time: as many numbers as events at most, whatever the times."""
    known = F.expr("array(" + ", ".join(f"{b}L" for b in breaks) + ")" if breaks else "array(0L)")
    before = F.size(F.filter(known, lambda b: b <= F.floor(at / slice_seconds)))
    return F.when(at.isNotNull(), before)


def judge_urls(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url",
               time_col: str = "fetched_at", slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(id, url, fetched_at, action, scope, value, list, kept): one row per capture.

    The most specific active entry decides: a prefix before a host before a domain, then the longer
    value, then the later `since`, then list, action and value in reverse order of the alphabet. A
    capture is kept unless that entry's action is 'block'; without an active entry the four columns are
    null. Captures with a null or hostless URL or a null time match nothing and are kept. Any number is a
    time: one far behind the last event is judged by the lists as that event left them, one before the
    first matches nothing. Repeated captures are judged alike; other columns are not read; with an empty
    list all captures are kept.
    """
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                           F.col(time_col).cast("bigint").alias("fetched_at"))
    intervals = validity(events, slice_seconds)
    # one row of bounds, made from the lists and from the captures' times
    longest = events.agg(
        F.coalesce(F.max(F.when(F.col("scope") == "domain", F.size(F.split("value", r"\.")))),
                   F.lit(1)).alias("labels"),
        F.coalesce(F.max(F.when(F.col("scope") == "prefix", F.size(F.split("value", "/")) - 1)),
                   F.lit(0)).alias("depth")).first()
    once = rows.select("url", "fetched_at").filter("url IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    # the state of the lists changes only in slices that hold an event, so slices are numbered by these
    breaks = sorted(r["slice"] for r in small_rows(
        intervals.select(F.expr(f"since div {slice_seconds}").alias("slice")).distinct(), "slices of list events"))
    asked = once.select(
        "url", "fetched_at", _slice_number(F.col("fetched_at"), breaks, slice_seconds).alias("slice"),
        F.explode(candidate_values(url_host(F.col("url")), url_path(F.col("url")),
                                   F.lit(longest["labels"]), F.lit(longest["depth"]))).alias("c"))
    asked = asked.select("url", "fetched_at", "slice", F.col("c.scope").alias("c_scope"),
                         F.col("c.value").alias("c_value"))
    first = _slice_number(F.col("since"), breaks, slice_seconds)
    final = F.coalesce(_slice_number(F.col("until") - 1, breaks, slice_seconds), F.lit(len(breaks)))
    filed = intervals.withColumn("i_slice", F.explode(F.sequence(first, final)))
    met = asked.join(filed, (F.col("c_scope") == F.col("scope")) & (F.col("c_value") == F.col("value"))
                     & (F.col("slice") == F.col("i_slice")) & (F.col("since") <= F.col("fetched_at"))
                     & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until"))))
    rank = F.when(F.col("scope") == "prefix", 3).when(F.col("scope") == "host", 2).otherwise(1)
    best = met.groupBy("url", "fetched_at").agg(F.max(F.struct(
        rank.alias("rank"), F.length("value").alias("size"), "since", "list", "action",
        "value", "scope")).alias("best"))
    known = best.select(F.col("url").alias("b_url"), F.col("fetched_at").alias("b_at"), "best")
    return rows.join(known, (F.col("url") == F.col("b_url")) & (F.col("fetched_at") == F.col("b_at")),
                     "left").select(
        "id", "url", "fetched_at", F.col("best.action").alias("action"),
        F.col("best.scope").alias("scope"), F.col("best.value").alias("value"),
        F.col("best.list").alias("list"),
        (F.coalesce("best.action", F.lit("")) != "block").alias("kept"))
