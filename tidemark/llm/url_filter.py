"""URL filter by dated lists: every capture is judged by the entries active when it was fetched.

List entries (host suffix, day, action) become validity intervals: an entry holds until the next one of
its suffix. Intervals are laid out by suffix and month, so that a capture meets only those of its own
month, and a suffix with a long history or very many captures is spread over months. Of the suffixes of
a host that have an active entry the longest decides.

Urls are reduced to their host (white space around them, scheme, user, ports and path removed, A-Z
lower-cased, trailing dots dropped); null or hostless urls match nothing. Of entries on one suffix and day the action that comes
last by name counts. Repeated captures are judged each; captures without a day match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import ascii_lower, kept

FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    rest = F.regexp_replace(ascii_lower(url), r"^[\x20\x09-\x0D]*([a-z][a-z0-9+.-]*://)?", "")
    plain = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#\x20\x09-\x0D]*", 0), r"^.*@", "")
    return F.nullif(F.regexp_replace(plain, r"(:[0-9]*|\.)+$", ""), F.lit(""))


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def intervals(entries: DataFrame, until: Column | None = None) -> DataFrame:
    """(suffix, action, valid_from, valid_to) from (suffix, day, action); ``valid_to`` is exclusive."""
    daily = (
        entries.where("suffix IS NOT NULL AND day IS NOT NULL")
        .groupBy("suffix", "day")
        .agg(F.max("action").alias("action"))
    )
    after = F.lead("day").over(Window.partitionBy("suffix").orderBy("day"))
    return daily.select(
        "suffix", "action", F.col("day").alias("valid_from"), F.coalesce(after, until if until is not None else F.lit(FOREVER).cast("date")).alias("valid_to")
    )


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, host, fetched, suffix, valid_from, verdict for (page_id, url, fetched)."""
    rows = captures.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url").cast("string")).alias("host"), "fetched"
    )
    # Only the months from the first fetch to the last are laid out.
    first, last = (F.lit(x).cast("date") for x in captures.agg(F.min("fetched"), F.max("fetched")).first())
    months = F.sequence(_month(F.greatest("valid_from", first)), _month(F.least(F.date_sub("valid_to", 1), last)))
    held = (
        intervals(entries)
        .where((F.col("valid_from") <= last) & (F.col("valid_to") > first))
        .withColumn("month", F.explode(months))
    )
    labels = F.split("host", r"\.")
    # Suffixes of as many labels as some entry has; these numbers are few, whatever the list's length.
    lengths = entries.where("suffix IS NOT NULL").select(F.size(F.split("suffix", r"\.")).alias("n")).distinct().orderBy("n").collect()
    wanted = F.filter(F.array(*[F.lit(r["n"]) for r in lengths]).cast("array<int>"), lambda n: n <= F.size(labels))
    suffixes = F.transform(wanted, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    asked = (
        rows.where("host IS NOT NULL AND fetched IS NOT NULL")
        .groupBy("host", "fetched")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("month", _month(F.col("fetched")))
    )
    hit = (
        asked.join(held, ["suffix", "month"])
        .where("valid_from <= fetched AND fetched < valid_to")
        .groupBy("host", "fetched")
        .agg(F.max_by(F.struct("suffix", "valid_from", "action"), F.length("suffix")).alias("best"))
    )
    return rows.join(hit, ["host", "fetched"], "left").select(
        "page_id", "host", "fetched",
        F.col("best.suffix").alias("suffix"),
        F.col("best.valid_from").alias("valid_from"),
        F.coalesce("best.action", F.lit("unlisted")).alias("verdict"),
    )


# The test tables carry neither fetch days nor lists; both follow from the pages.


def dated_captures(pages: DataFrame) -> DataFrame:
    """A fetch day for every page, by its id."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(1461)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Block and allow entries on hosts and on their parent domains, from each page's id."""
    host = host_of(F.col("url"))
    parent = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.col("page_id") * 104729, F.lit(1461)).cast("int"))
    action = F.when(F.pmod(F.col("page_id"), F.lit(3)) == 0, "allow").otherwise("block")
    return kept(
        pages.where(host.isNotNull()).select(
            F.when(F.pmod(F.col("page_id"), F.lit(5)) == 0, parent).otherwise(host).alias("suffix"), day.alias("day"), action.alias("action")
        ).where("suffix <> ''").distinct(),
        "entries",
    )
