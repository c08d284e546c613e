"""Operator 8: URL filters as a temporal list join.

Dated list entries (pattern, day, action) become validity intervals: an entry
is in force from its day until the next entry of the same pattern; of several
on one day the last (largest ``seq``) counts.  Each capture is looked up as of
its fetch day under its patterns -- every domain that its host lies in (the host
from any of its labels on; an IPv4 address only whole), host, host with first
path segment -- and the most specific pattern with an entry in force decides.
Domains of more labels than any entry has are not asked for.

The as-of join sorts, for each pattern, its intervals and the distinct fetch
days of its captures, and carries the last interval on.  Both are reduced to
one row for a (pattern, day) before they move, so a host that has a third of
all captures and entries is a few rows for each day.  The domains of a host are
asked for once for each day of the host; captures then meet the verdict on their
host and section by (host, day) and (section, day), spread over salts.

Nulls: a capture without URL, host or day, and an entry without pattern or day,
match nothing; the capture stays, not blocked.  Repeated rows get the same
result each; other columns are not read.  URLs of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm.shared import salted_join

IPV4 = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+\.?$"


def url_patterns(url: Column) -> dict[str, Column]:
    """The host of a URL, and the host with the first path segment."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+?)\.?(?:[/?#:]|$)", 1)), F.lit(""))
    path = F.regexp_extract(url, r"^[^:]+://[^/?#]+(/[^/?#]*)", 1)
    return {"host": host, "section": F.concat(host, path)}


def entry_pattern(pattern: Column) -> Column:
    """An entry as hosts and sections are written: host in lower case, without
    port and final dot; the path as it is."""
    host = F.lower(F.regexp_extract(pattern, r"^([^/:]*?)\.?(?::[0-9]*)?(?:/|$)", 1))
    return F.concat(host, F.regexp_extract(pattern, r"(/.*)$", 1))


def domains(host: Column, most: Column) -> Column:
    """The host and the domains it lies in, of at most ``most`` labels."""
    labels = F.split(F.regexp_replace(host, r"\.$", ""), r"\.")
    of = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), most)), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    return F.array_union(F.array(host), F.when(host.rlike(IPV4) | (most < 1), F.array(host)).otherwise(of))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, since, until, action) of entries (pattern, day, seq, action)."""
    daily = entries.where("pattern is not null and day is not null").groupBy("pattern", "day").agg(
        F.max(F.struct("seq", "action")).alias("last"))
    after = Window.partitionBy("pattern").orderBy("day")  # one row a day
    return daily.select("pattern", F.col("day").alias("since"), F.lead("day").over(after).alias("until"), F.col("last.action").alias("action"))


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "day") -> DataFrame:
    """(page_id, day, blocked, rule, listed_on) of every capture; rule is the
    entry's pattern as ``entry_pattern`` writes it."""
    names = url_patterns(F.col("url"))
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(day_col).alias("day")).select(
        "page_id", "day", *[x.alias(k) for k, x in names.items()])
    entries = entries.withColumn("pattern", entry_pattern(F.col("pattern")))
    deepest = entries.where("pattern is not null and day is not null and not contains(pattern, '/')").agg(
        F.coalesce(F.max(F.size(F.split("pattern", r"\."))), F.lit(0)).alias("most"))  # one row
    hosts = rows.where("host is not null and day is not null").select("host", "day").distinct().withColumn("most", deepest.scalar())
    probes = hosts.select("host", "day", F.explode(domains(F.col("host"), F.col("most"))).alias("pattern"))
    sections = rows.where("section is not null and day is not null").select(F.col("section").alias("pattern"), "day")
    asked = probes.select("pattern", "day").union(sections).distinct()
    spans = intervals(entries).withColumn("entry", F.struct("since", "until", "action"))
    upto = Window.partitionBy("pattern").orderBy("day", F.col("entry").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    events = spans.select("pattern", F.col("since").alias("day"), "entry").unionByName(
        asked.withColumn("entry", F.lit(None).cast(spans.schema["entry"].dataType)))
    verdicts = (
        events.withColumn("in_force", F.last("entry", ignorenulls=True).over(upto)).where("entry is null and in_force is not null")
        .select("pattern", "day", F.col("in_force.action").alias("action"), F.col("in_force.since").alias("since"))
    )
    found = verdicts.select("pattern", "day", F.struct(F.col("pattern").alias("rule"), "action", "since").alias("v"))
    longest = salted_join(probes, found, ["pattern", "day"], "inner").groupBy("host", "day").agg(F.max_by("v", F.length("pattern")).alias("v_host"))
    rows = salted_join(rows, longest, ["host", "day"])
    rows = salted_join(rows, found.select(F.col("pattern").alias("section"), "day", F.col("v").alias("v_section")), ["section", "day"])
    return rows.withColumn("v", F.coalesce("v_section", "v_host")).select(
        "page_id", "day", F.coalesce(F.col("v.action") == "block", F.lit(False)).alias("blocked"),
        F.col("v.rule").alias("rule"), F.col("v.since").alias("listed_on"))
