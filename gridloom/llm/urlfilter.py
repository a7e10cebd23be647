"""URL filters: captures judged by list entries that were active when they were fetched.  DataFrame operations only.

Dated entries of a list become validity intervals: an entry of a pattern holds until the next one of the same
pattern.  Intervals and captures meet by an equi-join on (kind, pattern, month), so a probe sees only the
intervals of its own month; an interval is posted under the months that it touches, up to the last month with
a capture.  Captures are first brought down to distinct (pattern, day) probes, so a host with a third of all
captures costs as many probes as it has days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#\\]*@)?(\[[^\]/?#\\]*\]|[^/?#\\:@\[\]]*)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)/"


def host_of(url: str) -> Column:
    """The host of a url in lower case: what follows the scheme and user data (up to the last @ before the path), without port and dots at its end; an address in brackets whole.  Empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, action, since, until) from dated entries (kind, pattern, action, since); until is null for the newest.

    Of entries of one pattern and day the greatest action by name counts (so ``block`` outweighs ``allow``, and ``remove`` both).
    """
    daily = entries.where("pattern is not null and since is not null").groupBy("kind", "pattern", "since").agg(F.max("action").alias("action"))
    return daily.select("kind", "pattern", "action", "since", F.lead("since").over(W.partitionBy("kind", "pattern").orderBy("since")).alias("until"))


def patterns(captures: DataFrame) -> DataFrame:
    """captures with a column __tests: structs (rank, kind, pattern) of what can be listed, the narrowest first: site section, host, parent domains."""
    host = host_of("url")
    labels = F.split("__host", r"\.")
    parents = F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(labels) - 1)), lambda i: F.struct((i + 1).cast("int").alias("rank"), F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    section = F.struct(F.lit(1).alias("rank"), F.lit("section").alias("kind"), F.concat("__host", F.lit("/"), "__section").alias("pattern"))
    own = F.struct(F.lit(2).alias("rank"), F.lit("domain").alias("kind"), F.col("__host").alias("pattern"))
    tests = F.concat(F.when(F.col("__section") != "", F.array(section)).otherwise(F.array().cast("array<struct<rank:int,kind:string,pattern:string>>")), F.array(own), F.when(F.size(labels) > 2, parents).otherwise(F.array().cast("array<struct<rank:int,kind:string,pattern:string>>")))
    named = captures.withColumns({"__host": F.coalesce(host, F.lit("")), "__section": F.coalesce(F.lower(F.regexp_extract("url", PATH, 1)), F.lit(""))})
    return named.withColumn("__tests", F.when(F.col("__host") != "", tests))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (url, fetched: date, and other columns) with verdict, kind, pattern and listed_since.

    The narrowest pattern with an active entry decides; an active ``remove`` leaves the decision to wider patterns; without
    one the verdict is ``pass``.  A url that is null, empty or has no host, or a capture without a date, is ``pass``.
    Repeated captures are judged alike, each in a row of its own; repeated entries count once.  Entries may be empty.
    """
    named = patterns(captures).withColumn("__day", F.col("fetched").cast("date"))
    # what is judged is (section or host, day), not the capture
    keys = ["__host", "__section", "__day"]
    probes = named.where("__tests is not null and __day is not null").select(*keys, "__tests").dropDuplicates(keys)
    asked = probes.select(*keys, F.inline("__tests")).withColumn("month", F.trunc("__day", "month"))
    unique = asked.select("kind", "pattern", "__day", "month").distinct()
    last = captures.agg(F.max(F.col("fetched").cast("date"))).first()[0]  # one date: no interval need be posted beyond it
    spans = intervals(entries).withColumn("last", F.lit(last).cast("date")).where("since <= last")
    months = F.sequence(F.trunc("since", "month"), F.trunc(F.coalesce(F.date_sub("until", 1), F.greatest("last", "since")), "month"), F.expr("interval 1 month"))
    posted = spans.select("kind", "pattern", "action", "since", "until", F.explode(months).alias("month"))
    active = unique.join(posted, ["kind", "pattern", "month"]).where("since <= __day and (until is null or __day < until) and action <> 'remove'")
    ruled = asked.join(active.select("kind", "pattern", "__day", "action", "since"), ["kind", "pattern", "__day"])
    verdicts = ruled.groupBy(*keys).agg(F.min(F.struct("rank", "kind", "pattern", "action", "since")).alias("__r"))
    out = named.join(verdicts, keys, "left")
    own = [c for c in captures.columns if c not in ("host", "verdict", "kind", "pattern", "listed_since")]  # the result's columns take the place of others of that name
    return out.select(*own, F.col("__host").alias("host"), F.coalesce("__r.action", F.lit("pass")).alias("verdict"), F.col("__r.kind").alias("kind"), F.col("__r.pattern").alias("pattern"), F.col("__r.since").alias("listed_since"))
