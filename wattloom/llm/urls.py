"""URL filters: dated list entries as validity intervals, and an as-of join with every capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattloom.llm.common import if_small

#: An address: scheme, user, host, port, then the path up to a query or fragment.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without a last dot; null if there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", ""), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """When each ``pattern`` of a list is active: ``(list, pattern, valid_from, valid_to)``.

    ``entries``: ``(list, pattern, listed_at, active)``; ``active`` false takes
    the pattern off.  An entry holds until the next later one for its list and
    pattern; ``valid_to`` is exclusive and null while nothing follows.  Of
    entries with one time an active one wins.  Rows with a null are left out.
    """
    known = entries.select("list", "pattern", "listed_at", "active").dropna()
    known = known.groupBy("list", "pattern", "listed_at").agg(F.max("active").alias("active"))
    following = W.partitionBy("list", "pattern").orderBy("listed_at")
    return known.withColumn("valid_to", F.lead("listed_at").over(following)).where("active") \
        .select("list", "pattern", F.col("listed_at").alias("valid_from"), "valid_to")


def patterns_of(url: Column) -> Column:
    """Everything a list may have that covers an address: its host, the parent domains, and host with leading folders.

    Domains stand as they are and cover their sub-domains; a pattern with a
    slash, ``host/a/b``, covers the addresses of that host below the folder.
    """
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    folders = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")
    paths = F.transform(F.sequence(F.lit(1), F.greatest(F.size(folders), F.lit(1))),
                        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(folders, F.lit(1), i), "/")))
    return F.when(host.isNotNull(), F.concat(domains, F.when(F.size(folders) > 0, paths).otherwise(F.array().cast("array<string>"))))


def url_filter(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Judge every capture by the list entries active when it was fetched.

    ``captures``: ``(capture_id, url, fetched_at)``.  Returns a row per row of
    ``captures``: ``capture_id``, ``host``, ``n_matches``, ``lists`` (sorted,
    comma-joined), ``since`` (when the oldest of these entries was listed) and
    ``blocked``.

    A capture is reduced to the distinct ``(pattern, fetched_at)`` it asks for;
    captures of one host and time ask once.  These are joined with the
    intervals on the pattern, within which the time decides, and the answers go
    back to the captures by ``(url, fetched_at)``.  A hot host is thus a few
    rows per time; what is left of skew is split by adaptive execution, and
    the intervals are broadcast only below a checked number of rows.

    Captures whose url or time is null, or whose url has no host, match
    nothing.  Repeated captures get equal rows.  Other columns are not read;
    with no entries nothing is blocked.
    """
    captures = captures.select("capture_id", F.col("url").cast("string"), "fetched_at")
    asked = captures.where("fetched_at is not null").select("url", "fetched_at").distinct() \
        .select("url", "fetched_at", F.explode(patterns_of(F.col("url"))).alias("pattern"))
    questions = asked.select("pattern", "fetched_at").distinct()
    valid = if_small(intervals(entries).withColumnRenamed("pattern", "listed"))
    answers = questions.join(valid, (F.col("pattern") == F.col("listed")) & (F.col("fetched_at") >= F.col("valid_from"))
                             & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
    answers = answers.groupBy("pattern", "fetched_at").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("list").alias("lists"), F.min("valid_from").alias("since"))
    per_url = asked.join(answers, ["pattern", "fetched_at"]).groupBy("url", "fetched_at").agg(
        F.sum("n").alias("n_matches"), F.array_distinct(F.flatten(F.collect_set("lists"))).alias("lists"), F.min("since").alias("since"))
    return captures.join(per_url, ["url", "fetched_at"], "left").select(
        "capture_id", host_of(F.col("url")).alias("host"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
        F.array_join(F.sort_array(F.coalesce("lists", F.array().cast("array<string>"))), ",").alias("lists"), "since",
        F.col("n_matches").isNotNull().alias("blocked"))
