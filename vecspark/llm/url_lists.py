"""URL filters with dated lists, in DataFrame operations only.

A list is a table of dated events (list, key, action, at): at that time the list began to 'block' or to
'allow' the key, or the key was taken off ('remove').  Keys are hosts, parent domains ("example.com"
covers "www.example.com") and whole normalised URLs ("example.com/a/b").  Events become validity
intervals [since, until): each lasts until the next event of the same list and key.

Every capture (id, url, time) is judged by the entries that are active at its fetch time and match the
URL, its host or a parent domain.  The longest matching key decides (a URL over its host, a host over its
domain); where lists disagree about that key, block wins.

As-of join.  Captures probe with their keys.  Intervals are clipped to the time between the first and the
last capture and cut into epochs of EPOCH_DAYS, so the join is an equi-join on (key, epoch, salt) with an
exact time test.  A key that has more than 1 / HEAVY of all probes in an epoch is hot: its probes are spread
over SALTS tasks, which get a copy of its cut intervals each.  Probes and intervals carry no page content.
Intervals are formed in windows over one day of a key; a second window, over one row per key and day,
links the days, so a key with very many events fills no single task.

Defined cases: a null or hostless URL matches nothing and is allowed; a null time is before all entries;
of events of one list and key at the same time the last of remove, allow, block counts; repeated events
count once; repeated captures are judged each; empty tables give no verdicts or an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecspark.session import materialize

EPOCH_DAYS = 30
SALTS = 16
HEAVY = 1024


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and leading www; empty for none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(raw), r"^www\.", "")


def path_of(url: Column) -> Column:
    """Path without query, fragment and closing slashes."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.rtrim(raw, F.lit("/"))


def normalised_url(url: Column) -> Column:
    return F.concat(host_of(url), path_of(url))


def parent_domains(host: Column) -> Column:
    """The host and all its parents that are at least two labels long, the shortest first."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    counts = F.when(n >= 2, F.sequence(F.lit(2), n)).otherwise(F.array(F.lit(1)))
    suffixes = F.transform(counts, lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(suffixes, F.array(host))))


def intervals(events: DataFrame) -> DataFrame:
    """(list, key, action, since, until) of the dated events; until is null for entries still active.

    Windows are kept to one day of a key; each day learns from a second window, over one row per key and
    day, when the next day with events begins.
    """
    rank = F.when(F.col("action") == "block", 2).when(F.col("action") == "allow", 1).otherwise(0)
    last = events.filter(F.col("at").isNotNull() & F.col("key").isNotNull()).groupBy("list", "key", "at").agg(
        F.max(F.struct(rank.alias("r"), F.col("action"))).alias("m"))
    last = last.select("list", "key", "at", F.col("m.action").alias("action"), F.to_date("at").alias("day"))
    days = last.groupBy("list", "key", "day").agg(F.min("at").alias("first"))
    by_key = Window.partitionBy("list", "key").orderBy("day")
    days = days.select("list", "key", "day", F.lead("first").over(by_key).alias("next_day"))
    in_day = Window.partitionBy("list", "key", "day").orderBy("at")
    linked = last.withColumn("later", F.lead("at").over(in_day)).join(days, ["list", "key", "day"])
    return linked.filter(F.col("action") != "remove").select(
        "list", "key", "action", F.col("at").alias("since"), F.coalesce("later", "next_day").alias("until"))


def _epoch(t: Column) -> Column:
    return F.floor(F.unix_seconds(t) / (EPOCH_DAYS * 86400)).cast("long")


def spread(probes: DataFrame, cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: any of SALTS for the probes of a hot (key, epoch), each of them for its intervals, else 0."""
    total = probes.count()
    hot = probes.groupBy("key", "epoch").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HEAVY > total)
    hot = F.broadcast(materialize(hot.select("key", "epoch", F.lit(True).alias("hot")), "hot-keys"))  # fewer than HEAVY rows
    any_salt, each = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"), F.sequence(F.lit(0), F.lit(SALTS - 1))
    probes = probes.join(hot, ["key", "epoch"], "left").withColumn("salt", F.when(F.col("hot"), any_salt).otherwise(F.lit(0)))
    cut = cut.join(hot, ["key", "epoch"], "left").withColumn(
        "salt", F.explode(F.when(F.col("hot"), each).otherwise(F.array(F.lit(0)))))
    return probes.drop("hot"), cut.drop("hot")


def judge(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url: str = "url", at: str = "fetched_at") -> DataFrame:
    """Every capture's id with verdict ('block' or 'allow'), deciding_key, deciding_list and n_active, the
    number of active entries that match it.  deciding_list is the last by name of the lists that decide."""
    seen = captures.select(F.col(id_col).alias("id"), F.col(at).alias("t"), host_of(F.col(url)).alias("host"),
                           normalised_url(F.col(url)).alias("page"), F.monotonically_increasing_id().alias("row"))
    seen = materialize(seen, "captures")
    first, edge = seen.agg(F.min("t"), F.max("t")).first()
    own = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array("page"))
    probes = seen.filter(F.col("t").isNotNull()).select(
        "row", "t", _epoch(F.col("t")).alias("epoch"),
        F.explode(F.array_distinct(F.concat(own, parent_domains(F.col("host"))))).alias("key"))
    last = F.least(F.coalesce("until", F.lit(edge)), F.lit(edge))
    met = (F.col("since") <= F.lit(edge)) & (F.col("until").isNull() | (F.col("until") > F.lit(first)))
    cut = intervals(events).filter(met).select(
        "*", F.explode(F.sequence(_epoch(F.greatest("since", F.lit(first))), _epoch(last))).alias("epoch"))
    probes, cut = spread(probes, cut)
    active = (F.col("t") >= F.col("since")) & (F.col("until").isNull() | (F.col("t") < F.col("until")))
    hits = probes.join(cut, ["key", "epoch", "salt"]).filter(active)
    best = F.max(F.struct(F.length("key").alias("n"), (F.col("action") == "block").alias("block"), "key", "list"))
    verdicts = hits.groupBy("row").agg(best.alias("best"), F.count(F.lit(1)).alias("n_active"))
    return seen.join(verdicts, "row", "left").select(
        F.col("id").alias(id_col), F.when(F.col("best.block"), "block").otherwise("allow").alias("verdict"),
        F.col("best.key").alias("deciding_key"), F.col("best.list").alias("deciding_list"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"))
