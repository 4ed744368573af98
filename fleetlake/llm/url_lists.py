"""URL filters as a temporal list join.

Dated list entries (add and remove) become validity intervals; an as-of join
then gives every capture, for each list entry that matches its URL, the last
interval that began at or before the fetch, and the entry counts if that
interval was still open. The most specific active entry decides.

The as-of join is one global order of intervals and captures by (list, key,
time) in which every capture takes the last interval before it (see
``ordered.last_before``): linear in both sides, and a host or an entry with a
third of all rows is spread over many tasks. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import last_before, placed, running
from .runtime import written

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-cased host without a final dot; null where there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")
    return F.when(host != "", host)


def url_segments(url: Column) -> Column:
    """Path segments that are not empty."""
    return F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")


def entry_key(match: Column, pattern: Column) -> Column:
    """The join key of an entry: its kind and its normalised pattern."""
    p = F.regexp_replace(F.trim(pattern), r"[/.]+$", "")
    host = F.lower(F.regexp_extract(p, r"^([^/]*)", 1))
    return F.concat(match, F.lit(":"), F.when(match == "prefix", F.concat(host, F.regexp_extract(p, r"^[^/]*(.*)$", 1)))
                    .otherwise(host))


def candidate_keys(host: Column, segments: Column, depth: Column, labels: Column) -> Column:
    """Keys that match a URL: its host, its domains (the host included) of at
    most ``labels`` labels, and its path prefixes of at most ``depth`` segments."""
    names = F.split(host, r"\.")
    n = F.size(names)
    domains = F.when(labels > 0, F.transform(F.sequence(F.greatest(n - labels + 1, F.lit(1)), n), lambda i: F.concat(
        F.lit("domain:"), F.array_join(F.slice(names, i, n - i + 1), ".")))).otherwise(F.array().cast("array<string>"))
    most = F.least(F.size(segments), depth)
    prefixes = F.when(most > 0, F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: F.concat(
        F.lit("prefix:"), host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")))).otherwise(
            F.array().cast("array<string>"))
    return F.concat(F.array(F.concat(F.lit("host:"), host)), domains, prefixes)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(list, effect, key, pattern, rank, since, until)`` from dated entries.

    ``entries``: list, effect ('block' or 'allow'), match ('host', 'domain' or
    'prefix'), pattern, action ('add' or 'remove'), at. An added entry holds
    from its date to the next date of the same entry of the same list (null:
    open). Of several changes at one time an addition wins. Rows with a null
    in any of these columns, or another word in them, are ignored.
    """
    ok = (F.col("effect").isin("block", "allow") & F.col("match").isin("host", "domain", "prefix")
          & F.col("action").isin("add", "remove") & F.col("pattern").isNotNull() & F.col("list").isNotNull()
          & F.col("at").isNotNull())
    rows = entries.where(ok).select(
        "list", "effect", "pattern", entry_key(F.col("match"), F.col("pattern")).alias("key"), "at",
        (F.col("action") == "add").alias("adds"))
    # more specific first: prefixes by depth, then hosts, then domains by labels
    size = F.when(F.col("key").startswith("prefix:"), 2_000_000 + F.size(F.split("key", "/")))
    size = size.when(F.col("key").startswith("host:"), 1_000_000).otherwise(F.size(F.split("key", r"\.")))
    order = ["list", "effect", "key", "at", "adds", "pattern"]
    numbered = running(placed(rows.distinct(), order), order, {"at_row": F.lit(1).cast("long")})
    nxt = numbered.select((F.col("at_row") - 1).alias("at_row"), F.col("list").alias("_l"),
                          F.col("effect").alias("_e"), F.col("key").alias("_k"), F.col("at").alias("_at"))
    same = (F.col("list") == F.col("_l")) & (F.col("effect") == F.col("_e")) & (F.col("key") == F.col("_k"))
    out = numbered.join(nxt, "at_row", "left").withColumn("until", F.when(same, F.col("_at")))
    return (out.where("adds AND (until IS NULL OR until > at)")
            .select("list", "effect", "key", "pattern", size.cast("int").alias("rank"),
                    F.col("at").alias("since"), "until"))


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url: str = "url",
          at: str = "fetched_at") -> DataFrame:
    """One row per capture: id, fetch time, ``host``, ``verdict`` and the
    deciding entry (``list``, ``pattern``, ``since``, ``until``).

    ``verdict``: 'blocked' or 'allowed' by the most specific entry that was
    active (of equal ones allow before block, then the list's and the
    pattern's name); 'allowed' where none was; 'invalid' for a null URL or one
    without a host; 'undated' for a null fetch time. Repeated captures are
    judged each. An empty list allows all; an empty table gives an empty
    result.
    """
    intervals = written(validity_intervals(entries), "intervals")
    caps = written(captures.select(
        F.col(id_col).alias("_id"), F.col(at).alias("_at"), url_host(F.col(url)).alias("_host"),
        url_segments(F.col(url)).alias("_segments")).withColumn("_cap", F.monotonically_increasing_id()), "captures")
    # prefixes and domains need be tried only as deep as some entry goes
    deepest = intervals.agg(
        F.coalesce(F.max(F.when(F.col("key").startswith("prefix:"), F.size(F.split("key", "/")) - 1)), F.lit(0)).alias("_depth"),
        F.coalesce(F.max(F.when(F.col("key").startswith("domain:"), F.size(F.split("key", r"\.")))), F.lit(0)).alias("_labels"))
    probes = (caps.where("_host IS NOT NULL AND _at IS NOT NULL").join(F.broadcast(deepest))  # one row
              .select("_cap", F.col("_at").alias("at"),
                      F.explode(candidate_keys(F.col("_host"), F.col("_segments"), F.col("_depth"), F.col("_labels"))).alias("key")))
    known = intervals.select("list", "effect", "key").distinct()
    asked = probes.join(known, "key").select("list", "effect", "key", "at", F.lit(1).alias("turn"), "_cap",
                                             F.lit(None).cast(_entry_type(intervals)).alias("entry"))
    held = intervals.select("list", "effect", "key", F.col("since").alias("at"), F.lit(0).alias("turn"),
                            F.lit(None).cast("long").alias("_cap"),
                            F.struct("list", "effect", "key", "pattern", "rank", "since", "until").alias("entry"))
    order = ["list", "effect", "key", "at", "turn"]
    both = placed(held.unionByName(asked), order)
    seen = last_before(both, order, "entry", "last").where("turn = 1")
    active = ((F.col("last.list") == F.col("list")) & (F.col("last.effect") == F.col("effect"))
              & (F.col("last.key") == F.col("key")) & (F.col("last.until").isNull() | (F.col("last.until") > F.col("at"))))
    best = (seen.where(active)
            .groupBy("_cap").agg(F.min(F.struct((-F.col("last.rank")).alias("r"), "effect", "list",
                                                F.col("last.pattern").alias("pattern"), F.col("last.since").alias("since"),
                                                F.col("last.until").alias("until"))).alias("b")))
    out = caps.join(best, "_cap", "left")
    verdict = (F.when(F.col("_host").isNull(), "invalid").when(F.col("_at").isNull(), "undated")
               .when(F.col("b.effect") == "block", "blocked").otherwise("allowed"))
    return out.select(F.col("_id").alias(id_col), F.col("_at").alias(at), F.col("_host").alias("host"),
                      verdict.alias("verdict"), F.col("b.list").alias("list"), F.col("b.pattern").alias("pattern"),
                      F.col("b.since").alias("since"), F.col("b.until").alias("until"))


def _entry_type(intervals: DataFrame):
    return intervals.select(F.struct("list", "effect", "key", "pattern", "rank", "since", "until").alias("e")).schema["e"].dataType


# ------------------------------------------------------- the driver's tables

def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of the pages table, which has no dates: the fetch minute is
    spread over 2024 by the page's id."""
    minute = F.pmod(F.col("page_id") * 37, F.lit(525600))
    return pages.select("page_id", "url", F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("_0"), minute.alias("_m")).select(
        "page_id", "url", F.expr("_0 + make_dt_interval(0, 0, cast(_m as int), 0)").alias("fetched_at"))


def page_entries(pages: DataFrame) -> DataFrame:
    """Dated lists over what the pages hold, so that they grow with them:
    every host, every parent domain and every first path segment is listed
    for a while, on days given by its number of pages."""
    base = pages.select(url_host(F.col("url")).alias("host"), url_segments(F.col("url")).alias("seg")).where("host IS NOT NULL")
    hosts = base.groupBy("host").agg(F.count("*").alias("n"))
    domains = (hosts.withColumn("pattern", F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)).where("pattern <> ''")
               .groupBy("pattern").agg(F.sum("n").alias("n")))
    firsts = (base.where("size(seg) > 0").select(F.concat("host", F.lit("/"), F.element_at("seg", 1)).alias("pattern"))
              .groupBy("pattern").agg(F.count("*").alias("n")))

    def dated(rows: DataFrame, name: str, effect: str, match: str, first: str, changes: list[tuple[str, int]]) -> DataFrame:
        steps = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(d).alias("after")) for a, d in changes])
        return rows.select("pattern", F.expr(f"cast({first} as int)").alias("day"), F.explode(steps).alias("s")).select(
            F.lit(name).alias("list"), F.lit(effect).alias("effect"), F.lit(match).alias("match"), "pattern",
            "s.action", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(day + s.after)").alias("at"))

    return (dated(hosts.withColumnRenamed("host", "pattern"), "abuse", "block", "host", "(length(pattern) * 13 + n) % 300",
                  [("add", 0), ("remove", 45), ("add", 120)])
            .unionByName(dated(domains, "spam", "block", "domain", "(n * 7) % 200", [("add", 0), ("remove", 60)]))
            .unionByName(dated(firsts, "trusted", "allow", "prefix", "(n * 5) % 330", [("add", 0), ("remove", 90)])))
