"""URL filters by a temporal list join.

List entries are dated decisions on a host or on a domain with all that is below it. Each entry holds from its day until
the pattern's next one, so entries become validity intervals. Every distinct host of the captures is matched with the
patterns among its own name and its parent domains, which gives the host one timeline; the as-of join then evaluates each
capture against the intervals that hold at its fetch day, where the longest pattern decides.

Distinct hosts are gathered with map-side combining, so a host with a third of all captures counts as one row there; the
last join is a plain equality join with the captures on one side and one row for each host on the other, which adaptive
execution splits where a host is hot. Only the id, the URL and the day are read from the captures.

Defined cases: a null URL or one without a host is decided 'none'; a null fetch day matches no interval ('none'); among
entries of one pattern and day, 'block' wins over 'allow'; entries with a null pattern, day or action are ignored;
repeated captures give repeated rows; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: The end of an interval that is still open.
OPEN = "9999-12-31"


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, without user, port and trailing dot; null if there is none.

    Addresses are hosts, too: IPv4 as it stands, IPv6 in its brackets.
    """
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@\[\]]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(found), r"\.+$", ""), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, action, valid_from, valid_to (exclusive) of entries: pattern, action ('block' or 'allow'), listed (a date)."""
    rows = entries.where("pattern IS NOT NULL AND action IS NOT NULL AND listed IS NOT NULL")
    # 'block' sorts after 'allow', so the larger action of a day stays
    rows = rows.groupBy(F.regexp_replace(F.lower("pattern"), r"\.+$", "").alias("pattern"), "listed").agg(F.max("action").alias("action"))
    later = F.lead("listed").over(W.partitionBy("pattern").orderBy("listed"))
    return rows.select("pattern", "action", F.col("listed").alias("valid_from"), F.coalesce(later, F.lit(OPEN).cast("date")).alias("valid_to"))


def host_timelines(hosts: DataFrame, entries: DataFrame) -> DataFrame:
    """host, timeline: for each row of hosts that any pattern covers, the intervals of all of these patterns."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    # an address has no parent domains
    parents = F.when(F.col("host").rlike(r"^(\[.*\]|[0-9]+(\.[0-9]+){3})$"), F.array("host")).otherwise(parents)
    reach = hosts.select("host", F.explode(parents).alias("pattern"))
    held = reach.join(intervals(entries), "pattern")
    step = F.struct(F.length("pattern").alias("level"), "pattern", "action", "valid_from", "valid_to")
    return held.groupBy("host").agg(F.collect_list(step).alias("timeline"))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, host, fetched, decision, pattern, valid_from for captures: page_id, url, fetched (a date)."""
    rows = captures.select("page_id", "url", "fetched", host_of(F.col("url")).alias("host"))
    hosts = rows.where("host IS NOT NULL").select("host").distinct()
    rows = rows.join(host_timelines(hosts, entries), "host", "left")
    holds = F.filter("timeline", lambda e: (e["valid_from"] <= F.col("fetched")) & (F.col("fetched") < e["valid_to"]))
    best = F.array_max(holds)  # the longest pattern; of one pattern at most one interval holds
    return rows.withColumn("best", best).select("page_id", "url", "host", "fetched", F.coalesce("best.action", F.lit("none")).alias("decision"), "best.pattern", "best.valid_from")


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures; as the table has no fetch day, a fixed rule spreads the ids over 366 days."""
    day = F.pmod(F.col("page_id") * F.lit(7919), F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched"))


def rule_entries(pages: DataFrame) -> DataFrame:
    """A list for the tests and the query: for each host and parent domain of the pages, up to three dated entries by rule."""
    labels = F.split("host", r"\.")
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    names = hosts.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("pattern")).distinct()
    digit = lambda at: F.conv(F.substring(F.md5("pattern"), at, 4), 16, 10).cast("int")
    rows = names.select("pattern", F.posexplode(F.array(digit(1), digit(5), digit(9))).alias("k", "v"))
    listed = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("v", F.lit(366)).cast("int"))
    action = F.when(F.pmod(F.col("v") + F.col("k"), F.lit(3)) == 0, "allow").otherwise("block")
    return rows.where(F.pmod(F.col("v"), F.lit(4)) != 0).select("pattern", action.alias("action"), listed.alias("listed"))


ORACLE = r"""
WITH captures AS (
  SELECT page_id, url, nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', ''), '') AS host,
         (DATE '2024-01-01' + ((page_id * 7919) % 366)::INT) AS fetched FROM pages),
hosts AS (SELECT DISTINCT host, string_split(host, '.') AS labels FROM captures WHERE host IS NOT NULL),
names AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(1, len(labels) - 1) + 1), lambda i: array_to_string(labels[i:], '.'))) AS pattern FROM hosts),
entries AS (
  SELECT pattern, CASE WHEN (v + k) % 3 = 0 THEN 'allow' ELSE 'block' END AS action, (DATE '2024-01-01' + (v % 366)::INT) AS listed
  FROM (SELECT pattern, unnest([0, 1, 2]) AS k, ('0x' || substr(md5(pattern), unnest([1, 5, 9]), 4))::INT AS v FROM names) WHERE v % 4 <> 0),
one AS (SELECT pattern, listed, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT pattern, action, listed AS valid_from, coalesce(lead(listed) OVER (PARTITION BY pattern ORDER BY listed), DATE '9999-12-31') AS valid_to FROM one),
reach AS (SELECT host, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS pattern FROM hosts),
held AS (
  SELECT c.page_id, s.pattern, s.action, s.valid_from, row_number() OVER (PARTITION BY c.page_id ORDER BY length(s.pattern) DESC) AS k
  FROM captures c JOIN reach r USING (host) JOIN spans s ON s.pattern = r.pattern AND s.valid_from <= c.fetched AND c.fetched < s.valid_to)
SELECT c.page_id, c.url, c.host, c.fetched, coalesce(h.action, 'none') AS decision, h.pattern, h.valid_from
FROM captures c LEFT JOIN held h ON h.page_id = c.page_id AND h.k = 1
"""
