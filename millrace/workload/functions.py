"""Column functions and series over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import (
    add_units,
    count_units,
    haversine_distance,
    radians_of,
    safe_add,
    safe_cast,
    safe_divide,
    safe_subtract,
    slugify,
    surrogate_key,
    text_of,
    truncate_to,
    url_host,
    url_parameter,
    url_path,
    width_bucket,
)
from millrace.sources.series import date_spine, number_series
from millrace.workload.registry import query


@query("surrogate_key_nulls", """
WITH c AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS segment, c_nationkey FROM customer)
SELECT c_custkey,
  md5(c_name || '-' || coalesce(segment, '_dbt_utils_surrogate_key_null_') || '-' || CAST(c_nationkey AS VARCHAR))
    AS key,
  md5(c_name || '-' || coalesce(segment, '') || '-' || CAST(c_nationkey AS VARCHAR)) AS legacy_key
FROM c
""")
def surrogate_key_nulls(t):
    fields = ["c_name", "nullif(c_mktsegment, 'BUILDING')", "c_nationkey"]
    return t.customer.select("c_custkey", surrogate_key(*fields).alias("key"),
                             surrogate_key(*fields, nulls_as_empty=True).alias("legacy_key"))


@query("safe_math", """
SELECT l_orderkey, l_linenumber, l_suppkey,
  round(coalesce(l_quantity, 0) + coalesce(nullif(l_discount, 0.05), 0) + coalesce(nullif(l_tax, 0.02), 0), 6) AS added,
  round(coalesce(l_quantity, 0) - coalesce(nullif(l_discount, 0.05), 0) - coalesce(nullif(l_tax, 0.02), 0), 6)
    AS subtracted,
  round(l_quantity / nullif(l_tax * 100, 0), 6) AS divided
FROM lineitem
""")
def safe_math(t):
    fields = ["l_quantity", "nullif(l_discount, 0.05D)", "nullif(l_tax, 0.02D)"]
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.round(safe_add(fields), 6).alias("added"),
        F.round(safe_subtract(fields), 6).alias("subtracted"),
        F.round(safe_divide("l_quantity", "l_tax * 100"), 6).alias("divided"),
    )


@query("width_bucket", """
SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice >= 400000 THEN 11
  ELSE floor((o_totalprice - 100000) / 30000) + 1 END AS BIGINT) AS bucket
FROM orders
""")
def width_buckets(t):
    return t.orders.select("o_orderkey", width_bucket("o_totalprice", 100000, 400000, 10).alias("bucket"))


@query("haversine", """
WITH points AS (
  SELECT c_custkey, CAST(c_custkey % 170 AS DOUBLE) - 85 AS lat1, CAST(c_custkey % 350 AS DOUBLE) - 175 AS lon1,
         c_nationkey * 3.5 - 40 AS lat2, c_nationkey * 7.0 - 80 AS lon2
  FROM customer
),
arcs AS (
  SELECT c_custkey, lat1, 2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2))) AS mi
  FROM points
)
SELECT c_custkey, round(mi, 4) AS mi, round(mi * 1.60934, 4) AS km, round(radians(lat1), 6) AS lat FROM arcs
""")
def haversine(t):
    points = t.customer.select(
        "c_custkey",
        ((F.col("c_custkey") % 170).cast("double") - 85).alias("lat1"),
        ((F.col("c_custkey") % 350).cast("double") - 175).alias("lon1"),
        (F.col("c_nationkey") * 3.5 - 40).alias("lat2"),
        (F.col("c_nationkey") * 7.0 - 80).alias("lon2"),
    )
    corners = ["lat1", "lon1", "lat2", "lon2"]
    return points.select(
        "c_custkey",
        F.round(haversine_distance(*corners), 4).alias("mi"),
        F.round(haversine_distance(*corners, unit="km"), 4).alias("km"),
        F.round(radians_of("lat1"), 6).alias("lat"),
    )


NO_SCHEME = "replace(replace({url}, 'http://', ''), 'https://', '')"


@query("url_host", """
SELECT page_id, split_part(split_part(
  replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host
FROM pages
""")
def url_hosts(t):
    return t.pages.select("page_id", url_host("url").alias("host"))


@query("url_path", f"""
WITH s AS (SELECT page_id, {NO_SCHEME.format(url='url')} AS u FROM pages),
p AS (SELECT page_id, u, coalesce(nullif(strpos(u, '/'), 0), strpos(u, '?') - 1) AS pos FROM s)
SELECT page_id, split_part(right(u, length(u) - pos), '?', 1) AS path FROM p
""")
def url_paths(t):
    return t.pages.select("page_id", url_path("url").alias("path"))


@query("url_param", """
SELECT page_id, nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
       nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page
FROM pages
""")
def url_params(t):
    return t.pages.select("page_id", url_parameter("url", "ref").alias("ref"), url_parameter("url", "page").alias("page"))


SLUG = """
WITH named AS (SELECT p_partkey, p_name, p_size || ' ' || p_brand || ' -- ' || p_type AS title FROM part),
cleaned AS (
  SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS n,
         regexp_replace(regexp_replace(lower(title), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS t
  FROM named
)
SELECT p_partkey, CASE WHEN regexp_matches(n, '^[0-9]') THEN '_' || n ELSE n END AS name_slug,
       CASE WHEN regexp_matches(t, '^[0-9]') THEN '_' || t ELSE t END AS title_slug
FROM cleaned
"""


@query("slugify_col", SLUG)
def slugify_col(t):
    title = F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_brand", F.lit(" -- "), "p_type")
    return t.part.select("p_partkey", slugify("p_name").alias("name_slug"), slugify(title).alias("title_slug"))


@query("date_functions", """
SELECT o_orderkey,
  o_orderdate + INTERVAL 3 MONTH AS plus_months,
  o_orderdate + INTERVAL 36 HOUR AS plus_hours,
  date_diff('day', o_orderdate, TIMESTAMP '1998-08-02 13:30:00') AS days,
  date_diff('day', date_trunc('week', o_orderdate + INTERVAL 1 DAY), date_trunc('week', TIMESTAMP '1998-08-03 13:30:00'))
    // 7 AS weeks,
  date_diff('month', o_orderdate, TIMESTAMP '1998-08-02 13:30:00') AS months,
  date_diff('quarter', o_orderdate, TIMESTAMP '1998-08-02 13:30:00') AS quarters,
  date_diff('hour', o_orderdate, TIMESTAMP '1998-08-02 13:30:00') AS hours,
  CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start,
  CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS year_start
FROM orders
""")
def date_functions(t):
    day = "o_orderdate"
    until = "timestamp_ntz'1998-08-02 13:30:00'"
    units = {"day": "days", "week": "weeks", "month": "months", "quarter": "quarters", "hour": "hours"}
    return t.orders.select(
        "o_orderkey",
        add_units("month", 3, day).alias("plus_months"),
        add_units("hour", 36, day).alias("plus_hours"),
        *[count_units(unit, day, until).alias(name) for unit, name in units.items()],
        truncate_to("month", day).alias("month_start"),
        truncate_to("year", day).alias("year_start"),
    )


@query("casts_and_text", """
SELECT event_id, TRY_CAST(props AS INTEGER) AS not_a_number,
  TRY_CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS a_number,
  CAST(value > 50 AS VARCHAR) AS is_large,
  trim('  ' || event_type || ' ') AS trimmed,
  abs(user_id - 50) AS distance,
  least(user_id, 40) AS capped,
  CAST(ceil(value) AS BIGINT) AS rounded_up,
  user_id % 7 AS remainder,
  round(power(value, 2), 6) AS squared,
  right(event_type, 3) AS ending,
  strpos(event_type, 'e') AS first_e,
  event_type || '''s' AS possessive
FROM events
""")
def casts_and_text(t):
    return t.events.select(
        "event_id",
        safe_cast("props", "int").alias("not_a_number"),
        safe_cast(text_of("user_id"), "int").alias("a_number"),
        text_of("value > 50").alias("is_large"),
        F.trim(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("trimmed"),
        F.abs(F.col("user_id") - 50).alias("distance"),
        F.least("user_id", F.lit(40)).alias("capped"),
        F.ceil("value").alias("rounded_up"),
        (F.col("user_id") % 7).alias("remainder"),
        F.round(F.pow("value", F.lit(2)), 6).alias("squared"),
        F.right("event_type", F.lit(3)).alias("ending"),
        F.position(F.lit("e"), "event_type").cast("long").alias("first_e"),
        F.concat("event_type", F.lit("'s")).alias("possessive"),
    )


@query("series", """
WITH numbers AS (SELECT unnest(range(1, (SELECT max(o_custkey) + 1 FROM orders))) AS generated_number)
SELECT n.generated_number FROM numbers n
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = n.generated_number AND o.o_orderstatus = 'P')
""")
def series(t):
    """Customer numbers without a pending order."""
    top = t.orders.agg(F.max("o_custkey")).first()[0]
    pending = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("generated_number")).distinct()
    return number_series(t.spark, top).join(pending, "generated_number", "left_anti")


@query("spine_day", """
WITH days AS (
  SELECT CAST(unnest(range(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE)
    AS date_day FROM orders
),
counts AS (SELECT CAST(o_orderdate AS DATE) AS date_day, count(*) AS n FROM orders GROUP BY 1)
SELECT d.date_day, coalesce(c.n, 0) AS orders FROM days d LEFT JOIN counts c ON d.date_day = c.date_day
""")
def spine_day(t):
    """Orders per day, with the days that had none."""
    bounds = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")).first()
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    days = date_spine(t.spark, "day", bounds["a"], bounds["b"])
    return days.join(counts, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("orders"))


@query("spine_hour", """
WITH hours AS (
  SELECT unnest(range(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS date_hour
  FROM events
),
counts AS (SELECT date_trunc('hour', ts) AS date_hour, count(*) AS n FROM events GROUP BY 1)
SELECT h.date_hour, coalesce(c.n, 0) AS events FROM hours h LEFT JOIN counts c ON h.date_hour = c.date_hour
""")
def spine_hour(t):
    """Events per hour, with the hours that had none."""
    hour = truncate_to("hour", "ts")
    bounds = t.events.agg(F.min(hour).alias("a"), F.max(hour).alias("b")).first()
    counts = t.events.groupBy(hour.alias("date_hour")).agg(F.count(F.lit(1)).alias("n"))
    hours = date_spine(t.spark, "hour", bounds["a"], bounds["b"])
    return hours.join(counts, "date_hour", "left").select("date_hour", F.coalesce("n", F.lit(0)).alias("events"))
