"""Operator queries over the driver tables (inventory ids in the names), each with its SQL oracle.

Every query reads whole driver tables (or the star Spark derives from them); nothing is sampled or capped except
where the limit is the feature (top-k reports).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.functions.digest import delimited_text, row_digest, version_id
from lakekit.functions.timeops import seconds_between
from lakekit.operators import fingerprint, merge, profile, setops
from lakekit.operators.series import continuity_report, explode_parallel_arrays
from lakekit.plans import oracle
from lakekit.plans.catalog import register, star
from lakekit.plans.oracle import sround, with_star
from lakekit.plans.tables import TABLES, Tables, played_pickup

LINE_DIGEST_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
MONEY_COLS = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}


def _line_digest_cols():
    return [F.col(c).cast("decimal(18,4)") if c in MONEY_COLS else F.col(c) for c in LINE_DIGEST_COLS]


def _line_digest_sql(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    parts = [f"coalesce(CAST(CAST({p}{c} AS DECIMAL(18,4)) AS VARCHAR), '<null>')" if c in MONEY_COLS
             else f"coalesce(CAST({p}{c} AS VARCHAR), '<null>')" for c in LINE_DIGEST_COLS]
    return "sha256(concat_ws('|', " + ", ".join(parts) + "))"


def _fingerprint_sql(source: str, group: str) -> str:
    """Sums of the digests' four 64-bit lanes and the row count, hashed (see :func:`fingerprint.content_fingerprint`)."""
    lanes = " || ':' || ".join(f"CAST(SUM(CAST(CAST('0x' || substr(digest, {16 * i + 1}, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR)"
                               for i in range(4))
    return f"""
f AS (SELECT {group} AS grp, sha256(CAST(COUNT(*) AS VARCHAR) || ':' || {lanes}) AS content_sha256, COUNT(*) AS row_count
      FROM {source} GROUP BY {group})"""


def _sorted_fingerprint_sql(source: str, group: str) -> str:
    """Three-level fingerprint in SQL (mirrors :func:`fingerprint.sorted_fingerprint`)."""
    return f"""
d AS (SELECT {group} AS grp, digest, COUNT(*) AS n FROM {source} GROUP BY {group}, digest),
b AS (SELECT grp, substr(digest, 1, 3) AS bucket,
             sha256(string_agg(digest || 'x' || CAST(n AS VARCHAR), ',' ORDER BY digest || 'x' || CAST(n AS VARCHAR)))
               AS bh, SUM(n) AS n
      FROM d GROUP BY grp, substr(digest, 1, 3)),
f AS (SELECT grp, sha256(string_agg(bucket || ':' || bh, ',' ORDER BY bucket || ':' || bh)) AS content_sha256,
             CAST(SUM(n) AS BIGINT) AS row_count
      FROM b GROUP BY grp)"""


# --- C1/C2/A9: row digest and file content fingerprint (one "file" per ship month) -------------------------

@register("c2_period_content_fingerprint", f"""WITH rows AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS period, {_line_digest_sql()} AS digest FROM lineitem
), {_sorted_fingerprint_sql('rows', 'period')}
SELECT grp AS period, content_sha256, row_count FROM f""")
def c2_fingerprint(spark, d):
    li = Tables(spark, d).lineitem
    rows = li.select(F.date_format("l_shipdate", "yyyy-MM").alias("period"),
                     row_digest(*_line_digest_cols(), mode="text").alias("row_digest"))
    return fingerprint.sorted_fingerprint(rows, ["period"])


ZONE_ROW_SQL = ("concat_ws('|', coalesce(CAST(n.n_nationkey AS VARCHAR), '<null>'), coalesce(r.r_name, '<null>'), "
                "coalesce(n.n_name, '<null>'), coalesce(r.r_name, '<null>'))")


@register("c3_zone_snapshot_fingerprint", f"""WITH rows AS (
  SELECT 1 AS g, sha256({ZONE_ROW_SQL}) AS digest
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
), {_fingerprint_sql('rows', 'g')}
SELECT content_sha256, row_count, 'zones_' || substr(content_sha256, 1, 12) AS version_id FROM f""")
def c3_snapshot(spark, d):
    z = star(spark, d).raw_zones()
    rows = z.select(F.sha2(delimited_text("location_id", "borough", "zone", "service_zone"), 256).alias("row_digest"))
    return fingerprint.snapshot_fingerprint(rows, prefix="zones_")


# --- K4/K5/K7: keyed snapshot merge; C54 snapshot diff ------------------------------------------------------

def _order_status_source(t: Tables):
    li = t.lineitem
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.when(F.count_if(F.col("l_linestatus") != "F") == 0, "F")
        .when(F.count_if(F.col("l_linestatus") != "O") == 0, "O").otherwise("P").alias("o_orderstatus"))


STATUS_SOURCE_SQL = """src AS (
  SELECT l_orderkey AS o_orderkey,
         CASE WHEN COUNT_IF(l_linestatus <> 'F') = 0 THEN 'F'
              WHEN COUNT_IF(l_linestatus <> 'O') = 0 THEN 'O' ELSE 'P' END AS o_orderstatus
  FROM lineitem GROUP BY l_orderkey
)"""

MERGE_SQL = f"""WITH {STATUS_SOURCE_SQL},
plan AS (
  SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
    CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL
              AND t.o_orderstatus IS DISTINCT FROM s.o_orderstatus THEN 'update'
         WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN 'unchanged'
         WHEN s.o_orderkey IS NOT NULL THEN 'insert' ELSE '{{unmatched}}' END AS _merge_action,
    t.o_orderstatus AS t_status, s.o_orderstatus AS s_status, t.o_totalprice
  FROM orders t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey
)"""


def _merge_plan(spark, d, delete=True, enabled=True):
    t = Tables(spark, d)
    target = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return merge.merge_plan(target, _order_status_source(t), ["o_orderkey"], ["o_orderstatus"],
                            update_cols=["o_orderstatus"], delete_unmatched=delete, enabled=enabled)


@register("k5_mirror_merge_order_status", MERGE_SQL.format(unmatched="delete") + """
SELECT o_orderkey,
       CASE WHEN _merge_action IN ('update', 'insert') THEN s_status ELSE t_status END AS o_orderstatus,
       o_totalprice, _merge_action
FROM plan WHERE _merge_action <> 'delete'""")
def k5_merge(spark, d):
    return _merge_plan(spark, d).filter(F.col("_merge_action") != "delete")


@register("k4_merge_action_counts", MERGE_SQL.format(unmatched="delete") + """
SELECT _merge_action, CAST(COUNT(*) AS BIGINT) AS keys FROM plan GROUP BY _merge_action""")
def k4_counts(spark, d):
    return merge.merge_counts(_merge_plan(spark, d))


@register("k7_merge_gated_off_counts", """WITH t AS (SELECT o_orderkey FROM orders),
src AS (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem),
plan AS (SELECT CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN 'unchanged'
                     WHEN s.o_orderkey IS NOT NULL THEN 'skipped' ELSE 'keep' END AS _merge_action
         FROM t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey)
SELECT _merge_action, CAST(COUNT(*) AS BIGINT) AS keys FROM plan GROUP BY _merge_action""")
def k7_gated(spark, d):
    return merge.merge_counts(_merge_plan(spark, d, delete=True, enabled=False))


@register("c54_snapshot_diff_order_status", MERGE_SQL.format(unmatched="delete") + """,
before AS (SELECT o_orderkey, o_orderstatus FROM orders),
after AS (SELECT o_orderkey, CASE WHEN _merge_action IN ('update', 'insert') THEN s_status ELSE t_status END
            AS o_orderstatus FROM plan WHERE _merge_action <> 'delete'),
b AS (SELECT o_orderkey, o_orderstatus, COUNT(*) AS n FROM before GROUP BY ALL),
a AS (SELECT o_orderkey, o_orderstatus, COUNT(*) AS n FROM after GROUP BY ALL),
j AS (SELECT COALESCE(b.o_orderkey, a.o_orderkey) AS o_orderkey, COALESCE(b.o_orderstatus, a.o_orderstatus)
               AS o_orderstatus, COALESCE(b.n, 0) - COALESCE(a.n, 0) AS dd
      FROM b FULL OUTER JOIN a ON b.o_orderkey IS NOT DISTINCT FROM a.o_orderkey
                              AND b.o_orderstatus IS NOT DISTINCT FROM a.o_orderstatus)
SELECT o_orderkey, o_orderstatus, CASE WHEN dd > 0 THEN 'before_only' ELSE 'after_only' END AS side,
       CAST(abs(dd) AS BIGINT) AS copies
FROM j WHERE dd <> 0""")
def c54_diff(spark, d):
    before = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    after = k5_merge(spark, d).select("o_orderkey", "o_orderstatus")
    return setops.snapshot_diff(before, after)


# --- U1/U2/U3: set operations --------------------------------------------------------------------------------

@register("u2_key_set_diff_orders_lines", """
SELECT CAST((SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)) AS BIGINT)
         AS only_left,
       CAST((SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders)) AS BIGINT)
         AS only_right,
       CAST((SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders INTERSECT SELECT l_orderkey FROM lineitem)) AS BIGINT)
         AS in_both""")
def u2_diff(spark, d):
    t = Tables(spark, d)
    return setops.key_set_diff(t.orders.select(F.col("o_orderkey").alias("k")),
                               t.lineitem.select(F.col("l_orderkey").alias("k")), ["k"])


@register("u3_intersect_parts_sold", "SELECT p_partkey FROM part INTERSECT SELECT l_partkey FROM lineitem")
def u3_intersect(spark, d):
    t = Tables(spark, d)
    return setops.common_keys(t.part.select("p_partkey"), t.lineitem.select(F.col("l_partkey").alias("p_partkey")),
                              ["p_partkey"])


@register("u2_orders_without_lines", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def u2_only(spark, d):
    t = Tables(spark, d)
    return setops.keys_only_in(t.orders.select("o_orderkey"),
                               t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@register("u1_union_all_dates", """
SELECT 'order' AS role, CAST(o_orderdate AS DATE) AS d FROM orders
UNION ALL SELECT 'ship', CAST(l_shipdate AS DATE) FROM lineitem""")
def u1_union(spark, d):
    t = Tables(spark, d)
    return t.orders.select(F.lit("order").alias("role"), F.to_date("o_orderdate").alias("d")).unionByName(
        t.lineitem.select(F.lit("ship").alias("role"), F.to_date("l_shipdate").alias("d")))


# --- D9/A14/A12/C47/C46/S8/D7: profiling ---------------------------------------------------------------------

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("d9_null_rates_lineitem", "\nUNION ALL\n".join(
    f"SELECT 'lineitem' AS dataset, '{c}' AS column_name, {i + 1} AS ordinal, CAST(COUNT_IF({c} IS NULL) AS BIGINT) "
    f"AS null_count, CAST(COUNT(*) AS BIGINT) AS total_count, "
    f"CASE WHEN COUNT(*) = 0 THEN 0.0 ELSE {sround(f'CAST(COUNT_IF({c} IS NULL) AS DOUBLE) * 100.0 / COUNT(*)', 4)} "
    f"END AS null_pct FROM lineitem" for i, c in enumerate(LINEITEM_COLS)))
def d9_nulls(spark, d):
    return profile.null_rates(Tables(spark, d).lineitem, "lineitem").withColumn("ordinal", F.col("ordinal").cast("int"))


@register("a14_value_frequency_returnflag",
          "SELECT l_returnflag AS value, CAST(COUNT(*) AS BIGINT) AS count FROM lineitem GROUP BY l_returnflag")
def a14_freq(spark, d):
    return profile.value_frequency(Tables(spark, d).lineitem, "l_returnflag")


@register("a12_distinct_flag_status", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def a12_distinct(spark, d):
    return Tables(spark, d).lineitem.select("l_returnflag", "l_linestatus").distinct()


@register("c47_order_month_profile", """
SELECT strftime(o.o_orderdate, '%Y-%m') AS period, CAST(COUNT(*) AS BIGINT) AS rows,
       MIN(l.l_shipdate) AS min_date, MAX(l.l_shipdate) AS max_date,
       CAST(COUNT_IF(strftime(l.l_shipdate, '%Y-%m') <> strftime(o.o_orderdate, '%Y-%m')) AS BIGINT)
         AS rows_outside_period
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def c47_profile(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), "l_shipdate")
    return profile.per_group_profile(j, "period", "l_shipdate", "period")


@register("a13_wide_profile_lineitem", """
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT l_orderkey) AS BIGINT) AS orders,
  MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,3))) AS DECIMAL(38,3)) AS total_quantity,
  CAST(COUNT_IF(l_discount > 0.05) AS BIGINT) AS high_discount_rows,
  CAST(COUNT_IF(l_returnflag = 'R') AS BIGINT) AS returned_rows,
  MIN(l_linenumber) AS min_line, MAX(l_linenumber) AS max_line,
  CAST(COUNT_IF(l_shipdate IS NULL) AS BIGINT) AS null_ship
FROM lineitem""")
def a13_wide(spark, d):
    li = Tables(spark, d).lineitem
    return li.agg(F.count(F.lit(1)).cast("long").alias("rows"),
                  F.countDistinct("l_orderkey").cast("long").alias("orders"),
                  F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
                  F.sum(F.col("l_quantity").cast("decimal(18,3)")).cast("decimal(38,3)").alias("total_quantity"),
                  F.count_if(F.col("l_discount") > 0.05).cast("long").alias("high_discount_rows"),
                  F.count_if(F.col("l_returnflag") == "R").cast("long").alias("returned_rows"),
                  F.min("l_linenumber").alias("min_line"), F.max("l_linenumber").alias("max_line"),
                  F.count_if(F.col("l_shipdate").isNull()).cast("long").alias("null_ship"))


@register("c46_join_coverage_orders_customer", """
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT_IF(c.k IS NOT NULL) AS BIGINT) AS matched,
       CAST(COUNT_IF(o.o_custkey IS NULL) AS BIGINT) AS missing_key,
       CAST(COUNT_IF(o.o_custkey IS NOT NULL AND c.k IS NULL) AS BIGINT) AS unmatched_key,
       CAST(COUNT_IF(c.n > 1) AS BIGINT) AS fan_out_rows
FROM orders o LEFT JOIN (SELECT c_custkey AS k, COUNT(*) AS n FROM customer GROUP BY c_custkey) c
  ON o.o_custkey = c.k""")
def c46_cov(spark, d):
    t = Tables(spark, d)
    return profile.join_coverage(t.orders, "o_custkey", t.customer, "c_custkey")


@register("c46_time_coverage_trips_weather", with_star(""",
b AS (SELECT MIN(observation_timestamp_utc) AS lo, MAX(observation_timestamp_utc) AS hi FROM weather),
h AS (SELECT DISTINCT observation_timestamp_utc AS hr FROM weather),
t AS (SELECT date_trunc('hour', pickup_timestamp_utc) AS tt FROM weather_map)
SELECT CASE WHEN t.tt IS NULL THEN 'invalid_time' WHEN h.hr IS NOT NULL THEN 'matched'
            WHEN b.lo IS NULL OR t.tt < b.lo THEN 'before_coverage' WHEN t.tt > b.hi THEN 'after_coverage'
            ELSE 'hole_in_coverage' END AS coverage_bucket, CAST(COUNT(*) AS BIGINT) AS rows
FROM t CROSS JOIN b LEFT JOIN h ON t.tt = h.hr GROUP BY 1"""))
def c46_time(spark, d):
    s = star(spark, d)
    return profile.time_coverage(s.weather_map(), "pickup_timestamp_utc", s.weather(), "observation_timestamp_utc")


TYPE_MAP_SQL = ("CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
                "WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' "
                "ELSE lower(data_type) END")
TABLE_LIST_SQL = ", ".join(f"'{t}'" for t in TABLES)


@register("s8_catalog_column_signatures", f"""
SELECT table_name AS dataset, column_name, {TYPE_MAP_SQL} AS data_type, CAST(ordinal_position AS INTEGER) AS ordinal
FROM information_schema.columns WHERE table_name IN ({TABLE_LIST_SQL})""")
def s8_signatures(spark, d):
    t = Tables(spark, d)
    return profile.schema_signature_frame(spark, {name: getattr(t, name).schema for name in TABLES})


@register("d7_schema_drift_text_tables", f"""
WITH sig AS (SELECT table_name AS dataset, column_name, {TYPE_MAP_SQL} AS data_type
             FROM information_schema.columns WHERE table_name IN ('documents', 'benchmark', 'conversations', 'labels')),
grid AS (SELECT c.column_name, d.dataset FROM (SELECT DISTINCT column_name FROM sig) c
         CROSS JOIN (SELECT DISTINCT dataset FROM sig) d),
j AS (SELECT g.column_name, g.dataset, COALESCE(s.data_type, 'MISSING') AS data_type
      FROM grid g LEFT JOIN sig s ON g.column_name = s.column_name AND g.dataset = s.dataset)
SELECT column_name, dataset, data_type FROM j
WHERE column_name IN (SELECT column_name FROM j GROUP BY column_name HAVING COUNT(DISTINCT data_type) > 1)""")
def d7_drift(spark, d):
    t = Tables(spark, d)
    sig = profile.schema_signature_frame(spark, {n: getattr(t, n).schema
                                                 for n in ["documents", "benchmark", "conversations", "labels"]})
    return profile.schema_drift(sig).select("column_name", "dataset", "data_type")


# --- A5/A6/A7/A10/A11/A15: aggregations ------------------------------------------------------------------------

@register("a6_duplicate_line_keys", """
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS distinct_keys,
       CAST(COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicate_rows FROM lineitem""")
def a6_dups(spark, d):
    g = Tables(spark, d).lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").cast("long").alias("rows"), F.count(F.lit(1)).cast("long").alias("distinct_keys"),
                 F.sum(F.col("n") - 1).cast("long").alias("duplicate_rows"))


@register("a7_duplicate_groups", """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def a7_groups(spark, d):
    return (Tables(spark, d).lineitem.groupBy("l_orderkey", "l_linenumber")
            .agg(F.count(F.lit(1)).cast("long").alias("n")).filter("n > 1"))


@register("a5_count_distinct_per_nation", """
SELECT c.c_nationkey, CAST(COUNT(DISTINCT o.o_custkey) AS BIGINT) AS customers,
       CAST(COUNT(DISTINCT (o.o_custkey, o.o_orderstatus)) AS BIGINT) AS customer_statuses
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey""")
def a5_distinct(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    # two distinct aggregates over a small-domain grouping: pre-deduplicate once, then count
    pairs = j.select("c_nationkey", "o_custkey", "o_orderstatus").distinct()
    return pairs.groupBy("c_nationkey").agg(
        F.countDistinct("o_custkey").cast("long").alias("customers"),
        F.count(F.when(F.col("o_custkey").isNotNull() & F.col("o_orderstatus").isNotNull(), 1)).cast("long")
        .alias("customer_statuses"))


@register("a10_sorted_nation_names_per_region", """
SELECT r.r_name, string_agg(DISTINCT n.n_name, ',' ORDER BY n.n_name) AS nations
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name""")
def a10_set(spark, d):
    from lakekit.operators.dq import sorted_set_string
    t = Tables(spark, d)
    j = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(sorted_set_string("n_name").alias("nations"))


@register("a11_orders_per_customer_by_segment", f"""
WITH per AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey)
SELECT c.c_mktsegment, CAST(COUNT(*) AS BIGINT) AS customers, CAST(SUM(p.n) AS BIGINT) AS orders,
       {sround('CAST(SUM(p.n) AS DOUBLE) / COUNT(*)', 3)} AS avg_orders_per_customer
FROM per p JOIN customer c ON p.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""")
def a11_two_level(spark, d):
    t = Tables(spark, d)
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    j = per.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).cast("long").alias("customers"), F.sum("n").cast("long").alias("orders"),
        F.round(F.sum("n").cast("double") / F.count(F.lit(1)), 3).alias("avg_orders_per_customer"))


@register("a15_sum_hourly_array_sizes", f"""
SELECT CAST(COUNT(*) AS BIGINT) AS documents, CAST(SUM(h) AS BIGINT) AS hourly_values
FROM (SELECT CAST(date_trunc('hour', ts) AS DATE) AS day, COUNT(DISTINCT date_trunc('hour', ts)) AS h
      FROM {oracle.OBSERVED} GROUP BY coordinate_id, 1)""")
def a15_sizes(spark, d):
    docs = star(spark, d).weather_documents()
    return docs.agg(F.count(F.lit(1)).cast("long").alias("documents"),
                    F.sum(F.size("hourly.time")).cast("long").alias("hourly_values"))


# --- W1/W2/W6, O2/O3/O4: windows and top-k -------------------------------------------------------------------

@register("w1_latest_event_per_user", """
SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def w1_latest(spark, d):
    # latest row per key as an aggregate (max_by on the full order), partially aggregated before the shuffle:
    # a user with a third of all events never lands in one task, unlike a ROW_NUMBER window
    e = Tables(spark, d).events
    latest = e.groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts", "event_type"),
                                               F.struct("ts", "event_id")).alias("r"))
    return latest.select("user_id", "r.event_id", "r.ts", "r.event_type")


@register("w6_gap_to_previous_event", """
SELECT event_id, user_id, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_ts,
       date_sub('second', LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS gap_seconds
FROM events""")
def w6_lag(spark, d):
    from lakekit.operators.series import lag_distributed
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    p = lag_distributed(e, ["user_id"], ["ts", "event_id"], {"ts": "previous_ts"})
    return p.select("event_id", "user_id", "previous_ts", seconds_between("previous_ts", "ts").alias("gap_seconds"))


@register("w2_collision_size_per_line", """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS BIGINT) AS collision_count
FROM lineitem""")
def w2_count(spark, d):
    from lakekit.operators.dedup import with_collision_count
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber")
    keyed = li.withColumn("__k", F.struct("l_orderkey", "l_linenumber"))
    return with_collision_count(keyed, "__k").drop("__k")


@register("o2_top_order_full_tiebreak", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def o2_top1(spark, d):
    o = Tables(spark, d).orders
    return (o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
            .limit(1).select("o_orderkey", "o_totalprice", "o_orderdate"))


@register("o3_latest_order_key", """
SELECT arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest_orderkey FROM orders""")
def o3_latest(spark, d):
    o = Tables(spark, d).orders
    return o.agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest_orderkey"))


@register("o4_top15_pickup_zones", with_star("""
SELECT z.zone_name, CAST(COUNT(*) AS BIGINT) AS trips
FROM fact f JOIN dim_zone z ON f.pickup_zone_key = z.zone_key
GROUP BY z.zone_name ORDER BY trips DESC, z.zone_name LIMIT 15"""))
def o4_top(spark, d):
    s = star(spark, d)
    f, z = s.trip_fact(), s.dim_zone()
    j = f.join(z, f["pickup_zone_key"] == z["zone_key"])
    return (j.groupBy("zone_name").agg(F.count(F.lit(1)).cast("long").alias("trips"))
            .orderBy(F.col("trips").desc(), "zone_name").limit(15))


@register("o5_largest_collision_groups", """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 10""")
def o5_sample(spark, d):
    g = (Tables(spark, d).lineitem.groupBy("l_orderkey", "l_linenumber")
         .agg(F.count(F.lit(1)).cast("long").alias("n")))
    return g.orderBy(F.col("n").desc(), "l_orderkey", "l_linenumber").limit(10)


@register("o4_top10_dropoff_zones", with_star("""
SELECT z.zone_name, z.borough, CAST(COUNT(*) AS BIGINT) AS trips
FROM fact f JOIN dim_zone z ON f.dropoff_zone_key = z.zone_key
GROUP BY z.zone_name, z.borough ORDER BY trips DESC, z.zone_name, z.borough LIMIT 10"""))
def o4_top_dropoff(spark, d):
    s = star(spark, d)
    arrivals = s.trip_fact().groupBy("dropoff_zone_key").agg(F.count(F.lit(1)).cast("long").alias("n"))
    zones = s.dim_zone()
    j = arrivals.join(zones, arrivals["dropoff_zone_key"] == zones["zone_key"])
    return (j.groupBy("zone_name", "borough").agg(F.sum("n").cast("long").alias("trips"))
            .orderBy(F.col("trips").desc(), "zone_name", "borough").limit(10))


@register("o5_collision_group_members", with_star("""
, top AS (SELECT trip_hash FROM quarantine GROUP BY trip_hash, l_orderkey, l_linenumber
         ORDER BY COUNT(*) DESC, l_orderkey, l_linenumber LIMIT 10)
SELECT q.trip_hash, q.l_orderkey, q.l_linenumber, CAST(q.collision_count AS BIGINT) AS collision_count, q.pickup_datetime_local,
       q.dropoff_datetime_local, q.pickup_location_id, q.dropoff_location_id, q.fare_amount_usd, q.total_amount_usd
FROM quarantine q WHERE q.trip_hash IN (SELECT trip_hash FROM top)""".replace("\n, top AS", ",\ntop AS", 1)))
def o5_members(spark, d):
    """Every row of the ten largest groups of ambiguous trips, ties by identity."""
    held = star(spark, d).quarantine()
    top = (held.select("trip_hash", "l_orderkey", "l_linenumber", "collision_count").distinct()
           .orderBy(F.col("collision_count").desc(), "l_orderkey", "l_linenumber").limit(10))
    return held.join(F.broadcast(top.select("trip_hash")), "trip_hash", "left_semi").select(  # ten keys
        "trip_hash", "l_orderkey", "l_linenumber", F.col("collision_count").cast("long").alias("collision_count"), "pickup_datetime_local",
        "dropoff_datetime_local", "pickup_location_id", "dropoff_location_id", "fare_amount_usd", "total_amount_usd")


# --- P12/P13/J10: predicates and joins -------------------------------------------------------------------------

@register("p12_orders_with_and_without_lines", """
SELECT o_orderstatus, CAST(COUNT_IF(EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS BIGINT)
         AS with_lines,
       CAST(COUNT_IF(NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS BIGINT)
         AS without_lines
FROM orders o GROUP BY o_orderstatus""")
def p12_exists(spark, d):
    t = Tables(spark, d)
    keys = t.lineitem.select(F.col("l_orderkey").alias("k")).distinct().withColumn("__has", F.lit(True))
    j = t.orders.join(keys, F.col("o_orderkey") == F.col("k"), "left")
    return j.groupBy("o_orderstatus").agg(F.count_if(F.col("__has").isNotNull()).cast("long").alias("with_lines"),
                                          F.count_if(F.col("__has").isNull()).cast("long").alias("without_lines"))


@register("p13_lines_above_average_quantity", """
SELECT CAST(COUNT(*) AS BIGINT) AS lines_above_average FROM lineitem
WHERE l_quantity > (SELECT AVG(l_quantity) FROM lineitem)""")
def p13_scalar(spark, d):
    li = Tables(spark, d).lineitem
    avg = li.agg((F.sum(F.col("l_quantity").cast("decimal(18,6)")) / F.count("l_quantity")).alias("__avg"))
    return (li.crossJoin(F.broadcast(avg))  # one-row scalar subquery
            .filter(F.col("l_quantity") > F.col("__avg")).agg(F.count(F.lit(1)).cast("long").alias("lines_above_average")))


@register("c51_source_to_landed_reconciliation", with_star(f""",
src AS (SELECT strftime({oracle.PICKUP}, '%Y-%m') AS period, COUNT(*) AS source_rows,
               SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS source_fare
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
landed AS (SELECT strftime(pickup_datetime_raw, '%Y-%m') AS period, COUNT(*) AS landed_rows,
                  SUM(CAST(fare_amount_raw AS DECIMAL(18,2))) AS landed_fare FROM bronze_trips GROUP BY 1)
SELECT COALESCE(s.period, l.period) AS period, CAST(s.source_rows AS BIGINT) AS source_rows,
       CAST(l.landed_rows AS BIGINT) AS landed_rows,
       CAST(s.source_fare AS DECIMAL(38,2)) AS source_fare, CAST(l.landed_fare AS DECIMAL(38,2)) AS landed_fare,
       (s.source_rows IS NOT DISTINCT FROM l.landed_rows AND s.source_fare IS NOT DISTINCT FROM l.landed_fare)
         AS reconciled
FROM src s FULL OUTER JOIN landed l ON s.period = l.period"""))
def c51_recon(spark, d):
    t = Tables(spark, d)
    src = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
           .groupBy(F.date_format(played_pickup(), "yyyy-MM").alias("period"))
           .agg(F.count(F.lit(1)).cast("long").alias("source_rows"),
                F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("decimal(38,2)").alias("source_fare")))
    landed = (star(spark, d).raw_trips().groupBy(F.date_format("pickup_datetime_raw", "yyyy-MM").alias("period"))
              .agg(F.count(F.lit(1)).cast("long").alias("landed_rows"),
                   F.sum(F.col("fare_amount_raw").cast("decimal(18,2)")).cast("decimal(38,2)").alias("landed_fare")))
    j = src.join(landed, "period", "full_outer")
    return j.select("period", "source_rows", "landed_rows", "source_fare", "landed_fare",
                    (F.col("source_rows").eqNullSafe(F.col("landed_rows"))
                     & F.col("source_fare").eqNullSafe(F.col("landed_fare"))).alias("reconciled"))


# --- star layers as tables (C11–C31) ---------------------------------------------------------------------------

@register("c13_quarantine_rows", with_star("""
SELECT trip_hash, l_orderkey, l_linenumber, CAST(collision_count AS BIGINT) AS collision_count, quarantine_reasons
FROM quarantine"""))
def c13_quarantine(spark, d):
    return star(spark, d).quarantine().select("trip_hash", "l_orderkey", "l_linenumber", "collision_count",
                                               "quarantine_reasons")


@register("c12_quality_flag_profile", with_star("""
SELECT negative_fare_flag, negative_distance_flag, dropoff_before_pickup_flag, implausible_duration_flag,
       implausible_passenger_count_flag, passenger_count_missing_flag, CAST(COUNT(*) AS BIGINT) AS trips
FROM clean GROUP BY ALL"""))
def c12_flags(spark, d):
    from lakekit.plans.checks import FLAGS
    return star(spark, d).clean().groupBy(*FLAGS).agg(F.count(F.lit(1)).cast("long").alias("trips"))


@register("c11_typed_clean_trips", with_star("""
SELECT trip_hash, vendor_id, pickup_datetime_local, dropoff_datetime_local, trip_duration_seconds,
       pickup_location_id, dropoff_location_id, passenger_count, trip_distance_miles, fare_amount_usd, total_amount_usd
FROM clean"""))
def c11_typed(spark, d):
    return star(spark, d).clean().select(
        "trip_hash", "vendor_id", "pickup_datetime_local", "dropoff_datetime_local", "trip_duration_seconds",
        "pickup_location_id", "dropoff_location_id", "passenger_count", "trip_distance_miles", "fare_amount_usd",
        "total_amount_usd")


@register("c19_trip_zone_map", with_star("SELECT * FROM zone_map"))
def c19_zone_map(spark, d):
    return star(spark, d).zone_map()


@register("c20_trip_weather_map", with_star("SELECT * FROM weather_map"))
def c20_weather_map(spark, d):
    return star(spark, d).weather_map()


@register("c15_weather_hourly", with_star("SELECT * EXCLUDE (source_system) FROM weather"))
def c15_weather(spark, d):
    return star(spark, d).weather().drop("source_system")


@register("c24_dim_date", with_star("SELECT * FROM dim_date"))
def c24_dim_date(spark, d):
    return star(spark, d).dim_date()


@register("c25_dim_hour", with_star("""
SELECT h.*, CAST(COUNT(c.trip_hash) AS BIGINT) AS pickups FROM dim_hour h LEFT JOIN clean c ON hour(c.pickup_datetime_local) = h.hour_of_day
GROUP BY ALL"""))
def c25_dim_hour(spark, d):
    """The hour dimension with the clean trips that each hour's key resolves."""
    s = star(spark, d)
    used = s.clean().groupBy(F.hour("pickup_datetime_local").alias("used_hour")).agg(F.count(F.lit(1)).alias("pickups"))
    j = s.dim_hour().join(used, F.col("hour_of_day") == F.col("used_hour"), "left").drop("used_hour")
    return j.withColumn("pickups", F.coalesce("pickups", F.lit(0)).cast("long"))


@register("c26_dim_zone", with_star("SELECT * FROM dim_zone"))
def c26_dim_zone(spark, d):
    return star(spark, d).dim_zone().drop("source_system")


@register("c27_dim_weather_classification", with_star("SELECT * FROM dim_wc"))
def c27_dim_wc(spark, d):
    return star(spark, d).dim_weather_classification()


@register("c29_weather_fact", with_star("""
SELECT weather_observation_key, observation_date_key, observation_hour_key, weather_classification_key,
       observation_timestamp_utc, observation_timestamp_local, temperature_2m_c, precipitation_mm, weather_code,
       precipitation_band
FROM weather_fact"""))
def c29_weather_fact(spark, d):
    return star(spark, d).weather_fact().select(
        "weather_observation_key", "observation_date_key", "observation_hour_key", "weather_classification_key",
        "observation_timestamp_utc", "observation_timestamp_local", "temperature_2m_c", "precipitation_mm",
        "weather_code", "precipitation_band")


FACT_COLS = ["trip_key", "pickup_date_key", "dropoff_date_key", "pickup_hour_key", "dropoff_hour_key",
             "pickup_zone_key", "dropoff_zone_key", "pickup_weather_classification_key", "vendor_id",
             "pickup_datetime_local", "dropoff_datetime_local", "pickup_timestamp_utc", "dropoff_timestamp_utc",
             "pickup_location_id", "dropoff_location_id", "passenger_count", "trip_distance_miles",
             "fare_amount_usd", "total_amount_usd", "trip_duration_seconds", "trip_count",
             "dropoff_before_pickup_flag", "negative_trip_distance_flag", "negative_fare_amount_flag",
             "negative_total_amount_flag", "zero_distance_high_fare_flag", "passenger_count_zero_flag",
             "passenger_count_over_8_flag", "pickup_zone_match_status", "dropoff_zone_match_status",
             "weather_match_status"]


@register("c30_trip_fact", with_star("SELECT " + ", ".join(FACT_COLS) + " FROM fact"))
def c30_fact(spark, d):
    return star(spark, d).trip_fact().select(*FACT_COLS)


# --- C44/C45/N2: series checks --------------------------------------------------------------------------------

@register("c44_series_continuity", with_star("""
, s AS (SELECT coordinate_id, weather_model, observation_timestamp_utc AS u, observation_timestamp_local AS lt,
               date_sub('second', LAG(observation_timestamp_utc) OVER w, observation_timestamp_utc) AS step,
               observation_timestamp_local < LAG(observation_timestamp_local) OVER w AS back
        FROM weather WINDOW w AS (PARTITION BY coordinate_id, weather_model ORDER BY observation_timestamp_utc))
SELECT coordinate_id, weather_model, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(COUNT_IF(step IS NOT NULL AND step <> 3600) AS BIGINT) AS gaps,
       CAST(COUNT_IF(step = 0) AS BIGINT) AS duplicate_times,
       CAST(COUNT_IF(COALESCE(back, false)) AS BIGINT) AS local_order_violations,
       MIN(u) AS first_utc, MAX(u) AS last_utc
FROM s GROUP BY coordinate_id, weather_model""".replace("\n, s AS", ",\ns AS", 1)))
def c44_continuity(spark, d):
    w = star(spark, d).weather()
    return continuity_report(w, ["coordinate_id", "weather_model"], "observation_timestamp_utc",
                             "observation_timestamp_local")


@register("c45_expected_series_volume", f"""
WITH h AS (SELECT CAST(date_trunc('hour', ts) AS DATE) AS day, COUNT(DISTINCT date_trunc('hour', ts)) AS n
           FROM {oracle.OBSERVED} GROUP BY coordinate_id, 1)
SELECT day AS requested_start_date, CAST(n AS INTEGER) AS hourly_values, CAST(24 AS BIGINT) AS expected_values,
       n = 24 AS volume_ok FROM h""")
def c45_volume(spark, d):
    from lakekit.operators.series import expected_hours
    docs = star(spark, d).weather_documents()
    return docs.select("requested_start_date", F.size("hourly.time").alias("hourly_values"),
                       expected_hours("requested_start_date", "requested_end_date").alias("expected_values")) \
        .withColumn("volume_ok", F.col("hourly_values") == F.col("expected_values"))


@register("n2_posexplode_hourly_positions", f"""
SELECT CAST(date_trunc('hour', ts) AS DATE) AS requested_start_date,
       CAST(dense_rank() OVER (PARTITION BY coordinate_id, CAST(date_trunc('hour', ts) AS DATE) ORDER BY date_trunc('hour', ts)) - 1
            AS INTEGER) AS pos,
       strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') AS hourly_time
FROM {oracle.OBSERVED} GROUP BY coordinate_id, date_trunc('hour', ts)""")
def n2_pos(spark, d):
    docs = star(spark, d).weather_documents()
    return explode_parallel_arrays(docs, {"hourly_time": "hourly.time"}, keep=["requested_start_date"], position="pos")


# --- C43/C37/C49: spot check, build reconciliation, dashboard queries -----------------------------------------

@register("c43_q1_spot_check", with_star(f""",
q1 AS ({oracle.Q1_AGG}),
target AS (SELECT * FROM q1 ORDER BY trip_count DESC, pickup_date DESC, pickup_hour DESC,
           pickup_zone_name DESC NULLS LAST LIMIT 1),
recomputed AS (
  SELECT CAST(COUNT(*) AS BIGINT) AS n FROM elig f
  JOIN target t ON CAST(f.pickup_datetime_local AS DATE) = t.pickup_date AND hour(f.pickup_datetime_local) = t.pickup_hour
  LEFT JOIN dim_zone z ON f.pickup_zone_key = z.zone_key
  WHERE z.zone_name IS NOT DISTINCT FROM t.pickup_zone_name)
SELECT t.pickup_date, t.pickup_hour, t.pickup_zone_name, t.trip_count AS published_trips,
       r.n AS recomputed_trips, t.trip_count = r.n AS spot_check_passed
FROM target t CROSS JOIN recomputed r"""))
def c43_spot(spark, d):
    from lakekit.plans.analytics import q1_activity_by_time_and_zone
    s = star(spark, d)
    fact, zones = s.trip_fact(), s.dim_zone()
    q1 = q1_activity_by_time_and_zone(fact, s.dim_date(), s.dim_hour(), zones)
    target = (q1.orderBy(F.col("trip_count").desc(), F.col("pickup_date").desc(), F.col("pickup_hour").desc(),
                         F.col("pickup_zone_name").desc_nulls_last()).limit(1)
              .select("pickup_date", "pickup_hour", "pickup_zone_name", "trip_count"))
    f = fact.join(zones.select("zone_key", "zone_name"), fact["pickup_zone_key"] == zones["zone_key"], "left")
    j = f.join(F.broadcast(target),  # the one target cell
               (F.to_date("pickup_datetime_local") == F.col("pickup_date"))
               & (F.hour("pickup_datetime_local") == F.col("pickup_hour"))
               & F.col("zone_name").eqNullSafe(F.col("pickup_zone_name")))
    r = j.agg(F.count(F.lit(1)).cast("long").alias("recomputed_trips"))
    return target.crossJoin(r).select(
        "pickup_date", "pickup_hour", "pickup_zone_name", F.col("trip_count").alias("published_trips"),
        "recomputed_trips", (F.col("trip_count") == F.col("recomputed_trips")).alias("spot_check_passed"))


@register("c37_q1_build_reconciliation", with_star(f""",
q1 AS ({oracle.Q1_AGG})
SELECT CAST((SELECT SUM(trip_count) FROM q1) AS BIGINT) AS analytics_trip_count,
       CAST((SELECT COUNT(*) FROM q1) AS BIGINT) AS result_rows,
       CAST((SELECT SUM(trip_count) FROM fact) AS BIGINT) AS gold_trip_count"""))
def c37_recon(spark, d):
    from lakekit.plans.analytics import build_reconciliation, q1_activity_by_time_and_zone
    s = star(spark, d)
    q1 = q1_activity_by_time_and_zone(s.trip_fact(), s.dim_date(), s.dim_hour(), s.dim_zone())
    return build_reconciliation(q1, s.trip_fact())


def _reported(build: str, **measures: str) -> str:
    return "\nUNION ALL ".join(f"SELECT '{build}' AS build, '{m}' AS measure, CAST(({q}) AS DECIMAL(38,2)) AS value"
                               for m, q in measures.items())


_GOLD = "SELECT SUM(trip_count) FROM fact"


@register("c37_build_reports", "WITH " + oracle.ANALYTICS_CTES + "\n" + "\nUNION ALL ".join([
    _reported("weather fact", silver_rows="SELECT COUNT(*) FROM weather", gold_rows="SELECT COUNT(*) FROM weather_fact",
              unresolved_classification_rows="SELECT COUNT(*) FROM weather_fact WHERE weather_classification_key IS NULL"),
    _reported("trip fact", silver_clean_rows="SELECT COUNT(*) FROM decided WHERE collision_count = 1", gold_trip_count=_GOLD,
              silver_fare_total="SELECT SUM(fare_amount_usd) FROM decided WHERE collision_count = 1",
              gold_fare_total="SELECT SUM(fare_amount_usd) FROM fact",
              null_pickup_zone_keys="SELECT COUNT(*) FROM fact WHERE pickup_zone_key IS NULL",
              weather_no_match_rows="SELECT COUNT(*) FROM fact WHERE weather_match_status = 'no_match'"),
    _reported("q1", analytics_trip_count="SELECT SUM(trip_count) FROM q1_result", gold_trip_count=_GOLD,
              result_rows="SELECT COUNT(*) FROM q1_result",
              rows_with_unresolved_zone="SELECT COUNT(*) FROM q1_result WHERE pickup_zone_name IS NULL"),
    _reported("q2", weather_attributed_trips="SELECT SUM(trip_count) FROM q2_result", gold_trip_count=_GOLD,
              covered_hours="SELECT SUM(covered_hours) FROM q2_result", gold_weather_hours="SELECT COUNT(*) FROM weather_fact"),
    _reported("q3", analytics_pickups="SELECT SUM(pickup_count) FROM q3_result",
              analytics_dropoffs="SELECT SUM(dropoff_count) FROM q3_result", gold_trip_count=_GOLD,
              zones_with_no_activity="SELECT COUNT(*) FROM q3_result WHERE pickup_count + dropoff_count = 0"),
    _reported("q4", analytics_trip_count="SELECT SUM(trip_count) FROM q4_result", gold_trip_count=_GOLD,
              result_rows="SELECT COUNT(*) FROM q4_result",
              rows_with_unresolved_borough="SELECT COUNT(*) FROM q4_result WHERE pickup_borough IS NULL")]))
def c37_reports(spark, d):
    """The totals that every fact and question build reports next to those of the table it was built from."""
    from lakekit.plans.analytics import build_reports
    from lakekit.plans.checks import gate_tables
    return build_reports(gate_tables(star(spark, d)))


@register("c49_dashboard_kpis_from_totals", with_star(f"""
SELECT CAST(SUM(trip_count) AS BIGINT) AS total_trips,
  {sround("CAST(SUM(CASE WHEN fare_eligible THEN fare_amount_usd END) AS DOUBLE) / CAST(NULLIF(COUNT_IF(fare_eligible), 0) AS DOUBLE)", 2)}
    AS avg_fare_amount_usd,
  {sround("CAST(SUM(CASE WHEN distance_eligible THEN trip_distance_miles END) AS DOUBLE) / CAST(NULLIF(COUNT_IF(distance_eligible), 0) AS DOUBLE)", 3)}
    AS avg_trip_distance_miles
FROM elig"""))
def c49_kpis(spark, d):
    from lakekit.operators.metrics import eligible_count, eligible_sum, safe_ratio
    from lakekit.operators.star import eligibility
    e = eligibility()
    f = star(spark, d).trip_fact()
    g = f.agg(F.sum("trip_count").cast("long").alias("total_trips"),
              eligible_sum("fare_amount_usd", e["fare_eligible"]).alias("__f"),
              eligible_count(e["fare_eligible"]).alias("__nf"),
              eligible_sum("trip_distance_miles", e["distance_eligible"]).alias("__d"),
              eligible_count(e["distance_eligible"]).alias("__nd"))
    return g.select("total_trips", safe_ratio("__f", "__nf", 2).alias("avg_fare_amount_usd"),
                    safe_ratio("__d", "__nd", 3).alias("avg_trip_distance_miles"))


@register("c49_dashboard_day_band_heatmap", with_star(f""",
q1 AS ({oracle.Q1_AGG})
SELECT pickup_day_of_week, pickup_time_of_day_band, CAST(SUM(trip_count) AS BIGINT) AS trips
FROM q1 GROUP BY ALL"""))
def c49_heatmap(spark, d):
    from lakekit.plans.analytics import q1_activity_by_time_and_zone
    s = star(spark, d)
    q1 = q1_activity_by_time_and_zone(s.trip_fact(), s.dim_date(), s.dim_hour(), s.dim_zone())
    return q1.groupBy("pickup_day_of_week", "pickup_time_of_day_band").agg(F.sum("trip_count").cast("long").alias("trips"))


@register("c49_dashboard_net_arrivals_top10", with_star("""
, p AS (SELECT pickup_zone_key AS k, COUNT(*) AS n FROM fact GROUP BY 1),
d AS (SELECT dropoff_zone_key AS k, COUNT(*) AS n FROM fact GROUP BY 1)
SELECT z.zone_name, CAST(COALESCE(d.n, 0) - COALESCE(p.n, 0) AS BIGINT) AS net_arrivals
FROM dim_zone z LEFT JOIN p ON z.zone_key = p.k LEFT JOIN d ON z.zone_key = d.k
ORDER BY net_arrivals DESC, z.zone_name LIMIT 10""".replace("\n, p AS", ",\np AS", 1)))
def c49_net(spark, d):
    from lakekit.plans.analytics import q3_mobility_patterns_by_zone
    s = star(spark, d)
    q3 = q3_mobility_patterns_by_zone(s.trip_fact(), s.dim_zone())
    return q3.select("zone_name", "net_arrivals").orderBy(F.col("net_arrivals").desc(), "zone_name").limit(10)
