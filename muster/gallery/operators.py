"""One query per operator, over the supplied tables at a fixed run date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import dates, predicates, text
from muster.gallery.registry import Registry
from muster.operators import aggregates, filters, joins, lookups, ranks
from muster.operators.rules import Rule, apply_rules
from muster.operators.scorecard import COUNT, INT_AVG, SUM, Kpi, scorecard
from muster.sources import snapshots
from muster.sources.tables import Catalog, shared_folder

registry = Registry()
query = registry.query

RUN_DATE = dt.date(1998, 1, 15)


# --- filters -------------------------------------------------------------------------------------

@query("planned_next_60d", """
    SELECT DATE '1998-01-15' AS snapshot_date, o_orderkey, o_custkey, o_orderdate, o_orderpriority, c_name, n_name
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    WHERE o_orderdate >= DATE '1998-01-15' AND o_orderdate < DATE '1998-03-17'""")
def planned_next_60d(t: Catalog) -> DataFrame:
    return (
        filters.within_days(t["orders"], "o_orderdate", RUN_DATE, after=60)
        .join(t["customer"].withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left")
        .join(t["nation"].withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left")
        .select(F.lit(RUN_DATE).alias("snapshot_date"), "o_orderkey", "o_custkey", "o_orderdate",
                "o_orderpriority", "c_name", "n_name")
    )


@query("last_30_days", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-12-16' AND DATE '1998-01-15'""")
def last_30_days(t: Catalog) -> DataFrame:
    return filters.within_days(t["orders"], "o_orderdate", RUN_DATE, before=30).select("o_orderkey", "o_orderdate")


def _period(t: Catalog, kind: str, **more) -> DataFrame:
    return filters.in_period(t["orders"], "o_orderdate", RUN_DATE, kind, **more).select("o_orderkey", "o_orderdate")


@query("month_to_date", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 1""")
def month_to_date(t: Catalog) -> DataFrame:
    return _period(t, "month")


@query("previous_month", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 12""")
def previous_month(t: Catalog) -> DataFrame:
    return _period(t, "previous_month")


@query("year_onward", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) >= 1998")
def year_onward(t: Catalog) -> DataFrame:
    return _period(t, "year_on")


@query("since_fixed_date", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= DATE '1997-06-01' AND o_orderdate <= DATE '1997-12-01'""")
def since_fixed_date(t: Catalog) -> DataFrame:
    return _period(t, "since_to_previous_month", since=dt.date(1997, 6, 1))


@query("null_tolerant_filter", """
    SELECT c_custkey, o_orderkey, o_orderstatus
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    WHERE (o_orderstatus IS NULL OR o_orderstatus <> 'F')
      AND CASE WHEN o_orderstatus = 'P' AND c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END = 0""")
def null_tolerant_filter(t: Catalog) -> DataFrame:
    both = t["customer"].join(t["orders"].withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    kept = filters.not_equal_or_null(both, "o_orderstatus", "F")
    kept = filters.exclude_when(kept, (F.col("o_orderstatus") == "P") & (F.col("c_mktsegment") == "BUILDING"))
    return kept.select("c_custkey", "o_orderkey", "o_orderstatus")


@query("membership", """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (1, 2, 3)""")
def membership(t: Catalog) -> DataFrame:
    return (
        t["customer"]
        .where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & ~F.col("c_nationkey").isin(1, 2, 3))
        .select("c_custkey", "c_mktsegment")
    )


@query("latest_snapshot", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
    WHERE CAST(l_shipdate AS DATE) = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)""")
def latest_snapshot(t: Catalog) -> DataFrame:
    return filters.latest_snapshot(t["lineitem"], "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


@query("valid_on_date", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE (l_returnflag = 'N' OR CAST(l_shipdate AS DATE) >= DATE '1998-01-15')
      AND CAST(o_orderdate AS DATE) <= DATE '1998-01-15'""")
def valid_on_date(t: Catalog) -> DataFrame:
    lines = t["lineitem"].join(t["orders"].withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    end = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))
    return lines.where(predicates.valid_at(F.col("o_orderdate"), end, RUN_DATE)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query("remap_codes", """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'TOP' ELSE o_orderpriority END AS priority,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'merged' ELSE o_orderstatus END AS label
    FROM orders""")
def remap_codes(t: Catalog) -> DataFrame:
    rows = t["orders"].select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("label"))
    return filters.remap(rows, "priority", ["1-URGENT", "2-HIGH"], {"priority": "TOP", "label": "merged"})


# --- joins ---------------------------------------------------------------------------------------

@query("coalesced_key_join", """
    SELECT c_custkey, n_nationkey, n_name
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
    JOIN nation ON n_nationkey = coalesce(CASE WHEN c_acctbal >= 0 THEN c_nationkey END, s_nationkey)""")
def coalesced_key_join(t: Catalog) -> DataFrame:
    both = t["customer"].join(t["supplier"].withColumnRenamed("s_suppkey", "c_custkey"), "c_custkey", "left")
    own = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    return joins.join_coalesced(both, t["nation"], [own, "s_nationkey"], "n_nationkey").select(
        "c_custkey", "n_nationkey", "n_name"
    )


@query("filtered_left_join", """
    SELECT c_custkey, o_orderkey, o_orderdate FROM customer
    LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'""")
def filtered_left_join(t: Catalog) -> DataFrame:
    orders = t["orders"].withColumnRenamed("o_custkey", "c_custkey")
    where = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return joins.join_filtered(t["customer"], orders, "c_custkey", where).select("c_custkey", "o_orderkey", "o_orderdate")


@query("exclude_matching", """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
      SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def exclude_matching(t: Catalog) -> DataFrame:
    filled = t["orders"].where("o_orderstatus = 'F'")
    return joins.exclude_matching(
        t["customer"].select("c_custkey", "c_name"), filled.select(F.col("o_custkey").alias("c_custkey")), "c_custkey"
    )


@query("exclude_not_in", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (
      SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def exclude_not_in(t: Catalog) -> DataFrame:
    returned = t["lineitem"].where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.exclude_not_in(t["orders"].select("o_orderkey", "o_custkey"), returned, "o_orderkey")


@query("exclude_not_in_with_null", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (
      SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END FROM lineitem)""")
def exclude_not_in_with_null(t: Catalog) -> DataFrame:
    holed = t["lineitem"].select(F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("o_orderkey"))
    return joins.exclude_not_in(t["orders"].select("o_orderkey", "o_custkey"), holed, "o_orderkey")


@query("keep_matching", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
      SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1)""")
def keep_matching(t: Catalog) -> DataFrame:
    several = ranks.multi_group_entities(t["orders"], "o_custkey", "o_orderpriority")
    return joins.keep_matching(
        t["customer"].select("c_custkey", "c_name"), several.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"
    )


@query("range_lookup", """
    WITH spans AS (
      SELECT o_custkey, o_orderkey, o_orderdate AS first_day, o_orderpriority,
             CASE WHEN o_orderstatus = 'O' THEN DATE '2001-12-31' ELSE CAST(o_orderdate AS DATE) + 90 END AS last_day
      FROM orders),
    lines AS (
      SELECT row_number() OVER () AS line, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_custkey
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    ranked AS (
      SELECT l.*, s.o_orderkey AS span_order, s.o_orderpriority AS span_priority,
             row_number() OVER (PARTITION BY line
                                ORDER BY s.first_day DESC NULLS LAST, s.o_orderkey DESC NULLS LAST) AS rn
      FROM lines l LEFT JOIN spans s
        ON s.o_custkey = l.o_custkey AND l.l_shipdate BETWEEN s.first_day AND s.last_day)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, span_order, span_priority FROM ranked WHERE rn = 1""")
def range_lookup(t: Catalog) -> DataFrame:
    orders = t["orders"]
    lines = t["lineitem"].join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "o_custkey")
    end = F.when(F.col("o_orderstatus") == "O", F.lit(dt.date(2001, 12, 31))).otherwise(
        F.date_add(F.to_date("o_orderdate"), 90)
    )
    return lookups.range_lookup(
        lines, orders, "o_custkey", "l_shipdate", F.col("o_orderdate"), end, F.col("o_orderdate"),
        {"span_order": "o_orderkey", "span_priority": "o_orderpriority"}, tie="o_orderkey",
    ).drop("o_custkey")


@query("asof_latest_before", """
    WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    ranked AS (
      SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, c.ts AS click_ts,
             row_number() OVER (PARTITION BY p.event_id ORDER BY c.ts DESC NULLS LAST, c.event_id DESC NULLS LAST) AS rn
      FROM p LEFT JOIN events c ON c.user_id = p.user_id AND c.event_type = 'click' AND c.ts <= p.ts)
    SELECT event_id, user_id, ts, click_id, click_ts FROM ranked WHERE rn = 1""")
def asof_latest_before(t: Catalog) -> DataFrame:
    events = t["events"]
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return lookups.asof_lookup(
        purchases, clicks, "user_id", "ts", "ts", {"click_id": "event_id", "click_ts": "ts"}, tie="event_id"
    )


@query("asof_by_day", """
    WITH p AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase'),
    c AS (
      SELECT user_id, CAST(ts AS DATE) AS d, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY 1, 2),
    ranked AS (
      SELECT p.event_id, p.user_id, c.view_id,
             row_number() OVER (PARTITION BY p.event_id ORDER BY c.d DESC NULLS LAST) AS rn
      FROM p LEFT JOIN c ON c.user_id = p.user_id AND c.d <= p.d)
    SELECT event_id, user_id, view_id FROM ranked WHERE rn = 1""")
def asof_by_day(t: Catalog) -> DataFrame:
    events = t["events"]
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    found = lookups.asof_lookup(
        purchases, views, "user_id", "ts", "ts", {"view_id": "event_id"}, tie="event_id", by_day=True
    )
    return found.drop("ts")


@query("latest_unbounded", """
    SELECT c_custkey, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders
                       WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS last_p
    FROM customer""")
def latest_unbounded(t: Catalog) -> DataFrame:
    orders = t["orders"].where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day")
    )
    return lookups.latest_lookup(t["customer"].select("c_custkey"), orders, "c_custkey", F.col("day"), {"last_p": "day"})


@query("contiguous_predecessor", """
    WITH seq AS (
      SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
             coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 10 DAY END,
                      o_orderdate + INTERVAL 20 DAY) AS ended
      FROM orders)
    SELECT a.o_orderkey, a.o_custkey, a.o_orderdate, b.o_orderkey AS previous_order, b.o_orderdate AS previous_date
    FROM seq a LEFT JOIN seq b ON b.o_custkey = a.o_custkey AND b.rn = a.rn - 1
      AND b.o_orderstatus = a.o_orderstatus AND date_diff('day', b.ended, a.o_orderdate) <= 2""")
def contiguous_predecessor(t: Catalog) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    end = F.coalesce(
        F.when(F.col("o_orderpriority") != "5-LOW", dates.plus_days(F.col("o_orderdate"), 10)),
        dates.plus_days(F.col("o_orderdate"), 20),
    )
    return lookups.contiguous_predecessor(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus", "o_orderdate", end, 2,
        {"previous_order": "o_orderkey", "previous_date": "o_orderdate"},
    ).drop("o_orderstatus", "o_orderpriority")


@query("any_link_match", """
    WITH users AS (SELECT DISTINCT user_id FROM events),
    linked AS (
      SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100
      UNION SELECT a.user_id FROM events a JOIN events b ON a.user_id = b.user_id AND CAST(a.ts AS DATE) = CAST(b.ts AS DATE)
            WHERE a.event_type = 'signup' AND b.event_type = 'error'
      UNION SELECT user_id FROM events GROUP BY user_id HAVING max(CASE WHEN event_type = 'view' THEN ts END) >= TIMESTAMP '2024-01-30')
    SELECT u.user_id, CASE WHEN l.user_id IS NULL THEN 'Missing' ELSE 'Signed' END AS status
    FROM users u LEFT JOIN linked l ON l.user_id = u.user_id""")
def any_link_match(t: Catalog) -> DataFrame:
    events = t["events"].withColumn("day", F.to_date("ts"))
    of = {k: events.where(F.col("event_type") == k) for k in ("purchase", "signup", "error", "view")}
    users = events.select("user_id").distinct()
    links = [
        of["purchase"].where("value > 100"),
        joins.keep_matching(of["signup"], of["error"].select("user_id", "day"), ["user_id", "day"]),
        of["view"].groupBy("user_id").agg(F.max("ts").alias("last")).where(
            F.col("last") >= F.lit(dt.date(2024, 1, 30))
        ),
    ]
    linked = joins.any_link_match(users, "user_id", links)
    return joins.flag_presence(users, linked, "user_id", "status", "Signed", "Missing")


@query("next_group_event", """
    WITH h AS (
      SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate,
             dense_rank() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC) AS rank_in_group,
             dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rank_by_date
      FROM orders)
    SELECT DISTINCT b.o_orderkey, a.o_custkey, a.o_orderpriority AS left_group, b.o_orderpriority AS new_group,
           CAST(date_diff('day', a.o_orderdate, b.o_orderdate) AS INTEGER) AS gap_days
    FROM h a JOIN h b ON b.o_custkey = a.o_custkey AND b.rank_by_date = a.rank_by_date - 1
    WHERE a.rank_in_group = 1""")
def next_group_event(t: Catalog) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    last = ranks.latest_rows(orders, ["o_custkey", "o_orderpriority"], "o_orderdate")
    pairs = lookups.next_event(
        orders, "o_custkey", "o_orderdate",
        {"new_order": "o_orderkey", "new_group": "o_orderpriority", "new_date": "o_orderdate"}, of=last,
    )
    return pairs.select(
        F.col("new_order").alias("o_orderkey"), "o_custkey", F.col("o_orderpriority").alias("left_group"), "new_group",
        dates.day_gap(F.col("o_orderdate"), F.col("new_date")).alias("gap_days"),
    ).distinct()


@query("date_dimension_join", """
    WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
    k AS (SELECT date, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key FROM d)
    SELECT o_orderkey, o_orderdate, date_key FROM orders LEFT JOIN k ON date_diff('day', k.date, o_orderdate) = 0""")
def date_dimension_join(t: Catalog) -> DataFrame:
    days = t["lineitem"].select(F.to_date("l_shipdate").alias("date")).distinct()
    keyed = days.withColumn("date_key", F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date"))
    return joins.join_on_date(t["orders"], keyed, "o_orderdate", "date").select("o_orderkey", "o_orderdate", "date_key")


@query("role_playing_join", """
    WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem),
    s AS (SELECT o_orderkey, o_orderpriority AS category, o_orderstatus AS remark FROM orders)
    SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, x.l_suppkey,
           coalesce(a.category, b.category, c.category) AS category, coalesce(a.remark, b.remark, c.remark) AS remark
    FROM x
    LEFT JOIN s a ON a.o_orderkey = x.l_orderkey AND a.category = '1-URGENT'
    LEFT JOIN s b ON b.o_orderkey = x.l_orderkey AND b.remark = 'P'
    LEFT JOIN s c ON c.o_orderkey = x.l_orderkey AND c.category IN ('5-LOW', '2-HIGH')""")
def role_playing_join(t: Catalog) -> DataFrame:
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    marks = t["orders"].select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("remark"),
    )
    roles = {
        "urgent": F.col("category") == "1-URGENT",
        "partial": F.col("remark") == "P",
        "other": F.col("category").isin("5-LOW", "2-HIGH"),
    }
    return joins.coalesce_roles(lines, marks, "l_orderkey", roles, ["category", "remark"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "category", "remark"
    )


@query("union_sentinel", """
    SELECT DISTINCT c_mktsegment AS segment_id, c_mktsegment AS segment FROM customer
    UNION SELECT 'UNKNOWN', 'UNKNOWN'""")
def union_sentinel(t: Catalog) -> DataFrame:
    segments = t["customer"].select(F.col("c_mktsegment").alias("segment_id"), F.col("c_mktsegment").alias("segment"))
    return joins.union_sentinel(segments, {"segment_id": "UNKNOWN", "segment": "UNKNOWN"})


# --- aggregates and scorecard --------------------------------------------------------------------

@query("status_counts", """
    SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS completed,
           count(CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END) AS pending
    FROM orders GROUP BY o_custkey""")
def status_counts(t: Catalog) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return aggregates.count_by_status(t["orders"], ["o_custkey"], {"completed": done, "pending": ~done}, "o_orderkey")


@query("sum_of_sums", """
    SELECT c_custkey, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END) + sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS BIGINT) AS total
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def sum_of_sums(t: Catalog) -> DataFrame:
    rows = t["customer"].join(t["orders"].withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    marked = rows.withColumns({s: F.when(F.col("o_orderstatus") == s, F.lit(1)) for s in ("P", "F")})
    return marked.groupBy("c_custkey").agg(aggregates.sum_of_sums("P", "F").alias("total"))


@query("int_average", """
    SELECT o_custkey, CAST(trunc(CAST(sum(date_diff('day', o_orderdate, l_shipdate)) AS DOUBLE) / count(*)) AS BIGINT) AS mean_days
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey""")
def int_average(t: Catalog) -> DataFrame:
    lines = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate").join(t["orders"], "o_orderkey")
    days = lines.select("o_custkey", dates.day_gap(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"))
    return days.groupBy("o_custkey").agg(aggregates.int_avg("days").alias("mean_days"))


@query("segment_scorecard", """
    WITH groups AS (
      SELECT DISTINCT c_mktsegment AS group_id, lower(c_mktsegment) AS group_name FROM customer
      UNION SELECT 'UNKNOWN', 'unknown'),
    o AS (SELECT orders.*, c_mktsegment, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT DATE '1998-01-15' AS record_date, group_id, group_name,
      (SELECT count(DISTINCT o_custkey) FROM o WHERE c_mktsegment = group_id) AS buyers,
      (SELECT count(DISTINCT o_custkey) FROM o WHERE c_mktsegment = group_id AND o_orderstatus = 'F') AS finished_buyers,
      (SELECT count(DISTINCT o_custkey) FROM o WHERE c_mktsegment = group_id
         AND CAST(o_orderdate AS DATE) BETWEEN DATE '1997-12-16' AND DATE '1998-01-15') AS recent_buyers,
      (SELECT count(DISTINCT c_nationkey) FROM o WHERE c_mktsegment = group_id AND o_orderpriority = '1-URGENT') AS urgent_nations,
      (SELECT count(o_orderkey) FROM o WHERE c_mktsegment = group_id) AS order_count,
      (SELECT count(o_orderkey) FROM o WHERE c_mktsegment = group_id AND o_orderstatus = 'P') AS pending_orders,
      (SELECT CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) FROM o WHERE c_mktsegment = group_id) AS total_cents,
      (SELECT CAST(trunc(CAST(sum(date_diff('day', o_orderdate, DATE '2002-01-01')) AS DOUBLE) / count(*)) AS BIGINT)
         FROM o WHERE c_mktsegment = group_id) AS mean_age_days,
      (SELECT count(DISTINCT c_custkey) FROM customer WHERE lower(c_mktsegment) = group_name AND c_acctbal < 0) AS in_debt,
      (SELECT count(DISTINCT c_custkey) FROM customer WHERE lower(c_mktsegment) = group_name) AS members,
      CAST(NULL AS BIGINT) AS reserved
    FROM groups""")
def segment_scorecard(t: Catalog) -> DataFrame:
    groups = joins.union_sentinel(
        t["customer"].select(F.col("c_mktsegment").alias("group_id"), F.lower("c_mktsegment").alias("group_name")),
        {"group_id": "UNKNOWN", "group_name": "unknown"},
    ).select(F.lit(RUN_DATE).alias("record_date"), "group_id", "group_name")
    orders = t["orders"].join(
        t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey"), "o_custkey"
    ).withColumns({
        "cents": F.round(F.col("o_totalprice") * 100).cast("bigint"),
        "age": dates.day_gap(F.col("o_orderdate"), F.lit(dt.date(2002, 1, 1))),
    })
    people = t["customer"].withColumn("name", F.lower("c_mktsegment"))
    recent = filters.between_days("o_orderdate", RUN_DATE - dt.timedelta(days=30), RUN_DATE)

    def order_kpi(name, value, how="count_distinct", where=None):
        return Kpi(name, orders, "c_mktsegment", value, how, where)

    return scorecard(groups, [
        order_kpi("buyers", "o_custkey"),
        order_kpi("finished_buyers", "o_custkey", where=F.col("o_orderstatus") == "F"),
        order_kpi("recent_buyers", "o_custkey", where=recent),
        order_kpi("urgent_nations", "c_nationkey", where=F.col("o_orderpriority") == "1-URGENT"),
        order_kpi("order_count", "o_orderkey", COUNT),
        order_kpi("pending_orders", "o_orderkey", COUNT, F.col("o_orderstatus") == "P"),
        order_kpi("total_cents", "cents", SUM),
        order_kpi("mean_age_days", "age", INT_AVG),
        Kpi("in_debt", people, "name", "c_custkey", where=F.col("c_acctbal") < 0, group_key="group_name"),
        Kpi("members", people, "name", "c_custkey", group_key="group_name"),
    ], constants=["reserved"])


# --- ranks ---------------------------------------------------------------------------------------

@query("latest_with_ties", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
    QUALIFY dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) = 1""")
def latest_with_ties(t: Catalog) -> DataFrame:
    return ranks.latest_rows(t["lineitem"], ["l_orderkey"], "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


@query("earliest_with_ties", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
      SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS back FROM lineitem)
    QUALIFY dense_rank() OVER (PARTITION BY l_orderkey ORDER BY back ASC NULLS FIRST) = 1""")
def earliest_with_ties(t: Catalog) -> DataFrame:
    lines = t["lineitem"].withColumn("back", F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")))
    return ranks.latest_rows(lines, ["l_orderkey"], "back", earliest=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query("first_row_per_entity", """
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def first_row_per_entity(t: Catalog) -> DataFrame:
    rows = t["orders"].select("o_custkey", "o_orderkey", "o_orderdate")
    return ranks.first_row(rows, ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc())


@query("dense_rank_all", """
    SELECT o_orderkey, o_custkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rank_by_date
    FROM orders""")
def dense_rank_all(t: Catalog) -> DataFrame:
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return ranks.rank_within(rows, ["o_custkey"], "o_orderdate", "rank_by_date").drop("o_orderdate")


@query("row_number_all", """
    SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders""")
def row_number_all(t: Catalog) -> DataFrame:
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return ranks.number_within(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "rn", descending=True).drop("o_orderdate")


@query("rank_history", """
    SELECT o_orderkey, o_custkey,
      dense_rank() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC) AS rank_in_group,
      dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rank_by_date,
      dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC) AS rank_of_group
    FROM orders""")
def rank_history(t: Catalog) -> DataFrame:
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return ranks.rank_history(rows, "o_custkey", "o_orderpriority", "o_orderdate").drop("o_orderpriority", "o_orderdate")


@query("next_status_after", """
    WITH anchor AS (SELECT user_id, min(CAST(ts AS DATE)) AS d FROM events WHERE event_type = 'signup' GROUP BY user_id),
    later AS (
      SELECT e.user_id, e.event_type, dense_rank() OVER (PARTITION BY e.user_id ORDER BY e.ts) AS rn
      FROM events e JOIN anchor a ON a.user_id = e.user_id WHERE CAST(e.ts AS DATE) > a.d),
    nxt AS (SELECT DISTINCT user_id, event_type AS next_status FROM later WHERE rn = 1)
    SELECT a.user_id, n.next_status FROM anchor a LEFT JOIN nxt n ON n.user_id = a.user_id
    WHERE n.next_status IS NULL OR n.next_status NOT IN ('error', 'view')""")
def next_status_after(t: Catalog) -> DataFrame:
    events = t["events"]
    anchors = events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("signed_up"))
    following = lookups.next_status_after(events, anchors, ["user_id"], "ts", "event_type", "signed_up", "next_status")
    out = anchors.select("user_id").distinct().join(following, "user_id", "left")
    for dropped in ("error", "view"):
        out = filters.not_equal_or_null(out, "next_status", dropped)
    return out


# --- scalar functions ----------------------------------------------------------------------------

_DAYS = "CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER)"
_WEEK = "CAST(floor(date_diff('day', DATE '1899-12-31', {}) / 7.0) AS INTEGER)"


@query("weekday_gap", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_DAYS} AS days,
           {_WEEK.format('l_shipdate')} - {_WEEK.format('o_orderdate')} AS weeks,
           CAST(date_diff('month', o_orderdate, l_shipdate) AS INTEGER) AS months,
           {_DAYS} + 1 - 2 * ({_WEEK.format('l_shipdate')} - {_WEEK.format('o_orderdate')}) AS weekdays
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def weekday_gap(t: Catalog) -> DataFrame:
    lines = t["lineitem"].join(t["orders"].withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    a, b = F.col("o_orderdate"), F.col("l_shipdate")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dates.day_gap(a, b).alias("days"),
        dates.week_gap(a, b).alias("weeks"), dates.month_gap(a, b).alias("months"),
        dates.weekdays_between(a, b).alias("weekdays"),
    )


@query("month_end_add", """
    SELECT event_id, ts + INTERVAL 1 MONTH AS plus_month, ts + INTERVAL 84 DAY AS plus_weeks,
           strftime(ts + INTERVAL 3 MONTH, '%d/%m/%Y') AS until_text,
           'Grace period until ' || strftime(ts, '%d/%m/%Y') || ' for ' || CASE WHEN value > 50 THEN event_type END AS note
    FROM events""")
def month_end_add(t: Catalog) -> DataFrame:
    ts = F.col("ts")
    return t["events"].select(
        "event_id", dates.plus_months(ts, 1).alias("plus_month"), dates.plus_weeks(ts, 12).alias("plus_weeks"),
        dates.dmy(dates.plus_months(ts, 3)).alias("until_text"),
        text.joined("Grace period until ", dates.dmy(ts), " for ", F.when(F.col("value") > 50, F.col("event_type"))).alias("note"),
    )


@query("later_of", """
    WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS a,
                      CASE WHEN o_orderpriority <> '5-LOW' THEN DATE '1998-01-15' END AS b FROM orders)
    SELECT o_orderkey, CASE WHEN a > b THEN a ELSE b END AS later FROM x""")
def later_of(t: Catalog) -> DataFrame:
    a = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    b = F.when(F.col("o_orderpriority") != "5-LOW", F.lit(RUN_DATE))
    return t["orders"].select("o_orderkey", predicates.later_of(a, b).alias("later"))


@query("pattern_flags", """
    SELECT doc_id,
           CASE WHEN text ILIKE '%license%' OR text ILIKE '%copyright%' THEN 1 ELSE 0 END AS legal,
           CASE WHEN text ILIKE '%the%of%and%' THEN 1 ELSE 0 END AS ordered_words,
           CASE WHEN text ILIKE 'th%' THEN 'starts' WHEN text ILIKE '%.' THEN 'ends' ELSE 'other' END AS shape,
           CASE WHEN source ILIKE 'SRC1%' AND text NOT ILIKE '%la%' THEN 'YES' ELSE 'NO' END AS plain
    FROM documents""")
def pattern_flags(t: Catalog) -> DataFrame:
    def bit(c):
        return F.when(c, 1).otherwise(0)

    return t["documents"].select(
        "doc_id",
        bit(text.matches_any("text", ["%license%", "%copyright%"])).alias("legal"),
        bit(text.like("text", "%the%of%and%")).alias("ordered_words"),
        F.when(text.like("text", "th%"), "starts").when(text.like("text", "%."), "ends").otherwise("other").alias("shape"),
        F.when(text.like("source", "SRC1%") & ~text.like("text", "%la%"), "YES").otherwise("NO").alias("plain"),
    )


# --- rules ---------------------------------------------------------------------------------------

@query("ordered_rules", """
    WITH r0 AS (SELECT o_orderkey, o_orderdate, o_orderpriority, o_orderstatus AS status, 'as ordered' AS note, 1 AS failing FROM orders),
    r1 AS (SELECT o_orderkey, o_orderdate, o_orderpriority,
             CASE WHEN o_orderpriority = '1-URGENT' AND status = 'P' THEN 'Warning' ELSE status END AS status,
             CASE WHEN o_orderpriority = '1-URGENT' AND status = 'P' THEN 'was ' || status ELSE note END AS note,
             CASE WHEN o_orderpriority = '1-URGENT' AND status = 'P' THEN 0 ELSE failing END AS failing FROM r0),
    r2 AS (SELECT o_orderkey, o_orderdate, o_orderpriority, status,
             CASE WHEN status = 'Warning' AND o_orderdate < DATE '1998-01-01' THEN note || '. Eff. 01/01/1998' ELSE note END AS note,
             failing FROM r1),
    r3 AS (SELECT o_orderkey, o_orderdate, o_orderpriority,
             CASE WHEN status = 'F' THEN 'Compliant' ELSE status END AS status, note,
             CASE WHEN status = 'F' THEN 0 ELSE failing END AS failing FROM r2),
    r4 AS (SELECT o_orderkey, o_orderdate, o_orderpriority,
             CASE WHEN failing = 1 AND status = 'O' THEN 'Non-Compliant' ELSE status END AS status,
             CASE WHEN failing = 1 AND status = 'O' THEN 'Pre ' || note ELSE note END AS note, failing FROM r3)
    SELECT o_orderkey, status, CASE WHEN note = 'as ordered' AND status = 'Compliant' THEN 'fine' ELSE note END AS note, failing FROM r4""")
def ordered_rules(t: Catalog) -> DataFrame:
    rows = t["orders"].select(
        "o_orderkey", "o_orderdate", "o_orderpriority", F.col("o_orderstatus").alias("status"),
        F.lit("as ordered").alias("note"), F.lit(1).alias("failing"),
    )
    status, note, failing = F.col("status"), F.col("note"), F.col("failing")
    out = apply_rules(rows, [
        Rule("urgent", (F.col("o_orderpriority") == "1-URGENT") & (status == "P"),
             {"status": F.lit("Warning"), "note": text.joined("was ", status), "failing": F.lit(0)}),
        Rule("effective date", (status == "Warning") & (F.col("o_orderdate") < F.lit(dt.date(1998, 1, 1))),
             {"note": text.joined(note, ". Eff. 01/01/1998")}),
        Rule("finished", status == "F", {"status": F.lit("Compliant"), "failing": F.lit(0)}),
        Rule("open", (failing == 1) & (status == "O"),
             {"status": F.lit("Non-Compliant"), "note": text.joined("Pre ", note)}),
        Rule("plain", (note == "as ordered") & (status == "Compliant"), {"note": F.lit("fine")}),
    ])
    return out.select("o_orderkey", "status", "note", "failing")


@query("grace_classification", """
    WITH x AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate AS start_date, l_shipdate AS seen,
             CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 8 WHEN '4-NOT SPECIFIED' THEN 12 END AS weeks,
             l_returnflag
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    y AS (SELECT *, CAST(start_date AS DATE) + CAST(7 * weeks AS INTEGER) AS last_day FROM x)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, last_day,
      CASE WHEN l_returnflag = 'R' THEN 'Recommended' WHEN weeks IS NULL THEN 'No grace'
           WHEN last_day > CAST(seen AS DATE) OR l_returnflag <> 'A' THEN 'Grace period of ' || weeks || ' weeks allowed'
           ELSE 'Grace period of ' || weeks || ' weeks has passed' END AS note,
      CASE WHEN l_returnflag = 'R' THEN 0 WHEN last_day > CAST(seen AS DATE) OR l_returnflag <> 'A' THEN 0 ELSE 1 END AS failing
    FROM y""")
def grace_classification(t: Catalog) -> DataFrame:
    weeks = {"1-URGENT": 1, "2-HIGH": 4, "3-MEDIUM": 8, "4-NOT SPECIFIED": 12}
    lines = t["lineitem"].join(t["orders"].withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    last_day = note = None
    priority, flag = F.col("o_orderpriority"), F.col("l_returnflag")
    recommended = flag == "R"
    note = F.when(recommended, "Recommended")
    last_day = F.lit(None).cast("date")
    allowed_any = F.lit(False)
    for name, n in weeks.items():
        until = F.date_add(F.to_date("o_orderdate"), 7 * n)
        allowed = (until > F.to_date("l_shipdate")) | (flag != "A")
        arm = priority == name
        note = note.when(arm & allowed, f"Grace period of {n} weeks allowed").when(arm, f"Grace period of {n} weeks has passed")
        last_day = F.when(arm, until).otherwise(last_day)
        allowed_any = allowed_any | (arm & allowed)
    no_grace = ~priority.isin(list(weeks))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", last_day.alias("last_day"),
        note.otherwise("No grace").alias("note"),
        F.when(recommended | allowed_any | (no_grace & (flag != "A")), 0).otherwise(1).alias("failing"),
    )


# --- sinks ---------------------------------------------------------------------------------------

@query("snapshot_replace", """
    SELECT DATE '1998-01-14' AS record_date, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT DATE '1998-01-15', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def snapshot_replace(t: Catalog) -> DataFrame:
    """Two days written, the second one twice, then once more with an empty result, which is ignored."""
    orders = t["orders"].select("o_orderkey", "o_orderstatus")
    path = shared_folder(orders.sparkSession, "replace")
    first, second = RUN_DATE - dt.timedelta(days=1), RUN_DATE
    snapshots.replace_snapshot(orders.where("o_orderstatus = 'P'"), path, "record_date", first)
    snapshots.replace_snapshot(orders, path, "record_date", second)
    snapshots.replace_snapshot(orders.where("o_orderstatus = 'F'"), path, "record_date", second)
    snapshots.replace_snapshot(orders.where("o_orderstatus = '?'"), path, "record_date", second)
    return orders.sparkSession.read.parquet(path).select("record_date", "o_orderkey", "o_orderstatus")


@query("snapshot_replace_unguarded", """
    SELECT DATE '1998-01-14' AS record_date, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'""")
def snapshot_replace_unguarded(t: Catalog) -> DataFrame:
    """An empty result without the guard removes the day."""
    orders = t["orders"].select("o_orderkey", "o_orderstatus")
    path = shared_folder(orders.sparkSession, "replace")
    snapshots.replace_snapshot(orders.where("o_orderstatus = 'P'"), path, "record_date", RUN_DATE - dt.timedelta(days=1))
    snapshots.replace_snapshot(orders, path, "record_date", RUN_DATE)
    snapshots.replace_snapshot(orders.where("o_orderstatus = '?'"), path, "record_date", RUN_DATE, guard=False)
    return orders.sparkSession.read.parquet(path).select("record_date", "o_orderkey", "o_orderstatus")


@query("snapshot_retain", """
    WITH d AS (SELECT * FROM (VALUES (DATE '1998-01-17'), (DATE '1998-01-18'), (DATE '1998-01-19'), (DATE '1998-01-20')) v(snapshot_date))
    SELECT snapshot_date, CASE WHEN dayofweek(snapshot_date) = 0 THEN 0 ELSE 1 END AS to_delete, o_orderkey
    FROM d CROSS JOIN orders
    WHERE CAST(o_orderdate AS DATE) <= snapshot_date
      AND (dayofweek(snapshot_date) = 0 OR snapshot_date = DATE '1998-01-20')""")
def snapshot_retain(t: Catalog) -> DataFrame:
    """Four daily runs from a Saturday, the last one twice: Sunday and the last run remain."""
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    path = shared_folder(orders.sparkSession, "retain")
    for day in (17, 18, 19, 20, 20):
        run = dt.date(1998, 1, day)
        rows = orders.where(F.col("o_orderdate") < F.lit(run + dt.timedelta(days=1))).select(
            F.lit(run).alias("snapshot_date"), "o_orderkey"
        )
        snapshots.retain_and_append(
            rows.withColumn("to_delete", snapshots.retention_flag("snapshot_date")), path, "snapshot_date", run
        )
    return orders.sparkSession.read.parquet(path).select("snapshot_date", "to_delete", "o_orderkey")


@query("append_new", """
    SELECT o_orderkey, CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'first' ELSE 'second' END AS batch FROM orders""")
def append_new(t: Catalog) -> DataFrame:
    """Three batches with overlapping keys: a key keeps the batch that brought it first."""
    orders = t["orders"]
    path = shared_folder(orders.sparkSession, "append")
    old = orders.where(F.col("o_orderdate") < F.lit(dt.date(1998, 1, 1)))
    for batch, rows in (("first", old), ("second", orders), ("third", orders)):
        snapshots.append_new(rows.select("o_orderkey", F.lit(batch).alias("batch")), path, "o_orderkey")
    return orders.sparkSession.read.parquet(path)


@query("append_new_strict", """
    SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey, 'first' AS batch FROM orders""")
def append_new_strict(t: Catalog) -> DataFrame:
    """Once the target holds a NULL key, SQL's NOT IN lets nothing more in."""
    orders = t["orders"]
    path = shared_folder(orders.sparkSession, "append")
    holed = orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey"))
    snapshots.append_new(holed.withColumn("batch", F.lit("first")), path, "o_orderkey", strict=True)
    rest = orders.select("o_orderkey", F.lit("second").alias("batch"))
    snapshots.append_new(rest, path, "o_orderkey", strict=True)
    return orders.sparkSession.read.parquet(path)
