"""The generic operators on the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from callweave import fixed_values as fv
from callweave.functions import (
    date_columns,
    decode_flags,
    fixed_width,
    trim_all,
    typed_nulls,
    wall_seconds,
    wall_text,
)
from callweave.operators import (
    anti_join,
    changed_rows,
    changed_rows_ranged,
    dedup_on,
    dial_code_lookup,
    diff_by_column,
    diff_summary,
    enrich,
    explode_roles,
    fingerprint,
    group_total,
    joined_labels,
    latest_per_key,
    latest_version,
    mark_first,
    missing_columns,
    normalize_for_diff,
    null_safe_join,
    prefix_lookup,
    repeat_rows,
    require_columns,
    require_parents,
    require_schema,
    store_ranged,
    tolerance_join,
    top_order,
    union_aligned,
)
from callweave.plans import regression_check
from callweave.plans.tickets import exclude_service_numbers
from callweave.sources import (
    DayStore,
    Stages,
    export_sorted_csv,
    read_csv,
    read_csv_by_header,
    read_csv_columns,
    read_csv_quarantined,
    read_lines,
    read_table,
    write_csv,
    write_days,
    write_orc,
    write_orc_table,
)
from checks import views
from checks.views import BASE_SQL, IVR_SQL, PLAN_SQL, TICKETS_SQL, USERS_SQL, table, with_views

QUERIES = {}
SQL = {}


def query(sql: str | None):
    """Register a function under its own name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def tickets_sql(select: str, *more: str) -> str:
    return with_views(BASE_SQL, TICKETS_SQL, *more, select=select)


# --- projections --------------------------------------------------------------------


@query("""
SELECT o_orderkey AS "TicketId", o_custkey AS cust, o_orderstatus AS state,
  o_totalprice * 2 AS doubled, 'Forfait' AS kind FROM orders""")
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .selectExpr(
            "o_orderkey as TicketId", "o_custkey", "o_orderstatus", "o_orderpriority",
            "o_totalprice * 2 as doubled",
        )
        .withColumnsRenamed({"o_custkey": "cust", "o_orderstatus": "state", "absent": "x"})
        .withColumn("kind", F.lit(fv.IN_PLAN))
        .drop("O_ORDERPRIORITY")
    )


@query("""
SELECT doc_id, trim('  ' || text || ' ') AS text, trim('  ' || lang) AS lang,
  trim(source || '   ') AS source, n_chars FROM documents""")
def trim_every_column(spark, sf):
    padded = table(spark, sf, "documents").withColumns(
        {
            "text": F.concat(F.lit("  "), "text", F.lit(" ")),
            "lang": F.concat(F.lit("  "), "lang"),
            "source": F.concat("source", F.lit("   ")),
        }
    )
    return trim_all(padded)


@query("""
SELECT page_id, url, CAST(NULL AS VARCHAR) AS pays, CAST(NULL AS INTEGER) AS transfer,
  CAST(NULL AS DOUBLE) AS waiting FROM pages""")
def typed_null_columns(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return typed_nulls(pages, {"pays": "string", "transfer": "int", "waiting": "double"})


@query("""
SELECT substr(line, 1, 8) AS word, substr(line, 9, 1) AS mark,
  CAST(trim(substr(line, 10, 11)) AS BIGINT) AS custkey, trim(substr(line, 21, 12)) AS segment,
  substr(line, 33, 20) AS rest
FROM (SELECT rpad(c_name, 20, ' ') || rpad(c_mktsegment, 12, ' ') || 'nation, ' || c_nationkey AS line
      FROM customer)""")
def fixed_width_lines(spark, sf):
    line = F.concat(
        F.rpad("c_name", 20, " "), F.rpad("c_mktsegment", 12, " "),
        F.lit("nation, "), F.col("c_nationkey").cast("string"),
    )
    path = Stages(spark).path("lines")
    table(spark, sf, "customer").select(line).write.text(path)
    layout = [("word", 1, 8), ("mark", 9, 1), ("number", 10, 11), ("segment", 21, 12), ("rest", 33, 20)]
    cut = fixed_width(read_lines(spark, path), layout)
    return cut.select(
        "word", "mark", F.trim("number").cast("bigint").alias("custkey"),
        F.trim("segment").alias("segment"), "rest",
    )


_flag_sql = ", ".join(
    f'CAST(substr("InternFacilities", {at}, 1) AS INTEGER) AS "{name}"'
    for name, at in fv.FACILITY_POSITIONS.items()
)


@query(tickets_sql(f'SELECT "TicketId", {_flag_sql} FROM t'))
def flag_decode(spark, sf):
    tickets = views.tickets(spark, sf).select("TicketId", "InternFacilities")
    return decode_flags(tickets).drop("InternFacilities")


# --- filters ------------------------------------------------------------------------


@query(tickets_sql("""
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM (VALUES ("CalledNumber"), ("ChargedNumber"), ("CallingNumber"), ("InitialDialledNumber")) v(x)
  WHERE length(x) = 8 AND x LIKE '1%')"""))
def exclude_numbers(spark, sf):
    return exclude_service_numbers(views.tickets(spark, sf))


@query(tickets_sql("""
SELECT class, count(*) AS n_calls, count(DISTINCT "CalledNumber") AS n_numbers FROM (
  SELECT "CalledNumber", CASE WHEN "CalledNumber" IS NULL THEN 'none'
    WHEN length("CalledNumber") = 10 AND "CalledNumber" LIKE '08%' THEN 'special'
    WHEN length("CalledNumber") = 10 AND "CalledNumber" LIKE '07%' THEN 'mobile'
    WHEN length("CalledNumber") = 10 THEN 'national' WHEN length("CalledNumber") = 4 THEN 'short'
    WHEN length("CalledNumber") = 8 THEN 'internal' WHEN length("CalledNumber") > 10 THEN 'international'
    WHEN "CalledNumber" IN ('15', '17', '18') THEN 'emergency' ELSE 'other' END AS class FROM t)
GROUP BY class"""))
def route_by_class(spark, sf):
    number, size = F.col("CalledNumber"), F.length("CalledNumber")
    kind = (
        F.when(number.isNull(), "none")
        .when((size == 10) & number.startswith("08"), "special")
        .when((size == 10) & number.startswith("07"), "mobile")
        .when(size == 10, "national")
        .when(size == 4, "short")
        .when(size == 8, "internal")
        .when(size > 10, "international")
        .when(number.isin(fv.EMERGENCY_NUMBERS), "emergency")
        .otherwise("other")
    )
    # Two steps: numbers first, so that neither step collects the numbers of a class.
    return (
        views.tickets(spark, sf)
        .groupBy(kind.alias("class"), "CalledNumber")
        .agg(F.count("*").alias("n"))
        .groupBy("class")
        .agg(F.sum("n").alias("n_calls"), F.count("CalledNumber").alias("n_numbers"))
    )


@query("""
SELECT name, present, n_rows FROM (VALUES ('event_id', 1), ('ts', 1), ('Callednumber', 0)) AS c(name, present),
  (SELECT count(*) AS n_rows FROM events)""")
def column_contract(spark, sf):
    """Which required columns a table has, next to its size."""
    events = table(spark, sf, "events")
    required = ["event_id", "ts", "Callednumber"]
    missing = set(missing_columns(events, required))
    checked = require_columns(events, [c for c in required if c not in missing])
    present = F.array(
        *[F.struct(F.lit(c).alias("name"), F.lit(int(c not in missing)).alias("present")) for c in required]
    )
    return checked.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(present))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def schema_contract(spark, sf):
    return require_schema(
        table(spark, sf, "lineitem"), "l_orderkey bigint, l_linenumber int, l_quantity double"
    )


# --- groups -------------------------------------------------------------------------


@query("""
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_user(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("""
SELECT a.user_id, a.event_id, b.event_id AS error_event, b.value AS error_value FROM (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) a
LEFT JOIN (
  SELECT * FROM events WHERE event_type LIKE '%err%' AND value > 20
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) b
ON a.user_id = b.user_id""")
def latest_filtered_left(spark, sf):
    """Latest event and latest error of each user, out of one aggregation."""
    events = table(spark, sf, "events")
    event = F.struct("ts", "event_id", "value")
    is_error = F.col("event_type").contains("err") & (F.col("value") > 20)
    latest = events.groupBy("user_id").agg(
        F.max(event).alias("last"), F.max(F.when(is_error, event)).alias("error")
    )
    return latest.select(
        "user_id", F.col("last.event_id").alias("event_id"),
        F.col("error.event_id").alias("error_event"), F.col("error.value").alias("error_value"),
    )


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN f IS NULL THEN 1 ELSE 0 END AS not_first
FROM orders LEFT JOIN (
  SELECT o_custkey AS c, o_orderpriority AS p, min(o_orderdate) AS f FROM orders
  WHERE o_orderstatus <> 'P' GROUP BY 1, 2)
ON o_custkey = c AND o_orderpriority = p AND o_orderdate = f""")
def mark_first_order(spark, sf):
    marked = mark_first(
        table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], "o_orderdate",
        F.col("o_orderstatus") != "P", "first",
    )
    return marked.select(
        "o_orderkey", "o_custkey", F.when(F.col("first"), 0).otherwise(1).alias("not_first")
    )


@query("""
WITH k AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
    CASE WHEN l_partkey % 50 <> 0 THEN l_partkey % 100 END AS part, l_returnflag FROM lineitem)
SELECT k.l_orderkey, k.l_linenumber, k.part, k.l_returnflag, total
FROM k LEFT JOIN (SELECT part, l_returnflag, CAST(sum(quantity) AS BIGINT) AS total FROM k GROUP BY 1, 2) g
ON k.part = g.part AND k.l_returnflag = g.l_returnflag""")
def group_total_hot_keys(spark, sf):
    """Few keys, so all are hot, and one in fifty is null."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey") % 100).alias("part"), "l_returnflag",
    )
    return group_total(
        items, ["part", "l_returnflag"], "quantity", "total", ["l_orderkey", "l_linenumber"]
    ).drop("quantity")


@query("""
SELECT l_orderkey, l_linenumber, day, sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_partkey, day)::BIGINT AS total
FROM (SELECT *, CAST(l_shipdate AS DATE) AS day FROM lineitem)""")
def group_total_part_day(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return group_total(
        items, ["l_partkey", "day"], "quantity", "total", ["l_orderkey", "l_linenumber"]
    ).drop("quantity", "l_partkey")


@query("""
SELECT l_orderkey, string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS flags
FROM lineitem GROUP BY l_orderkey""")
def joined_flags(spark, sf):
    return joined_labels(table(spark, sf, "lineitem"), ["l_orderkey"], "l_returnflag", "flags")


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m%d') AS ends FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
  AND (o_orderstatus = 'O' OR o_orderdate > TIMESTAMP '1999-06-01')""")
def latest_valid_version(spark, sf):
    versions = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus",
        F.date_format("o_orderdate", "yyyyMMdd").alias("ends"),
    )
    valid = (F.col("o_orderstatus") == "O") | (
        F.try_to_date("ends", "yyyyMMdd") > F.lit("1999-06-01").cast("date")
    )
    return latest_version(versions, "o_custkey", "ends", valid, ["o_orderkey"])


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def dedup_part_supplier(spark, sf):
    return dedup_on(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT DISTINCT text, lang, source FROM documents")
def distinct_documents(spark, sf):
    return table(spark, sf, "documents").select("text", "lang", "source").distinct()


@query("""
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders ORDER BY ALL""")
def ordered_rows(spark, sf):
    return top_order(table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


# --- joins --------------------------------------------------------------------------


@query(tickets_sql("""
SELECT "TicketId", id, CAST(abs(floor(start) - epoch(CAST("InitialStartDateTime" AS TIMESTAMP))) AS BIGINT) AS date_diff
FROM t JOIN ivr_calls ON 'sip:' || "CalledNumber" || '@node;user=phone' = caller
WHERE abs(floor(start) - epoch(CAST("InitialStartDateTime" AS TIMESTAMP))) <= 4""", IVR_SQL))
def tolerance_pairs(spark, sf):
    tickets = views.tickets(spark, sf).select(
        "TicketId",
        F.concat(F.lit("sip:"), "CalledNumber", F.lit("@node;user=phone")).alias("number"),
        wall_seconds(F.col("InitialStartDateTime"), "UTC").alias("second"),
    )
    calls = views.ivr_calls(spark, sf).select("id", "caller", F.floor("start").alias("call_second"))
    pairs = tolerance_join(tickets, calls, "number", "caller", "second", "call_second", 4)
    return pairs.select("TicketId", "id", "date_diff")


@query("""
SELECT a.event_id AS event_id, b.event_id AS other_id,
  CAST(abs(epoch(date_trunc('second', a.ts)) - epoch(date_trunc('second', b.ts))) AS BIGINT) AS gap
FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_type = 'error'
WHERE abs(epoch(date_trunc('second', a.ts)) - epoch(date_trunc('second', b.ts))) <= 600""")
def tolerance_pairs_by_user(spark, sf):
    events = table(spark, sf, "events").withColumn("second", F.unix_timestamp("ts"))
    errors = events.where("event_type = 'error'").select(
        F.col("event_id").alias("other_id"), F.col("user_id").alias("other_user"),
        F.col("second").alias("other_second"),
    )
    return tolerance_join(
        events.select("event_id", "user_id", "second"), errors,
        "user_id", "other_user", "second", "other_second", 600, difference="gap",
    ).select("event_id", "other_id", "gap")


@query(tickets_sql("""
SELECT "TicketId", "CalledNumber", debut IS NOT NULL AS in_plan FROM t
LEFT JOIN (SELECT DISTINCT debut, longueur FROM plan WHERE debut IS NOT NULL)
ON length("CalledNumber") = CAST(longueur AS INTEGER) AND debut = substr("CalledNumber", 1,
  CASE WHEN "CalledNumber" LIKE '08%' THEN 4 WHEN "CalledNumber" LIKE '07%' THEN 3 ELSE 2 END)""", PLAN_SQL))
def prefix_of_number(spark, sf):
    number = F.col("CalledNumber")
    size = F.when(number.startswith("08"), 4).when(number.startswith("07"), 3).otherwise(2)
    tickets = views.tickets(spark, sf).select("TicketId", "CalledNumber")
    return prefix_lookup(tickets, "CalledNumber", size, views.plan(spark), "in_plan")


@query("""
SELECT p_partkey, p_brand, count(s_suppkey) AS listings FROM (
  SELECT p_partkey, p_brand, s_suppkey FROM part
  LEFT JOIN (SELECT s_suppkey, 'Brand#' || (s_suppkey % 10) AS debut FROM supplier)
  ON substr(p_brand, 1, 7) = debut AND length(p_brand) = 8) GROUP BY 1, 2""")
def prefix_of_brand(spark, sf):
    """Suppliers act as a plan that lists each prefix many times. The listings of a part are counted, so
    the lookup gives their number; a row for each would be parts times suppliers."""
    plan = table(spark, sf, "supplier").select(
        F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 10).cast("string")).alias("Debut"),
        F.lit("8").alias("Longueur"),
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    listed = prefix_lookup(parts, "p_brand", 7, plan, "hit", duplicates=True, times="times")
    return listed.groupBy("p_partkey", "p_brand").agg(
        F.sum(F.when(F.col("hit"), F.col("times")).otherwise(0)).alias("listings")
    )


@query(tickets_sql("""
SELECT "TicketId", code AS "Indicatif_numero", pays AS "Pays" FROM (
  SELECT "TicketId", substr(regexp_replace("CalledNumber", '^00', ''), 1, k) AS code
  FROM t, (VALUES (2), (3)) AS p(k) WHERE length("CalledNumber") > 10)
JOIN (SELECT DISTINCT indicatif FROM plan) c ON code = c.indicatif
LEFT JOIN (SELECT indicatif, string_agg(pays, ', ' ORDER BY pays) AS pays FROM codes GROUP BY 1) n
  ON code = n.indicatif""", PLAN_SQL))
def dial_codes_of_number(spark, sf):
    tickets = views.tickets(spark, sf).where(F.length("CalledNumber") > 10)
    countries = joined_labels(views.dial_codes(spark), ["Indicatif"], "Pays", "Pays")
    hits = dial_code_lookup(
        tickets.select("TicketId", "CalledNumber"), "CalledNumber", views.plan(spark), countries
    )
    return hits.drop("CalledNumber")


@query("""
SELECT a.o_orderkey, a.k, a.o_orderstatus FROM
  (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS k FROM orders) a
WHERE NOT EXISTS (SELECT 1 FROM (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS k FROM orders) b
  WHERE b.o_orderpriority = '1-URGENT' AND b.k = a.k AND b.o_orderstatus = a.o_orderstatus)""")
def anti_two_keys(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("k"),
    )
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    return anti_join(orders, urgent, ["k", "o_orderstatus"]).select("o_orderkey", "k", "o_orderstatus")


@query(tickets_sql("""
SELECT "TicketId", "CalledNumber", n_calls FROM t JOIN (
  SELECT "CalledNumber" AS number, count(*) AS n_calls FROM t GROUP BY 1)
ON "CalledNumber" IS NOT DISTINCT FROM number"""))
def null_safe_numbers(spark, sf):
    tickets = views.tickets(spark, sf).select("TicketId", "CalledNumber")
    counts = tickets.groupBy(F.col("CalledNumber").alias("number")).agg(F.count("*").alias("n_calls"))
    return null_safe_join(tickets, counts, "CalledNumber", "number").drop("number")


@query(tickets_sql("""
SELECT "TicketId", "ChargedNumber", center FROM t LEFT JOIN users ON "ChargedNumber" = internal""", USERS_SQL))
def alternate_key(spark, sf):
    directory = views.users(spark, sf).select(
        F.col("Internal Number").alias("internal"), F.col("Cost Center").alias("center")
    )
    tickets = views.tickets(spark, sf).select("TicketId", "ChargedNumber")
    return enrich(tickets, directory, "ChargedNumber", "internal").drop("internal")


@query("""
SELECT o_orderkey, c_name AS customer FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)""")
def require_two_parents(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    large = table(spark, sf, "lineitem").where("l_quantity > 45")
    kept = require_parents(orders, large, "o_orderkey", "l_orderkey")
    paying = table(spark, sf, "customer").where("c_acctbal > 0")
    return require_parents(kept, paying, "o_custkey", "c_custkey", {"c_name": "customer"}).drop("o_custkey")


# --- rows ---------------------------------------------------------------------------


@query("""
SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def union_to_left_columns(spark, sf):
    left = table(spark, sf, "customer").selectExpr("c_custkey as k", "c_name as name", "c_nationkey as nation")
    right = table(spark, sf, "supplier").selectExpr(
        "s_nationkey as nation", "s_acctbal as extra", "s_name as name", "s_suppkey as k"
    )
    return union_aligned(left, right)


@query("SELECT c_custkey, c_name FROM customer, (VALUES (1), (2), (3), (4), (5)) AS r(i)")
def repeat_five_times(spark, sf):
    return repeat_rows(table(spark, sf, "customer").select("c_custkey", "c_name"), 5)


@query("""
SELECT o_orderkey, 'buyer' AS role, o_custkey AS party FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, 'buyer', o_custkey FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'receiver', o_custkey + 1000000 FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'urgent', NULL FROM orders WHERE o_orderpriority = '1-URGENT'""")
def fan_out_roles(spark, sf):
    final = F.col("o_orderstatus") == "F"
    roles = [
        (~final, {"role": F.lit("buyer"), "party": F.col("o_custkey")}),
        (final, {"role": F.lit("buyer"), "party": F.col("o_custkey")}),
        (final, {"role": F.lit("receiver"), "party": F.col("o_custkey") + 1_000_000}),
        (
            F.col("o_orderpriority") == "1-URGENT",
            {"role": F.lit("urgent"), "party": F.lit(None).cast("bigint")},
        ),
    ]
    return explode_roles(table(spark, sf, "orders"), roles).select("o_orderkey", "role", "party")


# --- scalar functions -----------------------------------------------------------------


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN millisecond(ts) % 1000 = 0 THEN '' ELSE strftime(ts, '.%g') END AS "InitialStartDateTime",
  CAST(minute(ts) AS INTEGER) AS "Minutes", CAST(hour(ts) AS INTEGER) AS "Hour", CAST(ts AS DATE) AS "Date",
  CASE dayofweek(ts) WHEN 0 THEN 'dimanche' WHEN 1 THEN 'lundi' WHEN 2 THEN 'mardi' WHEN 3 THEN 'mercredi'
    WHEN 4 THEN 'jeudi' WHEN 5 THEN 'vendredi' ELSE 'samedi' END AS "dayofweek",
  q AS "quarter", hour(ts) || ':' || substr(q, 1, 2) || ' - ' ||
    CASE WHEN q <> '45-00' THEN CAST(hour(ts) AS VARCHAR) WHEN hour(ts) = 23 THEN '00'
         ELSE CAST(hour(ts) + 1 AS VARCHAR) END || ':' || substr(q, 4, 2) AS "Lib_hour"
FROM (SELECT *, CASE WHEN minute(ts) < 15 THEN '00-15' WHEN minute(ts) < 30 THEN '15-30'
        WHEN minute(ts) < 45 THEN '30-45' ELSE '45-00' END AS q FROM events)""")
def date_parts(spark, sf):
    events = table(spark, sf, "events").select("event_id", wall_text(F.col("ts")).alias("InitialStartDateTime"))
    return date_columns(events)


@query("""
SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half,
  CAST(round_even(l_extendedprice, 0) AS BIGINT) AS price FROM lineitem""")
def half_even(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.bround(F.col("l_quantity") / 2).cast("int").alias("half"),
        F.bround("l_extendedprice").cast("bigint").alias("price"),
    )


# --- comparison -----------------------------------------------------------------------


def _two_versions(spark, sf):
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    price = F.col("o_totalprice")
    orders = table(spark, sf, "orders").select(*names, "o_totalprice")
    left = orders.select(*names)
    right = orders.where(price >= 9000).withColumns(
        {
            "o_orderstatus": F.when(price > 480_000, "X").otherwise(F.col("o_orderstatus")),
            "o_orderpriority": F.when(price < 490_000, F.col("o_orderpriority")),
        }
    )
    return left, repeat_rows(right.select(*reversed(names)), 2)


VERSIONS_SQL = """
l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders),
r AS (SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 480000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_totalprice < 490000 THEN o_orderpriority END AS o_orderpriority
      FROM orders, (VALUES (1), (2)) AS c(i) WHERE o_totalprice >= 9000)"""


@query(with_views(VERSIONS_SQL, select="""
SELECT *, 'left' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
UNION ALL SELECT *, 'right' FROM (SELECT * FROM r EXCEPT SELECT * FROM l)"""))
def dataset_diff(spark, sf):
    return changed_rows(*_two_versions(spark, sf))


@query(with_views(VERSIONS_SQL, select="""
SELECT (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM r) AS right_rows,
  (SELECT count(*) FROM (SELECT * FROM l EXCEPT SELECT * FROM r)) AS left_only,
  (SELECT count(*) FROM (SELECT * FROM r EXCEPT SELECT * FROM l)) AS right_only"""))
def dataset_diff_summary(spark, sf):
    return diff_summary(*_two_versions(spark, sf))


_by_column = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", o_orderkey, CAST({c} AS VARCHAR) AS value, '{side}' AS side
    FROM (SELECT o_orderkey, {c} FROM {a} EXCEPT SELECT o_orderkey, {c} FROM {b})"""
    for c in ("o_custkey", "o_orderstatus", "o_orderpriority")
    for side, a, b in (("left", "l", "r"), ("right", "r", "l"))
)


@query(with_views(VERSIONS_SQL, select=_by_column))
def dataset_diff_by_column(spark, sf):
    return diff_by_column(*_two_versions(spark, sf), id_column="o_orderkey")


_CORRECTED_SQL = """
last AS (SELECT max(o_orderkey) AS k FROM orders),
l AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders),
r AS (SELECT o_orderkey, o_custkey, o_orderdate,
        CASE WHEN o_orderkey BETWEEN k // 2 AND k // 2 + k // 50 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
      FROM orders, last WHERE o_orderkey <= k - k // 200)"""


@query(with_views(_CORRECTED_SQL, select="""
SELECT *, 'left' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
UNION ALL SELECT *, 'right' FROM (SELECT * FROM r EXCEPT SELECT * FROM l)"""))
def dataset_diff_by_range(spark, sf):
    """A correction of one block of numbers and a missing end, found from the digests of key ranges."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    last = orders.agg(F.max("o_orderkey")).first()[0] or 0
    block = F.col("o_orderkey").between(last // 2, last // 2 + last // 50)
    corrected = orders.where(F.col("o_orderkey") <= last - last // 200).withColumn(
        "o_totalprice", F.when(block, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    stages = Stages(spark)
    store_ranged(orders, stages.path("left"), "o_orderkey", ranges=100)
    store_ranged(corrected, stages.path("right"), "o_orderkey", like=stages.path("left"))
    return changed_rows_ranged(spark, stages.path("left"), stages.path("right"))


@query("""
SELECT event_id, CAST(value AS DOUBLE) AS amount, strftime(ts, '%Y-%m-%d %H:%M') AS minute_text,
  replace(props, '"', '') AS props FROM events WHERE event_type <> 'view'""")
def normalized_for_diff(spark, sf):
    exported = table(spark, sf, "events").select(
        "event_id", "event_type", F.col("value").cast("string").alias("value"),
        F.regexp_replace(F.col("ts").cast("string"), " ", "T").alias("minute_text"),
        F.concat(F.lit(" "), "props", F.lit(" ")).alias("props"),
    )
    once = normalize_for_diff(
        exported, to_double=["value"], from_iso=["minute_text"], strip_quotes=["props"],
        rename={"value": "amount"}, where="event_type <> 'view'", drop=["event_type"],
    )
    return normalize_for_diff(once, to_minute=["minute_text"], trim=["props"])


@query(with_views(VERSIONS_SQL, select="""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, o_orderpriority, 'left' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority, 'right'
FROM (SELECT * FROM r EXCEPT SELECT * FROM l)"""))
def regression_of_files(spark, sf):
    """Two results exported as CSV, compared from their files."""
    stages = Stages(spark)
    left, right = _two_versions(spark, sf)
    write_csv(left, stages.path("expected"), ";")
    write_csv(right, stages.path("actual"), ";")
    return regression_check(spark, stages.path("expected"), stages.path("actual"))[1]


@query("""
SELECT count(*) AS n_rows, CAST(sum(h) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM (
  SELECT CAST('0x' || substr(md5(concat_ws(',', coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
    coalesce(length(CAST(text AS VARCHAR)) || ':' || text, '-'),
    coalesce(length(CAST(lang AS VARCHAR)) || ':' || lang, '-'),
    coalesce(length(CAST(source AS VARCHAR)) || ':' || source, '-'),
    coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'))), 1, 15) AS BIGINT) AS h FROM documents)""")
def table_fingerprint(spark, sf):
    return fingerprint(table(spark, sf, "documents"), "md5")


@query("SELECT count(*) AS n_rows, true AS same_if_dealt_anew, true AS other_if_changed FROM lineitem")
def table_fingerprint_xxhash(spark, sf):
    """The hash itself is Spark's own; its promises can be checked anywhere."""
    items = table(spark, sf, "lineitem")
    changed = items.withColumn("l_comment" if "l_comment" in items.columns else items.columns[-1], F.lit(None))
    prints = [
        fingerprint(df).select(F.struct("hash_sum", "hash_xor").alias(name), F.col("n_rows").alias(f"n_{name}"))
        for name, df in (("a", items), ("b", items.repartition(7)), ("c", changed))
    ]
    return prints[0].join(prints[1], F.col("n_a") == F.col("n_b")).join(prints[2], F.col("n_a") == F.col("n_c")).select(
        F.col("n_a").alias("n_rows"), (F.col("a") == F.col("b")).alias("same_if_dealt_anew"), (F.col("a") != F.col("c")).alias("other_if_changed")
    )


# --- sources and sinks ------------------------------------------------------------------


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def scan_csv_roundtrip(spark, sf):
    path = Stages(spark).path("part")
    write_csv(table(spark, sf, "part"), path)
    return read_csv_columns(
        spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double"
    )


@query("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(n_chars AS VARCHAR) AS n_chars, lang,
  'a "quoted" $ text, with ' || source AS note FROM documents""")
def scan_csv_delimiters(spark, sf):
    """Header-driven text columns, another delimiter, quotes doubled inside quotes."""
    path = Stages(spark).path("documents")
    noted = table(spark, sf, "documents").select(
        "doc_id", "n_chars", "lang",
        F.concat(F.lit('a "quoted" $ text, with '), "source").alias("note"),
    )
    noted.write.options(header=True, sep="$", quote='"', escape='"').csv(path)
    return read_csv(spark, path, sep="$", quote='"', escape='"')


@query("""
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS jour,
  CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-10' THEN 'second run' ELSE 'first run' END AS run
FROM events WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-10' OR event_type <> 'view'""")
def orc_day_rerun(spark, sf):
    """All days written, one of them run again: only its partition is replaced."""
    path = Stages(spark).path("days")
    days = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("jour")
    )
    write_days(days.withColumn("run", F.lit("first run")), path)
    again = days.where("jour = '2024-01-10' and event_type <> 'view'")
    write_days(again.withColumn("run", F.lit("second run")), path, by=["event_id"])
    return spark.read.schema("event_id bigint, user_id bigint, event_type string, run string, jour string").orc(path)


@query("""
SELECT event_id, user_id, event_type, CASE WHEN week = '2024-01-08' THEN 'second run' ELSE 'first run' END AS run, week AS jour
FROM (SELECT *, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week FROM events)
WHERE week <> '2024-01-08' OR event_type <> 'view'""")
def day_store_rerun(spark, sf):
    """Weeks of events published one by one, as tables of two halves. One week is run again and published;
    another is run again and fails before it is: its first version stays."""
    store = DayStore(spark, Stages(spark).path("store"))
    weeks = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week")
    )

    def run(label, rows, name):
        draft = store.draft(label)
        rows = rows.where(F.col("week") == label).drop("week").withColumn("run", F.lit(name))
        for half in (0, 1):
            draft.write(rows.where(F.col("event_id") % 2 == half), f"half-{half}")
        return draft

    for r in weeks.select("week").distinct().orderBy("week").collect():
        run(r.week, weeks, "first run").publish()
    run("2024-01-08", weeks.where("event_type <> 'view'"), "second run").publish()
    run("2024-01-15", weeks.where("event_type <> 'view'"), "never published")
    return store.read("half-0").unionByName(store.read("half-1"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 0 OR o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 89 = 0 OR o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_totalprice AS DOUBLE) END AS o_totalprice,
       CASE WHEN o_orderkey % 89 = 0 THEN concat('order ', o_orderkey, ',', o_custkey, ',1.5')
            WHEN o_orderkey % 97 = 0 THEN concat(o_orderkey, ',', o_custkey) END AS line
FROM orders""")
def scan_csv_quarantine(spark, sf):
    """CSV in which some lines have a word for a number and others lack a value: good rows, and beside them
    the bad lines with the order they belong to."""
    stages = Stages(spark)
    orders = table(spark, sf, "orders")
    line = (
        F.when(F.col("o_orderkey") % 89 == 0, F.concat(F.lit("order "), "o_orderkey", F.lit(","), "o_custkey", F.lit(",1.5")))
        .when(F.col("o_orderkey") % 97 == 0, F.concat_ws(",", "o_orderkey", "o_custkey"))
        .otherwise(F.concat_ws(",", "o_orderkey", "o_custkey", F.col("o_totalprice").cast("string")))
    )
    # Written by a CSV writer without quotes, so that every file begins with the header.
    text = orders.select(line.alias("o_orderkey,o_custkey,o_totalprice"))
    text.write.options(header=True, sep="\u0001", quote="", escapeQuotes=False).csv(stages.path("orders"))
    schema = "o_orderkey long, o_custkey long, o_totalprice double"
    good = read_csv_quarantined(spark, stages.path("orders"), schema, stages.path("quarantine"), stages, limit=10**9)
    bad = spark.read.parquet(stages.path("quarantine")).where("file like '%orders/part-%'")
    key = F.regexp_extract("line", r"(\d+)", 1).cast("long")
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(
        bad.select(key.alias("o_orderkey"), F.lit(None).cast("long").alias("o_custkey"), F.lit(None).cast("double").alias("o_totalprice"), "line")
    )


@query("""
SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def sorted_csv_export(spark, sf):
    path = Stages(spark).path("export")
    rows = table(spark, sf, "events").select(
        "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    export_sorted_csv(rows, path)
    return read_csv(spark, path, sep=";")


@query("SELECT p_partkey, p_name, p_size FROM part")
def scan_csv_mixed_headers(spark, sf):
    """Files of one kind whose headers have the same names in another order."""
    path = Stages(spark).path("parts")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    write_csv(parts.where("p_partkey % 2 = 0"), f"{path}/even")
    write_csv(parts.where("p_partkey % 2 = 1").select("p_size", "p_partkey", "p_name"), f"{path}/odd")
    return read_csv_by_header(spark, [f"{path}/even", f"{path}/odd"], "p_partkey bigint, p_name string, p_size int")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_csv_ddl(spark, sf):
    path = Stages(spark).path("customers")
    write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey >= 5")
def scan_orc_table(spark, sf):
    """A managed ORC table, replaced as a whole, read by its name."""
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    write_orc_table(nations, "callweave_nations")
    write_orc_table(nations.where("n_nationkey >= 5"), "callweave_nations")
    return read_table(spark, "callweave_nations")


@query("SELECT s_suppkey, s_name FROM supplier")
def orc_folder(spark, sf):
    path = Stages(spark).path("suppliers")
    write_orc(table(spark, sf, "supplier").select("s_suppkey", "s_name"), path)
    return spark.read.orc(path)


@query("""
SELECT place, o_orderkey FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders) WHERE place <= 100""")
def latest_orders(spark, sf):
    """Order by one column (and the key for ties); the report is the first hundred."""
    first = table(spark, sf, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100)
    place = F.row_number().over(Window.orderBy(F.desc("o_orderdate"), "o_orderkey"))
    return first.select(place.cast("long").alias("place"), "o_orderkey")


@query("SELECT min(o_orderkey) AS first_key, count(*) = 0 AS is_empty FROM orders")
def first_row_and_emptiness(spark, sf):
    first = table(spark, sf, "orders").orderBy("o_orderkey").limit(1)
    return first.agg(F.max("o_orderkey").alias("first_key"), (F.count("*") == 0).alias("is_empty"))
