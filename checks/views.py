"""Call data derived from the given tables, once as DataFrames and once as SQL.

``events`` gives tickets, voice-response calls (clicks and errors; an error calls twice),
their blocks and the users; ``region``, ``nation``, ``supplier`` and ``customer`` give the
organisation (a nation without a rich supplier has no centre). The SQL texts are ``WITH`` parts that
a query puts in front of its own.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.plans import Reference

AS_OF = datetime.date(2024, 1, 31)
CAUSES = ["TRANSFERRED", "RELEASED By Caller", "RELEASED By VAA", "NOT ENOUGH LICENSE"]
CALL_TYPES = [0, 3, 4, 7, 8, 9, 13, 14]
PLAN = [  # Indicatif, Debut, Longueur
    *[(None, f"0{d}", "10") for d in range(1, 7)],
    *[(None, f"07{d}", "10") for d in range(3, 8)],
    *[(None, f"080{d}", "10") for d in range(10)],
    (None, "30", "4"), (None, "31", "4"), (None, "30", "4"),
    ("49", None, None), ("351", None, None), ("351", None, None), ("33", None, None),
]
DIAL_CODES = [("49", "Allemagne"), ("351", "Portugal"), ("351", "Madeira"), ("33", "France")]
LAYOUT = [  # nom, de, long
    ("Numero_UA", "0", "10"), ("Date_limite_de_validite", "11", "8"), ("Code_UA", "19", "10"),
    ("Code_type_de_structure", "44", "5"), ("Etat", "70", "1"),
    ("Date_deffet_de_letat", "71", "8"), ("DIR_hierarchique", "129", "3"),
    ("CI_hierarchique", "132", "5"), ("CB_hierarchique", "137", "7"),
    ("Libelle_long_1", "144", "30"), ("Libelle_long_2", "174", "30"),
    ("Libelle_court_1", "204", "15"), ("Libelle_court_2", "219", "15"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pad(value, size: int):
    return F.lpad(value.cast("string"), size, "0")


def choose(index, values):
    chosen = F.when(index == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        chosen = chosen.when(index == i, value)
    return chosen


def calls_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, u = F.col("n"), F.col("u")
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("n"),
        F.col("user_id").alias("u"),
        "event_type",
        F.substring(F.col("ts").cast("timestamp_ntz").cast("string"), 1, 19).alias("s"),
    )
    base = base.withColumn("d8", pad(u * 79190131 % 100_000_000, 8))
    d8, d7 = F.col("d8"), F.substring("d8", 2, 7)
    numbers = [  # chosen by CASE, so that only one of them is computed per row
        F.concat(F.lit("06"), d8), F.concat(F.lit("07"), d8), F.concat(F.lit("08"), d8),
        F.concat(F.lit("3"), pad(u * 7 % 1000, 3)), F.concat(F.lit("5"), d7),
        F.lit("15"), F.lit("18"), F.lit("112"),
        F.concat(F.lit("0049"), d8), F.concat(F.lit("00351"), d8), F.concat(F.lit("00182"), d8),
        F.lit(None).cast("string"), F.concat(F.lit("09"), d8),
    ]
    return base.withColumns(
        {
            "called": choose(F.floor(n / 8) % 13, numbers),
            "charged": F.concat(F.lit("3"), d7),
            "calling": F.concat(F.when(n % 11 == 0, "1").otherwise("4"), d7),
        }
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    flag = lambda every: F.when(n % every == 0, "1").otherwise("0")
    later = (F.col("s").cast("timestamp_ntz") + F.make_dt_interval(secs=n % 3)).cast("string")
    return calls_base(spark, sf_dir).select(
        F.col("s").alias("InitialStartDateTime"),
        n.cast("string").alias("TicketId"),
        F.col("called").alias("CalledNumber"),
        F.col("calling").alias("CallingNumber"),
        choose(n % 8, [str(c) for c in CALL_TYPES]).alias("CallType"),
        (n % 4 * 15).cast("string").alias("EffectiveCallDuration"),
        F.col("called").alias("InitialDialledNumber"),
        later.alias("StartDateTime"),
        F.concat(
            F.lit("00000"), flag(7), F.lit("00"), flag(5), F.repeat(F.lit("0"), F.lit(31))
        ).alias("InternFacilities"),
        F.when(n % 13 == 0, "").otherwise(F.col("charged")).alias("ChargedNumber"),
        F.lit(None).cast("string").alias("CostCenter"),
        (n % 20).cast("string").alias("WaitingDuration"),
    )


def ivr_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    is_error = F.col("event_type") == "error"
    copies = F.when(is_error, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    second = F.unix_timestamp(F.col("s").cast("timestamp_ntz"))
    return (
        calls_base(spark, sf_dir)
        .where(F.col("event_type").isin("click", "error") & F.col("called").isNotNull())
        .select("*", F.explode(copies).alias("k"))
        .withColumns(
            {
                "id": (n * 10 + F.col("k")).cast("string"),
                "start": second + (n * 5 % 9) + F.lit(0.25) + F.col("k"),
                "cause": choose(F.floor(n / 96) % 4, CAUSES),
            }
        )
    )


def ivr_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, u = F.col("n"), F.col("u")
    return ivr_base(spark, sf_dir).select(
        "id",
        F.concat(F.lit("sip:"), "called", F.lit("@node;user=phone")).alias("caller"),
        F.col("charged").alias("called"),
        F.concat(F.lit("SITE-"), (u % 7).cast("string")).alias("tenantname"),
        F.concat(F.lit("TREE-"), (n % 3).cast("string")).alias("treename"),
        "start",
        (n % 90).cast("double").alias("duration"),
        F.col("cause").alias("endcause"),
        F.when(F.col("cause") == CAUSES[0], F.col("calling")).alias("transferredto"),
    )


def ivr_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, j = F.col("n"), F.col("j")
    code = F.concat(pad(n % 25 % 5, 3), pad(n % 25, 2), pad(F.floor(n / 25) % 100, 2))
    asked = (j == 1) & (F.floor(n / 2) % 2 == 0)
    stamp = F.col("start") + j
    return (
        ivr_base(spark, sf_dir)
        .select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j"))
        .select(
            "id",
            F.lit("ENTER_NODE").alias("event"),
            stamp.alias("timestamp"),
            F.timestamp_seconds(stamp).alias("createdate"),
            (n * 37 * (j + 1) % 120_000).cast("int").alias("duration (ms)"),
            F.when(asked, F.concat(F.lit("transfer_"), (n % 5).cast("string")))
            .otherwise(F.concat(F.lit("menu_"), j.cast("string")))
            .alias("bloc id"),
            F.when((j == 2) & (n % 4 != 1), F.concat(F.lit("BLOC-"), code))
            .otherwise("BLOC")
            .alias("bloc name"),
        )
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("u")
    center = F.concat(
        pad(u % 25 % 5, 3), F.lit(" "), pad(u % 25, 2), F.lit(" "), pad(u % 100, 2)
    )
    return (
        calls_base(spark, sf_dir)
        .select("u", "charged")
        .distinct()
        .select(
            F.col("charged").alias("Internal Number"),
            F.when(u % 10 == 0, "PAS TOUCHE").otherwise(center).alias("Cost Center"),
        )
    )


def organisation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("k"),
        pad(F.col("r_regionkey"), 3).alias("code"),
        F.lit("").alias("dir"), F.lit("").alias("ci"), F.lit("").alias("cb"),
        F.col("r_name").alias("label"),
    )
    nation = table(spark, sf_dir, "nation")
    nation_code = F.concat(pad(F.col("n_regionkey"), 3), pad(F.col("n_nationkey"), 2))
    rich = table(spark, sf_dir, "supplier").where("s_acctbal > 3000")
    with_supplier = nation.join(rich, F.col("n_nationkey") == F.col("s_nationkey"), "left_semi")
    centre = with_supplier.select(
        F.col("n_nationkey").cast("bigint").alias("k"),
        nation_code.alias("code"),
        pad(F.col("n_regionkey"), 3).alias("dir"), F.lit("").alias("ci"), F.lit("").alias("cb"),
        F.col("n_name").alias("label"),
    )
    office = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey", (F.col("c_custkey") % 100).alias("suffix"))
        .agg(F.min("c_custkey").alias("k"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "k",
            F.concat(nation_code, pad(F.col("suffix"), 2)).alias("code"),
            pad(F.col("n_regionkey"), 3).alias("dir"),
            nation_code.alias("ci"),
            F.when(F.col("k") % 17 == 3, "0000001").otherwise("").alias("cb"),
            F.concat(F.lit("OFFICE "), F.col("k").cast("string")).alias("label"),
        )
    )
    units = region.unionByName(centre).unionByName(office)
    k, size = F.col("k"), F.length("code")
    ends = (
        F.when((size == 7) & (k % 11 == 5), "20210630")
        .when((size == 7) & (k % 13 == 5), "20991231")
        .otherwise("99999999")
    )
    versions = F.explode(
        F.array(
            F.struct(ends.alias("ends"), F.lit("").alias("mark")),
            F.struct(F.lit("20200101").alias("ends"), F.lit("OLD ").alias("mark")),
        )
    )
    unit = units.select("*", versions.alias("v")).select("*", "v.*")

    def field(value, width: int):
        return F.rpad(value if not isinstance(value, str) else F.lit(value), width, " ")

    line = F.concat(
        field(F.concat(F.lit("UA"), k.cast("string")), 10), F.col("ends"),
        field(F.col("code"), 10), field("", 15), field("ADMIN", 5), field("", 21), F.lit("A"),
        F.when(k % 7 == 2, "00000000").otherwise("20190101"), field("", 50),
        field(F.col("dir"), 3), field(F.col("ci"), 5), field(F.col("cb"), 7),
        field(F.concat("mark", "label"), 30),
        field(F.concat(F.lit("UNIT, "), F.substring("code", 1, 5)), 30),
        field(F.concat(F.lit("U"), k.cast("string")), 15), field("", 15),
    )
    title = table(spark, sf_dir, "region").where("r_regionkey = 0").select(
        field(F.concat(F.repeat(F.lit("T"), F.lit(43)), F.lit("CTURE")), 233).alias("value")
    )
    return unit.select(line.alias("value")).unionByName(title)


def reference(spark: SparkSession, sf_dir: str) -> Reference:
    return Reference(
        users=users(spark, sf_dir),
        organisation_lines=organisation_lines(spark, sf_dir),
        organisation_layout=spark.createDataFrame(LAYOUT, "nom string, de string, long string"),
        numbering_plan=plan(spark),
        dial_codes=dial_codes(spark),
    )


def plan(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLAN, "Indicatif string, Debut string, Longueur string")


def dial_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIAL_CODES, "Indicatif string, Pays string")


# --- the same views as SQL --------------------------------------------------------


def _literal(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)


BASE_SQL = """
base0 AS (
  SELECT event_id AS n, user_id AS u, event_type, date_trunc('second', ts) AS s,
         lpad(CAST(user_id * 79190131 % 100000000 AS VARCHAR), 8, '0') AS d8 FROM events),
base AS (
  SELECT n, u, event_type, s, d8, substr(d8, 2) AS d7,
    CASE (n // 8) % 13
      WHEN 0 THEN '06' || d8 WHEN 1 THEN '07' || d8 WHEN 2 THEN '08' || d8
      WHEN 3 THEN '3' || lpad(CAST(u * 7 % 1000 AS VARCHAR), 3, '0')
      WHEN 4 THEN '5' || substr(d8, 2) WHEN 5 THEN '15' WHEN 6 THEN '18' WHEN 7 THEN '112'
      WHEN 8 THEN '0049' || d8 WHEN 9 THEN '00351' || d8 WHEN 10 THEN '00182' || d8
      WHEN 12 THEN '09' || d8 END AS called,
    '3' || substr(d8, 2) AS charged,
    CASE WHEN n % 11 = 0 THEN '1' ELSE '4' END || substr(d8, 2) AS calling
  FROM base0)"""

TICKETS_SQL = """
t AS (
  SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS "InitialStartDateTime", CAST(n AS VARCHAR) AS "TicketId",
    called AS "CalledNumber", calling AS "CallingNumber",
    CAST(CASE n % 8 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 7 WHEN 4 THEN 8
         WHEN 5 THEN 9 WHEN 6 THEN 13 ELSE 14 END AS VARCHAR) AS "CallType",
    CAST(15 * (n % 4) AS VARCHAR) AS "EffectiveCallDuration", called AS "InitialDialledNumber",
    strftime(s + to_seconds(n % 3), '%Y-%m-%d %H:%M:%S') AS "StartDateTime",
    '00000' || CASE WHEN n % 7 = 0 THEN '1' ELSE '0' END || '00'
      || CASE WHEN n % 5 = 0 THEN '1' ELSE '0' END || repeat('0', 31) AS "InternFacilities",
    CASE WHEN n % 13 = 0 THEN '' ELSE charged END AS "ChargedNumber",
    CAST(NULL AS VARCHAR) AS "CostCenter", CAST(n % 20 AS VARCHAR) AS "WaitingDuration"
  FROM base)"""

IVR_SQL = """
ib AS (
  SELECT base.*, k, CAST(10 * n + k AS VARCHAR) AS id,
    CAST(epoch(s) + (n * 5 % 9) + k AS DOUBLE) + 0.25 AS start,
    CASE (n // 96) % 4 WHEN 0 THEN 'TRANSFERRED' WHEN 1 THEN 'RELEASED By Caller'
      WHEN 2 THEN 'RELEASED By VAA' ELSE 'NOT ENOUGH LICENSE' END AS cause
  FROM base, (VALUES (0), (1)) AS c(k)
  WHERE event_type IN ('click', 'error') AND called IS NOT NULL AND (k = 0 OR event_type = 'error')),
ivr_calls AS (
  SELECT id, 'sip:' || called || '@node;user=phone' AS caller, charged AS called,
    'SITE-' || (u % 7) AS tenantname, 'TREE-' || (n % 3) AS treename, start,
    CAST(n % 90 AS DOUBLE) AS duration, cause AS endcause,
    CASE WHEN cause = 'TRANSFERRED' THEN calling END AS transferredto
  FROM ib),
ivr_blocks AS (
  SELECT id, start + j AS "timestamp", CAST(n * 37 * (j + 1) % 120000 AS INTEGER) AS ms,
    CASE WHEN j = 1 AND (n // 2) % 2 = 0 THEN 'transfer_' || (n % 5)
         ELSE 'menu_' || j END AS bloc_id,
    CASE WHEN j = 2 AND n % 4 <> 1 THEN 'BLOC-' || lpad(CAST(n % 25 % 5 AS VARCHAR), 3, '0')
           || lpad(CAST(n % 25 AS VARCHAR), 2, '0')
           || lpad(CAST((n // 25) % 100 AS VARCHAR), 2, '0')
         ELSE 'BLOC' END AS bloc_name
  FROM ib, (VALUES (0), (1), (2)) AS b(j))"""

USERS_SQL = """
users AS (
  SELECT DISTINCT charged AS internal, CASE WHEN u % 10 = 0 THEN 'PAS TOUCHE' ELSE
    lpad(CAST(u % 25 % 5 AS VARCHAR), 3, '0') || ' ' || lpad(CAST(u % 25 AS VARCHAR), 2, '0')
    || ' ' || lpad(CAST(u % 100 AS VARCHAR), 2, '0') END AS center
  FROM base)"""

ORGANISATION_SQL = """
nat AS (
  SELECT *, lpad(CAST(n_regionkey AS VARCHAR), 3, '0') AS d,
    lpad(CAST(n_regionkey AS VARCHAR), 3, '0') || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS c
  FROM nation),
units AS (
  SELECT r_regionkey AS k, lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS code, '' AS dir, '' AS ci,
    '' AS cb, r_name AS label FROM region
  UNION ALL
  SELECT n_nationkey, c, d, '', '', n_name FROM nat
  WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 3000)
  UNION ALL
  SELECT k, c || lpad(CAST(suffix AS VARCHAR), 2, '0'), d, c,
    CASE WHEN k % 17 = 3 THEN '0000001' ELSE '' END, 'OFFICE ' || k
  FROM (SELECT c_nationkey, c_custkey % 100 AS suffix, min(c_custkey) AS k
        FROM customer GROUP BY ALL) o JOIN nat ON n_nationkey = c_nationkey),
versions AS (
  SELECT *, CASE WHEN length(code) = 7 AND k % 11 = 5 THEN '20210630'
                 WHEN length(code) = 7 AND k % 13 = 5 THEN '20991231'
                 ELSE '99999999' END AS ends, '' AS mark FROM units
  UNION ALL SELECT *, '20200101', 'OLD ' FROM units),
lines AS (
  SELECT rpad('UA' || k, 10, ' ') || ends || rpad(code, 10, ' ') || repeat(' ', 15) || 'ADMIN'
    || repeat(' ', 21) || 'A' || CASE WHEN k % 7 = 2 THEN '00000000' ELSE '20190101' END
    || repeat(' ', 50) || rpad(dir, 3, ' ') || rpad(ci, 5, ' ') || rpad(cb, 7, ' ')
    || rpad(mark || label, 30, ' ') || rpad('UNIT, ' || substr(code, 1, 5), 30, ' ')
    || rpad('U' || k, 15, ' ') || repeat(' ', 15) AS value
  FROM versions
  UNION ALL SELECT rpad(repeat('T', 43) || 'CTURE', 233, ' ') FROM region WHERE r_regionkey = 0)"""

PLAN_SQL = f"""
plan(indicatif, debut, longueur) AS (VALUES {_values(PLAN)}),
codes(indicatif, pays) AS (VALUES {_values(DIAL_CODES)})"""


def with_views(*parts: str, select: str) -> str:
    return "WITH " + ",".join(part.strip() for part in parts) + "\n" + select.strip()
