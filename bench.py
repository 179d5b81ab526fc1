"""Timings of the headline queries, and of the plain form of the main operators.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. BENCH_PLAIN=1 also times the plain form of the matching of calls,
which takes minutes. Every result is computed in full (written to the no-op sink). The
operators run on stored inputs, so that they are timed and not the derivation of the test
data; ``plain`` holds the same results computed the straightforward way (join and filter,
one join per step, union of branches, window per key, one EXCEPT per direction or column).
"""

import json
import os
import time
from dataclasses import replace
from functools import reduce

from pyspark.sql import SparkSession, Window, functions as F

from callweave import fixed_values as fv
from callweave.functions import wall_seconds
from callweave.operators import (
    changed_rows,
    diff_by_column,
    explode_roles,
    fingerprint,
    group_total,
    latest_per_key,
    tolerance_join,
)
from callweave.plans import (
    call_legs,
    call_rules,
    cross_reference,
    day_facts,
    ivr_prep,
    match_calls,
    org_directory,
    stats_export,
    tariff_classify,
    ticket_prep,
    user_directory,
)
from callweave.sources import Stages
from checks import building_blocks, views

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("callweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(make) -> float:
    began = time.time()
    make().write.format("noop").mode("overwrite").save()
    return round(time.time() - began, 3)


def union_all(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


def plain_ivr_prep(blocks, calls):
    """Two windows and a join."""
    latest = Window.partitionBy("id").orderBy(F.desc("timestamp"))

    def last(df):
        return df.withColumn("place", F.row_number().over(latest)).where("place = 1")

    a = last(blocks).select("id", "bloc name", (F.col("duration (ms)") / 1000).alias("bloc duration"))
    b = last(blocks.where(F.col("bloc id").contains("transfer_"))).select(
        "id", F.col("bloc name").alias("Motif appel"), "bloc id"
    )
    return a.join(b, "id", "left").join(calls, "id")


def plain_match(tickets, ivr):
    """Equal numbers first, then the filter on time, then two joins of the full rows."""
    distance = F.abs(F.floor("start") - wall_seconds(F.col("InitialStartDateTime"), "UTC"))
    near = (
        tickets.select("TicketId", "CalledNumber", "InitialStartDateTime")
        .join(ivr, F.col("CalledNumber") == F.col("temp_caller"))
        .where(distance <= 4)
        .select("TicketId", "started_datetime", "endcause")
    )
    again = ivr.withColumnsRenamed({"started_datetime": "date", "temp_caller": "temp", "endcause": "end"})
    return tickets.join(near, "TicketId", "left").join(
        again, (F.col("CalledNumber") == F.col("temp")) & (F.col("started_datetime") == F.col("date")), "left"
    )


def plain_tariff(legs, plan, codes):
    """One filtered branch with its own join per class, and their union."""
    number, size = F.col("CalledNumber"), F.length("CalledNumber")
    ten = size == 10
    classes = [
        (ten & number.startswith("08"), 4, fv.TO_SPECIAL), (ten & number.startswith("07"), 3, fv.TO_NATIONAL),
        (ten & ~number.startswith("07") & ~number.startswith("08"), 2, fv.TO_NATIONAL), (size == 4, 2, fv.TO_SHORT),
    ]
    prefixes = plan.select("Debut", F.col("Longueur").cast("int")).dropna().distinct()
    columns = [*fv.RULE_COLUMNS, "Appel_facturable", "Appel_vers", "Pays"]

    def done(df, billing, to, country=None):
        return df.withColumns({
            "Appel_facturable": billing, "Appel_vers": F.lit(to),
            "Pays": country if country is not None else F.lit(None).cast("string"),
        }).select(*columns)

    parts = [
        done(
            legs.where(condition).join(prefixes, (F.substring(number, 1, k) == F.col("Debut")) & (size == F.col("Longueur")), "left"),
            F.when(F.col("Debut").isNotNull(), fv.IN_PLAN).otherwise(fv.OUT_OF_PLAN), to,
        )
        for condition, k, to in classes
    ]
    short = (size < 10) & (size != 4) & (size != 8)
    urgent = number.isin(fv.EMERGENCY_NUMBERS)
    for condition, to in [(size == 8, fv.TO_INTERNAL), (short & urgent, fv.TO_EMERGENCY), (short & ~urgent, fv.TO_INTERNAL)]:
        parts.append(done(legs.where(condition), F.lit(fv.IN_PLAN), to))
    countries = codes.groupBy("Indicatif").agg(F.concat_ws(", ", F.collect_list("Pays")).alias("Pays"))
    emitted = legs.where((size > 10) & (F.col("Type_appel") == fv.EMITTED))
    bare = F.regexp_replace(number, "^00", "")
    tried = union_all([emitted.withColumn("code", F.substring(bare, 1, k)) for k in (2, 3)])
    named = tried.join(countries, F.col("code") == F.col("Indicatif"), "left").drop("Indicatif")
    hits = named.join(plan.select("Indicatif").distinct(), F.col("code") == F.col("Indicatif"))
    parts.append(done(hits, F.lit(fv.IN_PLAN), fv.TO_INTERNATIONAL, F.col("Pays")))
    missed = named.join(hits.groupBy("TicketId").count(), "TicketId", "left_anti")
    parts.append(done(missed.select(*fv.RULE_COLUMNS).distinct(), F.lit(fv.OUT_OF_PLAN), fv.TO_INTERNATIONAL))
    received = legs.where((size > 10) & (F.col("Type_appel") == fv.RECEIVED))
    parts.append(done(received, F.lit(None).cast("string"), fv.TO_INTERNATIONAL))
    return union_all(parts)


def plain_fan_out(orders, roles):
    return union_all([orders.where(condition).select("o_orderkey", *[v.alias(n) for n, v in values.items()]) for condition, values in roles])


def main():
    spark = session()
    stages = Stages(spark)

    def table(name):
        return views.table(spark, SF, name)

    # Inputs, stored once and not timed.
    raw = stages.keep(views.tickets(spark, SF), "raw_tickets")
    blocks = stages.keep(views.ivr_blocks(spark, SF), "blocks")
    calls = stages.keep(views.ivr_calls(spark, SF), "calls")
    tickets = stages.keep(ticket_prep(raw), "tickets")
    ivr = stages.keep(ivr_prep(blocks, calls), "ivr")
    matched = stages.keep(match_calls(tickets, ivr, "UTC"), "matched")
    legs = stages.keep(call_rules(matched), "rules")
    reference = views.reference(spark, SF)
    lines = stages.keep(reference.organisation_lines, "lines")
    users = stages.keep(reference.users, "users")
    organisation = stages.keep(org_directory(lines, reference.organisation_layout, views.AS_OF), "org")
    daily_reference = replace(reference, organisation_lines=lines, users=users)
    plan, codes = views.plan(spark), views.dial_codes(spark)
    tariffs = stages.keep(tariff_classify(legs, plan, codes), "tariffs")
    items = table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("bigint").alias("quantity"),
        F.to_date("l_shipdate").alias("day"),
    )
    events = table("events").select("user_id", "event_id", "ts", "event_type")
    left, right = building_blocks._two_versions(spark, SF)
    orders = table("orders")
    urgent, final = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "F"
    roles = [
        (~final, {"role": F.lit("buyer"), "party": F.col("o_custkey")}),
        (final, {"role": F.lit("receiver"), "party": F.col("o_custkey")}),
        (urgent, {"role": F.lit("urgent"), "party": F.lit(None).cast("bigint")}),
    ]
    number_time = tickets.select(
        "TicketId", F.col("CalledNumber").alias("number"), wall_seconds(F.col("InitialStartDateTime"), "UTC").alias("second")
    ).where("number is not null")
    call_time = ivr.select("id", "temp_caller", F.floor("start").alias("call_second"))
    times = ("number", "temp_caller", "second", "call_second", 4)
    keys = ["l_returnflag", "day"]

    queries = {
        "ticket_prep": lambda: ticket_prep(raw),
        "ivr_prep": lambda: ivr_prep(blocks, calls),
        "tolerance_pairs": lambda: tolerance_join(number_time, call_time, *times),
        "match_calls": lambda: match_calls(tickets, ivr, "UTC"),
        "call_legs": lambda: call_legs(matched),
        "call_rules": lambda: call_rules(matched, keep=Stages(spark).keep),
        "tariff_classify": lambda: tariff_classify(legs, plan, codes),
        "org_directory": lambda: org_directory(lines, reference.organisation_layout, views.AS_OF),
        "daily_run": lambda: day_facts(raw, blocks, calls, daily_reference, views.AS_OF, Stages(spark), "UTC"),
        "stats_export": lambda: stats_export(
            cross_reference(tariffs, user_directory(users, organisation), organisation)
        ),
        "latest_per_key": lambda: latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")]),
        "group_total": lambda: group_total(items, keys, "quantity", "total", ["l_orderkey", "l_linenumber"]),
        "fan_out": lambda: explode_roles(orders, roles).select("o_orderkey", "role", "party"),
        "dataset_diff": lambda: changed_rows(left, right),
        "diff_by_column": lambda: diff_by_column(left, right, "o_orderkey"),
        "fingerprint": lambda: fingerprint(table("lineitem")),
    }
    ordered = left.columns
    plain = {
        "ivr_prep": lambda: plain_ivr_prep(blocks, calls),
        "tolerance_pairs": lambda: tolerance_join(number_time, call_time, *times, bucketed=False),
        "tariff_classify": lambda: plain_tariff(legs, plan, codes),
        "group_total": lambda: items.withColumn("total", F.sum("quantity").over(Window.partitionBy(*keys))),
        "fan_out": lambda: plain_fan_out(orders, roles),
        "dataset_diff": lambda: left.subtract(right.select(*ordered)).unionByName(right.select(*ordered).subtract(left)),
        "diff_by_column": lambda: union_all([
            a.select("o_orderkey", F.col(c).cast("string").alias("v")).subtract(b.select("o_orderkey", F.col(c).cast("string").alias("v")))
            for a, b in ((left, right), (right, left)) for c in ordered if c != "o_orderkey"
        ]),
    }
    took, took_plain = {}, {}
    for name, make in queries.items():
        timed(make)  # the first run compiles
        took[name] = min(timed(make) for _ in range(2))
        if name in plain:
            timed(plain[name])
            took_plain[name] = min(timed(plain[name]) for _ in range(2))
    if os.environ.get("BENCH_PLAIN"):
        took_plain["match_calls"] = timed(lambda: plain_match(tickets, ivr))
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "plain": took_plain,
        "sf": os.path.basename(SF.rstrip("/")).replace("sf", ""),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
