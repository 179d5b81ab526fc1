"""Call rules: from matched tickets to call legs with indicators.

``v2`` is the current rule set, ``v1`` the former one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from callweave import fixed_values as fv
from callweave.functions import decode_flags, is_true
from callweave.operators import explode_roles, group_total, mark_first

CONNECTION_SECONDS = 60


def _typed(matched: DataFrame) -> DataFrame:
    """Uniform names and explicit types, so that nothing is cast by comparison later."""
    typed = matched.withColumnsRenamed(fv.MATCH_RENAMES).withColumns(
        {
            "CallType": F.col("CallType").try_cast("int"),
            "EffectiveCallDuration": F.col("EffectiveCallDuration").try_cast("int"),
            "WaitingDuration": F.col("WaitingDuration").try_cast("double"),
            "duration": F.col("duration").try_cast("double"),
            "bloc_duration": F.col("bloc_duration").try_cast("double"),
        }
    )
    return decode_flags(typed, positions={f: fv.FACILITY_POSITIONS[f] for f in fv.USED_FLAGS})


def call_legs(matched: DataFrame) -> DataFrame:
    """One row per leg of a call, from the view of one number.

    An internal call is one leg emitted and one received. A transferred call has two
    further internal legs. Every other call is one leg. Tickets without a charged number
    or call type have none.
    """
    call_type, transfer = F.col("CallType"), F.col("Transfer")
    called, charged, calling = F.col("CalledNumber"), F.col("ChargedNumber"), F.col("CallingNumber")
    first_leg = F.col("endcause").isNotNull() & (call_type == fv.FIRST_LEG_CALL_TYPE)
    # Only a transfer flag can be cleared, so no other ticket has to look for its first leg.
    flagged = mark_first(
        _typed(matched), ["InitialStartDateTime", "CalledNumber"], "StartDateTime", first_leg,
        "_first", only=transfer != 0,
    ).where(charged.isNotNull())
    calls = flagged.withColumn("Transfer", F.when(F.col("_first"), transfer * 0).otherwise(transfer))

    direction = (
        F.when(call_type.isin(fv.EMITTED_CALL_TYPES), fv.EMITTED)
        .when(call_type.isin(fv.RECEIVED_CALL_TYPES), fv.RECEIVED)
        .otherwise(fv.UNKNOWN)
    )
    size = F.length(called)
    reach = (
        F.when((size > 8) | (size == 4), fv.EXTERNAL)
        .when(size <= 8, fv.INTERNAL)
        .otherwise(fv.UNKNOWN)
    )
    no_cause, no_transfer = F.lit(None).cast("string"), F.lit(None).cast("int")

    def leg(kind, reach, called, charged, cause=no_cause, transfer=no_transfer):
        return {
            "Type_appel": kind if isinstance(kind, Column) else F.lit(kind),
            "calledNumber_externe_interne": reach,
            "CalledNumber": called,
            "ChargedNumber": charged,
            "endcause": cause,
            "Appel_transfere": transfer,
        }

    cause, inside = F.col("endcause"), F.lit(fv.INTERNAL)
    is_internal = call_type == fv.INTERNAL_CALL_TYPE
    is_transferred = (transfer == 1) & (call_type != fv.IVR_CALL_TYPE)
    payer = F.when(transfer == 1, calling).otherwise(charged)
    roles = [
        (~is_internal, leg(direction, reach, called, payer, cause, transfer)),
        (is_internal, leg(fv.EMITTED, inside, called, charged, cause, transfer)),
        (is_internal, leg(fv.RECEIVED, inside, charged, called, no_cause, transfer)),
        (is_transferred, leg(fv.EMITTED, inside, charged, calling)),
        (is_transferred, leg(fv.RECEIVED, inside, calling, charged)),
    ]
    return explode_roles(calls, roles).select(*fv.LEG_COLUMNS)


def _with_counts(legs: DataFrame) -> DataFrame:
    """Origin of the leg and the 0/1 counts that all other indicators pass on."""
    call_type, cause, kind = F.col("CallType"), F.col("endcause"), F.col("Type_appel")
    is_ivr = call_type == fv.IVR_CALL_TYPE
    return legs.withColumns(
        {
            "Origine": F.when(cause.isNotNull(), fv.ORIGIN_IVR)
            .when(is_ivr, fv.ORIGIN_IVR_UNKNOWN)
            .otherwise(fv.ORIGIN_DIRECT),
            "Date": F.substring("InitialStartDateTime", 1, 10),
            "Appels_recus": F.when(is_ivr & (cause == fv.TRANSFERRED), 0)
            .when(F.col("Appel_transfere") == 1, 0)
            .when(kind == fv.RECEIVED, 1),
            "Appels_emis": F.when(is_true(kind == fv.EMITTED), 1).otherwise(0),
            "postes_logges": F.when(call_type == fv.FIRST_LEG_CALL_TYPE, F.col("ChargedNumber")),
        }
    )


def _with_indicators(legs: DataFrame, rules: str) -> DataFrame:
    received = F.col("Appels_recus")
    cause, motive, block = F.col("endcause"), F.col("Motif_appel"), F.col("bloc_duration")
    kind, reach, origin = F.col("Type_appel"), F.col("calledNumber_externe_interne"), F.col("Origine")
    effective, call_type = F.col("EffectiveCallDuration"), F.col("CallType")
    is_ivr, is_received = call_type == fv.IVR_CALL_TYPE, kind == fv.RECEIVED
    is_direct = origin == fv.ORIGIN_DIRECT
    by_caller, by_ivr = cause == fv.RELEASED_BY_CALLER, cause == fv.RELEASED_BY_IVR
    asked, long_block = motive.isNotNull(), block > CONNECTION_SECONDS
    v2 = rules == "v2"

    def counted(condition: Column) -> Column:
        return F.when(condition, received)

    waited_by_caller = by_caller & asked & long_block
    waited = (waited_by_caller | (by_ivr & asked)) if v2 else waited_by_caller
    connected_block = block.cast("float") > CONNECTION_SECONDS
    connected = (cause == fv.TRANSFERRED) | (by_caller & asked & connected_block)
    if v2:
        connected = connected | (by_ivr & asked)
    legs = legs.withColumns(
        {
            "Origine_appel_entrant": F.when(is_received & (origin == fv.ORIGIN_IVR), fv.ORIGIN_IVR)
            .when(is_received & is_direct & (reach == fv.EXTERNAL), fv.INCOMING_EXTERNAL)
            .when(is_received & is_direct & (reach == fv.INTERNAL), fv.INCOMING_INTERNAL),
            "Mise_en_relation": counted(connected),
            "Appels_SVI": counted((origin == fv.ORIGIN_IVR) & (cause != fv.NO_LICENSE)),
            "Appels_dissuades": counted(by_ivr & motive.isNull() if v2 else by_ivr),
            "Appels_raccroches": counted(by_caller & (~asked | (block <= CONNECTION_SECONDS))),
            "Appels_sans_license": counted(cause == fv.NO_LICENSE),
            "Appels_SVI_non_reconnu": counted(is_ivr & cause.isNull()),
            "Appels_directs_internes": counted(is_direct & (reach == fv.INTERNAL)),
            "Appels_directs_externes": counted(is_direct & (reach == fv.EXTERNAL)),
        }
    )
    reached = (
        (F.col("Appels_directs_internes") == 1)
        | (F.col("Appels_directs_externes") == 1)
        | (F.col("Mise_en_relation") == 1)
    )
    legs = legs.withColumn("Appels_aboutis", counted(reached))

    arrived = F.col("Appels_aboutis") == 1
    # In v2 a leg without an end cause is never counted as answered; in v1 it can be.
    not_released = ~by_caller & ~by_ivr if v2 else ~cause.eqNullSafe(fv.RELEASED_BY_CALLER)
    waiting = F.when((cause == fv.TRANSFERRED) & (effective > 0), block).when(
        is_received & is_direct, F.col("WaitingDuration")
    )
    if v2:
        waiting = waiting.when(is_ivr & (cause == fv.TRANSFERRED), F.lit(0.0))
    forwarded = (
        (F.col("CallForwardingUnconditional") == 1)
        | (F.col("CallForwardingOnBusy") == 1)
        | (F.col("CallForwardingOnNoReply") == 1)
    )
    answered = arrived & (effective > 0) & not_released
    legs = legs.withColumns(
        {
            "Appels_decroches": F.when(answered, received).otherwise(0),
            "Appels_non_decroches": counted((arrived & (effective == 0)) | waited),
            "Appels_transferes": F.when(F.col("Appel_transfere") == 1, F.col("Appel_transfere")),
            "Appels_renvoyes": counted(forwarded),
            "Attente_avant_mise_en_relation": waiting,
            "Duree_de_navigation": F.when(is_ivr, effective),
            "Duree_de_communication": F.when(is_ivr, 0).when(
                is_received | (kind == fv.EMITTED), effective
            ),
            "Horaire_ouverture": F.when(asked | is_direct, fv.OPENING_HOURS).when(
                ~asked & (origin == fv.ORIGIN_IVR), fv.CLOSING_HOURS
            ),
        }
    )
    return legs.withColumn("Aboutissement_SVI", _outcome_v2() if v2 else _outcome_v1())


def _outcome_v2() -> Column:
    return (
        F.when(F.col("Appels_non_decroches") == 1, fv.OUTCOME_NOT_ANSWERED)
        .when(F.col("Appels_dissuades") == 1, fv.OUTCOME_DETERRED)
        .when(F.col("Appels_raccroches") == 1, fv.OUTCOME_HUNG_UP)
        .when(F.col("Appels_decroches") == 1, fv.OUTCOME_ANSWERED)
    )


def _outcome_v1() -> Column:
    cause, motive, block = F.col("endcause"), F.col("Motif_appel"), F.col("bloc_duration")
    by_caller = cause == fv.RELEASED_BY_CALLER
    connected = motive.isNotNull() | (block > CONNECTION_SECONDS)
    return (
        F.when(cause == fv.RELEASED_BY_IVR, fv.OUTCOME_V1_IVR)
        .when(by_caller & motive.isNull() & (block <= CONNECTION_SECONDS), fv.OUTCOME_V1_CALLER)
        .when((by_caller & connected) | (cause == fv.TRANSFERRED), fv.OUTCOME_V1_CONNECTED)
    )


def call_rules(
    matched: DataFrame,
    rules: str = "v2",
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """The 48 columns of the call facts.

    ``rules="v1"`` applies the former definitions of the outcome, connection, deterrence,
    answer and waiting indicators (Horaire_ouverture has no former definition and is the
    same). ``keep(df, name)`` may store a stage: the legs are read three times, for the
    repeat-call totals and for the facts.
    """
    counted = _with_counts(call_legs(matched))
    if keep is not None:
        counted = keep(counted, "legs")
    # Only received legs have a repeat count, and only they add to it.
    is_received = F.col("Type_appel") == fv.RECEIVED
    received = group_total(
        counted.where(is_received), ["CalledNumber", "Date"], "Appels_recus", "Appels",
        spread=["TicketId", "ChargedNumber"],
    )
    others = counted.where(~is_received).withColumn("Appels", F.lit(None).cast("bigint"))
    repeated = received.unionByName(others)
    return _with_indicators(repeated, rules).select(*fv.RULE_COLUMNS)
