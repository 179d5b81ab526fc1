"""Preparation of the voice-response calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave import fixed_values as fv
from callweave.functions import office_code, sip_user
from callweave.operators import require_columns


def ivr_prep(blocks: DataFrame, calls: DataFrame) -> DataFrame:
    """One row per voice-response call that has blocks: its last block, its last transfer
    block, the office code named in the last block and the caller's number.

    The last block is the one with the greatest timestamp; equal timestamps are decided by
    the greater block id, name and duration. Both blocks come out of one aggregation, whose
    partial step keeps two blocks per call and task.
    """
    require_columns(blocks, fv.IVR_BLOCK_REQUIRED, "IVR blocks")
    require_columns(calls, fv.IVR_CALL_REQUIRED, "IVR calls")
    block = F.struct("timestamp", "bloc id", "bloc name", "duration (ms)")
    is_transfer = F.col("bloc id").contains(fv.TRANSFER_BLOCK_MARK)
    last = (
        blocks.groupBy("id")
        .agg(F.max(block).alias("last"), F.max(F.when(is_transfer, block)).alias("motive"))
        .select(
            "id",
            (F.col("last")["duration (ms)"] / 1000).alias("bloc duration"),
            F.col("last")["bloc name"].alias("bloc name"),
            F.col("motive")["bloc name"].alias("Motif appel"),
            F.col("motive")["bloc id"].alias("bloc id"),
        )
    )
    return last.join(calls.select(*fv.IVR_CALL_REQUIRED), "id").withColumns(
        {
            "started_datetime": F.col("start").cast("timestamp"),
            "SAGES (bloc)": office_code(F.col("bloc name")),
            "temp_caller": sip_user(F.col("caller")),
        }
    )
