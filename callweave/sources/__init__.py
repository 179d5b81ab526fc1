from callweave.sources.days import DayStore, Draft, UnknownDayError
from callweave.sources.quarantine import BadRowsError, read_csv_quarantined
from callweave.sources.readers import (
    read_csv,
    read_csv_by_header,
    read_csv_columns,
    read_ivr_blocks,
    read_ivr_calls,
    read_layout_file,
    read_lines,
    read_table,
    read_tickets,
)
from callweave.sources.shared import Stages, shared_folder
from callweave.sources.synthetic import synthetic_tickets
from callweave.sources.writers import (
    export_sorted_csv,
    write_csv,
    write_day,
    write_days,
    write_orc,
    write_orc_table,
)

__all__ = [
    "BadRowsError", "DayStore", "Draft", "Stages", "UnknownDayError", "export_sorted_csv", "read_csv",
    "read_csv_by_header", "read_csv_columns", "read_csv_quarantined", "read_ivr_blocks",
    "read_ivr_calls", "read_layout_file", "read_lines", "read_table", "read_tickets",
    "shared_folder", "synthetic_tickets", "write_csv", "write_day", "write_days", "write_orc",
    "write_orc_table",
]
