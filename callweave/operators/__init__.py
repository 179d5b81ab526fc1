from callweave.operators.compare import (
    changed_rows,
    columns_only_left,
    diff_by_column,
    diff_summary,
    fingerprint,
    normalize_for_diff,
    schema_differences,
)
from callweave.operators.contract import missing_columns, require_columns, require_schema
from callweave.operators.groups import (
    dedup_on,
    group_total,
    joined_labels,
    latest_per_key,
    latest_version,
    mark_first,
)
from callweave.operators.joins import (
    anti_join,
    attach_by_key,
    dial_code_lookup,
    enrich,
    null_safe_join,
    prefix_lookup,
    require_parents,
    tolerance_join,
)
from callweave.operators.ranged import changed_rows_ranged, differing_ranges, range_edges, store_ranged, stored_rows
from callweave.operators.rows import distinct_in_ranges, explode_roles, repeat_rows, top_order, union_aligned

__all__ = [
    "anti_join", "attach_by_key", "changed_rows", "changed_rows_ranged", "columns_only_left",
    "dedup_on", "dial_code_lookup", "diff_by_column", "differing_ranges", "diff_summary", "distinct_in_ranges", "enrich",
    "explode_roles", "fingerprint", "group_total", "joined_labels", "latest_per_key",
    "latest_version", "mark_first", "missing_columns", "normalize_for_diff",
    "null_safe_join", "prefix_lookup", "range_edges", "repeat_rows", "require_columns", "require_parents",
    "require_schema", "schema_differences", "store_ranged", "stored_rows", "tolerance_join", "top_order", "union_aligned",
]
