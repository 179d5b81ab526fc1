from callweave.functions.dates import (
    date_columns,
    french_weekday,
    hour_label,
    iso_text,
    quarter_label,
    wall_clock,
    wall_seconds,
    wall_text,
)
from callweave.functions.predicates import is_blank, is_eight_digits_from_one, is_true
from callweave.functions.text import (
    decode_flags,
    fixed_width,
    office_code,
    read_layout,
    sip_user,
    trim_all,
    typed_nulls,
    without_blanks,
)

__all__ = [
    "date_columns", "decode_flags", "fixed_width", "french_weekday", "hour_label",
    "is_blank", "is_eight_digits_from_one", "is_true", "iso_text", "office_code",
    "quarter_label", "read_layout", "sip_user", "trim_all", "typed_nulls", "wall_clock",
    "wall_seconds", "wall_text", "without_blanks",
]
