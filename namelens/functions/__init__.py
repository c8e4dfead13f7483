from namelens.functions.paths import parse_upload_path
from namelens.functions.sql import register_functions
from namelens.functions.text import flag, normalize_gender, normalize_name, normalize_zip5
from namelens.functions.values import (
    DATE_FORMATS,
    PROBABILITY_TYPE,
    decile,
    record_order,
    share,
    try_date,
    try_number,
)

__all__ = [
    "DATE_FORMATS",
    "PROBABILITY_TYPE",
    "decile",
    "flag",
    "normalize_gender",
    "normalize_name",
    "normalize_zip5",
    "parse_upload_path",
    "record_order",
    "register_functions",
    "share",
    "try_date",
    "try_number",
]
