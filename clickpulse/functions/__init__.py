"""Column expressions (built-in Spark functions only, all codegen-able)."""

from clickpulse.functions.text import (
    half_up_1dp, percent_text, id_list, pairs_to_json, minute_of, day_of, minute_text, parse_day,
)
from clickpulse.functions.predicates import all_of, optional_predicates
from clickpulse.functions.share import register_city_ratio, share_text, OTHER_LABEL

__all__ = [
    "half_up_1dp", "percent_text", "id_list", "pairs_to_json", "minute_of", "day_of",
    "minute_text", "parse_day", "all_of", "optional_predicates", "share_text", "register_city_ratio", "OTHER_LABEL",
]
