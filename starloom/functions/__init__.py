"""Column expressions (all built-in Spark functions unless noted)."""

from starloom.functions.html import decode_entities, html_text, strip_markup, with_html_text
from starloom.functions.money import hundredths_to_money, money, money_sum
from starloom.functions.recode import (
    DEFAULT_CATEGORIES,
    GENDER_CODES,
    bool_label,
    fill_defaults,
    recode,
)
from starloom.functions.timeparts import (
    bucket,
    calendar_columns,
    date_parts,
    day_name,
    season,
    time_member_columns,
    time_of_day,
    weekday_flag,
)

__all__ = [
    "DEFAULT_CATEGORIES", "GENDER_CODES", "bool_label", "bucket", "calendar_columns",
    "date_parts", "day_name", "decode_entities", "fill_defaults", "html_text",
    "hundredths_to_money", "money", "money_sum", "recode", "season", "strip_markup",
    "time_member_columns", "time_of_day", "weekday_flag", "with_html_text",
]
