"""Column expressions: every helper returns a ``Column`` built from
``pyspark.sql.functions`` only, so it stays inside whole-stage codegen."""

from vitrina.functions.text import (  # noqa: F401
    blank_to_null, decimal_from_text, first_token, int_from_text, leading_word,
    second_token, strip_blanks, strip_word,
)
from vitrina.functions.dates import iso_week, week_end, week_start  # noqa: F401
from vitrina.functions.ratios import guarded_percent, guarded_ratio  # noqa: F401
