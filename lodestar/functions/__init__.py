"""Column-level helpers: all built-in Spark expressions, no UDFs."""

from lodestar.functions.months import (  # noqa: F401
    add_months_date, date_range_filter, month_end, month_start, shift_month_end,
    shift_month_start, yyyymm,
)
from lodestar.functions.calendar import day_period, weekday_label  # noqa: F401
from lodestar.functions.values import (  # noqa: F401
    keep_or, loyalty_class, present_id, safe_ratio, to_number,
)
