"""Calendar labels: weekday codes and day periods of an hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's column prefixes): weekday labels
# Monday..Sunday and the four day periods.
WEEKDAY_LABELS = ["01_Mon", "02_Tue", "03_Wed", "04_Thu", "05_Fri", "06_Sat", "07_Sun"]
DAY_PERIODS = ["night", "morning", "afternoon", "prime"]


def weekday_label(col: Column | str) -> Column:
    """``01_Mon`` .. ``07_Sun`` by ISO weekday; independent of the locale."""
    c = F.col(col) if isinstance(col, str) else col
    return F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_LABELS]), F.weekday(c) + 1)


def day_period(hour: Column | str) -> Column:
    """Hour -> period: 0 prime, 1-5 night, 6-12 morning, 13-18 afternoon, 19-24 prime.

    Hours outside 0..24 give NULL (filter them with ``between(0, 23)`` first).
    """
    h = F.col(hour) if isinstance(hour, str) else hour
    name = F.lit("prime")
    for last, period in ((18, "afternoon"), (12, "morning"), (5, "night")):
        name = F.when(h <= last, period).otherwise(name)
    return F.when(h.between(0, 24), F.when(h == 0, "prime").otherwise(name))
