"""Month-lag features: values of earlier months attached to the current row.

The base and all history tables are put under one another as rows of (key,
month index, base row, one struct per history) and dealt by key once; lag
``k`` of a table is then the one struct in the range frame exactly ``k``
months before.  No join is left: one exchange and one sort serve every table
and lag, a history is read once however many lags there are, and a base row
without any history keeps its place.  With ``star`` the row's own month is one
more frame, so the star of base and histories is never dealt or sorted as
wide rows.  Parts that the caller has dealt by the key are not dealt again
(all of them must be, in the session's number of shuffle partitions).

A window partition holds a key's months times the tables, as each history is
unique on (key, month): a bound set by the calendar, so no key is hot.  The
same window checks it: the rows in each lag's frame are counted beside the
value, and a second row of one history fails the query, naming the table and
the lag, where any value would be as good as the other.  The check costs no
exchange and no pass; ``check=False`` leaves it out.

Months are compared as year * 12 + month: base and history months are month
ends, as everywhere in this library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.functions.months import month_end, shift_month_end


def lag_name(col: str, k: int) -> str:
    return f"{col}_p{k}"


def _month_index(col):
    return F.year(col) * 12 + F.month(col)


def month_lags(base: DataFrame, histories: Sequence[tuple[DataFrame, Sequence[str]]],
               keys: Sequence[str] = ("analytic_id",), base_month: str = "ddate",
               history_month: str = "ddate", lags: Sequence[int] = (1, 2),
               month_bounds=None, check: bool = True, star: bool = False) -> DataFrame:
    """Attach ``{col}_p{k}`` for every history column and lag ``k``.

    ``histories`` = [(table, columns)]; output columns are ordered by lag,
    then table, then column.  ``month_bounds`` = (first, last) base month; the
    histories are filtered on their own month column with literals (pushed to
    the scan) to the months the lags need.  Rows with a NULL key or month get
    NULL lags.

    A history that is ``base`` itself is taken from the base rows and not put
    under them a second time.  With ``star`` the other histories' values of
    the row's own month come along too, under their own names and before the
    lags, as left joins on key and month attach them: NULL without a match, a
    row per match with several.
    """
    keys, lags = list(keys), list(lags)
    if star and month_bounds is not None:
        raise ValueError("month_bounds keep the months of the lags only, star needs the rows' own")
    own = [t is base and history_month == base_month and month_bounds is None for t, _ in histories]
    slots = ["_row" if o else f"_h{i}" for i, o in enumerate(own)]
    carried = [s for s in slots if s != "_row"]
    by = [f"_k{i}" for i in range(len(keys))]
    types = [F.struct(*[F.col(c) for c in cols]) for _, cols in histories]
    kinds = [t.select(x.alias("x")).schema["x"].dataType for (t, _), x in zip(histories, types)]
    row_type = base.select(F.struct("*").alias("x")).schema["x"].dataType

    def none(kind):
        return F.lit(None).cast(kind)

    # base rows without a key match nothing: scattered, not met in one task
    unkeyed = F.col(base_month).isNull()
    for k in keys:
        unkeyed = unkeyed | F.col(k).isNull()
    parts = [base.select(*[F.col(k).alias(n) for k, n in zip(keys, by)], _month_index(base_month).alias("_m"),
                         F.when(unkeyed, F.pmod(F.xxhash64(F.struct("*")), F.lit(1 << 20))).otherwise(F.lit(0)).alias("_s"),
                         F.struct("*").alias("_row"), *[none(k).alias(s) for k, s in zip(kinds, slots) if s in carried])]
    for i, (table, _) in enumerate(histories):
        if own[i]:
            continue
        t = table
        if month_bounds is not None:
            lo, hi = month_bounds
            t = t.filter(F.col(history_month).between(F.lit(month_end(lo, max(lags))), F.lit(month_end(hi, min(lags)))))
        parts.append(t.select(*[F.col(k).alias(n) for k, n in zip(keys, by)], _month_index(history_month).alias("_m"),
                              F.lit(0).cast("long").alias("_s"), none(row_type).alias("_row"),
                              *[types[i].alias(s) if j == i else none(kinds[j]).alias(s)
                                for j, s in enumerate(slots) if s in carried]))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    known = F.col("_m").isNotNull()
    for n in by:
        known = known & F.col(n).isNotNull()
    w = Window.partitionBy(*by, "_s").orderBy("_m")

    def lagged(i: int, k: int):
        frame, s = w.rangeBetween(-k, -k), slots[i]
        value = F.first(s, ignorenulls=True).over(frame)
        if check:
            said = F.lit(f"history {i + 1} has several rows of one key {k} months before a row")
            value = F.when(F.col("_row").isNotNull() & (F.count(s).over(frame) > 1), F.raise_error(said)).otherwise(value)
        return F.when(known, value).alias(f"_v{i}_{k}")

    now = [i for i, s in enumerate(slots) if star and s in carried]
    met = [F.when(known, F.collect_list(slots[i]).over(w.rangeBetween(0, 0))).alias(f"_n{i}") for i in now]
    picked = rows.select("_row", *met, *[lagged(i, k) for k in lags for i in range(len(slots))]).filter("_row is not null")
    for i in now:
        picked = picked.withColumn(f"_n{i}", F.explode_outer(f"_n{i}"))
    return picked.select("_row.*", *[F.col(f"_n{i}").getField(c).alias(c) for i in now for c in histories[i][1]], *[
        F.col(f"_v{i}_{k}").getField(c).alias(lag_name(c, k))
        for k in lags for i, (_, cols) in enumerate(histories) for c in cols])


def month_lags_literal(base: DataFrame, histories, keys=("analytic_id",),
                       base_month: str = "ddate", history_month: str = "ddate",
                       lags=(1, 2)) -> DataFrame:
    """The one-join-per-table-and-lag form (bench comparison and tests)."""
    keys = list(keys)
    out = base
    for k in lags:
        out = out.withColumn(f"_p{k}_map", shift_month_end(base_month, -k))
    for k in lags:
        for table, cols in histories:
            right = table.select(*keys, F.col(history_month).alias(f"_p{k}_map"),
                                 *[F.col(c).alias(lag_name(c, k)) for c in cols])
            out = out.join(right, keys + [f"_p{k}_map"], "left")
    return out.drop(*[f"_p{k}_map" for k in lags])
