"""Cleansing: mean imputation, unknown / zero fills and category recodes.

Everything after the mean fit is one projection over the input, so the row
count is preserved and no self-join on a non-unique key can multiply or
lose rows.  The fitted means live in an ``ImputerModel`` that is saved with
the model and reused when scoring (fit on training data only).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer, ImputerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.values import keep_or, loyalty_class, to_number
from lodestar.operators.pivot import qcol, zero_fill

# Fixed values (must equal the reference's): mean-imputed columns, kept
# gender values, kept handset OS values.
MEAN_COLS = ["age", "handset_launchprice", "credit_limit"]
GENDER_KEEP = ["Male", "Female"]
OS_KEEP = ["Android", "iOS", "Proprietary", "Unknown"]


def fit_means(df: DataFrame, cols: Sequence[str] = MEAN_COLS) -> ImputerModel:
    """Column means (NULL and NaN ignored) as a reusable ImputerModel."""
    cols = list(cols)
    return Imputer(inputCols=cols, outputCols=cols, strategy="mean").fit(df)


def prepare_numbers(df: DataFrame, number_cols: Sequence[str] = ("age",),
                    id_col: str = "analytic_id") -> DataFrame:
    """Text numbers -> double (unparsable -> NULL); drop rows without an id."""
    out = df
    for c in number_cols:
        out = out.withColumn(c, to_number(c))
    return out.filter(F.col(id_col).isNotNull())


def cleanse(df: DataFrame, id_cols: Sequence[str], zero_cols: Sequence[str],
            means: ImputerModel | None = None, mean_cols: Sequence[str] = MEAN_COLS,
            unknown_cols: Sequence[str] = ("gender", "handset_os", "new_pack_cat"),
            id_col: str = "analytic_id") -> tuple[DataFrame, ImputerModel]:
    """Impute and recode in one pass; returns (clean table, fitted means).

    Output: ids, mean-imputed columns, ``mnp_flag`` (NULL -> "N"),
    ``gender`` (Male/Female else "unknown"), ``handset_os`` (NULL ->
    "unknown" -> not kept -> "others"), other ``unknown_cols`` (NULL ->
    "unknown"), zero-filled numerics and ``serenade`` (loyalty class).
    """
    d = prepare_numbers(df, ("age",) if "age" in mean_cols else (), id_col)
    means = means or fit_means(d, mean_cols)
    d = means.transform(d)
    types = dict(d.dtypes)
    unknown = [c for c in unknown_cols if c not in ("gender", "handset_os")]
    cols = [qcol(c) for c in id_cols]
    cols += [qcol(c) for c in mean_cols]
    cols.append(F.coalesce(F.col("mnp_flag"), F.lit("N")).alias("mnp_flag"))
    cols.append(keep_or("gender", GENDER_KEEP, "unknown").alias("gender"))
    cols.append(keep_or(F.coalesce(F.col("handset_os"), F.lit("unknown")), OS_KEEP, "others")
                .alias("handset_os"))
    cols += [F.coalesce(qcol(c), F.lit("unknown")).alias(c) for c in unknown]
    cols += [zero_fill(c, types[c]).alias(c) for c in zero_cols]
    cols.append(loyalty_class("master_segment_id").alias("serenade"))
    return d.select(*cols), means

