"""Boosted-tree propensity model on spark.ml: fit, evaluate, score, persist.

Categorical predictors are indexed (unseen values get their own index at
scoring), numeric predictors are assembled as they are, and a
``GBTClassifier`` is fitted on the training share of a hash split.  Tree
learners read the nominal metadata of the indexed columns, so no one-hot
expansion is needed.  Training is distributed by spark.ml; the data never
leaves Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's): categorical predictors and the
# boosted-tree settings (trees, learning rate, depth, row and column
# sampling, seed) and the split ratio.
CATEGORICAL = ["mnp_flag", "gender", "handset_os", "serenade", "new_pack_cat"]
GBT_PARAMS = {"maxIter": 400, "stepSize": 0.01, "maxDepth": 8,
              "subsamplingRate": 0.8, "featureSubsetStrategy": "0.61", "seed": 567}
SPLIT_RATIO, SPLIT_SEED = 0.75, 567
ID_COLS = ["analytic_id", "crm_sub_id", "camp_response", "national_id", "register_date"]


def predictors(df: DataFrame, exclude: Sequence[str] = ID_COLS) -> tuple[list[str], list[str]]:
    """(numeric, categorical) predictor names: every column except ids/label."""
    types = dict(df.dtypes)
    numeric, cats = [], []
    for c in df.columns:
        if c in exclude:
            continue
        if types[c] == "string":
            cats.append(c)
        elif types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint"):
            numeric.append(c)
        else:
            raise ValueError(f"predictor {c} has type {types[c]}: cast it or exclude it")
    return numeric, cats


def build_pipeline(numeric: Sequence[str], categorical: Sequence[str], label_col: str,
                   params: dict | None = None) -> Pipeline:
    idx = [f"{c}__idx" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx,
                                    handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(numeric) + idx, outputCol="features",
                                  handleInvalid="keep"))
    p = dict(GBT_PARAMS)
    p.update(params or {})
    stages.append(GBTClassifier(featuresCol="features", labelCol=label_col, **p))
    return Pipeline(stages=stages)


def bins_for(encoder: PipelineModel) -> int:
    """Tree bins that hold every category of the fitted encoder and its bucket
    for unseen values."""
    sizes = [len(x) + 1 for s in encoder.stages if hasattr(s, "labelsArray") for x in s.labelsArray]
    return max([32, *sizes])


def fit(train: DataFrame, label_col: str, numeric: Sequence[str], categorical: Sequence[str],
        params: dict | None = None) -> PipelineModel:
    """Fit the encoder, then the trees with as many bins as the widest
    category needs; returns both as one pipeline model."""
    data = train.withColumn(label_col, F.col(label_col).cast("double"))
    *encode, trees = build_pipeline(numeric, categorical, label_col, params).getStages()
    encoder = Pipeline(stages=encode).fit(data)
    trees.setMaxBins(max(trees.getMaxBins(), bins_for(encoder)))
    return PipelineModel(stages=[*encoder.stages, trees.fit(encoder.transform(data))])


def fit_encoded(train: DataFrame, label_col: str, numeric: Sequence[str], categorical: Sequence[str],
                keys: Sequence[str], most: int = 31, params: dict | None = None):
    """``fit`` where no predictor needs more than the default bins: categorical
    predictors of more than ``most`` categories are target-encoded across folds.

    Returns (model, encoding table or None, encoded columns); rows to score
    go through ``encode.transform`` with ``training`` false."""
    from lodestar.operators import encode
    sizes = train.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in categorical]).first() if categorical else {}
    wide = [c for c in categorical if sizes[c] > most]
    if not wide:
        return fit(train, label_col, numeric, categorical, params), None, []
    table = encode.fit(train, label_col, wide, keys)
    data = encode.transform(table, train, wide, keys, F.lit(True))
    narrow = [c for c in categorical if c not in wide]
    return fit(data, label_col, [*numeric, *[f"{c}_te" for c in wide]], narrow, params), table, wide


def validation_loss(model: PipelineModel, test: DataFrame, label_col: str) -> list[float]:
    """Log loss on ``test`` after each tree (no early stopping)."""
    data = test.withColumn(label_col, F.col(label_col).cast("double"))
    for stage in model.stages[:-1]:
        data = stage.transform(data)
    return model.stages[-1].evaluateEachIteration(data)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], digits: int | None = 4,
          out_col: str = "p1") -> DataFrame:
    """Probability of class 1, rounded, next to the ``keep`` columns."""
    pred = model.transform(df)
    p1 = vector_to_array(F.col("probability"))[1]
    return pred.select(*keep, (p1 if digits is None else F.round(p1, digits)).alias(out_col))


def auc(model: PipelineModel, test: DataFrame, label_col: str) -> float:
    pred = model.transform(test.withColumn(label_col, F.col(label_col).cast("double")))
    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(pred))


def importance(spark: SparkSession, model: PipelineModel, numeric: Sequence[str],
               categorical: Sequence[str]) -> DataFrame:
    """(feature, importance) from the fitted trees, most important first."""
    names = list(numeric) + list(categorical)
    vec = model.stages[-1].featureImportances.toArray().tolist()
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    rows = list(zip(names, [float(v) for v in vec]))
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
