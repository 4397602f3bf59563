"""Feature transformers, regression models and metrics on Spark ML.

The reference trained a torch layer and fitted scikit-learn scalers on a
3,000-row sample pulled to the driver; here every fit is a Spark ML estimator
over the full distributed data, and every metric is one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.functions.expressions import delayed_flag, hhmm_hour, is_valid_number
from ontime.operators.cleaning import canonical_names, cast_columns, not_cancelled
from ontime.operators.forest import BinnedForestRegressor
from ontime.schema import LABEL, MODEL_FEATURES, transformed_types


@dataclass
class Imputed:
    df: DataFrame
    imputed: list[str]
    dropped_all_null: list[str] = field(default_factory=list)
    means: dict[str, float] = field(default_factory=dict)


def column_means(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Mean of each column's real values (null and NaN left out), None without any; one aggregate."""
    if not columns:
        return {}
    x = [F.col(c).cast("double") for c in columns]
    row = df.agg(*[F.avg(F.when(~F.isnan(v), v)).alias(c) for c, v in zip(columns, x, strict=True)]).first()
    return {c: row[c] for c in columns}


def all_null_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with no real value, found in one aggregate."""
    return [c for c, mean in column_means(df, columns).items() if mean is None]


def impute_mean(df: DataFrame, columns: list[str], label: str | None = LABEL,
                reference_compat: bool = False) -> Imputed:
    """Mean imputation under the original column names.

    One aggregate gives the means and finds the columns that are entirely
    null, which are reported; the fill is a projection.  The label is left
    alone unless ``reference_compat`` (imputing the target leaks it into the
    features).
    """
    cols = [c for c in columns if c in df.columns and (reference_compat or c != label)]
    df = cast_columns(df, {c: "double" for c in cols})
    means = column_means(df, cols)
    known = {c: m for c, m in means.items() if m is not None}
    filled = {c: F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(m)) for c, m in known.items()}
    return Imputed(df.withColumns(filled) if filled else df, list(known), [c for c in cols if c not in known], known)


def add_hours(df: DataFrame, wrap24: bool = False) -> DataFrame:
    """DepHour and ArrHour from the hhmm times when present (P10)."""
    add = {}
    if "DepTime" in df.columns:
        add["DepHour"] = hhmm_hour("DepTime", wrap24)
    if "ArrTime" in df.columns:
        add["ArrHour"] = hhmm_hour("ArrTime", wrap24)
    return df.withColumns(add) if add else df


def scaler_pipeline(columns: list[str], handle_invalid: str = "skip",
                    vector_col: str = "features_vec", scaled_col: str = "scaled_features") -> Pipeline:
    """Assemble + standardise (mean 0, sample std 1)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol=vector_col, handleInvalid=handle_invalid),
        StandardScaler(inputCol=vector_col, outputCol=scaled_col, withMean=True, withStd=True),
    ])


def unpack_vector(df: DataFrame, vector_col: str, names: list[str], prefix: str = "") -> DataFrame:
    """Vector column to one double column per element."""
    arr = vector_to_array(F.col(vector_col))
    return df.withColumns({f"{prefix}{n}": arr[i] for i, n in enumerate(names)})


def standard_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None,
                   handle_invalid: str = "skip") -> tuple[DataFrame, PipelineModel]:
    """Scale ``columns``; the scaler is fitted on ``fit_on`` (train) when given (M3, M4)."""
    model = scaler_pipeline(columns, handle_invalid).fit(fit_on if fit_on is not None else df)
    return model.transform(df), model


def model_input(df: DataFrame, features: list[str] | None = None, label: str = LABEL,
                assemble: bool = True, handle_invalid: str = "skip") -> DataFrame:
    """Rows ready for a regressor (M11): not cancelled, typed, complete, assembled.

    Types are those of the transformed layer (``schema.transformed_types``).
    Raises ``ValueError`` when the label column is absent.
    """
    df = not_cancelled(canonical_names(df))
    if label not in df.columns:
        raise ValueError(f"label {label} not found")
    types = transformed_types()
    df = add_hours(cast_columns(df, {c: types[c] for c in ("DepTime", "ArrTime")}))
    wanted = [c for c in features or MODEL_FEATURES if c in df.columns]
    out = cast_columns(df, {c: types.get(c, "double") for c in [*wanted, label]}).select(*wanted, label)
    out = out.na.drop(how="any")
    if assemble:
        out = VectorAssembler(inputCols=wanted, outputCol="features_vec", handleInvalid=handle_invalid).transform(out)
    return out


def linear_regression(features: list[str], label: str = LABEL, max_iter: int = 50, reg_param: float = 0.1,
                      solver: str = "auto", scale: bool = False) -> Pipeline:
    """Assembler (+ optional scaler) + ``LinearRegression`` (M5, M9)."""
    stages = [VectorAssembler(inputCols=features, outputCol="features_vec", handleInvalid="skip")]
    feat_col = "features_vec"
    if scale:
        stages.append(StandardScaler(inputCol="features_vec", outputCol="scaled_features",
                                     withMean=True, withStd=True))
        feat_col = "scaled_features"
    stages.append(LinearRegression(featuresCol=feat_col, labelCol=label, maxIter=max_iter,
                                   regParam=reg_param, solver=solver))
    return Pipeline(stages=stages)


def random_forest(features: list[str], label: str = LABEL, num_trees: int = 50, max_depth: int = 8,
                  seed: int = 42, max_bins: int = 32, subset: str = "auto", bagging: bool = True) -> Pipeline:
    """Assembler + ``BinnedForestRegressor`` (M6); ``max_bins`` thresholds a feature, ``subset`` of features a split."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="features_vec", handleInvalid="skip"),
        BinnedForestRegressor(featuresCol="features_vec", labelCol=label, numTrees=num_trees,
                              maxDepth=max_depth, seed=seed, maxBins=max_bins, featureSubsetStrategy=subset,
                              bootstrap=bagging),
    ])


def iterative_linear(features: list[str], label: str = LABEL, max_iter: int = 100) -> Pipeline:
    """Plain least squares fitted iteratively with L-BFGS on scaled inputs (M9).

    Stands in for the reference's one-layer network trained with Adam: the
    same model class (one linear layer, squared loss); ``objectiveHistory`` of
    the fitted model is the loss trace.
    """
    return linear_regression(features, label, max_iter=max_iter, reg_param=0.0, solver="l-bfgs", scale=True)


def delay_classifier(features: list[str], label: str = "is_delayed", weight_col: str | None = "class_weight",
                     max_iter: int = 50, tol: float = 1e-6) -> Pipeline:
    """Logistic model of the flag that ``with_class_weight`` adds, with its class weights."""
    stages = [VectorAssembler(inputCols=features, outputCol="features_vec", handleInvalid="skip"),
              LogisticRegression(featuresCol="features_vec", labelCol=label, weightCol=weight_col or None,
                                 maxIter=max_iter, tol=tol)]
    return Pipeline(stages=stages)


def class_weights(df: DataFrame, target: str = LABEL, threshold: float = 15.0) -> DataFrame:
    """(is_delayed, n, class_weight) of the two classes (X4); rows without a target are left out.

    A class's weight is ``0.5 / share(class)``, so both weigh the same in
    total; 1 where only one class is there.
    """
    known = df.filter(is_valid_number(F.col(target).cast("double")))
    counts = (known.groupBy(delayed_flag(target, threshold).cast("double").alias("is_delayed"))
              .agg(F.count(F.lit(1)).alias("n")))
    everyone = Window.partitionBy()  # two rows
    total, classes = F.sum("n").over(everyone), F.count(F.lit(1)).over(everyone)
    weight = F.when(classes > 1, F.lit(0.5) * total / F.col("n")).otherwise(1.0)
    return counts.select("is_delayed", "n", weight.alias("class_weight"))


def with_class_weight(df: DataFrame, target: str = LABEL, threshold: float = 15.0) -> DataFrame:
    """Rows with a target, their ``is_delayed`` label and class weight."""
    known = df.filter(is_valid_number(F.col(target).cast("double")))
    weight = F.lit(1.0)
    for r in class_weights(df, target, threshold).collect():  # two rows
        weight = F.when(F.col("is_delayed") == r["is_delayed"], F.lit(r["class_weight"])).otherwise(weight)
    return known.withColumn("is_delayed", delayed_flag(target, threshold).cast("double")) \
        .withColumn("class_weight", weight)


def regression_metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """RMSE, R2, MAE and row count in one aggregate (M7)."""
    err = F.col(prediction) - F.col(label)
    agg = pred.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(err * err).alias("sse"),
                   F.avg(F.abs(err)).alias("mae"),
                   F.var_pop(F.col(label)).alias("var_y"))
    return agg.select(
        "n",
        F.sqrt(F.try_divide(F.col("sse"), F.col("n").cast("double"))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var_y") * F.col("n"))).alias("r2"),
        "mae")


def compare_models(models: dict[str, PipelineModel], test: DataFrame, label: str = LABEL) -> DataFrame:
    """(model, n, rmse, r2, mae) per fitted model, best RMSE first.

    The models' predictions are chained over one scan of the test set and all
    metrics come from one aggregate.
    """
    out = test
    for i, m in enumerate(models.values()):
        scored = m.transform(out)
        extra = [c for c in scored.columns if c not in out.columns and c != "prediction"]
        out = scored.withColumnRenamed("prediction", f"_p{i}").drop(*extra)
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("prediction"))
                               for i, name in enumerate(models)]))
    err = F.col("prediction") - F.col(label)
    agg = (out.select(label, rows.alias("m")).select(label, "m.*").groupBy("model")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"), F.avg(F.abs(err)).alias("mae"),
                F.var_pop(F.col(label)).alias("var_y")))
    return agg.select("model", "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                      (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var_y") * F.col("n"))).alias("r2"),
                      "mae").orderBy("rmse", "model")


def score_rows(model: PipelineModel, df: DataFrame, label: str = LABEL, keep: list[str] | None = None) -> DataFrame:
    """Predictions next to the label (M8)."""
    return model.transform(df).select(*(keep or []), label, "prediction")


#: Partitions of a train set: one for so many rows, and no fewer than the least.
TRAIN_PARTITION_ROWS, LEAST_TRAIN_PARTITIONS = 1_000_000, 16


def train_partitions(rows: int) -> int:
    return max(LEAST_TRAIN_PARTITIONS, -(-rows // TRAIN_PARTITION_ROWS))


@contextmanager
def laid_out(train: DataFrame, partitions: int | None = None, label: str = LABEL) -> Iterator[DataFrame]:
    """The train set cached in one layout (memory, spilling to disk), released after; several fits may share it.

    Estimators pass over their input many times, and a forest's bagging draws
    by partition and row position.  The rows are therefore always dealt by the
    hash of all columns to ``partitions`` partitions and sorted in them: the
    fitted model depends on that number, not on files, cores or upstream
    shuffles.  They are sorted by the label first: rows of near labels mostly
    reach the same nodes of a forest, whose counts then stay in the processor's
    cache.  Unless stated it follows from the number of rows
    (``train_partitions``), which costs one count.
    """
    partitions = partitions or train_partitions(train.count())
    order = sorted(train.columns, key=lambda c: c != label)
    ordered = train.repartition(partitions, *train.columns).sortWithinPartitions(*order)
    cached = ordered.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()


def fit_persisted(pipeline: Pipeline, train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """Fit on the ``laid_out`` train set, or a linear pipeline on the rows themselves.

    A forest's draws depend on the layout.  A linear fit is made of sums over
    all rows, whose order changes their rounding alone: sorting and caching the
    rows for it would cost more than its passes.  Its iterative solvers keep
    the rows as blocks; these get no larger than ``train_partitions`` allows.
    """
    if any(isinstance(s, RandomForestRegressor) for s in pipeline.getStages()):
        with laid_out(train, partitions) as cached:
            return pipeline.fit(cached)
    if any(_iterative(s) for s in pipeline.getStages()):
        train = train.repartition(partitions or train_partitions(train.count()), *train.columns)
    return pipeline.fit(train)


def _iterative(stage) -> bool:
    """An estimator that passes over its rows until it converges, rather than once."""
    return isinstance(stage, LogisticRegression) or (isinstance(stage, LinearRegression) and stage.getSolver() == "l-bfgs")


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline to shared storage."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
