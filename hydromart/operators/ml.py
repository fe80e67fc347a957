"""Next-day exceedance model: split, fit, score, evaluate (ML-01..ML-15) with ``pyspark.ml``.

Training data stays distributed (no ``toPandas``); reports are single aggregates over
confusion counts; the daily scoring job is a filter on the latest date, a ``transform`` and
an upsert into the predictions table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydromart.functions.temporal import as_timestamp
from hydromart.operators.quality import SCORING_FEATURES
from hydromart.operators.tables import upsert

LABEL = "target_j1"
TODAY_FLAG = "depasse_p95_j"
# Fixed value: first day of the chronological test period.
SPLIT_DATE = "2023-01-01"


def chronological_split(df: DataFrame, cutoff: str = SPLIT_DATE, date: str = "date",
                        label: str = LABEL) -> dict[str, DataFrame]:
    """ML-01: labelled rows before / from ``cutoff``."""
    lab = df.where(F.col(label).isNotNull())
    c = F.lit(cutoff).cast("date")
    return {"train": lab.where(F.col(date) < c), "test": lab.where(F.col(date) >= c)}


def balanced_weights(df: DataFrame, label: str = LABEL, weight: str = "weight") -> DataFrame:
    """ML-04: ``n / (n_classes * n_class)`` per row. The per-class table has one row per class."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n, k = per.agg(F.sum("_nc")).scalar(), per.agg(F.count(F.lit(1))).scalar()
    # one row per class (two for a binary label): a broadcast with a proven size bound
    w = F.broadcast(per.select(label, (n / (k * F.col("_nc"))).alias(weight)))
    return df.join(w, label)


def logistic_pipeline(features: Sequence[str] = SCORING_FEATURES, label: str = LABEL, weight: str = "weight",
                      reg_param: float = 0.0, max_iter: int = 1000, relative_error: float = 0.0,
                      tol: float = 1e-6) -> Pipeline:
    """ML-02..04: median imputation -> standardisation -> weighted logistic regression.

    Medians are exact (``relative_error`` 0); a larger error makes them cheaper on very large tables.
    ``reg_param`` should be ``1 / sum(weights)`` to match an L2 penalty C=1 on summed losses;
    internal standardisation is off because the scaler already standardises.
    """
    imputed = [f"{c}_imp" for c in features]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(features), outputCols=imputed, relativeError=relative_error),
        VectorAssembler(inputCols=imputed, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight, maxIter=max_iter,
                           regParam=reg_param, elasticNetParam=0.0, standardization=False, tol=tol),
    ])


def forest_pipeline(features: Sequence[str] = SCORING_FEATURES, label: str = LABEL, weight: str = "weight",
                    num_trees: int = 100, max_depth: int = 5, seed: int = 42, relative_error: float = 0.0) -> Pipeline:
    """ML-05: median imputation -> random forest with balanced class weights.

    ``max_depth`` is Spark's default; up to 30 is allowed, and memory doubles with every level.
    """
    imputed = [f"{c}_imp" for c in features]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(features), outputCols=imputed, relativeError=relative_error),
        VectorAssembler(inputCols=imputed, outputCol="features"),
        RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=weight,
                               numTrees=num_trees, maxDepth=max_depth, seed=seed),
    ])


def fit(train: DataFrame, kind: str = "logistic", label: str = LABEL, **kw) -> PipelineModel:
    """Fit a pipeline on balanced weights; the logistic penalty is scaled by the weight total.

    The scaler divides by the sample deviation. Dividing by the population deviation instead scales
    every feature by sqrt(n / (n - 1)), which a penalty (n - 1) / n times as large makes up for: the
    fitted scores are those of a fit on population deviations (``certificate`` checks it).

    The weighted training set is checkpointed once (reliable, in ``spark.checkpoint.dir``):
    the imputer, the scaler and every optimiser iteration then read it instead of
    re-evaluating the feature plan, and a lost executor does not replay the whole lineage.
    """
    from hydromart.session import checkpoint_dir
    weighted = balanced_weights(train.withColumn(label, F.col(label).cast("double")), label)
    checkpoint_dir(train.sparkSession)
    weighted = weighted.checkpoint(eager=True)
    if kind == "logistic":
        if "reg_param" not in kw:
            total, n = weighted.agg(F.sum("weight"), F.count(F.lit(1))).first()
            kw["reg_param"] = (n - 1) / n / total if n > 1 else 1.0 / (total or 1.0)
        return logistic_pipeline(label=label, **kw).fit(weighted)
    return forest_pipeline(label=label, **kw).fit(weighted)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML-06: class and probability of the positive class."""
    out = model.transform(df)
    return out.withColumn("prediction_j1", F.col("prediction").cast("long")).withColumn(
        "probabilite_depassement_j1", vector_to_array("probability")[1])


def coefficients(model: PipelineModel, features: Sequence[str] = SCORING_FEATURES) -> DataFrame:
    """ML-12: logistic coefficients ranked by absolute value (a 5-row frame from model metadata)."""
    from pyspark.sql import SparkSession
    lr = model.stages[-1]
    spark = SparkSession.getActiveSession()
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())]
    return (spark.createDataFrame(rows, "feature string, coefficient double")
            .orderBy(F.abs("coefficient").desc()))


def certificate(model: PipelineModel, train: DataFrame, features: Sequence[str] = SCORING_FEATURES,
                label: str = LABEL, penalty: float = 1.0) -> DataFrame:
    """ML-03/04/06/12: proof that a logistic model is the minimum of the penalised weighted loss.

    The loss ``sum(weight * log loss) + penalty / 2 * |b|^2`` over features imputed with their medians
    and divided by their population deviation is strictly convex, so coefficients at which its gradient
    vanishes are the only ones that minimise it, however they were found. One aggregate over ``train``
    recomputes, from the coefficients alone and without the model's own transformers, per feature:
    ``median``, ``mean``, ``deviation`` (of the population), ``coefficient`` (for one population
    deviation) and ``gradient`` (per unit of weight); and the same for ``(intercept)``.
    """
    from hydromart.session import checkpoint_dir
    spark = train.sparkSession
    lr = model.stages[-1]
    rows = train.where(F.col(label).isNotNull())
    medians = rows.agg(*[F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}`)").alias(c) for c in features]).first()
    checkpoint_dir(spark)
    filled = balanced_weights(rows.select(F.col(label).cast("double").alias(label),
                                          *[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) for c in features]), label)
    filled = filled.checkpoint(eager=True)
    told = filled.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"),
                      *[F.avg(c).alias(f"mean_{c}") for c in features],
                      *[F.stddev_pop(c).alias(f"deviation_{c}") for c in features]).first()
    per_sample = ((told.n - 1) / told.n) ** 0.5 if told.n > 1 else 1.0  # population over sample deviation
    fitted = [float(x) * per_sample for x in lr.coefficients.toArray()]
    scaled = {c: ((F.col(c) - told[f"mean_{c}"]) / told[f"deviation_{c}"] if told[f"deviation_{c}"] else F.lit(0.0)) for c in features}
    margin = F.lit(float(lr.intercept))
    for c, b in zip(features, fitted):
        margin = margin + scaled[c] * b
    slope = F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col(label))
    pulls = filled.agg(F.sum(slope).alias("intercept"), *[F.sum(slope * scaled[c]).alias(c) for c in features]).first()
    out = [(c, float(medians[c]), told[f"mean_{c}"], told[f"deviation_{c}"], b, (pulls[c] + penalty * b) / told.total)
           for c, b in zip(features, fitted)]
    out.append(("(intercept)", None, None, None, float(lr.intercept), pulls["intercept"] / told.total))
    return spark.createDataFrame(out, "feature string, median double, mean double, deviation double, "
                                      "coefficient double, gradient double")


# ----------------------------------------------------------------------------- evaluation
def classification_report(df: DataFrame, label: str = LABEL, prediction: str = "prediction",
                          by: Sequence[str] = ()) -> DataFrame:
    """ML-07: per-class precision / recall / F1 / support, accuracy, macro and weighted averages.

    One aggregate of the four confusion counts (per ``by`` group); zero division gives 0.
    Rows: class '0', '1', 'accuracy', 'macro avg', 'weighted avg'.
    """
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = df.where(F.col(label).isNotNull()).groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    def f1(pr, rc):
        return F.coalesce(F.try_divide(2 * pr * rc, pr + rc), F.lit(0.0))

    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    p0, r0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    s1, s0 = (tp + fn), (tn + fp)
    n = s0 + s1
    f11, f10 = f1(p1, r1), f1(p0, r0)
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f10.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f11.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), ratio(tp + tn, n).alias("precision"), ratio(tp + tn, n).alias("recall"),
                 ratio(tp + tn, n).alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f10 + f11) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), ratio(p0 * s0 + p1 * s1, n).alias("precision"),
                 ratio(r0 * s0 + r1 * s1, n).alias("recall"), ratio(f10 * s0 + f11 * s1, n).alias("f1"),
                 n.alias("support")))
    return c.select(*by, F.inline(rows))


def confusion(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """ML-08."""
    return (df.where(F.col(label).isNotNull())
            .groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def persistence(df: DataFrame, today: str = TODAY_FLAG) -> DataFrame:
    """ML-09: the baseline "tomorrow = today"."""
    return df.withColumn("prediction", F.col(today).cast("int"))


def new_crossings(df: DataFrame, label: str = LABEL, prediction: str = "prediction",
                  today: str = TODAY_FLAG) -> DataFrame:
    """ML-10: report restricted to rows below the threshold today (a crossing must be new),
    plus the number of new crossings found out of all."""
    sub = df.where(F.col(today) == 0)
    return classification_report(sub, label, prediction)


def found_crossings(df: DataFrame, label: str = LABEL, prediction: str = "prediction",
                    today: str = TODAY_FLAG) -> DataFrame:
    """ML-10: how many new crossings (label 1, today 0) the predictions found."""
    sub = df.where((F.col(today) == 0) & (F.col(label) == 1))
    return sub.agg(F.count_if(F.col(prediction) == 1).alias("found"), F.count(F.lit(1)).alias("total"))


def train_test_report(train: DataFrame, test: DataFrame, label: str = LABEL,
                      prediction: str = "prediction") -> DataFrame:
    """ML-11: the report for both periods, tagged by ``split``."""
    both = (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))
    return classification_report(both, label, prediction, by=["split"])


def split_report(df: DataFrame, cutoff: str = SPLIT_DATE, date: str = "date", label: str = LABEL,
                 prediction: str = "prediction") -> DataFrame:
    """ML-11 in one pass over one frame: the split is a column, not two filtered copies."""
    split = F.when(F.col(date) < F.lit(cutoff).cast("date"), F.lit("train")).otherwise(F.lit("test"))
    return classification_report(df.withColumn("split", split), label, prediction, by=["split"])


def reliability_bins(df: DataFrame, proba: str = "probabilite_depassement_j1", label: str = LABEL,
                     bins: int = 10) -> DataFrame:
    """ML-15: calibration table: mean predicted probability vs observed rate per probability bin."""
    b = F.least(F.floor(F.col(proba) * bins).cast("int"), F.lit(bins - 1))
    return (df.where(F.col(label).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(proba).alias("mean_proba"),
                 F.avg(F.col(label).cast("double")).alias("observed_rate")))


# ----------------------------------------------------------------------------- scoring job
PREDICTION_KEYS = ["date", "code_station"]
PREDICTION_COLUMNS = ["date", "code_station", "code_insee", "code_departement", *SCORING_FEATURES,
                      "prediction_j1", "probabilite_depassement_j1", "date_prediction"]


def latest_rows(features: DataFrame, date: str = "date") -> DataFrame:
    """JN-12: rows of the latest date, ``date = (select max(date))`` as a scalar subquery; its
    value is pushed into the Parquet scan as a runtime filter (row groups of other dates skipped)."""
    return features.where(F.col(date) == features.agg(F.max(date)).scalar())


def score_latest(model: PipelineModel, features: DataFrame, predicted_at=None) -> DataFrame:
    """ML-13: predictions for the latest feature date, stamped; ``date`` is the data date (target = date + 1)."""
    rows = latest_rows(features).select("date", "code_station", "code_insee", "code_departement",
                                        *SCORING_FEATURES)
    scored = predict(model, rows)
    return scored.select(*PREDICTION_COLUMNS[:-1], as_timestamp(predicted_at).alias("date_prediction"))


def upsert_predictions(history: DataFrame, scored: DataFrame) -> DataFrame:
    """ML-13: idempotent MERGE on (date, code_station); earlier dates are untouched."""
    return upsert(history.select(*PREDICTION_COLUMNS), scored.select(*PREDICTION_COLUMNS), PREDICTION_KEYS)


def model_fingerprint(spark, path: str) -> str:
    """ML-14: SHA-256 over every file of a saved pipeline, metadata and fitted data, with its place.

    Spark hashes the files; the driver sees one digest per file.
    """
    root = path.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .where(~F.col("path").rlike(r"/[._][^/]*$"))
             .select(F.regexp_extract("path", r"((?:metadata|stages)/.*)$", 1).alias("file"), F.sha2("content", 256).alias("digest")))
    h = hashlib.sha256()
    for r in files.orderBy("file").collect():
        h.update(f"{r.file} {r.digest}\n".encode())
    return h.hexdigest()


def load_checked(path: str, expected_sha256: str | None = None) -> PipelineModel:
    """ML-14: load a saved pipeline, refusing it when its fingerprint differs from the recorded one."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if expected_sha256 is not None:
        got = model_fingerprint(spark, path)
        if got != expected_sha256:
            raise ValueError(f"model at {path} has fingerprint {got}, expected {expected_sha256}")
    return PipelineModel.load(path)
