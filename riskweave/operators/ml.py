"""Spark ML on the feature table (ML1, ML4-13, JN13).

Training rows are point-in-time weekly feature snapshots, labelled by an observed cancellation
within 90 days of the snapshot (JN13). Folds hold whole accounts, stratified by label. All fitting is Spark ML (treeAggregate
/ distributed trees); nothing is collected except the fitted coefficients and metrics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.config import Settings
from riskweave.operators.compare import FEATURE_COLS, prediction_frame, prepare_features
from riskweave.session import ensure_checkpoint_dir, stored

LABEL = "label"
WEIGHT = "class_weight"
FOLD = "fold"
# FIXED VALUES: estimator settings (the inverse L2 strength of the logistic model, folds, seed; the
# trees' are in pipelines())
LR_C = 0.5
N_FOLDS = 5
SEED = 42


# --- labels ---------------------------------------------------------------------------


def cancel_labels(snapshots: DataFrame, billing: DataFrame, horizon_days: int = 90) -> DataFrame:
    """JN13: label a (account, feature_week) snapshot 1 if the account cancels within
    `horizon_days` of the snapshot date (date(cancel) in [week, week + horizon]).

    Range join without a per-key nested loop: each cancellation is expanded to the
    (at most ceil(horizon/7)+1) snapshot Mondays that can see it, then an equi-join on
    (account_id, week) marks the snapshots. The fan-out is fixed by the horizon.
    """
    c = billing.where(F.col("event_type") == "cancellation").select(
        "account_id", F.col("event_ts").cast("date").alias("d")
    )
    lo = F.date_sub("d", horizon_days)
    first_monday = F.when(
        F.trunc(lo, "week") < lo, F.date_add(F.trunc(lo, "week"), 7)
    ).otherwise(F.trunc(lo, "week"))
    weeks = c.select(
        "account_id",
        F.explode(
            F.sequence(first_monday, F.trunc("d", "week"), F.expr("INTERVAL 7 DAYS"))
        ).alias("feature_week"),
    ).distinct()
    hit = weeks.withColumn("__hit", F.lit(1))
    return snapshots.join(hit, ["account_id", "feature_week"], "left").withColumn(
        LABEL, F.coalesce(F.col("__hit"), F.lit(0)).cast("int")
    ).drop("__hit")


def with_class_weights(df: DataFrame) -> DataFrame:
    """ML7: balanced weights n / (2 * n_class). The per-label counts are a two-row
    aggregate, so the broadcast is bounded by the number of classes."""
    return df.join(F.broadcast(class_weights(df).select(LABEL, WEIGHT)), LABEL)


FOLD_BUCKETS = 1024


def _hash(*cols) -> F.Column:
    """A 32-bit hash of the columns' text that any SQL engine can restate."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols, F.lit(str(SEED)))), 1, 8), 16, 10).cast("long")


def with_folds(df: DataFrame, key: str = "account_id", k: int = N_FOLDS) -> DataFrame:
    """ML8: stratified folds of whole accounts. Accounts with and without a positive row are
    dealt out in turn, in hash order, so every fold gets its share of both and all weeks of an
    account are in one fold. The order is by bucket of the hash: ranks inside a bucket come from
    a window per bucket, and the buckets' offsets from a table of 2 x FOLD_BUCKETS counts."""
    h = _hash(key)
    acc = (
        df.groupBy(key).agg(F.max(LABEL).alias("__s")).withColumn("__h", h)
        .withColumn("__b", F.floor(F.col("__h") * FOLD_BUCKETS / 2**32).cast("int"))
    )
    rank = F.row_number().over(Window.partitionBy("__s", "__b").orderBy("__h", key))
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = acc.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__s", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    folds = acc.withColumn("__r", rank).join(F.broadcast(offsets), ["__s", "__b"]).select(
        key, ((F.col("__o") + F.col("__r") - 1) % k).cast("int").alias(FOLD)
    )
    return df.join(folds, key)


def class_weights(df: DataFrame) -> DataFrame:
    """ML7: rows and balanced weight of each class."""
    n = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        WEIGHT, n.cast("double") / (F.lit(2.0) * F.col("n_rows"))
    )


def fold_sizes(df: DataFrame) -> DataFrame:
    """Rows, positives and accounts of every fold."""
    return with_folds(df).groupBy(FOLD).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).alias("n_positive"), F.count_distinct("account_id").alias("n_accounts")
    )


def label_balance(df: DataFrame) -> DataFrame:
    """AGG12: positives, negatives, rate."""
    return df.agg(
        F.sum(LABEL).alias("n_positive"),
        F.count_if(F.col(LABEL) == 0).alias("n_negative"),
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(LABEL).cast("double")).alias("positive_rate"),
    )


# --- estimators ---------------------------------------------------------------------------


def pipelines(n_rows: int) -> dict[str, Pipeline]:
    """ML5 / ML6. The logistic L2 strength is restated for Spark's mean-loss objective:
    regParam = 1 / (C * sum(weights)) with balanced weights summing to n."""
    asm = VectorAssembler(inputCols=FEATURE_COLS, outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    lr = LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=1000,
        regParam=1.0 / (LR_C * max(n_rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-10,
    )
    gbt = GBTClassifier(
        featuresCol="raw_features",
        labelCol=LABEL,
        maxIter=150,
        maxDepth=3,
        stepSize=0.08,
        subsamplingRate=0.8,
        minInstancesPerNode=8,
        seed=SEED,
    )
    return {
        "Logistic Regression": Pipeline(stages=[asm, scaler, lr]),
        "Gradient Boosting": Pipeline(stages=[asm, gbt]),
    }


@dataclass
class TrainResult:
    model: PipelineModel
    model_name: str
    cv_auc: float
    cv_std: float
    cv: dict[str, tuple[float, float]]
    n_training: int
    churn_rate: float


def _evaluator() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC")


def train(training: DataFrame, models: tuple[str, ...] | None = None) -> TrainResult:
    """ML8 + ML9: k-fold CV per pipeline on stratified account folds, best mean AUC refit on all
    rows. The labelled rows are stored once (reliable checkpoint), in the partitions that the
    session's settings give; every optimizer iteration then reads them."""
    ensure_checkpoint_dir(training.sparkSession)
    data = with_folds(with_class_weights(training)).checkpoint()
    stats = data.agg(F.count(F.lit(1)).alias("n"), F.avg(LABEL).alias("rate")).first()
    n, rate = int(stats["n"]), float(stats["rate"] or 0.0)
    data = data.cache()
    cands = pipelines(n)
    if models:
        cands = {k: v for k, v in cands.items() if k in models}
    cv_scores = cross_validate(cands, data)
    best = max(cands, key=lambda k: cv_scores[k][0])
    model = cands[best].fit(data)
    data.unpersist()
    return TrainResult(model, best, round(cv_scores[best][0], 4), cv_scores[best][1], cv_scores, n, rate)


def cross_validate(cands: dict[str, Pipeline], data: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population std of the held-out AUC per pipeline. Every (pipeline, fold)
    fit is an independent set of Spark jobs, so all of them are submitted concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    def fit_fold(name: str, k: int) -> tuple[str, float]:
        train_k = data.where(F.col(FOLD) != k)
        test_k = data.where(F.col(FOLD) == k)
        m = cands[name].fit(train_k)
        return name, float(_evaluator().evaluate(m.transform(test_k)))

    jobs = [(name, k) for name in cands for k in range(N_FOLDS)]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        results = list(pool.map(lambda a: fit_fold(*a), jobs))
    out = {}
    for name in cands:
        aucs = [a for n_, a in results if n_ == name]
        mu = sum(aucs) / len(aucs)
        sd = (sum((a - mu) ** 2 for a in aucs) / len(aucs)) ** 0.5
        out[name] = (mu, sd)
    return out


def probability(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    return model.transform(prepared).withColumn(
        "__prob", vector_to_array("probability").getItem(1)
    )


def score(
    result: TrainResult, features: DataFrame, s: Settings, stamp: bool = True
) -> DataFrame:
    """ML12: prediction table for the current features."""
    scored = probability(result.model, prepare_features(features))
    return prediction_frame(scored, F.col("__prob"), result.model_name, result.cv_auc, s, stamp)


def importance(result: TrainResult, spark: SparkSession, top: int = 10) -> DataFrame:
    """ML10: signed coefficients (logistic) or impurity importances (trees), top by |value|."""
    last = result.model.stages[-1]
    values = (
        last.coefficients.toArray().tolist()
        if hasattr(last, "coefficients")
        else last.featureImportances.toArray().tolist()
    )
    df = spark.createDataFrame(
        [(f, float(v)) for f, v in zip(FEATURE_COLS, values)], "feature string, value double"
    )
    return df.orderBy(F.abs("value").desc(), "feature").limit(top)


def classification_report(scored: DataFrame) -> DataFrame:
    """AGG13 from the confusion counts (a 2x2 aggregate): per-class precision, recall,
    f1, support, plus accuracy and macro / weighted means."""
    conf = scored.groupBy(F.col(LABEL).cast("int").alias("y"), F.col("prediction").cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    tot = conf.agg(
        *[F.sum(F.when((F.col("y") == y) & (F.col("p") == p), F.col("n")).otherwise(0)).alias(f"c{y}{p}")
          for y in (0, 1) for p in (0, 1)]
    )
    rows = []
    for cls, name in ((0, "Retained"), (1, "Churned")):
        other = 1 - cls
        tp, fp, fn = F.col(f"c{cls}{cls}"), F.col(f"c{other}{cls}"), F.col(f"c{cls}{other}")
        prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
        rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
        rows.append(
            F.struct(F.lit(name).alias("label"), prec.alias("precision"), rec.alias("recall"),
                     f1.alias("f1"), (tp + fn).cast("double").alias("support"))
        )
    per = tot.select(F.inline(F.array(*rows)))
    n = F.sum("support")
    summary = per.agg(
        F.struct(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), n.alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("label"),
                 (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                 (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                 (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"), n.alias("support")).alias("w"),
    ).select(F.inline(F.array("m", "w")))
    acc = tot.select(
        F.lit("accuracy").alias("label"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        ((F.col("c00") + F.col("c11")) / (F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11"))).alias("f1"),
        (F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")).cast("double").alias("support"),
    )
    return per.unionByName(acc).unionByName(summary)


def area_under_roc(scored: DataFrame, score: str) -> float:
    """The area by Spark's curve over all distinct scores (no bins)."""
    return BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=score, numBins=0).evaluate(scored)


def lr_gradient(model: PipelineModel, weighted: DataFrame) -> DataFrame:
    """ML5: the gradient of the weighted, regularised mean loss at the fitted coefficients, one row
    per coefficient and the intercept. It is zero where the fit is optimal. One aggregate over the
    rows, computed here from probabilities and scaled features, not taken from the optimizer."""
    last = model.stages[-1]
    names = [*FEATURE_COLS, "intercept"]
    scored = model.transform(weighted).select(
        F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"),
        (vector_to_array("probability")[1] - F.col(LABEL)).alias("miss"), F.col(WEIGHT).alias("w"),
    )
    sums = scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("w").alias("total"),
        *(F.sum(F.col("w") * F.col("miss") * F.col("x")[i]).alias(f"g{i}") for i in range(len(names))),
    )
    strength = last.getRegParam()
    coefficients = [*last.coefficients.toArray().tolist(), 0.0]
    rows = [
        F.struct(F.lit(n).alias("term"), (F.col(f"g{i}") / F.col("total") + F.lit(strength * float(b))).alias("gradient"))
        for i, (n, b) in enumerate(zip(names, coefficients, strict=True))
    ]
    return sums.select("n_rows", F.inline(F.array(*rows)))


def fit_logistic(training: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """The logistic pipeline on all rows, and the weighted rows it was fitted on (stored once)."""
    weighted = stored(with_class_weights(training), "weighted-training")
    return pipelines(weighted.count())["Logistic Regression"].fit(weighted), weighted


def training_auc(result: TrainResult, training: DataFrame) -> float:
    """ML11: in-sample AUC of the refit model."""
    return float(_evaluator().evaluate(result.model.transform(training)))
