"""Churn label, forest, scores and how good they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.functions.exact import plain_ratio
from basketry.operators import forest
from basketry.operators.distribution import value_counts
from basketry.operators.forest import Forest
from basketry.operators.ranking import lowest_share, totalled

FEATURES = ("recency_days", "frequency", "monetary", "r_score", "f_score", "m_score")


def churn_features(
    metrics: DataFrame, columns: Sequence[str] = FEATURES, churn_days: int = rules.CHURN_AFTER_DAYS
) -> DataFrame:
    """Scored customers with their features, NULL as 0, and the label.

    The label is a threshold on recency_days, itself a feature, so a model on the default columns separates
    the classes almost perfectly; pass columns without it for a real forecast.
    """
    label = rules.churned(F.col("recency_days"), churn_days).alias("churned")
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in columns]
    return metrics.where("rfm_segment IS NOT NULL").select("customer_id", "rfm_segment", *filled, label)


def stratified_split(
    features: DataFrame, test_share: tuple[int, int] = (1, 5), seed: int = 42, method: str = "selected"
) -> DataFrame:
    """Flag the test rows: the same share of both classes, chosen by a hash of the customer."""
    draw = F.md5(F.concat(F.col("customer_id").cast("string"), F.lit(f":{seed}")))
    marked = lowest_share(features.withColumn("_draw", draw), "churned", ["_draw"], test_share, "is_test", method)
    return marked.drop("_draw")


def fit_forest(
    train: DataFrame,
    columns: Sequence[str] = FEATURES,
    trees: int = 200,
    depth: int = 6,
    min_leaf: int = 5,
    seed: int = 42,
) -> Forest:
    """The forest; it follows from the customers and the seed, not from how they are partitioned."""
    return forest.fit(train, columns, F.col("churned"), F.col("customer_id"), trees, depth, min_leaf, seed)


def churn_scores(model: Forest, features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Predicted class, churn probability and risk band of every customer; the model knows its columns."""
    scored = model.score(features, "churn_probability")
    return scored.withColumns(
        {
            "prediction": (F.col("churn_probability") > 0.5).cast("int"),
            "churn_risk": rules.churn_risk(F.col("churn_probability")),
        }
    )


def feature_importance(model: Forest, like: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """One row per feature, most important first."""
    rows = [(c, float(v)) for c, v in zip(model.columns, model.importances(), strict=True)]
    table = like.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def confusion_matrix(scored: DataFrame, label: str = "churned", prediction: str = "prediction") -> DataFrame:
    """Rows per actual and predicted class."""
    pairs = scored.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted"))
    return pairs.agg(F.count(F.lit(1)).alias("rows"))


def classification_report(
    scored: DataFrame,
    label: str = "churned",
    prediction: str = "prediction",
    names: Sequence[str] = ("Active", "Churned"),
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy (in the f1 column), macro and weighted means.

    A measure without cases is 0.
    """
    matrix = confusion_matrix(scored, label, prediction)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)
    actual = matrix.groupBy(F.col("actual").alias("_actual")).agg(F.sum("rows").alias("_support"))
    predicted = matrix.groupBy(F.col("predicted").alias("_class")).agg(
        F.sum("rows").alias("_predicted"), F.sum(hit).alias("_hits")
    )
    joined = actual.join(predicted, F.col("_actual") == F.col("_class"), "full")

    def of(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(plain_ratio(part, whole), F.lit(0.0))

    classes = joined.select(
        F.coalesce("_actual", "_class").alias("_class"),
        ratio(of("_hits"), of("_predicted")).alias("precision"),
        ratio(of("_hits"), of("_support")).alias("recall"),
        ratio(2 * of("_hits"), of("_predicted") + of("_support")).alias("f1"),
        of("_support").alias("support"),
        of("_hits").alias("_hits"),
    )
    measures = ["precision", "recall", "f1"]
    support = F.col("support")
    overall = classes.agg(
        F.sum("support").alias("_n"),
        plain_ratio(F.sum("_hits"), F.sum("support")).alias("_accuracy"),
        *(F.avg(m).alias(f"_macro_{m}") for m in measures),
        *(plain_ratio(F.sum(F.col(m) * support), F.sum("support")).alias(f"_weighted_{m}") for m in measures),
    )

    def line(name: str, *values: Column) -> Column:
        fields = zip(("class", *measures), (F.lit(name), *values))
        return F.struct(*(v.alias(n) for n, v in fields), F.col("_n").alias("support"))

    blank = F.lit(None).cast("double")
    summary = overall.select(
        F.inline(
            F.array(
                line("accuracy", blank, blank, F.col("_accuracy")),
                line("macro avg", *(F.col(f"_macro_{m}") for m in measures)),
                line("weighted avg", *(F.col(f"_weighted_{m}") for m in measures)),
            )
        )
    )
    named = rules.label_of(F.col("_class").cast("int"), names).alias("class")
    return classes.select(named, *measures, "support").unionByName(summary)


def _by_score(scored: DataFrame, score: str, label: str) -> DataFrame:
    return scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("_pos"), F.sum((F.lit(1) - F.col(label)).cast("bigint")).alias("_neg")
    )


def _cumulated(scored: DataFrame, score: str, label: str, method: str) -> tuple[DataFrame, Column, Column]:
    """Hits and false alarms at every distinct threshold from the highest down, and the class sizes."""
    by_score = _by_score(scored, score, label)
    upto, sums = totalled(by_score, [F.desc("threshold")], {"_tp": "_pos", "_fp": "_neg"}, method)
    return upto, F.lit(sums["_tp"]).cast("bigint"), F.lit(sums["_fp"]).cast("bigint")


def roc_curve(
    scored: DataFrame, score: str = "churn_probability", label: str = "churned", method: str = "selected"
) -> DataFrame:
    """False and true positive rate at every distinct score, after a starting point at (0, 0).

    Points come from the highest threshold down, as the blocks of the running sums lie.
    """
    upto, positives, negatives = _cumulated(scored, score, label, method)
    points = upto.select(
        plain_ratio(F.col("_fp"), negatives).alias("fpr"),
        plain_ratio(F.col("_tp"), positives).alias("tpr"),
        "threshold",
    )
    start = scored.sparkSession.range(1, numPartitions=1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold")
    )
    return start.unionByName(points)


def roc_auc(
    scored: DataFrame, score: str = "churn_probability", label: str = "churned", method: str = "selected"
) -> DataFrame:
    """Chance that a churned customer scores above an active one, ties counting half."""
    upto, positives, negatives = _cumulated(scored, score, label, method)
    whole = "decimal(38,0)"
    below = (negatives - F.col("_fp")) * 2 + F.col("_neg")
    wins = F.sum(F.col("_pos").cast("decimal(19,0)") * below.cast("decimal(19,0)"))
    pairs = positives.cast("decimal(18,0)") * negatives.cast("decimal(18,0)") * F.lit(2)
    return upto.agg(plain_ratio(wins.cast(whole), pairs.cast(whole)).alias("roc_auc"))


def churn_kpis(scored: DataFrame, champion: str = "Champions") -> DataFrame:
    """High-risk customers, champions of the clustering, and the mean probability with its rating."""
    rows = F.count(F.lit(1))
    high = F.count_if(F.col("churn_risk") == "High")
    best = F.count_if(F.col("ml_segment") == champion)
    kpis = scored.agg(
        high.alias("high_risk"),
        plain_ratio(high, rows, 100).alias("high_risk_percent"),
        best.alias("champions"),
        plain_ratio(best, rows, 100).alias("champions_percent"),
        F.avg("churn_probability").alias("avg_churn_probability"),
    )
    return kpis.withColumn("churn_status", rules.churn_status(F.col("avg_churn_probability")))


def risk_distribution(scored: DataFrame) -> DataFrame:
    return value_counts(scored, "churn_risk", "customers")


def ml_segment_distribution(scored: DataFrame) -> DataFrame:
    return value_counts(scored, "ml_segment", "customers")


def top_churn(scored: DataFrame, limit: int = 20) -> DataFrame:
    columns = ["customer_id", "rfm_segment", "recency_days", "frequency", "monetary", "churn_probability"]
    return scored.select(*columns).orderBy(F.desc("churn_probability"), "customer_id").limit(limit)
