"""Counts, shares, exact order statistics, splits and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.session import work_dir

_ACCURACY = 10_000


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per distinct value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def value_shares(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per distinct value and their share of all rows.

    The grand total is a scalar subquery, so no window has to gather the groups in one task.
    """
    counts = value_counts(df, *keys)
    grand_total = counts.agg(F.sum("count").alias("n")).scalar()
    return counts.withColumn("share", C.ratio(F.col("count"), grand_total))


def _with_running(df: DataFrame, bucket: str, order: str, n: str, name: str) -> DataFrame:
    """Add the total of ``n`` over all rows before each row, for rows unique in ``order``.

    Two levels keep every task small: totals per bucket are summed up in one task, rows only
    inside their own bucket. Buckets must follow the order and be few.
    """
    before = lambda window: window.rowsBetween(W.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    totals = df.groupBy(bucket).agg(F.sum(n).alias("_total"))
    lower = totals.select(bucket, zero(F.sum("_total").over(before(W.orderBy(bucket)))).alias("_lower"))
    inside = zero(F.sum(n).over(before(W.partitionBy(bucket).orderBy(order))))
    return (
        df.withColumn("_inside", inside)
        .join(lower, bucket)
        .withColumn(name, F.col("_lower") + F.col("_inside"))
        .drop("_lower", "_inside")
    )


def median(df: DataFrame, c: str, buckets: int = 10_000) -> DataFrame:
    """Exact median as a one-row frame.

    A first pass brackets the middle by an approximate percentile with a rank guarantee. Only
    the distinct values inside the bracket (under 0.1 % of the ranks) are then ranked, spread
    over buckets of equal width.
    """
    values = df.select(F.col(c).cast("double").alias("v")).filter(F.col("v").isNotNull())
    margin = 2 / _ACCURACY
    sketch = values.agg(
        F.percentile_approx("v", [0.5 - margin, 0.5 + margin], _ACCURACY).alias("q")
    )
    low = sketch.select(F.col("q")[0].alias("low")).scalar()
    high = sketch.select(F.col("q")[1].alias("high")).scalar()
    ranks = values.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < low).alias("below")
    )
    n, below = ranks.select("n").scalar(), ranks.select("below").scalar()
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - low, high - low) * buckets), F.lit(0))
    middle = (
        values.filter(F.col("v").between(low, high)).groupBy("v").count().withColumn("b", place)
    )
    upto = below + F.col("before") + F.col("count")
    first = F.min(F.when(upto >= F.floor((n + 1) / 2), F.col("v")))
    second = F.min(F.when(upto >= F.floor(n / 2) + 1, F.col("v")))
    return _with_running(middle, "b", "v", "count", "before").agg(
        ((first + second) / 2).alias("median")
    )


def present(c: str) -> Column:
    """The number in a column, NULL where there is none or it is not a number."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians of several columns, as (column, median), from two scans.

    The first scan brackets the middle of every column by an approximate percentile with a rank
    guarantee. The second counts what lies below each bracket and the distinct values inside it,
    combined within tasks; running counts over those (under 0.1 % of the ranks) give the medians.
    """
    margin, values = 2 / _ACCURACY, {c: present(c) for c in columns}
    ends = [0.5 - margin, 0.5 + margin]
    # two ends and a count for each column
    row = df.agg(
        *[F.percentile_approx(v, ends, _ACCURACY).alias(f"{c}__ends") for c, v in values.items()],
        *[F.count(v).alias(f"{c}__count") for c, v in values.items()],
    ).first()
    found = {c: (k, row[f"{c}__ends"], row[f"{c}__count"]) for k, c in enumerate(columns) if row[f"{c}__count"]}
    shape = "struct<k:int,v:double>"
    cells = [
        F.when(values[c] < low, F.struct(F.lit(k).alias("k"), F.lit(None).cast("double").alias("v")).cast(shape))
        .when(values[c] <= high, F.struct(F.lit(k).alias("k"), values[c].alias("v")).cast(shape))
        for c, (k, (low, high), _) in found.items()
    ]
    sizes = df.sparkSession.createDataFrame([(k, c, n) for c, (k, _, n) in found.items()], "k int, column string, n long")
    inside = F.explode(F.array_compact(F.array(*cells))) if cells else F.explode(F.array().cast(f"array<{shape}>"))
    counts = df.select(inside.alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("count"))
    # values below the bracket are one row without a value, which comes first
    upto = F.sum("count").over(W.partitionBy("k").orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", upto).join(F.broadcast(sizes), "k")
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("v")))
    return ranked.groupBy("column").agg(((at(F.floor((F.col("n") + 1) / 2)) + at(F.floor(F.col("n") / 2) + 1)) / 2).alias("median"))


def stratified_split(
    df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly ``round(fraction * n)`` rows of every label, chosen by key hash.

    The rows are read once and written with their hashes; histogram, cut and flag read that table.
    The cut is the quota-th smallest hash of the label. Its 16-bit prefix comes from a
    histogram of at most 65,536 rows per label, so only one prefix's rows are ever ranked.
    """
    digest = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))), 256)
    path = work_dir(df.sparkSession, "split")
    hashed = df.withColumn("_h", digest)
    hashed.write.parquet(path)
    hashed = df.sparkSession.read.schema(hashed.schema).parquet(path)
    ranked = hashed.select(label, "_h", F.substring("_h", 1, 4).alias("_p"))
    in_label = W.partitionBy(label)
    running = in_label.orderBy("_p").rowsBetween(W.unboundedPreceding, 0)
    histogram = (
        ranked.groupBy(label, "_p")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("quota", F.round(F.sum("n").over(in_label) * F.lit(fraction)).cast("long"))
    )
    edge = histogram.filter(
        (F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota"))
    ).select(label, "_p", (F.col("quota") - (F.col("upto") - F.col("n"))).alias("take"))
    cut = (
        ranked.join(edge, [label, "_p"])
        .withColumn("rank", F.row_number().over(W.partitionBy(label).orderBy("_h")))
        .filter(F.col("rank") == F.col("take"))
        .select(label, F.col("_h").alias("_cut"))
    )
    return (
        hashed.join(cut, label, "left")
        .withColumn("is_test", C.flag(F.col("_h") <= F.col("_cut")))
        .select(*df.columns, "is_test")
    )


def balanced_weight(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight = n / (classes * n_label)``, the usual balancing of a skewed label."""
    counts = value_counts(df, label)
    classes = counts.agg(F.count(F.lit(1)).alias("k")).scalar()
    n = counts.agg(F.sum("count").alias("n")).scalar()
    weights = counts.select(label, C.ratio(n, classes * F.col("count")).alias("weight"))
    return df.join(weights, label)


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted) pair (A17). Keys are unique, so a count is enough."""
    return df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("customers"))


def outcome_label(actual: str | Column, predicted: str | Column) -> Column:
    """Name of the confusion cell."""
    a, p = C.col(actual), C.col(predicted)
    return C.first_match(
        [
            ((a == 1) & (p == 1), "True Positive"),
            ((a == 0) & (p == 0), "True Negative"),
            ((a == 0) & (p == 1), "False Positive"),
            ((a == 1) & (p == 0), "False Negative"),
        ],
        "Unknown",
    )


def binary_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; an undefined ratio is 0."""
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    cells = df.agg(
        C.count_where(a & p).alias("tp"),
        C.count_where(~a & p).alias("fp"),
        C.count_where(a & ~p).alias("fn"),
        C.count_where(~a & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    or_zero = lambda c: F.coalesce(c, F.lit(0.0))
    return cells.select(
        or_zero(C.ratio(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
        or_zero(C.ratio(tp, tp + fp)).alias("precision"),
        or_zero(C.ratio(tp, tp + fn)).alias("recall"),
        or_zero(C.ratio(2 * tp, 2 * tp + fp + fn)).alias("f1_score"),
    )


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    cells = confusion_counts(df, actual, predicted)
    hit = F.when(F.col(actual) == F.col(predicted), F.col("customers")).otherwise(0)
    by_actual = cells.groupBy(F.col(actual).alias("class")).agg(
        F.sum(hit).alias("hits"), F.sum("customers").alias("support")
    )
    by_predicted = cells.groupBy(F.col(predicted).alias("class")).agg(
        F.sum("customers").alias("predicted")
    )
    joined = by_actual.join(by_predicted, "class", "full")
    hits = F.coalesce(F.col("hits"), F.lit(0))
    support = F.coalesce(F.col("support"), F.lit(0))
    predicted_n = F.coalesce(F.col("predicted"), F.lit(0))
    or_zero = lambda c: F.coalesce(c, F.lit(0.0))
    return joined.select(
        "class",
        or_zero(C.ratio(hits, predicted_n)).alias("precision"),
        or_zero(C.ratio(hits, support)).alias("recall"),
        or_zero(C.ratio(2 * hits, support + predicted_n)).alias("f1_score"),
        support.alias("support"),
    )


def report_averages(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The report's rows over all classes (L9): accuracy, the plain and the weighted average."""
    cells = confusion_counts(df, actual, predicted)
    hit = F.when(F.col(actual) == F.col(predicted), F.col("customers")).otherwise(0)
    accuracy = cells.agg(C.ratio(F.sum(hit), F.sum("customers")).alias("a")).scalar()
    report = class_report(df, actual, predicted)
    n = F.sum("support")
    shown = ("precision", "recall", "f1_score")
    rows = [
        report.agg(F.lit("accuracy").alias("row"), *[F.first(accuracy).alias(c) for c in shown], n.alias("support")),
        report.agg(F.lit("macro avg").alias("row"), *[C.ratio(F.sum(c), F.count(F.lit(1))).alias(c) for c in shown], n.alias("support")),
        report.agg(F.lit("weighted avg").alias("row"), *[C.ratio(F.sum(F.col(c) * F.col("support")), n).alias(c) for c in shown], n.alias("support")),
    ]
    return reduce(DataFrame.unionByName, rows)


def roc_auc(df: DataFrame, label: str, score: str, buckets: int = 256) -> DataFrame:
    """Exact area under the ROC curve of any score, ties counted half.

    Rows collapse to one per distinct score before anything is ordered. Buckets hold about equally
    many distinct scores, so scores that crowd in one place do not crowd in one task.
    """
    scores = (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("s"))
        .agg(
            C.count_where(F.col(label) == 1).alias("pos"),
            C.count_where(F.col(label) == 0).alias("neg"),
        )
    )
    cuts = scores.agg(F.percentile_approx("s", [k / buckets for k in range(1, buckets)], _ACCURACY).alias("q")).scalar()
    # the number of cuts not above the score, found by halving
    scores = scores.withColumns({"_cuts": cuts, "b": F.lit(0)})
    step = 1 << (buckets - 1).bit_length()
    while step := step // 2:
        ahead = F.col("b") + step
        scores = scores.withColumn("b", F.when((ahead < buckets) & (F.get("_cuts", ahead - 1) <= F.col("s")), ahead).otherwise(F.col("b")))
    scores = scores.drop("_cuts")
    exact = lambda c: c.cast("decimal(19,0)")
    wins = exact(F.col("pos")) * exact(2 * F.col("neg_below") + F.col("neg"))
    return (
        _with_running(scores, "b", "s", "neg", "neg_below")
        .agg(F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(C.ratio(F.col("wins"), F.lit(2.0) * F.col("p") * F.col("n")).alias("roc_auc"))
    )
