"""Studies of scored rows: threshold sweep, summaries, box statistics, distributions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions.lookup import one_row_map
from agoralens.operators.profile import histogram
from agoralens.operators.quantiles import exact_quantiles
from agoralens.session import settled


def below_threshold(matches: DataFrame, threshold=fv.MATCH_THRESHOLD) -> DataFrame:
    """Opinions whose best score is under the threshold."""
    return matches.filter(F.col("similarity_score") < threshold).select(
        "opinion_id",
        F.col("matched_topic_id").alias("matched_topic"),
        F.col("similarity_score").alias("score"),
    )


def match_summary(matched: DataFrame, threshold=fv.MATCH_THRESHOLD) -> DataFrame:
    """Totals, accuracy, mean similarity, confident and below-threshold counts in one row."""
    score = F.col("similarity_score")
    return matched.agg(
        F.count("*").alias("total"),
        F.count_if("is_correct").alias("correct"),
        F.avg(F.col("is_correct").cast("int")).alias("accuracy"),
        F.avg(score).alias("mean_similarity"),
        F.count_if(score >= threshold).alias("confident"),
        F.count_if(score < threshold).alias("below_threshold"),
    )


def threshold_sweep(
    matched: DataFrame,
    score="similarity_score",
    correct="is_correct",
    steps=fv.SWEEP_STEPS,
    width=fv.SWEEP_WIDTH,
) -> DataFrame:
    """Accuracy and coverage at evenly spaced cut-offs, both 0 where no row passes.

    All cut-offs are counted in one pass over one row per opinion.
    """
    cuts = [i * width for i in range(steps)]
    counters = [F.count("*").alias("n")]
    for i, cut in enumerate(cuts):
        passed = F.coalesce(F.col(score) >= F.lit(cut), F.lit(False))
        counters += [
            F.count_if(passed).alias(f"p{i}"),
            F.count_if(passed & F.col(correct)).alias(f"c{i}"),
        ]
    one = matched.agg(*counters)
    rows = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(cut).alias("threshold"),
            F.coalesce(F.try_divide(F.col(f"c{i}"), F.col(f"p{i}")), F.lit(0.0)).alias("accuracy"),
            F.coalesce(F.try_divide(F.col(f"p{i}"), F.col("n")), F.lit(0.0)).alias("coverage"),
            F.col(f"p{i}").alias("passed"),
        )
        for i, cut in enumerate(cuts)
    ]
    return one.select(F.inline(F.array(*rows)))


def score_by_correctness(df: DataFrame, score="similarity_score", correct="is_correct") -> DataFrame:
    """Count, mean and population deviation of the scores of right and wrong rows."""
    return df.groupBy(F.col(correct).alias("is_correct")).agg(
        F.count(score).alias("count"),
        F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
    )


def box_statistics(df: DataFrame, score="similarity_score", correct="is_correct") -> DataFrame:
    """Quartiles, whiskers at 1.5 quartile ranges and outlier count of right and wrong rows.

    Flag and score are stored first, because the quartiles need several passes over them.
    """
    flags = df.select(F.col(correct).alias("is_correct"), F.col(score).cast("double").alias("v"))
    flags = settled(flags.filter("v is not null and is_correct is not null"), "scores")
    per_flag = (
        exact_quantiles(flags, "v", (0.25, 0.5, 0.75), "is_correct")
        .groupBy("is_correct")
        .agg(F.map_from_entries(F.collect_list(F.struct("share", "quantile"))).alias("q"))
    )
    lookup = one_row_map(per_flag, "is_correct", "q")
    q = {n: F.col("q")[F.lit(s)] for n, s in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    rows = (
        flags.withColumn("q", lookup[F.col("is_correct")])
        .select("is_correct", "v", *[c.alias(n) for n, c in q.items()])
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    v = F.col("v")
    stats = rows.groupBy("is_correct").agg(
        F.count("*").alias("count"),
        *[F.max(n).alias(n) for n in ("q1", "median", "q3")],
        F.min(F.when(v >= low, v)).alias("lo"),
        F.max(F.when(v <= high, v)).alias("hi"),
        F.count_if((v < low) | (v > high)).alias("outliers"),
    )
    # A whisker never ends inside the box.
    return stats.select(
        "is_correct",
        "count",
        "q1",
        "median",
        "q3",
        F.least("lo", "q1").alias("whisker_low"),
        F.greatest("hi", "q3").alias("whisker_high"),
        "outliers",
    )


def distribution_report(df: DataFrame, score: str, bins: int, guide=fv.REPORT_GUIDE) -> DataFrame:
    """Histogram of scores; every row repeats the mean and the share at or over the guide.

    The scores are stored first, because the edges need one pass and the counts another.
    """
    df = settled(df.select(score), "scores")
    known = F.col(score)
    totals = df.agg(
        F.struct(
            F.avg(known).alias("mean"),
            (F.count_if(known >= guide) / F.nullif(F.count(known), F.lit(0))).alias("share"),
        ).alias("t")
    ).scalar()
    return (
        histogram(df, score, bins)
        .withColumn("t", totals)
        .select("bin", "lower", "upper", "count", F.col("t.mean").alias("mean"), F.col("t.share").alias("guide_share"))
    )


def similarity_report(matches: DataFrame) -> DataFrame:
    return distribution_report(matches, "similarity_score", fv.SIMILARITY_BINS)


def confidence_report(classified: DataFrame) -> DataFrame:
    return distribution_report(classified, "type_confidence", fv.CONFIDENCE_BINS)
