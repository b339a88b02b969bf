"""Accuracy: area-weighted confusion, precision by stratum, stratified samples, threshold sweeps."""

from __future__ import annotations

from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopyflow.functions import stats


def confusion_ha(pixels: DataFrame, predicted: Column, truth: Column, area: Column) -> DataFrame:
    """One row: tp, fp, fn in area; masked counts as not set; 0 for no pixels."""
    p, t = F.coalesce(predicted, F.lit(False)), F.coalesce(truth, F.lit(False))
    part = lambda c: F.coalesce(F.sum(F.when(c, area)), F.lit(0.0))
    return pixels.agg(part(p & t).alias("tp"), part(p & ~t).alias("fp"), part(~p & t).alias("fn"))


def metrics(counts: DataFrame) -> DataFrame:
    return counts.select("*", *(c.alias(n) for n, c in stats.confusion(F.col("tp"), F.col("fp"), F.col("fn")).items()))


def strata(spark) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, (n, _, _) in enumerate(stats.STRATA)], "ord int, stratum string")


def precision_report(verdicts: DataFrame) -> DataFrame:
    """verdicts (stratum, verdict) counted; every stratum has a row; unclear ones are outside the denominator."""
    n = lambda v: F.count(F.when(F.col("verdict") == v, 1))
    got = verdicts.groupBy("stratum").agg(n("true_positive").alias("tp"), n("false_positive").alias("fp"), n("unclear").alias("unclear"))
    out = strata(verdicts.sparkSession).join(got, "stratum", "left").na.fill(0, ["tp", "fp", "unclear"]).withColumn("judged", F.col("tp") + F.col("fp"))
    lo, hi = stats.wilson(F.col("tp"), F.col("judged"))
    return out.select("ord", "stratum", "tp", "fp", "unclear", "judged", stats.ratio(F.col("tp"), F.col("judged")).alias("precision"), lo.alias("lo"), hi.alias("hi"))


def as_rows(report: DataFrame) -> list[str]:
    """A precision report as lines of fixed width, a stratum each."""
    c = F.col
    share = F.format_string("%5.2f [%4.2f, %4.2f]", "precision", "lo", "hi")
    said = F.format_string("%-12s %4d judged  %4d true  %4d false  %4d unclear  %s", "stratum", "judged", "tp", "fp", "unclear", F.when(c("judged") > 0, share).otherwise("    -"))
    return [r.line for r in report.orderBy("ord").select(said.alias("line")).collect()]


def stratified_top(rows: DataFrame, classes: list[str], order: list[Column], n: int) -> DataFrame:
    """Up to n rows of each class, the first in order; Spark prunes each task's rows to n before the shuffle."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*classes).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def stratified_sample(alerts: list[dict], per_stratum: int = 25, seed: int = 42) -> list[dict]:
    """A reviewer's sample: within each stratum, in order of strata, a seeded draw from the alerts in order of id. For a small store, on the driver."""
    if per_stratum < 1:
        raise ValueError(f"a stratum needs a sample of one at least, not {per_stratum}")
    rng, out = Random(seed), []
    for _, low, high in stats.STRATA:
        some = sorted((a for a in alerts if low <= a["area_ha"] < high), key=lambda a: a["alert_id"])
        # drawn even where all are taken, as each draw moves the generator on for the strata after it
        out += rng.sample(some, min(per_stratum, len(some)))
    return out


def sample_id(sample: DataFrame, keys: list[str], alert: Column) -> DataFrame:
    """(keys, sample_id): twelve digits that name a drawn sample whatever the order of its rows. A sample is what people review, so it fits a row."""
    return sample.groupBy(*keys).agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(alert.cast("string"))), ","), 256), 1, 12).alias("sample_id"))


def pooled(report: DataFrame) -> DataFrame:
    """One row for all strata of a precision report."""
    out = report.agg(*(F.sum(n).alias(n) for n in ("tp", "fp", "unclear", "judged")))
    lo, hi = stats.wilson(F.col("tp"), F.col("judged"))
    return out.select("*", stats.ratio(F.col("tp"), F.col("judged")).alias("precision"), lo.alias("lo"), hi.alias("hi"))


def stratum_areas(pixels: DataFrame, keys: list[str], area: str) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.sum(area).alias("stratum_ha"))


def weighted(samples: DataFrame, areas: DataFrame, keys: list[str]) -> DataFrame:
    """samples with w: their stratum's area, shared by the samples that it really has."""
    had = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return samples.join(had, keys).join(areas, keys).withColumn("w", F.col("stratum_ha") / F.col("_n")).drop("_n", "stratum_ha")


def sweep(samples: DataFrame, thresholds: list[float], least: list[int], score: str = "dist", truth: str = "loss", weight: str = "w", pixels: str = "px", greener: str = "greener") -> DataFrame:
    """Weighted accuracy of every setting (gate, threshold, least pixels).

    pixels: a sample's patch size, or an array with its size at each threshold. Each sample is summed once, map-side, in the bin of the size steps that
    it reaches at each threshold; the settings are then cumulated over the bins, at most 4 x (len(least) + 1) ** len(thresholds) rows whatever the samples.
    """
    sized = dict(samples.dtypes)[pixels].startswith("array")
    steps = sorted(set(least))
    reached = lambda size: sum((F.when(size >= k, 1).otherwise(0) for k in steps[1:]), F.when(size >= steps[0], 1).otherwise(0))
    step = F.array(*(F.when(F.col(score) >= t, reached(F.col(pixels)[i] if sized else F.col(pixels))).otherwise(0) for i, t in enumerate(thresholds)))
    w = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    loss, own = F.coalesce(F.col(truth) == 1, F.lit(False)), F.col(weight)
    bins = samples.select(step.alias("step"), F.coalesce(F.col(greener) == 1, F.lit(False)).alias("green"), loss.alias("lost"), own.alias("w")).groupBy("step", "green", "lost").agg(w(F.col("w")).alias("w"), F.count(F.lit(1)).alias("n"), F.count("w").alias("n_w"))
    grid = F.array(*(F.struct(F.lit(g).alias("gate"), F.lit(float(t)).alias("threshold"), F.lit(int(k)).alias("least"), F.lit(i).alias("i"), F.lit(steps.index(k) + 1).alias("need")) for g in (False, True) for i, t in enumerate(thresholds) for k in least))
    each = bins.select("*", F.explode(grid).alias("s"))
    hit = (F.get("step", F.col("s.i")) >= F.col("s.need")) & ~(F.col("s.gate") & F.col("green"))
    part = lambda c, v="w": F.coalesce(F.sum(F.when(c, F.col(v))), F.lit(0))
    out = each.groupBy("s.gate", "s.threshold", "s.least").agg(
        part(hit & F.col("lost")).alias("tp"), part(hit & ~F.col("lost")).alias("fp"), part(hit & ~F.col("lost"), "n").cast("long").alias("n_fp"), part(~hit & F.col("lost")).alias("fn"),
        F.coalesce(F.try_divide(part(~F.col("lost")), part(~F.col("lost"), "n_w")), F.lit(0.0)).alias("stable_w"),
    )
    lo, hi = stats.poisson(F.col("n_fp"))
    mean = F.when(F.col("n_fp") > 0, F.col("fp") / F.greatest(F.col("n_fp"), F.lit(1))).otherwise(F.col("stable_w"))
    c = stats.confusion(F.col("tp"), F.col("fp"), F.col("fn"))
    return out.select("gate", "threshold", "least", "tp", "fp", "n_fp", "fn", c["precision"].alias("precision"), stats.ratio(F.col("tp"), F.col("tp") + hi * mean).alias("p_lo"), stats.ratio(F.col("tp"), F.col("tp") + lo * mean).alias("p_hi"), c["recall"].alias("recall"), c["f1"].alias("f1"))
