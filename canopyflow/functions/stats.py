"""Scores and intervals as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Normal quantiles of the two intervals, and the size strata in hectares, [low, high).
Z, Z_EXACT = 1.96, 1.959963984540054
STRATA = (("under_0.5ha", 0.0, 0.5), ("0.5_to_1ha", 0.5, 1.0), ("1_to_5ha", 1.0, 5.0), ("over_5ha", 5.0, float("inf")))


def ratio(a: Column, b: Column) -> Column:
    """0 on a zero denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Negative counts or areas are an error when read."""
    tp, fp, fn = (F.when(x.isNull() | (x >= 0), x).otherwise(F.raise_error(F.concat(F.lit("a count below 0: "), x.cast("string"))).cast("double")) for x in (tp, fp, fn))
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {"precision": p, "recall": r, "f1": ratio(2 * p * r, p + r), "iou": ratio(tp, tp + fp + fn)}


def wilson(k: Column, n: Column, z: float = Z) -> tuple[Column, Column]:
    """(0, 1) where n is 0; negative counts, and more successes than trials, are an error when read."""
    wrong = F.concat(F.lit("not a share: "), k.cast("string"), F.lit(" of "), n.cast("string"))
    k = F.when(k.isNull() | ((k >= 0) & (k <= n)), k).otherwise(F.raise_error(wrong).cast("long"))
    p = F.try_divide(k.cast("double"), n.cast("double"))
    d = 1 + F.try_divide(F.lit(z * z), n.cast("double"))
    c = (p + F.try_divide(F.lit(z * z / 2), n.cast("double"))) / d
    m = (z / d) * F.sqrt(F.try_divide(p * (1 - p), n.cast("double")) + F.try_divide(F.lit(z * z / 4), n.cast("double") * n))
    return F.coalesce(F.greatest(F.lit(0.0), c - m), F.lit(0.0)), F.coalesce(F.least(F.lit(1.0), c + m), F.lit(1.0))


def _chi2(z: float, df: Column) -> Column:
    """Quantile by the Wilson-Hilferty cube."""
    return df * F.pow(1 - F.try_divide(F.lit(2.0), 9 * df) + z * F.sqrt(F.try_divide(F.lit(2.0), 9 * df)), 3)


def poisson(k: Column) -> tuple[Column, Column]:
    """95 % interval of a count."""
    k = k.cast("double")
    return F.when(k == 0, 0.0).otherwise(0.5 * _chi2(-Z_EXACT, 2 * k)), 0.5 * _chi2(Z_EXACT, 2 * k + 2)


def size_stratum(ha: Column) -> Column:
    out = F.when(ha <= 0, F.raise_error(F.concat(F.lit("an area has to be above 0: "), ha.cast("string"))).cast("string"))
    for name, _, high in STRATA:
        out = out.when(ha < high, name)
    return out


def shared_hash(col: Column) -> Column:
    """An order that any SQL engine can reproduce."""
    return (col.cast("long") * F.lit(2654435761)) % F.lit(4294967296)
