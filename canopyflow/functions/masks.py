"""Mask semantics: a masked value is NULL, and any operation on it is masked, OR and AND included, unlike SQL's three-valued logic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_and(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), a & b)


def mask_or(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), a | b)


def unmask(x: Column, value=False) -> Column:
    return F.coalesce(x, F.lit(value))


def update_mask(band: Column, mask: Column) -> Column:
    return F.when(mask, band)


def self_mask(x: Column) -> Column:
    return F.when(x != 0, x)
