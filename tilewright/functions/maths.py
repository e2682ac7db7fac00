"""Numbers: clipping, quantizing, the noise model's lines, learning rates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """NaN counts as larger than any number, so it becomes `high`."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def quantize(value: Column, step: float | None) -> Column:
    """Multiples of `step`, half to even; no step, no change."""
    return F.rint(value / F.lit(step)) * F.lit(step) if step and step > 0 else value


def variance_line(value: Column, a: Column, b: Column) -> Column:
    """a * max(x, 0) + b, floored at 0."""
    return F.greatest(a * F.greatest(value, F.lit(0.0)) + b, F.lit(0.0))


def sigma(value: Column, a: Column, b: Column) -> Column:
    """The standard deviation by the variance line, floored at 1e-6."""
    return F.sqrt(F.greatest(a * F.greatest(value, F.lit(0.0)) + b, F.lit(1e-12)))


def aligned_span(extent: Column, crop: Column, period: Column) -> Column:
    """How many whole periods an aligned crop can be shifted by; raises if the crop doesn't fit."""
    return F.when(extent >= crop, F.floor((extent - crop) / period)).otherwise(F.raise_error(F.lit("the crop is larger than the frame")))


def cosine_lr(step: Column, total: int, lr: float) -> Column:
    """The closed form of cosine annealing: a resumed run has the same rate at a step as one that never stopped."""
    return F.lit(0.5 * lr) * (1 + F.cos(F.lit(math.pi) * step / F.lit(float(total))))


def psnr(mse: Column) -> Column:
    """Decibels against a peak of 1; 99 for an error that is practically none."""
    return F.when(mse <= 1e-12, 99.0).otherwise(10 * F.log10(1 / mse))
