"""Column functions over numbers and vectors, all in DOUBLE."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error-function approximation 7.1.26 of Abramowitz and Stegun.
ERF_P = 0.3275911
ERF_COEFFICIENTS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it inside a lambda over another array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def dot(left: Column, right: Column) -> Column:
    return total(F.zip_with(left, right, lambda a, b: a * b))


def erf(x: Column) -> Column:
    a1, a2, a3, a4, a5 = ERF_COEFFICIENTS
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * F.abs(x))
    series = ((((F.lit(a5) * t + a4) * t + a3) * t + a2) * t + a1) * t
    return F.signum(x) * (F.lit(1.0) - series * F.exp(-x * x))


def gelu(x: Column) -> Column:
    """Half of x times one plus erf(x / sqrt 2)."""
    return F.lit(0.5) * x * (F.lit(1.0) + erf(x / F.sqrt(F.lit(2.0))))


def layer_norm(vector: Column, weight: Column | None = None, eps: float = 1e-5) -> Column:
    """Scale to zero mean and unit population variance, without bias."""
    values = vector.cast("array<double>")

    def normalise(moments: Column) -> Column:
        scaled = F.transform(values, lambda x: (x - moments["mean"]) / F.sqrt(moments["var"] + F.lit(eps)))
        return scaled if weight is None else F.zip_with(scaled, weight, lambda x, w: x * w)

    size = F.size(values)
    mean = F.try_divide(total(values), size)  # NULL for an empty vector

    def with_variance(mu: Column) -> Column:
        squares = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mu) * (x - mu))
        return _bind(F.struct(mu.alias("mean"), F.try_divide(squares, size).alias("var")), normalise)

    return _bind(mean, with_variance)


def softmax(vector: Column) -> Column:
    values = vector.cast("array<double>")
    powers = _bind(F.array_max(values), lambda top: F.transform(values, lambda x: F.exp(x - top)))
    return _bind(powers, lambda es: _bind(total(es), lambda s: F.transform(es, lambda e: e / s)))


def log_softmax(vector: Column) -> Column:
    values = vector.cast("array<double>")

    def shift(top: Column) -> Column:
        log_sum = F.ln(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top)))
        return _bind(log_sum, lambda ls: F.transform(values, lambda x: x - top - ls))

    return _bind(F.array_max(values), shift)


def argmax(vector: Column) -> Column:
    """0-based position of the largest value, the lowest one among ties."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")
