"""Normal densities, divergences and losses as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_SQRT_2PI = 0.5 * math.log(2 * math.pi)

# Fixed values of the training loss.
LIKELIHOOD_WEIGHT = 1e-5
SCALE_FLOOR = 1e-30


def stddev(log_var: Column) -> Column:
    return F.exp(0.5 * log_var)


def variance(log_var: Column) -> Column:
    return F.exp(log_var)


def log_density(x: Column, mean: Column, scale: Column) -> Column:
    """Log of the Normal density at ``x``."""
    z = (x - mean) / scale
    return -0.5 * z * z - F.log(scale) - LOG_SQRT_2PI


def entropy(scale: Column) -> Column:
    return 0.5 + LOG_SQRT_2PI + F.log(scale)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double"))


def row_nll(x: Column, mean: Column, log_var: Column) -> Column:
    """Negative log-likelihood of a vector, summed over its components."""
    squared = F.zip_with(x, mean, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    terms = F.zip_with(squared, log_var, lambda s, v: 0.5 * s * F.exp(-v) + 0.5 * v + LOG_SQRT_2PI)
    return array_sum(terms)


def row_kl(mean: Column, log_var: Column) -> Column:
    """Divergence of N(mean, exp(log_var)) from the standard Normal, summed over components."""
    terms = F.zip_with(
        mean,
        log_var,
        lambda m, v: v.cast("double") + 1.0 - m.cast("double") * m.cast("double") - F.exp(v.cast("double")),
    )
    return -0.5 * array_sum(terms)


def row_squared_error(x: Column, mean: Column) -> Column:
    return array_sum(
        F.zip_with(x, mean, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    )


def likelihood_loss(mse: Column, mean_log_density: Column) -> Column:
    return mse - LIKELIHOOD_WEIGHT * mean_log_density


def total_loss(mse: Column, mean_log_density: Column, kl: Column, mixing: float, beta: float) -> Column:
    """Composite training loss; a mixing factor of 0 or None counts as 1."""
    return mse + (mixing or 1.0) * likelihood_loss(mse, mean_log_density) + beta * kl


def reparameterized(mean: Column, log_var: Column, noise: Column) -> Column:
    """``mean + noise * exp(log_var / 2)`` for scalar columns."""
    return mean + noise * stddev(log_var)


def normal_sample(mean: Column, scale: Column, seed: int) -> Column:
    return mean + F.randn(seed) * scale
