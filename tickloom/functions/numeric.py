"""Column functions for phases, filter gains and noise models."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_PS = 200_000
HALF_PS = PERIOD_PS // 2
MAD_TO_SIGMA = 1.4826


def wrapped(change: Column) -> Column:
    """The change less whole periods, in (-half, half]."""
    return (F.lit(HALF_PS) - F.pmod(F.lit(HALF_PS) - change, F.lit(PERIOD_PS))).cast("long")


def half_even(doubled: Column) -> Column:
    """Half of a whole number, rounded half to even, in whole numbers only."""
    low = F.floor(doubled / 2).cast("long")
    return F.when(F.pmod(doubled, F.lit(2)) == 0, low).otherwise(low + F.pmod(low, F.lit(2)))


def cycles(predicted: Column, phase: Column) -> Column:
    """Whole periods to add to a raw phase to come nearest to the predicted one."""
    return F.rint((predicted - phase) / F.lit(float(PERIOD_PS))).cast("long")


def gains(states: Column, m: Column, epoch_s: float = 600.0) -> Column:
    """Struct (g, h, k) of a critically damped fixed-gain filter: poles at exp(-1/m); one state takes the measurement as it is."""
    lam = F.exp(F.lit(-1.0) / m)
    one = 1 - lam
    g = F.when(states == 1, F.lit(1.0)).when(states == 2, 1 - lam * lam).otherwise(1 - lam * lam * lam)
    h = F.when(states == 1, F.lit(0.0)).when(states == 2, one * one / epoch_s).otherwise(1.5 * one * one * (1 + lam) / epoch_s)
    k = F.when(states == 3, one * one * one / (epoch_s * epoch_s)).otherwise(F.lit(0.0))
    return F.struct(g.alias("g"), h.alias("h"), k.alias("k"))


def allan_model(tau: Column, white: Column, flicker_phase: Column, flicker: Column, walk: Column) -> Column:
    """a2/tau^2 + a1/tau + a0 + b1*tau."""
    return white / (tau * tau) + flicker_phase / tau + flicker + walk * tau


def measurement_noise(white: Column) -> Column:
    return F.sqrt(white / 3)


def time_constant(tau_s: Column, epoch_s: float = 600.0) -> Column:
    """Epochs, at least one, rounded half to even."""
    return F.greatest(F.lit(1), F.rint(tau_s / epoch_s)).cast("long")


def signed_phase(fs: Column) -> Column:
    """Femtoseconds as picoseconds with three decimals and a sign."""
    size = F.abs(fs)
    return F.concat(F.when(fs < 0, "-").otherwise("+"), F.floor(size / 1000).cast("string"), F.lit("."), F.lpad(F.pmod(size, F.lit(1000)).cast("string"), 3, "0"))


def median_of(values: Column) -> Column:
    """Median of a sorted array of numbers."""
    n = F.size(values)
    return (F.element_at(values, F.floor((n + 1) / 2).cast("int")) + F.element_at(values, (F.floor(n / 2) + 1).cast("int"))) / F.lit(2.0)


LN2 = math.log(2.0)
