"""Complex impedance as pairs of columns (re, im), and the scalar formulas around it."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Complex = tuple[Column, Column]


def add(*terms: Complex) -> Complex:
    re, im = F.lit(0.0), F.lit(0.0)
    for a, b in terms:
        re, im = re + a, im + b
    return re, im


def multiply(x: Complex, y: Complex) -> Complex:
    return x[0] * y[0] - x[1] * y[1], x[0] * y[1] + x[1] * y[0]


def divide(x: Complex, y: Complex) -> Complex:
    size = y[0] * y[0] + y[1] * y[1]
    size = F.when(size > 0, size)
    return (x[0] * y[0] + x[1] * y[1]) / size, (x[1] * y[0] - x[0] * y[1]) / size


def polar(size: Column, angle: Column) -> Complex:
    return size * F.cos(angle), size * F.sin(angle)


def power_jw(w: Column, n: Column) -> Complex:
    """(jw)^n on the principal branch."""
    return polar(F.pow(w, n), n * math.pi / 2)


def zarc(w: Column, r: Column, tau: Column, n: Column) -> Complex:
    """r / (1 + (jw tau)^n)."""
    a, b = power_jw(w * tau, n)
    return divide((r, F.lit(0.0)), (1 + a, b))


def constant_phase(w: Column, y0: Column, n: Column) -> Complex:
    return divide((F.lit(1.0), F.lit(0.0)), tuple(y0 * x for x in power_jw(w, n)))


def inductor(w: Column, inductance: Column) -> Complex:
    return F.lit(0.0), w * inductance


def tanh(z: Complex) -> Complex:
    """Of a complex number with a non-negative real part, without overflow."""
    x, y = z
    e = F.exp(-2 * x)
    bottom = 1 + 2 * e * F.cos(2 * y) + e * e
    return (1 - e * e) / bottom, 2 * e * F.sin(2 * y) / bottom


def warburg(w: Column, aw: Column, tau: Column) -> Complex:
    """Finite-length Warburg element aw tanh(sqrt(jw tau)) / sqrt(jw tau)."""
    root = polar(F.sqrt(w * tau), F.lit(math.pi / 4))
    return tuple(aw * x for x in divide(tanh(root), root))


def delayed(z: Complex, f: Column, tau: Column, conjugated: bool = False) -> Complex:
    """z rotated by exp(j 2 pi f tau); conjugated first in an odd Nyquist zone."""
    z = (z[0], -z[1]) if conjugated else z
    return multiply(z, polar(F.lit(1.0), 2 * math.pi * f * tau))


def low_pass_corrected(z: Complex, f: Column, tau: Column) -> Complex:
    """z divided by a first-order low-pass."""
    return multiply(z, (F.lit(1.0), 2 * math.pi * f * tau))


def magnitude(z: Complex) -> Column:
    return F.sqrt(z[0] * z[0] + z[1] * z[1])


def phase(z: Complex) -> Column:
    return F.atan2(z[1], z[0])


def shunt_sensitivity(c0: Column, c1: Column, celsius: Column) -> Column:
    return c0 + 1e-3 * c1 * celsius


def current_density(volts: Column, c0: Column, c1: Column, celsius: Column) -> Column:
    """Null where the sensitivity is zero."""
    h = shunt_sensitivity(c0, c1, celsius)
    return volts / F.when(h != 0, h)


def celsius(volts: Column, c0: Column, c1: Column) -> Column:
    return (volts - c0) / F.when(c1 != 0, c1)


def saturation_pascal(celsius_: Column) -> Column:
    """Magnus formula over water."""
    return 611.2 * F.exp(17.62 * celsius_ / (243.12 + celsius_))


def mole_fraction(dew_celsius: Column, total_pascal: Column) -> Column:
    return saturation_pascal(dew_celsius) / total_pascal


def stoichiometry(current: Column, dry_air_nl_min: Column, oxygen: float = 0.2095) -> Column:
    """Oxygen fed over oxygen consumed at a current in ampere."""
    fed = dry_air_nl_min * oxygen / 22.414 / 60
    return fed / F.when(current > 0, current / (4 * 96485.33212))


def along(x: Column, places: list[float], values: list[Column]) -> Column:
    """Straight between the places and held beyond their ends: the temperature along the plate from a few sensors."""
    out = values[-1]
    for (a, u), (b, v) in reversed(list(zip(zip(places, values, strict=True), list(zip(places, values, strict=True))[1:], strict=False))):
        out = F.when(x <= b, u + (v - u) * (F.greatest(x, F.lit(a)) - a) / (b - a)).otherwise(out)
    return out
