"""Column expressions on prices, quotes and spreads. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity tiers (strictly above), and the bands of the imbalance panel.
CRITICAL_ABOVE = 0.01
WARNING_ABOVE = 0.005
IMBALANCE_STEPS = ((-0.5, "red"), (-0.2, "yellow"), (0.2, "green"), (0.5, "yellow"))

# A standard deviation below this share of the price is rounding noise of equal samples: a double
# carries a price to about 2e-16 of itself, and a frame adds up a hundred of them.
STD_NOISE = 1e-13


def fixed_point(raw: Column, expo: Column) -> Column:
    """Oracle mantissa and exponent to DOUBLE: ``raw * 10^expo``."""
    return raw.cast("double") * F.pow(F.lit(10.0), expo)


def peg_deviation(price: Column) -> Column:
    return F.abs(F.lit(1.0) - price)


def peg_severity(deviation: Column) -> Column:
    return (
        F.when(deviation > CRITICAL_ABOVE, "CRITICAL")
        .when(deviation > WARNING_ABOVE, "WARNING")
        .otherwise("INFO")
    )


def mid_price(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2.0


def quote_width(bid: Column, ask: Column) -> Column:
    return ask - bid


def imbalance_ratio(bid_qty: Column, ask_qty: Column) -> Column:
    """Bid share minus ask share in [-1, 1]; an empty book counts as balanced."""
    total = bid_qty + ask_qty
    return F.when(total > 0, (bid_qty - ask_qty) / total).otherwise(F.lit(0.0))


def imbalance_band(value: Column) -> Column:
    """Colour of the highest threshold step at or below ``value``; the first step is the floor."""
    band = F.lit(IMBALANCE_STEPS[0][1])
    for step, colour in IMBALANCE_STEPS[1:]:
        band = F.when(value >= step, F.lit(colour)).otherwise(band)
    return F.when(value.isNotNull(), band)


def z_score(
    value: Column, mean: Column, std: Column, count: Column, price: Column | None = None
) -> Column:
    """Distance from the mean in deviations; 0 for a lone sample or for equal samples.

    ``price`` is one of the prices whose difference ``value`` is: its size says how far equal
    samples may differ by rounding. Without it the values themselves say so.
    """
    size = F.greatest(F.abs(value), F.abs(mean)) if price is None else F.abs(price)
    noise = size * STD_NOISE
    return F.when((count >= 2) & (std > noise), (value - mean) / std).otherwise(F.lit(0.0))
