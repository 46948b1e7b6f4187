"""Bias, error and their 22 bins as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.functions.categories import ladder

ZERO_SALES_DIVISOR = 0.00001
ZERO_POSITION = 10  # index of the bin that ends at zero

# Bias edges run over -100..100 percent by 10, error edges over -50..50 units by 5.
BIN_EDGES = {"bias": range(-100, 101, 10), "error": range(-50, 51, 5)}
DEFAULT_GOOD_RANGE = {"bias": (-20.0, 30.0), "error": (-10.0, 15.0)}


def _signed(edge: int) -> str:
    return f"+{edge}" if edge > 0 else str(edge)


def bin_table(method: str) -> list[tuple[str, float, float]]:
    """The 22 bins in order as (label, start, end); the outer two are open."""
    edges = list(BIN_EDGES[method])
    spans = [(-math.inf, edges[0]), *zip(edges, edges[1:]), (edges[-1], math.inf)]
    rows = []
    for number, (start, end) in enumerate(spans, start=1):
        if start == -math.inf:
            text = f"< {_signed(end)}"
        elif end == math.inf:
            text = f"> {_signed(start)}"
        else:
            text = f"{_signed(start)} {_signed(end)}"
        rows.append((f"{number:02d}| {text}", float(start), float(end)))
    return rows


def bin_label(method: str, value: Column) -> Column:
    """The bin of ``value`` (bias as a ratio, error in units); null goes to the last bin."""
    unit = 100 if method == "bias" else 1
    rows = bin_table(method)
    return ladder([(value < end / unit, label) for label, _, end in rows[:-1]], rows[-1][0])


def bias(actual: Column, predicted: Column) -> Column:
    gap = predicted - actual
    return F.when(actual > 0, gap / actual).when(
        actual == 0, gap / F.lit(ZERO_SALES_DIVISOR)).otherwise(F.lit(0.0))


def error(actual: Column, predicted: Column) -> Column:
    return predicted - actual


def percent(part: Column, whole: Column) -> Column:
    """Percent to one decimal, halves to the even digit; null where the whole is zero."""
    return F.bround(part / F.nullif(whole, F.lit(0)) * 100, 1)
