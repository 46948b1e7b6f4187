"""Batched regression for a bending trend with a multiplicative weekly season.

The model is the piecewise-linear trend with a weekly Fourier season of Taylor and Letham,
"Forecasting at Scale" (2018).  Slope changes have a Laplace prior, as theirs do: most are exactly zero, and those that are not
are shrunk by a constant (soft threshold).  The season has a normal prior.  The noise, which weighs the data against the prior, is the
mean square that a straight line under the current season leaves, where theirs is sampled.  So it is an estimator of the same form, not the same
estimates.  ``ridge`` gives slope changes a normal prior instead.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

# The solver travels to the workers by value, so they need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPOCH = date(1970, 1, 1)
HISTORY_SHARE = 0.8  # changepoints lie in the first part of the rows
FOURIER_ORDER = 3
SEASON_DAYS = 14
SEASON_PENALTY = 0.01
ROUNDS = 6
MIN_ROWS = 2
LAPLACE, RIDGE = "laplace", "ridge"
MOST_TURNS = 20
TINY = 1e-8


def _bends(scaled: np.ndarray, changepoints: int) -> np.ndarray:
    """Where the trend may bend: evenly spread over the first rows, never more than rows allow."""
    rows = int(len(scaled) * HISTORY_SHARE)
    count = max(min(changepoints, rows - 1), 0)
    return scaled[np.linspace(0, rows - 1, count + 1).round().astype(int)[1:]]


def _trend_design(scaled: np.ndarray, bends: np.ndarray) -> np.ndarray:
    hinges = np.maximum(scaled[:, None] - bends[None, :], 0.0)
    return np.column_stack([np.ones_like(scaled), scaled, hinges])


def _season_design(days: np.ndarray) -> np.ndarray:
    angle = 2.0 * np.pi * days[:, None] * np.arange(1, FOURIER_ORDER + 1)[None, :] / 7.0
    return np.column_stack([np.sin(angle), np.cos(angle)])


def _ridge(design: np.ndarray, penalty: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Coefficients for a stack of designs (series, rows, terms) and targets (series, rows)."""
    normal = np.einsum("spi,spj->sij", design, design) + np.diag(penalty)
    moment = np.einsum("spi,sp->si", design, target)
    return np.linalg.solve(normal, moment[..., None])[..., 0]


def lasso(gram: np.ndarray, moment: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Minimum of half b'Gb - m'b + w |b|_1 for stacks G (series, terms, terms), m (series, terms) and w (series).

    An active set with signs: given these the minimum solves a linear system.  On the way there the first term that would change its
    sign stops at zero and leaves the set; once there, the term outside that could improve most enters.  A series is done when
    none could, which are the conditions of optimality; the others go on together.
    """
    out = np.zeros_like(moment)
    terms = moment.shape[1]
    todo = np.arange(len(moment))
    b, sign, barred = (np.zeros_like(moment) for _ in range(3))
    slack = 1e-9 * (np.maximum(np.abs(moment).max(axis=1, initial=0.0), weight) + TINY)
    each = np.arange(terms)
    for _ in range(MOST_TURNS * (terms + 1)):
        g, m, w = gram[todo], moment[todo], weight[todo][:, None]
        slope = m - np.einsum("sij,sj->si", g, b)
        excess = np.where((sign != 0) | (barred != 0), -np.inf, np.abs(slope) - w)
        enter = excess.argmax(axis=1)
        settled = (np.where(sign != 0, np.abs(slope - w * sign), 0.0) <= slack[todo, None]).all(axis=1)
        done = settled & (excess[np.arange(len(todo)), enter] <= slack[todo])
        out[todo] = b
        if done.all():
            break
        add = np.flatnonzero(settled & ~done)
        sign[add, enter[add]] = np.sign(slope[add, enter[add]])
        g, m, w, b, sign, barred, todo = (x[~done] for x in (g, m, w, b, sign, barred, todo))
        inside = sign != 0
        system = np.where(inside[:, :, None] & inside[:, None, :], g, 0.0)
        system[:, each, each] += np.where(inside, 0.0, 1.0)
        goal = np.linalg.solve(system, np.where(inside, m - w * sign, 0.0)[..., None])[..., 0]
        crossing = inside & (goal * sign <= 0)
        reach = np.where(crossing, np.abs(b) / np.maximum(np.abs(b) + np.abs(goal), 1e-300), 1.0)
        step = reach.min(axis=1, keepdims=True, initial=1.0)
        leaving = crossing & (reach <= step)
        # One that leaves without having moved must wait until another one has.
        barred = np.where(step > 0, 0.0, barred + leaving)
        b = np.where(leaving | ~inside, 0.0, b + step * (goal - b))
        sign = np.where(leaving, 0.0, sign)
    return out


def _sparse(design: np.ndarray, prior: float, target: np.ndarray) -> np.ndarray:
    """Intercept, slope and slope changes of each series; the first two are free, so they are taken out first."""
    normal = np.einsum("spi,spj->sij", design, design)
    normal[:, np.arange(design.shape[2]), np.arange(design.shape[2])] += TINY
    moment = np.einsum("spi,sp->si", design, target)
    line = np.linalg.solve(normal[:, :2, :2], np.concatenate((moment[:, :2, None], normal[:, :2, 2:]), axis=2))
    straight, carried = line[:, :, 0], line[:, :, 1:]
    left = target - np.einsum("spi,si->sp", design[:, :, :2], straight)
    weight = np.square(left).mean(axis=1) / prior
    gram = normal[:, 2:, 2:] - normal[:, 2:, :2] @ carried
    bends = lasso(gram, moment[:, 2:] - np.einsum("sij,sj->si", normal[:, 2:, :2], straight), weight)
    return np.concatenate((straight - np.einsum("sij,sj->si", carried, bends), bends), axis=1)


def fit_block(y: np.ndarray, days: np.ndarray, changepoints: int, prior: float,
              future_days: np.ndarray, flags: np.ndarray | None = None,
              future_flags: np.ndarray | None = None, penalty: str = LAPLACE) -> np.ndarray:
    """Forecasts (series, future) for series of one length and one set of dates.

    ``flags`` (rows, flags) and ``future_flags`` lift or lower the trend on their days, as the season
    does.
    """
    n, span = y.shape[1], max(days[-1] - days[0], 1)
    scaled, ahead = (days - days[0]) / span, (future_days - days[0]) / span
    bends = _bends(scaled, changepoints)
    trend_x, trend_future = _trend_design(scaled, bends), _trend_design(ahead, bends)
    # Only the bends are penalised; the tiny rest keeps the system solvable.
    trend_penalty = np.full(trend_x.shape[1], TINY)
    trend_penalty[2:] = 1.0 / prior ** 2 / max(n, 1)
    lift_parts = [(_season_design(days), _season_design(future_days))] if (
        days[-1] - days[0] + 1 >= SEASON_DAYS) else []
    if flags is not None and flags.shape[1]:
        lift_parts.append((flags, future_flags))
    scale = np.maximum(np.abs(y).max(axis=1, keepdims=True), 1e-12)
    target = y / scale
    lift, lift_future = np.ones_like(target), np.ones((len(y), len(future_days)))
    if lift_parts:
        lift_x, lift_x_future = (np.column_stack(side) for side in zip(*lift_parts))
        lift_penalty = np.full(lift_x.shape[1], SEASON_PENALTY)
    for _ in range(ROUNDS if lift_parts else 1):
        lifted = trend_x[None] * lift[..., None]
        trend_beta = _sparse(lifted, prior, target) if penalty == LAPLACE and len(bends) else _ridge(lifted, trend_penalty, target)
        trend = trend_beta @ trend_x.T
        if lift_parts:
            lift_beta = _ridge(lift_x[None] * trend[..., None], lift_penalty, target - trend)
            lift, lift_future = 1.0 + lift_beta @ lift_x.T, 1.0 + lift_beta @ lift_x_future.T
    return (trend_beta @ trend_future.T) * lift_future * scale


@dataclass(frozen=True)
class RegressorDays:
    """Flag values by day, from ``first`` (days since 1970) on, and the columns each category uses."""

    first: int
    values: np.ndarray
    columns: dict[str, list[int]]

    def of(self, category: str, days: np.ndarray) -> np.ndarray:
        """Flags of the days; zeros for days outside the table."""
        place = days - self.first
        known = (place >= 0) & (place < len(self.values))
        found = self.values[np.where(known, place, 0)] * known[:, None] if len(self.values) else np.zeros(
            (len(days), self.values.shape[1]))
        return found[:, self.columns.get(category, [])]


def changepoint_values(start: date, horizon_days: int, regressors: RegressorDays | None = None, penalty: str = LAPLACE):
    """A pandas UDF from a product's series to its forecast values, null where there is no fit."""
    first = (start - EPOCH).days

    @F.pandas_udf("array<double>")
    def values(y: pd.Series, days: pd.Series, changepoints: pd.Series, prior: pd.Series,
               category: pd.Series) -> pd.Series:
        future = np.arange(first, first + horizon_days)
        out = pd.Series([None] * len(y), index=y.index, dtype=object)
        frame = pd.DataFrame({"y": y, "days": days, "c": changepoints, "p": prior,
                              "category": category if regressors else ""})
        frame = frame[[v is not None and len(v) >= MIN_ROWS for v in frame["y"]]]
        # Products with the same rule and the same dates share one design and one solve.
        frame["dates"] = [np.asarray(d, dtype=np.int64).tobytes() for d in frame["days"]]
        for (_, c, p, label), block in frame.groupby(["dates", "c", "p", "category"]):
            series = np.stack([np.asarray(v, dtype=float) for v in block["y"]])
            dates = np.asarray(block["days"].iloc[0], dtype=np.int64)
            flags = [regressors.of(label, d) for d in (dates, future)] if regressors else [None, None]
            try:
                fitted = fit_block(series, dates, int(c), float(p), future, *flags, penalty)
            except np.linalg.LinAlgError:
                continue
            for index, row in zip(block.index, fitted):
                if np.isfinite(row).all():
                    out.at[index] = row
        return out

    return values
