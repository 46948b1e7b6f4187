"""Forecast settings: dates, thresholds and the per-category lifecycle table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta
from types import MappingProxyType

# Calendar flags that Growth and Mature categories may use as regressors.
CALENDAR_REGRESSORS = (
    "EID_ADHA_DAY_0",
    "EID_ADHA_DAY_PLUS_1",
    "EID_FITR_DAY_0",
    "EID_FITR_DAY_MINUS_1",
    "ISLAMIC_NEW_YEAR_DAY_0",
    "ISLAMIC_NEW_YEAR_DAY_PLUS_1",
    "BLACK_FRIDAY_DAY_0",
    "NATIONAL_DAY_DAY_0",
    "ARAFAT_DAY_DAY_0",
    "WHITE_FRIDAY_DAY_0",
)


@dataclass(frozen=True)
class LifecycleRule:
    """How one age-and-sales category is trained and scaled."""

    look_back: int
    over_forecast_factor: float
    changepoints: int
    changepoint_prior: float
    regressors: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.look_back < 1:
            raise ValueError("look_back must be at least 1")
        if self.over_forecast_factor <= 0 or self.changepoint_prior <= 0:
            raise ValueError("over_forecast_factor and changepoint_prior must be positive")


# Category -> look-back rows, over-forecast factor, changepoints, prior, regressors.
LIFECYCLE_RULES: Mapping[str, LifecycleRule] = MappingProxyType({
    "02| Launch_01| Low": LifecycleRule(10, 1.0, 1, 0.01),
    "02| Launch_02| Medium": LifecycleRule(10, 1.15, 2, 0.05),
    "02| Launch_03| High": LifecycleRule(7, 1.2, 1, 0.1),
    "03| Growth_01| Low": LifecycleRule(10, 1.0, 2, 0.01),
    "03| Growth_02| Medium": LifecycleRule(30, 1.3, 3, 0.05, CALENDAR_REGRESSORS),
    "03| Growth_03| High": LifecycleRule(30, 1.3, 4, 0.1, CALENDAR_REGRESSORS),
    "04| Mature_01| Low": LifecycleRule(60, 1.0, 4, 0.01, CALENDAR_REGRESSORS),
    "04| Mature_02| Medium": LifecycleRule(
        60, 1.3, 6, 0.05, ("SALARY_PERIOD", *CALENDAR_REGRESSORS)),
    "04| Mature_03| High": LifecycleRule(
        60, 1.3, 8, 0.1, ("SALARY_PERIOD", *CALENDAR_REGRESSORS)),
})
FALLBACK_RULE = LifecycleRule(60, 1.1, 25, 0.05)


@dataclass(frozen=True)
class Settings:
    """One run's settings.  Bad values raise here, before any job starts."""

    history_start: date = date(2025, 4, 21)
    history_end: date = date(2025, 10, 16)
    forecast_start: date | None = None
    horizon_days: int = 14
    min_observations: int = 8
    zero_ratio_threshold: float = 0.6
    recent_rows: int = 14
    salary_first_day: int = 25
    salary_last_day: int = 4
    non_eligible_ages: tuple[str, ...] = ("00| Draft", "01| New")
    non_eligible_sales: tuple[str, ...] = ("01| Dead",)
    lifecycle: Mapping[str, LifecycleRule] = field(default_factory=lambda: LIFECYCLE_RULES)
    fallback: LifecycleRule = FALLBACK_RULE
    strict_draft: bool = False
    """Label every day before the first sale Draft, not just the last one."""
    use_regressors: bool = False
    """Let the changepoint model see each category's calendar flags, past and future."""
    changepoint_penalty: str = "laplace"
    """Prior of the trend's bends: "laplace" leaves most of them out, "ridge" makes all of them small."""

    def __post_init__(self) -> None:
        if self.changepoint_penalty not in ("laplace", "ridge"):
            raise ValueError("changepoint_penalty must be laplace or ridge")
        for name in ("history_start", "history_end", "forecast_start"):
            value = getattr(self, name)
            if isinstance(value, str):
                object.__setattr__(self, name, date.fromisoformat(value))
        if self.history_start >= self.history_end:
            raise ValueError("history_start must be before history_end")
        if self.forecast_start is None:
            object.__setattr__(self, "forecast_start", self.history_end + timedelta(days=1))
        if self.forecast_start <= self.history_end:
            raise ValueError("forecast_start must be after history_end, the last training day")
        if self.horizon_days < 1 or self.min_observations < 1 or self.recent_rows < 1:
            raise ValueError("horizon_days, min_observations and recent_rows must be positive")
        if not 0.0 <= self.zero_ratio_threshold <= 1.0:
            raise ValueError("zero_ratio_threshold must be within 0..1")
        if not self.lifecycle:
            raise ValueError("the lifecycle table is empty")

    @property
    def forecast_end(self) -> date:
        return self.forecast_start + timedelta(days=self.horizon_days - 1)

    @property
    def longest_look_back(self) -> int:
        return max(rule.look_back for rule in (*self.lifecycle.values(), self.fallback))

    @property
    def all_regressors(self) -> tuple[str, ...]:
        seen = dict.fromkeys(r for rule in self.lifecycle.values() for r in rule.regressors)
        return tuple(seen)
