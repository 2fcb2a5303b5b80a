"""Price, volume and attention classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds in percent, as ratio to the baseline, and in seconds.
ALERT_MOVE_PCT = 1.5
HIGH_MOVE_PCT = 1.5
MEDIUM_MOVE_PCT = 0.5
HIGH_VOLUME_RATIO = 2.0
MEDIUM_VOLUME_RATIO = 1.5
FLAT_MOVE_PCT = 0.1
FRESH_SECONDS = 120
LAGGING_SECONDS = 900

# Weights of the attention score.
MOVE_WEIGHT = 1.5
SIGNAL_BONUS = {"HIGH": 3.0, "MEDIUM": 1.5}
VOLATILITY_BONUS = {"HIGH": 2.0, "MEDIUM": 1.0}


def percent_change(start: Column, end: Column) -> Column:
    """Change in percent; null unless the start is positive, or when it does not fit.

    Decimals keep four digits.
    """
    share = F.try_divide(F.try_subtract(end, start), start)
    return F.when(start > 0, F.try_multiply(share, F.lit(100)))


def price_alert_type(change_pct: Column) -> Column:
    """PRICE_SURGE, PRICE_DROP, or null for a move inside the threshold."""
    return F.when(change_pct >= F.lit(ALERT_MOVE_PCT), "PRICE_SURGE").when(
        change_pct <= F.lit(-ALERT_MOVE_PCT), "PRICE_DROP"
    )


def alert_severity(change_pct: Column) -> Column:
    return F.when(F.abs(change_pct) >= F.lit(ALERT_MOVE_PCT), "HIGH").otherwise("LOW")


def volatility_level(change_pct: Column) -> Column:
    size = F.abs(change_pct)
    return (
        F.when(size >= F.lit(HIGH_MOVE_PCT), "HIGH")
        .when(size >= F.lit(MEDIUM_MOVE_PCT), "MEDIUM")
        .otherwise("LOW")
    )


def spike_strength(ratio: Column) -> Column:
    return (
        F.when(ratio >= F.lit(HIGH_VOLUME_RATIO), "HIGH")
        .when(ratio >= F.lit(MEDIUM_VOLUME_RATIO), "MEDIUM")
        .otherwise("LOW")
    )


def _finite(value: Column) -> Column:
    """As double, with NaN turned into null so that it satisfies no threshold."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def _bonus(level: Column, weights: dict[str, float]) -> Column:
    value = F.lit(0.0)
    for name, weight in weights.items():
        value = F.when(level == name, F.lit(weight)).otherwise(value)
    return value


def attention_score(
    change_pct: Column, ratio: Column, strength: Column, volatility: Column
) -> Column:
    """Weighted size of move and volume ratio plus bonuses, three digits, half to even.

    Rounded the way numeric arrays are: scaled, rounded to an integer, scaled back.
    """
    move = F.coalesce(F.abs(_finite(change_pct)), F.lit(0.0))
    volume = F.coalesce(_finite(ratio), F.lit(0.0))
    bonus = _bonus(strength, SIGNAL_BONUS), _bonus(volatility, VOLATILITY_BONUS)
    score = move * F.lit(MOVE_WEIGHT) + volume + bonus[0] + bonus[1]
    return F.rint(score * 1000) / 1000


def market_direction(change_pct: Column) -> Column:
    change = _finite(change_pct)
    return (
        F.when(change.isNull() | (F.abs(change) < F.lit(FLAT_MOVE_PCT)), "FLAT")
        .when(change > 0, "UP")
        .otherwise("DOWN")
    )


def attention_reason(
    change_pct: Column, ratio: Column, strength: Column, volatility: Column
) -> Column:
    """The first reason that applies, strongest first."""
    change = F.abs(_finite(change_pct))
    volume = _finite(ratio)
    return (
        F.when((strength == "HIGH") | (volume >= F.lit(HIGH_VOLUME_RATIO)), "Volume spike")
        .when(change >= F.lit(HIGH_MOVE_PCT), "Sharp price move")
        .when(volatility == "HIGH", "High volatility")
        .when((strength == "MEDIUM") | (volume >= F.lit(MEDIUM_VOLUME_RATIO)), "Elevated volume")
        .otherwise("Normal")
    )


def freshness(latest_time: Column, now: Column) -> Column:
    """How current a table is, from the age of its newest row."""
    age_micros = F.unix_micros(now) - F.unix_micros(latest_time)
    return (
        F.when(latest_time.isNull(), "NO_DATA")
        .when(age_micros <= FRESH_SECONDS * 1_000_000, "FRESH")
        .when(age_micros <= LAGGING_SECONDS * 1_000_000, "LAGGING")
        .otherwise("STALE")
    )
