"""Volume of a window against the average of the windows before it."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.signals import spike_strength
from marketloom.functions.values import window_micros

_COLUMNS = ("symbol", "window_start", "window_end", "total_volume", "number_of_trades")


def _as_current() -> Column:
    return F.struct(
        F.lit(True).alias("is_current"), F.unix_micros("window_start").alias("at")
    )


def _as_history() -> Column:
    return F.struct(
        F.lit(False).alias("is_current"), F.unix_micros("window_end").alias("at")
    )


def _slice_of(micros: Column, length: int) -> Column:
    return ((micros - F.pmod(micros, F.lit(length))) / F.lit(length)).cast("bigint")


def volume_spikes(
    current: DataFrame,
    history: DataFrame | None = None,
    *,
    lookback_minutes: int = 30,
    slice_length: str = "1 day",
) -> DataFrame:
    """Windows with a baseline: mean volume of the symbol's windows that ended in
    ``[start - lookback, start)``, the ratio to it, and the strength of the spike.

    ``history`` defaults to ``current`` itself. Each side is one row per symbol and window.

    This is a range join written as a range frame: current rows sit at their start,
    history rows at their end, and the frame of a current row covers exactly the history
    it would join. A frame needs a symbol's rows in one task, so time is cut into slices
    and history near the end of a slice is repeated in the next one; a task then holds one
    symbol for one slice, however long the history or however active the symbol.
    """
    lookback = lookback_minutes * 60_000_000
    length = max(window_micros(slice_length), lookback)
    if history is None:
        sides = current.select(*_COLUMNS, F.explode(F.array(_as_current(), _as_history())).alias("side"))
    else:
        earlier = history.select(
            "symbol",
            "window_start",
            "window_end",
            "total_volume",
            F.lit(None).cast("bigint").alias("number_of_trades"),
            _as_history().alias("side"),
        )
        sides = current.select(*_COLUMNS, _as_current().alias("side")).unionByName(earlier)

    at, is_current = F.col("side.at"), F.col("side.is_current")
    reach = F.when(is_current, at).otherwise(at + F.lit(lookback))
    slices = F.sequence(_slice_of(at, length), _slice_of(reach, length))
    placed = sides.where(F.col("symbol").isNotNull() & at.isNotNull()).select(
        *_COLUMNS, is_current.alias("is_current"), at.alias("at"), F.explode(slices).alias("slice")
    )

    before = Window.partitionBy("symbol", "slice").orderBy("at").rangeBetween(-lookback, -1)
    past_volume = F.when(~F.col("is_current"), F.col("total_volume"))
    based = placed.withColumn("baseline_volume", F.try_avg(past_volume).over(before)).where(
        F.col("is_current") & (F.col("baseline_volume") > 0)
    )
    rated = based.withColumn(
        "volume_spike_ratio", F.try_divide("total_volume", "baseline_volume")
    )
    return rated.select(
        "symbol",
        "window_start",
        "window_end",
        F.col("total_volume").alias("current_volume"),
        "baseline_volume",
        "volume_spike_ratio",
        spike_strength(F.col("volume_spike_ratio")).alias("signal_strength"),
        "number_of_trades",
    )


def history_for(batch: DataFrame, summary: DataFrame, lookback_minutes: int) -> DataFrame:
    """The part of ``summary`` that can be a baseline for ``batch``.

    One small aggregate over the batch gives two time bounds; they are passed as literals, as
    days too if the table is partitioned by ``window_date``, so that only the folders of those
    days are listed and only their newest files read.
    """
    bounds = batch.agg(
        F.min("window_start").alias("first"), F.max("window_start").alias("last")
    ).first()
    if bounds["first"] is None:
        return summary.limit(0)
    first = bounds["first"] - timedelta(minutes=lookback_minutes)
    if "window_date" in summary.columns:
        # A day more on either side, so that no zone of the driver matters.
        days = (first - timedelta(days=1)).date(), (bounds["last"] + timedelta(days=1)).date()
        summary = summary.where(F.col("window_date").between(F.lit(days[0]), F.lit(days[1])))
    earliest = F.lit(bounds["first"]) - F.make_dt_interval(mins=F.lit(lookback_minutes))
    return summary.where(
        (F.col("window_end") >= earliest) & (F.col("window_end") < F.lit(bounds["last"]))
    )
