"""Names, paths and limits, with the defaults of the deployed pipeline."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Feed:
    """What is stamped on normalised events, and the topics they go to."""

    schema_version: str = "1.0"
    source: str = "binance"
    trades_topic: str = "market.trades.raw"
    klines_topic: str = "market.klines.raw"
    tickers_topic: str = "market.tickers.raw"
    invalid_topic: str = "market.events.invalid"
    alerts_topic: str = "market.signals.alerts"

    @property
    def topics(self) -> tuple[str, ...]:
        """Topics the raw layer captures, market events first."""
        return (self.trades_topic, self.klines_topic, self.tickers_topic, self.invalid_topic)


# Table names shared by every layer and by stored deployments.
BRONZE_TRADES = "bronze_market_trades_raw"
BRONZE_KLINES = "bronze_market_klines_raw"
BRONZE_TICKERS = "bronze_market_tickers_raw"
BRONZE_INVALID = "bronze_market_invalid_events"
SILVER_TRADES = "silver_market_trades"
SILVER_KLINES = "silver_market_klines"
SILVER_TICKERS = "silver_market_tickers"
SILVER_KEYED_TRADES = "silver_market_trades_keyed"
GOLD_OHLC = "gold_symbol_1min_ohlc"
GOLD_SUMMARY = "gold_symbol_5min_trade_summary"
GOLD_VOLATILITY = "gold_symbol_5min_volatility"
GOLD_SPIKES = "gold_volume_spike_signals"
GOLD_PRICE_ALERTS = "gold_price_movement_alerts"
GOLD_WATCHLIST = "gold_market_watchlist_summary"

GOLD_TABLES = (
    GOLD_OHLC,
    GOLD_SUMMARY,
    GOLD_VOLATILITY,
    GOLD_SPIKES,
    GOLD_PRICE_ALERTS,
    GOLD_WATCHLIST,
)

# Own tables: every raw topic in one partitioned table, and the shared window measures
# that the four five-minute tables are cut from.
BRONZE_ALL = "bronze_market_raw_all"
GOLD_WINDOW_MEASURES = "gold_symbol_5min_measures"


def _below(root: str, variable: str, name: str) -> str:
    if not root:
        raise ValueError(f"set {variable} to a folder that every executor can reach")
    return f"{root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Settings:
    """Where tables and checkpoints live, and how streams are paced.

    Folders have no default: one that is relative or local would be another on each executor.
    """

    bronze_path: str = ""
    silver_path: str = ""
    gold_path: str = ""
    checkpoint_path: str = ""
    table_format: str = "parquet"
    bus_format: str = "kafka"
    bus_options: Mapping[str, str] = field(default_factory=dict)
    starting_offsets: str = "latest"
    fail_on_data_loss: str = "false"
    max_offsets_per_trigger: str | None = None
    silver_watermark: str = "10 minutes"
    #: Days between a trade and the latest copy of it that the keyed table looks for.
    copy_reach_days: int = 1
    gold_watermark: str = "10 minutes"
    #: Tasks, and so files, that write one day of a typed or metric table in a batch at most.
    files_per_day: int = 4
    max_files_per_trigger: str | None = None
    trigger_interval: str | None = None
    available_now: bool = False
    baseline_lookback_minutes: int = 30
    feed: Feed = Feed()

    def bronze(self, table: str) -> str:
        return _below(self.bronze_path, "BRONZE_PATH", table)

    def silver(self, table: str) -> str:
        return _below(self.silver_path, "SILVER_PATH", table)

    def gold(self, table: str) -> str:
        return _below(self.gold_path, "GOLD_PATH", table)

    def checkpoint(self, query: str) -> str:
        return _below(self.checkpoint_path, "CHECKPOINT_ROOT", query)

    @classmethod
    def from_env(cls, env: Mapping[str, str], layer: str = "") -> "Settings":
        """Settings from environment variables; ``layer`` picks the pacing variables."""
        prefix = layer.upper()
        feed = Feed(
            schema_version=env.get("PRODUCER_SCHEMA_VERSION", "1.0"),
            source=env.get("PRODUCER_SOURCE", "binance"),
            trades_topic=env.get("TOPIC_TRADES_RAW", "market.trades.raw"),
            klines_topic=env.get("TOPIC_KLINES_RAW", "market.klines.raw"),
            tickers_topic=env.get("TOPIC_TICKERS_RAW", "market.tickers.raw"),
            invalid_topic=env.get("TOPIC_EVENTS_INVALID", "market.events.invalid"),
            alerts_topic=env.get("TOPIC_SIGNALS_ALERTS", "market.signals.alerts"),
        )
        servers = env.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
        return cls(
            bronze_path=env.get("BRONZE_PATH", ""),
            silver_path=env.get("SILVER_PATH", ""),
            gold_path=env.get("GOLD_PATH", ""),
            checkpoint_path=env.get("CHECKPOINT_ROOT", ""),
            table_format=env.get("TABLE_FORMAT", "parquet"),
            bus_options={"kafka.bootstrap.servers": servers},
            starting_offsets=env.get("BRONZE_STARTING_OFFSETS", "latest"),
            fail_on_data_loss=env.get("BRONZE_FAIL_ON_DATA_LOSS", "false"),
            max_offsets_per_trigger=env.get("BRONZE_MAX_OFFSETS_PER_TRIGGER"),
            silver_watermark=env.get("SILVER_WATERMARK_DELAY", "10 minutes"),
            copy_reach_days=int(env.get("SILVER_COPY_REACH_DAYS", "1")),
            gold_watermark=env.get("GOLD_WATERMARK_DELAY", "10 minutes"),
            files_per_day=int(env.get("FILES_PER_DAY", "4")),
            max_files_per_trigger=env.get(f"{prefix}_MAX_FILES_PER_TRIGGER"),
            trigger_interval=env.get(f"{prefix}_TRIGGER_PROCESSING_TIME"),
            baseline_lookback_minutes=int(env.get("GOLD_VOLUME_BASELINE_LOOKBACK_MINUTES", "30")),
            feed=feed,
        )
