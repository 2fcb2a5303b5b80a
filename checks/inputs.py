"""The given tables in the shapes the operators expect.

``events`` serves as the market feed: the event type is the symbol, the value the price,
``props.k`` the quantity. Messages carry the faults a feed can have; which fault an event
has follows from its ``k``, so both engines agree on it without exchanging data.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.config import Feed
from marketloom.functions.values import MONEY
from marketloom.operators.normalize import normalize
from marketloom.operators.deadletter import route
from marketloom.operators.rows import computed_once

FEED = Feed()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to all cores, before steps that cost far more than the scan.

    A Parquet row group is one task however many rows it has, and a file may have only one.
    """
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that all executors can reach.

    A cluster names its shared folder in ``spark.checkpoint.dir``; only a local session
    without that setting uses a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="marketloom-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def feed_events(events: DataFrame) -> DataFrame:
    """Events with price, k and instant, plus the kind of message each becomes."""
    kind = (
        F.when(F.col("event_type") == "view", "kline")
        .when(F.col("event_type") == "signup", "ticker")
        .otherwise("trade")
    )
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("at"),
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("price"),
        _k().alias("k"),
        kind.alias("kind"),
    )


def typed_trades(events: DataFrame) -> DataFrame:
    """All events as typed trades, before the quality filter."""
    price = F.col("value").cast("decimal(18,2)").cast(MONEY)
    quantity = _k().cast(MONEY)
    return events.select(
        F.upper("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("trade_id"),
        price.alias("price"),
        quantity.alias("quantity"),
        F.try_multiply(price, quantity).try_cast(MONEY).alias("trade_value"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_market_maker"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with positive price and quantity."""
    rows = typed_trades(table(spark, sf_dir, "events"))
    return rows.where((F.col("price") > 0) & (F.col("quantity") > 0))


def _text(value: Column) -> Column:
    return value.cast("string")


def vendor_messages(events: DataFrame) -> DataFrame:
    """``event_id, at, value``: one vendor message per event, some of them faulty."""
    rows = feed_events(spread(events))
    k, price = F.col("k"), F.col("price")
    # The fault of a message by its k. 1 cut-off JSON, 2 an array, 3 unknown
    # type, 4 missing quantity, 5 price not numeric, 6 blank symbol, 7 negative quantity,
    # 8 id not a number, 9 flag not a boolean, 10 no envelope, 11 null payload, 12 time out
    # of range; k = 0 is a zero quantity by nature.
    minute = F.unix_millis("at") - F.unix_millis("at") % 60000
    parts = {
        "symbol": F.when(k == 6, "  ").otherwise(F.col("event_type")),
        "millis": F.when(k == 12, 99999999999999999).otherwise(F.unix_millis("at")),
        "minute": minute,
        "first_price": F.when(k == 5, "n/a").otherwise(_text(price)),
        "quantity": F.when(k == 7, "-7").when(k != 4, _text(k)),
        "flag": F.when(k == 9, '"yes"').otherwise((F.col("user_id") % 2 == 0).cast("string")),
        "high": _text(price + k),
        "low": _text(F.greatest(price - 1, F.lit(0).cast("decimal(18,2)"))),
        "amount": _text((price * k).cast("decimal(18,2)")),
    }
    carried = ["event_id", "at", "user_id", "event_type", "price", "k", "kind"]
    # A step for the parts and for each kind keeps the generated methods small enough for the JIT.
    rows = computed_once(rows, F.struct(*(value.alias(f"_{name}") for name, value in parts.items())), *carried)
    carried += [f"_{name}" for name in parts]
    symbol, millis, minute, first_price, quantity, flag, high, low, value = (F.col(f"_{name}") for name in parts)
    kind_name = F.when(k == 3, "aggTrade")

    def count(good: Column) -> Column:
        return F.when(k == 8, '"x1"').otherwise(_text(good))

    def spliced(record: Column, **raw: Column) -> Column:
        """JSON of ``record`` with some more properties given as JSON text."""
        extra = [F.concat(F.lit(f',"{name}":'), text) for name, text in raw.items()]
        return F.concat(F.regexp_replace(F.to_json(record), r"\}$", ""), *extra, F.lit("}"))

    trade = spliced(
        F.struct(
            F.coalesce(kind_name, F.lit("trade")).alias("e"), millis.alias("E"), symbol.alias("s"),
            first_price.alias("p"), quantity.alias("q"),
        ),
        t=count(F.col("event_id")),
        m=flag,
    )
    bar = spliced(
        F.struct(
            minute.alias("t"), (minute + 59999).alias("T"), F.lit("1m").alias("i"),
            first_price.alias("o"), high.alias("h"), low.alias("l"), _text(price).alias("c"),
            quantity.alias("v"), value.alias("q"), _text(k).alias("V"), _text(price).alias("Q"),
        ),
        n=count(F.col("user_id")),
        x=flag,
    )
    kline = spliced(
        F.struct(
            F.coalesce(kind_name, F.lit("kline")).alias("e"), millis.alias("E"), symbol.alias("s")
        ),
        k=F.col("_bar"),
    )
    ticker = spliced(
        F.struct(
            F.coalesce(kind_name, F.lit("24hrTicker")).alias("e"), millis.alias("E"),
            symbol.alias("s"), _text((price - 50).cast("decimal(18,2)")).alias("p"),
            _text(k - 50).alias("P"), _text(price).alias("w"), first_price.alias("c"),
            _text(k).alias("Q"), _text(price).alias("o"), high.alias("h"), low.alias("l"),
            quantity.alias("v"), value.alias("q"), (F.unix_millis("at") - 86400000).alias("O"),
            F.unix_millis("at").alias("C"), F.col("event_id").alias("F"),
            (F.col("event_id") + k).alias("L"),
        ),
        n=count(k),
    )
    for kind, name, text in (("kline", "_bar", bar), ("kline", "_kline", kline), ("ticker", "_ticker", ticker), ("trade", "_trade", trade)):
        made = F.when(F.col("kind") == kind, text)
        rows = computed_once(rows, F.struct(made.alias(name)), *carried)
        carried.append(name)
    data = F.coalesce("_kline", "_ticker", "_trade")
    head = F.concat(F.lit('{"stream":"'), F.col("event_type"), F.lit("@"), F.col("kind"), F.lit('",'))
    message = (
        F.when(k == 1, F.concat(head, F.lit('"data":{"e":')))
        .when(k == 2, F.concat(F.lit("["), data, F.lit("]")))
        .when(k == 10, data)
        .when(k == 11, F.concat(head, F.lit('"data":null}')))
        .otherwise(F.concat(head, F.lit('"data":'), data, F.lit("}")))
    )
    return computed_once(rows, F.struct(message.alias("value")), "event_id", "at")


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor messages through the normaliser."""
    messages = vendor_messages(table(spark, sf_dir, "events"))
    return normalize(messages, FEED, keep=("event_id", "at"))


def bus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages as bus records: valid ones on their topic, the rest on the invalid one."""
    messages = vendor_messages(table(spark, sf_dir, "events"))
    routed = normalize(messages, FEED, keep=("event_id", "at"))
    return _positioned(route(routed, FEED, keep=("event_id", "at")))


def _positioned(records: DataFrame) -> DataFrame:
    return records.select(
        "topic",
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("at").alias("timestamp"),
    )


def plain_events(events: DataFrame) -> DataFrame:
    """``event_id, kind, value``: normalised JSON with faults of its own, for the validators."""
    rows = feed_events(spread(events))
    k, price = F.col("k"), F.col("price")
    # 1 no symbol, 2 no time, 3 time without zone, 4 no id, 5 price not
    # numeric, 6 blank quantity, 7 negative quantity, 8 unknown type, 9 no type.
    at = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    time = F.when(k == 3, at).when(k != 2, F.concat(at, F.lit("Z")))
    amount = F.when(k == 5, "n/a").otherwise(_text(price))
    size = F.when(k == 6, " ").when(k == 7, "-7").otherwise(_text(k))
    record = F.struct(
        F.when(k == 8, "book_ticker").when(k != 9, F.col("kind")).alias("event_type"),
        F.when(k != 1, F.upper("event_type")).alias("symbol"),
        time.alias("event_time"),
        time.alias("kline_start_time"),
        F.when(k != 4, F.col("event_id")).alias("trade_id"),
        amount.alias("price"),
        amount.alias("open_price"),
        _text(price).alias("high_price"),
        _text(price).alias("low_price"),
        _text(price).alias("close_price"),
        amount.alias("last_price"),
        size.alias("quantity"),
        size.alias("volume"),
    )
    return rows.select("event_id", "kind", F.to_json(record).alias("value"))
