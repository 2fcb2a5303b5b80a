"""Checks of JSON events against their published contracts, which are JSON-Schema files.

A contract is compiled to columns once, and a mixed feed is checked in one pass: each event is
parsed once and meets the rules of the contract that its row names.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.jsonschema import Closed, Node, Property, broken_rule, compiled, node_at
from marketloom.functions.values import to_money
from marketloom.operators.rows import computed_once, with_json

#: Where the library's own contract files are.
FILES = Path(__file__).resolve().parent.parent / "contracts"
#: Rules of a contract that one step of a plan checks.
STEP = 3
Rule = Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Contract:
    """A contract's name and the compiled rules of its file.

    ``extra_rules`` are documented but not enforced upstream, so they are off by default.
    """

    name: str
    rules: tuple[Property | Closed, ...]
    extra_rules: tuple[tuple[str, Rule], ...] = field(default=())

    @property
    def properties(self) -> tuple[Property, ...]:
        return tuple(rule for rule in self.rules if isinstance(rule, Property))


def contract_of(
    name: str, document: Mapping, read: Callable[[str], Mapping] = {}.__getitem__, extra_rules: Sequence[tuple[str, Rule]] = ()
) -> Contract:
    """The contract of a JSON-Schema document; ``read`` gives the files that it refers to."""
    return Contract(name, tuple(compiled(document, read)), tuple(extra_rules))


def read_contract(spark: SparkSession, path: str, extra_rules: Sequence[tuple[str, Rule]] = ()) -> Contract:
    """A contract file on any file system that Spark reads, named after the file."""

    def document(file: str) -> Mapping:
        return json.loads(spark.read.text(file, wholetext=True).first()["value"])

    folder, name = posixpath.split(path)
    return contract_of(name.removesuffix(".json"), document(path), lambda file: document(f"{folder}/{file}"), extra_rules)


@cache
def _packaged(file: str) -> Mapping:
    return json.loads((FILES / file).read_text(encoding="utf-8"))


def packaged_contract(name: str, *extra_rules: tuple[str, Rule]) -> Contract:
    return contract_of(name, _packaged(f"{name}.json"), _packaged, extra_rules)


def _high_not_below_low(get: Callable[[str], Column]) -> Column:
    return to_money(get("high_price")) >= to_money(get("low_price"))


def _value_is_product(get: Callable[[str], Column]) -> Column:
    product = F.try_multiply(to_money(get("price")), to_money(get("quantity")))
    return F.round(to_money(get("trade_value")), 6) == product


_NOT_CROSSED = ("high_price is not below low_price", _high_not_below_low)
TRADE_CONTRACT = packaged_contract("trade_event_v1", ("trade_value equals price times quantity", _value_is_product))
KLINE_CONTRACT = packaged_contract("kline_event_v1", _NOT_CROSSED)
TICKER_CONTRACT = packaged_contract("ticker_event_v1", _NOT_CROSSED)
INVALID_CONTRACT = packaged_contract("invalid_event_v1")
ALERT_CONTRACT = packaged_contract("alert_event_v1")
CONTRACTS = (TRADE_CONTRACT, KLINE_CONTRACT, TICKER_CONTRACT, INVALID_CONTRACT, ALERT_CONTRACT)


def contract_name(event_type: Column, failed: Column | None = None) -> Column:
    """The contract of an event of this type, or of a dead letter where ``failed`` holds."""
    name = F.concat(event_type, F.lit("_event_v1"))
    return name if failed is None else F.when(failed, INVALID_CONTRACT.name).otherwise(name)


def _node_name(at: int, part: str) -> str:
    return f"_{part}{at}"


def _read(rules: Sequence[Property | Closed], mine: Column) -> list[Column]:
    """JSON type and text of the properties, read once for all rules of each."""
    found = []
    for at, rule in enumerate(rules):
        if isinstance(rule, Property):
            node = node_at(F.col("_event"), rule.path)
            found.append(F.when(mine, node.kind).alias(_node_name(at, "kind")))
            found.append(F.when(mine, node.text).alias(_node_name(at, "text")))
    return found


def _checks(contract: Contract, rules: Sequence[Property | Closed]) -> list[Column]:
    """A column per rule: its text where the event ``_event`` breaks it, else null."""
    event, keys, checks = F.col("_event"), F.col("_keys"), []
    for at, rule in enumerate(rules):
        kind, text = F.col(_node_name(at, "kind")), F.col(_node_name(at, "text"))
        node = Node(kind, kind, text) if isinstance(rule, Property) else None
        checks.append(broken_rule(rule, event, keys, contract.name, node))
    return checks


def _extra_checks(contract: Contract) -> list[Column]:
    """The same for the contract's rules that are not enforced upstream."""
    get = lambda name: F.try_variant_get("_event", f"$.{name}", "string")
    return [F.when(~holds(get), f"{contract.name}: {text}") for text, holds in contract.extra_rules]


def _with_lines(rows: DataFrame, mine: Column, checks: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """``_lines`` with what the checks found in the rows of one contract."""
    more = F.concat_ws("\n", F.nullif("_lines", F.lit("")), *checks)
    return computed_once(rows, F.struct(F.when(mine, more).otherwise(F.col("_lines")).alias("_lines")), *keep)


def feed_violations(
    events: DataFrame, contracts: Sequence[Contract] = CONTRACTS, value: str = "value", contract: str = "contract", *,
    extra_rules: bool = False,
) -> DataFrame:
    """Add ``violations``, the broken rules of a JSON event as ``name: rule`` texts.

    Each row names its contract in the column ``contract``; one that is not known breaks
    ``event: contract`` only, and text that is not a JSON object ``event: type`` only. A property
    reports the first rule it breaks. Null texts and null names count as not known.
    """
    columns = events.columns
    rows = with_json(events, value, "_event", *columns)
    # Names alone come from the text: as a map of VARIANT every value would be converted.
    keys = F.when(F.col("_event").isNotNull(), F.json_object_keys(F.col(f"`{value}`")))
    rows = computed_once(rows, F.struct(keys.alias("_keys")), *columns, "_event")
    known = F.coalesce(F.col(f"`{contract}`").isin(*[one.name for one in contracts]), F.lit(False))
    lines = F.when(~known, "event: contract").when(F.col("_keys").isNull(), "event: type").otherwise("")
    carried = [*columns, "_event", "_keys"]
    rows = computed_once(rows, F.struct(lines.alias("_lines")), *carried)
    # Few rules a step keep the generated methods small enough for the JIT; a row computes
    # those of its own contract only.
    for one in contracts:
        mine = F.col("_keys").isNotNull() & (F.col(f"`{contract}`") == one.name)
        for low in range(0, len(one.rules), STEP):
            rules = one.rules[low : low + STEP]
            read = _read(rules, mine)
            if read:
                rows = computed_once(rows, F.struct(*read), *carried, "_lines")
            rows = _with_lines(rows, mine, _checks(one, rules), carried)
        if extra_rules and one.extra_rules:
            rows = _with_lines(rows, mine, _extra_checks(one), carried)
    violations = F.when(F.col("_lines") == "", F.array().cast("array<string>")).otherwise(F.split("_lines", "\n"))
    return rows.select(*columns, violations.alias("violations"))


def feed_report(
    events: DataFrame, contracts: Sequence[Contract] = CONTRACTS, value: str = "value", contract: str = "contract", *,
    extra_rules: bool = False,
) -> DataFrame:
    """Number of events per contract and broken rule, in one pass; rules nobody breaks are not listed."""
    rows = events.select(F.col(f"`{value}`").alias("value"), F.col(f"`{contract}`").alias("contract"))
    broken = feed_violations(rows, contracts, extra_rules=extra_rules)
    return (
        broken.select("contract", F.explode("violations").alias("rule"))
        .groupBy("contract", "rule")
        .agg(F.count("*").alias("violations"))
    )


def contract_violations(
    events: DataFrame, contract: Contract, value: str = "value", *, extra_rules: bool = False
) -> DataFrame:
    """``feed_violations`` of events that all have one contract."""
    named = events.withColumn("_contract", F.lit(contract.name))
    return feed_violations(named, [contract], value, "_contract", extra_rules=extra_rules).drop("_contract")


def contract_report(
    events: DataFrame, contract: Contract, value: str = "value", *, extra_rules: bool = False
) -> DataFrame:
    """``feed_report`` of events that all have one contract."""
    named = events.select(F.col(f"`{value}`").alias("value"), F.lit(contract.name).alias("contract"))
    return feed_report(named, [contract], extra_rules=extra_rules)


def unsupported_symbols(events: DataFrame, symbols: tuple[str, ...]) -> DataFrame:
    """Events whose symbol is not on the configured list (documented, not enforced)."""
    return events.where(F.col("symbol").isNull() | ~F.col("symbol").isin(*symbols))
