"""Tolerant casts, text forms of numbers and instants, and the ordering key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,18)"

# Number syntax accepted on the wire.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# The same, plus the names of infinity and not-a-number in any case.
DECIMAL_PATTERN = (
    r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|(?i:inf|infinity|s?nan[0-9]*))\s*$"
)
INSTANT_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?"
    r"(Z|[+-][0-9]{2}:?[0-9]{2})$"
)
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# First and last epoch millisecond whose year has four digits.
FIRST_MILLI = -62135596800000
LAST_MILLI = 253402300799999


def to_money(value: Column) -> Column:
    """Decimal with 18 fraction digits; null when the text is not such a number."""
    return value.try_cast(MONEY)


def to_instant(text: Column) -> Column:
    """Timestamp from ISO text, a trailing ``Z`` meaning UTC; null when unreadable."""
    return F.try_to_timestamp(text)


def iso_millis(instant: Column) -> Column:
    """ISO text with milliseconds and a literal ``Z``."""
    return F.date_format(instant, ISO_MILLIS)


def iso_from_millis(millis: Column) -> Column:
    """ISO text of an epoch-millisecond number; null outside years 1 to 9999."""
    return F.when(
        millis.between(FIRST_MILLI, LAST_MILLI), iso_millis(F.timestamp_millis(millis))
    )


def is_blank(text: Column) -> Column:
    """True for null and for text without a visible character."""
    return text.isNull() | ~text.rlike(r"\S")


def is_number(text: Column) -> Column:
    return text.rlike(NUMBER_PATTERN)


def is_instant_text(text: Column) -> Column:
    """ISO date and time with a zone."""
    return text.rlike(INSTANT_PATTERN) & F.try_to_timestamp(F.replace(text, F.lit(","), F.lit("."))).isNotNull()


def sealed_json(text: Column) -> Column:
    """The text parsed to VARIANT as the first element of an array sealed by its hash.

    Spark's parser stops at the end of the first value and ignores what follows. The seal
    is only found at its place when the text is one complete JSON value.
    """
    seal = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), seal, F.lit("]")))


def seal_is_whole(sealed: Column, text: Column) -> Column:
    """True when the text in ``sealed_json`` was one JSON value.

    The array is read as numbers, which takes no copy of the value, and in one go: to look for an
    element that is not there ends in an exception inside Spark for every row.
    """
    numbers = F.try_variant_get(sealed, "$", "array<bigint>")
    return (F.size(numbers) == 2) & (F.get(numbers, 1) == F.xxhash64(text))


def unsealed(sealed: Column, text: Column) -> Column:
    """The VARIANT inside ``sealed_json``, null when the text was not one JSON value."""
    return F.when(seal_is_whole(sealed, text), F.try_variant_get(sealed, "$[0]", "variant"))


def strict_json(text: Column) -> Column:
    """Text as VARIANT, null unless it is exactly one JSON value."""
    return unsealed(sealed_json(text), text)


# Significant digits of a product, and the largest exponent of decimal arithmetic.
PRODUCT_DIGITS = 28
PRODUCT_EXPONENT = 999_999
#: Digits of a limb of a long factor; the products of limbs stay far below 38 digits.
LIMB = 9


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _number_parts(text: Column) -> Column:
    """Sign, digits without leading zeros, and the power of ten of a decimal text."""

    def part(group: int) -> Column:
        return F.regexp_extract(text, r"^\s*([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?\s*$", group)

    power = F.when(part(4) == "", 0).otherwise(part(4).try_cast("int"))
    return F.struct(
        (part(1) == "-").alias("minus"), F.ltrim(F.concat(part(2), part(3)), F.lit("0")).alias("digits"),
        (power - F.length(part(3))).alias("power"),
    )


def product_text(left: Column, right: Column) -> Column:
    """Product of two decimal texts in plain notation.

    It is exact, with as many fraction digits as both factors have together; beyond 28
    significant digits it is rounded half to even, as decimal arithmetic of that precision
    does. Plain factors of up to 28 digits together, which is nearly every message, are one
    product of whole numbers; signs, exponents and more digits take the long way.
    """
    short = F.when(is_short_product(left, right), short_product(left, right))
    return short.otherwise(long_product(left, right))


def long_product(left: Column, right: Column) -> Column:
    """``product_text`` of any factors by lambda functions, which Spark interprets."""
    factors = F.struct(_number_parts(left).alias("a"), _number_parts(right).alias("b"))
    numbers = left.rlike(NUMBER_PATTERN) & right.rlike(NUMBER_PATTERN)
    return F.when(numbers, _let(_let(_let(factors, _multiplied), _rounded), _plain))


def is_short_product(left: Column, right: Column) -> Column:
    """Plain factors of few digits."""
    return _is_plain(left) & _is_plain(right) & (F.length(left) + F.length(right) <= PRODUCT_DIGITS)


def _is_plain(text: Column) -> Column:
    """Digits with at most one point among them, few enough for a whole number of 18 digits."""
    digits = F.length(F.replace(text, F.lit("."), F.lit("")))
    only = F.translate(text, "0123456789.", "") == ""
    return only & (digits > 0) & (digits >= F.length(text) - 1) & (F.length(text) <= 18)


def short_product(left: Column, right: Column) -> Column:
    """``product_text`` where ``is_short_product``; all of it is generated code."""

    def whole(text: Column) -> Column:
        return F.replace(text, F.lit("."), F.lit("")).try_cast("decimal(18,0)")

    def fraction(text: Column) -> Column:
        return F.when(F.contains(text, F.lit(".")), F.length(text) - F.instr(text, ".")).otherwise(0)

    digits, places = F.try_multiply(whole(left), whole(right)).cast("string"), fraction(left) + fraction(right)
    padded = F.lpad(digits, F.greatest(F.length(digits), places + 1), F.lit("0"))
    point = F.length(padded) - places
    text = F.concat(F.substring(padded, F.lit(1), point), F.lit("."), F.substring(padded, point + 1, places))
    return F.when(places == 0, digits).otherwise(text)


def _multiplied(factors: Column) -> Column:
    a, b = factors["a"]["digits"], factors["b"]["digits"]
    product = F.try_multiply(_whole(a), _whole(b)).cast("string")
    return F.struct(
        (factors["a"]["minus"] != factors["b"]["minus"]).alias("minus"),
        F.when(F.length(a) + F.length(b) <= 38, product).otherwise(_long_digits(a, b)).alias("digits"),
        (factors["a"]["power"] + factors["b"]["power"]).alias("power"),
    )


def _limbs(digits: Column) -> Column:
    """The number's limbs, the lowest first."""
    count = F.greatest(F.ceil(F.length(digits) / LIMB).cast("int"), F.lit(1))
    padded = F.lpad(digits, count * LIMB, F.lit("0"))
    at = F.sequence(count - 1, F.lit(0), F.lit(-1))
    return F.transform(at, lambda i: F.substring(padded, i * LIMB + 1, F.lit(LIMB)).cast("decimal(38,0)"))


def _long_digits(a: Column, b: Column) -> Column:
    """Digits of the product of two digit texts of any length: limb by limb, then the carries."""
    zero = F.lit(0).cast("decimal(38,0)")

    def column(x: Column, y: Column, k: Column) -> Column:
        pairs = F.sequence(F.greatest(k - F.size(y) + 1, F.lit(0)), F.least(k, F.size(x) - 1))
        return F.aggregate(pairs, zero, lambda s, i: (s + F.get(x, i) * F.get(y, k - i)).cast("decimal(38,0)"))

    def carried(state: Column, total: Column) -> Column:
        now = (state["carry"] + total).cast("decimal(38,0)")
        limb = F.pmod(now, F.lit(10**LIMB).cast("decimal(38,0)"))
        text = F.lpad(limb.cast("string"), LIMB, "0")
        carry = ((now - limb) / F.lit(10**LIMB).cast("decimal(10,0)")).cast("decimal(38,0)")
        return F.struct(carry.alias("carry"), F.concat(text, state["text"]).alias("text"))

    def product(factors: Column) -> Column:
        x, y = factors["x"], factors["y"]
        totals = F.transform(F.sequence(F.lit(0), F.size(x) + F.size(y) - 2), lambda k: column(x, y, k))
        start = F.struct(zero.alias("carry"), F.lit("").alias("text"))
        done = F.aggregate(totals, start, carried, lambda s: F.concat(s["carry"].cast("string"), s["text"]))
        digits = F.ltrim(done, F.lit("0"))
        return F.when(digits == "", "0").otherwise(digits)

    return _let(F.struct(_limbs(a).alias("x"), _limbs(b).alias("y")), product)


def _rounded(number: Column) -> Column:
    """At most 28 digits, half to even."""
    digits, power = number["digits"], number["power"]
    extra = F.length(digits) - PRODUCT_DIGITS
    head, tail = F.substring(digits, 1, PRODUCT_DIGITS), F.substring(digits, F.lit(PRODUCT_DIGITS + 1), F.length(digits))
    half = F.rpad(F.lit("5"), extra, F.lit("0"))
    odd = F.substring(head, -1, 1).isin("1", "3", "5", "7", "9")
    up = (tail > half) | ((tail == half) & odd)
    shorter = (_whole(head) + F.when(up, 1).otherwise(0)).cast("string")
    # Rounding up can carry into one more digit, which is then a zero.
    carried = F.length(shorter) - PRODUCT_DIGITS
    return F.struct(
        number["minus"].alias("minus"),
        F.when(extra > 0, F.substring(shorter, 1, PRODUCT_DIGITS)).otherwise(digits).alias("digits"),
        F.when(extra > 0, power + extra + carried).otherwise(power).alias("power"),
    )


def _plain(number: Column) -> Column:
    digits, power = number["digits"], number["power"]
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(1) - power), F.lit("0"))
    point = F.length(padded) + power
    fraction = F.concat(F.substring(padded, F.lit(1), point), F.lit("."), F.substring(padded, point + 1, -power))
    text = F.when(power < 0, fraction).when(digits == "0", digits).otherwise(F.rpad(digits, F.length(digits) + power, F.lit("0")))
    minus = F.when(number["minus"], "-").otherwise("")
    return F.when(F.abs(power) <= PRODUCT_EXPONENT, F.concat(minus, text))


def _whole(digits: Column) -> Column:
    return F.when(digits == "", F.lit(0).cast("decimal(38,0)")).otherwise(digits.try_cast("decimal(38,0)"))


def window_micros(width: str) -> int:
    """Length of a duration such as ``5 minutes`` in microseconds."""
    amount, unit = width.split()
    # Microseconds per unit.
    per_unit = {
        "second": 1_000_000,
        "minute": 60_000_000,
        "hour": 3_600_000_000,
        "day": 86_400_000_000,
        "week": 604_800_000_000,
    }
    return int(amount) * per_unit[unit.rstrip("s")]


def moment_key(event_time: Column, trade_id: Column) -> Column:
    """Order trades by time, then by trade id.

    One decimal: microseconds, then the id moved to the positive numbers of twenty digits. It
    is exact for any time and id, and keeps ``min_by``/``max_by`` in a hash aggregate, where a
    struct key would mean a sort.
    """
    micros = F.unix_micros(event_time).cast("decimal(18,0)")
    shifted = F.coalesce(trade_id, F.lit(0)).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(19,0)")
    return (micros * F.lit("1" + "0" * 20).cast("decimal(21,0)") + shifted).cast("decimal(38,0)")
