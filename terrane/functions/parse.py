"""Prices, areas and dates from text, one function for each way in which sources write them.

All are column expressions. A text that a variant cannot read gives null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrane.functions.text import fold, squeeze

BILLION, MILLION, THOUSAND = 1_000_000_000, 1_000_000, 1_000
LARGEST_LONG = 9223372036854775807
#: The first number with a decimal sign or without one.
_NUMBER = r"[-+]?\d*[.,]\d+|\d+"
_PLAIN = r"\d+(?:[.,]\d+)?"


def _first(x: Column, pattern: str) -> Column:
    return F.replace(F.nullif(F.regexp_extract(x, pattern, 0), F.lit("")), F.lit(","), F.lit("."))


def _unit(p: Column, *marks: tuple[tuple[str, ...], int]) -> Column:
    """The factor of the first group of marks of which one stands anywhere in the text; null if none does."""
    out = None
    for texts, factor in marks:
        hit = F.lit(False)
        for t in texts:
            hit = hit | p.contains(t)
        out = F.when(hit, F.lit(float(factor))) if out is None else out.when(hit, F.lit(float(factor)))
    return out


_ACCENTED = ((("tỷ",), BILLION), (("triệu",), MILLION), (("ngàn", "nghìn"), THOUSAND))
_BARE = ((("ty",), BILLION), (("trieu",), MILLION), (("nghin", "ngan"), THOUSAND))


def price_unit_needed(x: Column) -> Column:
    """First number by the first unit; null without a unit. In doubles, cut to a whole number."""
    p = F.lower(x)
    factor = _unit(p, *_ACCENTED, (("đ", "vnd"), 1))
    return (_first(p, _NUMBER).try_cast("double") * factor).cast("long")


def price_unit_optional(x: Column) -> Column:
    """As `price_unit_needed`, but a missing unit counts as one, and a price to be agreed on is 0."""
    p = F.lower(x)
    value = (_first(p, _NUMBER).try_cast("double") * F.coalesce(_unit(p, *_ACCENTED), F.lit(1.0))).cast("long")
    return F.when(p.contains("thỏa thuận"), F.lit(0).cast("long")).otherwise(value)


def price_plain_or_unit(x: Column, comma: bool = True) -> Column:
    """A double: the text itself if it is a number, else its first run of digits and dots by the unit. A price to be
    agreed on is null. `comma`: commas are decimal signs; without it they end a number."""
    p = F.trim(F.lower(x))
    p = F.replace(p, F.lit(","), F.lit(".")) if comma else p
    run = F.nullif(F.regexp_extract(p, r"[0-9.]+", 0), F.lit("")).try_cast("double")
    value = F.when(p.rlike(r"^[0-9]+(\.[0-9]+)?$"), p.try_cast("double")).otherwise(run * F.coalesce(_unit(p, *_ACCENTED), F.lit(1.0)))
    value = F.when(p.contains("thương lượng") | p.contains("thỏa thuận"), None).otherwise(value)
    return F.when(value <= float(LARGEST_LONG), value) if comma else value


def _decimal(x: Column, factor: int) -> Column:
    return x.try_cast("decimal(24,6)") * F.lit(factor)


def price_folded(x: Column) -> Column:
    """First number by the unit, read without accents and in decimals; null without a unit."""
    p = squeeze(F.lower(fold(x)))
    first = _first(p, _PLAIN)
    out = F.when(p.contains("ty"), _decimal(first, BILLION)).when(p.contains("trieu"), _decimal(first, MILLION))
    return F.floor(out.when(p.contains("nghin") | p.contains("ngan"), _decimal(first, THOUSAND))).cast("long")


def price_compound(x: Column) -> Column:
    """As `price_folded`, but billions and the millions after them are summed."""
    p = squeeze(F.lower(fold(x)))
    at = F.instr(p, "ty")
    left, right = F.substring(p, F.lit(1), at - 1), F.substring(p, at + 2, F.char_length(p))
    high = _decimal(_first(left, _PLAIN), BILLION)
    low = F.when(right.contains("trieu"), _decimal(_first(right, _PLAIN), MILLION))
    both = F.when(high.isNotNull() | low.isNotNull(), F.coalesce(high, F.lit(0)) + F.coalesce(low, F.lit(0)))
    one = F.when(p.contains("trieu"), _decimal(_first(p, _PLAIN), MILLION)).when(p.contains("nghin") | p.contains("ngan"), _decimal(_first(p, _PLAIN), THOUSAND))
    return F.floor(F.when(at > 0, both).otherwise(one)).cast("long")


def price_two_units(x: Column) -> Column:
    """Billions and millions, or millions and thousands, each number with two decimals; a unit without its number
    makes the whole null."""
    two = lambda y, n: F.round(_first(y, r"[0-9]+([.,][0-9]+)?").try_cast("decimal(24,6)"), 2).cast("decimal(15,2)") * F.lit(n)
    after = lambda mark: F.substring_index(x, mark, -1)
    high = two(x, BILLION) + F.when(x.contains("triệu"), two(after("tỷ"), MILLION)).otherwise(F.lit(0))
    low = two(x, MILLION) + F.when(x.rlike("nghìn|ngàn"), two(after("triệu"), THOUSAND)).otherwise(F.lit(0))
    return F.when(x.contains("tỷ"), high).when(x.contains("triệu"), low)


def price_residue(x: Column, before: Column) -> Column:
    """As `price_two_units`, but a second unit without its number counts as none, and a text without a unit leaves the
    price that was there before."""
    two = lambda y, n: F.round(_first(y, r"[0-9]+([.,][0-9]+)?").try_cast("decimal(24,6)"), 2).cast("decimal(15,2)") * F.lit(n)
    rest = lambda mark, n: F.coalesce(two(F.substring_index(x, mark, -1), n), F.lit(0))
    high = two(x, BILLION) + F.when(x.contains("triệu"), rest("tỷ", MILLION)).otherwise(F.lit(0))
    low = two(x, MILLION) + F.when(x.rlike("nghìn|ngàn"), rest("triệu", THOUSAND)).otherwise(F.lit(0))
    return F.when(x.contains("tỷ"), high).when(x.contains("triệu"), low).otherwise(before)


def price_short_units(x: Column) -> Column:
    """Blanks removed; short units allowed; a missing unit counts as one; two decimals; null unless positive."""
    p = F.regexp_replace(F.lower(x), "[\\s\\u00a0]", "")
    p = F.replace(p, F.lit(","), F.lit("."))
    factor = F.when(p.contains("ty") | p.contains("tỷ"), BILLION).when(p.contains("trieu") | p.contains("triệu") | p.contains("tr"), MILLION)
    factor = factor.when(p.contains("nghin") | p.contains("nghìn") | p.contains("ngan") | p.contains("k"), THOUSAND).otherwise(1)
    value = F.bround(F.nullif(F.regexp_extract(p, r"\d+(?:\.\d+)?", 0), F.lit("")).try_cast("decimal(24,6)") * factor, 2)
    return F.when((value > 0) & (value <= F.lit("999999999999999999.99").cast("decimal(20,2)")), value)


def price_digits(x: Column) -> Column:
    return F.when(x.rlike("^[0-9]+$"), x.try_cast("long"))


def price_stripped(x: Column) -> Column:
    """What is left of the text without all but digits and dots, as a double."""
    return F.nullif(F.regexp_replace(x, "[^0-9.]", ""), F.lit("")).try_cast("double")


PRICES: dict[str, Callable[[Column], Column]] = {
    "unit_needed": price_unit_needed,
    "unit_optional": price_unit_optional,
    "plain_or_unit": price_plain_or_unit,
    "plain_or_unit_dots": lambda x: price_plain_or_unit(x, comma=False),
    "folded": price_folded,
    "compound": price_compound,
    "two_units": price_two_units,
    "short_units": price_short_units,
    "digits": price_digits,
    "stripped": price_stripped,
}


def _positive(x: Column) -> Column:
    return F.when(x > 0, x)


def area_first_number(x: Column) -> Column:
    return _positive(_first(F.lower(x), _NUMBER).try_cast("double"))


def bound(x: Column, of: Callable[[Column], Column]) -> Column:
    """`of(x)`, with x computed once. A projection that holds one is compiled in several methods, by itself; otherwise Spark
    fuses it with its neighbours in one method, which the JVM interprets if the expressions are long."""
    return F.get(F.transform(F.array(x), of), 0)


def _signed(first_parts: Callable[[Column], Column], kind: str) -> Callable[[Column], Column]:
    """A number of groups and decimals: with both signs the one that `first_parts` denies is the decimal sign; one sign
    alone that parts groups of three is not."""

    def of(t: Column) -> Column:
        dots, commas = F.replace(t, F.lit("."), F.lit("")), F.replace(t, F.lit(","), F.lit(""))
        decimal = F.replace(t, F.lit(","), F.lit("."))
        value = (
            F.when(t.contains(".") & t.contains(","), F.when(first_parts(t), F.replace(dots, F.lit(","), F.lit("."))).otherwise(commas))
            .when(t.contains("."), F.when(t.rlike(r"^\d{1,3}(\.\d{3})+$"), dots).otherwise(t))
            .when(t.contains(","), F.when(t.rlike(r"^\d{1,3}(,\d{3})+$"), commas).otherwise(decimal))
            .otherwise(t)
        )
        return value.try_cast(kind)

    return of


def area_last_sign(x: Column) -> Column:
    """The last of dot and comma is the decimal sign if both stand there; one alone that parts groups of three is not."""
    y = F.regexp_replace(F.lower(x), "m²|m2|㎡", "")
    t = F.nullif(F.regexp_extract(y, r"[-+]?\d[\d.,]*", 0), F.lit(""))
    last_comma = lambda t: F.char_length(F.substring_index(t, ",", -1)) < F.char_length(F.substring_index(t, ".", -1))
    return bound(bound(t, _signed(last_comma, "double")), _positive)


def area_first_sign(x: Column) -> Column:
    """As `area_last_sign`, but the sign that stands first parts groups; blanks within the number are dropped; zero is kept."""
    t = F.nullif(F.regexp_replace(F.regexp_extract(x, r"\d[\d\s.,]*", 0), r"\s+", ""), F.lit(""))
    return bound(t, _signed(lambda t: F.instr(t, ".") < F.instr(t, ","), "decimal(24,6)"))


def area_sides(x: Column) -> Column:
    """Struct (width, length) of an area text such as "80 m2 (4,5x18)", with two decimals; null without such sides."""
    side = r"\(\s*([0-9]+(?:[.,][0-9]+)?)\s*[xX]\s*([0-9]+(?:[.,][0-9]+)?)\s*\)"
    number = lambda i: F.round(F.replace(F.nullif(F.regexp_extract(x, side, i), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(24,6)"), 2).try_cast("decimal(10,2)")
    return F.when(x.rlike(side), F.struct(number(1).alias("width"), number(2).alias("length")))


def area_strict(x: Column, scale: int = 2) -> Column:
    """A number with one decimal sign and nothing else, of `scale` decimals, positive."""
    y = F.replace(F.trim(x), F.lit(","), F.lit("."))
    return _positive(F.when(y.rlike(r"^[0-9]+(\.[0-9]+)?$"), F.round(y.try_cast("decimal(28,8)"), scale)))


def area_short(x: Column) -> Column:
    """The first number if it has at most eight characters, with two decimals."""
    n = _first(x, r"[0-9]+([.,][0-9]+)?")
    return F.when(F.char_length(n) <= 8, F.round(n.try_cast("decimal(24,6)"), 2))


AREAS: dict[str, Callable[[Column], Column]] = {
    "first_number": area_first_number,
    "last_sign": area_last_sign,
    "first_sign": area_first_sign,
    "strict": area_strict,
    "strict4": lambda x: area_strict(x, 4),
    "short": area_short,
}


def any_date(x: Column) -> Column:
    """A timestamp from ISO dates with or without a time, and dates of day, month and year."""
    y = F.trim(x)
    # A form is tried only where its signs stand in the text, as each failure costs much.
    dash, slash, colon, third = y.contains("-"), y.contains("/"), y.contains(":"), F.substring(y, 3, 1) == "-"
    forms = ((dash & colon, "yyyy-MM-dd HH:mm:ss"), (dash & ~colon & ~third, "yyyy-MM-dd"), (slash, "dd/MM/yyyy"), (dash & third, "dd-MM-yyyy"))
    with_t = F.when(dash & y.contains("T"), F.try_to_timestamp(F.substring(y, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return F.coalesce(*[F.when(fits, F.try_to_timestamp(y, F.lit(f))) for fits, f in forms], with_t)


def compact_date(x: Column) -> Column:
    """A date from a number such as 20240131."""
    return F.to_date(F.try_to_timestamp(x.cast("string"), F.lit("yyyyMMdd")))


def epoch_by_size(x: Column) -> Column:
    """A timestamp from seconds, or from milliseconds if the number is above 10**12."""
    return F.timestamp_seconds(F.when(x > 1_000_000_000_000, F.floor(x / 1000)).otherwise(x).cast("long"))


def epoch_by_length(x: Column) -> Column:
    """As `epoch_by_size`, but numbers of over ten digits are milliseconds."""
    return F.timestamp_seconds(F.when(F.char_length(x.cast("string")) > 10, F.floor(x / 1000)).otherwise(x).cast("long"))


def posted_before(text: Column, seen: Column) -> Column:
    """A timestamp from a text such as "3 ngày trước" and the time at which it was seen. Months keep the day up to the
    28th. A text without an amount and a unit gives the time itself; null or blank text gives null."""
    p = squeeze(F.lower(fold(text)))
    shape = r"(\d+)\s+(giay|phut|gio|ngay|tuan|thang)"
    amount, unit = F.regexp_extract(p, shape, 1).try_cast("int"), F.regexp_extract(p, shape, 2)
    seconds = {"giay": 1, "phut": 60, "gio": 3600, "ngay": 86400, "tuan": 604800}
    size = F.coalesce(*[F.when(unit == u, F.lit(s)) for u, s in seconds.items()])
    moved = F.timestamp_micros(F.unix_micros(seen) - amount.cast("long") * size * 1_000_000)
    first = F.add_months(F.trunc(seen, "month"), -amount)
    day = F.least(F.dayofmonth(seen), F.lit(28))
    clock = F.unix_micros(seen) - F.unix_micros(F.date_trunc("day", seen))
    month = F.timestamp_micros(F.unix_micros(F.date_add(first, day - 1).cast("timestamp")) + clock)
    return F.when(F.trim(text) == "", None).when(unit == "thang", month).when(unit != "", moved).otherwise(F.when(text.isNotNull(), seen))


def month_key(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM")


def quarter_key(month: Column) -> Column:
    return F.concat(F.substring(month, 1, 4), F.lit("-Q"), F.ceil(F.substring(month, 6, 2).cast("int") / 3).cast("string"))


def shifted_month(month: Column, by: int) -> Column:
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), by), "yyyy-MM")


def last_sunday(day: Column, before: bool = False) -> Column:
    """The latest Sunday; on a Sunday that day, or the one a week earlier with `before`."""
    back = F.dayofweek(day) - 1
    return F.date_sub(day, F.when(back == 0, 7).otherwise(back) if before else back)
