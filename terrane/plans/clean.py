"""The clean-up of listings: one projection for all sources, and the step at which each listing stopped.

The steps are place, price, area, trade, group and date. `process_status` counts the steps that a listing passed one after
another, 6 being all; the values of later steps are there all the same. Land prices come last and gate nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions import parse, rules
from terrane.operators.state import gate, split_by

STEPS = ("place", "price", "area", "trade", "group", "date")


@dataclass(frozen=True)
class Source:
    """How a source writes its listings: names of parsers and rules."""

    price: str
    area: str
    groups: str
    land: str
    trade: str = "words"
    date: str = "any"
    whole_m2: bool = False
    by_unit: bool = False


#: The styles of sources that are known; a source's rows say in `style` which one is theirs.
SOURCES = {
    "names": Source("unit_needed", "first_number", "names", "names", date="epoch_by_size"),
    "codes": Source("unit_needed", "first_number", "codes", "codes", date="epoch_by_length"),
    "folded": Source("unit_optional", "last_sign", "folded", "folded", trade="url", date="epoch_by_size", whole_m2=True),
    "ids": Source("plain_or_unit", "strict", "ids", "ids"),
    "slugs": Source("plain_or_unit_dots", "strict", "slugs", "slugs"),
    "numbers": Source("digits", "strict4", "numbers", "numbers", trade="number", date="compact", by_unit=True),
    "phrases": Source("compound", "first_sign", "phrases", "phrases"),
}


def _trade(kind: str) -> Column:
    if kind == "url":
        return rules.trade_kind_of_url(F.col("url"))
    return rules.trade_kind_of_number(F.col("src_type").try_cast("int")) if kind == "number" else rules.trade_kind(F.col("src_type"))


def _date(kind: str) -> Column:
    raw = F.col("src_date")
    number = raw.try_cast("long")
    made = {
        "any": lambda: parse.any_date(raw),
        "compact": lambda: parse.compact_date(number),
        "epoch_by_size": lambda: parse.epoch_by_size(number),
        "epoch_by_length": lambda: parse.epoch_by_length(number),
    }[kind]()
    return F.to_date(made)


def standardised(raw: DataFrame, places: DataFrame, sources: dict[str, Source] = SOURCES) -> DataFrame:
    """Typed listings with `process_status`.

    `raw`: id, style, src_place, src_price, src_size, unit, src_category, src_type, src_date, url; all but id text.
    `places`: place (text, one row each), ward, province. A style that is not in `sources` passes no step after place.
    """

    def by_style(of) -> Column:
        out = None
        for style, source in sources.items():
            value = of(source)
            out = F.when(F.col("style") == style, value) if out is None else out.when(F.col("style") == style, value)
        return out

    rows = raw.join(places, F.col("src_place") == F.col("place"), "left").withColumns({
        "price_vnd": by_style(lambda s: parse.PRICES[s.price](F.col("src_price")).cast("double")).cast("long"),
        "std_area": by_style(lambda s: parse.AREAS[s.area](F.col("src_size")).cast("double")),
        "trade": by_style(lambda s: _trade(s.trade)),
        "std_date": by_style(lambda s: _date(s.date)),
    })
    m2 = lambda s: rules.price_m2_by_unit(F.col("price_vnd"), F.col("std_area"), F.col("unit")) if s.by_unit else rules.price_m2(F.col("price_vnd"), F.col("std_area"), s.whole_m2).cast("double")
    # The rules of all styles are long, so this projection holds a bound value, as that of the areas does.
    rows = rows.withColumns({
        "price_m2": by_style(m2),
        "grp": parse.bound(by_style(lambda s: rules.GROUPS[s.groups].of(F.col("src_category"), F.col("trade"))), lambda g: g),
        "std_month": parse.month_key(F.col("std_date")),
        "land": by_style(lambda s: rules.LAND_PRICES[s.land].of(F.col("src_category"), F.col("trade"), F.col("price_vnd"))),
    })
    steps = [F.col("ward").isNotNull(), F.col("price_vnd") > 0, F.col("std_area") > 0, F.col("trade").isNotNull(), F.col("grp").isNotNull(), F.col("std_date").isNotNull()]
    return rows.select(
        "id", "style", "province", "ward", "price_vnd", "std_area", "price_m2", "trade", "grp", "std_date", "std_month",
        F.col("land.price_land").alias("price_land"), F.col("land.status").alias("land_price_status"),
        # Exploded, so that a filter on it does not parse all texts a second time below the projections.
        F.explode(F.array(gate(steps))).alias("process_status"),
    )


def accepted_and_rejected(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The listings that passed all steps, and the others with the step that stopped them."""
    good, bad = split_by(clean, F.col("process_status") == len(STEPS))
    return good, bad.withColumn("reason", F.get(F.array(*map(F.lit, STEPS)), F.col("process_status")))


def backlog(clean: DataFrame) -> DataFrame:
    """Listings of each style that wait at each step."""
    return clean.where(F.col("process_status") < len(STEPS)).groupBy("style", "process_status").agg(F.count("*").alias("n"))
