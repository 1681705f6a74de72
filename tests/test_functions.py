"""Parsers, dates and texts on literal examples."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from terrane.functions import parse, rules, text


def column(spark, function, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, f"i int, x {kind}").select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in out]


PRICES = {
    "unit_needed": {"5 tỷ": 5_000_000_000, "800 triệu": 800_000_000, "2,5 tỷ": 2_500_000_000, "15 triệu/tháng": 15_000_000, "2.01 tỷ": 2_009_999_999, "1.200.000 đ": 1, "500": None, "": None, None: None, "2 tỷ 300 triệu": 2_000_000_000},
    "unit_optional": {"Thỏa thuận": 0, "5,5 tỷ": 5_500_000_000, "700": 700, None: None, "": None},
    "plain_or_unit": {"12.5": 12.5, "3,5 tỷ": 3.5e9, "thương lượng": None, "1.2.3 tỷ": None, None: None},
    "folded": {"5 Tỷ": 5_000_000_000, "2.01 tỷ": 2_010_000_000, "3 nghìn": 3000, "7": None, None: None},
    "compound": {"2 tỷ 300 triệu": 2_300_000_000, "2 tỷ": 2_000_000_000, "300 trieu": 300_000_000, "tỷ": None, None: None},
    "two_units": {"2 tỷ 300 triệu": Decimal(2_300_000_000), "5 triệu 200 nghìn": Decimal(5_200_000), "9": None, None: None},
    "short_units": {"2 tr": Decimal(2_000_000), "5k": Decimal(5000), "0": None, "3,5ty": Decimal(3_500_000_000), None: None},
    "digits": {"123": 123, "12a": None, "": None, None: None},
    "stripped": {"1 234.5 đ": 1234.5, "đ": None, None: None},
}


@pytest.mark.parametrize("name", PRICES)
def test_prices(spark, name):
    got = column(spark, parse.PRICES[name], list(PRICES[name]))
    assert [None if g is None else float(g) for g in got] == [None if v is None else float(v) for v in PRICES[name].values()]


AREAS = {
    "first_number": {"80.5 m²": 80.5, "120,5m2": 120.5, "0": None, "x": None, None: None},
    "last_sign": {"1.234,56": 1234.56, "1,234.56": 1234.56, "1.200": 1200, "84,56 m²": 84.56, "0": None, None: None},
    "first_sign": {"1.234,5": 1234.5, "1,234.5": 1234.5, "0": 0, "1 200": 1200, None: None},
    "strict": {"12,345": 12.35, "12 m2": None, "0": None, None: None},
    "short": {"12,5x": 12.5, "123456.789": None, None: None},
}


@pytest.mark.parametrize("name", AREAS)
def test_areas(spark, name):
    got = column(spark, parse.AREAS[name], list(AREAS[name]))
    assert [None if g is None else float(g) for g in got] == [None if v is None else float(v) for v in AREAS[name].values()]


def test_dates(spark):
    day = dt.datetime(2024, 1, 31)
    assert column(spark, parse.any_date, ["2024-01-31", "31/01/2024", "31-01-2024", "2024-01-31T00:00:00", "31/02/2024", None]) == [day] * 4 + [None, None]
    assert column(spark, parse.compact_date, [20240131, 20240231, None], "long") == [day.date(), None, None]
    seen = F.lit("2024-03-31 12:00:00").cast("timestamp")
    got = column(spark, lambda x: parse.posted_before(x, seen), ["2 ngày trước", "1 tháng trước", "hôm nay", " ", None])
    assert got == [dt.datetime(2024, 3, 29, 12), dt.datetime(2024, 2, 28, 12), dt.datetime(2024, 3, 31, 12), None, None]
    assert column(spark, parse.epoch_by_size, [1706659200, 1706659200000], "long") == [day, day]
    assert column(spark, parse.quarter_key, ["2024-01", "2024-06", "2024-12"]) == ["2024-Q1", "2024-Q2", "2024-Q4"]
    assert column(spark, parse.last_sunday, [dt.date(2024, 1, 7), dt.date(2024, 1, 8)], "date") == [dt.date(2024, 1, 7)] * 2


def test_texts(spark):
    assert column(spark, text.words_only, ["Hồ Chí Minh", "Đất-Nền", "éa", None]) == ["ho chi minh", "dat nen", "ea", None]
    assert column(spark, text.ward_name, ["Phường 07", "P. Bến Nghé", "xã  An"]) == ["7", "ben nghe", "an"]
    assert column(spark, text.project_core, ["Chung cư Căn hộ Sao", "Khu đô thị mới Sao", "Căn hộ", "Sao Mai"]) == ["sao", "moi sao", "", "sao mai"]
    assert column(spark, text.normal_url, ["HTTP://A.com/x/?b=2&a=1#f", "https://a.com"]) == ["http://a.com/x?a=1&b=2", "https://a.com/"]
    assert column(spark, text.street_part, ["1, Main, W, D, C", "W, D, C"]) == ["1, Main", None]
    assert column(spark, text.phone, ["gọi 0912 345 678", "0912 345 ***", "12"]) == ["0912345678", None, None]


def test_rules(spark):
    rows = [("58", "s"), ("58", "u"), ("58", None), ("0", "s"), (None, None)]
    df = spark.createDataFrame(rows, "c string, t string")
    assert [r[0] for r in df.select(rules.GROUPS["ids"].of(F.col("c"), F.col("t"))).collect()] == [3, 4, 3, None, None]
    land = df.select(rules.LAND_PRICES["ids"].of(F.col("c"), F.col("t"), F.lit(10)).alias("r")).select("r.*").collect()
    assert [tuple(r) for r in land] == [(10, "DONE"), (None, "SKIP"), (None, "SKIP"), (None, "SKIP"), (None, "SKIP")]
