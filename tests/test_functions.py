from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates, keys, nested, numbers, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, want", [("00012", "12"), ("000", None), ("", None), ("a01", "a01"), ("10", "10")])
def test_strip_zeros(spark, raw, want):
    assert one(spark, text.strip_zeros(F.col("s")), s=raw) == want


@pytest.mark.parametrize("raw, want", [("007", "7"), ("12.0", "12"), ("12.5", "12.5"), ("x1", "x1"), ("0", "0"), ("9" * 30, "9" * 30), ("9007199254740993.0", "9007199254740993"), ("000", "0"), ("0.0", "0"), ("1.", "1.")])
def test_normalize_numeric_text(spark, raw, want):
    assert one(spark, text.normalize_numeric_text(F.col("s")), s=raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("840912345678", "0912345678"),
        (".0912345678", "0912345678"),
        ("84912345678", "0912345678"),
        ("8412345678", "08412345678"),
        ("912345678", "0912345678"),
        ("0912345678", "0912345678"),
    ],
)
def test_clean_mobile(spark, raw, want):
    assert one(spark, text.clean_mobile(F.col("s")), s=raw) == want


def test_missing_attributes_keep_order(spark):
    got = text.missing_attributes({"NAME": F.lit(None), "UNIT": F.lit("x"), "VENDOR": F.lit(None)})
    assert one(spark, got) == "NAME, VENDOR"


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["col 1", "col-2"])
    assert text.clean_columns(df).columns == ["col_1", "col_2"]
    camel = spark.createDataFrame([(1, 2)], ["/bic/storeCode", "TranTime!"])
    assert text.snake_case_columns(camel).columns == ["/bic/store_code", "tran_time"]
    assert text.snake_case_columns(camel, keep_punctuation=True).columns == ["/bic/store_code", "tran_time!"]
    with pytest.raises(ValueError):
        text.clean_columns(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


@pytest.mark.parametrize("raw, want", [("20240115", date(2024, 1, 15)), ("00000000", None), ("", None), ("20241315", None)])
def test_parse_compact_date(spark, raw, want):
    assert one(spark, dates.parse_compact_date(F.col("s")), s=raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("1/15/2024 1:02:03 PM", datetime(2024, 1, 15, 13, 2, 3)),
        ("1/15/2024 12:00:00 AM", datetime(2024, 1, 15)),
        ("1/15/2024 12:00:00 PM", datetime(2024, 1, 15, 12)),
        ("soon", None),
    ],
)
def test_parse_ampm_is_not_shifted_twice(spark, raw, want):
    assert one(spark, dates.parse_ampm(F.col("s"))
               .cast("string"), s=raw) == (None if want is None else str(want))


def test_normalize_stamp(spark):
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    df = spark.createDataFrame([(None,), ("20240115093000",), ("2024-01-15 09:30:00",), ("soon",)], "s string")
    got = [r[0] for r in df.select(dates.normalize_stamp(F.col("s"), now)).collect()]
    assert got == ["20240201000000", "20240115093000", "20240115093000", None]


def test_last_weekday_of_month(spark):
    df = spark.createDataFrame([("2024-01-15",), ("2024-07-01",), ("2024-02-29",)], "d string")
    got = [str(r[0]) for r in df.select(dates.last_weekday_of_month(F.col("d").cast("date"))).collect()]
    assert got == ["2024-01-31", "2024-07-31", "2024-02-28"]


def test_clean_date_list(spark):
    raw = " '2024-01-02',2024-01-01,,soon,2024-01-02,2022-12-31,2024-02-01"
    assert one(spark, dates.clean_date_list(F.lit(raw), "2024-01-15")) == "2024-01-02,2024-01-01"


def test_stamp_from_filename(spark):
    got = one(spark, dates.stamp_from_filename(F.lit("price_01_20240115093000.xml")).cast("string"))
    assert got == "2024-01-15 09:30:00"


def test_local_day(spark):
    utc = F.to_timestamp(F.lit("2024-01-15 18:00:00"))
    assert one(spark, dates.local_day(utc)) == date(2024, 1, 16)


def test_numbers(spark):
    assert one(spark, numbers.least_positive(F.lit(0.0), F.lit(-1.0), F.lit(3.0), F.lit(2.0))) == 2.0
    assert one(spark, numbers.least_positive(F.lit(0.0), F.lit(-1.0))) is None
    assert one(spark, numbers.round_to_pack(F.lit(13.0), F.lit(6))) == 18
    assert one(spark, numbers.round_to_pack(F.lit(13.0), F.lit(0))) is None
    assert one(spark, numbers.picking_type(F.lit(12.0), F.lit(6))) == "Case"
    assert one(spark, numbers.picking_type(F.lit(13.0), F.lit(6))) == "Piece"
    assert one(spark, numbers.picking_type(F.lit(12.0), F.lit(1))) == "Piece"
    assert one(spark, numbers.signed(F.lit("H"), F.lit(-4.0))) == -4.0
    assert one(spark, numbers.signed(F.lit("S"), F.lit(-4.0))) == 4.0
    assert one(spark, numbers.noise_floor(F.lit(1e-9))) == 0.0


def test_keys_do_not_run_together(spark):
    a = keys.surrogate_key(F.lit("1"), F.lit("23"))
    b = keys.surrogate_key(F.lit("12"), F.lit("3"))
    c = keys.surrogate_key(F.lit("1"), F.lit(None), F.lit("23"))
    df = spark.range(1).select(a.alias("a"), b.alias("b"), c.alias("c")).first()
    assert len({df.a, df.b, df.c}) == 3
    assert one(spark, F.length(keys.pseudonym(F.lit("x"), "salt"))) == 32


def test_nested(spark):
    days = F.array(*[F.lit(d).cast("date") for d in ("2024-01-05", "2024-01-01", "2024-01-04", "2024-01-02", "2024-01-05")])
    assert one(spark, nested.start_of_last_run(days)) == date(2024, 1, 4)
    assert one(spark, nested.kth_smallest(F.array(F.lit(3), F.lit(1), F.lit(2)), 1)) == 2
    assert one(spark, nested.kth_smallest(F.array(F.lit(3)), 1)) is None
