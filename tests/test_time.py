from freightflow import functions as fn
from pyspark.sql import functions as F


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_text_of_milliseconds(spark):
    ms = F.lit(1704262146000)
    assert value(spark, fn.ms_to_date(ms)) == "2024-01-03"
    assert value(spark, fn.ms_to_datetime(ms)) == "2024-01-03 06:09:06"


def test_milliseconds_of_text(spark):
    assert value(spark, fn.datetime_to_ms(F.lit("2024-01-16 22:00:49"))) == 1705442449000
    assert value(spark, fn.date_to_ms(F.lit("2024-01-16"))) == 1705363200000
    for bad in ["2024-01-16", "x", "", "2024-13-01 00:00:00", "2024-1-1 0:0:0"]:
        assert value(spark, fn.datetime_to_ms(F.lit(bad))) is None
    assert value(spark, fn.date_to_ms(F.lit("16/01/2024"))) is None


def test_time_zone_is_a_setting(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert value(spark, fn.ms_to_datetime(F.lit(0))) == "1970-01-01 08:00:00"
        assert value(spark, fn.datetime_to_ms(F.lit("1970-01-01 08:00:00"))) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clock(spark):
    assert value(spark, fn.number_to_clock(F.lit(17042000), "milliseconds")) == "04:44:02"
    assert value(spark, fn.number_to_clock(F.lit(17042))) == "04:44:02"
    assert value(spark, fn.number_to_clock(F.lit(360000))) == "100:00:00"
    assert value(spark, fn.clock_to_number(F.lit("04:44:02"))) == 17042
    assert value(spark, fn.clock_to_number(F.lit("04:44:02"), "milliseconds")) == 17042000
    for bad in ["04:44", "1:2:3:4", "a:b:c", ""]:
        assert value(spark, fn.clock_to_number(F.lit(bad))) is None
