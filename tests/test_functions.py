from __future__ import annotations

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sensorgrid.fixed_values import AQI_CATEGORIES
from sensorgrid.functions import aqi as A
from sensorgrid.functions.calendar import (
    day_period,
    event_time,
    iso_timestamp,
    night,
    rush_hour,
    time_enrichment,
)
from sensorgrid.functions.numeric import (
    exact_avg,
    half_up,
    keyed_jitter,
    truncated_int,
    whole_half_up,
)

GOLDEN = [
    (-1.0, -4, "Bon", 100.0),
    (0.0, 0, "Bon", 100.0),
    (0.1, 0, "Bon", 100.0),
    (6.0, 25, "Bon", 82.4),
    (12.0, 50, "Bon", 71.5),
    (12.1, 51, "Modéré", 71.1),
    (23.7, 75, "Modéré", 62.1),
    (35.4, 100, "Modéré", 53.7),
    (35.5, 101, "Mauvais pour sensibles", 53.3),
    (55.4, 150, "Mauvais pour sensibles", 38.4),
    (55.5, 151, "Mauvais", 38.2),
    (150.4, 200, "Mauvais", 24.7),
    (150.5, 201, "Très mauvais", 24.4),
    (250.4, 300, "Très mauvais", 0.0),
    (250.5, 301, "Dangereux", 0.0),
    (500.4, 500, "Dangereux", 0.0),
    (500.5, 500, "Dangereux", 0.0),
    (None, 500, "Dangereux", 0.0),
]


def test_aqi_golden_values(spark):
    rows = spark.createDataFrame([(p,) for p, *_ in GOLDEN], "pm double")
    scored = rows.withColumn("aqi", A.aqi_from_pm25(F.col("pm")))
    aqi = F.col("aqi")
    got = scored.select("pm", aqi, A.aqi_category(aqi), A.air_quality_percent(aqi)).collect()
    assert [tuple(r) for r in got] == GOLDEN


def test_missing_index(spark):
    row = spark.createDataFrame([(None,)], "pm double").select(
        A.aqi_from_pm25(F.col("pm"), null_aqi=True).alias("aqi")
    )
    aqi = F.col("aqi")
    got = row.select(
        aqi, A.aqi_category(aqi), A.aqi_color(aqi), A.aqi_recommendation(aqi),
        A.air_quality_percent(aqi), A.sport_ok(aqi),
    ).first()
    assert tuple(got) == (None, "Dangereux", "#7E0023", "Urgence sanitaire", None, False)


def test_index_grows_with_concentration_and_class_with_index(spark):
    scored = spark.range(0, 6000).select((F.col("id") / 10).alias("pm"))
    scored = scored.withColumn("aqi", A.aqi_from_pm25(F.col("pm")))
    rows = scored.select("aqi", A.aqi_category(F.col("aqi")).alias("c")).orderBy("pm").collect()
    values = [r.aqi for r in rows]
    classes = [AQI_CATEGORIES.index(r.c) for r in rows]
    assert values == sorted(values) and classes == sorted(classes)


def test_sql_functions(spark):
    A.register_sql_functions(spark)
    got = spark.sql(
        "SELECT get_aqi_category(50), get_aqi_category(151), get_aqi_color(300), "
        "get_aqi_category(CAST(NULL AS INT)), get_aqi_color(CAST(NULL AS INT))"
    ).first()
    assert tuple(got) == ("Bon", "Mauvais", "#8F3F97", "Dangereux", "#7E0023")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=50, max_size=200))
def test_half_up_is_round(spark, values):
    check_rounding(spark, values)


def test_half_up_is_round_at_ties(spark):
    near = [k / 20 for k in range(-400, 400)] + [1.26 * k for k in range(500)]
    near += [0.49999999999999994, 2.4999999999999996, 1e13 + 0.25, 52.849999999999994]
    near += [random.Random(1).randrange(100000) / 100 for _ in range(500)]
    check_rounding(spark, near)


def check_rounding(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    v = F.col("v")
    wrong = rows.where(
        (half_up(v, 1) != F.round(v, 1))
        | (half_up(v, 4) != F.round(v, 4))
        | (whole_half_up(v) != F.round(v, 0))
    )
    assert wrong.collect() == []


def test_truncated_int(spark):
    rows = spark.createDataFrame([(1.9,), (-1.9,), (1e12,), (-1e12,), (None,)], "v double")
    got = [r[0] for r in rows.select(truncated_int(F.col("v"))).collect()]
    assert got == [1, -1, 2147483647, -2147483648, None]


def test_exact_avg_over_the_whole_range(spark):
    rows = spark.createDataFrame([(1e13,), (2.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert rows.agg(exact_avg("v")).first()[0] == (1e13 + 2) / 2
    assert spark.createDataFrame([(-1e300,)], "v double").agg(exact_avg("v")).first()[0] == -1e300


def test_exact_avg_of_any_order_and_missing(spark):
    values = [0.1] * 10 + [0.2, 0.7, -3.3, None, float("nan")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    assert rows.agg(exact_avg("v")).first()[0] == pytest.approx(-1.4 / 13, abs=1e-15)
    empty = rows.where("v > 100").agg(exact_avg("v")).first()[0]
    assert empty is None


def test_jitter_is_bounded_and_replayable(spark):
    rows = spark.range(2000).withColumn("f", keyed_jitter([F.col("id")], F.lit(0.25), 3))
    other = spark.range(2000).withColumn("f", keyed_jitter([F.col("id")], F.lit(0.25), 4))
    lo, hi, mean = rows.agg(F.min("f"), F.max("f"), F.avg("f")).first()
    assert 0.75 <= lo < 0.77 and 1.23 < hi < 1.25 and abs(mean - 1) < 0.02
    assert rows.exceptAll(rows.repartition(3)).isEmpty()
    assert rows.join(other, ["id", "f"]).isEmpty()


def test_hours(spark):
    rows = spark.createDataFrame([(h,) for h in [*range(24), None]], "h int")
    h = F.col("h")
    got = rows.select(rush_hour(h), night(h), day_period(h)).collect()
    for hour, (rush, dark, period) in zip(range(24), got):
        assert rush == (hour in (7, 8, 9, 17, 18, 19))
        assert dark == (hour >= 22 or hour <= 5)
        names = [(6, "Nuit"), (12, "Matin"), (14, "Midi"), (18, "Après-midi"), (22, "Soir"), (24, "Nuit")]
        assert period == next(n for end, n in names if hour < end)
    assert tuple(got[-1]) == (False, False, "Nuit")


def test_days(spark):
    rows = spark.sql("SELECT explode(array(timestamp_ntz'2024-01-01 10:00:00', timestamp_ntz'2024-01-06 23:00:00', NULL)) AS datetime")
    got = time_enrichment(rows).collect()
    assert tuple(got[0])[1:] == (10, 0, "Monday", 1, 0, "Matin")
    assert tuple(got[1])[1:] == (23, 5, "Saturday", 1, 1, "Nuit")
    assert tuple(got[2])[1:] == (None, None, "Sunday", None, 0, "Nuit")


def test_event_time_needs_both_parts(spark):
    rows = spark.createDataFrame(
        [("2024-01-01", "10:11:12"), (None, "10:11:12"), ("2024-01-01", None), ("foo", "10:11:12"), ("", "10:11:12")],
        "d string, t string",
    )
    got = [r[0] for r in rows.select(iso_timestamp(event_time(F.col("d"), F.col("t")))).collect()]
    assert got == ["2024-01-01T10:11:12.000000", None, None, None, None]
