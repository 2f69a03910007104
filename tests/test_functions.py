import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from citytrace.functions import bins, geo, numeric, times, tokens


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def values(spark, kind, items, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_distance_bin_edges(spark):
    assert values(spark, "double", [0.1, 1.99, 2.0, 4.99, 5.0, 10.0, 20.0, 29.9], bins.distance_bin) == [
        "0-2mi", "0-2mi", "2-5mi", "2-5mi", "5-10mi", "10-20mi", "20-30mi", "20-30mi",
    ]


def test_fare_bin_edges(spark):
    fares = [0.0, 9.99, 10.0, 20.0, 40.0, 80.0, 100.0, 140.0, 180.0, 300.0, 999.0]
    assert values(spark, "double", fares, bins.fare_bin) == [
        "$0-$10", "$0-$10", "$10-$20", "$20-$40", "$40-$80", "$80-$100", "$100-$140", "$140-$180", "$180-$300",
        "$300-$1000", "$300-$1000",
    ]


@pytest.mark.parametrize(
    "tip, fare, label",
    [
        (0.0, 10.0, "NoTip"), (-1.0, 10.0, "NoTip"), (0.5, 10.0, "LowTip"), (1.0, 10.0, "MidTip"),
        (1.99, 10.0, "MidTip"), (2.0, 10.0, "HighTip"), (5.0, 0.0, "LowTip"),
    ],
)
def test_tip_bin(spark, tip, fare, label):
    assert one(spark, bins.tip_bin(F.lit(tip), F.lit(fare))) == label


def test_time_bucket_of_clock_text(spark):
    texts = [
        "07:59:59", "08:00:00", "11:59:59", "12:00:00", "15:59:59", "16:00:00", "19:59:59", "20:00:00", "23:59:59",
        "xx:00:00", None,
    ]
    got = values(spark, "string", texts, lambda c: bins.time_bucket(times.hour_of_text(c)))
    assert got == [
        None, "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", "night", None, None,
    ]


def test_labels(spark):
    assert values(spark, "int", [1, 2, 3, None], bins.payment_label) == ["CreditCard", "Cash", "Other", "Other"]
    code = lambda zone, borough: one(spark, bins.airport_code(F.lit(zone), F.lit(borough)))
    assert code("JFK Airport", "Queens") == "JFK"
    assert code("LaGuardia Airport", "Queens") == "LGA"
    assert code("Somewhere", "EWR") == "EWR"
    assert code("Midtown", "Manhattan") is None
    nothing = F.lit(None).cast("string")
    assert one(spark, bins.route_type(F.lit("JFK"), nothing)) == "airport_to_city"
    assert one(spark, bins.route_type(nothing, nothing)) == "city_to_city"


def test_minutes_count_boundaries_or_time(spark):
    ts = lambda text: F.lit(text).cast("timestamp_ntz")
    a, b = ts("2025-01-01 10:00:59"), ts("2025-01-01 10:01:00")
    assert one(spark, times.minutes_boundary(a, b)) == 1
    assert one(spark, times.minutes_exact(a, b)) == pytest.approx(1 / 60)
    assert one(spark, times.minutes_exact(a, ts("2025-01-01 10:01:00.500"))) == pytest.approx(1.5 / 60)


def test_minutes_ignore_daylight_saving(spark):
    """01:50 to 03:10 on the night of the change is 80 minutes on the wall."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a, b = (times.ts_of_text(F.lit("2025-03-09"), F.lit(t)) for t in ("01:50:00", "03:10:00"))
        assert one(spark, times.minutes_exact(a, b)) == 80.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar(spark):
    sunday = F.lit(dt.date(2025, 1, 5))
    assert one(spark, times.dow0(sunday)) == 0
    assert one(spark, times.is_weekend(sunday)) == 1
    assert one(spark, times.day_name(sunday)) == "Sunday"
    assert one(spark, times.month_label(sunday)) == "Jan"
    assert one(spark, times.hour_label(F.lit(7))) == "07:00"
    assert one(spark, times.ts_of_text(F.lit("2025-01-01"), F.lit("xx:00:00"))) is None


def test_haversine_and_projection(spark):
    km = one(spark, geo.haversine_km(*[F.lit(v) for v in (40.0, -74.0, 41.0, -74.0)]))
    assert km == pytest.approx(6371.0 * math.pi / 180, rel=1e-12)
    assert one(spark, geo.km_to_miles(F.lit(10.0))) == pytest.approx(6.21371)
    crs = geo.ConicProjection()
    x, y = crs.forward(40.75, -73.9)
    lat, long = crs.inverse(F.lit(x), F.lit(y))
    assert one(spark, lat) == pytest.approx(40.75, abs=1e-9)
    assert one(spark, long) == pytest.approx(-73.9, abs=1e-9)
    assert crs.forward(crs.origin_latitude, -74.0) == pytest.approx((984250.0, 0.0), abs=1e-6)


def test_tokens_round_trip(spark):
    text = tokens.rule_text(F.lit(["b=2", "a=x=y"]), F.lit(["c=3"]))
    assert one(spark, text) == "{a=x=y, b=2} -> {c=3}"
    parsed = one(spark, tokens.parse_rule(text))
    assert (parsed["antecedent"], parsed["consequent"]) == (["a=x=y", "b=2"], ["c=3"])
    assert one(spark, tokens.parse_rule(F.lit("no rule")))["antecedent"] == []
    assert one(spark, tokens.token_value(F.lit(["b=2", "a=x=y"]), "a")) == "x=y"
    assert one(spark, tokens.token_value(F.lit(["b=2"]), "a")) is None


def test_numeric_guards(spark):
    assert values(spark, "double", [1.0, float("nan"), float("inf"), -float("inf"), None], numeric.finite) == [
        1.0, None, None, None, None,
    ]
    assert one(spark, numeric.percent(F.lit(1), F.lit(0), 4)) == 0.0
    assert one(spark, numeric.percent(F.lit(1), F.lit(3), 4)) == 33.3333
