"""Staging edge rows: every boundary of the cleaning and classification rules."""

from datetime import datetime
from decimal import Decimal as D


from stormcab import schemas
from stormcab.operators import staging

T0 = datetime(2025, 1, 6, 8, 0, 0)  # a Monday


def raw_trip(spark, **kw):
    base = dict(record_hash="h", vendor_id=1, pickup_datetime=T0, dropoff_datetime=datetime(2025, 1, 6, 8, 20),
                passenger_count=D("1.00"), trip_distance=D("2.500"), rate_code_id=1, store_and_fwd_flag="N",
                pickup_location_id=1, dropoff_location_id=2, payment_type=1, fare_amount=D("10.00"),
                extra=None, mta_tax=None, tip_amount=None, tolls_amount=None, improvement_surcharge=None,
                total_amount=D("12.00"), congestion_surcharge=None, airport_fee=None, cbd_congestion_fee=None,
                pickup_hour=None, pickup_date=None, ingestion_month=datetime(2025, 1, 1).date(),
                source_file="f", ingested_at=T0)
    rows = []
    for i, over in enumerate(kw.get("rows", [{}])):
        r = dict(base, **over)
        r["record_hash"] = f"h{i}"
        rows.append(tuple(r[f.name] for f in schemas.RAW_TRIPS.fields))
    return spark.createDataFrame(rows, schemas.RAW_TRIPS)


def kept(spark, rows):
    return [r.trip_id for r in staging.stg_taxi_trips(raw_trip(spark, rows=rows)).orderBy("trip_id").collect()]


def test_distance_bounds(spark):
    rows = [{"trip_distance": v} for v in (D("0"), D("0.001"), D("200.000"), D("200.001"), None)]
    assert kept(spark, rows) == ["h1", "h2"]


def test_fare_and_total_bounds(spark):
    fares = [{"fare_amount": v} for v in (D("-0.01"), D("0"), D("1000"), D("1000.01"), None)]
    assert kept(spark, fares) == ["h1", "h2", "h4"]  # NULL fare survives as 0
    totals = [{"total_amount": v} for v in (D("1500"), D("1500.01"))]
    assert kept(spark, totals) == ["h0"]


def test_passenger_bounds_and_default(spark):
    rows = [{"passenger_count": v} for v in (None, D("0"), D("8"), D("9"))]
    assert kept(spark, rows) == ["h0", "h1", "h2"]
    r = staging.stg_taxi_trips(raw_trip(spark, rows=[{"passenger_count": None}])).collect()[0]
    assert r.passenger_count == D("1.00")


def test_duration_rules(spark):
    rows = [{"dropoff_datetime": T0}, {"dropoff_datetime": datetime(2025, 1, 6, 7, 59)},
            {"dropoff_datetime": datetime(2025, 1, 6, 8, 1, 30)}]
    out = staging.stg_taxi_trips(raw_trip(spark, rows=rows)).collect()
    assert [r.trip_id for r in out] == ["h2"] and out[0].trip_duration_min == 1.5


def test_rush_hour_edges(spark):
    times = [(6, 59, 59), (7, 0, 0), (9, 59, 59), (10, 0, 0), (16, 0, 0), (19, 59, 59), (20, 0, 0)]
    rows = [{"pickup_datetime": datetime(2025, 1, 6, h, m, s), "dropoff_datetime": datetime(2025, 1, 6, 23, 0)}
            for h, m, s in times]
    out = staging.stg_taxi_trips(raw_trip(spark, rows=rows)).orderBy("trip_id").collect()
    assert [r.is_rush_hour for r in out] == [False, True, True, False, True, True, False]


def test_payment_names(spark):
    rows = [{"payment_type": v} for v in (1, 2, 3, 4, 5, 6, 0, 7, None)]
    out = staging.stg_taxi_trips(raw_trip(spark, rows=rows)).orderBy("trip_id").collect()
    assert [r.payment_type_name for r in out] == ["Credit card", "Cash", "No charge", "Dispute", "Unknown",
                                                  "Voided trip", "Unknown", "Unknown", "Unknown"]


def test_weekday_and_weekend(spark):
    rows = [{"pickup_datetime": datetime(2025, 1, d, 8), "dropoff_datetime": datetime(2025, 1, d, 9)}
            for d in (6, 11, 12)]
    out = staging.stg_taxi_trips(raw_trip(spark, rows=rows)).orderBy("trip_id").collect()
    assert [(r.weekday_number, r.is_weekend) for r in out] == [(1, False), (6, True), (7, True)]


def test_spring_forward_hour_stays_local(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [{"pickup_datetime": datetime(2025, 3, 9, 2, 30), "dropoff_datetime": datetime(2025, 3, 9, 3, 10)}]
        r = staging.stg_taxi_trips(raw_trip(spark, rows=rows)).collect()[0]
        from stormcab.functions import columns as C
        key = staging.stg_taxi_trips(raw_trip(spark, rows=rows)).select(C.date_hour_key("pickup_hour")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert str(r.pickup_hour) == "2025-03-09 02:00:00" and key == 2025030902
    assert r.trip_duration_min == 40.0  # by the clock: the session's zone skips an hour here


def test_duration_has_seconds_and_microseconds(spark):
    rows = [{"pickup_datetime": datetime(2024, 12, 31, 23, 59, 59, 500000), "dropoff_datetime": datetime(2025, 1, 1, 0, 0, 30, 750000)}]
    assert staging.stg_taxi_trips(raw_trip(spark, rows=rows)).first().trip_duration_min == 31250000 / 60000000


def raw_weather(spark, rows):
    base = dict(weather_record_id="w", borough="Bronx",
                temperature_2m=D("1.00"), precipitation_mm=D("0"), rain_mm=D("0"), snowfall_cm=D("0"),
                wind_speed_10m=D("5.00"), weathercode=1, source_month=datetime(2025, 1, 1).date(),
                source_file="f", ingested_at=datetime(2025, 1, 2))
    out = []
    for i, over in enumerate(rows):
        r = dict(base, **over)
        r.setdefault("weather_ts_hour", datetime(2025, 1, 1, i))
        out.append(tuple(r[f.name] for f in schemas.RAW_WEATHER.fields))
    return spark.createDataFrame(out, schemas.RAW_WEATHER)


def test_severity_levels(spark):
    cases = [({"precipitation_mm": D("0")}, "clear"), ({"precipitation_mm": D("0.01")}, "light"),
             ({"precipitation_mm": D("2")}, "moderate"), ({"precipitation_mm": D("8")}, "severe"),
             ({"snowfall_cm": D("0.1")}, "light"), ({"snowfall_cm": D("1")}, "moderate"),
             ({"snowfall_cm": D("3")}, "severe"), ({"precipitation_mm": None, "snowfall_cm": None}, "clear")]
    rows = [dict(c, weather_ts_hour=datetime(2025, 1, 1, i)) for i, (c, _) in enumerate(cases)]
    out = staging.stg_weather_hourly(raw_weather(spark, rows)).orderBy("weather_ts_hour").collect()
    assert [r.weather_severity for r in out] == [s for _, s in cases]
    assert out[-1].precipitation_mm == D("0.00")  # NULL -> 0


def test_weather_validity_after_dedup(spark):
    h = datetime(2025, 1, 1, 5)
    rows = [  # newest reading is invalid while an older one is valid: nothing survives
        {"weather_ts_hour": h, "ingested_at": datetime(2025, 1, 3), "temperature_2m": D("60.01")},
        {"weather_ts_hour": h, "ingested_at": datetime(2025, 1, 2), "temperature_2m": D("10")},
    ]
    assert staging.stg_weather_hourly(raw_weather(spark, rows)).count() == 0
    bounds = [{"temperature_2m": v} for v in (D("-50"), D("-50.01"), D("60"), None)]
    out = staging.stg_weather_hourly(raw_weather(spark, bounds)).orderBy("weather_ts_hour").collect()
    assert [float(r.temperature_2m) for r in out] == [-50.0, 60.0]
    winds = [{"wind_speed_10m": v} for v in (D("-1"), D("200"), D("200.01"), None)]
    assert staging.stg_weather_hourly(raw_weather(spark, winds)).count() == 1


def test_nyc_borough_flag(spark):
    z = spark.createDataFrame([(1, "Bronx", "a", None), (2, "EWR", "b", None), (3, None, "c", None)],
                              "location_id int, borough string, zone string, service_zone string")
    out = staging.stg_locations(z).orderBy("location_id").collect()
    assert [r.is_nyc_borough for r in out] == [True, False, False]
