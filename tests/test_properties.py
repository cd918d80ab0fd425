"""Property test: the staging filter keeps exactly the rows the rules allow."""

from datetime import datetime, timedelta
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stormcab import schemas
from stormcab.operators import staging

T0 = datetime(2025, 1, 6, 8, 0, 0)
money = st.one_of(st.none(), st.sampled_from([D("-0.01"), D("0"), D("5.25"), D("1000"), D("1000.01"),
                                              D("1500"), D("1500.01")]))
row = st.fixed_dictionaries({
    "trip_distance": st.one_of(st.none(), st.sampled_from([D("0"), D("0.001"), D("3.5"), D("200"), D("200.001")])),
    "fare_amount": money,
    "total_amount": money,
    "passenger_count": st.one_of(st.none(), st.sampled_from([D("0"), D("1"), D("8"), D("9")])),
    "minutes": st.sampled_from([-5, 0, 1, 30]),
    "pickup_location_id": st.one_of(st.none(), st.just(1)),
})


def allowed(r) -> bool:
    fare = r["fare_amount"] if r["fare_amount"] is not None else D(0)
    total = r["total_amount"] if r["total_amount"] is not None else D(0)
    pax = r["passenger_count"] if r["passenger_count"] is not None else D(1)
    dist = r["trip_distance"]
    return (r["minutes"] > 0 and r["pickup_location_id"] is not None and dist is not None
            and D(0) < dist <= D(200) and D(0) <= fare <= D(1000) and D(0) <= total <= D(1500)
            and D(0) <= pax <= D(8))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_staging_filter_matches_rules(spark, rows):
    data = []
    for i, r in enumerate(rows):
        rec = {f.name: None for f in schemas.RAW_TRIPS.fields}
        rec.update(record_hash=f"h{i:03d}", pickup_datetime=T0, dropoff_datetime=T0 + timedelta(minutes=r["minutes"]),
                   passenger_count=r["passenger_count"], trip_distance=r["trip_distance"],
                   pickup_location_id=r["pickup_location_id"], dropoff_location_id=2,
                   fare_amount=r["fare_amount"], total_amount=r["total_amount"],
                   ingestion_month=T0.date(), source_file="f", ingested_at=T0)
        data.append(tuple(rec[f.name] for f in schemas.RAW_TRIPS.fields))
    df = spark.createDataFrame(data, schemas.RAW_TRIPS)
    got = {r.trip_id for r in staging.stg_taxi_trips(df).select("trip_id").collect()}
    want = {f"h{i:03d}" for i, r in enumerate(rows) if allowed(r)}
    assert got == want
