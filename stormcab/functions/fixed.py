"""Fixed values.

Everything in this module must equal the values the original pipeline uses,
otherwise names, keys and filters give different results.  They are stated
plainly, in their natural order, in one place.
"""

from __future__ import annotations

# --- FIXED VALUES (must match the original pipeline) ------------------------

# The five boroughs with their own weather series, in the original order.
NYC_BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")

# Payment type code -> name; anything else (and NULL) is "Unknown".
PAYMENT_TYPE_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
UNKNOWN_PAYMENT = "Unknown"

# Rate code -> name (prototype notebook); anything else is "Unknown".
RATE_CODE_NAMES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

# Source column name -> warehouse name for trip files.  Both spellings of the
# airport fee map to one name.
TAXI_COLUMN_RENAME_MAP = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
    "airport_fee": "airport_fee",
    "cbd_congestion_fee": "cbd_congestion_fee",
}

# Columns a trip file must carry after renaming.
REQUIRED_TAXI_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "trip_distance",
    "fare_amount",
    "total_amount",
)

# Columns that feed the trip record hash, in hash order.
TRIP_HASH_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
    "total_amount",
    "trip_distance",
)

# Weather payload measure name -> warehouse name.
WEATHER_RENAME_MAP = {
    "precipitation": "precipitation_mm",
    "rain": "rain_mm",
    "snowfall": "snowfall_cm",
    "windspeed_10m": "wind_speed_10m",
}

# Zone lookup header -> warehouse name.
ZONE_RENAME_MAP = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
    "service_zone": "service_zone",
}

# Staging validity bounds for trips.
MAX_TRIP_DISTANCE = 200
MAX_FARE_AMOUNT = 1000
MAX_TOTAL_AMOUNT = 1500
MIN_PASSENGERS = 0
MAX_PASSENGERS = 8
DEFAULT_PASSENGERS = 1

# Staging validity bounds for weather.
MIN_TEMPERATURE = -50
MAX_TEMPERATURE = 60
MIN_WIND_SPEED = 0
MAX_WIND_SPEED = 200

# Weather severity thresholds: (precipitation mm, snowfall cm), checked from
# the most severe level down; "light" is anything above zero.
SEVERE_PRECIPITATION_MM = 8
SEVERE_SNOWFALL_CM = 3
MODERATE_PRECIPITATION_MM = 2
MODERATE_SNOWFALL_CM = 1
SEVERITY_LEVELS = ("clear", "light", "moderate", "severe")
UNKNOWN_WEATHER = "unknown"

# Rush hours: [07:00, 10:00) and [16:00, 20:00), every day of the week.
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)
# ISO weekday numbers of the weekend.
WEEKEND_ISO_DAYS = (6, 7)

# Quality thresholds (defaults of the original settings).
MIN_TAXI_ROWS = 1000
MIN_WEATHER_JOIN_COVERAGE = 0.95
WEATHER_ROWS_FRACTION = 0.95
WEATHER_FILES_PER_MONTH = 5
MIN_WEATHER_EXTRACT_ROWS = 24 * 20

# Processed-extract columns the raw checks require.
REQUIRED_PROCESSED_TAXI_COLUMNS = (
    "record_hash",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "trip_distance",
    "fare_amount",
    "total_amount",
)
REQUIRED_PROCESSED_WEATHER_COLUMNS = (
    "weather_record_id",
    "borough",
    "weather_ts_hour",
    "temperature_2m",
    "precipitation_mm",
    "weathercode",
)

# Dashboard: number of zones in the top-zone bar charts, rows in the
# top-revenue query.
TOP_ZONES = 15
TOP_REVENUE_ROWS = 20

# --- end of fixed values -----------------------------------------------------
