"""Record types of the inputs and outputs, usable wherever Spark takes a schema."""

from __future__ import annotations

from pyspark.sql.types import StructType


def record(**fields: str) -> StructType:
    """A nullable StructType from ``name="type"`` pairs, in the order given."""
    schema = StructType()
    for name, type_name in fields.items():
        schema = schema.add(name, type_name)
    return schema


# Column names and types of the booking records.
BOOKINGS = record(
    id="long",
    date_time="string",
    site_name="integer",
    posa_continent="integer",
    user_location_country="integer",
    user_location_region="integer",
    user_location_city="integer",
    orig_destination_distance="double",
    user_id="integer",
    is_mobile="integer",
    is_package="integer",
    channel="integer",
    srch_ci="string",
    srch_co="string",
    srch_adults_cnt="integer",
    srch_children_cnt="integer",
    srch_rm_cnt="integer",
    srch_destination_id="integer",
    srch_destination_type_id="integer",
    hotel_id="long",
)

# Keys of the weather messages. ``Id`` arrives in exponent form,
# which JSON readers only accept as a double; project_weather() makes it a long.
WEATHER_MESSAGES = record(
    wthrDate="string",
    avgTmprF="double",
    avgTmprC="double",
    Id="double",
    Name="string",
    Country="string",
    City="string",
    Address="string",
    Latitude="double",
    Longitude="double",
    Geohash="string",
)

# Columns of an enriched booking.
ENRICHED = record(
    order_id="long",
    srch_ci="string",
    srch_co="string",
    srch_children_cnt="integer",
    hotel_id="long",
    hotel_name="string",
    avg_tmpr="double",
    duration_stay="long",
)

# Keys of the customer-preference messages.
PREFERENCES = record(
    hotel_name="string",
    hotel_id="long",
    order_id="long",
    duration_stay="long",
    children_cnt="integer",
    initial_state="string",
    initial_state_value="string",
)

# Names of the counters, and columns of the two results.
_COUNTERS = dict.fromkeys(
    [
        "erroneous_data_cnt",
        "short_stay_cnt",
        "standart_stay_cnt",
        "standart_extended_stay_cnt",
        "long_stay_cnt",
    ],
    "long",
)

POPULAR_BY_HOTEL = record(
    hotel_name="string", hotel_id="long", **_COUNTERS, most_popular_stay_type="string"
)

POPULAR_BY_CHILDREN = record(
    hotel_name="string",
    with_children_true="long",
    with_children_false="long",
    **_COUNTERS,
    most_popular_stay_type="string",
)
