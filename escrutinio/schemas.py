"""Declared schemas of the data model."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values.
BLANK = "BLANK"
THRESHOLD = 0.03

PARTY_KEY = ["autonomic_region_name", "province_name", "political_party_norm"]


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Fields of a vote. from_json never enforces "not null", so every field is declared nullable and
# rows without an id are routed to the rejects instead.
VOTE = _struct(
    ("id", StringType()),
    ("blank_vote", BooleanType()),
    ("political_party", StringType()),
    ("province_name", StringType()),
    ("province_iso_code", StringType()),
    ("autonomic_region_name", StringType()),
    ("autonomic_region_iso_code", StringType()),
    ("location", StringType()),
    ("timestamp", TimestampType()),
)

# Bronze keeps the text of the messages that could not be parsed.
# With each message goes when it reached the broker and when it reached bronze.
ARRIVAL = ["arrived", "ingested"]
BRONZE = StructType(
    [*VOTE.fields, StructField("raw", StringType(), True), *(StructField(name, TimestampType(), True) for name in ARRIVAL)]
)

# Fixed values.
SILVER_COLUMNS = [
    "id",
    "timestamp",
    "political_party",
    "province_name",
    "autonomic_region_name",
    "blank_vote",
    "location",
    "province_iso_code",
    "autonomic_region_iso_code",
]

SILVER = StructType(
    [VOTE[name] for name in SILVER_COLUMNS] + [StructField("political_party_norm", StringType(), True)]
)

# The projection that the counting stream reads back: no raw party column.
VOTE_NORM = StructType(
    [
        StructField("political_party_norm", StringType(), True) if field.name == "political_party" else field
        for field in VOTE.fields
    ]
)

SEATS = StructType([*(StructField(n, StringType(), True) for n in PARTY_KEY), StructField("seats", LongType(), True)])

SEAT_DOCUMENT = _struct(
    ("doc_id", StringType()),
    ("province_name", StringType()),
    ("political_party", StringType()),
    ("autonomic_region_name", StringType()),
    ("seats", LongType()),
    ("updated_at", TimestampType()),
)

# The served table: its key and the micro-batch of each row beside the document.
SERVED = StructType(
    [StructField("seat_key", StringType(), True), StructField("sequence", LongType(), True), *SEAT_DOCUMENT.fields]
)

# A message of a topic: its key and its JSON value.
MESSAGE = _struct(("key", StringType()), ("value", StringType()))

# The dimension that votes are joined with by province.
PROVINCE_LOOKUP = _struct(
    ("province_name", StringType()),
    ("region_name", StringType()),
    ("region_iso_code", StringType()),
)

COORDINATES_FILE = _struct(("coordinates", ArrayType(StringType())))

# Geometry depth depends on its type, so "coordinates" stays text until the type is known.
GEOMETRY = _struct(("type", StringType()), ("coordinates", StringType()))

MUNICIPALITY = _struct(
    ("prov_code", StringType()),
    ("prov_name", StringType()),
    ("geo_point_2d", _struct(("lat", StringType()), ("lon", StringType()))),
    ("geo_shape", _struct(("geometry", GEOMETRY))),
)

STREETS = _struct(("features", ArrayType(_struct(("geometry", GEOMETRY)))))
