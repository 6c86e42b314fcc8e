"""The election data model over the given order and customer tables.

Each order is a vote: its customer's nation is the province, the nation's region the
autonomous region. Every tenth vote arrives twice.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.schemas import MUNICIPALITY, STREETS


_LAT = "double(36000 + o_orderkey % 7000) / 1000"
_LON = "double((o_orderkey * 7) % 12000 - 9000) / 1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the nine vote fields."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "o_orderkey",
            "string(o_orderkey) AS id",
            "o_orderkey % 41 = 0 AS blank_vote",
            "CASE WHEN o_orderkey % 41 <> 0 THEN concat('PARTY_', int(floor(sqrt(o_orderkey % 100)))) END"
            " AS political_party",
            "n_name AS province_name",
            "concat('ES-', n_nationkey) AS province_iso_code",
            "r_name AS autonomic_region_name",
            "concat('ES-R', r_regionkey) AS autonomic_region_iso_code",
            f"CASE WHEN o_orderkey % 53 = 0 THEN 'unknown' WHEN o_orderkey % 59 = 0 THEN concat('136.5,', {_LON})"
            f" ELSE concat({_LAT}, ',', {_LON}) END AS location",
            "timestamp_micros(unix_micros(timestamp(o_orderdate))"
            " + (o_orderkey % 86400) * 1000000 + (o_orderkey % 1000) * 1000) AS timestamp",
        )
    )


def raw_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base_votes`` with every tenth vote repeated."""
    copies = F.expr("explode(sequence(1, CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END))").alias("_copy")
    return base_votes(spark, sf_dir).select("*", copies).drop("_copy")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw votes as JSON message values; one in 97 is cut off."""
    votes = raw_votes(spark, sf_dir)
    fields = [name for name in votes.columns if name != "o_orderkey"]
    text = F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return votes.select(F.when(F.col("o_orderkey") % 97 == 0, F.substring(text, 1, 20)).otherwise(text).alias("value"))


def seats_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seats per province: none for nation 23, no entry for nation 24."""
    return (
        table(spark, sf_dir, "nation")
        .filter("n_nationkey <> 24")
        .selectExpr(
            "n_name AS province_name",
            "bigint(CASE WHEN n_nationkey = 23 THEN 0 ELSE 1 + n_nationkey % 12 END) AS total_seats",
        )
    )


def provincias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provinces as the relational source stores them: one per nation, with its customers
    as population. Nation 24 names a region that does not exist."""
    people = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("people"))
    nation = table(spark, sf_dir, "nation")
    return nation.join(people, F.col("n_nationkey") == F.col("c_nationkey"), "left").selectExpr(
        "bigint(n_nationkey) AS id",
        "lpad(n_nationkey, 2, '0') AS codigo_provincia",
        "n_name AS nombre",
        "lower(n_name) AS nombre_alternativo",
        "CASE WHEN n_nationkey = 24 THEN '99' ELSE string(n_regionkey) END AS codigo_comunidad",
        "bigint(CASE WHEN n_nationkey = 23 THEN 0 ELSE 1 + n_nationkey % 12 END) AS total_diputados",
        "36 + double(n_nationkey) / 4 AS latitud",
        "double(n_nationkey) / 4 - 9 AS longitud",
        "coalesce(people, 0L) AS habitantes",
        "concat('ES-', n_nationkey) AS iso_3166_2_prov",
    )


def comunidades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as the relational source stores them, and one more without provinces."""
    regions = table(spark, sf_dir, "region")
    extra = regions.selectExpr("max(r_regionkey) + 1 AS r_regionkey", "'NO PROVINCES' AS r_name")
    return regions.unionByName(extra).selectExpr(
        "string(r_regionkey) AS codigo_comunidad",
        "r_name AS nombre",
        "lower(r_name) AS nombre_alternativo",
        "bigint(4 + r_regionkey) AS numero_senadores",
        "concat('ES-R', r_regionkey) AS iso_3166_2_ccaa",
    )


def _point(key: str, index: int) -> str:
    """[lon, lat] of one of a record's points; longitudes lie around the zero meridian."""
    lon = f"double(({key} * 7 + {index * 13}) % 2001 - 1000) / 100000"
    lat = f"double(3600 + ({key} * 11 + {index * 17}) % 700) / 100"
    return f"array({lon}, {lat})"


def _line(key: str, *indexes: int) -> str:
    return f"array({', '.join(_point(key, index) for index in indexes)})"


def _geometry(kind: str, coordinates: str) -> str:
    """JSON text of a geometry."""
    return f"""concat('{{"type":"{kind}","coordinates":', to_json({coordinates}), '}}')"""


def municipality_records(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """JSON records of municipalities, one per customer, with shapes of several types; ``more`` columns before."""
    key = "c_custkey"
    polygon = _geometry("Polygon", f"array({_line(key, 0, 1, 2, 0)})")
    several = _geometry(
        "MultiPolygon", f"array(array({_line(key, 0, 1, 2, 0)}), array({_line(key, 1, 2, 3, 1)}, {_line(key, 3, 0, 3)}))"
    )
    other = _geometry("Point", _point(key, 0))
    with_hole = _geometry("Polygon", f"array({_line(key, 0, 2, 3, 0)}, {_line(key, 1, 2, 1)})")
    center = f"to_json(named_struct('lat', {_point(key, 0)}[1], 'lon', {_point(key, 0)}[0]))"
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            *more,
            f"""concat('{{"prov_code":"', lpad(n_nationkey, 2, '0'), '","prov_name":"', n_name,
                '","geo_point_2d":', CASE WHEN {key} % 7 = 0 THEN 'null' ELSE {center} END,
                ',"geo_shape":', CASE WHEN {key} % 5 = 3 THEN 'null' ELSE concat('{{"geometry":',
                    CASE {key} % 5 WHEN 0 THEN {polygon} WHEN 1 THEN {several} WHEN 2 THEN {other}
                                   ELSE {with_hole} END, '}}') END, '}}') AS value"""
        )
    )


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = municipality_records(spark, sf_dir)
    return records.select(F.from_json("value", MUNICIPALITY).alias("m")).select("m.*")


def street_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON of street features, one per supplier, in a file per nation."""
    key = "s_suppkey"
    line = _geometry("LineString", _line(key, 0, 1, 2))
    lines = _geometry("MultiLineString", f"array({_line(key, 0, 1)}, {_line(key, 2, 3)})")
    other = _geometry("Point", _point(key, 0))
    collection = f"""concat('{{"features":[{{"geometry":',
        CASE {key} % 3 WHEN 0 THEN {line} WHEN 1 THEN {lines} ELSE {other} END, '}}]}}')"""
    return table(spark, sf_dir, "supplier").selectExpr("concat('city_', s_nationkey, '.json') AS name", f"{collection} AS value")


def streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = F.from_json("value", STREETS)["features"].alias("features")
    return street_records(spark, sf_dir).select(F.col("name").alias("file_name"), features)


def street_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities with a street file: every nation but each third."""
    nation = table(spark, sf_dir, "nation").filter("n_nationkey % 3 <> 0")
    return nation.selectExpr("n_name AS prov_name", "concat('city_', n_nationkey, '.json') AS file_name")
