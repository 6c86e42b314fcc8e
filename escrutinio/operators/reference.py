"""Regions, provinces and parties: the dimensions around the votes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.operators.joins import broadcast_if_small
from escrutinio.operators.positions import chunked_lists

# Column names of the relational source tables.
PROVINCE_COLUMNS = {
    "id": "id",
    "codigo_provincia": "province_code",
    "nombre": "province_name",
    "nombre_alternativo": "province_alternative_name",
    "codigo_comunidad": "region_code",
    "total_diputados": "total_seats",
    "latitud": "latitude",
    "longitud": "longitude",
    "habitantes": "population",
    "iso_3166_2_prov": "province_iso_code",
}
REGION_COLUMNS = {
    "codigo_comunidad": "region_code",
    "nombre": "region_name",
    "nombre_alternativo": "region_alternative_name",
    "numero_senadores": "senators",
    "iso_3166_2_ccaa": "region_iso_code",
}

# The parties on the ballot and their popularity.
POLITICAL_PARTIES = [
    ("Gato Unido", 1850),
    ("Perro Liberal", 2000),
    ("Tiburon Popular", 1800),
    ("Oso Nacional", 1500),
    ("Conejo Federal", 1000),
    ("Lechuga Verde", 850),
    ("Frente Popular Judias Verdes", 3500),
    ("Pepino Social", 2300),
    ("Coalicion Cebollon", 2500),
    ("Sandia Democractica", 1300),
]


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(source).alias(name) for source, name in names.items()))


def provinces_model(provincias: DataFrame) -> DataFrame:
    """Provinces as stored in the relational source, under our names."""
    return _renamed(provincias, PROVINCE_COLUMNS)


def regions_model(comunidades: DataFrame) -> DataFrame:
    """Autonomous regions as stored in the relational source, under our names."""
    return _renamed(comunidades, REGION_COLUMNS)


def political_parties(spark: SparkSession) -> DataFrame:
    """The parties on the ballot with their popularity."""
    values = ", ".join(f"('{name}', {popularity})" for name, popularity in POLITICAL_PARTIES)
    return spark.sql(f"select name, cast(popularity as bigint) as popularity from values {values} as t(name, popularity)")


def provinces_with_region(regions: DataFrame, provinces: DataFrame) -> DataFrame:
    """Provinces with the names of their region; provinces of an unknown region drop out."""
    return provinces.join(regions, "region_code")


def seats_by_province(regions: DataFrame, provinces: DataFrame) -> DataFrame:
    """The seats reference of the allocation."""
    return provinces_with_region(regions, provinces).select(
        "province_name", F.col("total_seats").cast("bigint").alias("total_seats")
    )


def region_seats(regions: DataFrame, provinces: DataFrame) -> DataFrame:
    """Regions with the number of their provinces and seats; 0 for a region without any."""
    totals = provinces.groupBy("region_code").agg(
        F.sum("total_seats").alias("total_seats"), F.count("*").alias("province_count")
    )
    return regions.join(totals, "region_code", "left").select(
        *regions.columns,
        F.coalesce("total_seats", F.lit(0)).cast("bigint").alias("total_seats"),
        F.coalesce("province_count", F.lit(0)).cast("bigint").alias("province_count"),
    )


def region_tree(regions: DataFrame, provinces: DataFrame, chunk_size: int = 10_000) -> DataFrame:
    """Regions with the list of their provinces, ordered by id.

    One row per region, with chunk 0, as long as it has at most ``chunk_size`` provinces;
    beyond that the list continues in chunks 1, 2, ... A region without provinces has an
    empty list.
    """
    lists = chunked_lists(
        provinces, ["region_code"], F.struct("id", *(c for c in provinces.columns if c not in ("id", "region_code"))),
        "id", "provinces", chunk_size,
    )
    empty = F.array().cast(lists.schema["provinces"].dataType)
    return (
        region_seats(regions, provinces)
        .join(lists, "region_code", "left")
        .withColumn("chunk", F.coalesce("chunk", F.lit(0)).cast("bigint"))
        .withColumn("provinces", F.coalesce("provinces", empty))
    )


def province_lookup_table(regions: DataFrame, provinces: DataFrame) -> DataFrame:
    """Province name to region name and ISO code; of provinces with one name the last
    (by region, then id) wins."""
    return (
        provinces_with_region(regions, provinces)
        .groupBy("province_name")
        .agg(F.max(F.struct("region_code", "id", "region_name", "region_iso_code")).alias("last"))
        .select("province_name", "last.region_name", "last.region_iso_code")
    )


def province_lookup(votes: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add the region of each vote's province; NULL where the province is unknown.

    The lookup is broadcast once its size is known to be small, so votes are not shuffled
    by a province that may hold a large share of them.
    """
    names = lookup.select(
        "province_name",
        F.col("region_name").alias("autonomic_region_name"),
        F.col("region_iso_code").alias("autonomic_region_iso_code"),
    )
    kept = votes.drop("autonomic_region_name", "autonomic_region_iso_code")
    return kept.join(broadcast_if_small(names), "province_name", "left")


def population_weights(provinces: DataFrame, scale: int = 1000) -> DataFrame:
    """Integer weight of each province: its share of the population in thousandths,
    truncated, at least 1."""
    total: Column = provinces.agg(F.sum("population")).scalar()
    share = F.try_divide(F.col("population"), total) * scale
    return provinces.withColumn(
        "weight", F.greatest(F.lit(1).cast("bigint"), F.coalesce(share.cast("bigint"), F.lit(1).cast("bigint")))
    )


def weight_expansion(weighted: DataFrame, weight: str = "weight") -> DataFrame:
    """Repeat each row ``weight`` times, numbered from 1 in ``slot``."""
    slots = F.when(F.col(weight) >= 1, F.sequence(F.lit(1).cast("bigint"), F.col(weight).cast("bigint")))
    return weighted.withColumn("slot", F.explode(slots))
