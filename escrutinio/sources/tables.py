"""Reference tables from a relational database or from files."""

from pyspark.sql import DataFrame, SparkSession

from escrutinio.operators.reference import provinces_model, regions_model

# Tables of the relational source.
PROVINCES_TABLE = "elecciones_es.provincias"
REGIONS_TABLE = "elecciones_es.comunidades_autonomas"


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> dict[str, str]:
    """Options of the JDBC source for a whole table or a query.

    ``split`` = (column, lower, upper, parts) reads a table in parallel by ranges of a
    numeric column; rows outside the bounds go to the outer parts.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    if split is not None and query is not None:
        raise ValueError("only a table can be split")
    source = {"dbtable": table} if table is not None else {"query": query}
    parts = {}
    if split is not None:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        parts = {name: str(value) for name, value in zip(names, split, strict=True)}
    return {"url": url, **source, **parts, **options}


def jdbc_table(spark: SparkSession, url: str, table: str | None = None, **options) -> DataFrame:
    """A table or query result of a database; its driver must be on the class path."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def reference_from_jdbc(
    spark: SparkSession,
    url: str,
    regions_split: tuple[str, int, int, int] | None = None,
    provinces_split: tuple[str, int, int, int] | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Regions and provinces of the database, under our names; each may be read in parallel by its own split."""
    regions = jdbc_table(spark, url, REGIONS_TABLE, split=regions_split, **options)
    provinces = jdbc_table(spark, url, PROVINCES_TABLE, split=provinces_split, **options)
    return regions_model(regions), provinces_model(provinces)


def reference_from_files(spark: SparkSession, regions_path: str, provinces_path: str) -> tuple[DataFrame, DataFrame]:
    """Regions and provinces exported to Parquet, under our names."""
    return regions_model(spark.read.parquet(regions_path)), provinces_model(spark.read.parquet(provinces_path))


def seats_from_rows(spark: SparkSession, rows: list[tuple[str, int]]) -> DataFrame:
    """A seats reference given in code as (province, seats) pairs."""
    return spark.createDataFrame(rows, "province_name string, total_seats bigint")
