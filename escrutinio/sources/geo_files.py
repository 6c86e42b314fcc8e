"""Coordinate files, municipality records and street geometries."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from escrutinio.schemas import COORDINATES_FILE, MUNICIPALITY, STREETS
from escrutinio.sources.json_arrays import read_array


def _file_name() -> Column:
    return F.col("_metadata.file_name")


def _points(files: DataFrame) -> DataFrame:
    """One row per coordinate; files with an empty or no list add none."""
    return files.select("prov_code", F.explode("coordinates").alias("coordinate"))


def coordinate_files(spark: SparkSession, path: str) -> DataFrame:
    """Points of files named ``<province code>.json``, each ``{"coordinates": [...]}``."""
    files = spark.read.schema(COORDINATES_FILE).option("multiLine", True).json(path, pathGlobFilter="*.json")
    return _points(files.select(F.regexp_replace(_file_name(), r"\.json$", "").alias("prov_code"), "coordinates"))


def coordinate_folders(spark: SparkSession, path: str) -> DataFrame:
    """Points of the folders ``prov_code=<code>`` written by ``sinks.coordinates``."""
    schema = StructType([*COORDINATES_FILE.fields, StructField("prov_code", StringType(), True)])
    return _points(spark.read.schema(schema).json(path))


def municipalities(spark: SparkSession, path: str, lines: bool = False, split: bool = False) -> DataFrame:
    """Municipality records of JSON files.

    A file that is one JSON array is read by one task, whatever its size; with ``split`` by as
    many as its bytes ask for, see ``json_arrays``. With ``lines`` the files hold one record per
    line and are split.
    """
    if split and not lines:
        return read_array(spark, path, MUNICIPALITY)
    return spark.read.schema(MUNICIPALITY).option("multiLine", not lines).json(path)


def streets(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Street features of GeoJSON files, one city per file, with the ``file_name``.

    A file is one row of one task; with ``lines`` it holds a feature collection per line and
    is split.
    """
    files = spark.read.schema(STREETS).option("multiLine", not lines).json(path)
    return files.select(_file_name().alias("file_name"), "features")


def street_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Province name to file name, from one JSON object ``{"name": "file", ...}``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("prov_name", "file_name"))
