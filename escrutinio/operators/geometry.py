"""Geometries of municipalities and streets flattened to coordinates per province.

Points stay one per row: the reference form, one list per province, is an unbounded group
and is only cut into files (``sinks.coordinates``) in bounded chunks.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from escrutinio.functions.geo import coordinate_text
from escrutinio.operators.positions import weighted_ranges

_POINT = "array<string>"
_LINE = f"array<{_POINT}>"
_LINES = f"array<{_LINE}>"
_POLYGONS = f"array<{_LINES}>"


def _points(geometry: Column, one_level: str | None, two_levels: str | None, three_levels: str | None) -> Column:
    """All points of a geometry, whose type tells how deep its coordinates nest."""
    kind, text = geometry["type"], geometry["coordinates"]
    points = F.array().cast(_LINE)
    if one_level:
        points = F.when(kind == one_level, F.from_json(text, _LINE)).otherwise(points)
    if two_levels:
        points = F.when(kind == two_levels, F.flatten(F.from_json(text, _LINES))).otherwise(points)
    if three_levels:
        points = F.when(kind == three_levels, F.flatten(F.flatten(F.from_json(text, _POLYGONS)))).otherwise(points)
    return points


def _shape(geometry: Column) -> Column:
    """Points of all rings, holes included, of Polygon and MultiPolygon; else none."""
    return _points(geometry, None, "Polygon", "MultiPolygon")


def _as_text(points: DataFrame) -> DataFrame:
    """[longitude, latitude] points as ``lat,lon`` text."""
    point = F.col("point")
    text = coordinate_text(F.get(point, F.lit(1)), F.get(point, F.lit(0)))
    return points.select(*(name for name in points.columns if name != "point"), text.alias("coordinate"))


def _municipality_points(municipalities: DataFrame) -> DataFrame:
    center = F.col("geo_point_2d")
    centers = F.when(center.isNotNull(), F.array(F.array(center["lon"], center["lat"])))
    none = F.array().cast(_LINE)
    points = F.concat(F.coalesce(centers, none), F.coalesce(_shape(F.col("geo_shape.geometry")), none))
    return municipalities.select("prov_code", F.explode(points).alias("point"))


def _street_points(streets: DataFrame) -> DataFrame:
    kept = [name for name in streets.columns if name != "features"]
    features = streets.select(*kept, F.explode("features").alias("feature"))
    points = _points(F.col("feature.geometry"), "LineString", "MultiLineString", None)
    return features.select(*kept, F.explode(points).alias("point"))


def municipality_points(municipalities: DataFrame) -> DataFrame:
    """The centre of each municipality that has one, and the points of its shape."""
    return _as_text(_municipality_points(municipalities))


def street_points(streets: DataFrame) -> DataFrame:
    """Points of LineString and MultiLineString features per file; other features have none."""
    return _as_text(_street_points(streets))


def build_coordinates(
    municipalities: DataFrame,
    streets: DataFrame | None = None,
    mapping: DataFrame | None = None,
    provinces: DataFrame | None = None,
) -> DataFrame:
    """Centres, shapes and city streets of each province as (prov_code, coordinate) rows.

    The streets are those of the city file that ``mapping`` gives for the ``prov_name``;
    provinces without a mapping or a file add none. Names come from ``provinces``
    (``province_code``, ``province_name``); without it the municipalities are read a second
    time for their codes and names, and a code with several names uses the greatest.
    Repeated points stay: ring ends repeat, and copies act as weights of a draw.

    Files are matched before their features are parsed, so that a file of no province costs
    nothing more and no point is shuffled by its file.
    """
    points = _municipality_points(municipalities)
    if streets is not None and mapping is not None:
        if provinces is None:
            names = municipalities.groupBy("prov_code").agg(F.max("prov_name").alias("prov_name"))
        else:
            names = provinces.select(F.col("province_code").alias("prov_code"), F.col("province_name").alias("prov_name"))
        files = names.join(mapping, "prov_name").select("prov_code", "file_name")
        matched = streets.join(files, "file_name").select("prov_code", "features")
        points = points.unionByName(_street_points(matched))
    return _as_text(points)


def coordinate_chunks(points: DataFrame, chunk_size: int = 10_000) -> DataFrame:
    """Coordinates of each province, copies kept, as lists of at most ``chunk_size``.

    Each distinct coordinate holds a range of positions; a chunk holds the positions
    [chunk * chunk_size, (chunk + 1) * chunk_size). A coordinate with very many copies
    spans several chunks, so no list is longer than ``chunk_size``.
    """
    size = F.lit(chunk_size).cast("bigint")
    first, last = F.expr(f"lo div {chunk_size}"), F.expr(f"(hi - 1) div {chunk_size}")
    spans = weighted_ranges(points, ["prov_code"], "coordinate", F.lit(1)).withColumn(
        "chunk", F.explode(F.sequence(first, last))
    )
    start = F.greatest(F.col("lo"), F.col("chunk") * size)
    copies = F.least(F.col("hi"), (F.col("chunk") + 1) * size) - start
    entry = F.struct(start.alias("start"), F.array_repeat("coordinate", copies.cast("int")).alias("copies"))
    return (
        spans.groupBy("prov_code", "chunk")
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select("prov_code", "chunk", F.flatten(F.col("_entries.copies")).alias("coordinates"))
    )
