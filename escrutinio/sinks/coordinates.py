"""Coordinates of each province as JSON files."""

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from escrutinio.folders import names, remove_folder, rename
from escrutinio.operators.geometry import coordinate_chunks


def write_coordinates(points: DataFrame, path: str, chunk_size: int = 10_000) -> None:
    """Folders ``prov_code=<code>`` with lines ``{"chunk": n, "coordinates": [...]}``.

    The form for provinces of any size: their chunks are written, and read, by several tasks.
    """
    coordinate_chunks(points, chunk_size).write.mode("overwrite").partitionBy("prov_code").json(path)


def write_coordinate_files(points: DataFrame, path: str, chunk_size: int = 10_000) -> None:
    """Files ``<code>.json``, each ``{"coordinates": [...]}``, as ``coordinate_files`` reads them.

    A file is written by one task, chunk by chunk, so that its memory is bounded; its
    reader takes it as one row, for which reason very large provinces need the other form.
    """
    chunks = coordinate_chunks(points, chunk_size)
    last = F.col("chunk") == F.max("chunk").over(Window.partitionBy("prov_code"))
    items = F.expr("substring(to_json(coordinates), 2, length(to_json(coordinates)) - 2)")
    text = F.concat(
        F.when(F.col("chunk") == 0, '{"coordinates":[').otherwise(","), items, F.when(last, "]}").otherwise("")
    )
    lines = chunks.select(F.concat("prov_code", F.lit(".json")).alias("name"), "chunk", text.alias("value"))
    write_named_files(lines, path, "chunk")


def write_named_files(lines: DataFrame, path: str, order: str) -> None:
    """The lines ``value`` of each ``name`` in ``order``, as one text file of that name.

    The files are laid out in a folder of their own, which then takes the place of ``path``:
    files of an earlier run do not stay, and a run that fails leaves them as they are.
    """
    spark = lines.sparkSession
    staged = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    parts = f"{staged}/_parts"
    dealt = lines.repartition("name").sortWithinPartitions("name", order)
    # One file per name, whatever the session's limit of records is.
    dealt.select("name", "value").write.option("maxRecordsPerFile", 0).partitionBy("name").text(parts)
    for folder in names(spark, parts):  # one per file
        if folder.startswith("name="):
            (part,) = (n for n in names(spark, f"{parts}/{folder}") if n.startswith("part-"))
            rename(spark, f"{parts}/{folder}/{part}", f"{staged}/{folder.removeprefix('name=')}")
    remove_folder(spark, parts)
    remove_folder(spark, path)
    rename(spark, staged, path)
