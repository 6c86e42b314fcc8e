"""Build the coordinate files: ``spark-submit .../jobs/coordinates.py --municipalities FILE --output DIR``."""

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from escrutinio.operators.geometry import build_coordinates
from escrutinio.sinks.coordinates import write_coordinates
from escrutinio.sources import geo_files


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Coordinates per province from municipality and street geometries.")
    parser.add_argument("--municipalities", required=True)
    parser.add_argument("--lines", action="store_true", help="municipalities are JSON lines, not one array")
    parser.add_argument("--split", action="store_true", help="read an array of municipalities by many tasks")
    parser.add_argument("--street-lines", action="store_true", help="street files hold a feature collection per line")
    parser.add_argument("--streets", help="folder of GeoJSON files, one per city")
    parser.add_argument("--mapping", help="JSON object of province name to street file")
    parser.add_argument("--output", required=True)
    parser.add_argument("--chunk-size", type=int, default=10_000)
    args = parser.parse_args(argv)
    if bool(args.streets) != bool(args.mapping):
        parser.error("--streets and --mapping go together")
    spark = SparkSession.builder.appName("coordinates").getOrCreate()
    streets = geo_files.streets(spark, args.streets, args.street_lines) if args.streets else None
    mapping = geo_files.street_mapping(spark, args.mapping) if args.mapping else None
    points = build_coordinates(geo_files.municipalities(spark, args.municipalities, args.lines, args.split), streets, mapping)
    write_coordinates(points, args.output, args.chunk_size)


if __name__ == "__main__":
    main()
