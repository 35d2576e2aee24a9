"""spark-submit entry: ``spark-submit --py-files ... scholarlake/__main__.py -i IN -o OUT``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from scholarlake import ENTITIES, RunReport, run
from scholarlake.sources.snapshot import FILE_PATTERN


def main(argv: list[str] | None = None) -> RunReport:
    parser = argparse.ArgumentParser(prog="scholarlake", description=__doc__)
    parser.add_argument("-i", "--input-dir", required=True, help="snapshot directory")
    parser.add_argument("-o", "--output-dir", required=True, help="shared by all executors")
    parser.add_argument("-e", "--entities", default=",".join(ENTITIES), help="comma-separated")
    parser.add_argument(
        "-f", "--files-per-entity", type=int, default=0, help="first N files only (0: all)"
    )
    parser.add_argument("--pattern", default=FILE_PATTERN, help="files below an entity's folder")
    parser.add_argument("--stage-dir", help="shared folder for intermediate tables")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("scholarlake").getOrCreate()
    report = run(
        spark,
        args.input_dir,
        args.output_dir,
        args.entities.split(","),
        args.files_per_entity,
        args.pattern,
        stage_dir=args.stage_dir,
    )
    for line in report.lines():
        print(line)
    return report


if __name__ == "__main__":
    main()
