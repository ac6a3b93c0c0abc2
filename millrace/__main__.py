"""`spark-submit … -m millrace -input <config>`: run a loading job."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .spec import JobSpec
from .streaming.ingest import Ingest


def read_config(spark: SparkSession, given: str) -> str:
    """Inline JSON, or the text of a file on any file system Spark reads."""
    if given.lstrip().startswith("{"):
        return given
    return spark.read.text(given, wholetext=True).first()["value"]


def main() -> None:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("-input", required=True, help="config: JSON text or the path of a file")
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    job = JobSpec.from_config(read_config(spark, parser.parse_args().input))
    Ingest(spark, job).run()


if __name__ == "__main__":
    main()
