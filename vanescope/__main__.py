"""Jobs for spark-submit.

    layers SOURCE BASE   CSV directory to Bronze, Silver and Gold tables below BASE,
                         and to PostgreSQL when POSTGRES_DB is set
    hours SOURCE TARGET  weather documents to a flat Parquet table
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

from vanescope.plans.hours import hourly_table
from vanescope.plans.layers import RunConfig, run
from vanescope.sinks.files import write_parquet
from vanescope.sources.database import postgres_options


def main(args: list[str]) -> None:
    if len(args) != 3 or args[0] not in ("layers", "hours"):
        sys.exit(__doc__)
    job, source, target = args
    spark = SparkSession.builder.appName(f"vanescope-{job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if job == "layers":
        database = postgres_options() if "POSTGRES_DB" in os.environ else None
        run(spark, RunConfig(source=source, base=target, database=database))
    else:
        write_parquet(hourly_table(spark, source), target, sort_by=["time"])


if __name__ == "__main__":
    main(sys.argv[1:])
