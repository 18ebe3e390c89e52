"""Job entry points, as run by ``spark-submit`` (or ``python -m contrail.cli``).

    ingest      landed JSON -> bronze run (S13/S14)
    clean       every unmerged bronze run (or --run) -> stored SCD2 silver (I8)
    indicators  current part of silver -> indicator marts for one ``as_of`` (I1-I7, D1-D3)

Each command uses the session ``spark-submit`` provides (``getOrCreate``); all
paths and the ``as_of`` time are arguments, nothing is read from the clock.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from contrail.operators.dims import airline_country_dim, continent_dim
from contrail.plans import pipeline, views
from contrail.plans.jobs import silver_job
from contrail.session import ensure_checkpoint_dir
from contrail.sources.feeds import ingest_to_bronze, load_schema
from contrail.sources.scd2_table import read_scd2


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="contrail")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--landing", required=True)
    a.add_argument("--schema", required=True, help="StructType JSON file or text")
    a.add_argument("--bronze", required=True)
    a.add_argument("--as-of", required=True)
    a.add_argument("--files-per-run", type=int)
    c = sub.add_parser("clean")
    c.add_argument("--bronze", required=True)
    c.add_argument("--silver", required=True)
    c.add_argument("--run", type=int, help="extract_time of one bronze run")
    c.add_argument("--tracked", default="status_text,on_ground,estimated_arrival")
    i = sub.add_parser("indicators")
    i.add_argument("--silver", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--as-of", required=True)
    i.add_argument("--dims", required=True, help="folder with nation/region/supplier tables")
    i.add_argument("--names", help="comma-separated subset of indicators")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"contrail-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "ingest":
        run = ingest_to_bronze(spark, args.landing, load_schema(args.schema), args.bronze, args.as_of,
                               files_per_run=args.files_per_run)
        result = {"run": run}
    elif args.cmd == "clean":
        batch = silver_job(spark, args.bronze, args.silver, views.TIME_DETAIL_LEAVES, views.EPOCH_TEXT_COLUMNS,
                           args.tracked.split(","), run_id=args.run, tie_break=["airline_name", "aircraft_model"])
        result = {"batch": batch}
    else:
        dims = {"continents": continent_dim(views.read(spark, args.dims, "nation"),
                                            views.read(spark, args.dims, "region")),
                "airline_countries": airline_country_dim(views.read(spark, args.dims, "supplier"),
                                                           views.read(spark, args.dims, "nation"))}
        current_part = read_scd2(spark, args.silver, current_only=True).withColumnRenamed("time_updated",
                                                                                          "extract_ts")
        names = args.names.split(",") if args.names else None
        result = {"marts": pipeline.publish_indicators(current_part, args.as_of, args.out, dims, names)}
    print(json.dumps(result))
    return 0


if __name__ == "__main__":
    sys.exit(main())
