"""Command line: ``python -m convoy {deliveries,fleet,compare} --root DIR`` with the input files
(``--orders``, ``--telemetry``) or a testdata folder (``--sf-dir``).

Runs the end-to-end jobs and prints the written paths (or the comparison timings) as JSON.  The
session is the caller's or the one spark-submit configures; without either, a local one.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from convoy.plans import publish
from convoy.plans.registry import AS_OF
from convoy.session import checkpoint_root
from convoy.sources import fixtures as fx


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="convoy")
    ap.add_argument("job", choices=["deliveries", "fleet", "compare"])
    ap.add_argument("--orders", help="orders CSV")
    ap.add_argument("--telemetry", help="telemetry CSV (deliveries) or JSON (fleet)")
    ap.add_argument("--json-array", action="store_true", help="each telemetry JSON file holds one array of records")
    ap.add_argument("--sf-dir", help="testdata folder to derive the inputs from, instead of files")
    ap.add_argument("--root", required=True, help="folder for the published tables (shared storage)")
    ap.add_argument("--as-of", default=AS_OF)
    a = ap.parse_args(argv)
    if not a.sf_dir and not (a.orders and a.telemetry):
        ap.error("name --orders and --telemetry, or --sf-dir")
    spark = SparkSession.builder.appName("convoy").getOrCreate()
    checkpoint_root(spark)
    if a.job == "compare" and not a.sf_dir:
        out = publish.compare_files(spark, a.orders, a.telemetry, a.root, a.as_of)
    elif a.job == "compare":
        out = publish.compare(spark, fx.shipments(spark, a.sf_dir), fx.telemetry(spark, a.sf_dir), a.root, a.as_of)
    elif a.job == "deliveries" and a.sf_dir:
        out = publish.publish_deliveries(spark, fx.shipments(spark, a.sf_dir), fx.telemetry(spark, a.sf_dir), a.root)
    elif a.job == "deliveries":
        out = publish.deliveries_from_files(spark, a.orders, a.telemetry, a.root)
    elif a.sf_dir:
        out = publish.publish_fleet(spark, fx.parcels(spark, a.sf_dir), fx.samples(spark, a.sf_dir), a.root)
    else:
        out = publish.fleet_from_files(spark, a.orders, a.telemetry, a.root, a.json_array)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
