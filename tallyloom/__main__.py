"""Command line: ``python -m tallyloom full --input retail.csv --output out --k 5``."""

from __future__ import annotations

import argparse
import json
from functools import partial

from pyspark.sql import SparkSession

from tallyloom.functions.staging import clear_stages
from tallyloom.plans.runs import preprocess_minimal, preprocess_modular, run_basic, run_full
from tallyloom.schema import MINIMAL_EXPORT_COLUMNS
from tallyloom.session import create_session
from tallyloom.sources.readers import read_transactions_csv
from tallyloom.sources.writers import export_csv, write_jdbc


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyloom")
    parser.add_argument("run", choices=["full", "basic", "preprocess", "preprocess-minimal"])
    parser.add_argument("--input", required=True, help="CSV file or folder of raw transaction lines")
    parser.add_argument("--output", required=True, help="folder for exports and the segment store")
    parser.add_argument("--k", type=int, help="number of clusters (default: 5, basic: 4)")
    parser.add_argument("--store", help="segment store to merge into (default: segments in the output folder)")
    parser.add_argument("--multi-line", action="store_true", help="quoted fields contain line breaks")
    parser.add_argument("--jdbc-url", help="database for the monthly aggregate")
    parser.add_argument("--jdbc-table", default="agg_sales_monthly")
    parser.add_argument("--jdbc-properties", help="JSON file with user, password, driver")
    args = parser.parse_args(argv)

    spark = create_session()
    try:
        _run(spark, args)
    finally:
        clear_stages(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    inferred = args.run.startswith("preprocess")
    raw = read_transactions_csv(spark, args.input, infer_schema=inferred, multi_line=args.multi_line)
    if args.run == "preprocess":
        export_csv(preprocess_modular(raw), f"{args.output}/preprocessed")
        return
    if args.run == "preprocess-minimal":
        export_csv(preprocess_minimal(raw), f"{args.output}/preprocessed", MINIMAL_EXPORT_COLUMNS)
        return

    # Stages stay in the work folder until the run is through: started again, a killed run goes on after the last one.
    sinks = {"store_path": args.store or f"{args.output}/segments", "work_path": f"{args.output}/_work", "inputs": args.input}
    if args.jdbc_url:
        with open(args.jdbc_properties, encoding="utf-8") as handle:
            properties = json.load(handle)
        sinks["monthly_sink"] = partial(
            write_jdbc, table=args.jdbc_table, url=args.jdbc_url, properties=properties
        )
    if args.run == "full":
        result = run_full(raw, args.k or 5, export_path=f"{args.output}/preprocessed", **sinks)
    else:
        result = run_basic(raw, args.k or 4, **sinks)
    result.log.discard()
    print(json.dumps({**result.stage_rows, "silhouette": result.clusters.silhouette, "sse": result.clusters.sse}))


if __name__ == "__main__":
    main()
