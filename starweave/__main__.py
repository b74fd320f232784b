"""Run the job: ``spark-submit --py-files ... -m starweave`` or ``python -m starweave``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from starweave.plans.etl import EtlConfig, run
from starweave.session import spark_session


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starweave", description="Raw CSV to a checked star.")
    parser.add_argument("input_root", help="folder of the raw tables, any Hadoop path")
    parser.add_argument("stage_root", help="folder for the staged Parquet tables")
    parser.add_argument("database", help="catalog database of the warehouse tables")
    parser.add_argument("--database-location")
    parser.add_argument("--run-date", help="yyyymmdd, default today")
    parser.add_argument("--load-days", default="run", help="run, latest, all, incremental or yyyymmdd")
    parser.add_argument("--newest", action="store_true", help="of each key what the last day says")
    parser.add_argument("--mode", choices=["replace", "append"], default="replace")
    parser.add_argument("--prefix-len", type=int, help="cut match ids in keys, default whole")
    parser.add_argument("--keys", choices=["whole", "plain"], help="default whole, plain with a prefix")
    parser.add_argument("--buckets", type=int, help="default by the staged bytes, 0 for none")
    parser.add_argument("--most-facts", type=int, help="stop if the fact would have more rows")
    parser.add_argument("--strict-keys", action="store_true", help="merged keys are an error")
    parser.add_argument("--kills-without-header", action="store_true")
    parser.add_argument("--stats-columns", help="names, joined by commas, if there is no header")
    parser.add_argument("--max-records-per-file", type=int, default=0)
    parser.add_argument("--ids", choices=["monotonic", "dense"], default="monotonic")
    parser.add_argument("--infer-stats", action="store_true")
    parser.add_argument("--plain-days", action="store_true", help="day folders without a name")
    args = parser.parse_args(argv)
    config = EtlConfig(
        input_root=args.input_root,
        stage_root=args.stage_root,
        database=args.database,
        database_location=args.database_location,
        prefix_len=args.prefix_len or None,
        strict_keys=args.strict_keys,
        keys=args.keys,
        buckets=args.buckets,
        most_facts=args.most_facts,
        newest=args.newest,
        mode=args.mode,
        header=not args.kills_without_header,
        stats_columns=tuple(filter(None, (args.stats_columns or "").split(","))),
        max_records_per_file=args.max_records_per_file,
        ids=args.ids,
        infer_stats=args.infer_stats,
        named_days=not args.plain_days,
        load_days=args.load_days,
    )
    session = spark or spark_session("starweave")
    try:
        run(session, config, args.run_date)
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    main()
