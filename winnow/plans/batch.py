"""Batch entry point: load a table, clean it, write the rows and the report.

    spark-submit --py-files winnow.zip winnow/plans/batch.py --input in.csv --output out
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from winnow.plans.cleaning import Run, run_observed
from winnow.plans.config import Config, PRESETS, environment, preset
from winnow.plans.reports import report_table
from winnow.session import scratch_path
from winnow.sources.readers import load
from winnow.sources.sinks import write_csv, write_report


def batch_job(spark: SparkSession, source: str, output: str, cfg: Config | None = None,
              **options) -> Run:
    """Write ``output/data`` (CSV) and ``output/report`` (JSON lines).

    Fitting scans the table several times, so a text source is first written once as
    Parquet in the shared scratch folder; later scans read only the columns they need.
    Reports come from what is observed while the cleaned rows are written.
    ``options`` go to the reader.
    """
    cfg = cfg or Config()
    df = load(spark, source, **options)
    if not source.rstrip("/").endswith(".parquet"):
        staged = scratch_path(spark, "staged")
        df.write.parquet(staged)
        df = spark.read.parquet(staged)
    run = run_observed(df, lambda cleaned: write_csv(cleaned, f"{output}/data"), cfg)
    write_report(report_table(run.reports), f"{output}/report")
    return run


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Clean one table and report on its quality.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--environment", default="production")
    parser.add_argument("--preset", choices=sorted(PRESETS))
    parser.add_argument("--encoding", help="of a CSV source; told by its bytes otherwise")
    parser.add_argument("--schema", help="of a CSV or JSON source, as column definitions; inferred otherwise")
    parser.add_argument("--multi-line", action=argparse.BooleanOptionalAction, default=None,
                        help="line breaks inside CSV quotes; told by the quotes otherwise")
    args = parser.parse_args(argv)
    options = {k: v for k, v in (("encoding", args.encoding), ("schema", args.schema), ("multi_line", args.multi_line))
               if v is not None}
    spark = SparkSession.builder.appName("winnow").getOrCreate()
    batch_job(spark, args.input, args.output,
              preset(args.preset) if args.preset else environment(args.environment), **options)


if __name__ == "__main__":
    main()
