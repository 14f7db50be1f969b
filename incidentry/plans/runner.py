"""Run a group of reports from the command line::

    spark-submit run_reports.py time --input s3a://bucket/clean --output s3a://bucket/results \\
        --population population.csv --election election.csv

Master, memory and credentials come from spark-submit; none are set here.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..contract import INCIDENT_SCHEMA, POPULATION_SCHEMA
from ..sources.models import save_model
from ..sources.rollups import YearlyRollups
from ..sources.tables import load_result, read_csv, read_table, replace_result, save_result
from ..sources.workspace import stage, staging
from .address import address_reports
from .clean import clean_incidents, cleaning_reports, write_by_year
from .prediction import rebalanced_reports, severity_reports
from .roadside import roadside_reports
from .time import time_reports
from .weather import weather_reports

# One row per accident: never squeezed into a single file.
ROW_LEVEL = {
    "most_day_city_weather", "WeatherDensity", "dtPrediction", "PredResults_overunder",
}


def load_incidents(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, INCIDENT_SCHEMA)
    return read_table(spark, path, fmt)


def write_reports(reports: dict[str, DataFrame], root: str, fmt: str) -> None:
    for name, df in reports.items():
        replace_result(df, root, name, fmt, single_file=name not in ROW_LEVEL)


def _dimension(spark: SparkSession, path: str, fmt: str, schema=None) -> DataFrame:
    """A CSV file, or a stored table with the same columns."""
    return read_csv(spark, path, schema) if fmt == "csv" else read_table(spark, path, fmt)


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="run_reports")
    parser.add_argument(
        "job",
        choices=[
            "clean", "time", "address", "roadside", "weather",
            "severity-raw", "severity", "rebalanced",
        ],
    )
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--input-format", default="parquet")
    parser.add_argument("--output-format", default="parquet")
    parser.add_argument("--population", help="CSV with columns state, pop")
    parser.add_argument("--election", help="CSV with columns state, color")
    parser.add_argument("--years", type=int, nargs="+", default=[2017, 2018, 2019])
    parser.add_argument("--cutoff-year", type=int, default=2020)
    parser.add_argument("--day", default="2019-12-23", help="time: the day that is looked into")
    parser.add_argument("--city", default="Los Angeles", help="time: its city")
    parser.add_argument(
        "--bands", type=float, nargs=4, default=[40.0, 35.0, 37.0, 30.0], metavar="LATITUDE",
        help="time: northern and southern limit of the comparison, and of the bands on their own",
    )
    parser.add_argument("--dimension-format", default="csv", help="format of --population and --election")
    parser.add_argument(
        "--unsorted", action="store_true", help="clean: leave a year's small files as they are written"
    )
    parser.add_argument(
        "--class-weights", action="store_true", help="rebalanced: weigh the training rows instead of copying them"
    )
    parser.add_argument(
        "--rollups", help="time, address, roadside: keep roll-ups by year here, and read only years that changed since"
    )
    args = parser.parse_args(argv)
    if args.rollups and (args.input_format != "parquet" or args.job not in ("time", "address", "roadside")):
        parser.error("--rollups needs the parquet table of the clean job, and a job that has roll-ups")
    with staging(spark):
        _run(spark, parser, args)


def _run(spark: SparkSession, parser: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    incidents = load_incidents(spark, args.input, args.input_format)

    kept = YearlyRollups(spark, args.input, args.rollups) if args.rollups else None

    if args.job == "clean":
        cleaned = clean_incidents(incidents)
        if args.output_format == "parquet":
            write_by_year(cleaned, f"{args.output}/incidents", compact=not args.unsorted)
            # what was stored is counted, not computed once more
            cleaned = load_result(spark, args.output, "incidents").select(*incidents.columns)
        else:
            save_result(cleaned, args.output, "incidents", args.output_format)
        reports = cleaning_reports(incidents, cleaned)
    elif args.job == "time":
        if not (args.population and args.election):
            parser.error("time needs --population and --election")
        reports = time_reports(
            incidents,
            _dimension(spark, args.population, args.dimension_format, POPULATION_SCHEMA),
            _dimension(spark, args.election, args.dimension_format),
            args.years, (args.day, args.city), (tuple(args.bands[:2]), tuple(args.bands[2:])), stage, kept,
        )
    elif args.job == "address":
        if not args.population:
            parser.error("address needs --population")
        population = _dimension(spark, args.population, args.dimension_format, POPULATION_SCHEMA)
        reports = address_reports(incidents, population, args.cutoff_year, stage, kept)
    elif args.job == "roadside":
        reports = roadside_reports(incidents, args.cutoff_year, stage, kept)
    elif args.job == "weather":
        reports = weather_reports(incidents, args.cutoff_year, stage)
    else:
        if args.job == "rebalanced":
            model, reports = rebalanced_reports(
                incidents, args.cutoff_year, weight="weight" if args.class_weights else None
            )
        else:
            sampled = args.job == "severity"
            model, reports = severity_reports(incidents, args.cutoff_year, sampled=sampled)
        save_model(model, f"{args.output}/{args.job}_model")
    write_reports(reports, args.output, args.output_format)
