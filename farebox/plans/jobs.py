"""Batch job: input directory -> typed trips -> marts -> exported files.

``python -m farebox build --input DIR --output DIR`` (or through
``spark-submit``) replaces the four one-reducer jobs and the SQL session:
one application, one shared aggregation pass for all marts (or one plan per
mart over a table typed and staged once), and one sorted output file per mart, each written with overwrite semantics."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from farebox import schema as S
from farebox.plans import catalog as CAT
from farebox.plans import shared as SH
from farebox.plans import storage as ST
from farebox.session import ensure_checkpoint_dir, remove_folder, scratch_path
from farebox.sources import text as TX


def load_input(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    if fmt == "csv":
        return TX.read_trips_text(spark, path, **options)
    if fmt == "parquet":
        return TX.read_trips_parquet(spark, path)
    raise ValueError(f"unknown input format: {fmt!r}")


def build(spark: SparkSession, input_path: str, output: str, *, input_format: str = "csv",
          fmt: str = "tsv", marts: list[str] | None = None, weekly_year: int = S.WEEKLY_YEAR,
          stage: bool | None = None, shared: bool = True, rounding: str = "sql", publish: bool = False,
          **options) -> dict[str, str]:
    """Build and export the marts; returns mart name -> output path.
    By default the marts come from one shared pass over the input, limited to
    what ``marts`` needs.  ``shared=False`` gives each mart a plan of its own;
    the input is then parsed once into a staged table unless ``stage`` says
    otherwise.  ``publish`` writes a new version and points readers to it when
    all marts are there (``sinks.publish``).  Intermediate tables are removed after the export."""
    names = marts or CAT.SERVED
    if unknown := set(names) - set(CAT.MartCatalog.NAMES):
        raise CAT.UnknownMart(f"unknown datasets: {sorted(unknown)}")
    ensure_checkpoint_dir(spark)
    scratch = scratch_path(spark, "build")
    try:
        staged = stage if stage is not None else not shared
        if staged and input_format == "csv":
            options.setdefault("text_rules", True)   # each field is typed once
        trips = load_input(spark, input_path, input_format, **options)
        if staged:
            trips = ST.stage_trips(spark, trips, f"{scratch}/trips")
        prebuilt = None
        if shared:
            needed = set(names) | (set(CAT.KPI_INPUTS) if "kpi_summary" in names else set())
            made = SH.shared_marts(trips, materialize=f"{scratch}/groups", weekly_year=weekly_year,
                                   rounding=rounding, only=needed)
            made["od_flows"] = made["od_flows_top20"]  # the catalogue serves the top-20 flows
            prebuilt = {n: df for n, df in made.items() if n in needed}
        cat = CAT.MartCatalog(trips, weekly_year=weekly_year, marts=prebuilt, rounding=rounding)
        if publish:
            folder = cat.publish(output, fmt, names)
            return {n: f"{folder}/{n}" for n in names}
        return cat.export_all(output, fmt, names=names)
    finally:
        remove_folder(spark, scratch)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="farebox")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build and export the marts")
    b.add_argument("--input", required=True)
    b.add_argument("--input-format", default="csv", choices=["csv", "parquet"])
    b.add_argument("--output", required=True)
    b.add_argument("--format", default="tsv", choices=["tsv", "csv", "json"])
    b.add_argument("--marts", default="", help="comma-separated subset of the served marts")
    b.add_argument("--weekly-year", type=int, default=S.WEEKLY_YEAR)
    b.add_argument("--stage", action=argparse.BooleanOptionalAction, default=None,
                   help="write typed Parquet first (default: only with --per-mart)")
    b.add_argument("--per-mart", action="store_true", help="one plan per mart, no shared pass")
    b.add_argument("--rounding", default="sql", choices=["sql", "python"],
                   help="python: round the Python-computed marts as Python's :.2f does")
    b.add_argument("--publish", action="store_true", help="write a new version, then point readers to it")
    b.add_argument("--multi-line", action="store_true", help="quoted fields may hold line ends; a file is then one task")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName("farebox-build").getOrCreate()
    out = build(spark, args.input, args.output, input_format=args.input_format, fmt=args.format,
                marts=[m for m in args.marts.split(",") if m] or None,
                weekly_year=args.weekly_year, stage=args.stage, shared=not args.per_mart,
                rounding=args.rounding, publish=args.publish, **({"multi_line": True} if args.multi_line else {}))
    print(json.dumps(out))


if __name__ == "__main__":
    main()
