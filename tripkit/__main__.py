"""Command line: ``python -m tripkit --input trips.csv --base /shared/run``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tripkit.operators.prep import ENCODERS, SCALERS
from tripkit.plans.end_to_end import run


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripkit", description=__doc__)
    parser.add_argument("--input", nargs="+", required=True, help="trip CSVs, the first that exists is read")
    parser.add_argument("--weather", help="daily weather CSV")
    parser.add_argument("--base", required=True, help="shared folder for everything the run writes")
    parser.add_argument("--scaler", choices=SCALERS, default="standard")
    parser.add_argument("--encoder", choices=ENCODERS, default="ordinal")
    parser.add_argument("--skip-eda", action="store_true")
    parser.add_argument("--skip-train", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("tripkit").getOrCreate()
    result = run(
        spark, args.base, args.input, args.weather, args.scaler, args.encoder, args.skip_eda, args.skip_train
    )
    print(f"dataset {result.version}, rows {result.split_sizes}, {result.elapsed_sec} s")
    if result.comparison is not None:
        result.comparison.leaderboard.show(truncate=False)


if __name__ == "__main__":
    main()
