"""Publish marts as a Spark application.

    python -m martloom --input s3a://raw --output s3a://marts

or ``spark-submit --py-files martloom.zip martloom/__main__.py`` with the same arguments.
Master, memory, credentials and packages come from the deployer's Spark configuration.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession

from martloom.plans.marts import MARTS
from martloom.plans.run import RETAIN_SECONDS, run_marts


def _option(kind: type) -> Callable[[str], object]:
    """One value, or several by name as in ``a=1,b=2``."""

    def parse(text: str) -> object:
        if "=" not in text:
            return kind(text)
        pairs = (part.split("=", 1) for part in text.split(","))
        return {name.strip(): kind(value) for name, value in pairs}

    return parse


def _bytes(mb: int | dict[str, int] | None) -> int | dict[str, int] | None:
    if isinstance(mb, dict):
        return {mart: _bytes(n) for mart, n in mb.items()}
    return None if mb is None else mb << 20


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="martloom", description="Publish data marts.")
    parser.add_argument("--input", required=True, help="folder with one parquet table each")
    parser.add_argument("--output", required=True, help="folder for the <mart>_report folders")
    parser.add_argument("--marts", default=",".join(MARTS), help="comma-separated names")
    parser.add_argument("--suffix", default="", help="after table names, e.g. .parquet")
    parser.add_argument("--database", help="catalog database of the served tables")
    parser.add_argument("--no-register", action="store_true", help="write files only")
    parser.add_argument("--layout", choices=("runs", "flat"), help="a folder per run, or one")
    parser.add_argument(
        "--scale", type=_option(int), help="decimals for exact sums: 2, or o_totalprice=2,l_tax=4"
    )
    parser.add_argument(
        "--order", type=_option(str), help="global, file or none, or by mart: orders=none"
    )
    parser.add_argument(
        "--num-files", type=_option(int), help="at most so many files, or by mart: orders=4,parts=8"
    )
    parser.add_argument(
        "--file-mb", type=_option(int), help="size of files in MB, or by mart: lineitems=512"
    )
    parser.add_argument(
        "--retain-seconds", type=float, default=RETAIN_SECONDS, help="how long replaced runs stay"
    )
    parser.add_argument("--shuffle-partitions", type=int, help="largest shuffle / 128 MB")
    parser.add_argument("--concurrent", type=int, help="marts at the same time, default all")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("martloom").getOrCreate()
    statuses = run_marts(
        spark,
        args.input,
        args.output,
        marts=args.marts.split(","),
        suffix=args.suffix,
        database=args.database,
        register=not args.no_register,
        layout=args.layout,
        scale=args.scale,
        order=args.order,
        num_files=args.num_files,
        file_bytes=_bytes(args.file_mb),
        retain_seconds=args.retain_seconds,
        shuffle_partitions=args.shuffle_partitions,
        concurrent=args.concurrent,
    )
    for status in statuses:
        outcome = status.table or status.path if status.published else status.error
        state = "published" if status.published else "failed"
        print(f"{status.mart}: {state} in {status.seconds:.1f} s: {outcome}")
    return 0 if all(s.published for s in statuses) else 1


if __name__ == "__main__":
    sys.exit(main())
