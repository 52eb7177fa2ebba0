"""Run one load as a Spark job.

    python -m millrace --spec config/orders.json --base /lake --full-load true
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from . import LoadOptions, LoadResult, load_spec, run_load


def _flag(text: str) -> bool:
    return text.strip().lower() == "true"


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace", description="Run one load.")
    parser.add_argument("--spec", required=True, help="JSON specification, on any file system")
    parser.add_argument("--base", required=True, help="folder that receives all outputs")
    parser.add_argument("--dataset", help="dataset name; by default the specification's")
    parser.add_argument("--sys-level", default="dev")
    parser.add_argument("--full-load", type=_flag, default=False, metavar="true|false")
    parser.add_argument("--mask", action="store_true")
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--rejects-by-hour", action="store_true")
    parser.add_argument("--rejects-table", metavar="DATABASE.TABLE")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> LoadResult:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    spec = load_spec(spark, args.spec)
    if args.dataset:
        spec = replace(spec, name=args.dataset)
    options = LoadOptions(
        full_load=args.full_load,
        sys_level=args.sys_level,
        mask=args.mask,
        strict=args.strict,
        rejects_by_hour=args.rejects_by_hour,
        rejects_table=tuple(args.rejects_table.split(".", 1)) if args.rejects_table else None,
    )
    return run_load(spark, spec, args.base, options)


if __name__ == "__main__":
    main()
