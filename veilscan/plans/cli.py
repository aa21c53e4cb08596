"""Command line: python -m veilscan.plans.cli --input-dir DIR (--output-dir DIR | --run-dir DIR) [...].  Exit codes: 0, 1 failed, 2 no such input, 130 stopped."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..operators.routing import include_list
from ..session import ship
from ..sources import files
from . import pipeline


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Find personal data in files and rate the risk of leaks.")
    p.add_argument("--input-dir", required=True, help="folder that is scanned")
    where = p.add_mutually_exclusive_group(required=True)
    where.add_argument("--output-dir", help="results of one pass")
    where.add_argument("--run-dir", help="results of both passes: the files, then their texts again")
    p.add_argument("--include-list", help="text file of relative paths, one a line")
    p.add_argument("--max-file-size-mb", type=float, default=100.0)
    p.add_argument("--max-rows", type=int, default=50_000, help="rows of a table")
    p.add_argument("--ocr", dest="ocr", action="store_true", default=True)
    p.add_argument("--no-ocr", dest="ocr", action="store_false")
    p.add_argument("--texts-dir", help="score the texts in this folder again, with --input-dir as their originals")
    p.add_argument("--workers", type=int, help="shuffle partitions; Spark decides on cores")
    p.add_argument("--pdf-workers", type=int, help="taken and not needed: Spark spreads all files alike")
    p.add_argument("--file-timeout", type=float, default=600.0, help="seconds for one file, 0 for no limit")
    p.add_argument("--tables-only", action="store_true", help="no text and findings file for each file, only tables")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    spark = SparkSession.builder.appName("veilscan").getOrCreate()
    ship(spark)
    if a.workers:
        spark.conf.set("spark.sql.shuffle.partitions", str(max(1, a.workers)))
    there = spark._jvm.org.apache.hadoop.fs.Path(a.input_dir)
    store = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(there) or not store.getFileStatus(there).isDirectory():
        print(f"no such folder: {a.input_dir}", file=sys.stderr)
        return 2
    try:
        if a.texts_dir:
            pipeline.rerun(spark, files.text_files(spark, a.texts_dir), a.input_dir, a.output_dir or f"{a.run_dir}/final")
            return 0
        include = include_list(spark.read.text(a.include_list)) if a.include_list else None
        options = {"include": include, "limit_mb": a.max_file_size_mb, "max_rows": a.max_rows, "use_ocr": a.ocr, "timeout": max(0.0, a.file_timeout), "per_file": not a.tables_only}
        if a.run_dir:
            pipeline.both(spark, a.input_dir, a.run_dir, **options)
        else:
            pipeline.run(spark, a.input_dir, a.output_dir, **options)
    except KeyboardInterrupt:
        return 130
    except Exception as e:  # noqa: BLE001 - a failed run is an exit code
        print(f"failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
