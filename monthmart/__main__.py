"""python -m monthmart FOLDER PATH: load the workbooks of a folder into the mart at a path.

Exit 0: loaded, all checks passed; 1: no rows; 2: loaded, some checks fail; 3: refused by a constraint, 4: another load came first; the mart is as
before.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.mart import ConstraintError, load_folder
from .plans.versions import ConcurrentLoadError
from .sources import inventory


def main() -> int:
    parser = argparse.ArgumentParser(prog="monthmart", description=__doc__)
    parser.add_argument("folder", help="folder with the workbook files")
    parser.add_argument("path", help="where cache and tables are kept, on storage all executors share")
    parser.add_argument("--publish", nargs="?", const="", help="name the tables in the catalogue, with this prefix")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("monthmart").getOrCreate()
    try:
        mart, report = load_folder(spark, args.folder, args.path)
    except ConstraintError as broken:
        print(f"load refused: {broken}", file=sys.stderr)
        return 3
    except ConcurrentLoadError as second:
        print(f"load refused: {second}", file=sys.stderr)
        return 4
    if report is not None:
        report.filter("status != 'ok' OR sem_grupo > 0").show(1000, truncate=False)
    if mart is None:
        print("no rows to load", file=sys.stderr)
        return 1
    if args.publish is not None:
        mart.publish(args.publish)
    inventory(spark, mart.create_views()).show(truncate=False)
    checks = mart.checks()
    checks.show(checks.count(), truncate=False)
    return 2 if checks.filter("should_error").head() else 0


if __name__ == "__main__":
    sys.exit(main())
