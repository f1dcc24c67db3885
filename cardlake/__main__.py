"""``python -m cardlake [--multiline] <root>``: run the whole pipeline below a root folder."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from cardlake.plans.pipeline import run_pipeline


def main(arguments: list[str]) -> int:
    multiline = "--multiline" in arguments
    arguments = [a for a in arguments if a != "--multiline"]
    if len(arguments) != 1:
        print("usage: python -m cardlake [--multiline] <root folder>", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("cardlake").getOrCreate()
    result = run_pipeline(spark, arguments[0], multiline=multiline)
    print(f"run {result['run_id']}: {result['status']}")
    print(f"bronze rows {result['bronze']['bronze_total_rows']}, "
          f"silver {result['silver']['silver_rows_written']}, "
          f"quarantine {result['silver']['quarantine_rows_written']}, "
          f"facts {result['gold']['transaction_rows_written']}")
    print(f"platform KPIs {result['analytics']['platform_kpis']}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
