"""Command line: score one lead sheet against the warehouse.

    python -m shiftscore --warehouse <dir> --leads <sheet.csv> \\
        --variant open|call --out <dir> [--as-of "2024-06-01 00:00:00"] [--run-id <name>]

Spark's master and settings come from spark-defaults.conf or from
``PYSPARK_SUBMIT_ARGS="--master yarn --conf ... pyspark-shell"``; on a cluster
``spark.checkpoint.dir`` names a folder that all executors share.  The warehouse folder holds the eleven relations as ``<dir>/<name>`` tables
(see ``shiftscore.sources.warehouse.RELATIONS``).
"""

from __future__ import annotations

import argparse

from .plans.job import run_scoring_job
from .session import get_session
from .sources.leads import read_call_sheets, read_open_sheets
from .sources.warehouse import load_warehouse


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="shiftscore")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--warehouse-format", default="parquet")
    p.add_argument("--leads", required=True)
    p.add_argument("--leads-format", default="csv")
    p.add_argument("--variant", choices=("open", "call"), required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", default=None)
    p.add_argument("--run-id", default=None)
    p.add_argument("--no-history", action="store_true")
    p.add_argument("--set-aside", action="store_true", help="leave rows with a wrong number of cells out of the list")
    a = p.parse_args(argv)
    spark = get_session()
    wh = load_warehouse(spark, a.warehouse, fmt=a.warehouse_format)
    reader = read_open_sheets if a.variant == "open" else read_call_sheets
    sheets = reader(spark, a.leads, fmt=a.leads_format, set_aside=a.set_aside)
    res = run_scoring_job(wh, sheets.leads, a.variant, a.out, a.as_of, history=not a.no_history, run_id=a.run_id, malformed=sheets.malformed)
    print(f"active={res.active_rows} remaining={res.remaining_rows} malformed={res.malformed_rows}")


if __name__ == "__main__":
    main()
