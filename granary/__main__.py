"""python -m granary run|history|sql: the batch from the command line."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import reconcile
from .plans.lakehouse import STAGES, Lakehouse
from .sources.generator import DATES


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="granary")
    p.add_argument("command", choices=["run", "history", "sql"])
    p.add_argument("what", nargs="?", help="stages by comma, or all; a table as layer.name; a query over gold views")
    p.add_argument("--root", default="warehouse")
    p.add_argument("--landing", default="landing")
    p.add_argument("--business-date", choices=DATES)
    p.add_argument("--mode", default="normal", help="normal, resume, fail-during:ENTITY, fail-after:ENTITY")
    p.add_argument("--fail-on-mismatch", action="store_true", help="exit 1 if a batch of this run has a mismatch")
    p.add_argument("--reports", help="folder for mismatch_report.csv, on any file system")
    a, _ = p.parse_known_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    house = Lakehouse(spark, a.root, a.landing)
    if a.command == "history":
        house.table(*a.what.split(".")).history().show(100, False)
    elif a.command == "sql":
        for name in ("dim_party", "dim_account", "dim_loan", "fact_deposit_balance_daily", "fact_loan_position_daily", "fact_payment", "fact_aml_alert"):
            if (df := house.read("gold", name)) is not None:
                df.createOrReplaceTempView(name)
        spark.sql(a.what).show(100, False)
    else:
        stages = STAGES if a.what in (None, "all") else tuple(a.what.split(","))
        days = [a.business_date] if a.business_date else DATES
        for day in days:
            house.run(day, stages, a.mode)
        mine = [house.batch(day) for day in days]
        results = house.read("ref", "recon_results")
        bad = results.where(F.col("batch_id").isin(mine) & (F.col("status") == "MISMATCH")) if results is not None else None
        if a.reports and results is not None:
            reconcile.report(results.where(F.col("batch_id").isin(mine)), a.reports)
        if a.fail_on_mismatch and bad is not None and bad.limit(1).count():
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
