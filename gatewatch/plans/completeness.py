"""Expected reports and the completeness check (JOB8, FN6, FN14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.plans.slots import explode_slots


def expected_reports(run_dates: DataFrame, list_name: str, date_col: str = "run_date") -> DataFrame:
    """(report_date, slot, object_name) for every run date and slot, with
    the object name a report of that date and slot is published under."""
    x = explode_slots(run_dates, date_col)
    day = F.date_format("run_date", "yyyy-MM-dd")
    folder = F.replace(F.col("_folder"), F.lit("{list}"), F.lit(list_name))
    name = F.concat(
        F.lit("WatchList/"), folder, F.lit("/"), day, F.lit(f"/{list_name}_List_"), day, F.col("_suffix"), F.lit(".xlsx")
    )
    return x.select(F.col("run_date").alias("report_date"), "slot", name.alias("object_name"))


def missing_reports(expected: DataFrame, runs: DataFrame, list_name: str) -> DataFrame:
    """Expected reports of a list with no recorded run of that list (an empty
    report still records one). A left anti join on (report_date, slot)."""
    done = runs.where(F.col("list_name") == F.lit(list_name)).select("report_date", "slot")
    return expected.join(done, ["report_date", "slot"], "left_anti")
