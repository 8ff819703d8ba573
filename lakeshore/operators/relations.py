"""Gold as SQL relations: views over Gold tables, and the reports as table functions.

`register` makes both in the session, so that SQL text runs against them:

    register(spark, {"zone_flow_monthly": frame, ...})
    run_sql(spark, "SELECT * FROM zone_analysis(pickup_location_id => :zone) ORDER BY trip_count DESC LIMIT :n", zone=132, n=25)

A report's function has its parameters by name, all with defaults: a required
one the first of its fixed values, an optional one NULL, which means all rows.
A function's body is one filter over its view. Spark inlines it, so constants
reach the Parquet scan as partition and data filters.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .. import spec
from .reports import REPORTS

#: What a required parameter is if it is not given.
DEFAULTS = {"data_variant": spec.DATA_VARIANTS[0], "month_basis": spec.MONTH_BASES[0]}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def function_sql(report: str, table: DataFrame, view: str) -> str:
    """The definition of a report's table function over a view of its Gold table."""
    r, name = REPORTS[report], report
    types = {f.name: f.dataType.simpleString() for f in table.schema}
    params, conditions = [], []
    for c in r.required:
        params.append(f"{c} {types[c]} DEFAULT {_quoted(DEFAULTS[c])}")
        conditions.append(f"t.{c} = {name}.{c}")
    for c in r.optional:
        params.append(f"{c} {types[c]} DEFAULT NULL")
        conditions.append(f"({name}.{c} IS NULL OR t.{c} = {name}.{c})")
    columns = ", ".join(f"{c} {t}" for c, t in types.items())
    return (f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({', '.join(params)}) RETURNS TABLE({columns})\n"
            f"RETURN SELECT {', '.join(f't.{c}' for c in types)} FROM {view} t WHERE {' AND '.join(conditions)}")


def register(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Temporary views `<prefix><table>` of the Gold tables, and a function for each report of one of them; their names."""
    made = []
    for name, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
        made.append(f"{prefix}{name}")
    for report, r in REPORTS.items():
        if r.table in tables:
            spark.sql(function_sql(report, tables[r.table], f"{prefix}{r.table}"))
            made.append(report)
    return made


def unregister(spark: SparkSession, names: list[str]) -> None:
    """Take the views and functions that `register` made out of the session again; queries made of them stay."""
    for name in reversed(names):
        if name in REPORTS:
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
        else:
            spark.catalog.dropTempView(name)


def run_sql(spark: SparkSession, text: str, **params: Any) -> DataFrame:
    """SQL text with `:name` markers, bound to the given values (never pasted into the text)."""
    return spark.sql(text, args=params)
