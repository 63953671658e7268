"""Catalog of the engine's named queries and of their reference SQL.

Relational queries are written once, in the SQL that Spark and the reference
engine share; ``dialect`` holds the few spellings that differ.  Operators that
need more than one SQL statement live in ``gridloom.operators`` and
``gridloom.streaming`` and are registered here next to the SQL that checks them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from gridloom.plans.dialect import DuckDB, Spark
from gridloom.plans.relations import with_relations
from gridloom.plans.statements import STATEMENTS

FLAGSHIP = "canopy_cover_by_zone"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations", "pages", "benchmark")


def statement(name: str, dialect) -> str:
    relations, write = STATEMENTS[name]
    return with_relations(write(dialect), relations, dialect)


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Runs a statement over the driver tables that it names, with no views
    left behind in the session."""
    sql = re.sub(r"\b(FROM|JOIN) (" + "|".join(TABLES) + r")\b", r"\1 {\2}", sql)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def _runner(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_sql(spark, sf_dir, statement(name, Spark()))

    run.__name__ = name
    return run


def queries() -> dict:
    from gridloom.operators import registry
    from gridloom.plans import estimates, fieldwork, grids, reports, rulebook, shapes

    return {name: _runner(name) for name in STATEMENTS} | rulebook.queries() | shapes.queries() | estimates.queries() | grids.queries() | fieldwork.queries() | reports.queries() | registry.queries()


def oracle_sql() -> dict[str, str]:
    from gridloom.operators import registry
    from gridloom.plans import estimates, fieldwork, grids, reports, rulebook, shapes

    return {name: statement(name, DuckDB()) for name in STATEMENTS} | rulebook.oracle_sql() | shapes.oracle_sql() | estimates.oracle_sql() | grids.oracle_sql() | fieldwork.oracle_sql() | reports.oracle_sql() | registry.oracle_sql()
