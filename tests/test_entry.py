"""The driver contract."""

import __spark_entry__ as entry_module


def test_entry_runs(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and {"zone", "cells", "status"} <= set(rows[0].asDict())


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
