"""Every registered query against its SQL, and the driver contract."""

import re

import pytest
from oracle import SF_DIR, compare, connect

import __spark_entry__ as entry_point
from tradewind import checks
from tradewind.checks import registry
from tradewind.checks.shapes import SHAPE_SQL, Retail

checks.load()
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, con, name) is None


def test_entry_runs(spark):
    df = entry_point.entry(spark)
    assert df.columns[:2] == ["customer_state", "region"] and df.count() == 25


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry_point.queries())
    assert set(NAMES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", [n for n in NAMES if re.match(r"n([1-9]|1[0-4]|44|45)_", n)])
def test_sql_form_equals_frame_form(spark, name):
    """The exploration questions, asked in SQL over views of the shaped tables."""
    retail = Retail(spark, SF_DIR)
    for view in SHAPE_SQL:
        getattr(retail, view[2:]).createOrReplaceTempView(view)
    from tradewind.checks.registry import ORACLE
    text = ORACLE[name].replace("'day', order_purchase_ts", "day, order_purchase_ts")
    text = text.replace("date_diff(", "datediff(")
    sql = spark.sql(text)
    frame = entry_point.queries()[name](spark, SF_DIR)

    def rows(df):
        return sorted(repr([str(float(v)) if isinstance(v, (int, float)) or hasattr(v, "as_tuple") else v
                            for v in r]) for r in df.select(*sorted(df.columns)).collect())
    assert rows(sql) == rows(frame)
