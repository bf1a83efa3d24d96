"""Every registered query against its checking SQL, and the warehouse build."""

import datetime

import pytest

import __spark_entry__ as entry_points
from basketry.checks.compare import connect, difference
from basketry.checks.inputs import Inputs
from basketry.plans import warehouse

SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, folder, db, name):
    df = entry_points.queries()[name](spark, folder)
    if name in SQL:
        assert difference(df, SQL[name], db) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 20


def test_build_twice_and_incrementally(spark, folder):
    i = Inputs.of(spark, folder)
    sources = (i.events, i.ip_locations, i.products, i.rates)
    first = warehouse.build(spark, *sources)
    keyed = "order_product_key is not null"
    full = first[warehouse.FACT].where(keyed).drop("inserted_date", "updated_date").collect()
    old_files = set(first[warehouse.FACT].inputFiles())
    again = warehouse.build(spark, *sources, incremental=True, as_of=datetime.date(2000, 1, 1))
    merged = again[warehouse.FACT].where(keyed).drop("inserted_date", "updated_date")
    assert sorted(map(str, merged.collect())) == sorted(map(str, full))
    # Days before the look-back are neither in the batch nor hold a row it replaces.
    early = {f for f in old_files if int(f.split("date_key=")[1].split("/")[0]) < 19991229}
    assert early and early <= set(merged.inputFiles()) and old_files - set(merged.inputFiles())
    report = {r["check"]: r["failures"] for r in warehouse.quality_report(again, i.rates).collect()}
    assert len(report) == 76  # 74 generic tests and 2 singular ones
    failures = {check: n for check, n in report.items() if n}
    # Orders without an id are in the input on purpose; the row-count bounds are those of
    # production.
    assert "mart has the rows of the fact" not in failures
    assert "no duplicate order and product" not in failures
    assert failures.get("stg_checkout_success_cart_items.order_id not null", 0) > 0
