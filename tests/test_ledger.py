"""The ledger of attempts: rounds, stops, reruns, passes and odd input."""

import pytest
from pyspark.sql import functions as F

from basketry.plans.ledger import AttemptLedger
from basketry.session import fresh_path
from basketry.sinks.versioned import ConcurrentCommit

FILL = "x" * 1000
GOOD = FILL + 'var react_data = {"name": "Ring", "price": 12.0};'
NONE, DENIED = FILL, FILL + "Access Denied"
PAGES = "product_id string, domain string, html string, seen int, product string"


def plan_of(spark, **domains):
    return spark.createDataFrame(list(domains.items()), "product_id string, attempts array<string>")


def stored(spark, *rows):
    """The last column clashes with a name the ledger uses."""
    return spark.createDataFrame([(*r, k, "extra") for k, r in enumerate(rows)], PAGES)


def attempts(book):
    return sorted((r["product_id"], r["pass"], r["attempt"], r["domain"], r["status"]) for r in book.rows().collect())


@pytest.fixture
def book(spark):
    return AttemptLedger(spark, fresh_path(spark, "ledger"))


def test_rounds_stop_at_success_and_resume(spark, book):
    plan = plan_of(spark, a=["d1", "d2", "d3"], b=["d2", "d1"], c=["d3", "d1"])
    pages = stored(spark, ("a", "d1", NONE), ("a", "d2", GOOD), ("a", "d3", GOOD), ("b", "d2", DENIED), ("b", "d1", NONE))
    first = book.work(plan, pages, rounds=1)
    assert [(r.number, r.attempts, r.products) for r in first] == [(1, 2, 0)]
    assert [(r.number, r.attempts, r.products) for r in book.work(plan, pages)] == [(2, 2, 1)]
    assert book.work(plan, pages) == []
    want = [("a", 1, 0, "d1", "react_data_not_found"), ("a", 1, 1, "d2", "ok"),
            ("b", 1, 0, "d2", "access_denied"), ("b", 1, 1, "d1", "react_data_not_found")]
    assert attempts(book) == want
    assert [(r["product_id"], r["domain_used"], r["price"]) for r in book.products().collect()] == [("a", "d2", "12.0")]
    assert list(map(tuple, book.failures(plan).collect())) == [("b", "d2;d1", "react_data_not_found")]
    assert list(map(tuple, book.waiting(plan).collect())) == [("c", "d3")]
    # The page of c arrives, and b is found in another pass; a is not tried again.
    pages = stored(spark, ("a", "d1", GOOD), ("b", "d2", GOOD), ("c", "d3", GOOD))
    assert book.work(plan, pages.where("product_id = 'c'")) and book.failures(plan).count() == 1
    assert [r.products for r in book.work(plan, pages, new_pass=True)] == [1]
    assert attempts(book) == [*want, ("b", 2, 0, "d2", "ok"), ("c", 1, 0, "d3", "ok")]
    assert book.failures(plan).isEmpty() and book.waiting(plan).isEmpty()


def test_a_stop_before_the_commit_tries_nothing(spark, book, monkeypatch):
    plan, pages = plan_of(spark, a=["d1", "d2"]), stored(spark, ("a", "d1", NONE), ("a", "d2", GOOD))
    book.work(plan, pages, rounds=1)

    def stop(*_):
        raise KeyboardInterrupt("driver is gone")

    with monkeypatch.context() as m:
        m.setattr(book.table, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            book.work(plan, pages)
    again = AttemptLedger(spark, book.table.root)
    assert len(attempts(again)) == 1
    assert [r.products for r in again.work(plan, pages)] == [1]
    assert [a[2] for a in attempts(again)] == [0, 1]


def test_of_two_runs_at_once_one_fails(spark, book):
    plan, pages = plan_of(spark, a=["d1", "d2"]), stored(spark, ("a", "d1", NONE), ("a", "d2", NONE))
    book.work(plan, pages, rounds=1)
    base = book.table.snapshot()
    row = book.rows().withColumn("attempt", F.lit(1)).withColumn("round", F.lit(2))
    book.work(plan, pages, rounds=1)
    with pytest.raises(ConcurrentCommit):
        book.table.append(row, base)
    with pytest.raises(ValueError):
        book.table.append(row, book.table.snapshot())
    assert book.table.append(row.limit(0), book.table.snapshot()) is None
    assert len(attempts(book)) == 2


def test_a_plan_that_changes_repeats_no_domain(spark, book):
    pages = stored(spark, ("a", "d1", NONE), ("a", "d2", NONE), ("a", "d3", GOOD))
    book.work(plan_of(spark, a=["d2", "d1"]), pages, rounds=1)
    book.work(plan_of(spark, a=["d1", "d2", "d3"]), pages)
    assert [(a[2], a[3]) for a in attempts(book)] == [(0, "d2"), (1, "d1"), (2, "d3")]


def test_repeated_null_and_empty_input(spark, book):
    plan = spark.createDataFrame([("a", ["d1"]), (None, ["d1"]), ("b", None), ("c", [])], "product_id string, attempts array<string>")
    pages = stored(spark, ("a", "d1", None), ("a", "d1", GOOD), (None, "d1", GOOD), ("a", None, GOOD), ("z", "d1", GOOD))
    assert book.work(plan, pages.limit(0)) == [] and book.products().isEmpty() and book.failures(plan).isEmpty()
    assert book.work(plan.limit(0), pages) == []
    # Of repeated pages the first by order counts.
    assert [r.attempts for r in book.work(plan, pages, order=["seen"])] == [1]
    assert attempts(book) == [("a", 1, 0, "d1", "empty_or_too_short")]
    assert list(map(tuple, book.failures(plan).collect())) == [("a", "d1", "empty_or_too_short")]
    assert book.waiting(plan).isEmpty()
