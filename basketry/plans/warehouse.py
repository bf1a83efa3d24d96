"""The whole warehouse: staging views, core and mart tables, and their tests."""

from __future__ import annotations

import datetime
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators.quality import enforce_contract
from basketry.plans import declared, dims, facts, mart, staging
from basketry.plans.staged import StagedDays
from basketry.session import cut_lineage, fresh_path, remove
from basketry.sinks.versioned import VersionedTable
from basketry.sinks.writers import publish_view, save_table
from basketry.sources.readers import Registry

CORE, MART = "core", "mart"
CARTS = "parsed_carts"
CART = "stg_checkout_success_cart_items"
FACT = "fact_sales_order_detail"
RATES = "fact_exchange_rate"
FLAT = "mart_sales_order_detail"

# Row-count bounds of the sales fact in production.
FACT_ROWS = (30_000, 50_000)


STAGING_MODELS = ["stg_checkout_success_cart_items", "stg_currency", "stg_location", "stg_products", "stg_store"]
DIMENSIONS = ["dim_date", "dim_customer", "dim_product", "dim_location", "dim_currency", "dim_store"]


def define(spark: SparkSession, events: DataFrame, ip_locations: DataFrame, raw_products: DataFrame,
           currency_rates: DataFrame, *, write_cart: bool = True) -> Registry:
    """All models by name, each built when first referred to.

    Staging models are written once below the shared folder, and before them the parsed carts:
    cart items, currencies and stores read these instead of the raw events.  Cart items feed
    three models and would be made three times; and lookups on disk have a size, so Spark
    broadcasts a small one to the fact rows instead of shuffling these by a key such as
    the currency, of which one value may cover a third of them.  Products are a plain
    scan of the raw table and need no copy.  The parsed carts are removed once all three that
    read them are written, so they are no model to refer to from outside.

    Who refers to one model only of those that cart items feed leaves ``write_cart`` out: their
    lines then go straight into that model, and only the columns it needs are shuffled.
    """
    r = Registry(spark)
    carts = fresh_path(spark, CARTS)
    # What is made of the carts and written; with the last of it they have no reader left.
    waiting = {CART, "stg_currency", "stg_store"} if write_cart else set()

    def written(name: str, build) -> None:
        def once() -> DataFrame:
            made = cut_lineage(build(), name)
            if name in waiting:
                waiting.remove(name)
                if not waiting:
                    remove(spark, carts)
            return made

        r.add(name, once)

    r.add(CARTS, lambda: cut_lineage(staging.parsed_carts(events), CARTS, carts))
    (written if write_cart else r.add)(CART, lambda: staging.checkout_cart_items(r[CARTS], currency_rates, whole=write_cart))
    written("stg_currency", lambda: staging.currency(r[CARTS], currency_rates))
    written("stg_location", lambda: staging.location(ip_locations))
    written("stg_store", lambda: staging.store(r[CARTS]))
    r.add("stg_products", lambda: staging.products(raw_products))

    r.add("dim_date", lambda: dims.date(r[CART]))
    r.add("dim_customer", lambda: dims.customer(r[CART]))
    r.add("dim_product", lambda: dims.product(r["stg_products"]))
    r.add("dim_location", lambda: dims.location(r["stg_location"]))
    r.add("dim_currency", lambda: dims.currency(r["stg_currency"]))
    r.add("dim_store", lambda: dims.store(r["stg_store"]))
    r.add(RATES, lambda: facts.exchange_rate(r["dim_date"], r["dim_currency"], currency_rates))
    r.add(FACT, lambda: sales_fact(r, r[CART], currency_rates))
    r.add(FLAT, lambda: mart.sales_mart(
        r[FACT], r["dim_date"], r["dim_product"], r["dim_location"], r["dim_currency"], r["dim_store"]))
    return r


def sales_fact(r: Registry, cart: DataFrame, currency_rates: DataFrame) -> DataFrame:
    return facts.sales_order_detail(
        cart, r["stg_location"], r["dim_currency"], r["stg_store"], r["stg_products"], currency_rates)


def versioned_root(spark: SparkSession) -> str:
    """Folder of the tables with a commit log, beside those of the core database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {CORE}")
    return spark.catalog.getDatabase(CORE).locationUri.rstrip("/") + "/versioned"


def build(spark: SparkSession, events: DataFrame, ip_locations: DataFrame, raw_products: DataFrame,
          currency_rates: DataFrame, *, incremental: bool = False,
          as_of: datetime.date | None = None, root: str | None = None) -> Registry:
    """Build all tables; the registry then refers to what was saved.

    Every table is checked against its contract before it is written.  Cart lines and the
    fact are kept by day below ``root`` and change by one commit each.  An incremental run
    reads the raw events of the look-back window only, stages their days anew and merges them
    into the fact, of which it rewrites the days it touches; the first run, and one that is
    not incremental, replaces both.  Should a run stop between the two commits, the next one
    with the same window makes up for it.
    """
    root = root or versioned_root(spark)
    staged = StagedDays.below(spark, root)
    fact = VersionedTable(spark, f"{root}/{FACT}", facts.FACT_PARTITION)
    again = incremental and staged.exists() and fact.exists()
    as_of = as_of or datetime.datetime.now(datetime.UTC).date()
    staged.load(events, currency_rates, as_of - datetime.timedelta(days=facts.LOOK_BACK_DAYS) if again else None)

    r = define(spark, events, ip_locations, raw_products, currency_rates)
    r.put(CART, staged.cart())
    r.put("stg_store", cut_lineage(staged.store(), "stg_store"))
    r.put("stg_currency", cut_lineage(staged.currency(currency_rates), "stg_currency"))
    for name in STAGING_MODELS:
        publish_view(r[name], name)

    def save(layer: str, name: str) -> None:
        r.put(name, spark.table(save_table(enforce_contract(r[name], name), layer, name)))

    for name in [*DIMENSIONS, RATES]:
        save(CORE, name)

    if again:
        fact.merge(enforce_contract(sales_fact(r, facts.recent(r[CART], as_of), currency_rates), FACT), facts.MERGE_KEYS)
    else:
        fact.replace(enforce_contract(r[FACT], FACT))
    fact.publish(f"{CORE}.{FACT}")
    r.put(FACT, fact.read())
    save(MART, FLAT)
    return r


def quality_report(models: Registry, currency_rates: DataFrame,
                   fact_rows: tuple[int, int] = FACT_ROWS) -> DataFrame:
    """(check, failures) of all declared tests of the warehouse; ``fact_rows`` bounds the sales fact."""
    return declared.measure(_tests(fact_rows), _tested(models, currency_rates))


def declared_report(spark: SparkSession, models: Registry, currency_rates: DataFrame,
                    fact_rows: tuple[int, int] = FACT_ROWS, *, saved: bool = True) -> DataFrame:
    """Every declared test with its failures and outcome, those included that were not run.

    Models that are not ``saved`` as tables: fact and mart, which a dozen tests read, are written
    first, of the mart what its tests look at.  Else each test would join them anew.
    """
    tests = _tests(fact_rows)
    if not saved:
        models.put(FACT, cut_lineage(models[FACT], FACT))
    tables = _tested(models, currency_rates)
    if not saved:
        tables[FLAT] = cut_lineage(tables[FLAT].select(*declared.columns_read(tests, FLAT, tables[FLAT].columns)), FLAT)
    return declared.with_outcome(spark, tests, declared.measure(tests, tables))


def _tests(fact_rows: tuple[int, int]) -> list[declared.Declared]:
    return [replace(t, low=fact_rows[0], high=fact_rows[1]) if t.kind == "row count" else t for t in declared.catalogue()]


def _tested(models: Registry, currency_rates: DataFrame) -> dict[str, DataFrame]:
    return {m: models[m] for m in [*STAGING_MODELS, *DIMENSIONS, RATES, FACT, FLAT]} | {"seed": currency_rates}
