"""Product URLs, retry domains and product pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.jsontext import once
from basketry.functions.text import as_column, catalog_url, is_filled, url_authority
from basketry.operators import pages
from basketry.operators.lookup import remaining_tasks
from basketry.operators.pick import earliest_value, latest_value, most_frequent, ranked_values
from basketry.session import cut_lineage
from basketry.sources.schemas import PRODUCT_COLUMNS

# Event types that show a product on its own page, and the one that refers to it.
PRODUCT_EVENTS = [
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "add_to_cart_action",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
]
REFERRING_EVENT = "product_view_all_recommend_clicked"

RANKED_DOMAINS = 20
FALLBACK_DOMAINS = 4
FIRST_SEEN = ["time_stamp", "_id"]


def product_urls(events: DataFrame) -> DataFrame:
    """(product_id, url): the first page each product was seen on, else the first referrer.

    An empty product id does not fall back to the viewed one; such rows drop out.  Events
    are read once: the kind of page comes first in the order of a product's URLs.
    """
    referring = F.col("collection") == REFERRING_EVENT
    shown = events.where(F.col("collection").isin([*PRODUCT_EVENTS, REFERRING_EVENT])).select(
        F.when(referring, F.col("viewing_product_id")).otherwise(
            F.coalesce("product_id", "viewing_product_id")).alias("product_id"),
        F.when(referring, F.col("referrer_url")).otherwise(F.col("current_url")).alias("url"),
        referring.alias("referring"), *FIRST_SEEN,
    )
    return earliest_value(
        shown.where(is_filled("product_id") & is_filled("url")), "product_id", "url",
        ["referring", *FIRST_SEEN],
    )


def product_domains(urls: DataFrame, order: list[str]) -> DataFrame:
    """(product_id, domain): the domain of a product's last URL."""
    hosts = urls.withColumn("domain", url_authority("url"))
    return latest_value(hosts, "product_id", "domain", order)


def top_domains(urls: DataFrame, n: int = RANKED_DOMAINS) -> DataFrame:
    """(domain, cnt) of the most frequent domains."""
    return most_frequent(urls, url_authority("url"), n, name="domain")


def attempt_domains(domain: Column | str, ranked: Column, extra: int = FALLBACK_DOMAINS) -> Column:
    """The product's own domain, then the best other ones."""
    own = as_column(domain)
    others = F.filter(ranked, lambda d: d != own)
    return F.concat(F.array(own), F.slice(others, 1, extra))


def domain_plan(urls: DataFrame, order: list[str]) -> DataFrame:
    """(product_id, domain, attempts): where to look for a product, in that order."""
    ranked = ranked_values(top_domains(urls), "domain").scalar()
    domains = product_domains(urls, order).select("*", once(ranked).alias("ranked"))
    return domains.withColumn("attempts", attempt_domains("domain", F.col("ranked"))).drop("ranked")


def open_tasks(urls: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """URLs of products not parsed yet; ``limit`` is for trial runs."""
    if limit is not None:
        urls = urls.orderBy("product_id").limit(limit)
    return remaining_tasks(urls, done, "product_id")


def parse_pages(stored: DataFrame) -> DataFrame:
    """Outcome and 21 product columns for stored pages (product_id, domain, attempt, html)."""
    data = F.col("data")
    return (
        pages.with_product_data(stored)
        .select(
            *pages.product_record(
                data, F.col("product_id"), catalog_url("domain", "product_id"), "domain"
            ),
            "attempt",
            F.col("product_id").alias("task_id"),
            pages.page_outcome("html", data).alias("status"),
        )
    )


def split_outcomes(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, failures) of parsed pages.

    The first attempt that went well gives the product.  A product with none goes to
    failures (product_id, domains_tried, last_error); the domain plan bounds the number
    of its attempts.  Pages are parsed once: both come from one written aggregate.
    """
    good, order = F.col("status") == pages.OK, F.struct("attempt", "domain_used")
    tried = F.sort_array(F.collect_set(order))
    outcomes = cut_lineage(parsed.groupBy("task_id").agg(
        F.min_by(F.struct(*PRODUCT_COLUMNS), F.when(good, order)).alias("product"),
        F.array_join(F.transform(tried, lambda t: t["domain_used"]), ";").alias("domains_tried"),
        F.max_by("status", order).alias("last_error"),
    ), "page-outcomes")
    failures = outcomes.where(F.col("product").isNull()).select(
        F.col("task_id").alias("product_id"), "domains_tried", "last_error")
    return outcomes.where(F.col("product").isNotNull()).select("product.*"), failures


def outcome_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("status").agg(F.count(F.lit(1)).alias("cnt"))
