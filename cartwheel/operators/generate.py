"""Synthetic e-commerce tables, generated by Spark from id columns.

Every generator takes a DataFrame of ids (``spark.range`` for a fresh table,
or the key column of an existing one) and attaches columns from hashed
uniforms of (seed, column, id).  Output is therefore reproducible for a seed,
independent of the partition count, and recomputable after a lost executor.
Dates are relative to an explicit ``as_of`` date, never to "today".

Text columns (names, cities, ...) are picked from small vocabularies: no
query reads them, they only need to look like text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.random import (hashed_choice, hashed_int, hashed_normal,
                                        hashed_range)
from cartwheel.operators.sampling import pareto_weights, uniform_sample, weighted_sample

DEFAULT_AS_OF = dt.date(2025, 1, 1)

# Product categories of the e-commerce model.
CATEGORIES = ["Electronics", "Clothing", "Home", "Sports", "Books"]

# First names and categories of the file-format benchmark table.
FORMAT_TABLE_NAMES = ["John", "Jane", "Bob", "Alice", "Charlie", "Diana", "Eve", "Frank"]
FORMAT_TABLE_CATEGORIES = ["A", "B", "C", "D", "E"]

# Vocabularies for generated text.
FIRST_NAMES = ["Ada", "Bruno", "Carla", "Dmitri", "Elif", "Farah", "Goran", "Hana", "Ivo", "Jia",
          "Kofi", "Lena", "Mateo", "Nia", "Oskar", "Priya", "Quinn", "Rosa", "Sami", "Tomas"]
LAST_NAMES = ["Adler", "Baker", "Costa", "Dubois", "Eriksen", "Fischer", "Garcia", "Haddad",
         "Ito", "Jensen", "Kowalski", "Larsen", "Moreau", "Novak", "Okafor", "Petrov"]
CITIES = ["Lisbon", "Austin", "Osaka", "Lagos", "Lyon", "Pune", "Leeds", "Cusco",
           "Gdansk", "Perth", "Quebec", "Tartu"]
COUNTRIES = ["Portugal", "United States", "Japan", "Nigeria", "France", "India",
              "United Kingdom", "Peru", "Poland", "Australia", "Canada", "Estonia"]
ADJECTIVES = ["Compact", "Durable", "Smart", "Classic", "Portable", "Premium", "Eco",
               "Modular", "Wireless", "Ergonomic"]
NOUNS = ["Kettle", "Backpack", "Lamp", "Jacket", "Speaker", "Novel", "Racket", "Blender",
          "Monitor", "Sneaker", "Tent", "Notebook"]

_DAYS_PER_YEAR = 365


def _ids(spark: SparkSession, n: int, name: str) -> DataFrame:
    return spark.range(1, int(n) + 1).withColumnRenamed("id", name)


def _days_before(as_of: dt.date, key: str, seed: int, salt: str, max_days: int):
    return F.date_sub(F.lit(as_of), hashed_int(key, seed, salt, 0, max_days).cast("int"))


def customers_from_ids(ids: DataFrame, key: str = "customer_id", seed: int = 0,
                       as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Customers for the given ids.

    age: normal(35, 12) truncated toward zero, then clipped to [18, 95];
    registration_date: uniform over the 5 years up to ``as_of``.
    """
    first = hashed_choice(key, seed, "first", FIRST_NAMES)
    last = hashed_choice(key, seed, "last", LAST_NAMES)
    age = hashed_normal(key, seed, "age", 35.0, 12.0).cast("bigint")
    return ids.select(
        F.col(key).cast("bigint").alias("customer_id"),
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.col(key).cast("string"),
                 F.lit("@example.com")).alias("email"),
        F.greatest(F.least(age, F.lit(95).cast("bigint")), F.lit(18).cast("bigint")).alias("age"),
        hashed_choice(key, seed, "city", CITIES).alias("city"),
        hashed_choice(key, seed, "country", COUNTRIES).alias("country"),
        _days_before(as_of, key, seed, "registered", 5 * _DAYS_PER_YEAR)
        .alias("registration_date"),
    )


def generate_customers(spark: SparkSession, num_records: int, seed: int = 0,
                       as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """``num_records`` customers with ids 1..n."""
    return customers_from_ids(_ids(spark, num_records, "customer_id"), seed=seed, as_of=as_of)


def products_from_ids(ids: DataFrame, key: str = "product_id", seed: int = 0) -> DataFrame:
    """Products for the given ids.

    category: uniform over :data:`CATEGORIES`; price: uniform [10, 500]
    rounded half-even to cents; stock: integer 0..1000; rating: uniform
    [1, 5] rounded to one decimal.
    """
    return ids.select(
        F.col(key).cast("bigint").alias("product_id"),
        F.concat_ws(" ", hashed_choice(key, seed, "adjective", ADJECTIVES),
                    hashed_choice(key, seed, "noun", NOUNS)).alias("name"),
        hashed_choice(key, seed, "category", CATEGORIES).alias("category"),
        F.bround(hashed_range(key, seed, "price", 10.0, 500.0), 2).alias("price"),
        hashed_int(key, seed, "stock", 0, 1000).alias("stock"),
        F.bround(hashed_range(key, seed, "rating", 1.0, 5.0), 1).alias("rating"),
    )


def generate_products(spark: SparkSession, num_records: int, seed: int = 0) -> DataFrame:
    """``num_records`` products with ids 1..n."""
    return products_from_ids(_ids(spark, num_records, "product_id"), seed=seed)


def orders_from_ids(ids: DataFrame, customers: DataFrame, products: DataFrame,
                    key: str = "order_id", seed: int = 0, alpha: float = 1.16,
                    as_of: dt.date = DEFAULT_AS_OF, customer_key: str = "customer_id",
                    product_key: str = "product_id", unique_keys: bool = False) -> DataFrame:
    """Orders for the given order ids.

    The customer of each order is drawn with probability proportional to a
    Pareto(``alpha``) weight per customer (a few customers place most
    orders); the product is drawn uniformly; quantity is 1..10; order_date is
    uniform over the 2 years up to ``as_of``.  ``unique_keys=True`` declares
    the customer and product keys primary keys (see ``weighted_sample``).
    """
    order_ids = ids.select(F.col(key).cast("bigint").alias("order_id"))
    cust_ids = customers.select(F.col(customer_key).cast("bigint").alias("customer_id"))
    prod_ids = products.select(F.col(product_key).cast("bigint").alias("product_id"))
    who = weighted_sample(order_ids, "order_id",
                          pareto_weights(cust_ids, "customer_id", alpha, seed),
                          "customer_id", seed=seed, unique_keys=unique_keys)
    # the product draw runs on the customer draw's output: no join of two samples
    what = uniform_sample(who, "order_id", prod_ids, "product_id", seed=seed + 1,
                          unique_keys=unique_keys)
    return (what
            .select("order_id", "customer_id", "product_id",
                    hashed_int("order_id", seed, "quantity", 1, 10).alias("quantity"),
                    _days_before(as_of, "order_id", seed, "ordered", 2 * _DAYS_PER_YEAR)
                    .alias("order_date")))


def generate_orders(spark: SparkSession, num_records: int, customers: DataFrame,
                    products: DataFrame, seed: int = 0, alpha: float = 1.16,
                    as_of: dt.date = DEFAULT_AS_OF, unique_keys: bool = False) -> DataFrame:
    """``num_records`` orders (ids 1..n) over the given customers and products."""
    return orders_from_ids(_ids(spark, num_records, "order_id"), customers, products,
                           seed=seed, alpha=alpha, as_of=as_of, unique_keys=unique_keys)


def format_table_from_ids(ids: DataFrame, key: str = "id", seed: int = 42,
                          as_of: dt.datetime = dt.datetime(2025, 1, 1, 12, 0, 0)) -> DataFrame:
    """The file-format benchmark table for the given ids (1-based).

    email is ``user{id-1}@example.com``; amount uniform [10, 10000); date is
    ``as_of`` minus 0..364 whole days (time of day kept), microsecond
    timestamps.
    """
    days = hashed_int(key, seed, "days", 0, 364)
    return ids.select(
        F.col(key).cast("bigint").alias("id"),
        hashed_choice(key, seed, "name", FORMAT_TABLE_NAMES).alias("name"),
        F.concat(F.lit("user"), (F.col(key) - 1).cast("string"), F.lit("@example.com"))
        .alias("email"),
        hashed_range(key, seed, "amount", 10.0, 10000.0).alias("amount"),
        (F.lit(as_of).cast("timestamp") - F.make_dt_interval(days.cast("int")))
        .alias("date"),
        hashed_choice(key, seed, "category", FORMAT_TABLE_CATEGORIES).alias("category"),
    )


def create_test_dataframe(spark: SparkSession, num_rows: int = 500_000,
                          seed: int = 42) -> DataFrame:
    """The file-format benchmark table with ids 1..num_rows."""
    return format_table_from_ids(_ids(spark, num_rows, "id"), seed=seed)
