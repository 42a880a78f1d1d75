"""A synthetic dirty table for trials and demonstrations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The sample's distributions.
NULL_SHARE = 0.05
PLANTED = 20
CITIES = ["New York", "London", "Tokyo", "Paris", None]
RATINGS = ["A", "B", "C", None]
PREMIUM = [True, False, None]
MEAN_VISITS = 5
FIRST_DAY = "2020-01-01"


def _uniform(tag: str, seed: int) -> Column:
    """A number in (0, 1) that depends on the row id, the tag and the seed alone.

    So a recomputed partition yields the same rows, which a random generator bound to
    partitions would not.
    """
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(tag), F.col("id").cast("string"))), 1, 12)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / F.lit(float(16 ** 12))


def _normal(tag: str, seed: int, mean: float, std: float) -> Column:
    u, v = _uniform(tag + "/u", seed), _uniform(tag + "/v", seed)
    return F.lit(mean) + F.lit(std) * F.sqrt(-2 * F.log(u)) * F.cos(F.lit(2 * math.pi) * v)


def _choice(tag: str, seed: int, values: list) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, F.floor(_uniform(tag, seed) * len(values)).cast("int"))


def _poisson(tag: str, seed: int, mean: float) -> Column:
    """By the inverse distribution, cut where it is 1 to 12 digits."""
    u, k, term, total = _uniform(tag, seed), 0, math.exp(-mean), 0.0
    out = F.when(F.lit(False), F.lit(0))
    while total + term < 1 - 1e-12:
        total += term
        out = out.when(u < total, F.lit(k))
        k += 1
        term *= mean / k
    return out.otherwise(F.lit(k))


def sample_rows(ids: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """The sample's ten columns for every row of ``ids`` (column ``id``, 1 to ``n``).

    About 5 % of the cells are null, and 20 rows spread over the table carry outliers.
    """
    planted = F.floor(F.col("id") * PLANTED / n) != F.floor((F.col("id") - 1) * PLANTED / n)
    salary, purchase = _normal("salary", seed, 50000.0, 15000.0), -100.0 * F.log(_uniform("purchase", seed))
    columns = {
        "customer_id": F.col("id").cast("bigint"),
        "age": _normal("age", seed, 35.0, 10.0).cast("int"),
        "salary": F.when(planted, salary * 5).otherwise(salary),
        "purchase_amount": F.when(planted, purchase * 10).otherwise(purchase),
        "city": _choice("city", seed, CITIES),
        "membership_date": F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("id") - 1).cast("int"))
        .cast("timestamp_ntz"),
        "is_premium": _choice("premium", seed, PREMIUM),
        "rating": _choice("rating", seed, RATINGS),
        "score": _uniform("score", seed) * 100,
        "visits": _poisson("visits", seed, MEAN_VISITS),
    }
    return ids.select(*[
        F.when(_uniform("null/" + name, seed) >= NULL_SHARE, c).alias(name) for name, c in columns.items()])


def sample_table(spark: SparkSession, n: int = 1000, seed: int = 42) -> DataFrame:
    return sample_rows(spark.range(1, n + 1), n, seed)
