"""Scalar expressions over transaction columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.config import HASH_SEPARATOR


def row_digest(columns: Sequence[str], safe: bool = False) -> Column:
    """SHA-256 over the row's values, in the order given.

    The default form skips nulls and does not escape the separator, so rows that differ only in
    where a null stands share a digest. ``safe`` writes each value with its length and marks
    nulls, so that different rows have different input.
    """
    if not safe:
        return F.sha2(F.concat_ws(HASH_SEPARATOR, *columns), 256)
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def entity_class(name: str) -> Column:
    """First character of an account name: the kind of entity behind it."""
    return F.substring(name, 1, 1)


def is_class(name: str, letter: str) -> Column:
    return (entity_class(name) == letter).cast("int")


def hour_of_day(step: str) -> Column:
    """Hour 0..23 of a 1-based hour index; a step below 1 keeps the dividend's sign."""
    return ((F.col(step) - 1) % 24).cast("int")


def day_of_run(step: str) -> Column:
    return F.floor((F.col(step) - 1) / 24).cast("int") + 1


def one_hot(name: str, values: Iterable[str]) -> list[Column]:
    """One 0/1 column per listed value. Unknown and null values give zeros throughout."""
    return [F.when(F.col(name) == v, 1).otherwise(0).alias(f"{name}_{v}") for v in values]


def ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient that is 0.0 where the denominator is zero or missing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def long_form(values: Mapping[str, Column], name: str, value: str) -> Column:
    """One output row per entry: its key in column ``name``, its value as double in ``value``.

    ``DataFrame.unpivot`` does the same, but Spark does not recognise two copies of an unpivoted
    branch as equal, and then shuffles it twice.
    """
    entries = [F.struct(F.lit(k).alias(name), v.cast("double").alias(value)) for k, v in values.items()]
    return F.inline(F.array(*entries))


def sample_hash(key: str, purpose: str, seed: int = 42) -> Column:
    """A reproducible uniform draw per row, as 32 hex digits that compare like a number.

    The draw depends on the key's value only: it survives retries, repartitioning and another
    engine. ``purpose`` keeps the draws of different samplings independent.
    """
    return F.md5(F.concat(F.lit(f"{purpose}:{seed}:"), F.col(key).cast("string")))


def hex_share(fraction: float) -> str:
    """The 8-digit hex bound below which a share ``fraction`` of all draws falls."""
    return format(min(int(fraction * 2**32), 2**32 - 1), "08x")


def ks_pvalue(statistic: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value, by its alternating series.

    Below lambda = 0.2 the series converges slowly and the p-value is 1 to beyond 12 digits.
    """
    size = n.cast("double") * m.cast("double") / (n + m).cast("double")
    lam = statistic * F.sqrt(size)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
