"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_failure(target: str = "target") -> Column:
    return F.when(F.col(target) == 1, 1).otherwise(0)


def failure_sum(target: str = "target") -> Column:
    """``SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END)``."""
    return F.sum(is_failure(target))


def dround(x: str | Column, digits: int) -> Column:
    """Round to ``digits`` places the way DuckDB and numpy do: scale by 10^digits,
    round to an integer (half away from zero), scale back.

    Spark's ``round(x, d)`` rounds the shortest decimal string of ``x`` instead, so an
    interpolated quartile like 75962.525 (binary 75962.52499...) rounds up in Spark but
    down everywhere else.  Scaling first makes the result independent of the engine.
    """
    m = float(10 ** digits)
    return F.round(col(x) * F.lit(m), 0) / F.lit(m)


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``ROUND(100 * num / den, digits)`` in double arithmetic; NULL when den is 0.

    The literal is a double (a DECIMAL literal would change the result type), and
    ``try_divide`` keeps ANSI mode from raising on an empty input.
    """
    return dround(F.try_divide(F.lit(100.0) * num, den), digits)


def safe_ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def avg_r(c: str | Column, digits: int = 4) -> Column:
    """Average rounded to ``digits`` places: summation order differs between engines
    in the last bits, rounding makes the printed value engine-independent."""
    return dround(F.avg(col(c)), digits)


def band(c: str | Column, lo: float, hi: float, labels: Sequence[str]) -> Column:
    """Three bins: ``< lo``, ``BETWEEN lo AND hi`` (inclusive), otherwise.

    NULL falls to the last label, as a CASE without a matching arm does in SQL.
    """
    x = col(c)
    return (F.when(x < lo, F.lit(labels[0]))
            .when(x.between(lo, hi), F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def any_null(columns: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return cond


def arith_hash(key: str | Column, seed: int, modulus: int = 1000003) -> Column:
    """Integer hash that DuckDB can reproduce exactly (for oracle runs)."""
    k = F.pmod(col(key).cast("bigint"), F.lit(modulus))
    return F.pmod(k * F.lit(7919) + F.lit(seed * 104729), F.lit(modulus))


def key_hash(key: str | Column, seed: int, kind: str = "xxhash64") -> Column:
    """Row-key hash used to order rows randomly but reproducibly.

    ``xxhash64`` (default) is a well-mixed 64-bit hash; ``arith`` is the weak linear
    hash that the DuckDB oracle can compute.
    """
    if kind == "arith":
        return arith_hash(key, seed)
    if kind == "xxhash64":
        return F.xxhash64(col(key).cast("bigint"), F.lit(seed).cast("bigint"))
    raise ValueError(f"unknown hash kind {kind!r}")


# A generator without state: two quadratic steps modulo a prime.  Every product stays below 2**63, so
# Spark SQL and DuckDB compute the same numbers from the same text.
PRIME, OTHER_PRIME = 2147483647, 2147483629


def counter_random_sql(counter: str, stream: int) -> str:
    """SQL for a pseudo-random number in [0, PRIME) of a counter (a BIGINT from 0) in a stream."""
    a = f"(({counter} % {PRIME}) * 48271 + {stream * 69621 + 12345}) % {PRIME}"
    b = f"(({a}) * ({a}) % {PRIME} + ({a}) * 16807 % {PRIME} + {counter} % {OTHER_PRIME}) % {PRIME}"
    return f"((({b}) * ({b}) % {PRIME} + ({b}) * 40692 % {PRIME} + {stream}) % {PRIME})"
