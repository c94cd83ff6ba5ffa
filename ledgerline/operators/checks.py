"""Column checks on built tables: not_null and unique."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    rule: str


# The checks published tables must pass.
CORE_CHECKS = [
    Check("dim_users", "user_key", "not_null"),
    Check("dim_users", "user_key", "unique"),
    Check("dim_users", "user_uuid", "not_null"),
    Check("dim_promo_codes", "promo_code_id", "not_null"),
    Check("dim_promo_codes", "promo_code_id", "unique"),
    Check("dim_exchange_rates", "rate_key", "not_null"),
    Check("dim_exchange_rates", "rate_key", "unique"),
    Check("dim_exchange_rates", "currency", "not_null"),
    Check("dim_exchange_rates", "valid_from", "not_null"),
    Check("dim_exchange_rates", "valid_to", "not_null"),
    Check("fact_transactions", "transaction_nk", "not_null"),
    Check("fact_transactions", "transaction_nk", "unique"),
    Check("fact_transactions", "created_at", "not_null"),
    Check("fact_cancellations", "cancellation_nk", "not_null"),
    Check("fact_cancellations", "cancellation_nk", "unique"),
    Check("fact_cancellation_matches", "cancellation_nk", "not_null"),
    Check("fact_cancellation_matches", "cancellation_nk", "unique"),
]

#: Where a rule stops a run for some rows of a table only. A rate that another of its time replaces has an empty interval:
#: it holds for no moment, so no fact has its key, and a key is found once among the rates that do hold.
STOPPING = {Check("dim_exchange_rates", "rate_key", "unique"): "valid_from < valid_to"}


class CheckFailure(RuntimeError):
    """A table broke one of its checks; nothing was published."""


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One pass over the table for all its not_null checks."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    tall = counts.select(F.expr(f"stack({len(columns)}, {pairs}) as (column_name, failures)"))
    return tall.select(F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("rule"), "failures")


def repeated_values(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values held by more than one row; NULLs do not count."""
    groups = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    failures = groups.agg(F.count_if(F.col("n") > 1).alias("failures"))
    return failures.select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit("unique").alias("rule"), "failures"
    )


def run_checks(tables: dict[str, DataFrame], checks: list[Check] = CORE_CHECKS, only: dict[Check, str] | None = None) -> DataFrame:
    """table_name, column_name, rule, failures for each check on the given tables; ``only`` names the rows that a unique check is about."""
    only, results = only or {}, []
    for name, df in tables.items():
        columns = [c.column for c in checks if c.table == name and c.rule == "not_null"]
        if columns:
            results.append(null_counts(df, name, columns))
        unique = [c for c in checks if c.table == name and c.rule == "unique"]
        results += [repeated_values(df.where(only[c]) if c in only else df, name, c.column) for c in unique]
    return reduce(DataFrame.unionByName, results)


def require(results: DataFrame) -> None:
    """Raise when any check failed (the result has one row per check)."""
    broken = results.where("failures > 0").collect()
    if broken:
        lines = [f"{r.table_name}.{r.column_name} {r.rule}: {r.failures}" for r in broken]
        raise CheckFailure("; ".join(lines))
