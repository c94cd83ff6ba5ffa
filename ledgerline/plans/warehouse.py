"""The batch tables as a graph of lazy frames over one set of raw tables."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from ledgerline.plans import dims, facts, marts, staging
from ledgerline.session import configure, declare_settled, settle, settled_at, wanted_partitions
from ledgerline.sources.keyed import KeyedRows


#: Key buckets of a file day where the raw rows are few or their size is not known.
LEAST_BUCKETS = 2


class Warehouse:
    """Each table is built from the others on first use.

    ``keep`` is called on the tables several others read: the default settles
    them in the shared folder, a rebuild stores them under their names instead.
    """

    def __init__(
        self,
        transactions: DataFrame,
        cancellations: DataFrame,
        exchange_rates: DataFrame,
        users: DataFrame,
        test_users: DataFrame,
        promo_codes: DataFrame,
        run_ts: datetime | None = None,
        keep=settle,
    ) -> None:
        configure(transactions.sparkSession)
        self.raw_transactions = transactions
        self.raw_cancellations = cancellations
        self.raw_exchange_rates = exchange_rates
        self.raw_users = users
        self.raw_test_users = test_users
        self.raw_promo_codes = promo_codes
        self.run_ts = run_ts
        self.keep = keep

    # Staging

    @cached_property
    def flagged(self) -> DataFrame:
        return staging.flagged_transactions(self.raw_transactions)

    def store_keyed(self) -> None:
        """Store the raw transactions with their keys, by file day and key bucket, for all tables that read them.

        The raw rows are scanned once for it, and not again by any table built afterwards.
        """
        spark, root = self.raw_transactions.sparkSession, settled_at(self.raw_transactions.sparkSession, "keyed")
        store = KeyedRows(spark, root, max(LEAST_BUCKETS, wanted_partitions(self.raw_transactions)))
        declare_settled(root, store.table)
        days = store.insert(self.raw_transactions, "all")
        self.flagged = staging.flagged_rows(store.rows(dict.fromkeys(days, ("all",)), days))

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.transactions(self.flagged)

    @cached_property
    def stg_cancellations(self) -> DataFrame:
        return staging.cancellations(self.raw_cancellations)

    @cached_property
    def stg_exchange_rates(self) -> DataFrame:
        return staging.exchange_rates(self.raw_exchange_rates)

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.users(self.raw_users, self.raw_test_users)

    @cached_property
    def stg_promo_codes(self) -> DataFrame:
        return staging.promo_codes(self.raw_promo_codes)

    # Core

    @cached_property
    def dim_users(self) -> DataFrame:
        return dims.users(self.raw_users, self.raw_test_users, self.run_ts)

    @cached_property
    def dim_promo_codes(self) -> DataFrame:
        return dims.promo_codes(self.stg_promo_codes, self.run_ts)

    @cached_property
    def held_rates(self) -> DataFrame:
        """What the fact reads of the rates: those whose interval is not empty by another rate of their time."""
        return settle(dims.held_rates(self.stg_exchange_rates), "held-rates")

    @cached_property
    def dim_exchange_rates(self) -> DataFrame:
        return self.keep(dims.exchange_rates(self.stg_exchange_rates, self.run_ts, held=self.held_rates), "dim_exchange_rates")

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return facts.transactions(
            self.flagged, self.dim_users, self.dim_promo_codes, self.held_rates, self.run_ts
        )

    @cached_property
    def fact_cancellations(self) -> DataFrame:
        return facts.cancellations(self.stg_cancellations, self.run_ts)

    @cached_property
    def fact_cancellation_matches(self) -> DataFrame:
        return facts.cancellation_matches(self.fact_cancellations, self.stored_transactions, self.run_ts)

    @cached_property
    def dq_transactions_duplicate(self) -> DataFrame:
        return facts.quarantine(self.flagged, self.run_ts)

    # Marts: the fact and the matches are each built once for all of them

    @cached_property
    def stored_transactions(self) -> DataFrame:
        return self.keep(facts.by_day(self.fact_transactions), "fact_transactions", facts.BY_DAY)

    @cached_property
    def stored_matches(self) -> DataFrame:
        built = facts.cancellation_matches(self.fact_cancellations, self.stored_transactions, self.run_ts)
        return self.keep(built, "fact_cancellation_matches")

    @cached_property
    def activity(self) -> DataFrame:
        return marts.hourly_activity(self.stored_transactions)

    @cached_property
    def mart_transactions_hourly(self) -> DataFrame:
        return marts.transactions_hourly(self.activity)

    @cached_property
    def mart_purchases_hourly(self) -> DataFrame:
        return marts.purchases_hourly(self.activity)

    @cached_property
    def mart_revenue_daily(self) -> DataFrame:
        return marts.revenue_daily(self.activity, self.stored_matches)

    @cached_property
    def mart_promo_usage(self) -> DataFrame:
        return marts.promo_usage(self.dim_promo_codes, self.fact_transactions)

    @cached_property
    def mart_traffic_source_daily(self) -> DataFrame:
        return marts.traffic_source_daily(self.activity, self.stored_matches)

    @cached_property
    def mart_currency_daily(self) -> DataFrame:
        return marts.currency_daily(self.activity)

    @cached_property
    def mart_cancellations_daily(self) -> DataFrame:
        return marts.cancellations_daily(self.activity, self.stored_matches)

    @cached_property
    def mart_user_cohorts(self) -> DataFrame:
        return marts.user_cohorts(self.fact_transactions)

    @cached_property
    def mart_data_quality_daily(self) -> DataFrame:
        return marts.data_quality_daily(
            self.flagged, self.dq_transactions_duplicate, self.activity, self.stored_matches
        )
