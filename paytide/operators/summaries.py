"""Gold summaries.

Every summary is the same three moves: measure rows per key, merge measures if they were
taken at a finer grain, and present them under the table's column names. All measures
are mergeable (counts, exact sums, maxima), which buys two things at scale: Spark combines
them on the map side, so a dominant bank or hour costs one partial row per task, and a
single rollup of Silver can feed all four tables instead of four scans. Money is added in
fixed point, so the digits do not depend on how rows were split or merged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytide import schema as s
from paytide.functions.exact import exact_sum, exact_total, misfit_sum
from paytide.functions.scalars import money, rate_pct

# Finest grain any of the four tables needs.
ROLLUP_KEYS = (
    "txn_date",
    "txn_hour",
    "sender_bank",
    "txn_type",
    "merchant_category",
    "is_anomaly",
)

_AVERAGE = "amount_avg"


def measures(
    *,
    id_col: str = "txn_id",
    status_col: str = "status",
    amount: Column | str = "amount",
    success: str = "SUCCESS",
    failed: str = "FAILED",
    pending: str = "PENDING",
) -> list[Column]:
    """The mergeable measures of a set of rows. `amount` may be any numeric expression."""
    value = F.col(amount) if isinstance(amount, str) else amount
    having = {"n_success": success, "n_failed": failed, "n_pending": pending}
    return [
        F.count(id_col).alias("n"),
        *[F.count_if(F.col(status_col) == code).alias(name) for name, code in having.items()],
        exact_sum(value).alias("amount_sum"),
        misfit_sum(value).alias("amount_misfit"),
        F.count(value).alias("amount_n"),
        F.max(value).cast("double").alias("amount_max"),
    ]


def merged_measures() -> list[Column]:
    """Combine measures already taken at a finer grain."""
    counts = ["n", "n_success", "n_failed", "n_pending", "amount_n"]
    return [
        *[F.sum(c).alias(c) for c in counts],
        # Merged sums keep their type, so that they can be merged again.
        F.sum("amount_sum").cast("decimal(38,10)").alias("amount_sum"),
        F.sum("amount_misfit").alias("amount_misfit"),
        F.max("amount_max").alias("amount_max"),
    ]


def txn_rollup(df: DataFrame, keys: Sequence[str] = ROLLUP_KEYS) -> DataFrame:
    """Measures of Silver at the grain shared by all Gold tables."""
    return df.groupBy(*keys).agg(*measures())


@dataclass(frozen=True)
class Summary:
    """A Gold table: what it groups by, shows and sorts on, in column order."""

    keys: tuple[str, ...]
    columns: Mapping[str, str]
    rates: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    descending: str | None = None
    keep: Callable[[], Column] | None = None

    def present(self, measured: DataFrame, with_processed_at: bool) -> DataFrame:
        amount = exact_total(F.col("amount_sum"), F.col("amount_misfit"))

        def shown(measure: str) -> Column:
            if measure == "amount_sum":
                return money(amount)
            if measure == _AVERAGE:
                return money(F.try_divide(amount, F.col("amount_n")))
            return money(F.col(measure)) if measure.startswith("amount") else F.col(measure)

        out = [F.col(k) for k in self.keys]
        out += [shown(measure).alias(name) for name, measure in self.columns.items()]
        out += [
            rate_pct(F.col(part), F.col(whole)).alias(name)
            for name, (part, whole) in self.rates.items()
        ]
        if with_processed_at:
            out.append(F.current_timestamp().alias("processed_at"))
        first = [F.desc(self.descending)] if self.descending else []
        return measured.select(*out).orderBy(*first, *self.keys)

    def of_rows(
        self, df: DataFrame, *, with_processed_at: bool = True, **columns: Column | str
    ) -> DataFrame:
        """Summarise transactions; `columns` are passed on to `measures`."""
        rows = df.filter(self.keep()) if self.keep else df
        measured = rows.groupBy(*self.keys).agg(*measures(**columns))
        return self.present(measured, with_processed_at)

    def of_rollup(self, rollup: DataFrame, *, with_processed_at: bool = True) -> DataFrame:
        """Summarise a `txn_rollup`, giving the same rows as `of_rows` on its input."""
        rows = rollup.filter(self.keep()) if self.keep else rollup
        measured = rows.groupBy(*self.keys).agg(*merged_measures())
        return self.present(measured, with_processed_at)


# The output columns of the four tables.
SUMMARIES = {
    "hourly_txn_summary": Summary(
        keys=("txn_date", "txn_hour"),
        columns={
            "total_txns": "n",
            "successful_txns": "n_success",
            "failed_txns": "n_failed",
            "pending_txns": "n_pending",
            "total_amount": "amount_sum",
            "avg_amount": _AVERAGE,
            "max_amount": "amount_max",
        },
        rates={"success_rate": ("n_success", "n"), "failure_rate": ("n_failed", "n")},
    ),
    "bank_failure_analysis": Summary(
        keys=("sender_bank",),
        columns={
            "total_txns": "n",
            "failed_txns": "n_failed",
            "total_amount": "amount_sum",
            "avg_amount": _AVERAGE,
        },
        rates={"failure_rate_pct": ("n_failed", "n")},
        descending="failure_rate_pct",
    ),
    "merchant_spend_analysis": Summary(
        keys=("merchant_category",),
        columns={
            "total_txns": "n",
            "total_spend": "amount_sum",
            "avg_spend": _AVERAGE,
            "max_spend": "amount_max",
            "successful_txns": "n_success",
        },
        rates={"success_rate": ("n_success", "n")},
        descending="total_spend",
        keep=lambda: F.col("txn_type") == s.MERCHANT_TYPE,
    ),
    "anomaly_summary": Summary(
        keys=("txn_date", "sender_bank"),
        columns={
            "anomaly_count": "n",
            "total_anomaly_amount": "amount_sum",
            "avg_anomaly_amount": _AVERAGE,
            "max_anomaly_amount": "amount_max",
        },
        descending="anomaly_count",
        keep=lambda: F.col("is_anomaly"),
    ),
}


def hourly_txn_summary(df: DataFrame, **options) -> DataFrame:
    """Volume, money and outcome rates per batch date and hour."""
    return SUMMARIES["hourly_txn_summary"].of_rows(df, **options)


def bank_failure_analysis(df: DataFrame, **options) -> DataFrame:
    """Failure rate per sending bank, worst first."""
    return SUMMARIES["bank_failure_analysis"].of_rows(df, **options)


def merchant_spend_analysis(df: DataFrame, **options) -> DataFrame:
    """Spend per merchant category over merchant payments, largest first."""
    return SUMMARIES["merchant_spend_analysis"].of_rows(df, **options)


def anomaly_summary(df: DataFrame, **options) -> DataFrame:
    """Flagged transactions per date and bank, most first."""
    return SUMMARIES["anomaly_summary"].of_rows(df, **options)


def gold_tables(rollup: DataFrame, *, with_processed_at: bool = True) -> dict[str, DataFrame]:
    """All four tables from one rollup."""
    return {
        name: summary.of_rollup(rollup, with_processed_at=with_processed_at)
        for name, summary in SUMMARIES.items()
    }
