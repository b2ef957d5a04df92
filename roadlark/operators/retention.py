"""Per-customer retention as one set-based filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlark.functions.timing import as_ntz, days_before


def _judged(rows: DataFrame, policies: DataFrame, as_of: Column | str, days: str) -> DataFrame:
    """Rows with ``_expired``: older than the shortest period of any policy of their customer.

    A customer without a policy, or with an open-ended one, keeps everything.
    """
    shortest = policies.groupBy("customer_id").agg(F.min(days).alias("_days"))
    cutoff = days_before(as_ntz(as_of), F.col("_days"))
    return rows.join(shortest, "customer_id", "left").withColumn(
        "_expired", F.coalesce(F.col("event_ts") < cutoff, F.lit(False))
    )


def policies_in_use(rows: DataFrame, policies: DataFrame, days: str = "raw_retention_days") -> DataFrame:
    """The shortest period of each customer that has rows, as policies that judge these rows alike.

    Rows name few customers as a rule, however many policies there are: once written, these are small
    enough for Spark to broadcast them, and no customer's rows have to be gathered in one place."""
    shortest = policies.groupBy("customer_id").agg(F.min(days).alias(days))
    return shortest.join(rows.select("customer_id").distinct(), "customer_id", "left_semi")


def retained(rows: DataFrame, policies: DataFrame, as_of: Column | str, days: str = "raw_retention_days") -> DataFrame:
    return _judged(rows, policies, as_of, days).where("NOT _expired").select(*rows.columns)


def expired(rows: DataFrame, policies: DataFrame, as_of: Column | str, days: str = "raw_retention_days") -> DataFrame:
    return _judged(rows, policies, as_of, days).where("_expired").select(*rows.columns)


def deleted_per_customer(rows: DataFrame, policies: DataFrame, as_of: Column | str) -> DataFrame:
    """Number of deleted rows per policy, zero included."""
    gone = expired(rows.select("customer_id", "event_ts"), policies, as_of).groupBy("customer_id")
    counts = gone.agg(F.count("*").alias("deleted"))
    return policies.select("customer_id").join(counts, "customer_id", "left").fillna(0, ["deleted"])


def deletion_message(rows: DataFrame, policies: DataFrame, as_of: Column | str) -> DataFrame:
    total = F.count("*")
    return expired(rows.select("customer_id", "event_ts"), policies, as_of).agg(
        F.concat(F.lit("RAW retention enforced. Total rows deleted: "), total.cast("string")).alias("message")
    )
