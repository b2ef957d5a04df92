"""Row filters and column masks by role.

Open-source Spark has no policy objects, so a policy is a function that builds the DataFrame a
role may see.  Give users that DataFrame (or a view of it) and keep the base table private: the
masks sit below every filter a user adds, so a predicate sees only masked values, but nothing
here protects the files themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlark.functions.masks import MASK_BY_TAG

ADMIN_ROLES = ("ACCOUNTADMIN",)
PLATFORM_ADMINS = ("SYSADMIN", "ACCOUNTADMIN")

Mask = Callable[[Column], Column]


def row_visible(role: str, column: str = "customer_id", admins=ADMIN_ROLES) -> Column:
    """Admins see all rows; the role ``<customer>_ROLE`` sees that customer's rows.

    The suffix is cut from the role instead of being added to the column, which leaves a plain
    equality that reaches the Parquet scan.
    """
    if role in admins:
        return F.lit(True)
    if not role.endswith("_ROLE"):
        return F.lit(False)
    return F.col(column) == role.removesuffix("_ROLE")


def rows_of_role(df: DataFrame, role: str, column: str = "customer_id", admins=ADMIN_ROLES) -> DataFrame:
    return df.where(row_visible(role, column, admins))


def visible_counts(df: DataFrame, roles: list[str], column: str = "customer_id") -> DataFrame:
    """Number of rows each role sees, counted in one pass."""
    counts = df.agg(*[F.count_if(row_visible(role, column)).alias(role) for role in roles])
    return counts.unpivot([], roles, "role", "n")


def rows_of_region(
    df: DataFrame, role: str, column: str, region: str, admins=PLATFORM_ADMINS
) -> DataFrame:
    return df if role in admins else df.where(F.col(column) == region)


def masked(df: DataFrame, role: str, masks: Mapping[str, Mask], admins=ADMIN_ROLES) -> DataFrame:
    if role in admins:
        return df
    return df.withColumns({name: mask(F.col(name)) for name, mask in masks.items()})


def secured(df: DataFrame, role: str, masks: Mapping[str, Mask], admins=ADMIN_ROLES) -> DataFrame:
    """What a role may see: its customer's rows with masked columns."""
    return masked(rows_of_role(df, role, admins=admins), role, masks, admins)


def tagged(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Attach ``pii_tag`` to columns as column metadata, which travels with the schema."""
    for name, tag in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "pii_tag": tag})
    return df


def masks_from_tags(df: DataFrame) -> dict[str, Mask]:
    tags = {field.name: field.metadata.get("pii_tag") for field in df.schema.fields}
    return {name: MASK_BY_TAG[tag] for name, tag in tags.items() if tag in MASK_BY_TAG}


def masked_by_tags(df: DataFrame, role: str, admins=PLATFORM_ADMINS) -> DataFrame:
    return masked(df, role, masks_from_tags(df), admins)


def customer_vehicles(vehicles: DataFrame, policies: DataFrame, email_domain: str = "fleet.example") -> DataFrame:
    """Vehicle registry with the two sensitive columns the masks protect.

    The serial number comes from the md5 of vehicle and device, so a retried task writes the same
    number again and any engine can check it.
    """
    name = F.concat_ws("|", "vehicle_id", "device_id").cast("binary")
    serial = F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint") % F.lit(90 * 9000)
    return (
        vehicles.drop("raw_retention_days", "tenant_isolation_enabled")
        .join(policies.select("customer_id", "raw_retention_days", "tenant_isolation_enabled"), "customer_id")
        .select(
            "customer_id",
            "customer_name",
            "vehicle_id",
            "device_id",
            "first_seen_ts",
            "last_seen_ts",
            "total_gps_events",
            "raw_retention_days",
            "tenant_isolation_enabled",
            F.format_string(
                "XX-%d-XX-%d", F.floor(serial / 9000) + 10, F.pmod(serial, F.lit(9000)) + 1000
            ).alias("device_serial_number"),
            F.concat(
                F.lit("driver_"),
                F.lower(F.replace("vehicle_id", F.lit("VH_"), F.lit(""))),
                F.lit("@" + email_domain),
            ).alias("driver_email"),
        )
    )
