"""Column masks.  Each takes the clear value and returns the masked one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(value: Column) -> Column:
    return F.regexp_replace(value, ".+@", "****@")


def mask_serial(value: Column) -> Column:
    """Constant for every row, including missing values."""
    return F.lit("****-****")


def mask_license(value: Column) -> Column:
    return F.lit("****-MASKED-****")


def mask_phone(value: Column) -> Column:
    return F.concat(F.lit("XXX-XXX-"), F.right(value, F.lit(4)))


def mask_vin(value: Column) -> Column:
    return F.concat(F.lit("***VIN-"), F.right(value, F.lit(4)))


# Mask chosen by the value of a column's ``pii_tag``.
MASK_BY_TAG = {
    "EMAIL": mask_email,
    "DEVICE_SERIAL": mask_serial,
    "PHONE_NUMBER": mask_phone,
    "LICENSE": mask_license,
    "VEHICLE_VIN": mask_vin,
}
