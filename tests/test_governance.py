from helpers import plan_of
from pyspark.sql import functions as F

from roadlark.functions import masks
from roadlark.operators import governance

ROWS = [("A", "driver_1@fleet.example", "XX-1"), ("A", None, None), ("B", "x@y", "XX-2")]
MASKS = {"email": masks.mask_email, "serial": masks.mask_serial}


def table(spark):
    return spark.createDataFrame(ROWS, "customer_id string, email string, serial string")


def test_rows_of_role(spark):
    df = table(spark)
    assert governance.rows_of_role(df, "ACCOUNTADMIN").count() == 3
    assert governance.rows_of_role(df, "A_ROLE").count() == 2
    assert governance.rows_of_role(df, "A").count() == 0
    counts = {r.role: r.n for r in governance.visible_counts(df, ["ACCOUNTADMIN", "A_ROLE", "B_ROLE"]).collect()}
    assert counts == {"ACCOUNTADMIN": 3, "A_ROLE": 2, "B_ROLE": 1}
    assert counts["A_ROLE"] + counts["B_ROLE"] == counts["ACCOUNTADMIN"]


def test_masked_values_differ_from_clear_ones(spark):
    got = governance.secured(table(spark), "A_ROLE", MASKS).collect()
    assert {(r.email, r.serial) for r in got} == {("****@fleet.example", "****-****"), (None, "****-****")}
    assert governance.secured(table(spark), "ACCOUNTADMIN", MASKS).collect() == table(spark).collect()


def test_filter_sees_masked_values_only(spark):
    seen = governance.secured(table(spark), "B_ROLE", MASKS)
    assert seen.where("email = 'x@y'").count() == 0
    assert seen.where("email = '****@y'").count() == 1


def test_tags_choose_masks(spark):
    df = governance.tagged(table(spark), {"email": "EMAIL"})
    got = governance.masked_by_tags(df, "ANALYST").where("customer_id = 'B'").first()
    assert (got.email, got.serial) == ("****@y", "XX-2")
    assert governance.masked_by_tags(df, "SYSADMIN").where("email = 'x@y'").count() == 1


def test_suffix_masks(spark):
    row = spark.range(1).select(masks.mask_phone(F.lit("+91-9876543210")), masks.mask_vin(F.lit("MAT60001"))).first()
    assert tuple(row) == ("XXX-XXX-3210", "***VIN-0001")


def test_region(spark):
    df = spark.createDataFrame([("Pune-Chikhali",), ("Else",)], "r string")
    assert governance.rows_of_region(df, "ANALYST", "r", "Pune-Chikhali").count() == 1
    assert governance.rows_of_region(df, "SYSADMIN", "r", "Pune-Chikhali").count() == 2


def test_row_filter_reaches_the_scan(spark, tmp_path):
    table(spark).write.parquet(f"{tmp_path}/t")
    plan = plan_of(governance.secured(spark.read.parquet(f"{tmp_path}/t"), "A_ROLE", MASKS))
    assert "EqualTo(customer_id,A)" in plan
