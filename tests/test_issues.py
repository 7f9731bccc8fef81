"""Units offered nearby: missing unit ids are one unit."""

from shortfall.operators import issues

SCHEMA = "fiu_id string, fsn string, dest_pincode string, lzn_value string, is_accepted string, effective_inventory double"


def offers(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def counted(df):
    return {(r.fsn, r.dest_pincode): r.fe_issue for r in issues.units_offered_nearby(df).collect()}


def test_missing_unit_ids_match_and_count_once(spark):
    near = [(u, "p", "d", "L1", "false", 2.0) for u in (None, None, "u1", "u2")]
    national = [(u, "q", "e", "N1", "true", 0.0) for u in (None, "u1")]
    assert counted(offers(spark, near + national)) == {("p", "d"): 2}
    assert counted(offers(spark, near + national[1:])) == {("p", "d"): 1}
    assert counted(offers(spark, near[:2] + national[:1])) == {("p", "d"): 1}


def test_numbers_as_unit_ids(spark):
    df = offers(spark, [("7", "p", "d", "Z1", "false", 1.0), (None, "p", "d", "Z1", "false", 1.0), (None, "q", "e", "N2", "TRUE", 0.0)])
    assert counted(df.withColumn("fiu_id", df.fiu_id.cast("bigint"))) == {("p", "d"): 1}


def test_destination_named_in_full(spark):
    df = offers(spark, [("7", "p", "d", "Z1", "false", 1.0), ("7", "q", "e", "N2", "TRUE", 0.0)])
    full = df.withColumnRenamed("dest_pincode", "destination_pincode")
    assert issues.fulfilment_engine_issue(full).first().fe_issue == 1
