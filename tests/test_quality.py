"""Declared constraints as checks: a CHECK passes on TRUE or NULL; keys and
foreign keys on small in-code tables."""

from skyfold.operators import quality as Q


def test_range_rule_null_passes_false_fails(spark):
    t = spark.createDataFrame([(1, 100), (2, None), (3, -5)], "route_id int, distance_km int")
    got = Q.dq_range_checks({"route": t}, [("route", "distance_positive", "distance_km > 0")]).first()
    assert (got.rows_checked, got.violations) == (3, 1)


def test_enum_rule(spark):
    r = spark.createDataFrame([("HELD",), ("CONFIRMED",), ("LOST",), (None,)], "status string")
    got = Q.dq_enum_checks({"reservation": r}, [("reservation", "status", ("HELD", "CONFIRMED"))]).first()
    assert got.violations == 1


def test_unique_keys_ignore_null_parts(spark):
    t = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, j string")
    got = Q.dq_unique_checks({"t": t}, [("t", "kj", ("k", "j"))]).first()
    assert (got.duplicate_keys, got.duplicate_rows) == (1, 2)


def test_composite_foreign_key_orphans(spark):
    child = spark.createDataFrame([(1, "ECO"), (1, "BUS"), (2, "ECO"), (None, "ECO")],
                                  "flight_instance_id long, cabin_code string")
    parent = spark.createDataFrame([(1, "ECO"), (2, "ECO")], "flight_instance_id long, cabin_code string")
    fk = [("segment_inventory", "seg", ("flight_instance_id", "cabin_code"), "inv", ("flight_instance_id", "cabin_code"))]
    assert Q.dq_foreign_keys({"seg": child, "inv": parent}, fk).first().orphans == 1
