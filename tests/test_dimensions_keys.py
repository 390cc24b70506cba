from conftest import lookup_df, reports_df
from pyspark.sql import Window
from pyspark.sql import functions as F

from avionyx.operators import dimensions, integrity, keys


def test_aircraft_dimension_first_wins_and_unknown_added_once(spark):
    lk = lookup_df(
        spark,
        [
            ("XY-AAA", "MSN 1", "A320", "Airbus"),
            ("XY-BBB", "MSN 2", "737", "Boeing"),
            ("XY-AAA", "MSN 9", "A350", "Airbus"),  # duplicate: the first row wins
        ],
    )
    r = reports_df(
        spark,
        [
            (1, "XY-ZZZ", "2020-01-01 00:00", "1", "PIREP"),
            (2, "XY-ZZZ", "2020-01-02 00:00", "1", "PIREP"),
            (3, None, "2020-01-02 00:00", "1", "PIREP"),
            (4, "XY-BBB", "2020-01-02 00:00", "1", "PIREP"),
        ],
    )
    dim = {d.Aircraft_Registration_Code: d for d in dimensions.aircraft_dimension(dimensions.aircraft_members(lk, r)).collect()}
    assert set(dim) == {"XY-AAA", "XY-BBB", "XY-ZZZ"}
    assert dim["XY-AAA"].Manufacturer_Serial_Number == "MSN 1"
    assert dim["XY-ZZZ"].Aircraft_Manufacturer_Class is None
    # lookup aircraft get the low keys, report-only aircraft after them
    assert sorted(d.Aircraft_ID for d in dim.values()) == [1, 2, 3]
    assert dim["XY-ZZZ"].Aircraft_ID == 3


def test_surrogate_keys_are_dense_and_ordered_across_partitions(spark):
    members = spark.range(0, 5000).select(F.format_string("R%05d", (F.col("id") * 7919) % 5000).alias("reg"))
    keyed = keys.assign_surrogate_keys(members, ["reg"], "key", num_partitions=6)
    expected = members.select("reg", F.row_number().over(Window.orderBy("reg")).alias("want"))
    joined = keyed.join(expected, "reg")
    assert joined.count() == 5000
    assert joined.filter(F.col("key") != F.col("want")).count() == 0
    assert integrity.check_unique(keyed, ["key"]).count() == 0


def test_ensure_dimension_is_idempotent(spark):
    existing = keys.assign_surrogate_keys(
        spark.createDataFrame([("A",), ("B",)], "reg string"), ["reg"], "id"
    )
    cand = spark.createDataFrame([("B",), ("C",), ("C",), ("D",)], "reg string")
    new = keys.ensure_dimension(existing, cand, ["reg"], "id")
    assert sorted((r.id, r.reg) for r in new.collect()) == [(3, "C"), (4, "D")]
    grown = existing.unionByName(new)
    assert keys.ensure_dimension(grown, cand, ["reg"], "id").count() == 0


def test_calendar_dimensions(spark):
    f = spark.createDataFrame(
        [("2020-02-29 23:00",), ("2020-02-29 01:00",), ("2021-01-01 00:00",), (None,)], "s string"
    ).select(F.to_timestamp_ntz("s").alias("scheduleddeparture"))
    dates = dimensions.date_dimension(dimensions.date_members(f)).orderBy("Date_ID").collect()
    assert [(d.Date_ID, d.Day_Num, d.Month_Num, d.Year) for d in dates] == [(1, 29, 2, 2020), (2, 1, 1, 2021)]


def test_key_files_follow_the_members_not_the_session(spark):
    from avionyx.operators import keys

    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        keyed = keys.assign_surrogate_keys(spark.range(500).selectExpr("id AS k"), ["k"], "key")
        assert len(keyed.inputFiles()) <= 2
        assert [r["key"] for r in keyed.orderBy("k").collect()] == list(range(1, 501))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_aircraft_members_without_lookup_lines(spark):
    lookup = lookup_df(spark, [("A", "2", "m", "Airbus"), ("A", "1", "m", "Airbus")]).drop("lookup_line")
    assert [r.Manufacturer_Serial_Number for r in dimensions.aircraft_members(lookup).collect()] == ["1"]

