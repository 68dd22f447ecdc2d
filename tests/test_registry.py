import random

import pytest
from pyspark.sql import functions as F

from phenoloom.functions.dates import DAY, epoch_seconds
from phenoloom.operators import registry


def seconds(text):
    import datetime
    return int(datetime.datetime.strptime(text, "%Y-%m-%d").replace(tzinfo=datetime.timezone.utc).timestamp())


def test_birth_dates_pad_month(spark):
    df = spark.createDataFrame(
        [(1, "1950", "4", "11012"), (2, "1960", "11", "11003"), (3, None, "5", None)],
        "userId int, x34_0_0 string, x52_0_0 string, x54_0_0 string",
    )
    got = {r.userId: r for r in registry.birth_dates(df).collect()}
    assert got[1].date_of_birth == seconds("1950-04-15") and got[1].month_of_birth == "04"
    assert got[2].date_of_birth == seconds("1960-11-15") and got[3].date_of_birth is None


def test_first_occurrence_values(spark):
    codes = ["1901-01-01", "2037-07-07", "1902-02-02", "1903-03-03", "12.5", "2000-01-01", None]
    wide = spark.createDataFrame(
        [(i, c, "x", "x") for i, c in enumerate(codes)], "eid int, `131494-0.0` string, `13-0.0` string, `131494-1.0` string"
    )
    births = spark.createDataFrame([(i, seconds("1950-04-15"), "04") for i in range(7)], "eid int, date_of_birth long, month_of_birth string")
    frame = registry.first_occurrence(wide, births)
    got = {r.eid: r.value for r in frame.entries.collect()}
    half_year = (seconds("1970-12-31") - seconds("1970-04-15")) / 2
    assert got == {0: None, 1: None, 2: 0.0, 3: half_year, 4: 12.5, 5: float(seconds("2000-01-01") - seconds("1950-04-15")), 6: None}
    assert frame.cols.collect()[0].trait_type == "icd_first_occurrence"


def test_activity_monitor_quality(spark):
    wide = spark.createDataFrame(
        [(1, None, 1, 1, 1, 5.0), (2, 3, 1, 1, 1, 6.0), (3, None, 1, None, 1, 7.0), (4, None, 1, None, 0, 8.0)],
        "eid int, `90002-0.0` int, `90015-0.0` int, `90016-0.0` int, `90017-0.0` int, `90012-0.0` double",
    )
    fields = spark.createDataFrame([("90012", "Continuous"), ("90015", "Integer")], "FieldID string, ValueType string")
    known = {r.eid: r.value for r in registry.activity_monitor(wide, fields).entries.collect()}
    assert known == {1: 5.0, 2: 6.0, 3: None, 4: 8.0}  # a false flag is known
    strict = {r.eid: r.value for r in registry.activity_monitor(wide, fields, strict=True).entries.collect()}
    assert strict == {1: 5.0, 2: None, 3: None, 4: None}


@pytest.mark.parametrize("window", [None, 1, 7, 30])
def test_any_within_matches_brute_force(spark, window):
    rng = random.Random(window or 0)
    starts = [(rng.choice(["hot", "a", "b"]), rng.randrange(-300, 300)) for _ in range(60)]
    outcomes = [(rng.choice(["hot", "a", "c", "d"]), rng.randrange(-300, 300)) for _ in range(60)]
    starts += [("edge", 0)]
    outcomes += [("edge", window if window else -1)]  # the end is exclusive
    got = {
        r.k: r.within
        for r in registry.any_within(
            spark.createDataFrame(starts, "k string, s long"), spark.createDataFrame(outcomes, "k string, o long"), ["k"], "s", "o", window
        ).collect()
    }
    want = {
        k: any(k == a == b and s <= o and (window is None or o < s + window) for a, s in starts for b, o in outcomes)
        for k in {x[0] for x in starts + outcomes}
    }
    assert got == want


def test_covid_window_and_analyses(spark):
    tests = spark.createDataFrame([(1, 0, 1, 0), (1, 1, 0, 0), (2, 0, 0, 1), (9, 0, 0, 0)], "eid int, origin int, result int, reqorg int")
    main = spark.createDataFrame(
        [(3, 0, None, "01/03/2020"), (4, 0, "01/03/2020", "28/02/2020"), (4, 1, None, "30/03/2020"), (5, 0, None, "01/03/2020"), (6, 0, None, "01/01/2020"), (7, 0, None, "01/01/2020")],
        "eid int, ins_index int, epistart string, admidate string",
    )
    diag = spark.createDataFrame(
        [(3, 0, "U071"), (3, 0, "J45"), (4, 0, "U071"), (4, 1, "J45"), (5, 0, "U071"), (6, 0, "J45")],
        "eid int, ins_index int, diag_icd10 string",
    )
    deaths = spark.createDataFrame([(3, "01/03/2020"), (4, "30/03/2020"), (5, "31/03/2020"), (8, "31/03/2020")], "eid int, date_of_death string")
    got = {r.eid: r for r in registry.covid_status(tests, main, diag, deaths).collect()}
    assert [got[i].death for i in (3, 4, 5, 8)] == [True, True, False, False]  # days 0, 29, 30
    assert got[4].inpatient2 and got[3].inpatient2 and not got[6].inpatient2
    assert got[1].result and got[1].inpatient is None and got[2].result is None and got[2].inpatient
    assert 7 not in got  # a visit without any diagnosis
    uncapped = {r.eid: r for r in registry.covid_status(tests, main, diag, deaths, window_days=None).collect()}
    assert uncapped[5].death
    samples = spark.createDataFrame([(1, 11012), (3, 11003), (6, None), (99, 11012)], "eid int, recruitment_center int")
    frame = registry.covid_matrix(samples, registry.covid_status(tests, main, diag, deaths), "02")
    cells = {(r.eid, r.coding): r.value for r in frame.entries.collect()}
    assert cells[(99, "C2_v2")] == 0.0 and cells[(99, "C1_v2")] is None
    assert cells[(3, "C2_v2_england_controls")] is None and cells[(1, "C2_v2_england_controls")] == 1.0
    assert cells[(1, "B1_v2_origin")] == 1.0 and cells[(3, "B2_v2_origin")] == 0.0
    assert frame.cols.filter("coding = 'C2_v2'").collect()[0].n_cases == 2


def test_prescriptions_order_and_lookup(spark):
    rows = [(1, 2, "d1", "03/02/2020"), (1, 2, "d1", ""), (1, 2, "d2", "01/02/2020"), (1, 2, "lost", "01/02/2020"), (1, 2, "none", "01/02/2020")]
    prescriptions = spark.createDataFrame(rows, "eid int, data_provider int, drug_name string, issue_date string")
    mapping = spark.createDataFrame(
        [("d1", "g", "c"), ("d1", "g", "c"), ("d2", "g", "c"), ("none", "", "c")],
        "Original_Prescription string, Generic_Name string, Drug_Category_and_Indication string",
    )
    records = registry.prescription_records(prescriptions, mapping)
    got = [(r.drug_name, r.issue_date) for r in records.orderBy("record").collect()]
    assert got == [("d2", seconds("2020-02-01")), ("d1", seconds("2020-02-03")), ("d1", None)]
    entry = registry.prescription_matrix(records).entries.collect()[0]
    assert entry.n_records == 3 and entry.first_date == seconds("2020-02-01")


def test_bad_dates_are_missing(spark):
    df = spark.createDataFrame([("31/02/2020",), ("5/3/2020",), ("x",), (None,)], "d string")
    got = [r[0] for r in df.select(epoch_seconds(F.col("d"), "d/M/yyyy")).collect()]
    assert got == [None, seconds("2020-03-05"), None, None] and DAY == 86400
