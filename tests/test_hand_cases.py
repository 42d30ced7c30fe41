"""Hand cases of FIXTURES.md on tiny frames."""

import datetime as dt

from pyspark.sql import functions as F

from dispatchboard.functions import scalars as S
from dispatchboard.operators import calls as C
from dispatchboard.operators import transit as T
from dispatchboard.schemas import CALL
from dispatchboard.streaming.quarantine import split_malformed

CALLS_DDL = "call_date_time timestamp, original_crime_type_name string, disposition string"


def _calls(spark, rows):
    return spark.createDataFrame(rows, CALLS_DDL)


def t(h, m, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


def test_duplicate_triple_counted_once(spark):
    df = _calls(spark, [(t(10, 5), "theft", "A"), (t(10, 5), "theft", "A")])
    out = C.call_counts(df).collect()
    assert len(out) == 6 and all(r.call_count == 1 for r in out)


def test_null_type_group_with_count_zero(spark):
    out = C.call_counts(_calls(spark, [(t(10, 5), None, "A")])).collect()
    assert len(out) == 6 and all(r.call_count == 0 for r in out)


def test_null_disposition_own_group_and_no_description(spark):
    codes = spark.createDataFrame([("A", "Arrest")], "disposition_code string, description string")
    df = _calls(spark, [(t(10, 5), "theft", None), (t(10, 5), "theft", "A")])
    out = C.with_disposition(C.call_counts(df), codes).collect()
    nulls = [r for r in out if r.disposition is None]
    assert len(nulls) == 6 and all(r.description is None for r in nulls)
    assert {r.description for r in out if r.disposition == "A"} == {"Arrest"}


def test_null_time_in_no_window(spark):
    assert C.call_counts(_calls(spark, [(None, "theft", "A")])).count() == 0


def test_call_at_1005_lands_in_six_windows(spark):
    out = C.call_counts(_calls(spark, [(t(10, 5), "theft", "A")])).collect()
    starts = sorted(r.window_start for r in out)
    assert starts == [t(9, 10), t(9, 20), t(9, 30), t(9, 40), t(9, 50), t(10, 0)]
    assert all(r.window_end - r.window_start == dt.timedelta(hours=1) for r in out)


def test_code_listed_twice_doubles_rows(spark):
    codes = spark.createDataFrame([("A", "x"), ("A", "y")],
                                  "disposition_code string, description string")
    out = C.with_disposition(C.call_counts(_calls(spark, [(t(10, 5), "theft", "A")])), codes)
    assert out.count() == 12


def test_bad_json_goes_to_quarantine(spark):
    df = spark.createDataFrame([(1, b'{"crime_id": "1"}'), (2, b"not json"), (3, None)],
                               "offset long, value binary")
    good, bad = split_malformed(df, CALL)
    assert [r.offset for r in bad.collect()] == [2]
    assert sorted(r.offset for r in good.collect()) == [1, 3]
    dec = df.select(S.decode_json("value", CALL).alias("d")).where("offset = 2")
    assert all(v is None for v in dec.collect()[0].d)


def test_bad_means_not_a_json_object(spark):
    texts = ['{"disposition": "A"}', "{}", '{"unknown": 1}', '{"disposition": "A"', "[1]", "5", "", "null",
             ' {"city": null} ', '{"call_date_time": "never", "disposition": "B"}']
    df = spark.createDataFrame(list(enumerate(texts)), "offset long, value string")
    good, bad = split_malformed(df, CALL, fields=["call_date_time", "disposition"])
    assert sorted(r.offset for r in bad.collect()) == [3, 4, 5, 6, 7]
    assert {r.offset: r.disposition for r in good.collect()} == {0: "A", 1: None, 2: None, 8: None, 9: "B"}
    _, strict = split_malformed(df, CALL, fields=["disposition"], required=["disposition"])
    assert sorted(r.offset for r in strict.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_call_times_in_every_form(spark):
    forms = ["2018-12-31T23:57:00.000", "2018-12-31T23:57:00", "2018-12-31 23:57:00", "2018-12-31T23:57:00.000000Z",
             "2019-01-01T00:57:00+01:00", "2018-12-31T23:57:00.000000+00:00"]
    df = spark.createDataFrame([('{"call_date_time": "%s"}' % f,) for f in forms], "value string")
    got = df.select(S.decode_json("value", CALL)["call_date_time"].cast("timestamp_ntz").alias("t")).collect()
    assert {r.t for r in got} == {dt.datetime(2018, 12, 31, 23, 57)} and len(got) == len(forms)


ARR_DDL = ("line string, station_id int, direction string, train_id string, "
           "train_status string, prev_station_id int, prev_direction string, "
           "timestamp timestamp, offset long")


def _slots(spark, rows, stations=((1,), (2,))):
    st = spark.createDataFrame([("red", s) for (s,) in stations], "line string, station_id int")
    arr = spark.createDataFrame(rows, ARR_DDL)
    return {(r.line, r.station_id): r for r in T.slot_occupancy(arr, st).collect()}


def test_second_train_takes_slot(spark):
    out = _slots(spark, [("red", 1, "a", "T1", "in_service", None, None, t(1, 0), 1),
                         ("red", 1, "a", "T2", "broken_down", None, None, t(1, 1), 2)])
    assert out[("red", 1)].dir_a == "T2" and out[("red", 1)].dir_a_status == "broken down"


def test_departure_clears_slot_held_by_other_train(spark):
    out = _slots(spark, [("red", 1, "a", "T2", "in_service", None, None, t(1, 0), 1),
                         ("red", 2, "a", "T1", "in_service", 1, "a", t(1, 1), 2)])
    assert out[("red", 1)].dir_a is None and out[("red", 2)].dir_a == "T1"


def test_clear_and_set_same_slot_in_one_event(spark):
    out = _slots(spark, [("red", 1, "a", "T1", "in_service", 1, "a", t(1, 0), 1)])
    assert out[("red", 1)].dir_a == "T1"


def test_previous_direction_null_clears_nothing(spark):
    out = _slots(spark, [("red", 1, "a", "T1", "in_service", None, None, t(1, 0), 1),
                         ("red", 2, "b", "T2", "in_service", 1, None, t(1, 1), 2)])
    assert out[("red", 1)].dir_a == "T1"


def test_other_direction_is_slot_b(spark):
    out = _slots(spark, [("red", 1, "x", "T1", "in_service", None, None, t(1, 0), 1)])
    assert out[("red", 1)].dir_b == "T1" and out[("red", 1)].dir_a is None


def test_unknown_station_still_clears_previous(spark):
    out = _slots(spark, [("red", 1, "b", "T1", "in_service", None, None, t(1, 0), 1),
                         ("red", 9, "a", "T1", "in_service", 1, "b", t(1, 1), 2)])
    assert ("red", 9) not in out and out[("red", 1)].dir_b is None


def test_weather_default_and_truncation(spark):
    empty = spark.createDataFrame([], "temperature float, status string, timestamp timestamp, offset long")
    r = T.current_weather(empty).collect()[0]
    assert (r.temperature, r.weather) == (70, "Sunny")
    one = spark.createDataFrame([(-7.9, "partly_cloudy", t(1, 0), 1)],
                                "temperature float, status string, timestamp timestamp, offset long")
    r = T.current_weather(one).collect()[0]
    assert (r.temperature, r.weather) == (-7, "Partly Cloudy")


def test_table_reading_counts_keys_not_riders(spark):
    rows = [(100, 5, 1), (100, 5, 2), (100, 5, 3)]
    df = spark.createDataFrame(rows, "key long, station_id int, offset long")
    assert T.entries_per_station_table(df).collect()[0].entries == 1
    assert T.entries_per_station(df).collect()[0].entries == 3


def test_epoch_key_rounds_half_even(spark):
    df = spark.createDataFrame([(1_700_000_000_000_500,), (1_700_000_000_001_500,)], "us long")
    out = [r.k for r in df.select(S.epoch_ms_key(F.timestamp_micros("us")).alias("k")).collect()]
    assert out == [1_700_000_000_000, 1_700_000_000_002]


def test_rides_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r.r for r in df.select(S.round_half_even("x").alias("r")).collect()] == [0, 2, 2]


def test_slug_and_colour(spark):
    df = spark.createDataFrame([("Harlem/Lake", "blue"), ("O'Hare-Airport Way", "pink")],
                               "n string, line string")
    out = df.select(S.name_slug("n").alias("s"), S.color_code("line").alias("c")).collect()
    assert [(r.s, r.c) for r in out] == [("harlem_and_lake", "#1E90FF"),
                                        ("ohare_airport_way", "0xFFFFFF")]


def test_line_colour_first_match(spark):
    df = spark.createDataFrame([(True, True, False), (False, False, False), (False, None, True)],
                               "red boolean, blue boolean, green boolean")
    assert [r.l for r in df.select(S.line_color().alias("l")).collect()] == ["red", "unknown", "green"]


def test_start_positions(spark):
    from dispatchboard.sources.topics import apply_start
    df = spark.createDataFrame([("t", p, o) for p in (0, 1, 2) for o in range(5)],
                               "topic string, partition int, offset long")
    assert apply_start(df, "earliest").count() == 15
    assert apply_start(df, "latest").count() == 0
    assert apply_start(df, {0: 3, 1: -1}).count() == 2 + 0 + 5
    assert apply_start(df, {"t": {2: 4}}).count() == 5 + 5 + 1


def test_expected_entries_calendar_days(spark):
    from dispatchboard.sources.files import read_ridership_curve
    seed = spark.createDataFrame([(1, 3000.0, 1500.0, 600.0)],
                                 "station_id int, avg_weekday_rides double, "
                                 "avg_saturday_rides double, `avg_sunday-holiday_rides` double")
    # 2024-01-06 is a Saturday, 2024-01-07 a Sunday, hour 8 ratio 0.125.
    steps = spark.createDataFrame([(1, dt.datetime(2024, 1, d, 8)) for d in (5, 6, 7)],
                                  "station_id int, step_time timestamp")
    curve = read_ridership_curve(spark)
    ref = [r.expected_entries for r in
           T.expected_entries(steps, seed, curve, 60).orderBy("step_time").collect()]
    cal = [r.expected_entries for r in
           T.expected_entries(steps, seed, curve, 60, "calendar").orderBy("step_time").collect()]
    assert ref == [6, 6, 6] and cal == [6, 3, 1]
