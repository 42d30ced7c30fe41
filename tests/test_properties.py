"""Properties on the driver tables."""

from pyspark.sql import functions as F

from dispatchboard.operators import calls as C
from dispatchboard.operators import keyed as K
from dispatchboard.operators import transit as T
from dispatchboard.plans import fixtures as X
from tests.conftest import SF_ORACLE


def test_dedup_idempotent(spark):
    d = K.distinct_calls(X.calls(spark, SF_ORACLE))
    assert K.distinct_calls(d).count() == d.count()


def test_window_counts_sum_to_six_per_triple(spark):
    calls = X.calls(spark, SF_ORACLE)
    d = K.distinct_calls(calls).where("call_date_time IS NOT NULL AND "
                                      "original_crime_type_name IS NOT NULL")
    total = C.call_counts(calls, sort=False).agg(F.sum("call_count")).first()[0]
    assert total == 6 * d.count()


def test_slots_independent_of_input_order(spark):
    arr = X.arrivals(spark, SF_ORACLE)
    st = T.line_stations(X.stops(spark, SF_ORACLE))
    a = sorted(map(tuple, T.slot_occupancy(arr, st).collect()), key=repr)
    shuffled = arr.orderBy(F.rand(7)).repartition(5)
    b = sorted(map(tuple, T.slot_occupancy(shuffled, st).collect()), key=repr)
    assert a == b


def test_latest_by_matches_row_number(spark):
    from pyspark.sql import Window
    s = X.stops(spark, SF_ORACLE)
    recs = T.station_records(s)
    w = Window.partitionBy("station_id").orderBy(F.col("stop_id").desc())
    rn = (recs.withColumn("rn", F.row_number().over(w)).where("rn = 1")
          .select("station_id", "station_name", "station_order", "line"))
    assert sorted(map(tuple, rn.collect())) == sorted(map(tuple, T.station_table(s).collect()))


def test_upsert_replay_is_idempotent(spark):
    from dispatchboard.session import scratch_path
    from dispatchboard.sinks.tables import KeyedTable
    tab = KeyedTable(spark, scratch_path(spark, "kt"), ["k"], ["o"])
    b0 = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, o int, v string")
    b1 = spark.createDataFrame([(1, 2, "c"), (1, 0, "z")], "k int, o int, v string")
    tab.upsert(b0, 0)
    tab.upsert(b1, 1)
    tab.upsert(b1, 1)  # replayed batch
    assert sorted(map(tuple, tab.read().collect())) == [(1, 2, "c"), (2, 1, "b")]


def test_neighbours_equal_whole_group_window(spark):
    """WIN-2 building block: sliced lag/lead equals lag/lead over a window
    holding each whole group, for a hot group spanning every slice, groups
    of one row, and null values."""
    import random
    from pyspark.sql import Window
    from dispatchboard.operators.keyed import neighbours
    rnd = random.Random(7)
    rows = [("hot", o, k, rnd.choice([None, 1, 2, 3])) for o, k in
            ((rnd.randint(0, 50), k) for k in range(600))]
    rows += [(f"g{i}", rnd.randint(0, 5), 1000 + i, i) for i in range(40)]
    rows += [("mid", o, 2000 + o, o) for o in range(30)]
    df = spark.createDataFrame(rows, "g string, o int, k int, v int")
    w = Window.partitionBy("g").orderBy("o", "k")
    want = sorted(df.select("g", "o", "k", F.lag("v").over(w).alias("prev"),
                            F.lead("v").over(w).alias("next")).collect())
    for slices in (1, 3, 16):
        got = neighbours(df, ["g"], ["o", "k"], "v", slices=slices)
        assert sorted(got.select("g", "o", "k", "prev", "next").collect()) == want
    got = neighbours(df, ["g"], ["o", "k"], "v")
    assert sorted(got.select("g", "o", "k", "prev", "next").collect()) == want


def test_bucket_first_windows_equal_spark_window(spark):
    """Batch flagship plan: counting per slide bucket and then expanding each
    bucket group into its windows equals Spark's sliding window()."""
    d = K.distinct_calls(X.calls(spark, SF_ORACLE))
    via_buckets = C.windows_from_buckets(C.bucket_counts(d))
    direct = C.windowed_counts(d)
    assert via_buckets.exceptAll(direct).count() == 0
    assert direct.exceptAll(via_buckets).count() == 0


def test_quarantine_split_partitions_rows(spark):
    """PRJ-20: good and bad outputs together hold every row once; a row is
    bad exactly when it has a value that isn't a JSON object."""
    import json
    import random
    from dispatchboard.schemas import CALL
    from dispatchboard.streaming.quarantine import split_malformed
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        kind = rnd.choice(["ok", "no_id", "garbage", "null"])
        v = {"ok": json.dumps({"crime_id": str(i), "disposition": "A"}),
             "no_id": json.dumps({"disposition": "A"}),
             "garbage": "<" + "x" * rnd.randint(0, 5),
             "null": None}[kind]
        rows.append((i, v, kind == "garbage"))
    df = spark.createDataFrame([(i, v) for i, v, _ in rows], "offset long, value string")
    good, bad = split_malformed(df, CALL)
    g = {r.offset for r in good.select("offset").collect()}
    b = {r.offset for r in bad.select("offset").collect()}
    assert not g & b and g | b == {i for i, _, _ in rows}
    assert b == {i for i, _, is_bad in rows if is_bad}
