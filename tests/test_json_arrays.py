"""JSON array files cut by bytes, against Python's own JSON reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dispatchboard.session import scratch_path
from dispatchboard.sinks import topics as TP
from dispatchboard.sources.json_arrays import read_json_array


@pytest.fixture
def split(spark):
    """Sets the bytes of a split."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
             "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
    yield set_to
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def written(spark, *texts):
    folder = scratch_path(spark, "arrays")
    for i, text in enumerate(texts):
        with open(f"{folder.replace('file:', '')}/{i}.json", "wb") as file:
            file.write(text.encode())
    return folder


def values(df):
    return sorted((json.dumps(json.loads(r["value"]), sort_keys=True) for r in df.collect()))


def plain(*texts):
    return sorted(json.dumps(e, sort_keys=True) for t in texts if t.strip() for e in json.loads(t))


def some(rng, depth=0):
    kind = rng.randint(0, 6 if depth < 3 else 3)
    if kind < 3:
        return "".join(rng.choice(['"', "\\", "}", "{", "[", "]", ",", "é", "\n", "a", "中", " ", "\\u0022"])
                       for _ in range(rng.randint(0, 12)))
    if kind == 3:
        return rng.choice([None, True, 1.5, -3])
    if kind == 4:
        return [some(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {f"k{i}{rng.choice(['', '}', '\"'])}": some(rng, depth + 1) for i in range(rng.randint(0, 4))}


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_random_arrays_at_any_split(spark, split, size):
    rng = random.Random(size)
    texts = [json.dumps([some(rng) for _ in range(rng.randint(0, 25))], indent=rng.choice([None, 1]),
                        ensure_ascii=rng.random() < 0.5) for _ in range(4)]
    split(size)
    assert values(read_json_array(spark, written(spark, *texts))) == plain(*texts)


def test_edges(spark, split):
    texts = ["[]", "", " [ ] \n", '[{"a":1}]\n', '["}", "x"]', "[1,2 , 3]", '\n[ {"a":[{"b":"]"}]} ,{"c":"\\"}"}]']
    for size in (3, 1 << 20):
        split(size)
        assert values(read_json_array(spark, written(spark, *texts))) == plain(*texts)
    with pytest.raises(Exception, match="not a JSON array"):
        read_json_array(spark, written(spark, '{"a": 1, "b": 2}')).collect()


def test_one_large_file_is_read_by_many_tasks(spark, split):
    rows = [{"id": i, "s": '}],{"[\\' * (i % 7)} for i in range(20000)]
    folder = written(spark, json.dumps(rows))
    split(32 * 1024)
    found = read_json_array(spark, folder)
    assert spark.read.option("lineSep", "}").text(folder).rdd.getNumPartitions() >= 8
    got = found.select(F.from_json("value", "id int, s string").alias("d")).select("d.*")
    assert sorted((r["id"], r["s"]) for r in got.collect()) == [(r["id"], r["s"]) for r in rows]


def test_an_element_larger_than_many_splits(spark, split):
    texts = [json.dumps([{"a": 1}, {"big": ["{}," * 50] * 40, "x": {"y": "]"}}, {"b": 2}])]
    split(50)
    assert values(read_json_array(spark, written(spark, *texts))) == plain(*texts)


def test_elements_are_published_as_they_are(spark, split):
    split(16)
    folder, loc = written(spark, '[{"a": 1, "z": "q}"}, {"b": [2]}]'), scratch_path(spark, "log-elements")
    TP.publish_json_file(spark, folder, "t", loc)
    log = TP.read_published(spark, loc, "t")
    assert {bytes(r["value"]).decode() for r in log.collect()} == {'{"a": 1, "z": "q}"}', '{"b": [2]}'}
    assert log.select("offset").distinct().count() == 2
    TP.publish_json_file(spark, folder, "u", loc, schema="a int")
    assert {bytes(r["value"]).decode() for r in TP.read_published(spark, loc, "u").collect()} == {'{"a":1}', "{}"}
