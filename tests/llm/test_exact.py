from collections import defaultdict

from pyspark.sql import functions as F

from dispatchboard.llm import exact
from dispatchboard.llm.shared import scratch
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, docs_frame, empty_frame, from_table


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return sorted(((doc_id, max((d for d in groups[text or ""] if d is not None), default=None),
                    len(groups[text or ""])) for doc_id, text in rows), key=repr)


def shown(rows):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in rows), key=repr)


def test_cases(spark):
    rows = exact.exact_duplicates(docs_frame(spark)).collect()
    assert shown(rows) == plain([(r[0], r[1]) for r in DOCS])
    assert sum(r["kept"] for r in rows) == len({r[1] or "" for r in DOCS})
    assert exact.exact_duplicates(empty_frame(spark)).collect() == []
    kept = exact.drop_exact_duplicates(docs_frame(spark))
    assert kept.columns == docs_frame(spark).columns
    assert kept.count() == len({r[1] or "" for r in DOCS})
    assert kept.where("doc_id = 2").count() == 1


def test_clashing_digests_are_told_apart_by_full_bytes(spark):
    docs = from_table(spark, SF_SMALL)
    rows = exact.exact_duplicates(docs, digest=lambda text: F.substring(F.sha2(text, 256), 1, 1)).collect()
    assert shown(rows) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_state_goes_on_from_an_earlier_run(spark):
    base = scratch(spark, "stream")
    own = exact.state_session(spark)

    def add(values):
        spark.createDataFrame(values, "doc_id long, digest string, at struct<file:string,row:long>") \
            .coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = own.readStream.schema(spark.read.parquet(f"{base}/in").schema).parquet(f"{base}/in")
        exact.digest_state(stream, f"{base}/state")
        return {r["digest"]: (r["keep"]["doc_id"], r["n"])
                for r in exact.read_state(own, f"{base}/state").collect()}
    assert add([(1, "a", ("f", 0)), (2, "b", ("f", 1))]) == {"a": (1, 1), "b": (2, 1)}
    assert add([(7, "a", ("g", 0)), (3, "c", ("g", 1))]) == {"a": (7, 2), "b": (2, 1), "c": (3, 1)}


def test_main_path_runs_no_python(spark):
    plan = exact.exact_duplicates(from_table(spark, SF_SMALL))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
