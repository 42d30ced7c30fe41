import hashlib

import pytest
import zstandard

from pyspark.sql import functions as F

from dispatchboard.llm import queries, warc
from tests.conftest import SF_ORACLE
from tests.llm.cases import from_table


def plain(pages):
    first = {}
    for page_id, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100:
            first[raw] = min(first.get(raw, page_id), page_id)
    out = {}
    for page_id, html in pages:
        raw = (html or "").encode()
        again = len(raw) >= 100 and first[raw] != page_id
        out[page_id] = (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                        first[raw] if again else None)
    return out


def shown(rows):
    return {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
            for r in rows}


def test_query_on_the_whole_table(spark):
    rows = queries.op10_warc(spark, SF_ORACLE).collect()
    pages = [(r["page_id"], r["html"]) for r in from_table(spark, SF_ORACLE, "pages").collect()]
    assert len(rows) == len(pages) and shown(rows) == plain(pages)


PAGES = [(i, f"http://x.org/{i}", "page text " * (5 + 40 * (i % 7))) for i in range(60)] + [
    (60, None, None), (61, "", ""), (62, "http://é.org/a b\r\nX: y", "é中" * 50), (63, "u", "x" * 3_000_000)]


@pytest.fixture()
def written(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 4000)
    folder = warc.archive_folder(spark)
    frame = spark.createDataFrame([(*p, "x", "x") for p in PAGES],
                                  "page_id long, url string, html string, digest string, place string")
    return folder, warc.write_bundles(frame, folder)


def test_round_trip_and_index(spark, written):
    folder, index = written
    rows = warc.read_bundles(spark, folder).collect()
    assert shown(rows) == plain([(p, h) for p, _, h in PAGES])
    at = ["record_id", "page_id", "bundle", "frame", "offset", "length"]
    assert {tuple(r[c] for c in at) for r in index.collect()} == {tuple(r[c] for c in at) for r in rows}
    for r in [r for r in index.collect() if r["page_id"] in (5, 60, 62, 63)]:
        fields, block = warc.fetch(folder, r["bundle"], r["frame"], r["offset"], r["length"])
        assert fields["WARC-Record-ID"] == f"<{r['record_id']}>" and fields["Page-ID"] == str(r["page_id"])
        if fields["WARC-Type"] == "response":
            assert block.split(b"\r\n\r\n", 1)[1] == (PAGES[r["page_id"]][2] or "").encode()
    names = {r["record_id"]: r["page_id"] for r in rows}
    for r in index.collect():
        fields, _ = warc.fetch(folder, r["bundle"], r["frame"], r["offset"], r["length"])
        if fields["WARC-Type"] == "revisit":
            assert names[fields["WARC-Refers-To"].strip("<>")] == int(fields["Refers-To-Page-ID"])


def test_bundles_are_plain_zstandard_and_frames_stand_alone(spark, written):
    folder, index = written
    fs, inner = warc._file_system(folder)
    name = index.first()["bundle"]
    with fs.open_input_file(f"{inner}/{name}") as file:
        table = warc.seek_table(file, file.size())
        whole = b"".join(warc.read_frame(file, *e) for e in table)
        file.seek(0)
        raw = file.read()
    assert len(table) > 2
    with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as reader:
        assert reader.read() == whole


def test_many_bundles_from_one_task(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 300)
    bundles = warc._Bundles(str(tmp_path), 3)
    places = [bundles.add(warc.record(i, i, "u", b"p" * 900, "0" * 64, None)) for i in range(20)]
    bundles.close()
    assert len({p[0] for p in places}) > 2 and not list(tmp_path.glob(".pages*"))
    for i, (name, frame, offset) in enumerate(places):
        fields, _ = warc.fetch(str(tmp_path), name, frame, offset, 10 ** 9)
        assert fields["Page-ID"] == str(i)


def test_cases(spark):
    text = "same payload " * 20
    frame = spark.createDataFrame([(7, "a", text), (7, "a", text), (None, "b", text), (None, None, None),
                                   (9, "c", "short"), (8, "c", "short")], "page_id long, url string, html string")
    rows = warc.archived(frame).collect()
    assert sorted((repr(r["page_id"]), r["record_type"], r["refers_to"]) for r in rows) == sorted([
        ("7", "response", None), ("7", "revisit", 7), ("None", "revisit", 7), ("None", "response", None),
        ("8", "response", None), ("9", "response", None)])
    assert len({r["record_id"] for r in rows}) == len(rows)
    assert warc.archived(frame.where("false")).collect() == []


def test_frames_are_read_back_by_many_tasks(spark, monkeypatch):
    """By the bytes they hold, not by the size of the rows that name them."""
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    pages = spark.range(110).selectExpr("id page_id", "cast(null as string) url",
                                        "concat(id, repeat(sha2(cast(id as string), 256), 20000)) html")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    out = warc.archived(pages)
    rows = out.withColumn("task", F.spark_partition_id()).collect()
    assert len({(r["bundle"], r["frame"]) for r in rows}) >= 100 and len(rows) == 110
    assert len({r["task"] for r in rows}) >= 4


def test_places_with_one_hash_keep_their_own_entries(spark, monkeypatch):
    """All places hash alike: every record must still find its own entry."""
    monkeypatch.setattr(warc.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    pages = spark.createDataFrame([(i, None, f"{i % 3}" * 200) for i in range(9)],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: r["refers_to"] for r in warc.archived(pages).collect()}
    assert got == {i: (i % 3 if i >= 3 else None) for i in range(9)}
