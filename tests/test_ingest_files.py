"""Files into bronze without the driver: listed, compared and read by tasks, each file once."""

import bz2
import gzip
import json
import os

import pytest
from pyspark.errors import AnalysisException

from hindsight.sources.bronze import read_bronze
from hindsight.sources.commits import Commits, Contended
from hindsight.streaming import ingest
from hindsight.streaming.ingest import document_stream, ingest_batch, ingest_stream


def write(root, name, content, at=1_700_000_000.987):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else json.dumps({"games": [{"uuid": content}]}).encode())
    os.utime(path, (at, at))


def uuids(spark, bronze):
    return sorted(r[0] for r in read_bronze(spark, bronze).selectExpr("inline(games)").select("uuid").collect())


def test_files_need_no_stream_whose_log_the_driver_holds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "ingest_stream", lambda *_: pytest.fail("as a stream"))
    monkeypatch.setattr(ingest, "document_stream", lambda *_: pytest.fail("listed by the driver"))
    root, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    for i in range(120):
        write(root, f"username=u{i}/later={i % 2}/a.json", f"g{i:03}")
    assert ingest_batch(spark, str(root), bronze) == 120
    assert ingest_batch(spark, str(root), bronze) == 0
    write(root, "username=u0/later=0/b.json", "h")
    assert ingest_batch(spark, str(root) + "/", bronze) == 1
    assert uuids(spark, bronze) == sorted([*(f"g{i:03}" for i in range(120)), "h"])


def test_a_late_file_of_an_old_date_is_read(spark, tmp_path):
    root, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    write(root, "a.json", "new")
    assert ingest_batch(spark, str(root), bronze) == 1
    write(root, "b.json", "old", at=1_600_000_000)
    assert ingest_batch(spark, str(root), bronze) == 1
    assert uuids(spark, bronze) == ["new", "old"]


def test_rows_are_those_of_the_stream(spark, tmp_path):
    root = tmp_path / "raw"
    names = ("a=1/x.json", "a=1/_k=v.json", "a=1/_hidden.json", "a=1/.dot", "c._COPYING_", "_dir/x.json", "_metadata/x.json", "_metadata.json")
    for name in (*names, "b=%20 ü+[x]*{y}?\\/x y%.json"):
        write(root, name, name)
    for name, content in {"empty": b"", "bad": b'{"games":[{"uuid":"\xff"}]}', "broken": b'{"games":[', "bom": b"\xef\xbb\xbf{}", "blank": b"\r\n"}.items():
        write(root, f"q/{name}.json", content)
    for name, packed in {"z.json.gz": gzip.compress, "[q]*.gz": gzip.compress, "Z.GZ": gzip.compress, "z.bz2": bz2.compress}.items():
        write(root, f"p/{name}", packed(json.dumps({"games": [{"uuid": name}]}).encode()))
    os.symlink(root / "p", root / "link")
    os.symlink("/nowhere", root / "dead")
    ours, streams = str(tmp_path / "ours"), str(tmp_path / "streams")
    assert ingest_batch(spark, str(root), ours) == 16
    ingest_stream(document_stream(spark, str(root)), streams, str(tmp_path / "seen"))
    columns = ["to_json(struct(games))", "_source_file", "string(_file_modified_at)", "to_json(_variant)", "hex(_raw)"]
    got, wanted = (sorted(map(str, read_bronze(spark, b).selectExpr(*columns).collect())) for b in (ours, streams))
    assert got == wanted


def test_folders_files_and_patterns(spark, tmp_path):
    root, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    for name in ("a/1.json", "b/2.json", "c/d/3.json"):
        write(root, name, name)
    assert ingest_batch(spark, f"{root}/{{a,b}}", bronze) == 2
    assert ingest_batch(spark, f"file://{root}/a/1.json", bronze) == 0
    assert ingest_batch(spark, f"{root}/c/d/3.json", bronze) == 1
    assert ingest_batch(spark, str(root), bronze) == ingest_batch(spark, f"{root}/none*", bronze) == 0
    assert uuids(spark, bronze) == ["a/1.json", "b/2.json", "c/d/3.json"]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest_batch(spark, f"{root}/none", bronze)


def test_a_run_that_dies_is_made_up_for(spark, tmp_path, monkeypatch):
    root, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    write(root, "a.json", "a")
    with monkeypatch.context() as patch:  # before its commit: nothing has happened
        patch.setattr(Commits, "put", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_batch(spark, str(root), bronze)
    assert read_bronze(spark, bronze) is None
    with monkeypatch.context() as patch:  # after it: the next one moves the rows
        patch.setattr(ingest, "_move", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_batch(spark, str(root), bronze)
    assert ingest_batch(spark, str(root), bronze) == 0
    assert uuids(spark, bronze) == ["a"]


def test_of_two_runs_each_file_is_read_by_one(spark, tmp_path, monkeypatch):
    root, bronze, put = tmp_path / "raw", str(tmp_path / "bronze"), Commits.put
    write(root, "a.json", "a")

    def other_first(log, number, content):
        monkeypatch.setattr(Commits, "put", put)
        assert ingest_batch(spark, str(root), bronze) == 1
        write(root, "b.json", "b")
        return put(log, number, content)

    monkeypatch.setattr(Commits, "put", other_first)
    assert ingest_batch(spark, str(root), bronze) == 1
    assert uuids(spark, bronze) == ["a", "b"]
    write(root, "c.json", "c")
    monkeypatch.setattr(Commits, "put", lambda *_: False)
    with pytest.raises(Contended):
        ingest_batch(spark, str(root), bronze)
    assert uuids(spark, bronze) == ["a", "b"]


def test_a_bronze_goes_on_as_it_was_begun(spark, tmp_path):
    root, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    write(root, "a.json", "a")
    ingest_stream(document_stream(spark, str(root)), bronze, f"{bronze}_read")
    write(root, "b.json", "b")
    assert ingest_batch(spark, str(root), bronze) == 1
    assert uuids(spark, bronze) == ["a", "b"]
    other = str(tmp_path / "other")
    assert ingest_batch(spark, str(root), other) == 2
    with pytest.raises(ValueError, match="begun by ingest_batch"):
        ingest_stream(document_stream(spark, str(root)), other, str(tmp_path / "seen"))
    assert uuids(spark, other) == ["a", "b"]


def test_games_of_a_document_are_built_once_a_pass(spark, tmp_path, monkeypatch):
    from querybook import ingestion

    columns = "event_id long, ts timestamp, user_id long, event_type string, value double"
    made = spark.range(60).selectExpr("id", "timestamp_seconds(1700000000 + id)", "id % 3", "'view'", "1.5D").toDF(*[c.split()[0] for c in columns.split(", ")])
    made.write.parquet(str(tmp_path / "events.parquet"))
    frames = []
    monkeypatch.setattr(ingestion.landing, "write_documents", lambda rows, *_: frames.append(rows))
    ingestion._documents(spark, str(tmp_path), "unused")
    games = sorted(json.dumps(g) for r in frames[0].collect() for g in json.loads(r["d"])["games"])
    wanted = ingestion.snapshots(spark, str(tmp_path)).selectExpr("to_json(struct(games)) d")
    assert games == sorted(json.dumps(g) for r in wanted.collect() for g in json.loads(r["d"])["games"])
    assert "(size(" not in frames[0]._jdf.queryExecution().optimizedPlan().toString()


def test_variants_are_written_whole(spark, tmp_path):
    import pyarrow.parquet as pq

    root, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    write(root, "a.json", "a")
    assert ingest_batch(spark, str(root), bronze) == 1
    assert "typed_value" not in str(pq.read_schema(next((tmp_path / "bronze").glob("part-*"))))
