"""Documents are published by commit: whole jobs or nothing, and never an attempt that doesn't count."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from lectern.sources import store


def docs(spark, n, text="x", parts=4):
    return spark.range(0, n, 1, parts).select(F.concat(F.lit("m/"), F.col("id") % 3, F.lit("/"), "id", F.lit(".json")).alias("path"), F.concat(F.lit('{"t": "'), F.lit(text), F.lit('"}\n')).alias("json"))


def files(folder):
    return sorted(str(x.relative_to(folder)) for x in folder.rglob("*") if x.is_file())


def test_round_trip_and_replacement(spark, tmp_path):
    store.write_documents(docs(spark, 10, "é "), f"file://{tmp_path}")
    store.write_documents(docs(spark, 3, "new"), str(tmp_path))
    found = {x.path: json.loads(x.json)["t"] for x in store.read_documents(spark, str(tmp_path)).collect()}
    assert found == {f"m/{k % 3}/{k}.json": "new" if k < 3 else "é " for k in range(10)}
    assert files(tmp_path) == sorted(found)
    store.write_documents(docs(spark, 0), str(tmp_path / "none"))
    assert store.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_other_endings(spark, tmp_path):
    store.write_documents(docs(spark, 4).withColumn("path", F.concat("path", F.lit(".conf"))), str(tmp_path), suffix=".conf")
    assert len(files(tmp_path)) == 4 and store.read_documents(spark, str(tmp_path)).count() == 0
    assert spark.read.format("documents").option("suffix", ".conf").load(str(tmp_path)).count() == 4


def test_an_aborted_job_leaves_nothing(spark, tmp_path):
    store.write_documents(docs(spark, 6, "old"), str(tmp_path))
    before = files(tmp_path)
    bad = docs(spark, 60, "new").withColumn("json", F.when(F.col("path") == "m/1/58.json", F.raise_error(F.lit("broken row"))).otherwise(F.col("json")))
    with pytest.raises(Exception, match="broken row"):
        store.write_documents(bad, str(tmp_path))
    with pytest.raises(Exception, match="over the ceiling"):
        store.write_documents(docs(spark, 60, "long" * 9), str(tmp_path), ceiling=30)
    with pytest.raises(Exception, match="unsafe path"):
        store.write_documents(docs(spark, 6, "new").withColumn("path", F.lit("../x.json")), str(tmp_path))
    with pytest.raises(Exception, match="two tasks wrote one path"):
        store.write_documents(docs(spark, 6, "new").union(docs(spark, 6, "new")), str(tmp_path))
    with pytest.raises(Exception, match="append"):
        docs(spark, 1).write.format("documents").mode("overwrite").save(str(tmp_path))
    assert files(tmp_path) == before and {x.json for x in store.read_documents(spark, str(tmp_path)).collect()} == {'{"t": "old"}\n'}


def test_a_lost_attempt_is_never_seen(tmp_path):
    """Two attempts of one task, the first killed after some files; a commit cut short is finished later."""
    writer = store.DocumentsWriter(str(tmp_path), 0, ["json", "path"])

    def dying():
        yield Row("{}", "a.json")
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(dying())
    good = writer.write(iter([Row('{"n": 1}', "a.json"), Row('{"n": 2}', "b/c.json")]))
    assert (good.documents, good.size) == (2, 16) and store.visible(*store.opened(str(tmp_path))) == []
    real = store.promoted
    store.promoted = lambda *x: None
    try:
        writer.commit([good, None])
    finally:
        store.promoted = real
    assert store.visible(*store.opened(str(tmp_path))) == []
    store.recover(str(tmp_path))
    assert files(tmp_path) == ["a.json", "b/c.json"] and (tmp_path / "a.json").read_text() == '{"n": 1}'
    late = store.DocumentsWriter(str(tmp_path), 0, ["path", "json"])
    late.write(iter([Row("d.json", "{}")]))
    store.recover(str(tmp_path))
    assert files(tmp_path) == ["a.json", "b/c.json"]
    late.abort([])
