"""What resharding leaves behind."""

from matchlake.llm import resharding


def test_files_hold_whole_documents(spark, make_docs, hostile, tmp_path):
    docs, path = make_docs(hostile), str(tmp_path / "shards")
    digest = resharding.reshard(docs, new_shards=5, path=path)
    files = spark.read.parquet(path)
    assert set(files.columns) == {*docs.columns, "_shard"}
    assert sorted(map(str, files.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert any(f"{path}/_shard=" in f for f in digest.inputFiles())
    assert digest.count() == len(hostile)


def test_other_names(make_docs, hostile):
    docs = make_docs(hostile).withColumnsRenamed({"doc_id": "id", "text": "body"})
    assert resharding.reshard(docs, "id", "body", 5).count() == len(hostile)
