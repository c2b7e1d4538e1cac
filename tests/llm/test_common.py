import re
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.support import documents
from textpulse.llm.common import drop_written, map_with_id, result_only, word_count, written
from textpulse.llm.jaccard_join import word_hashes
from textpulse.llm.training import labelled_ids


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\n", "é\x0bü", "a b c", "x" * 5000 + "\r\ny"]
    rows = documents(spark, [(n, t, None) for n, t in enumerate(texts)])
    found = {r.doc_id: r.n for r in rows.select("doc_id", word_count(F.col("text")).alias("n")).collect()}
    for n, text in enumerate(texts):
        assert found[n] == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x1f ", max_size=20)), max_size=6))
def test_word_hashes(texts):
    hashes, counts = word_hashes(texts)
    words = [w for t in texts for w in (t or "").encode().lower().split()]
    assert counts.tolist() == [len((t or "").encode().split()) for t in texts]
    assert len(hashes) == len(words)
    seen = {}
    for word, value in zip(words, hashes.tolist(), strict=True):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_large_ids_with_nulls_survive_python(spark):
    rows = documents(spark, [(9007199254740993, "x", None), (None, "y", None)])
    found = map_with_id(rows.select("doc_id", "text"), lambda batches: batches, "text string")
    assert found.schema["doc_id"].dataType == rows.schema["doc_id"].dataType
    assert {(r.doc_id, r.text) for r in found.collect()} == {(9007199254740993, "x"), (None, "y")}


def test_written_tables_go_to_the_shared_folder(spark):
    found = written(spark.range(5), "test")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert found.count() == 5
    if shared:
        assert all(shared in path for path in found.inputFiles())


def folder_of(table):
    return Path(table.inputFiles()[0].removeprefix("file:")).parent


def test_shuffle_files_go_with_the_write(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    local = Path(list(disk.localDirsString())[0])
    before = set(local.rglob("shuffle_*.data"))
    rows = spark.range(20_000).repartition(7, "id").withColumn("text", F.repeat(F.lit("x"), 50))
    found = written(rows, "test")
    assert not set(local.rglob("shuffle_*.data")) - before
    assert found.count() == 20_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_only_the_result_stays(spark):
    inner, outer = [], []

    @result_only
    def doubled(rows):
        inner.append(folder_of(written(rows, "test")))
        return written(rows.unionByName(rows), "test")

    @result_only
    def counted(rows):
        both = doubled(rows)
        outer.append(folder_of(both))
        gone = written(rows, "test")
        drop_written(gone)
        return written(both.groupBy("id").count(), "test")

    found = counted(spark.range(3))
    assert {tuple(r) for r in found.collect()} == {(0, 2), (1, 2), (2, 2)}
    assert not any(path.exists() for path in inner + outer)
    assert folder_of(doubled(spark.range(3))).exists()
    with pytest.raises(ValueError, match="no written table"):
        result_only(lambda: spark.range(3))()


def test_labelled_sample_is_bounded_and_stable(spark):
    rows = [(n, n % 2) for n in range(200)] * 2 + [(500, 0), (500, 1), (None, 1), (501, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    one = labelled_ids(labels, "quality", 20, folds=5, held_out=0).collect()
    other = labelled_ids(labels.repartition(9), "quality", 20, folds=5, held_out=0).collect()
    assert sorted(one) == sorted(other) and len(one) == 40
    assert not {500, 501, None} & {r.doc_id for r in labelled_ids(labels, "quality", 1000).collect()}
