"""The near-duplicate join leaves its result only: no tables or shuffle files of the way there."""

import time
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import ngram_join
from demandloom.session import CLEANUP, shared_dir, shuffles_released


def _files(spark, name: str) -> int:
    jvm = spark.sparkContext._jvm
    roots = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(1 for root in roots for _ in Path(root).rglob(name))


def test_only_the_result_stays(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame(
        [(g * 10 + k, " ".join([f"g{g}", *words[g:g + 40], *(["more"] * (k % 3))])) for g in range(8) for k in range(6)], "doc_id long, text string")
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before, setting = set(folder.iterdir()), spark.conf.get(CLEANUP)
    found: DataFrame = ngram_join.near_duplicates(docs)
    made = set(folder.iterdir()) - before
    assert [p.name.split("-")[0] for p in made] == ["near"]
    assert spark.conf.get(CLEANUP) == setting
    assert found.count() == 48 and found.where("component_id < doc_id").count() > 0


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    rows = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count()
    before = _files(spark, "shuffle_*.data")
    with shuffles_released(spark):
        rows.write.parquet(str(tmp_path / "out"))
    until = time.time() + 20
    while _files(spark, "shuffle_*.data") > before and time.time() < until:
        time.sleep(0.2)
    assert _files(spark, "shuffle_*.data") <= before
