import pyarrow as pa

import corpus_pipeline
from outlay.llm.common import BATCH_BYTES
from outlay.llm.labelled import smallest_hashes


def test_rows_reach_python_in_small_batches(spark, make, tmp_path):
    """The pipeline's Python stages see a few MB of rows at once, not a whole partition."""
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    docs = make([(i, "a line of text\n" * 4000) for i in range(400)]).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})

    for stage in (corpus_pipeline.quality, corpus_pipeline.minhash, corpus_pipeline.byte_bpe):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, folder)
        found = docs.mapInArrow(sizes, "rows long, size long").collect()
        assert sum(row["rows"] for row in found) == 400
        assert max(row["size"] for row in found) < 2 * BATCH_BYTES
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_the_sample_starts_no_python_workers(spark):
    ids = spark.range(1000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS label")
    plan = smallest_hashes(ids, "label", 10)._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" in plan
