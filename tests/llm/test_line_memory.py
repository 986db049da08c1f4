"""Line dedup hands its Python workers bounded batches."""

from meterflow.llm import common, line_dedup

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_by_bytes(spark, make_docs):
    spark.conf.unset(SETTING)
    line = "a line that is long enough to be told from the others"
    out = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(make_docs({i: line for i in range(6)})).collect()}
    assert out == {i: int(i < 5) for i in range(6)}
    assert int(spark.conf.get(SETTING)) <= common.BATCH_BYTES
