"""What Python workers keep from one operator to the next."""

import pyarrow as pa

import corpus_pipeline
from quirespark.llm import common, minhash, pieces, quality_model


def test_pieces_take_the_memory_of_earlier_operators():
    minhash.shingle_set("one two three four", 3)
    quality_model.features("one two three four", {})
    assert minhash._HASHES and quality_model._SLOTS
    pieces._table(pieces.model_path())
    assert not minhash._HASHES and not quality_model._SLOTS


def test_texts_are_sent_to_workers_once(spark):
    df = spark.createDataFrame([(1, "s", "some text"), (2, None, None)], "doc_id long, source string, text string")
    out = corpus_pipeline.sentencepiece_ids(spark, df, "")
    assert out.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    plan = out._jdf.queryExecution().analyzed().toString()
    sent = plan[plan.index("MapInArrow") :].splitlines()[1]
    assert sent.count("AS __in_") == 1 and "text" not in sent.split("AS __in_")[0] and sent.count("decoded") == 1


def test_batches_for_workers_are_bounded_in_bytes(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    docs = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('x', 4000) AS text")

    def make():
        # slices of a batch keep the whole batch's bytes
        return lambda texts: [pa.array([texts.buffers()[2].size] * len(texts), pa.int64())]

    try:
        out = common.add_columns(docs, ["text"], [("batch_bytes", "long")], make)
        rows = out.selectExpr("count(*)", "sum(length(text))", "max(batch_bytes)").first()
        assert rows[:2] == (4000, 16_000_000) and rows[2] <= 2 * common.SLICE_BYTES
        spark.conf.set(limit, "1m")
        common.add_columns(docs, ["text"], [("batch_bytes", "long")], make)
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit)
