"""What a Python worker holds at once."""

import public_tokenizers
import pyarrow as pa

from docflow.llm import bpe_codec, common, decontam


def test_texts_reach_workers_in_small_batches(spark):
    texts = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 300) AS text")
    before = spark.conf.get(common._BATCH_CONF, None)
    try:
        spark.conf.unset(common._BATCH_CONF)
        both = bpe_codec.round_trip(texts, public_tokenizers.path("word_bpe_49k.json"))
        assert both.count() == 3000
        sizes = texts.mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.nbytes], "rows": [b.num_rows]}) for b in it), "n long, rows long").collect()
        assert sum(r.rows for r in sizes) == 3000
        assert max(r.n for r in sizes) < 1.5 * common.BATCH_BYTES
        spark.conf.set(common._BATCH_CONF, "1000")
        common.bounded_batches(spark)
        assert spark.conf.get(common._BATCH_CONF) == "1000"
    finally:
        spark.conf.unset(common._BATCH_CONF) if before is None else spark.conf.set(common._BATCH_CONF, before)


def test_words_of_a_task_are_dropped():
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2]), "text": pa.array(["Some words here, and 7 more.", None])})
    rows = sum(b.num_rows for b in decontam._rows([batch], lambda words: decontam.windows(words, [3])))
    assert rows > 0 and not decontam._KNOWN


def test_library_keeps_no_model():
    c = bpe_codec.codec(public_tokenizers.path("word_bpe_49k.json"))
    assert c.library.get_vocab_size() == 0
    assert bpe_codec.offset_table(public_tokenizers.path("word_bpe_49k.json")).decode(c.encode("Ünïcode ☃ text")) != b""
