"""Decoding as a step of its own."""

import sentencepiece

from sparklake.llm import sentencepiece_bpe
from sparklake.llm.pieces import default_model


def test_decode_equals_the_decoding_of_the_same_pass_and_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    texts = ["one two  three", None, "", "é\n\n日本 x", "🙂" * 300]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    encoded = sentencepiece_bpe.encode(docs, decoded=True)
    assert encoded.columns == ["doc_id", "text", "ids", "decoded"]
    again = sentencepiece_bpe.decode(encoded).collect()
    for r, first in zip(sorted(again), sorted(encoded.collect())):
        assert r.decoded == first.decoded == library.decode(r.ids) == (texts[r.doc_id] or "")
    lost = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [r.decoded for r in sentencepiece_bpe.decode(lost).collect()] == ["", ""]
