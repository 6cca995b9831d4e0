"""The pipeline's encoding decodes what it has encoded."""

import json

import pytest

from tallybridge.llm import bpe
from tallybridge.llm.registry import tokenizer

KIND = "doc_id long, text string"


def test_encoding_without_the_decoded_column_is_decoded_all_the_same(spark, tmp_path):
    path = tokenizer("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "e Öl\n  x"), (2, None), (3, ""), (4, "� 😀 <|endoftext|>")], KIND)
    assert len(bpe.encode_documents(docs, path, decoded=False).collect()) == 4
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    # An id that encodes one text and decodes to another.
    file["added_tokens"] = [{"content": "<other>", "id": file["model"]["vocab"]["e"]}]
    wrong = tmp_path / "wrong.json"
    wrong.write_text(json.dumps(file), encoding="utf-8")
    with pytest.raises(Exception, match="do not decode"):
        bpe.encode_documents(docs, str(wrong), decoded=False).collect()
