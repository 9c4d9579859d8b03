import hashlib

import numpy as np
import public_tokenizers
import pytest
from test_idpack import odd_texts
from tokenizers import Tokenizer

from attesta.llm import bpe


@pytest.mark.parametrize("block_chars", [32_000_000, 300])
def test_documents_equal_the_tokenizer(spark, block_chars):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, t, 1) for i, t in enumerate(odd_texts())] + [(None, "no id", 2), (7, "twice", 3), (7, "twice", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int").repartition(4)
    found = bpe.encode_documents(docs, bpe.BpeParams(block_chars=block_chars), keep_ids=True).collect()
    expected = []
    for doc_id, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((str(doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded))
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(expected)


def test_equal_blocks_in_different_tasks(spark):
    docs = spark.createDataFrame([(1, "same text")] * 3, "doc_id bigint, text string").repartition(3)
    assert bpe.encode_documents(docs).count() == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode_documents(docs).collect() == []
