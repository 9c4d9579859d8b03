import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from attesta.llm import idpack, words


@pytest.mark.parametrize("width", [1, 7, 11, 16, 17, 32])
def test_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001).astype(np.uint32)
    packed = idpack.pack(ids, width)
    assert len(packed) == (1001 * width + 7) // 8
    for a, b in [(0, 1001), (5, 6), (500, 777), (1000, 1001), (3, 3)]:
        assert (idpack.unpack(packed, width, a, b) == ids[a:b]).all()


def odd_texts():
    rng = random.Random(9)
    parts = ["The", "cat's", "don't", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", " ", ",", ".", "...",
             "!?", "É", "é", "́", "Σας", "İ", "1", "23", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>",
             "日本", "😀", "'s", "'", "ab", "x.", "y,", "-", "\r\n", "½", "²", "_"]
    out = [None, "", " ", "\n", "a", ".", ",", " ,", "word", "x" * 5000, "ab, cd. ef,\ngh" * 300]
    return out + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(700)]


def test_pieces_encode_like_whole_texts():
    for name, split in [("word_bpe_49k.json", words.unspaced), ("byte_bpe_50k.json", words.spaced)]:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        for text in odd_texts():
            pieces = []
            for w in split(text or ""):
                base = words.without_tail(w)
                pieces += [base, w[len(base):]]
            found = [i for p in pieces for i in tokenizer.encode(p, add_special_tokens=False).ids]
            assert found == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert "".join(words.spaced("a b\nc  d ")) == "a b\nc  d "


@pytest.mark.parametrize("block_ids", [1 << 16, 50])
def test_files_equal_the_tokenizer(spark, block_ids):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(1000 - i, t, 1) for i, t in enumerate(odd_texts())] + [(None, "no id", 2), (7, "twice", 3), (7, "twice", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start int").repartition(5)
    blocks = idpack.pack_documents(docs, idpack.PackParams(block_ids=block_ids))
    assert blocks.select("width").distinct().collect()[0][0] == 16
    expected, start = [], 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((str(doc_id), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [(str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in idpack.read_documents(blocks).collect()]
    assert sorted(got) == sorted(expected)
    picked = idpack.read_ids(blocks, spark.createDataFrame([(900,), (7,)], "doc_id bigint")).collect()
    texts = {r[0]: r[1] for r in rows}
    assert sorted(r.doc_id for r in picked) == [7, 7, 900]
    for r in picked:
        assert r.ids == tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert idpack.read_documents(idpack.pack_documents(docs)).collect() == []
