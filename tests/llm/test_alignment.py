"""Token alignment against a plain two-pointer walk and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from attesta.llm import catalog
from attesta.llm.alignment import AlignParams, align_documents, gallop

SCHEMA = "doc_id bigint, text string"
BIG = 2**53 + 1


def byte_of_character():
    """The usual byte-level table, built the plain way."""
    visible = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 173 and not 127 <= b <= 160]
    out, extra = {}, 0
    for b in range(256):
        if b in visible:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    table = byte_of_character()

    def tokens(text):
        if not text:
            return []
        want = (" " + text).encode()
        a_ids = a.encode(" " + text, add_special_tokens=False).ids
        b_ids = b.encode(text)
        a_bytes = [bytes(table[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in b_ids
        ]
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return []
        spans = []
        for ids, parts in ((a_ids, a_bytes), (b_ids, b_bytes)):
            at, out = 0, []
            for i, part in zip(ids, parts):
                out.append((i, at, at + len(part)))
                at += len(part)
            spans.append(out)
        return spans

    def run(rows):
        docs, counts = [], Counter()
        for doc_id, text in rows:
            spans = tokens(text)
            links, groups = [], []
            if spans:
                a_spans, b_spans = spans
                links = [(x[0], y[0]) for x in a_spans for y in b_spans if x[1] < y[2] and y[1] < x[2]]
                cuts = sorted({x[2] for x in a_spans} & {y[2] for y in b_spans})
                low = 0
                for cut in cuts:
                    groups.append("|".join(
                        ",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in spans
                    ))
                    low = cut
            docs.append((doc_id, spans, groups, links))
            counts.update(set(links))
        highest = Counter()
        for (x, _), n in counts.items():
            highest[x] = max(highest[x], n)
        out = []
        for doc_id, spans, groups, links in docs:
            out.append((
                doc_id, len(spans[0]) if spans else 0, len(spans[1]) if spans else 0, len(groups), len(links),
                sum(counts[x] == highest[x[0]] for x in links), sum(counts[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if spans else "",
            ))
        return sorted(out, key=repr)

    return run


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_gallop():
    rng = random.Random(1)
    for _ in range(200):
        ends = np.array(sorted(rng.sample(range(1, 400), rng.randrange(1, 60))))
        wanted = np.array([rng.randrange(1, ends[-1] + 1) for _ in range(20)])
        right = np.searchsorted(ends, wanted)
        start = np.array([rng.randrange(r + 1) for r in right])
        assert (gallop(ends, wanted, start) == right).all()


TEXTS = [
    None, "", " ", "a", "Hello World, this is.", "  two  spaces \n\n and lines\t", "naïve café ▁ mark", "日本語のテキスト",
    "<|endoftext|> plain <s> </s> <0x41>", " odd　space​", "🙂🙃 emoji 👩‍👩‍👧", "x" * 3000, "word " * 2000, "\x00\x01",
    "ﬁ ligature ½ Å", "1234567890 3.14", "é combining", "﻿bom", "end ",
]


@pytest.mark.parametrize("anchors, chars", [((), 16_000_000), ((6, 3), 100), ((1024, 64, 8), 16_000_000)])
def test_equals_plain(spark, plain, anchors, chars):
    rng = random.Random(chars)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(rng.choice(["the", "of", "Energie", "naïveté", "x9", "über"]) for _ in range(rng.randrange(40))))
             for i in range(40)]
    rows += [(BIG, "above the doubles"), (None, "no id"), (BIG, "above the doubles")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(align_documents(docs, AlignParams(anchors=anchors, cached_chars=chars))) == plain(rows)


def test_empty_and_clashing_columns(spark, plain):
    wide = "doc_id int, text string, block int, n_a int, pair string"
    assert align_documents(spark.createDataFrame([], wide)).count() == 0
    docs = spark.createDataFrame([(1, "clashing names", 5, 6, "p"), (2, None, None, None, None)], wide)
    assert rows_of(align_documents(docs)) == plain([(1, "clashing names"), (2, None)])


def test_groups_are_returned(spark):
    docs = spark.createDataFrame([(1, "aligned tokenizers"), (2, None)], SCHEMA)
    rows = {r.doc_id: r for r in align_documents(docs, keep_groups=True).collect()}
    assert rows[2].groups == "" and rows[2].groups_sha256 == ""
    assert hashlib.sha256(rows[1].groups.encode()).hexdigest() == rows[1].groups_sha256
    assert rows[1].groups.count("|") == rows[1].n_groups


def test_given_tables(spark, plain):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    short = [r for r in rows if len(r[1] or "") < 4000]  # the plain walk is quadratic
    docs = spark.createDataFrame(short, SCHEMA)
    assert rows_of(align_documents(docs)) == plain(short)
    found = catalog.QUERIES["op12_token_alignment"](spark, folder)
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(r[0] for r in rows)
