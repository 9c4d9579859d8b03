"""Chunks against a word-by-word brute force on random small reports."""

import hashlib
import random

import pytest

from attesta import schemas
from attesta.operators import chunking, pages
from attesta.params import ChunkParams


def brute_sections(report_pages):
    sections, last = [], None
    for number, text, heading in report_pages:
        if not sections or (heading and heading != last):
            sections.append({"start": number, "heading": heading or None, "pages": []})
        last = heading or last
        sections[-1]["pages"].append((number, text or ""))
    return sections


def brute_chunks(report_pages, p: ChunkParams, by_section=True):
    if by_section:
        sections = brute_sections(report_pages)
    else:
        sections = [
            {"start": n, "heading": h or f"Page {n}", "pages": [(n, t or "")]}
            for n, t, h in report_pages
        ]
    chunks = []
    for s in sections:
        body = "\n\n".join(t for _, t in s["pages"] if t.strip())
        tokens = body.split()
        if not tokens:
            continue
        if len(tokens) <= p.max_words:
            windows = [body.strip()]
        else:
            windows = [
                " ".join(tokens[i : i + p.max_words]) for i in range(0, len(tokens), p.step)
            ]
        start_no = len(chunks)
        for i, window in enumerate(windows):
            if int(len(window.split()) / p.words_per_token) >= p.min_tokens:
                no = start_no + i
                digest = hashlib.md5(f"{s['start']}:{no}:{window[:80]}".encode()).hexdigest()[:8]
                chunks.append(
                    (no, f"chunk_{s['start']}_{no}_{digest}", s["start"],
                     s["heading"] or "Unknown Section", window)
                )
    return chunks


def random_report(rng, n_pages):
    out = []
    for number in range(1, n_pages + 1):
        n = rng.choice([0, 0, 1, 3, 8, 20, 60])
        gaps = [" ", "  ", "\n", "\t", " ", " \n "]
        text = "".join(f"w{rng.randint(0, 99)}{rng.choice(gaps)}" for _ in range(n))
        heading = rng.choice([None, None, None, "", "A", "B", "C"])
        out.append((number, rng.choice([text, text, " " + text]), heading))
    return out


@pytest.mark.parametrize(
    "params",
    [
        ChunkParams(max_tokens=20, overlap_tokens=6, min_tokens=4, block_pages=3),
        ChunkParams(max_tokens=12, overlap_tokens=12, min_tokens=1, block_pages=2),
        ChunkParams(max_tokens=40, overlap_tokens=0, min_tokens=12, block_pages=1000),
        ChunkParams(max_tokens=8, overlap_tokens=2, min_tokens=50, block_pages=5),
    ],
)
def test_chunks_match_brute_force(spark, params):
    rng = random.Random(11)
    reports = {f"r{i}": random_report(rng, n) for i, n in enumerate([1, 2, 5, 9, 30, 80])}
    reports["hot"] = [(n, "alpha beta gamma delta", None) for n in range(1, 200)]
    rows = [(rid, n, t, h) for rid, ps in reports.items() for n, t, h in ps]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, schemas.PAGE).repartition(5)
    for by_section in (True, False):
        got = {}
        for r in chunking.chunk_pages(df, params, by_section).collect():
            got.setdefault(r.report_id, []).append(
                (r.chunk_no, r.chunk_id, r.page_number, r.section_heading, r.text)
            )
        for rid, ps in reports.items():
            assert sorted(got.get(rid, [])) == brute_chunks(ps, params, by_section), rid


def test_sections_across_blocks(spark):
    rng = random.Random(2)
    report = random_report(rng, 60)
    df = spark.createDataFrame([("r", *p) for p in report], schemas.PAGE)
    expected = {
        n: (s["start"], s["heading"] or "Unknown Section")
        for s in brute_sections(report)
        for n, _ in s["pages"]
    }
    for block in (1, 4, 64):
        got = chunking.locate_sections(chunking.page_words(df), ChunkParams(block_pages=block)).collect()
        assert {r.page_number: (r.section_start, r.section_heading) for r in got} == expected


def test_default_sizes():
    p = ChunkParams()
    assert (p.max_words, p.step, p.min_words) == (450, 390, 38)


def test_empty_input(spark):
    assert chunking.chunk_pages(spark.createDataFrame([], schemas.PAGE)).collect() == []


def test_pages_and_headings(spark):
    spans = [
        (1, 0, 20.0, "Big "), (1, 1, 20.0, "Title"), (1, 2, 10.0, "body"), (1, 3, 20.0, "later"),
        (1, 4, 10.0, "text"), (1, 5, 10.0, "text"), (1, 6, 10.0, "text"),
        (2, 0, 10.0, "plain"), (2, 1, 10.0, "OUR WATER USE"), (2, 2, 10.0, "x"),
        (3, 0, 10.0, "nothing here"), (3, 1, 10.0, "ABC"),
        (4, 0, 30.0, "  "), (4, 1, 12.0, "word " * 16), (4, 2, 10.0, "a"), (4, 3, 10.0, "b"),
        (5, 0, 10.0, "a"), (5, 1, 11.0, "b"),
    ]
    df = spark.createDataFrame([("r", *s) for s in spans], schemas.SPAN)
    got = {r.page_number: r.section_heading for r in pages.detect_headings(df).collect()}
    assert got == {1: "Big Title", 2: "OUR WATER USE"}

    source = spark.createDataFrame(
        [("r", 1, "x" * 40, None), ("r", 2, None, None), ("r", 3, " a\t b ", None)], schemas.PAGE
    )
    clean = pages.clean_pages(source)
    assert {r.page_number: r.text for r in clean.collect()} == {1: "x" * 40, 2: "", 3: "a b"}
    assert sorted((r.page_number, r.n_chars) for r in pages.sparse_pages(clean).collect()) == [
        (2, 0), (3, 3),
    ]
    assert pages.with_headings(source, pages.detect_headings(df)).count() == 3


def test_headings_sort_only_the_first_spans(spark, monkeypatch):
    """Long pages are cut near their top before anything is sorted; the first spans of
    every page stay, whatever their numbers are."""
    numbers = {
        1: range(5000), 2: range(-700, 3000, 16), 3: [7] * 4, 4: range(9),
        5: [5, 100, *range(2000, 4000)], 6: [None, *range(1000)], 7: range(0, 90_000, 30),
    }
    rows = [("r", p, i, 10.0, "TOP WORD") for p, found in numbers.items() for i in found]
    rows += [("r", 8, i, 10.0, " " if i < 400 else "late") for i in range(2000)]
    spans = spark.createDataFrame(rows, "report_id string, page_number int, span_no int, size double, text string")
    given, first_n = [], pages.first_n
    monkeypatch.setattr(pages, "first_n", lambda df, *rest: given.append(df) or first_n(df, *rest))
    assert pages.detect_headings(spans).count() == 7
    near_top = [(r.page_number, r.span_no) for r in given[0].collect()]
    assert len(near_top) < 1000
    filled = [(p, i) for _, p, i, _, text in rows if text.strip()]
    for page in {p for p, _ in filled}:
        def top(found):
            return sorted((i for p, i in found if p == page), key=lambda i: (i is not None, i or 0))[:10]
        assert top(near_top) == top(filled)
