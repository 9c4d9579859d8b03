"""Hand-made model responses, good and bad."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from attesta import schemas
from attesta.operators import extraction, retrieval
from attesta.params import ExtractionParams, RetrievalParams
from attesta.plans.report import candidate_chunks, evidence_from_responses, report_findings

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ITEM = {
    "evidence_text": " quote ", "evidence_summary": "s", "candidate_sdgs": ["SDG 1"],
    "evidence_tags": ["policy"], "implementation_stage": "planned_action",
    "quantitative_support": True, "oversight_support": False, "confidence": 0.7, "rationale": "r",
}


def wrap(*items):
    return json.dumps({"evidence_items": list(items)})


def test_parse_responses(spark):
    good = wrap(ITEM)
    cases = {
        "clean": (good, 1, None),
        "fenced": (f"```json\n{good}\n```", 1, None),
        "plain_fence": (f"```\n{good}```", 1, None),
        "prose": (f"Sure: {good} Anything else?", 1, None),
        "two_objects": (f"{good} {good}", None, "no JSON in response"),
        "not_json": ("no idea", None, "no JSON in response"),
        "null": (None, None, "no JSON in response"),
        "single_quotes": ("{'evidence_items': []}", None, "no JSON in response"),
        "list": (f"[{good}]", None, "response is not an object"),
        "items_not_list": ('{"evidence_items": {"a": 1}}', None, None),
        "items_missing": ('{"x": 1}', None, None),
        "empty": (wrap(), 0, None),
        "seven": (wrap(*[ITEM] * 7), 5, None),
        "entry_text": (wrap(ITEM, "text"), None, "entry is not an object"),
        "late_text": (wrap(*[ITEM] * 5, "text"), 5, None),
    }
    df = spark.createDataFrame([(c, v[0]) for c, v in cases.items()], "case string, raw_response string")
    got = {r.case: r for r in extraction.parse_responses(df).collect()}
    for case, (_, n, error) in cases.items():
        items = got[case]["items"]
        assert got[case].parse_error == error, case
        assert (None if items is None else len(items)) == n, case


def coerce(spark, items, params=ExtractionParams()):
    df = spark.createDataFrame([(1, wrap(*items))], "k int, raw_response string")
    rows = extraction.coerce_items(
        extraction.response_items(extraction.parse_responses(df, params)), params
    ).collect()
    return {r.item_no: r for r in rows}


def test_coercion(spark):
    bad = {k: v for k, v in ITEM.items() if k != "rationale"}
    got = coerce(spark, [bad, {**ITEM, "evidence_text": "  "}, ITEM, ITEM, ITEM, ITEM])
    assert sorted(got) == [2, 3, 4]  # the cap counts the two bad entries
    assert got[2].evidence_text == "quote" and got[2].confidence == 0.7

    got = coerce(
        spark,
        [
            {**ITEM, "quantitative_support": "false", "oversight_support": ""},
            {**ITEM, "quantitative_support": 0, "oversight_support": [0]},
            {**ITEM, "quantitative_support": None, "oversight_support": {}},
            {**ITEM, "candidate_sdgs": "SDG 1", "evidence_tags": None},
            {**ITEM, "candidate_sdgs": [13, None, "SDG 2"], "evidence_text": None},
        ],
    )
    flags = [(got[i].quantitative_support, got[i].oversight_support) for i in range(3)]
    assert flags == [(True, False), (False, True), (False, False)]
    assert got[3].candidate_sdgs == [] and got[3].evidence_tags == []
    assert got[4].candidate_sdgs == ["13", "None", "SDG 2"] and got[4].evidence_text == "None"


@pytest.mark.parametrize(
    "value, expected",
    [
        (1.7, 1.0), (-2, 0.0), ("x", 0.5), ("0.4", 0.4), (None, 0.5), (True, 1.0), ([1], 0.5),
        (" 0.25 ", 0.25), ("1e-1", 0.1), ("1d", 0.5),
    ],
)
def test_confidence(spark, value, expected):
    assert coerce(spark, [{**ITEM, "confidence": value}])[0].confidence == expected


def test_strict_flags(spark):
    params = ExtractionParams(strict_flags=True)
    got = coerce(spark, [{**ITEM, "quantitative_support": "yes", "oversight_support": True}], params)
    assert (got[0].quantitative_support, got[0].oversight_support) == (False, True)


def flaky(prompt):
    if "boom" in prompt:
        raise RuntimeError("no answer")
    if "second" in prompt and "not valid JSON" not in prompt:
        return "hm"
    if "never" in prompt:
        return "hm"
    return '```json\n{"evidence_items": []}\n```'


def test_call_model_keeps_going(spark):
    prompts = spark.createDataFrame(
        [(1, "first"), (2, "boom"), (3, "second try"), (4, "never")], "k int, prompt string"
    )
    rows = extraction.call_model(prompts, flaky, ["k"], tasks=2).collect()
    got = {r.k: (r.attempts, r.error) for r in rows}
    assert got == {
        1: (1, None), 2: (3, "RuntimeError: no answer"), 3: (2, None), 4: (3, "response is not JSON"),
    }


def test_prompts(spark):
    df = spark.createDataFrame([("Acme", None)], "company string, page int")
    made = extraction.with_prompts(df, "C: {company} p{page} {{x}}").first().prompt
    assert made == "C: Acme p {x}"


def letters(texts):
    return [[float(t.count(c)) for c in "abc"] for t in texts]


def echo(prompt):
    return wrap({**ITEM, "evidence_text": prompt[:20]})


def test_pages_to_findings(spark):
    pages = spark.createDataFrame(
        [
            ("r1", 1, "energy water climate " * 20, "A"),
            ("r1", 2, "cab abc energy " * 20, "B"),
            ("r2", 1, "short", None),
        ],
        schemas.PAGE,
    )
    queries = spark.createDataFrame([("q", [1.0, 1.0, 1.0])], "query_id string, vector array<double>")
    found = candidate_chunks(pages, queries, letters)
    assert {(r.report_id, r.chunk_no, r.chunk_rank) for r in found.collect()} == {
        ("r1", 0, 2), ("r1", 1, 1),
    }
    from pyspark.sql import functions as F

    chunks = found.withColumns(
        {"company": F.lit("acme"), "report_name": F.lit("R"), "report_year": F.lit(2020)}
    )
    keys = ["report_id", "chunk_no"]
    answers = extraction.call_model(extraction.with_prompts(chunks), echo, keys)
    records, errors = evidence_from_responses(chunks, answers)
    rows = records.collect()
    assert len(rows) == 2 and {r.validation_status for r in rows} == {"valid"}
    assert {r.computed_score for r in rows} == {4} and errors.count() == 0
    assert {r.evidence_id for r in rows} == {r.evidence_id for r in records.collect()}
    reports = records.select("company", "report_year").distinct()
    tables = report_findings(records, reports, order=["seq"])
    goal = tables["goals"].first()
    assert goal.summary == (
        "2 evidence item(s) found. Dominant stage: planned action. Average score: 4/10. "
        "Key evidence types: policy."
    )
    assert goal.strongest_pages == [2, 1]
    assert tables["assessment"].first().overall_assessment == "strategic_commitment_present"


def test_rhetoric(spark):
    texts = {
        "We strive to do better": True,
        "We strive to do better by 2030": False,
        "We strive to save 5 m³ of it": False,
        "We STRIVE TO save; the Board agrees": False,
        "we strive to save 12 %": False,
        "Our vision is to grow": True,
        "plain statement": False,
        "going forward, we act": True,
        "we strive to use gwh": False,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from pyspark.sql import functions as F

    got = {r.t: r.x for r in df.select("t", retrieval.is_rhetoric(F.col("t")).alias("x")).collect()}
    assert got == texts


def test_keyword_hits(spark):
    from pyspark.sql import functions as F

    from attesta.constants import GOAL_KEYWORDS

    df = spark.createDataFrame(
        [("Agriculture near a WINDOW with equal opportunity",), ("",), (None,)], "t string"
    )
    rows = df.select(retrieval.keyword_hits(F.col("t"), GOAL_KEYWORDS).alias("h")).collect()
    assert rows[0].h == ["equal opportunity", "wind", "gri"]
    assert rows[1].h == []
    assert sum(len(v) for v in GOAL_KEYWORDS.values()) == 158


def test_many_queries_are_paired_once(spark):
    chunks = spark.createDataFrame(
        [("r", i, "t", [1.0, float(i)]) for i in range(20)],
        "report_id string, chunk_no int, text string, vector array<double>",
    )
    queries = spark.createDataFrame(
        [(f"q{i}", [1.0, 0.0]) for i in range(75)], "query_id string, vector array<double>"
    )
    from pyspark.sql import functions as F

    paired = retrieval.pair_with_queries(chunks, queries, F.col("chunk_no"), group_size=8)
    assert paired.select("chunk_no", "query_id").distinct().count() == paired.count() == 1500


def test_ties_keep_chunk_order_and_floor_uses_raw_score(spark):
    scored = spark.createDataFrame(
        [("r", "q", 2, 0.5), ("r", "q", 1, 0.5), ("r", "q", 0, 0.14999), ("r", "q", 3, 0.15)],
        "report_id string, query_id string, chunk_no int, raw_score double",
    )
    top = retrieval.top_chunks(scored, params=RetrievalParams(top_k=3)).orderBy("chunk_rank").collect()
    assert [(r.chunk_no, r.retrieval_score) for r in top] == [(1, 0.5), (2, 0.5), (3, 0.15)]


def test_each_prompt_is_asked_once(spark, tmp_path):
    import uuid

    calls, path = tmp_path / "calls", str(tmp_path / "answers")
    calls.mkdir()

    def answer(prompt):
        (calls / uuid.uuid4().hex).touch()
        return wrap(ITEM)

    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "k int, prompt string")
    first = extraction.store_responses(prompts.filter("k < 12"), answer, ["k"], path)
    for _ in range(3):
        assert extraction.parse_responses(first).count() == 12
    assert len(list(calls.iterdir())) == 12
    everything = extraction.store_responses(prompts, answer, ["k"], path, rounds=3)
    assert everything.count() == 20 and len(list(calls.iterdir())) == 20


def test_nothing_is_lost_silently(spark):
    cases = {"cut": wrap(*[ITEM] * 7), "late_text": wrap(*[ITEM] * 5, "text"), "no_list": '{"x": 1}',
             "text_list": '{"evidence_items": "a"}', "fine": wrap(ITEM, ITEM),
             "partial": wrap({"evidence_text": "x"}, ITEM), "blank": wrap({**ITEM, "evidence_text": " "})}
    df = spark.createDataFrame(list(cases.items()), "case string, raw_response string")
    for limit in (5, None):
        params = ExtractionParams(items_per_chunk=limit)
        parsed = extraction.parse_responses(df, params)
        kept = extraction.coerce_items(extraction.response_items(parsed), params).count()
        lost = extraction.dropped_entries(parsed, ["case"], params).collect()
        entries = sum(r.n_entries or 0 for r in parsed.collect())
        assert kept + sum(r.item_no is not None for r in lost) == entries
        assert {r["case"] for r in lost if r.item_no is None} == {"no_list", "text_list"}
        assert sum(r.reason == "beyond the entry limit" for r in lost) == (3 if limit else 0)


def test_losses_parse_a_response_once(spark):
    """One scan of the responses, whatever the kinds of loss."""
    df = spark.range(3).selectExpr("id AS k", "concat('{\"evidence_items\": [', id, ']}') AS raw_response")
    lost = extraction.dropped_entries(extraction.parse_responses(df), ["k"])
    plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1


def test_accepted_answers_parse(spark):
    cases = [wrap(ITEM), f"```json\n{wrap(ITEM)}\n```", "[1]", "5", '{"a": NaN}', "text", "NaN", f"x {wrap()} y"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "k int, raw_response string")
    for r in extraction.parse_responses(df).collect():
        assert extraction._is_json_object(cases[r.k]) == (r.parse_error is None), cases[r.k]


def test_prompts_come_in_small_batches(spark):
    """A worker holds a few megabytes of prompts, however long they are."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    prompts = spark.range(0, 150, 1, 1).selectExpr("id", "repeat('x', 200000) AS prompt")

    def answer(prompt):
        return json.dumps({"n": len(sys._getframe(1).f_locals["batch"])})

    got = extraction.call_model(prompts, answer, ["id"]).collect()
    assert len(got) == 150 and max(json.loads(r.raw_response)["n"] for r in got) <= 50


def test_failed_prompts_are_asked_again(spark, tmp_path):
    """One success per key, failed keys asked again, a run that stops goes on, null keys are keys."""
    import uuid

    calls, path = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    once_each = ExtractionParams(max_attempts=1)

    def model(down):
        def answer(prompt):
            (calls / f"{prompt}-{uuid.uuid4().hex}").touch()
            if prompt in down:
                raise ConnectionError("down")
            return wrap(ITEM)

        return answer

    rows = [(i, f"p{i}") for i in range(8)] + [(None, "none")]
    prompts = spark.createDataFrame(rows, "k int, prompt string")
    made = lambda: len(list(calls.iterdir()))
    store = lambda frame, down, **more: extraction.store_responses(frame, model(down), ["k"], path, once_each, **more)
    first = store(prompts.filter("k < 4"), {"p1", "p2"}).collect()  # the rest waits for the next run
    assert {r.k: r.error is None for r in first} == {0: True, 1: False, 2: False, 3: True} and made() == 4
    second = store(prompts, {"p2", "none"}, rounds=2).collect()
    assert made() == 4 + 2 + 5 and {r.k for r in second if r.error} == {2, None}
    third = store(prompts, set(), give_up_after=2).collect()
    assert {r.k for r in third if r.error} == {2} and made() == 12  # 2 had its two attempts
    last = {r.k: r for r in store(prompts, set()).collect()}
    assert made() == 13 and len(last) == 9 and not any(r.error for r in last.values())
    assert last[2].attempts == 3 and last[0].attempts == 1
    good = spark.createDataFrame([(last[2].raw_response,)], "raw_response string")
    assert extraction.parse_responses(good).first().parse_error is None
    store(prompts, {p for _, p in rows})
    assert made() == 13


def test_dropped_entries_are_errors_of_the_plan(spark):
    answers = spark.createDataFrame(
        [("r", 0, wrap(ITEM, {"evidence_text": "x"}), None), ("r", 1, wrap(*[ITEM] * 6), None),
         ("r", 2, '{"x": 1}', None), ("r", 3, "no json", None), ("r", 4, None, "down")],
        "report_id string, chunk_no int, raw_response string, error string",
    )
    chunks = spark.createDataFrame(
        [("r", i, f"c{i}", i + 1, "a", "R", 2020, 1, "h") for i in range(5)],
        "report_id string, chunk_no int, chunk_id string, chunk_rank int, company string, report_name string,"
        " report_year int, page_number int, section_heading string",
    )
    records, errors = evidence_from_responses(chunks, answers)
    assert records.count() == 6
    assert sorted((r.stage, r.message) for r in errors.collect()) == [
        ("dropped_entry", "chunk 0, entry 1: field missing"),
        ("dropped_entry", "chunk 1, entry 5: beyond the entry limit"),
        ("dropped_entry", "chunk 2: entries are not a list"),
        ("extraction", "down"), ("extraction", "no JSON in response"),
    ]


def plain_best(chunks, queries, params):
    """Every chunk with every query, the plain way."""
    import math

    size = lambda v: math.sqrt(sum(x * x for x in v))
    out = set()
    for report in {c[0] for c in chunks}:
        for name, q in queries:
            rows = []
            for r, no, _, v in chunks:
                if r == report and v is not None:
                    cos = sum(a * b for a, b in zip(q, v)) / (size(q) * size(v)) if size(q) and size(v) else 0.0
                    rows.append((-params.vector_weight * cos, no))
            kept = sorted((s, n) for s, n in rows if -s >= params.floor)[: params.top_k]
            out |= {(report, name, n, i + 1) for i, (_, n) in enumerate(kept)}
    return out


@pytest.mark.parametrize("pivots, top_k, floor", [(1, 3, 0.15), (8, 5, 0.15), (32, 2, -1.0), (5, 100, 0.3)])
def test_best_chunks_equal_all_pairs(spark, pivots, top_k, floor):
    """Pruned search against all pairs: clusters, zero, missing and opposite vectors."""
    import random

    rng = random.Random(pivots)
    centers = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    chunks = []
    for i in range(400):
        c = rng.choice(centers)
        v = [x + rng.gauss(0, 0.15) for x in c] if i % 50 else None if i % 100 else [0.0] * 6
        chunks.append((f"r{i % 3 if i % 2 else 0}", i, "zz", v))
    queries = [(f"q{i}", [x + rng.gauss(0, 0.2) for x in c]) for i, c in enumerate(centers)] + [("zero", [0.0] * 6), ("back", [-x for x in centers[0]])]
    params = RetrievalParams(pivots=pivots, top_k=top_k, floor=floor, keyword_weight=0.4)
    frame = spark.createDataFrame(chunks, "report_id string, chunk_no int, text string, vector array<double>")
    asked = spark.createDataFrame(queries, "query_id string, vector array<double>")
    best = retrieval.best_chunks(frame, asked, params)
    got = {(r.report_id, r.query_id, r.chunk_no, r.chunk_rank) for r in best.collect()}
    if floor >= 0:  # below a floor of zero, chunks of equal score stand in chunk order there and here
        assert got == plain_best(chunks, queries, params)
    else:
        assert {g[:3] for g in got if g[1] != "zero"} == {p[:3] for p in plain_best(chunks, queries, params) if p[1] != "zero"}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "q_group" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_blocks_are_ruled_out(spark):
    """On clustered vectors most chunks are never scored."""
    import random

    rng = random.Random(2)
    centers = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(20)]
    rows = [("r", i, "zz", [x + rng.gauss(0, 0.05) for x in centers[i % 20]]) for i in range(2000)]
    frame = spark.createDataFrame(rows, "report_id string, chunk_no int, text string, vector array<double>")
    queries = spark.createDataFrame([(f"q{i}", c) for i, c in enumerate(centers)], "query_id string, vector array<double>")
    params = RetrievalParams(top_k=5, keyword_weight=0.0)
    index, pivots = retrieval.index_chunks(frame, params)
    bounds = retrieval.block_bounds(index, pivots, queries, params, ["report_id"])
    seeds = retrieval._scored_blocks(index, bounds.filter("seed"), queries, params, ["report_id"])
    rest = retrieval.wanted_blocks(bounds, seeds, params, ["report_id"]).agg({"n": "sum"}).first()[0] or 0
    assert seeds.count() + rest < 0.4 * 2000 * 20


def test_lists_without_limit(spark, make_records):
    from attesta.operators import findings
    from attesta.params import FindingsParams

    n = 1500  # list positions beyond a thousand keep their order
    tags = [f"t{i}" for i in range(n)]
    records = make_records({"a": {"evidence_tags": tags, "candidate_sdgs": ["SDG 1"], "computed_score": 5, "page_number": 3}})
    records = records.withColumn("seq", F.lit(2**40).cast("bigint"))
    row = findings.top_tags(records, params=FindingsParams(top_tags=None)).first()
    assert row.top_tags == tags and row.n_tags == n
    row = findings.top_tags(records).first()
    assert row.top_tags == tags[:4] and row.n_tags == n
