"""Every validation and scoring rule, restated as rows of one frame."""

from conftest import by_case
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.operators import scoring, validation
from attesta.plans.report import score_all


def test_validation_rules(make_records):
    cases = {
        "fine": {},
        "page_null": {"page_number": None},
        "page_zero": {"page_number": 0},
        "page_negative": {"page_number": -1},
        "text_empty": {"evidence_text": ""},
        "text_blank": {"evidence_text": " \t\n "},
        "text_null": {"evidence_text": None},
        "goals_empty": {"candidate_sdgs": []},
        "goals_null": {"candidate_sdgs": None},
        "goals_bad": {"candidate_sdgs": ["SDG 1", "SDG13", "SDG 18", "SDG13"]},
        "goals_quoted": {"candidate_sdgs": ["it's"]},
        "goals_all": {"candidate_sdgs": k.GOALS},
        "stage_bad": {"implementation_stage": "active"},
        "stage_null": {"implementation_stage": None},
        "tags_null": {"evidence_tags": None},
        "tags_bad": {"evidence_tags": ["policy", "action_item"]},
        "tags_all": {
            "evidence_tags": k.TAGS, "quantitative_support": True, "oversight_support": True,
        },
        "outcome_unproven": {"evidence_tags": ["measured_outcome"]},
        "outcome_proven": {"evidence_tags": ["measured_outcome"], "quantitative_support": True},
        "governance_unproven": {"evidence_tags": ["governance"]},
        "governance_proven": {"evidence_tags": ["governance"], "oversight_support": True},
        "measurable_unproven": {"implementation_stage": k.MEASURABLE},
        "measurable_proven": {"implementation_stage": k.MEASURABLE, "quantitative_support": True},
        "flag_null": {"evidence_tags": ["governance"], "oversight_support": None},
        "many": {
            "page_number": None, "evidence_text": "", "candidate_sdgs": [],
            "implementation_stage": "x", "evidence_tags": ["y"],
        },
    }
    checked = validation.validate(make_records(cases))
    found = by_case(checked, "validation_errors")
    allowed = (
        "['implementation_in_progress', 'implemented_with_measurable_evidence', "
        "'mention_only', 'planned_action']"
    )
    assert found["fine"] == found["goals_all"] == found["tags_all"] == []
    for case in ("page_null", "page_zero", "page_negative"):
        assert found[case] == ["page_number is missing or invalid"]
    for case in ("text_empty", "text_blank", "text_null"):
        assert found[case] == ["evidence_text is empty"]
    assert found["goals_empty"] == found["goals_null"] == ["candidate_sdgs is empty"]
    assert found["goals_bad"] == ["invalid SDG identifiers: ['SDG13', 'SDG 18', 'SDG13']"]
    assert found["goals_quoted"] == ['invalid SDG identifiers: ["it\'s"]']
    assert found["stage_bad"] == [f"implementation_stage 'active' is not one of {allowed}"]
    assert found["stage_null"] == [f"implementation_stage '' is not one of {allowed}"]
    assert found["tags_null"] == ["evidence_tags is not a list"]
    assert found["tags_bad"] == ["invalid evidence_tags: ['action_item']"]
    assert found["outcome_unproven"] == [k.MSG_OUTCOME]
    assert found["governance_unproven"] == found["flag_null"] == [k.MSG_GOVERNANCE]
    assert found["measurable_unproven"] == [k.MSG_MEASURABLE]
    for case in ("outcome_proven", "governance_proven", "measurable_proven"):
        assert found[case] == []
    assert [m.split(" ")[0] for m in found["many"]] == [
        "page_number", "evidence_text", "candidate_sdgs", "implementation_stage", "invalid",
    ]
    status = by_case(checked, "validation_status")
    assert all((status[c] == "valid") == (found[c] == []) for c in cases)


def test_scores(make_records):
    full = {"quantitative_support": True, "oversight_support": True}
    cases = {
        "mention_only": {},
        "planned_action": {"implementation_stage": k.PLANNED},
        "implementation_in_progress": {"implementation_stage": k.IN_PROGRESS},
        "implemented_with_measurable_evidence": {"implementation_stage": k.MEASURABLE},
        **{f"tag_{t}": {"evidence_tags": [t]} for t in k.TAGS},
        "unknown_stage": {"implementation_stage": "zzz"},
        "twice": {"evidence_tags": ["policy", "policy", "measured_outcome", "measured_outcome"]},
        "quant": {"quantitative_support": True},
        "oversight": {"oversight_support": True},
        "everything": {"implementation_stage": k.MEASURABLE, "evidence_tags": k.TAGS, **full},
        "over_cap": {
            "implementation_stage": k.MEASURABLE, "evidence_tags": k.TAGS + ["kpi"] * 9, **full,
        },
        "null_tags": {"evidence_tags": None},
        "six": {"implementation_stage": k.MEASURABLE, "evidence_tags": ["kpi", "policy"]},
    }
    got = by_case(scoring.score(make_records(cases)), "computed_score", "computed_strength")
    assert [got[s][0] for s in k.STAGES] == [1, 2, 3, 4]
    assert {t: got[f"tag_{t}"][0] - 1 for t in k.TAGS} == {
        "aspiration": 0, "policy": 1, "initiative": 1, "target": 1, "kpi": 1, "governance": 0,
        "measured_outcome": 2,
    }
    assert got["unknown_stage"] == (1, "weak")
    assert got["twice"] == (7, "strong")
    assert got["quant"][0] == got["oversight"][0] == 2
    assert got["everything"] == got["over_cap"] == (12, "strong")
    assert got["null_tags"] == (1, "weak")
    assert got["planned_action"][1] == "weak" and got["implementation_in_progress"][1] == "moderate"
    assert got["six"] == (6, "strong")


def test_only_valid_records_are_scored(make_records):
    both = score_all(validation.validate(make_records({"a": {}, "b": {"page_number": 0}})))
    assert by_case(both, "computed_score", "computed_strength") == {
        "a": (1, "weak"), "b": (None, None),
    }


def test_rule_counts_on_empty_input(make_records):
    counts = validation.rule_violations(make_records({"a": {}}).filter(F.lit(False))).collect()
    assert len(counts) == 10 and {r["n_records"] for r in counts} == {0}
