"""Fixed validation rules on evidence records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.text import bracketed_list, is_blank


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _empty() -> Column:
    return F.array().cast("array<string>")


def rule_flags() -> dict[str, Column]:
    """One condition per rule, true when the rule is broken, in rule order."""
    goals = F.coalesce("candidate_sdgs", _empty())
    tags = F.coalesce("evidence_tags", _empty())
    stage = F.coalesce("implementation_stage", F.lit(""))
    quantified = F.coalesce("quantitative_support", F.lit(False))
    overseen = F.coalesce("oversight_support", F.lit(False))
    return {
        "page": F.coalesce("page_number", F.lit(0)) < 1,
        "text": is_blank("evidence_text"),
        "no_goals": F.size(goals) == 0,
        "bad_goals": F.size(F.array_except(goals, _strings(k.GOALS))) > 0,
        "stage": ~stage.isin(k.STAGES),
        "tags_type": F.col("evidence_tags").isNull(),
        "bad_tags": F.size(F.array_except(tags, _strings(k.TAGS))) > 0,
        "outcome": F.array_contains(tags, "measured_outcome") & ~quantified,
        "governance": F.array_contains(tags, "governance") & ~overseen,
        "measurable": (stage == k.MEASURABLE) & ~quantified,
    }


def _messages() -> dict[str, Column]:
    goals, tags = F.col("candidate_sdgs"), F.col("evidence_tags")
    bad_goals = F.filter(goals, lambda x: ~x.isin(k.GOALS))
    bad_tags = F.filter(tags, lambda x: ~x.isin(k.TAGS))
    before, after = k.MSG_STAGE.format(value="\0", allowed=str(sorted(k.STAGES))).split("\0")
    return {
        "page": F.lit(k.MSG_PAGE),
        "text": F.lit(k.MSG_TEXT),
        "no_goals": F.lit(k.MSG_NO_GOALS),
        "bad_goals": F.concat(F.lit(k.MSG_BAD_GOALS), bracketed_list(bad_goals)),
        "stage": F.concat(
            F.lit(before), F.coalesce("implementation_stage", F.lit("")), F.lit(after)
        ),
        "tags_type": F.lit(k.MSG_TAGS_TYPE),
        "bad_tags": F.concat(F.lit(k.MSG_BAD_TAGS), bracketed_list(bad_tags)),
        "outcome": F.lit(k.MSG_OUTCOME),
        "governance": F.lit(k.MSG_GOVERNANCE),
        "measurable": F.lit(k.MSG_MEASURABLE),
    }


def is_valid() -> Column:
    """All rules hold. Free of lambdas, so scans and filters stay compiled."""
    broken = F.lit(False)
    for flag in rule_flags().values():
        broken = broken | flag
    return ~broken


def error_list() -> Column:
    """Messages of the broken rules, in rule order."""
    messages = _messages()
    return F.array_compact(
        F.array(*[F.when(flag, messages[name]) for name, flag in rule_flags().items()])
    )


def validate(records: DataFrame) -> DataFrame:
    """Add validation_status and validation_errors.

    The status does not read the message column, so queries that need only the
    status never build messages.
    """
    return records.withColumns(
        {
            "validation_status": F.when(is_valid(), F.lit("valid")).otherwise(F.lit("rejected")),
            "validation_errors": error_list(),
        }
    )


def valid_only(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("validation_status") == "valid")


def rejected_only(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("validation_status") == "rejected")


def rule_violations(records: DataFrame) -> DataFrame:
    """How many records break each rule, one row per rule, in a single pass."""
    flags = rule_flags()
    wide = records.agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])
    return wide.unpivot([], list(flags), "rule", "n_records")


def status_counts(validated: DataFrame, keys: list[str]) -> DataFrame:
    valid = F.col("validation_status") == "valid"
    return validated.groupBy(*keys).agg(
        F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_rejected")
    )
