"""Explicit schemas of every table that is read from files."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


STR, INT, DBL, BOOL = StringType(), IntegerType(), DoubleType(), BooleanType()
STRS, INTS = ArrayType(STR), ArrayType(INT)

PAGE = _struct(report_id=STR, page_number=INT, text=STR, section_heading=STR)

SPAN = _struct(report_id=STR, page_number=INT, span_no=INT, size=DBL, text=STR)

EVIDENCE = _struct(
    evidence_id=STR,
    company=STR,
    report_name=STR,
    report_year=INT,
    page_number=INT,
    section_heading=STR,
    evidence_text=STR,
    evidence_summary=STR,
    candidate_sdgs=STRS,
    evidence_tags=STRS,
    implementation_stage=STR,
    quantitative_support=BOOL,
    oversight_support=BOOL,
    confidence=DBL,
    rationale=STR,
    validation_status=STR,
    validation_errors=STRS,
    computed_strength=STR,
    computed_score=INT,
)

GOAL_SUMMARY = _struct(
    sdg=STR,
    evidence_count=INT,
    average_score=DBL,
    strongest_pages=INTS,
    implementation_profile=STR,
    summary=STR,
)

RUN_METADATA = _struct(generated_at=STR, valid_count=INT, rejected_count=INT, sdg_count=INT)

RUN_DOCUMENT = _struct(
    company=STR,
    report_name=STR,
    report_year=INT,
    overall_assessment=STR,
    sdg_summaries=ArrayType(GOAL_SUMMARY),
    validated_evidence=ArrayType(EVIDENCE),
    rejected_evidence=ArrayType(EVIDENCE),
    pipeline_errors=STRS,
    metadata=RUN_METADATA,
)

LABELLED_ITEM = _struct(
    company=STR,
    report_name=STR,
    report_year=INT,
    page_number=INT,
    section_heading=STR,
    chunk_text=STR,
    expected_sdgs=STRS,
    expected_evidence_tags=STRS,
    expected_implementation_stage=STR,
    expected_quantitative_support=BOOL,
    expected_oversight_support=BOOL,
    expected_valid=BOOL,
    notes=STR,
)

PERFORMANCE_SUMMARY = _struct(model=STR, metric=STR, value=DBL)
LONGITUDINAL_SUMMARY = _struct(
    company=STR, year=INT, implementation_share=DBL, rhetoric_share=DBL
)
AGREEMENT_SUMMARY = _struct(
    company=STR, sdg_agreement=DBL, stage_agreement=DBL, overclaim_difference=DBL
)
