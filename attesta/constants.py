"""Fixed values shared by the operators.

Everything below is data, not behaviour: identifiers, labels, weights, word
lists and patterns that other tools producing or reading these records rely on.
"""

# ---------------------------------------------------------------------------
# domains
# ---------------------------------------------------------------------------

GOALS = [f"SDG {n}" for n in range(1, 18)]

STAGES = [
    "mention_only",
    "planned_action",
    "implementation_in_progress",
    "implemented_with_measurable_evidence",
]
MENTION, PLANNED, IN_PROGRESS, MEASURABLE = STAGES

TAGS = [
    "aspiration",
    "policy",
    "initiative",
    "target",
    "kpi",
    "governance",
    "measured_outcome",
]

STRENGTHS = ["weak", "moderate", "strong"]

# ---------------------------------------------------------------------------
# scoring
# ---------------------------------------------------------------------------

STAGE_POINTS = {
    "mention_only": 1,
    "planned_action": 2,
    "implementation_in_progress": 3,
    "implemented_with_measurable_evidence": 4,
}
TAG_POINTS = {"policy": 1, "initiative": 1, "target": 1, "kpi": 1, "measured_outcome": 2}
SCORE_CAP = 12
WEAK_LIMIT = 2
MODERATE_LIMIT = 5

# ---------------------------------------------------------------------------
# labels
# ---------------------------------------------------------------------------

ASSESSMENT_LABELS = {
    "measurable_implementation_evidence": "Strong — Measurable Implementation Evidence Present",
    "implementation_in_progress": "Moderate — Active Implementation Underway",
    "strategic_commitment_present": "Moderate — Strategic Commitment Present",
    "symbolic_alignment_only": "Weak — Symbolic Alignment Only",
    "no_evidence_found": "None — No SDG Evidence Extracted",
}
STAGE_NODE_LABELS = {
    "mention_only": "Mention only",
    "planned_action": "Planned action",
    "implementation_in_progress": "In progress",
    "implemented_with_measurable_evidence": "Measurable evidence",
}
STAGE_SHORT_LABELS = {
    "mention_only": "Mention",
    "planned_action": "Planned",
    "implementation_in_progress": "In progress",
    "implemented_with_measurable_evidence": "Measurable",
}
STAGE_TABLE_LABELS = {
    "mention_only": "Mention only",
    "planned_action": "Planned",
    "implementation_in_progress": "In progress",
    "implemented_with_measurable_evidence": "Measurable",
}
PROFILE_LABELS = {
    "planned_action": "planned",
    "implementation_in_progress": "in_progress",
    "implemented_with_measurable_evidence": "measurable_evidence",
}

# ---------------------------------------------------------------------------
# Validation messages
# ---------------------------------------------------------------------------

MSG_PAGE = "page_number is missing or invalid"
MSG_TEXT = "evidence_text is empty"
MSG_NO_GOALS = "candidate_sdgs is empty"
MSG_BAD_GOALS = "invalid SDG identifiers: "
MSG_STAGE = "implementation_stage '{value}' is not one of {allowed}"
MSG_TAGS_TYPE = "evidence_tags is not a list"
MSG_BAD_TAGS = "invalid evidence_tags: "
MSG_OUTCOME = (
    "'measured_outcome' tag requires quantitative_support == True "
    "(no numeric or metric evidence found by model)"
)
MSG_GOVERNANCE = (
    "'governance' tag requires oversight_support == True "
    "(no board/committee/executive oversight found by model)"
)
MSG_MEASURABLE = (
    "'implemented_with_measurable_evidence' stage requires quantitative_support == True"
)

# ---------------------------------------------------------------------------
# Flat file layout
# ---------------------------------------------------------------------------

CSV_COLUMNS = [
    "evidence_id",
    "company",
    "report_name",
    "report_year",
    "page_number",
    "section_heading",
    "candidate_sdgs",
    "evidence_tags",
    "implementation_stage",
    "quantitative_support",
    "oversight_support",
    "confidence",
    "computed_score",
    "computed_strength",
    "validation_status",
    "evidence_summary",
    "evidence_text",
    "rationale",
    "validation_errors",
]

RESPONSE_FIELDS = [
    "evidence_text",
    "evidence_summary",
    "candidate_sdgs",
    "evidence_tags",
    "implementation_stage",
    "quantitative_support",
    "oversight_support",
    "confidence",
    "rationale",
]

# ---------------------------------------------------------------------------
# Over-claim patterns (the numeric one is case-sensitive)
# ---------------------------------------------------------------------------

NUMERIC_PATTERN = r"\b\d[\d,.]*\s*(%|tonne|mt|gwh|mwh|kwh|m[³3]|kg|litres?|l\b)"
OVERSIGHT_PATTERN = (
    r"(?i)\b(board|committee|executive|ceo|cfo|director|oversight|audit|governance)\b"
)

# ---------------------------------------------------------------------------
# Rhetoric and action patterns
# ---------------------------------------------------------------------------

RHETORIC_PATTERNS = [
    r"\bwe are committed to sustainability\b",
    r"\bour commitment to sustainable development\b",
    r"\bsustainability is (at the )?core\b",
    r"\bwe believe in a sustainable future\b",
    r"\bwe strive to\b",
    r"\bwe aspire to\b",
    r"\bwe recognise the importance of\b",
    r"\bwe acknowledge (our|the)\b",
    r"\bgoing forward[,.]?\s*we\b",
    r"\bwe remain committed\b",
    r"\bour vision is to\b",
]

# The volume unit is written with explicit guards because Java does not count
# a superscript three as a word character.
ACTION_PATTERNS = [
    r"\b\d+[\.,]?\d*\s*%",
    r"\b\d{4}\b",
    r"\btonne[s]?\b",
    r"\bmt\b",
    r"\bgwh\b",
    r"\bmwh\b",
    r"\bkwh\b",
    r"(?<!\w)m[3³](?![\w³])",
    r"\btarget[s]?\b",
    r"\bkpi\b",
    r"\breduced by\b",
    r"\bincreased by\b",
    r"\bby \d{4}\b",
    r"\bcommittee\b",
    r"\bboard\b",
    r"\bexecutive\b",
    r"\baudited\b",
    r"\bverified\b",
    r"\binitiative[s]?\b",
    r"\bpolic(y|ies)\b",
]

# ---------------------------------------------------------------------------
# Goal keyword lexicon
# ---------------------------------------------------------------------------

GOAL_KEYWORDS = {
    "SDG 1": [
        "poverty", "extreme poverty", "social protection", "economic inclusion",
        "livelihoods", "income", "financial access", "microfinance",
    ],
    "SDG 2": [
        "hunger", "food security", "nutrition", "sustainable agriculture",
        "farmers", "smallholder", "food systems", "crop yield", "food waste",
        "agroforestry",
    ],
    "SDG 3": [
        "health", "safety", "wellbeing", "occupational health", "injury rate",
        "fatality", "mental health", "healthcare access", "disease prevention",
        "tafr", "ltifr",
    ],
    "SDG 4": [
        "education", "training", "skills development", "literacy",
        "vocational", "learning", "school", "scholarship", "apprenticeship",
    ],
    "SDG 5": [
        "gender equality", "women", "female representation", "gender pay gap",
        "diversity", "inclusion", "women empowerment", "equal opportunity",
        "gender-based violence",
    ],
    "SDG 6": [
        "water", "clean water", "water stewardship", "water withdrawal",
        "water recycling", "wastewater", "sanitation", "water intensity",
        "water risk",
    ],
    "SDG 7": [
        "energy", "renewable energy", "solar", "wind", "clean energy",
        "energy efficiency", "energy intensity", "electricity", "fossil fuel",
        "energy transition",
    ],
    "SDG 8": [
        "decent work", "fair wage", "living wage", "labour rights",
        "employment", "economic growth", "modern slavery", "forced labour",
        "child labour", "worker rights",
    ],
    "SDG 9": [
        "innovation", "infrastructure", "industry", "research and development",
        "r&d", "digitisation", "technology", "manufacturing",
    ],
    "SDG 10": [
        "inequality", "equal opportunity", "pay equity", "social inclusion",
        "marginalized", "indigenous", "disability",
    ],
    "SDG 11": [
        "communities", "sustainable cities", "urban", "affordable housing",
        "community investment", "local procurement",
    ],
    "SDG 12": [
        "responsible consumption", "responsible production", "circular economy",
        "waste reduction", "recycling", "packaging", "sustainable sourcing",
        "supply chain", "product stewardship",
    ],
    "SDG 13": [
        "climate", "climate change", "emissions", "ghg", "greenhouse gas",
        "carbon", "net zero", "decarbonisation", "scope 1", "scope 2",
        "scope 3", "paris agreement", "carbon neutral", "climate risk",
        "tcfd", "transition plan",
    ],
    "SDG 14": [
        "ocean", "marine", "water pollution", "plastic pollution",
        "aquatic ecosystem", "fisheries", "biodiversity ocean",
    ],
    "SDG 15": [
        "biodiversity", "land use", "deforestation", "forest",
        "ecosystem", "habitat", "species", "conservation", "tnfd",
        "nature-based solutions",
    ],
    "SDG 16": [
        "governance", "anti-corruption", "transparency", "accountability",
        "rule of law", "human rights", "ethics", "board oversight",
        "whistleblowing", "compliance",
    ],
    "SDG 17": [
        "partnerships", "multi-stakeholder", "public-private partnership",
        "collaboration", "sustainable development goals", "sdg",
        "reporting framework", "gri", "sasb",
    ],
}
