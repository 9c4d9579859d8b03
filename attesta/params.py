"""Tunable settings, one frozen dataclass per stage."""

from __future__ import annotations

from dataclasses import dataclass, field

from attesta import constants as k


@dataclass(frozen=True)
class ChunkParams:
    max_tokens: int = 600
    overlap_tokens: int = 80
    min_tokens: int = 50
    words_per_token: float = 0.75
    # Pages of one report are handled in blocks of this many consecutive page
    # numbers, so that a very long report spreads over many tasks.
    block_pages: int = 4096

    @property
    def max_words(self) -> int:
        return int(self.max_tokens * self.words_per_token)

    @property
    def step(self) -> int:
        advance = self.max_words - int(self.overlap_tokens * self.words_per_token)
        return advance if advance > 0 else self.max_words

    @property
    def min_words(self) -> int:
        """Fewest words whose truncated token estimate reaches the minimum."""
        n = max(1, int(self.min_tokens * self.words_per_token) - 1)
        while int(n / self.words_per_token) < self.min_tokens:
            n += 1
        return n


@dataclass(frozen=True)
class RetrievalParams:
    top_k: int = 20
    vector_weight: float = 0.6
    keyword_weight: float = 0.4
    rhetoric_factor: float = 0.3
    floor: float = 0.15
    keywords_for_full_score: int = 8
    lexicon: dict = field(default_factory=lambda: k.GOAL_KEYWORDS)
    rhetoric: tuple = tuple(k.RHETORIC_PATTERNS)
    action: tuple = tuple(k.ACTION_PATTERNS)
    # Chunk vectors that bounds of the similarity are taken from.
    pivots: int = 32
    # Characters handed to the embedder; None is the whole text. With a limit,
    # the characters left out are reported next to the vector.
    embed_chars: int | None = None


@dataclass(frozen=True)
class ExtractionParams:
    # Entries read per response; None reads all. Cut entries are in
    # ``extraction.dropped_entries``.
    items_per_chunk: int | None = 5
    max_attempts: int = 3
    default_confidence: float = 0.5
    # Only real JSON booleans switch a support flag on. Off by default: any
    # non-empty text, "false" included, then counts as true.
    strict_flags: bool = False


@dataclass(frozen=True)
class FindingsParams:
    """Lengths of the lists in a report; None is everything."""

    key_page_items: int | None = 5
    top_tags: int | None = 4
    strongest: int | None = 10
    moderate: int | None = 20
    reasons: int | None = 10


@dataclass(frozen=True)
class PeriodParams:
    cut_year: int = 2021
    before: str = "before"
    after: str = "after"


@dataclass(frozen=True)
class MaturityParams:
    score_divisor: float = 13.0
    score_weight: float = 0.5
    stage_weight: float = 0.3
    quality_weight: float = 0.2
