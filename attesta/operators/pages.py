"""Page-level steps: layout clean-up, sparse pages, headings from font sizes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta.functions.blocks import first_n
from attesta.functions.text import strip, tidy_page, word_count
from attesta.staging import staged

SPARSE_BELOW = 30
HEADING_WORDS = 15
HEADING_RATIO = 1.1
LEADING_SPANS = 10
CAPITAL_SPANS = 5
BOUND_SLOTS = 16
BOUND_BINS = 65_536


def split_pages(reports: DataFrame, separator: str = "\n") -> DataFrame:
    """Cut whole report texts (report_id, text) into numbered pages; none is dropped."""
    return reports.select(
        "report_id", F.posexplode(F.split("text", separator)).alias("pos", "text")
    ).select("report_id", (F.col("pos") + 1).alias("page_number"), "text")


def clean_pages(pages: DataFrame) -> DataFrame:
    """Tidy the page text; a page whose text is missing stays as an empty page."""
    return pages.withColumn("text", F.coalesce(tidy_page(F.col("text")), F.lit("")))


def sparse_pages(pages: DataFrame, below: int = SPARSE_BELOW) -> DataFrame:
    """One row per page with hardly any text."""
    return pages.select(
        "report_id", "page_number", F.length("text").alias("n_chars")
    ).filter(F.col("n_chars") < below)


def sparse_summary(pages: DataFrame, below: int = SPARSE_BELOW) -> DataFrame:
    """Per report: number of pages and of sparse pages, first and last sparse page."""
    sparse = F.length("text") < below
    return pages.groupBy("report_id").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_if(sparse).alias("n_sparse"),
        F.min(F.when(sparse, F.col("page_number"))).alias("first_sparse"),
        F.max(F.when(sparse, F.col("page_number"))).alias("last_sparse"),
    )


def _bin(page: list[str]) -> Column:
    return F.pmod(F.xxhash64(*page), F.lit(BOUND_BINS)).cast("int")


def _bounds(sizes: DataFrame, page: list[str]) -> Column:
    """Array with a span number per bin of pages: no page of the bin has one of its first
    ``LEADING_SPANS`` spans beyond it.

    The lowest numbers of different slots are different spans, so that many of them end
    at or after the first spans; a page with fewer slots in use is bounded by its last.
    """
    lows = [F.min(f"__low_{i}") for i in range(BOUND_SLOTS)]
    found = F.get(F.array_sort(F.array_compact(F.array(*lows))), F.lit(LEADING_SPANS - 1))
    pages = sizes.groupBy(*page).agg(F.coalesce(found, F.max("__last")).alias("bound"))
    bins = pages.groupBy(_bin(page).alias("bin")).agg(F.max("bound").alias("bound"))
    every = sizes.sparkSession.range(BOUND_BINS).withColumnRenamed("id", "bin").join(bins, "bin", "left")
    return every.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bin", "bound"))), lambda b: b["bound"])
    ).scalar()


def detect_headings(
    spans: DataFrame, stage: Callable[[DataFrame], DataFrame] = staged
) -> DataFrame:
    """Heading per page from text spans (report_id, page_number, span_no, size, text).

    Leading spans clearly larger than the upper median size form the heading;
    otherwise the first short all-capitals span near the top does. Sizes are
    counted before they are ranked, and only the first spans of a page are
    gathered, so a page with very many spans is no special case. The pass that
    counts the sizes also bounds where the first spans of a page end, so the rest
    are dropped before anything is sorted.
    """
    page = ["report_id", "page_number"]
    filled = spans.withColumn("text", strip("text")).filter(F.col("text") != "")

    slot = F.pmod(F.xxhash64("span_no"), F.lit(BOUND_SLOTS))
    sizes = filled.groupBy(*page, "size").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("span_no").alias("__last"),
        *[F.min(F.when(slot == i, F.col("span_no"))).alias(f"__low_{i}") for i in range(BOUND_SLOTS)],
    )
    sizes = stage(sizes)
    by_size = W.partitionBy(*page).orderBy("size")
    medians = (
        sizes.withColumn("upto", F.sum("n").over(by_size))
        .withColumn("total", F.sum("n").over(W.partitionBy(*page)))
        .filter(F.col("upto") > F.floor(F.col("total") / 2))
        .groupBy(*page)
        .agg(F.min("size").alias("median_size"))
    )

    bound = F.element_at(_bounds(sizes, page), _bin(page) + 1)
    near_top = filled.filter(F.col("span_no").isNull() | (F.col("span_no") <= bound))
    lead = first_n(near_top, page, [F.col("span_no")], LEADING_SPANS, "rn").join(medians, page)
    n_words = word_count("text")
    large = (F.col("size") >= F.col("median_size") * HEADING_RATIO) & (n_words <= HEADING_WORDS)
    capital = (
        (F.col("rn") <= CAPITAL_SPANS)
        & (F.upper("text") == F.col("text"))
        & (F.lower("text") != F.col("text"))
        & n_words.between(2, HEADING_WORDS)
        & (F.length("text") > 3)
    )
    flagged = lead.select(*page, "rn", "text", large.alias("large"), capital.alias("capital"))
    tops = flagged.groupBy(*page).agg(
        F.min(F.when(~F.col("large"), F.col("rn"))).alias("first_small"),
        F.array_sort(F.collect_list(F.struct("rn", "text"))).alias("top"),
        F.min(F.when(F.col("capital"), F.struct("rn", "text")))["text"].alias("capital_text"),
    )
    prefix = F.array_join(
        F.transform(
            F.filter(
                "top", lambda s: F.col("first_small").isNull() | (s["rn"] < F.col("first_small"))
            ),
            lambda s: s["text"],
        ),
        " ",
    )
    return tops.select(
        *page,
        F.coalesce(F.nullif(prefix, F.lit("")), "capital_text").alias("section_heading"),
    ).filter(F.col("section_heading").isNotNull())


def with_headings(pages: DataFrame, headings: DataFrame) -> DataFrame:
    return pages.drop("section_heading").join(headings, ["report_id", "page_number"], "left")
