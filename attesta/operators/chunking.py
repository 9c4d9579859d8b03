"""Pages to overlapping text chunks, for many reports at once.

The section logic runs on a narrow table (page number, heading, word count)
that is computed once; page texts are then read a second time and cut by word
position. A section of any length is therefore never concatenated in one place,
and a report of any length is spread over blocks of pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta.functions.blocks import running_before
from attesta.functions.text import strip, token_estimate, word_count, words
from attesta.params import ChunkParams
from attesta.staging import staged

DEFAULT_HEADING = "Unknown Section"


def word_stats(df: DataFrame, text: str = "text", params: ChunkParams = ChunkParams()) -> DataFrame:
    """Add word count and token estimate of a text column."""
    return df.withColumn("n_words", word_count(text)).withColumn(
        "n_tokens", token_estimate(F.col("n_words"), params.words_per_token)
    )


def page_words(pages: DataFrame) -> DataFrame:
    """Narrow page table: heading (NULL when empty) and word count, no text."""
    return pages.select(
        "report_id",
        "page_number",
        F.nullif("section_heading", F.lit("")).alias("h"),
        word_count("text").alias("n_words"),
    )


def locate_sections(narrow: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """Assign every page of a narrow page table to its section.

    A page opens a section when it has a heading that differs from the last
    heading before it; pages without one continue the running section. Result:
    report_id, page_number, section_start, section_heading, n_words.
    """
    blocked = narrow.withColumn("block", F.floor(F.col("page_number") / params.block_pages))
    in_block = W.partitionBy("report_id", "block").orderBy("page_number")
    before = in_block.rowsBetween(W.unboundedPreceding, -1)
    upto = in_block.rowsBetween(W.unboundedPreceding, 0)
    seen = blocked.withColumn("prev_h", F.last("h", ignorenulls=True).over(before))

    # What the rest of the report must know about a block.
    inner_break = F.when(F.col("h") != F.col("prev_h"), F.col("page_number"))
    headed = F.when(F.col("h").isNotNull(), F.struct("page_number", "h"))
    blocks = seen.groupBy("report_id", "block").agg(
        F.min("page_number").alias("first_page"),
        F.min(headed).alias("first_headed"),
        F.max(headed)["h"].alias("last_h"),
        F.max(inner_break).alias("last_inner"),
    )
    over_blocks = W.partitionBy("report_id").orderBy("block")
    earlier = over_blocks.rowsBetween(W.unboundedPreceding, -1)
    carried = (
        blocks.withColumn("carry_h", F.last("last_h", ignorenulls=True).over(earlier))
        .withColumn(
            "opening",
            F.when(
                F.col("first_headed.h") != F.coalesce("carry_h", F.lit("")),
                F.col("first_headed.page_number"),
            ),
        )
        .withColumn("last_break", F.greatest("last_inner", "opening"))
        .select(
            "report_id",
            "block",
            "carry_h",
            F.coalesce(
                F.last("last_break", ignorenulls=True).over(earlier),
                F.first("first_page").over(
                    over_blocks.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
                ),
            ).alias("carry_start"),
        )
    )
    joined = seen.join(carried, ["report_id", "block"])
    opens = F.when(
        F.col("h") != F.coalesce("prev_h", "carry_h", F.lit("")), F.col("page_number")
    )
    return joined.select(
        "report_id",
        "page_number",
        F.coalesce(F.last(opens, ignorenulls=True).over(upto), "carry_start").alias(
            "section_start"
        ),
        F.coalesce(
            F.last("h", ignorenulls=True).over(upto), "carry_h", F.lit(DEFAULT_HEADING)
        ).alias("section_heading"),
        "n_words",
    )


def pages_as_sections(narrow: DataFrame) -> DataFrame:
    """Every page is its own section, named after its number when unnamed."""
    return narrow.select(
        "report_id",
        "page_number",
        F.col("page_number").alias("section_start"),
        F.coalesce(
            "h", F.concat(F.lit("Page "), F.col("page_number").cast("string"))
        ).alias("section_heading"),
        "n_words",
    )


def _windows_kept(total, params: ChunkParams):
    """How many windows of a section reach the minimum size.

    Window sizes never grow along a section, so the kept ones come first and
    their number follows from the word total alone.
    """
    if params.min_words > params.max_words:
        return F.lit(0).cast("bigint")
    sliding = F.floor((total - params.min_words) / params.step) + 1
    return (
        F.when(total < params.min_words, F.lit(0))
        .when(total <= params.max_words, F.lit(1))
        .otherwise(sliding)
        .cast("bigint")
    )


def place_sections(sections: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """Add per page: words before it in its section, section total, kept windows
    and the number of chunks kept in earlier sections of the report."""
    block = F.floor(F.col("page_number") / params.block_pages)
    paged = sections.withColumn("block", block)
    per_block = paged.groupBy("report_id", "section_start", "block").agg(
        F.sum("n_words").alias("block_words")
    )
    along = W.partitionBy("report_id", "section_start").orderBy("block")
    per_block = per_block.select(
        "report_id",
        "section_start",
        "block",
        F.coalesce(
            F.sum("block_words").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("block_start"),
        F.sum("block_words")
        .over(along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        .alias("section_words"),
    ).withColumn("kept", _windows_kept(F.col("section_words"), params))

    section_block = F.floor(F.col("section_start") / params.block_pages)
    heads = per_block.filter(F.col("block") == section_block).select(
        "report_id", "section_start", "kept"
    )
    counted = running_before(
        heads, ["report_id"], section_block, "section_start", F.col("kept"), "chunks_before"
    ).select("report_id", "section_start", "chunks_before")
    placed = per_block.join(counted, ["report_id", "section_start"])

    inside = (
        W.partitionBy("report_id", "block", "section_start")
        .orderBy("page_number")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        paged.withColumn("inside", F.coalesce(F.sum("n_words").over(inside), F.lit(0)))
        .join(placed, ["report_id", "block", "section_start"])
        .select(
            "report_id",
            "page_number",
            "section_start",
            "section_heading",
            "n_words",
            (F.col("block_start") + F.col("inside")).alias("word_offset"),
            "section_words",
            "kept",
            "chunks_before",
        )
    )


def chunk_pages(
    pages: DataFrame,
    params: ChunkParams = ChunkParams(),
    by_section: bool = True,
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Chunks of at most ``max_tokens`` with overlap, undersized ones dropped.

    Input pages: report_id, page_number, text, section_heading. Output:
    report_id, chunk_no, chunk_id, page_number, section_heading, text.
    ``stage`` keeps the narrow tables, which several later steps read.
    """
    narrow = stage(page_words(pages))
    sections = (
        stage(locate_sections(narrow, params)) if by_section else pages_as_sections(narrow)
    )
    placed = place_sections(sections, params).filter((F.col("n_words") > 0) & (F.col("kept") > 0))
    texts = pages.select("report_id", "page_number", "text")
    whole = F.col("section_words") <= params.max_words

    # Window numbers a page takes part in: window w covers words
    # [w * step, w * step + max_words) of its section.
    first = F.when(F.col("word_offset") < params.max_words, F.lit(0)).otherwise(
        F.floor((F.col("word_offset") - params.max_words) / params.step) + 1
    )
    last = F.floor((F.col("word_offset") + F.col("n_words") - 1) / params.step)
    spread = (
        placed.join(texts, ["report_id", "page_number"])
        .withColumn("from_w", F.when(whole, F.lit(0)).otherwise(first).cast("bigint"))
        .withColumn(
            "to_w",
            F.when(whole, F.lit(0)).otherwise(F.least(last, F.col("kept") - 1)).cast("bigint"),
        )
        .filter(F.col("from_w") <= F.col("to_w"))
        .withColumn("whole_text", F.when(whole, F.col("text")))
        .withColumn("page_words", F.when(~whole, words("text")))
        .select(
            "report_id",
            "page_number",
            "section_start",
            "section_heading",
            "word_offset",
            "n_words",
            "chunks_before",
            "whole_text",
            "page_words",
            F.explode(F.sequence("from_w", "to_w")).alias("window"),
        )
    )
    start = F.greatest(F.lit(0), F.col("window") * params.step - F.col("word_offset"))
    stop = F.least(
        F.col("n_words").cast("bigint"),
        F.col("window") * params.step + params.max_words - F.col("word_offset"),
    )
    piece = F.coalesce(
        "whole_text",
        F.array_join(
            F.slice("page_words", (start + 1).cast("int"), (stop - start).cast("int")), " "
        ),
    )
    pieces = spread.select(
        "report_id",
        "section_start",
        "section_heading",
        "chunks_before",
        "window",
        F.col("whole_text").isNotNull().alias("is_whole"),
        F.struct("page_number", piece.alias("piece")).alias("part"),
    )
    # A chunk holds at most max_words words, so at most that many page parts.
    parts = F.transform(F.array_sort(F.collect_list("part")), lambda p: p["piece"])
    chunks = pieces.groupBy(
        "report_id", "section_start", "section_heading", "chunks_before", "window", "is_whole"
    ).agg(parts.alias("parts"))
    body = F.when(F.col("is_whole"), strip(F.array_join("parts", "\n\n"))).otherwise(
        F.array_join("parts", " ")
    )
    number = F.col("chunks_before") + F.col("window")
    digest = F.substring(
        F.md5(
            F.concat_ws(
                ":",
                F.col("section_start").cast("string"),
                F.col("chunk_no").cast("string"),
                F.substring("text", 1, 80),
            )
        ),
        1,
        8,
    )
    return chunks.select(
        "report_id",
        number.alias("chunk_no"),
        "section_start",
        "section_heading",
        body.alias("text"),
    ).select(
        "report_id",
        "chunk_no",
        F.concat_ws(
            "_",
            F.lit("chunk"),
            F.col("section_start").cast("string"),
            F.col("chunk_no").cast("string"),
            digest,
        ).alias("chunk_id"),
        F.col("section_start").alias("page_number"),
        "section_heading",
        "text",
    )
