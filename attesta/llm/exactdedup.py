"""Exact duplicates by digest, with frequent digests split off.

1. Every row becomes a narrow (row, doc_id, digest) record; texts are read once.
2. Misra-Gries: each task keeps at most `heavy` counters over its digests; the
   summaries are merged into at most `heavy` candidates. Every digest that more
   than n / (heavy + 1) rows have is among them.
3. The candidates are counted exactly, and those above that share are the frequent
   digests, with the row that stays. Their table has at most `heavy` rows, so it is
   broadcast, and their rows are decided where they lie, without a shuffle.
4. The remaining digests meet by an ordinary shuffle: one partially aggregated
   group per digest, joined back. None of them is frequent, so none is a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import staged, text_of, unstage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class ExactParams:
    heavy: int = 1024  # counters of a summary, and bound of the broadcast table


def digest_of(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text with A-Z in lower case."""
    return F.sha2(F.translate(text, UPPER, UPPER.lower()).cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest) per row; `row` tells repeated rows apart once staged."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(digest_of(text_of())).alias("digest"),
    )


def merged(counters: pd.Series, heavy: int) -> pd.Series:
    """At most `heavy` counters: all lose the value of the first one left out."""
    if len(counters) <= heavy:
        return counters
    least = counters.nlargest(heavy + 1).iloc[-1]
    left = counters - least
    return left[left > 0]


def candidates(rows: DataFrame, params: ExactParams) -> DataFrame:
    """(digest): at most `heavy`, with every digest of more than n / (heavy + 1) rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = pd.Series(dtype="int64")
        for batch in batches:
            counters = merged(counters.add(batch["digest"].value_counts(), fill_value=0).astype("int64"), params.heavy)
        yield pd.DataFrame({"digest": counters.index, "n": counters.to_numpy()})

    parts = rows.select("digest").mapInPandas(run, "digest binary, n bigint")
    total = staged(parts.groupBy("digest").agg(F.sum("n").alias("n")), "counters")
    first_out = total.orderBy(F.desc("n"), "digest").limit(params.heavy + 1).select("n")
    full = first_out.agg(F.when(F.count("*") > params.heavy, F.min("n")).otherwise(0)).first()[0]
    return total.filter(F.col("n") > full).select("digest")


def _groups(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_row, group_size): the largest id stays, null ids last."""
    return rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"),
        F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"),
        F.count("*").alias("group_size"),
    )


def frequent(rows: DataFrame, params: ExactParams) -> DataFrame:
    """The groups of the frequent digests, counted exactly; at most `heavy` rows."""
    found = _groups(rows.join(F.broadcast(candidates(rows, params)), "digest"))
    return staged(found.filter(F.col("group_size") * (params.heavy + 1) > rows.count()), "frequent")


def decided(rows: DataFrame, params: ExactParams) -> DataFrame:
    """`rows` with keep_id, keep_row and group_size; the rows of `digests`, staged."""
    winners = frequent(rows, params)
    columns = ["row", "doc_id", "digest", "keep_id", "keep_row", "group_size"]
    met = rows.join(F.broadcast(winners), "digest", "left")
    heavy = met.filter("group_size is not null").select(*columns)
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    return heavy.union(light.join(_groups(light), "digest").select(*columns))


def find_copies(docs: DataFrame, params: ExactParams | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`.

    Texts are equal if they are identical after lower-casing A-Z; a null text is the
    empty text. The row with the largest doc_id stays; null ids come last, so
    keep_id is null only if no row of the group has an id. Of repeated rows with the
    winning id exactly one is kept. Texts of any length; other columns are not read;
    an empty table gives no rows.
    """
    params = params or ExactParams()
    found = decided(staged(digests(docs), "digests"), params)
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, params: ExactParams | None = None) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows are numbered together with their texts, so exactly one row of each group
    stays, also among repeated rows; which of those with the winning id is open.
    """
    params = params or ExactParams()
    numbered = staged(
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc")).select(
            "doc", F.monotonically_increasing_id().alias("row")
        ),
        "numbered",
    )
    rows = staged(
        numbered.select(
            "row", F.col("doc.doc_id").cast("bigint").alias("doc_id"),
            F.unhex(digest_of(F.coalesce(F.col("doc.text").cast("string"), F.lit("")))).alias("digest"),
        ),
        "digests",
    )
    stay = decided(rows, params).filter("row = keep_row").select("row")
    kept = staged(numbered.join(stay, "row", "left_semi").select("doc.*"), "kept")
    unstage(numbered)
    unstage(rows)
    return kept
