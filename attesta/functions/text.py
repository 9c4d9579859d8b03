"""Text expressions: whitespace, words, tokens, previews, list texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when splitting or stripping text.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def once(value, use) -> Column:
    """``use(value)`` with the value computed a single time."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(col) -> Column:
    return F.trim(col, F.lit(SPACE_CHARS))


def is_blank(col) -> Column:
    return F.coalesce(strip(col), F.lit("")) == ""


def words(col) -> Column:
    """White-space separated words; an empty array for blank text."""
    return F.when(is_blank(col), F.array().cast("array<string>")).otherwise(
        F.split(strip(col), SPACE_RUN)
    )


def word_count(col) -> Column:
    return F.when(is_blank(col), F.lit(0)).otherwise(F.size(F.split(strip(col), SPACE_RUN)))


def token_estimate(n_words, words_per_token: float = 0.75) -> Column:
    return F.floor(n_words / F.lit(words_per_token)).cast("int")


def tidy_page(col) -> Column:
    """Layout clean-up: long newline runs, tabs, space runs, outer white space."""
    paragraphs = F.regexp_replace(col, r"\n{3,}", "\n\n")
    flat = F.translate(paragraphs, "\t", " ")
    return strip(F.regexp_replace(flat, r" {2,}", " "))


def preview(col, n: int | None) -> Column:
    """The first n characters, or all of them."""
    return F.col(col) if isinstance(col, str) and n is None else col if n is None else F.substring(col, 1, n)


def left_out(col, n: int | None) -> Column:
    """Characters beyond the first n."""
    column = F.col(col) if isinstance(col, str) else col
    return F.lit(0) if n is None else F.greatest(F.length(column) - n, F.lit(0))


def any_match(col, patterns) -> Column:
    """True when one of the patterns is found, ignoring case (one alternation)."""
    return col.rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns))


def bracketed_list(col) -> Column:
    """List text with quoted entries, as used in validation messages."""
    quoted = F.transform(
        col,
        lambda x: F.when(
            x.contains("'") & ~x.contains('"'), F.concat(F.lit('"'), x, F.lit('"'))
        ).otherwise(
            F.concat(
                F.lit("'"),
                F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")),
                F.lit("'"),
            )
        ),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def lookup(col, mapping: dict, default=None) -> Column:
    """CASE over a small constant table (stays inside generated code)."""
    pairs = list(mapping.items())
    expr = reduce(
        lambda acc, kv: acc.when(col == kv[0], F.lit(kv[1])),
        pairs[1:],
        F.when(col == pairs[0][0], F.lit(pairs[0][1])),
    )
    return expr if default is None else expr.otherwise(default)


def slug(col, length: int | None = None) -> Column:
    """Name as a folder part. A cut can make two names equal, so none is the default."""
    return preview(F.replace(F.lower(col), F.lit(" "), F.lit("_")), length)
