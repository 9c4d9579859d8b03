"""Prompts, responses and their conversion to evidence records.

The model call itself is a user function. Everything after it works on typed
JSON values (VARIANT), so a text "false" and a boolean false stay apart.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta import constants as k
from attesta.functions.blocks import first_n
from attesta.functions.text import once, strip
from attesta.params import ExtractionParams

PROMPT_TEMPLATE = (
    "Read this excerpt of a company report and list the evidence it gives for the"
    " goals SDG 1 to SDG 17.\n"
    "Company: {company}\nReport: {report_name} ({report_year})\nPage: {page_number}\n"
    "Section: {section_heading}\n\n{text}\n\n"
    'Answer with one JSON object {{"evidence_items": [...]}} and nothing else.'
)
RETRY_NOTE = (
    '\n\nThe last answer was not valid JSON. Answer with {"evidence_items": [...]} only.'
)


def with_prompts(chunks: DataFrame, template: str = PROMPT_TEMPLATE) -> DataFrame:
    """Fill a template with the columns it names; NULL becomes an empty text."""
    parts: list[Column] = []
    rest = template
    while rest:
        head, brace, tail = rest.partition("{")
        if brace and tail.startswith("{"):
            parts.append(F.lit(head + "{"))
            rest = tail[1:]
        elif brace:
            name, _, rest = tail.partition("}")
            parts += [F.lit(head), F.coalesce(F.col(name).cast("string"), F.lit(""))]
        else:
            parts.append(F.lit(head))
            rest = ""
    text = F.replace(F.concat(*parts), F.lit("}}"), F.lit("}"))
    return chunks.withColumn("prompt", text)


def _is_json_object(raw: str) -> bool:
    """Same acceptance as ``response_object``: bare, fenced, or embedded."""
    body = raw.strip().removeprefix("```json").removeprefix("```").removesuffix("```").strip()
    for candidate in (body, body[body.find("{") : body.rfind("}") + 1]):
        try:
            return isinstance(json.loads(candidate, parse_constant=_not_json), dict)
        except ValueError:
            continue
    return False


def _not_json(name: str):
    raise ValueError(name)


BATCH_BYTES = 4 << 20  # of prompts that a Python worker takes at a time


def call_model(
    prompts: DataFrame,
    answer: Callable[[str], str],
    keys: list[str],
    params: ExtractionParams = ExtractionParams(),
    tasks: int | None = None,
    pause: float = 0.0,
) -> DataFrame:
    """Ask a user function for every prompt; one failure never stops the rest.

    Output: keys, raw_response, attempts, error. ``tasks`` sets how many
    prompts are in flight at once; rows move by key, so a retried task asks
    for the same prompts again. Batches are bounded in bytes, since prompts have
    any length.
    """
    prompts.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    key_fields = [prompts.schema[key] for key in keys]
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields)
    limit = params.max_attempts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for prompt in batch["prompt"]:
                text, raw, error, attempt = prompt, None, None, 0
                while attempt < limit:
                    attempt += 1
                    try:
                        raw, error = answer(text), None
                    except Exception as exc:  # recorded, the next prompt goes on
                        error = f"{type(exc).__name__}: {exc}"
                    else:
                        if raw is not None and _is_json_object(raw):
                            break
                        error, text = "response is not JSON", prompt + RETRY_NOTE
                    if pause and attempt < limit:
                        time.sleep(pause * attempt)
                rows.append((raw, attempt, error))
            yield batch[keys].assign(
                raw_response=[r[0] for r in rows],
                attempts=[r[1] for r in rows],
                error=[r[2] for r in rows],
            )

    source = prompts.select(*keys, "prompt")
    if tasks:
        source = source.repartition(tasks, *keys)
    return source.mapInPandas(run, f"{layout}, raw_response string, attempts int, error string")


def store_responses(
    prompts: DataFrame,
    answer: Callable[[str], str],
    keys: list[str],
    path: str,
    params: ExtractionParams = ExtractionParams(),
    rounds: int = 1,
    give_up_after: int | None = None,
    **options,
) -> DataFrame:
    """Ask for the prompts that ``path`` has no answer to, store the answers, and
    return the stored answer of every key (see ``stored_responses``).

    ``path`` is a ledger: every call is a row, a failed one with its error. A key
    without a good answer is asked again on the next run, until it has
    ``give_up_after`` attempts if that is given; a key with one is never asked again.
    ``rounds`` splits the prompts by a hash of the keys; each round is committed on
    its own, so a run that stops in the middle goes on where it stopped. A null key
    is a key like any other.
    """
    spark = prompts.sparkSession
    for number in range(rounds):
        part = prompts.filter(F.pmod(F.xxhash64(*keys), F.lit(rounds)) == number)
        call, settled = 1, None
        if _exists(spark, path):
            asked = spark.read.parquet(path)
            call = asked.agg(F.coalesce(F.max("call_no"), F.lit(0))).first()[0] + 1
            known = asked.groupBy(*keys).agg(
                F.bool_or(F.col("error").isNull()).alias("good"), F.sum("attempts").alias("tried")
            )
            done = F.col("good")
            if give_up_after is not None:
                done = done | (F.col("tried") >= give_up_after)
            settled = known.filter(done).select(*[F.col(key).alias(f"_{key}") for key in keys])
        if settled is not None:
            same = [part[key].eqNullSafe(settled[f"_{key}"]) for key in keys]
            part = part.join(settled, reduce(Column.__and__, same), "left_anti")
        answers = call_model(part, answer, keys, params, **options)
        answers.withColumn("call_no", F.lit(call)).write.mode("append").parquet(path)
    return stored_responses(spark, path, keys)


def stored_responses(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Keys, raw_response, attempts and error, one row per key of a ledger.

    A good answer comes before a failed one, then the latest call; ``attempts`` is the
    sum over all calls.
    """
    ledger = spark.read.parquet(path)
    total = F.sum("attempts").over(W.partitionBy(*keys)).cast("int")
    order = [F.col("error").isNotNull(), F.col("call_no").desc(), F.col("raw_response")]
    first = first_n(ledger.withColumn("_total", total), list(keys), order, 1, "_rank")
    return first.select(*keys, "raw_response", F.col("_total").alias("attempts"), "error")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished write has left files at the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


# --- responses -----------------------------------------------------------------


_BOX = "array<struct<evidence_items:array<variant>>>"


def _single_value(text) -> Column:
    """A text that holds exactly one JSON value, as a list of it, else NULL.

    The value is NULL unless it is an object; only its entries are taken out, and
    they are copied once. The parser ignores what follows the first value of a text.
    Inside brackets trailing text makes the list malformed or longer than one.
    """
    boxed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", _BOX)
    return once(boxed, lambda b: F.when(F.size(b) == 1, b))


def _document(body) -> Column:
    """The body as one JSON value, else its part from the first { to the last }."""
    inner = F.regexp_substr(body, F.lit(r"(?s)\{.*\}"))
    # Text without matching outer brackets is not worth a failing parse.
    bracketed = (body.startswith("{") & body.endswith("}")) | (
        body.startswith("[") & body.endswith("]")
    )
    return once(
        F.when(bracketed, _single_value(body)),
        lambda doc: F.when(doc.isNotNull(), doc).otherwise(_single_value(inner)),
    )


def _outcome(doc, limit: int | None) -> Column:
    """Error, usable entries, and number of all entries of a parsed response."""
    value = F.get(doc, 0)
    none = F.lit(None).cast("array<variant>")

    def failed(message: str) -> Column:
        return F.struct(
            F.lit(message).alias("parse_error"), none.alias("items"),
            F.lit(None).cast("int").alias("n_entries"),
        )

    def checked(every) -> Column:
        items = every if limit is None else F.slice(every, 1, limit)
        # Only an object becomes a struct.
        broken = F.exists(items, lambda item: F.try_variant_get(item, "$", "struct<x:boolean>").isNull())
        return F.when(F.coalesce(broken, F.lit(False)), failed("entry is not an object")).otherwise(
            F.struct(
                F.lit(None).cast("string").alias("parse_error"), items.alias("items"),
                F.when(every.isNotNull(), F.size(every)).alias("n_entries"),
            )
        )

    return (
        F.when(doc.isNull(), failed("no JSON in response"))
        .when(value.isNull(), failed("response is not an object"))
        .otherwise(once(value["evidence_items"], checked))
    )


def parse_responses(
    responses: DataFrame, params: ExtractionParams = ExtractionParams()
) -> DataFrame:
    """Add ``items`` (the first few list entries), ``parse_error``, and ``n_entries``,
    the number of all list entries (null where there is no list).

    Code fences are removed; text that is not one JSON value is cut from its
    first { to its last } and tried again. The cap counts malformed entries
    too. An entry that is not an object makes the whole response fail. A
    response is parsed once: later filters see finished columns.
    """

    def unfenced(text) -> Column:
        """Fences are looked for only where a response begins or ends with one."""
        opened = F.when(
            text.startswith("```"), F.regexp_replace(text, r"^```(?:json)?\s*", "")
        ).otherwise(text)
        return F.when(
            text.endswith("```"), F.regexp_replace(opened, r"\s*```$", "")
        ).otherwise(opened)

    body = once(strip("raw_response"), unfenced)
    result = once(
        once(body, _document), lambda doc: _outcome(doc, params.items_per_chunk)
    )
    return responses.select("*", F.inline(F.array(result)))


UNLIMITED = 1 << 31  # more than the entries that a list can have

_LISTS = ("candidate_sdgs", "evidence_tags")


def _complete(fields) -> Column:
    required = F.array(*[F.lit(name) for name in k.RESPONSE_FIELDS])
    return F.size(F.array_except(required, F.map_keys(fields))) == 0


def _has_text(kind, text) -> Column:
    return F.coalesce(strip(_text_of(kind, text)), F.lit("")) != ""


def _entry(item) -> Column:
    """Kind and text of every expected field of one list entry."""

    def parts(fields) -> Column:
        kinds = {name: F.schema_of_variant(fields[name]) for name in k.RESPONSE_FIELDS}
        texts = {
            name: F.try_variant_get(fields[name], "$", "string")
            for name in k.RESPONSE_FIELDS
            if name not in _LISTS
        }
        return F.struct(
            _complete(fields).alias("complete"),
            _has_text(kinds["evidence_text"], texts["evidence_text"]).alias("has_text"),
            *[kinds[n].alias(f"kind_{n}") for n in k.RESPONSE_FIELDS if n not in _LISTS],
            *[text.alias(f"text_{name}") for name, text in texts.items()],
            *[_list_of(fields[name]).alias(name) for name in _LISTS],
        )

    return once(F.try_variant_get(item, "$", "map<string,variant>"), parts)


def response_items(parsed: DataFrame) -> DataFrame:
    """One row per entry, with its position and the parts of its fields.

    Fields are taken apart inside the list, before it is expanded: rules on the
    rows then refer to plain columns, which keeps the plan small.
    """
    others = [c for c in parsed.columns if c not in ("items", "raw_response", "parse_error", "n_entries")]
    return parsed.select(
        *others, F.posexplode(F.transform("items", _entry)).alias("item_no", "item")
    )


def _text_of(kind, text) -> Column:
    """Text form of a JSON value: null and booleans by name, numbers as written."""
    return (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def _truth_of(kind, text, strict: bool) -> Column:
    """Truth of a JSON value. Unless strict, any non-empty text counts as true."""
    if strict:
        return (kind == "BOOLEAN") & (text == "true")
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != "")
        .when(kind == "VOID", F.lit(False))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text.isin("[]", "{}"))
        .otherwise(F.coalesce(text.try_cast("double") != 0.0, F.lit(True)))
    )


def _number_of(kind, text, default: float) -> Column:
    """Number between 0 and 1; what is not a number becomes the default."""
    plain = r"^(?i)\s*[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?\s*$"
    number = F.when(kind == "BOOLEAN", (text == "true").cast("double")).when(
        text.rlike(plain), text.try_cast("double")
    )
    # greatest and least skip NULL, so the default must be chosen first.
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(number, F.lit(default))))


def _list_of(value) -> Column:
    entries = F.try_variant_get(value, "$", "array<string>")
    named = F.transform(entries, lambda x: F.coalesce(x, F.lit("None")))
    return F.coalesce(named, F.array().cast("array<string>"))


def coerce_items(items: DataFrame, params: ExtractionParams = ExtractionParams()) -> DataFrame:
    """Typed evidence fields of each entry; entries with a missing field or an
    empty evidence text are dropped."""
    others = [c for c in items.columns if c != "item"]

    def parts(name: str) -> tuple[Column, Column]:
        return F.col(f"item.kind_{name}"), F.col(f"item.text_{name}")

    def text(name: str) -> Column:
        return strip(_text_of(*parts(name))).alias(name)

    def truth(name: str) -> Column:
        return _truth_of(*parts(name), params.strict_flags).alias(name)

    return items.filter(F.col("item.complete") & F.col("item.has_text")).select(
        *others,
        text("evidence_text"),
        text("evidence_summary"),
        *[F.col(f"item.{name}").alias(name) for name in _LISTS],
        text("implementation_stage"),
        truth("quantitative_support"),
        truth("oversight_support"),
        _number_of(*parts("confidence"), params.default_confidence).alias("confidence"),
        text("rationale"),
    )


def to_records(
    items: DataFrame,
    chunks: DataFrame,
    keys: list[str],
    params: ExtractionParams = ExtractionParams(),
) -> DataFrame:
    """Evidence records with provenance and order from the chunk table.

    Ids are a hash of chunk key and position, so a rerun gives the same ids.
    ``seq`` is the order of extraction: best chunk first, then item position.
    """
    provenance = chunks.select(
        *keys, "company", "report_name", "report_year", "page_number", "section_heading",
        "chunk_id", "chunk_rank",
    )
    parts = [F.col(c).cast("string") for c in (*keys, "chunk_id", "item_no")]
    return (
        coerce_items(items, params)
        .join(provenance, keys)
        .withColumns(
            {
                "evidence_id": F.md5(F.concat_ws("|", *parts)),
                "validation_status": F.lit("pending"),
                "seq": F.col("chunk_rank").cast("bigint") * (params.items_per_chunk or UNLIMITED) + F.col("item_no"),
            }
        )
    )


def _loss(item) -> Column:
    """Why an entry does not become a record; null if it does."""

    def reason(fields) -> Column:
        quote = fields["evidence_text"]
        has_text = _has_text(F.schema_of_variant(quote), F.try_variant_get(quote, "$", "string"))
        return F.when(~_complete(fields), "field missing").when(~has_text, "no evidence text")

    return once(F.try_variant_get(item, "$", "map<string,variant>"), reason)


def dropped_entries(
    parsed: DataFrame, keys: list[str], params: ExtractionParams = ExtractionParams()
) -> DataFrame:
    """What a parsed response lost, as rows (keys, item_no, reason).

    Every entry of a list is a record or a row here; a response without a list
    has one row with a null position. Unparsable responses are in ``parse_error``.
    All losses of a response come from one pass over it, so it is parsed once.
    """
    found = F.filter(
        F.transform("items", lambda item, no: F.struct(no.alias("item_no"), _loss(item).alias("reason"))),
        lambda lost: lost["reason"].isNotNull(),
    )
    n = F.col("n_entries")
    if params.items_per_chunk is not None:
        limit = F.lit(params.items_per_chunk)
        beyond = F.transform(
            F.sequence(limit, n - 1),
            lambda no: F.struct(no.alias("item_no"), F.lit("beyond the entry limit").alias("reason")),
        )
        found = F.when(n > limit, F.concat(found, beyond)).otherwise(found)
    no_list = F.array(
        F.struct(F.lit(None).cast("int").alias("item_no"), F.lit("entries are not a list").alias("reason"))
    )
    return parsed.filter(F.col("parse_error").isNull()).select(
        *keys, F.inline(F.when(n.isNull(), no_list).otherwise(found))
    )


def error_table(failures: DataFrame, keys: list[str], stage: str, message: str) -> DataFrame:
    """Failures as rows (keys, stage, message), to be united across stages."""
    return failures.filter(F.col(message).isNotNull()).select(
        *keys, F.lit(stage).alias("stage"), F.col(message).alias("message")
    )
