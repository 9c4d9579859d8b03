"""Secret scan: fixed patterns, then character Markov models for other strings.

Everything is a DataFrame or SQL expression. Spans of a pattern follow from the
lengths of the matches and of the pieces between them. Long character runs that
touch no pattern span and do not have the shape of a UUID are scored by two Markov
models, one of random strings and one of ordinary identifiers; a run whose
log-likelihood ratio per step exceeds a threshold is a span of kind `markov`.

A model has two parts: the class of a character (upper case, lower case, digit, sign)
given the classes of the two before it, and the character given its class and the
character before it, smoothed towards the character's share of its class.

The models are counted from labelled strings of all documents. Random: digests in several alphabets.
Ordinary: the letter runs of documents, their other runs that occur in several
documents, and identifiers composed of neighbouring words in the usual styles (camel
case, snake case, upper case, with numbers). Half of the strings fit the models, the
other half the threshold: the highest that still finds a share `recall` of the random
strings, cut to the least length that is scored. Both models are arrays of a fixed size, constants in the
scoring expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import staged, text_of, unstage

ASSIGN = r"""(?=[pstaPSTA])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
UUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "markov")
STATES = len(ALPHABET) + 1  # state 0: any other character
BLOCK = 128
SLICES = 1 << 40  # of the hash that chooses the training sample
EXACT_SCORES = 1_000_000  # scores that one task may hold


@dataclass(frozen=True)
class SecretParams:
    min_value: int = 6  # characters of an assigned value
    min_run: int = 16  # characters of a scored run
    train_rows: int | None = None  # about so many documents train the models; by default all
    threshold: float | None = None  # log-likelihood ratio per step; by default fitted
    recall: float = 0.97  # of random strings of the least length, when the threshold is fitted
    smoothing: float = 20.0  # weight of a character's share of its class
    seen_in: int = 3  # documents that hold an identifier with digits


def _run_pattern(least: int) -> str:
    return rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{least},}}"


def _bound(value: Column, use) -> Column:
    """`use` of a value that is computed once, however often it is named in lambdas."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, start: int, join) -> Column:
    """`join` of the elements before each element, in blocks to stay near linear."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(start), join)

    def within(block: Column, before: Column) -> Column:
        return F.transform(block, lambda _, i: join(before, total(F.slice(block, 1, i))))

    def over(blocks: Column, totals: Column) -> Column:
        return F.flatten(F.transform(
            blocks, lambda block, k: _bound(total(F.slice(totals, 1, k)), lambda before: within(block, before))
        ))

    def cut(all_values: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(all_values) / F.lit(BLOCK)).cast("int") - 1),
            lambda k: F.slice(all_values, k * BLOCK + 1, BLOCK),
        )

    return _bound(values, lambda v: _bound(cut(v), lambda blocks: _bound(
        F.transform(blocks, total), lambda totals: over(blocks, totals))))


def _before(lengths: Column) -> Column:
    """Sum of the elements before each element."""
    return _running(lengths, 0, lambda a, x: a + x)


def _spans(df: DataFrame, kind: str, pattern: str) -> DataFrame:
    """Adds column `kind`: array of (start, end, hit, value) of all matches."""
    text, has_value = F.col("text"), kind == "assign"
    found = text.rlike(pattern)
    nothing = F.array().cast("array<string>")
    df = df.withColumns({
        "_hit": F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(nothing),
        "_gap": F.when(found, F.split(text, pattern, -1)).otherwise(nothing),
        "_value": F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).otherwise(nothing)
        if has_value else nothing,
    })
    df = df.withColumn(
        "_length", F.zip_with("_hit", "_gap", lambda h, g: F.coalesce(F.length(h), F.lit(0)) + F.length(g))
    ).withColumn(
        "_start", F.when(F.size("_hit") > 0, _before(F.col("_length"))).otherwise(F.array().cast("array<int>"))
    )
    return df.withColumn(
        kind,
        F.transform(
            F.col("_hit"),
            lambda h, i: F.struct(
                (F.get("_start", i) + F.length(F.get("_gap", i))).alias("start"),
                (F.get("_start", i) + F.length(F.get("_gap", i)) + F.length(h)).alias("end"),
                h.alias("hit"),
                F.get("_value", i).alias("value"),
            ),
        ),
    ).drop("_hit", "_gap", "_value", "_length", "_start")


def _base_spans(docs: DataFrame, params: SecretParams) -> DataFrame:
    df = _spans(docs, "assign", ASSIGN)
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(s["value"]) >= params.min_value))
    return _spans(_spans(df, "access", ACCESS), "hex", HEX)


def _states(token: Column) -> Column:
    """Place of each character in the alphabet, from 1; 0 for any other character."""
    return F.transform(
        F.regexp_extract_all(token, F.lit("(?s)."), F.lit(0)), lambda c: F.call_function("locate", c, F.lit(ALPHABET))
    )


def _class(state: Column) -> Column:
    """0 no character of the alphabet, 1 upper case, 2 lower case, 3 digit, 4 sign."""
    return (
        F.when(state <= 0, 0).when(state <= 26, 1).when(state <= 52, 2).when(state <= 62, 3).otherwise(4)
    )


def _steps(states: Column) -> Column:
    """(class cell, character cell) of each step: three classes, two characters."""
    at = lambda i: F.coalesce(F.get(states, i), F.lit(0))
    return F.transform(
        F.sequence(F.lit(1), F.size(states) - 1),
        lambda i: F.struct(
            ((F.when(i > 1, _class(at(i - 2))).otherwise(0) * 5 + _class(at(i - 1))) * 5 + _class(at(i))).alias("classes"),
            (at(i - 1) * STATES + at(i)).alias("characters"),
        ),
    )


def sample_slices(train_rows: int, rows: int) -> int:
    """Slices of the hash that hold about `train_rows` of the rows, rounded up."""
    return math.ceil(min(1.0, train_rows / max(1, rows)) * SLICES)


def _number(key: Column, most: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(most)), F.lit(most)).cast("string")


def composed(words: Column) -> Column:
    """Identifiers made of each three neighbouring words, in one of eight styles."""

    def styled(i: Column) -> Column:
        a, b, c = (F.get(words, i + k) for k in range(3))
        big_a, big_b, big_c = F.initcap(a), F.initcap(b), F.initcap(c)
        key = F.concat(a, b, c)
        small, large = _number(key, 20), _number(key, 2100)
        styles = [
            F.concat(a, big_b, big_c),
            F.concat(a, big_b, small, big_c, F.upper(F.substring(b, 1, 2))),
            F.concat(a, big_b, big_c, large),
            F.concat_ws("_", a, b, c),
            F.concat_ws("_", a, b, large),
            F.concat(F.upper(a), small, F.upper(b), large),
            F.concat_ws("-", F.upper(a), F.upper(b), F.upper(c)),
            F.concat(F.substring(a, 1, 1), big_a, small, big_b, big_c, large, F.upper(F.substring(c, 1, 2))),
        ]
        pick = F.pmod(F.xxhash64(key), F.lit(len(styles)))
        chosen = styles[-1]
        for number, style in enumerate(styles[:-1]):
            chosen = F.when(pick == number, style).otherwise(chosen)
        return chosen

    last = F.size(words) - 3
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last, F.lit(3)), styled)).otherwise(
        F.array().cast("array<string>")
    )


def training_strings(docs: DataFrame, params: SecretParams) -> DataFrame:
    """(token, random, fit): distinct labelled strings; half of them fit the models.

    From all documents, or from about `train_rows`, chosen by a hash of id and text length.
    """
    sample = docs
    if params.train_rows is not None:
        key = F.pmod(F.xxhash64(F.lit("train"), "doc_id", F.length("text")), F.lit(SLICES))
        sample = docs.filter(key < F.lit(sample_slices(params.train_rows, docs.count())))
    runs = sample.select(
        "doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_run_pattern(6)), F.lit(0)))).alias("token")
    )
    seen = runs.groupBy("token").agg(F.count("*").alias("n")).filter(
        F.col("token").rlike("^[A-Za-z_-]+$")
        | ((F.col("n") >= params.seen_in) & F.col("token").rlike("[A-Za-z]") & (F.length("token") < params.min_run))
    )
    words = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9])[A-Za-z]{2,12}(?![A-Za-z0-9])"), F.lit(0))
    named = sample.select(F.transform(words, F.lower).alias("words")).select(
        F.explode(composed(F.col("words"))).alias("token")
    )
    ordinary = seen.select(F.explode(F.array("token", F.upper("token"))).alias("token")).union(named)
    digest = lambda salt: F.base64(F.unhex(F.sha2(F.concat_ws(":", F.lit(salt), F.coalesce("doc_id", F.lit(0)), F.length("text")), 256)))
    plain = lambda salt: F.regexp_replace(digest(salt), "[^A-Za-z0-9]", "")
    random = sample.select(F.explode(F.array(
        F.regexp_replace(digest("a"), "=", ""), F.translate(F.regexp_replace(digest("b"), "=", ""), "+/", "-_"),
        plain("c"), plain("d"), F.upper(plain("e")), F.lower(plain("f")),
    )).alias("token"))
    both = ordinary.select("token", F.lit(0).alias("random")).union(random.select("token", F.lit(1).alias("random")))
    fit = F.pmod(F.xxhash64(F.lit("fit"), "token"), F.lit(2)) == 0
    return both.filter(F.length("token") > 1).distinct().withColumn("fit", fit)


def _counted_steps(strings: DataFrame) -> DataFrame:
    """(random, n, step): how often each step occurs. Steps are counted as texts of two or
    three characters, of which there are few, before their cells are found."""
    last = F.col("last")
    gram = F.substring("token", F.greatest(last - 2, F.lit(1)), F.least(last, F.lit(3)))
    grams = (
        strings.select("random", "token", F.explode(F.sequence(F.lit(2), F.length("token"))).alias("last"))
        .groupBy("random", gram.alias("gram"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return grams.select("random", "n", F.element_at(_bound(_states(F.col("gram")), _steps), -1).alias("step"))


def _log_ratio() -> Column:
    return F.array_sort(F.collect_list(F.struct("cell", (F.log("p1") - F.log("p0")).alias("ratio"))))["ratio"]


def _class_ratios(steps: DataFrame) -> DataFrame:
    """One row: log ratios of the class cells, with add-one counts."""
    cells = steps.sparkSession.range(125).select(F.col("id").alias("cell"))
    counts = steps.groupBy(F.col("step.classes").cast("bigint").alias("cell")).agg(
        *[F.sum(F.when(F.col("random") == r, F.col("n")).otherwise(0)).alias(f"n{r}") for r in (0, 1)]
    )
    filled = cells.join(counts, "cell", "left").select(
        "cell", F.floor(F.col("cell") / 5).alias("before"), *[(F.coalesce(f"n{r}", F.lit(0)) + 1.0).alias(f"n{r}") for r in (0, 1)]
    )
    totals = filled.groupBy("before").agg(*[F.sum(f"n{r}").alias(f"t{r}") for r in (0, 1)])
    shares = filled.join(totals, "before").select("cell", *[(F.col(f"n{r}") / F.col(f"t{r}")).alias(f"p{r}") for r in (0, 1)])
    return shares.agg(_log_ratio().alias("classes"))


def _character_ratios(steps: DataFrame, params: SecretParams) -> DataFrame:
    """One row: log ratios of the character cells, given the next character's class."""
    cells = steps.sparkSession.range(STATES * STATES).select(F.col("id").alias("cell"))
    counts = steps.groupBy(F.col("step.characters").cast("bigint").alias("cell")).agg(
        *[F.sum(F.when(F.col("random") == r, F.col("n")).otherwise(0)).alias(f"n{r}") for r in (0, 1)]
    )
    state = F.col("cell") % STATES
    filled = cells.join(counts, "cell", "left").select(
        "cell", F.floor(F.col("cell") / STATES).alias("previous"), state.alias("state"), _class(state).alias("class"),
        *[F.coalesce(f"n{r}", F.lit(0)).cast("double").alias(f"n{r}") for r in (0, 1)],
    )
    alone = filled.groupBy("class", "state").agg(*[(F.sum(f"n{r}") + 1).alias(f"s{r}") for r in (0, 1)])
    of_class = alone.groupBy("class").agg(*[F.sum(f"s{r}").alias(f"c{r}") for r in (0, 1)])
    after = filled.groupBy("previous", "class").agg(*[F.sum(f"n{r}").alias(f"t{r}") for r in (0, 1)])
    k = params.smoothing
    joined = filled.join(alone, ["class", "state"]).join(of_class, "class").join(after, ["previous", "class"])
    shares = joined.select("cell", *[
        ((F.col(f"n{r}") + k * F.col(f"s{r}") / F.col(f"c{r}")) / (F.col(f"t{r}") + k)).alias(f"p{r}") for r in (0, 1)
    ])
    return shares.agg(_log_ratio().alias("characters"))


@dataclass(frozen=True)
class SecretModel:
    classes: Column  # constant arrays: log-likelihood ratio of every cell
    characters: Column
    threshold: float

    def score(self, states: Column) -> Column:
        """Log-likelihood ratio per step of a string given by its states."""
        total = F.aggregate(
            _steps(states), F.lit(0.0),
            lambda a, s: a + F.get(self.classes, s["classes"]) + F.get(self.characters, s["characters"]),
        )
        return total / F.greatest(F.size(states) - 1, F.lit(1))


def _constant(values: list[float]) -> Column:
    return F.split(F.lit(",".join(repr(x) for x in values)), ",").cast("array<double>")


def held_out(strings: DataFrame, model: SecretModel, params: SecretParams) -> DataFrame:
    """(random, score) of the strings kept apart that are long enough to be scored.

    Random strings are cut to the least length, which is the hardest case.
    """
    least = F.lit(params.min_run)
    token = F.when(F.col("random") == 1, F.substring("token", F.lit(1), least)).otherwise(F.col("token"))
    rows = strings.filter(~F.col("fit")).select("random", token.alias("token")).filter(F.length("token") >= least)
    return rows.select("random", _bound(_states(F.col("token")), model.score).alias("score"))


def _quantile(scores: DataFrame, share: float, most: int = EXACT_SCORES) -> float | None:
    """Exact quantile of a stored column `score`, None without rows.

    Of more than `most` scores, only those near the quantile, between two approximate
    ones, are brought together.
    """
    n = scores.count()
    if n <= most:
        return scores.agg(F.percentile("score", F.lit(share)).alias("at")).first()["at"]
    near = [max(0.0, share - 0.001), min(1.0, share + 0.001)]
    low, high = scores.agg(F.percentile_approx("score", near, 100_000).alias("at")).first()["at"]
    between = F.when(F.col("score").between(low, high), F.col("score"))
    found = scores.agg(
        F.count_if(F.col("score") < low).alias("below"), F.sort_array(F.collect_list(between)).alias("near")
    ).first()
    place = share * (n - 1) - found["below"]
    first = math.floor(place)
    values = found["near"][first : first + 2]
    return values[0] + (place - first) * (values[-1] - values[0])


def train(docs: DataFrame, params: SecretParams) -> SecretModel:
    """Models and threshold from labelled strings.

    The strings are not stored: one pass over them counts the steps of those that fit
    the models, another scores the random strings kept apart. An empty table gives equal
    models. A table with rows whose sample is empty is an error.
    """
    strings = training_strings(docs, params)
    steps = staged(_counted_steps(strings.filter("fit")), "steps")
    if steps.isEmpty() and not docs.isEmpty():
        raise ValueError(f"no training sample for the character models: train_rows={params.train_rows}")
    model = SecretModel(
        _constant(_class_ratios(steps).first()["classes"]),
        _constant(_character_ratios(steps, params).first()["characters"]),
        0.5 if params.threshold is None else params.threshold,
    )
    unstage(steps)
    if params.threshold is None:
        random = staged(held_out(strings, model, params).filter("random = 1").select("score"), "scores")
        found = _quantile(random, 1 - params.recall)
        model = replace(model, threshold=0.5 if found is None else found)
        unstage(random)
    return model


def precision_and_recall(docs: DataFrame, params: SecretParams | None = None) -> tuple[float, float]:
    """Of the model on labelled strings kept apart, random strings at the least length."""
    params = params or SecretParams()
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    model = train(plain, params)
    flagged = F.col("score") > model.threshold
    found = held_out(training_strings(plain, params), model, params).agg(
        F.count_if(flagged & (F.col("random") == 1)).alias("right"), F.count_if(flagged).alias("all"),
        F.count_if(F.col("random") == 1).alias("random"),
    ).first()
    return found["right"] / max(1, found["all"]), found["right"] / max(1, found["random"])


def _apart(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span, by one sorted pass over both.

    Base spans are placed by their start, runs by their end and before base spans that
    start there; a run is apart if no base span placed before it ends after its start.
    """

    def events(spans: Column, all_runs: Column) -> Column:
        return F.array_sort(F.concat(
            F.transform(spans, lambda b: F.struct(
                b["start"].alias("at"), F.lit(1).alias("is_base"), b["end"].alias("end"), F.lit(-1).alias("run"))),
            F.transform(all_runs, lambda r, i: F.struct(
                r["end"].alias("at"), F.lit(0).alias("is_base"), F.lit(-1).alias("end"), i.alias("run"))),
        ))

    def clear(placed: Column, all_runs: Column) -> Column:
        reach = _running(F.transform(placed, lambda e: e["end"]), -1, lambda a, x: F.greatest(a, x))
        met = F.zip_with(placed, reach, lambda e, m: F.struct(e["run"].alias("run"), m.alias("reach")))
        kept = F.filter(met, lambda e: (e["run"] >= 0) & (e["reach"] <= F.get(all_runs, e["run"])["start"]))
        return F.transform(kept, lambda e: F.get(all_runs, e["run"]))

    found = _bound(runs, lambda r: _bound(events(base, r), lambda placed: clear(placed, r)))
    return F.when((F.size(base) == 0) | (F.size(runs) == 0), runs).otherwise(found)


def _scored(docs: DataFrame, model: SecretModel, params: SecretParams) -> DataFrame:
    """Adds column `markov`: runs outside the base spans that look random."""
    df = _spans(docs, "markov", _run_pattern(params.min_run))
    wanted = lambda s: s["hit"].rlike("[A-Za-z]") & s["hit"].rlike("[^0-9=/_-]") & ~s["hit"].rlike(UUID)
    df = df.withColumn("markov", F.filter("markov", wanted)).withColumn("_base", F.concat("assign", "access", "hex"))
    df = df.withColumn("markov", _apart(F.col("_base"), F.col("markov")))
    with_states = F.transform("markov", lambda s: F.struct(s.alias("span"), _states(s["hit"]).alias("states")))
    random = F.filter(with_states, lambda s: model.score(s["states"]) > model.threshold)
    return df.withColumn("markov", F.transform(random, lambda s: s["span"])).drop("_base")


def scan(docs: DataFrame, params: SecretParams | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document's spans: columns assign, access, hex, markov, text and `keep`.

    A null text counts as empty. Repeated rows keep a row each, null ids stay
    null, and columns not named in `keep` are not read.
    """
    params = params or SecretParams()
    kept = [F.col(c) for c in keep if c not in ("doc_id", "text")]
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"), *kept)
    model = train(plain.select("doc_id", "text"), params)
    return _scored(_base_spans(plain, params), model, params)


def _listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed."""

    def numbered(number: int, kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.struct(s["start"].alias("a"), F.lit(number).alias("k"), s["end"].alias("b"))
        )

    parts = [numbered(KINDS.index(kind), kind) for kind in kinds]
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(F.concat(*parts)),
            lambda s: F.concat_ws(":", F.get(names, s["k"]), s["a"].cast("string"), s["b"].cast("string")),
        ),
        ",",
    )


def find_secrets(docs: DataFrame, params: SecretParams | None = None) -> DataFrame:
    """Counts and spans of secrets per document, over whole texts.

    A null text counts as empty and has no spans. Repeated rows keep a row each, null
    ids stay null, texts have any length, other columns are not read, an empty table
    gives no rows.
    """
    return scan(docs, params).select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
        F.size("markov").cast("bigint").alias("n_markov"),
    )


def redact(docs: DataFrame, params: SecretParams | None = None, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span replaced; overlapping spans become one mark.

    Texts without a span stay as they are, null texts included.
    """
    found = scan(docs.withColumn("_text", F.col("text")), params, (*docs.columns, "_text"))
    spans = F.array_sort(
        F.concat(*[F.transform(k, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))) for k in KINDS])
    )
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts"))
    walked = F.aggregate(
        F.col("_all"), start,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["b"]).alias("end"),
            F.when(
                s["a"] >= acc["end"],
                F.concat(acc["parts"], F.array(
                    F.substring("text", acc["end"] + 1, s["a"] - acc["end"]), F.lit(mark))),
            ).otherwise(acc["parts"]).alias("parts"),
        ),
    )
    clean = found.withColumn("_all", spans).withColumn("_walk", walked)
    rest = F.substring("text", F.col("_walk.end") + 1, F.length("text"))
    redacted = F.when(
        F.size("_all") > 0, F.concat(F.array_join("_walk.parts", ""), rest)
    ).otherwise(F.col("_text"))
    return clean.withColumn("text", redacted).select(*docs.columns)
