"""Quality rules as one threshold table, compiled into one projection.

Each metric is a column expression over the text, each rule a metric with a lower and an upper
bound; a row is kept when every rule holds. Everything is a built-in column function, so the rules
run inside the scan stage, without a shuffle, whatever the size of the table.

Results for odd rows: null and empty texts have 0 words and fail; a document is judged by itself,
so repeated rows give repeated results; metrics with an empty denominator are 0.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.llm.common import chars_in, lines_with_words, private, spaced, words_of

SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "as", "by", "are",
    "be", "this", "from", "or", "at", "der", "die", "und", "den", "das", "von", "zu", "mit", "sich",
    "des", "auf", "ist", "im", "nicht", "ein", "eine", "le", "la", "les", "et", "un", "une", "dans",
    "que", "qui", "pour", "par", "sur", "au", "pas", "de", "el", "los", "las", "en", "y", "con",
    "por", "para", "se", "del", "una", "no",
]


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; an absent bound isn't checked."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Base rules of the contract: length and repetition.
BASE_RULES = [
    Rule("too_short", "n_words", low=50),
    Rule("repetitive", "repeat_percent", high=50),
]
#: The method's own rules, set wide so that ordinary prose passes, whatever its length.
METHOD_RULES = [
    Rule("word_length", "mean_word_length", low=2, high=15),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("shouting", "exclamations_per_word", high=0.5),
    Rule("few_stop_words", "stop_word_ratio", low=0.02),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
]


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _repeat_words(words: str, bits: str, ordered: str) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    ``ordered`` holds one number per window, sorted: hash bits above, the window's position in the
    low bits. Equal windows are neighbours there; neighbours with equal hash bits are compared word
    by word, and each confirmed window covers the words that the one before it did not.
    """
    w, o, n = F.col(words), F.col(ordered), f"`{bits}`"

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.expr(f"shiftleft(1L, {n}) - 1")).cast("int")

    def same(x: Column, y: Column) -> Column:
        equal = F.call_function("shiftright", x.bitwiseXOR(y), F.col(bits)) == 0
        for k in range(3):
            equal = equal & (F.get(w, place(x) + k) == F.get(w, place(y) + k))
        return F.coalesce(equal, F.lit(False))

    repeated = F.filter(o, lambda x, i: same(x, F.get(o, i - 1)) | same(x, F.get(o, i + 1)))
    starts = F.sort_array(F.transform(repeated, place))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at"))
    return F.aggregate(
        starts, zero,
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["at"])).alias("n"), p.alias("at")),
        lambda acc: acc["n"].cast("long"))


def quality_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The table with the metric columns; columns of the same names are replaced.

    The projections build on each other; each intermediate array is used more than once, so the
    optimiser keeps it as a column. Only texts in which some window hash occurs twice get the sorted
    form.
    """
    body, words, lines, hashes, bits, ordered = (
        private(docs, n) for n in ("_body", "_words", "_lines", "_hashes", "_bits", "_ordered"))
    w, text_col = F.col(words), F.col(body)
    split = docs.withColumn(body, F.coalesce(F.col(text), F.lit(""))).withColumns({
        words: words_of(text_col), lines: lines_with_words(text_col)})
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    hashed = split.withColumns({
        hashes: windows,
        bits: F.ceil(F.log2(F.size(w) + 1)).cast("int")})  # enough for any position
    packed = F.transform(F.col(hashes), lambda h, i: F.call_function(
        "shiftleft", F.call_function("shiftright", h, F.col(bits)), F.col(bits)).bitwiseOR(i.cast("long")))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    counted = hashed.withColumn(ordered, F.when(some, F.sort_array(packed)).otherwise(
        F.array().cast("array<long>")))
    n, n_lines = F.size(w).cast("long"), F.size(lines).cast("long")
    white = chars_in(spaced(text_col), " ")
    measured = counted.withColumns({
        # a filter on the verdict must not be pushed below, where each use of an array would compute it
        # anew; an expression that is not deterministic stops it here
        "n_words": n + F.monotonically_increasing_id() * 0,
        "word_chars": (F.length(text_col) - white).cast("long"),
        "n_symbols": chars_in(text_col, SYMBOLS).cast("long"),
        "n_dup_lines": n_lines - F.size(F.array_distinct(lines)).cast("long"),
        "n_repeat_words": _repeat_words(words, bits, ordered),
        "exclamations_per_word": _ratio(chars_in(text_col, "!"), n),
        "stop_word_ratio": _ratio(
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))), n),
        "dup_line_ratio": _ratio(n_lines - F.size(F.array_distinct(lines)), n_lines),
    })
    done = measured.withColumns({
        "mean_word_length": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
        "repeat_percent": _ratio(100 * F.col("n_repeat_words"), F.col("n_words")),
    })
    return done.drop(body, words, lines, hashes, bits, ordered)


def broken(rule: Rule) -> Column:
    value = F.col(rule.metric)
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (value < rule.low)
    if rule.high is not None:
        bad = bad | (value > rule.high)
    return bad


def judge_quality(docs: DataFrame, text: str = "text", base=BASE_RULES, rules=METHOD_RULES) -> DataFrame:
    """The table with metrics, ``base_failed``, ``failed`` (names of broken rules, comma-joined) and
    ``kept``."""
    measured = quality_metrics(docs, text)
    names = F.array(*[F.when(broken(r), F.lit(r.name)) for r in [*base, *rules]])
    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | broken(r)
    return measured.withColumns({
        "base_failed": base_failed, "failed": F.array_join(names, ","),
    }).withColumn("kept", F.col("failed") == "")


def filter_quality(docs: DataFrame, text: str = "text", base=BASE_RULES, rules=METHOD_RULES) -> DataFrame:
    """The rows that pass, with the table's own columns.

    The verdict is computed from the text alone, so it can't clash with columns of the table.
    """
    body, verdict = private(docs, "_body"), private(docs, "_kept")
    row = private(docs, "_row")
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                          F.col(text).alias(body))
    judged = judge_quality(wrapped, body, base, rules).select(row, F.col("kept").alias(verdict))
    return judged.filter(verdict).select(f"{row}.*")
