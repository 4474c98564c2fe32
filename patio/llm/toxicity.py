"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text, computed on byte arrays: densities of a fixed lexicon and of a lexicon
learned from the labels, lexicon words near a second-person word, words that only match with symbols
read as letters or letters apart (obfuscation), shares of capitals, exclamation and question marks,
symbols and stretched letters. Spark's trees learn from the labelled rows (``trees`` of depth
``depth``), and an isotonic fit on labelled rows kept apart turns their score into a probability.

``sample`` bounds the labelled rows that are learned from, chosen by a hash of the id; a leaf needs
``least`` of them, so that a few wrong labels don't make a rule.

Results for odd rows: null and empty texts have all features 0 and get the score that the model gives
to those; without labels of both kinds every score is 0; repeated rows get repeated scores;
an empty table gives an empty result; very long texts count whole; columns named ``score`` or
``predicted`` are replaced, all others stay.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.batches import add_columns
from patio.llm.common import private, words_of
from patio.llm.hashing import LOWER, span_hashes, text_hash, word_spans
from patio.session import durable

#: Insults of four languages, lower case.
LEXICON = [
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "fool", "loser", "losers", "trash", "garbage",
    "scum", "clown", "pathetic", "worthless", "disgusting", "jerk", "ugly", "hate", "shut", "kill",
    "imbecile", "filth", "vermin", "freak", "creep", "coward", "liar", "crap", "damn", "dumm", "dummkopf",
    "trottel", "abschaum", "versager", "arschloch", "stupide", "crétin", "imbécile", "ordure", "connard",
    "minable", "estúpido", "imbécil", "basura", "asqueroso", "inútil", "tonto",
]
#: Second-person words of four languages.
SECOND = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr",
          "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes"]
NEAR = 5

FEATURES = ["log_words", "lexicon", "lexicon_any", "learned", "learned_any", "near_second", "second",
            "hidden", "hidden_any", "capitals", "capital_words", "bangs", "questions", "symbols", "stretched"]

#: Signs that stand for letters in obfuscated words.
LEET = LOWER.copy()
for _sign, _letter in zip("013457@$!", "oieastasi"):
    LEET[ord(_sign)] = ord(_letter)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&@^~|<>"]] = True


def _letter_hashes(values, starts, ends):
    """Hashes of the spans' letters, other bytes left out."""
    kept = _LETTER[values]
    before = np.concatenate([[0], np.cumsum(kept)])
    return span_hashes(values[kept], before[starts], before[ends])


def _per_text(flags, bounds):
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)


def text_features(body, offsets, lexicon, learned, second) -> np.ndarray:
    """(texts, FEATURES); the word lists are sorted hashes."""
    starts, ends, bounds = word_spans(body, offsets)
    lower = LOWER[body]
    plain = _letter_hashes(lower, starts, ends)
    read = _letter_hashes(LEET[body], starts, ends)

    def among(hashes, words):
        if not len(words):
            return np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        return words[at] == hashes

    letters = np.concatenate([[0], np.cumsum(_LETTER[lower])])
    whole = (letters[ends] - letters[starts]) == (ends - starts)
    in_lexicon, in_learned, you = among(plain, lexicon), among(plain, learned), among(plain, second)
    # letters apart or signs read as letters: matches that the plain word wouldn't give
    inside = np.concatenate([[0], np.cumsum(~_LETTER[lower[:-1]] & _LETTER[lower[1:]])]) if len(body) else np.zeros(1, int)
    broken = inside[np.maximum(ends - 1, 0)] - inside[np.minimum(starts, max(len(body) - 1, 0))] > 0
    hidden = (among(read, lexicon) & ~in_lexicon) | (in_lexicon & ~whole & broken)
    # lexicon words with a second-person word at most NEAR words away in the same text
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    yous = np.flatnonzero(you)
    near = np.zeros(len(starts), bool)
    hits = np.flatnonzero(in_lexicon | hidden)
    if len(yous) and len(hits):
        right = np.searchsorted(yous, hits)
        for side in (np.minimum(right, len(yous) - 1), np.maximum(right - 1, 0)):
            other = yous[side]
            near[hits] |= (np.abs(other - hits) <= NEAR) & (text_of[other] == text_of[hits])
    upper = (body >= 65) & (body <= 90)
    uppers = np.concatenate([[0], np.cumsum(upper)])
    shouted = (uppers[ends] - uppers[starts] == ends - starts) & (ends - starts > 1)
    triple = np.zeros(len(body), bool)
    if len(body) > 2:
        triple[2:] = (lower[2:] == lower[1:-1]) & (lower[1:-1] == lower[:-2]) & _LETTER[lower[2:]]
    words = np.diff(bounds).astype(float)
    size, alphabetic = np.maximum(np.diff(offsets), 1), np.maximum(_per_text(_LETTER[lower], offsets), 1)
    per_word = np.maximum(words, 1)
    n_lexicon, n_learned, n_hidden = (_per_text(x, bounds) for x in (in_lexicon, in_learned, hidden))
    columns = [
        np.log1p(words), n_lexicon / per_word, np.minimum(n_lexicon, 5), n_learned / per_word,
        np.minimum(n_learned, 5), _per_text(near, bounds) / per_word, _per_text(you, bounds) / per_word,
        n_hidden / per_word, np.minimum(n_hidden, 5), _per_text(upper, offsets) / alphabetic,
        _per_text(shouted, bounds) / per_word, _per_text(body == 33, offsets) / per_word,
        _per_text(body == 63, offsets) / per_word, _per_text(_SYMBOL[body], offsets) / size,
        _per_text(triple, offsets) / size,
    ]
    return np.column_stack(columns)


def learn_lexicon(labelled: DataFrame, text: str = "text", label: str = "toxic", min_texts: int = 5, min_share: float = 0.02,
                  min_ratio: float = 20.0) -> list[str]:
    """Words in ``min_share`` of the toxic texts whose share there is ``min_ratio`` times their share of the
    others: 1 / ``min_share`` times the words of a toxic text at most.

    Exact copies count once, so a text that is repeated doesn't put its own words into the list.
    """
    words = F.array_distinct(F.transform(words_of(F.lower(F.col(text))), lambda w: F.regexp_replace(
        w, r"[^\p{L}]", "")))
    distinct = labelled.groupBy(F.xxhash64(text).alias("_h"), F.length(text).alias("_n")).agg(
        F.max(F.col(label)).alias("y"), F.first(words, ignorenulls=True).alias("w"))
    totals = labelled.agg(F.count(F.when(F.col(label) == 1, 1)), F.count(F.lit(1))).first()
    toxic, other = totals[0], totals[1] - totals[0]
    if not toxic or not other:
        return []
    counted = distinct.select("y", F.explode("w").alias("w")).filter("w != ''").groupBy("w").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).filter(
        F.col("a") >= max(min_texts, min_share * toxic))
    ratio = (F.col("a") / toxic) / ((F.col("b") + 0.5) / other)
    return [r.w for r in counted.filter(ratio >= min_ratio).orderBy("w").collect()]


def toxicity_features(df: DataFrame, text: str = "text", learned=(), keep=None, into: str = "features") -> DataFrame:
    lists = [np.array(sorted({text_hash(w) for w in words}), np.uint64) for words in (LEXICON, learned, SECOND)]

    def work(body, offsets):
        values = text_features(body, offsets, *lists)
        flat = pa.array(values.reshape(-1))
        return [pa.ListArray.from_arrays(
            pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)), flat)]

    return add_columns(df, text, T.StructType([T.StructField(into, T.ArrayType(T.DoubleType()))]), work, keep)


def score_toxicity(docs: DataFrame, labelled: DataFrame, text: str = "text", ident: str = "doc_id",
                   label: str = "toxic", keep: list[str] | None = None, trees: int = 20, depth: int = 3,
                   sample: int = 40_000, least: int = 25,
                   seed: int = 3) -> DataFrame:
    """The kept columns with ``score`` and ``predicted``; ``labelled`` holds (ident, text, label) rows
    to learn from."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    known = labelled.filter(F.col(label).isNotNull()).select(
        F.col(ident).alias("_id"), F.col(text).alias("_text"), F.col(label).cast("int").alias("_y"))
    n = known.count()
    ticket = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(seed)), F.lit(1_000_000))
    known = durable(known.filter(ticket < 1e6 * min(1.0, sample / max(n, 1))))
    learned = learn_lexicon(known.filter(ticket % 4 != 0), "_text", "_y")
    features, x, p, prob, margin, tree, step = (
        private(docs, c) for c in ("_features", "_x", "_p", "_prob", "_raw", "_s", "_c"))
    rows = durable(toxicity_features(known, "_text", learned, ["_id", "_y"], features).select(
        "_y", features, (F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(seed)), F.lit(4)) == 0).alias("aside")))
    kinds = {tuple(r) for r in rows.groupBy("aside", "_y").count().select("aside", "_y").collect()}
    wide = toxicity_features(docs, text, learned, keep, features)
    if not {(False, 0), (False, 1)} <= kinds:
        return wide.drop(features).withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})

    def vectors(df):
        return df.withColumn(x, array_to_vector(features))

    forest = GBTClassifier(featuresCol=x, labelCol="_y", predictionCol=p, maxIter=trees,
                           maxDepth=depth, stepSize=0.2, seed=seed, minInstancesPerNode=least)
    forest = forest.setProbabilityCol(prob).setRawPredictionCol(margin)
    aside = {(True, 0), (True, 1)} <= kinds
    model = forest.fit(vectors(rows.filter(~F.col("aside")) if aside else rows))

    def raw(df):
        return model.transform(vectors(df)).withColumn(tree, F.get(vector_to_array(prob), F.lit(1)))

    curve = IsotonicRegression(featuresCol=tree, labelCol="_y", predictionCol=step).fit(
        raw(rows.filter("aside") if aside else rows).select(tree, F.col("_y").cast("double")))
    # the tree score breaks ties inside a flat step of the curve
    done = curve.transform(raw(wide)).withColumn(
        "score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.999 * F.col(step) + 0.001 * F.col(tree))))
    return done.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select(*keep, "score", "predicted")
