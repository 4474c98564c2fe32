"""Queries of the operators that work on bytes: secrets, language, toxicity, tokens."""

import public_tokenizers
from pyspark.sql import functions as F

from patio.llm.common import table
from patio.llm.language import predict_language, train_language
from patio.llm.secrets import BASE_RULES, find_secrets
from patio.llm.sentences import PieceModel, decode_ids, encode_texts
from patio.llm.token_counts import count_tokens
from patio.llm.toxicity import score_toxicity

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secret_scan(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    spans = F.col("secrets")
    kinds = [r.kind for r in BASE_RULES]

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in kinds]
    base = _joined(F.filter(spans, lambda s: s["kind"].isin(kinds)))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"),
                        _joined(spans).alias("spans"))


def op1_sentencepiece(spark, sf_dir, model=MODEL):
    """Ids of every whole text, and whether decoding them gives the text back."""
    pieces = PieceModel.read(model)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = decode_ids(encode_texts(docs, pieces), pieces)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                          (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def _fold(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = _fold(3) == 1
    model = train_language(docs.filter(~held))
    scored = predict_language(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = _fold(5) == 0
    labels = table(spark, sf_dir, "labels").filter(~held).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    scored = score_toxicity(docs, docs.join(labels, "doc_id"), keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op13_token_counts(spark, sf_dir, tokenizer=TOKENIZER):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer, keep=["doc_id"])


QUERIES = {"op1_sentencepiece": op1_sentencepiece,
           "op3_language_id": op3_language_id, "op7_toxicity": op7_toxicity, "op8_secret_scan": op8_secret_scan,
           "op13_token_counts": op13_token_counts}
ORACLES = {}
