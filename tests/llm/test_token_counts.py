"""Token counts against the libraries on whole texts."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from patio.llm.plans.learned import TOKENIZER, op13_token_counts
from patio.llm.token_counts import PART_BYTES, count_parts, count_tokens, counter, safe_cuts

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
SPECIAL = "<|endoftext|>"


def by_library(name, text):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))


def read(name):
    with open(public_tokenizers.path(name), "rb") as f:
        return counter(name, f.read())


def flat(texts):
    data = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(data), np.uint8),
            np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))


TEXTS = ["", " ", "a", "  two  spaces  ", "it's  we'll\n\n x\t\ty  z　w", "日本語。テキスト", "é́ é ñ 😀 ok",
         f"a {SPECIAL} b{SPECIAL}{SPECIAL} <|endof text|>", "x" * 500, "1234 5678 .,;!? 99%", "a\x00b \x7f c",
         "▁ a ▁b", "\n\n\n  \n end \n"]


@pytest.mark.parametrize("name", FILES)
def test_parts_count_like_whole_texts(name):
    rng = np.random.default_rng(3)
    texts = TEXTS + ["".join(rng.choice(TEXTS, 30)) for _ in range(60)]
    want = [by_library(name, t) for t in texts]
    tool = read(name)
    assert tool.splits
    for part, batch in ((1, 1), (7, 40), (50, 3000), (1 << 16, 1 << 18)):
        assert count_parts(tool, *flat(texts), part, batch).tolist() == want


def test_cuts_are_bounded_where_boundaries_exist():
    body, _ = flat(["word " * 100_000])
    cuts = safe_cuts(body, False, PART_BYTES)
    assert max(np.diff(np.concatenate([[0], cuts, [len(body)]]))) <= PART_BYTES + 5
    assert len(safe_cuts(flat(["x" * 200_000])[0], False, PART_BYTES)) == 0


def test_unknown_patterns_and_spaced_tokens_stay_whole():
    import json
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        spec = json.load(f)
    spec["added_tokens"][0]["lstrip"] = True
    assert not counter("x.json", json.dumps(spec).encode()).splits
    spec["added_tokens"] = []
    spec["pre_tokenizer"] = {"type": "Whitespace"}
    assert not counter("x.json", json.dumps(spec).encode()).splits
    with pytest.raises(ValueError):
        counter("x.txt", b"")


@pytest.mark.parametrize("name", FILES)
def test_odd_rows(odd, name):
    rows = odd.collect()
    got = count_tokens(odd, public_tokenizers.path(name)).collect()
    assert len(got) == len(rows)
    key = lambda r: repr((r.doc_id, r.text, r.source))
    for r, g in zip(sorted(rows, key=key), sorted(got, key=key)):
        text = r.text or ""
        assert (g.n_bytes, g.n_tokens) == (len(text.encode()), by_library(name, text))
        assert g.over_limit == (g.n_tokens > 512)


def test_empty_and_clashing(docs):
    df = docs([(1, "a b c", "s")]).withColumnRenamed("source", "N_Tokens").withColumnRenamed("lang", "_text")
    row = count_tokens(df, TOKENIZER, limit=2).first().asDict()
    assert row == {"doc_id": 1, "text": "a b c", "_text": "en", "n_chars": 5, "n_bytes": 5, "n_tokens": 3,
                   "over_limit": True}
    assert count_tokens(docs([]), TOKENIZER).count() == 0


def test_query(spark, sf):
    got = op13_token_counts(spark, sf).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(texts)
    tool = Tokenizer.from_file(TOKENIZER)
    for r in got:
        assert r.n_tokens == len(tool.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 512)
