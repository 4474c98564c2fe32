"""Secrets, tokens, languages and toxicity."""

import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from patio.llm.automaton import compile_rules
from patio.llm.hashing import text_hash
from patio.llm.language import UNKNOWN, ByteNetwork, predict_language, train_language
from patio.llm.plans.learned import MODEL, op3_language_id, op7_toxicity
from patio.llm.secrets import BASE_RULES, RULES, Scanner, find_secrets
from patio.llm.sentences import BPE, UNIGRAM, Encoder, PieceModel, decode_ids, encode_texts
from patio.llm.toxicity import FEATURES, LEXICON, score_toxicity, text_features


def flat(texts):
    data = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(data), np.uint8),
            np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))


# secrets

_NAMES = "password|passwd|secret|token|api_?key"
_ANY = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", _NAMES)
BRUTE = [
    ("assign", re.compile(rf"""({_ANY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def brute_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BRUTE) for m in p.finditer(text) if ok(m)]
    return [(BRUTE[k][0], a, b) for a, k, b in sorted(found)]


ALPHABET = ["token", "Secret", "PASSWD", "api_key", "ApiKey", "=", ":", " ", "  ", "'", '"', "abc", "deadbeef" * 2,
            "0123456789abcdef0", "AKIA", "AKIAABCDEFGHIJ0123", "AKIAABCDEFGHIJ012", "é", "\n", ",", "x+/_.=-yzAB09q",
            ".", "-", "to", "ken", "zz "]


def test_spans_match_regular_expressions(docs):
    random.seed(1)
    texts = ["".join(random.choices(ALPHABET, k=random.randint(0, 40))) for _ in range(400)]
    kinds = {r.kind for r in BASE_RULES}
    got = find_secrets(docs([(i, t, "a") for i, t in enumerate(texts)]), keep=["doc_id"]).collect()
    for r in got:
        assert [(s.kind, s.start, s.end) for s in r.secrets if s.kind in kinds] == brute_spans(texts[r.doc_id])


PARTS = ["-----BEGIN ", "RSA ", "PRIVATE KEY-----", "ghp_", "gho_", "a" * 36, "B" * 20, "xoxb-", "1-2", "AIza", "z_" * 18,
         "eyJ", "eyJhbGciOiJI.", ".", "abcdefgh", "https", "://", "user", ":", "pa$$", "@", "host", " ", "\n", "-----", "_"]


def test_all_kinds_match_regular_expressions(docs):
    """The loose form of each rule finds, the strict form must fit the whole of what it found."""
    random.seed(4)
    texts = ["".join(random.choices(PARTS + ALPHABET, k=random.randint(0, 30))) for _ in range(400)]
    texts += ["-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9, "x ssh://u.x:p@h",
              "ghs_" + "a" * 36, "xoxb-" + "1" * 10, "AIza" + "q" * 35]
    forms = [(r.kind, re.compile(r.loose or r.strict), re.compile(r.strict)) for r in RULES]
    seen = set()
    for r in find_secrets(docs([(i, t, "a") for i, t in enumerate(texts)]), keep=["doc_id"]).collect():
        want = sorted((m.start(), k, m.end()) for k, (_, loose, strict) in enumerate(forms)
                      for m in loose.finditer(texts[r.doc_id]) if strict.fullmatch(m[0]))
        assert [(s.kind, s.start, s.end) for s in r.secrets] == [(RULES[k].kind, a, b) for a, k, b in want]
        seen |= {s.kind for s in r.secrets}
    assert seen == {r.kind for r in RULES}


def test_long_runs_are_linear(docs):
    n = 200_000
    texts = ["g" * n + ".x://u:p@h", "eyJ" * (n // 3) + ".", "eyJ" * (n // 3) + "." + "a" * 9 + "." + "b" * 9,
             "g" * n + "://u:p@h", "-----BEGIN " * (n // 11) + "PRIVATE KEY-----", "ghp_" * (n // 4)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets]
           for r in find_secrets(docs([(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert got[0] == [("url_login", n + 1, n + 9)] and got[1] == [] and len(got[2]) == 1
    assert got[3] == [("url_login", 0, n + 7)]


def test_long_text_without_a_break(docs):
    text = "a" * 50_000 + "Z" * 50_000 + "token=" + "Q" * 9_000
    row = find_secrets(docs([(1, text, "a")])).first()
    assert [(s.kind, s.start, s.end) for s in row.secrets] == brute_spans(text)


def test_further_kinds(docs):
    text = "x ghp_" + "a1" * 18 + " -----BEGIN RSA PRIVATE KEY----- https://me:pw@host"
    assert [s.kind for s in find_secrets(docs([(1, text, "a")])).first().secrets] == [
        "github", "hex", "private_key", "url_login"]


def test_secrets_of_odd_rows(odd, docs):
    clash = odd.withColumn("secrets", F.lit("x")).withColumn("_text", F.lit(1))
    assert all(r.secrets == [] for r in find_secrets(clash).collect())
    assert find_secrets(docs([])).count() == 0


def test_automaton_is_minimal_and_checks_rules():
    assert compile_rules(["ab|cb"], anywhere=False).table.shape[0] // compile_rules(["ab|cb"], False).n_classes == 4
    with pytest.raises(ValueError):
        compile_rules(["(a"], anywhere=False)
    assert len(Scanner().kinds) == 9


# tokens

@pytest.fixture(scope="module")
def pieces():
    return PieceModel.read(MODEL).build()


def test_ids_equal_the_library(spark, sf, pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    frame = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    for r in encode_texts(frame, pieces).collect():
        assert r.ids == library.encode(r.text)


def test_odd_texts_equal_the_library(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    random.seed(2)
    texts = ["", " ", "  a  b\t\n", "aaaa aaaaa", "日本語 ½😀", "x" * 5000] + [
        "".join(random.choices("aeinrst ▁é\n", k=random.randint(0, 60))) for _ in range(300)]
    ids, bounds = Encoder(pieces).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t) for t in texts]


def test_round_trip_of_odd_rows(odd, docs, pieces):
    out = decode_ids(encode_texts(odd.withColumn("ids", F.lit("clash")), pieces), pieces)
    assert all(r.decoded == (r.text or "") for r in out.collect())
    assert decode_ids(encode_texts(docs([]), pieces), pieces).count() == 0


def test_unigram_maximises_the_score():
    random.seed(3)
    parts = sorted({"".join(random.choices("abc", k=random.randint(1, 4))) for _ in range(40)} | set("abc") | {"▁", "▁a"})
    scores = {p: -random.randint(1, 40) / 4 for p in parts}
    model = PieceModel(["<unk>", *parts], np.array([0.0, *[scores[p] for p in parts]]),
                       np.array([2] + [1] * len(parts)), kind=UNIGRAM, squeeze=False).build()

    def best(word):
        value = [0.0] + [-np.inf] * len(word)
        for i in range(1, len(word) + 1):
            value[i] = max(value[j] + scores[word[j:i]] for j in range(i) if word[j:i] in scores)
        return value[-1]

    texts = ["".join(random.choices("abc ", k=random.randint(1, 12))) for _ in range(200)]
    ids, bounds = Encoder(model).encode(texts)
    for t, a, b in zip(texts, bounds, bounds[1:]):
        got = [model.pieces[i] for i in ids[a:b]]
        assert "".join(got) == model.normalise(t)
        assert sum(scores[p] for p in got) == pytest.approx(best(model.normalise(t)))
    assert model.kind != BPE


# languages

def test_languages_on_held_out_texts(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    truth = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang")
    rows = op3_language_id(spark, big).filter("held_out").join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd, docs):
    labelled = docs([(i, "der die das und nicht" if i % 2 else "the cat and the dog", "s") for i in range(40)])
    labelled = labelled.withColumn("lang", F.expr("if(doc_id % 2 = 1, 'de', 'en')"))
    model = train_language(labelled, epochs=3)
    rows = predict_language(odd.withColumn("_letters", F.lit(1)), model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.lang_pred == UNKNOWN) == (not any(c.isalpha() for c in r.text or ""))
    assert train_language(docs([])) is None
    assert {r.lang_pred for r in predict_language(odd, None).collect()} == {UNKNOWN}


def test_tables_give_the_network(pieces):
    model = ByteNetwork(["a", "b"])
    windows = np.random.default_rng(0).integers(0, 256, (3, 259)).astype(np.uint8)
    p, slow = model.params, []
    for w in (2, 3, 4):
        total = sum(p["embed"][windows[:, k:k + 256]] @ p[f"w{w}"][k] for k in range(w)) + p[f"b{w}"]
        slow.append(total.max(axis=1))
    assert np.allclose(model._pool(windows), np.concatenate(slow, axis=1), atol=1e-4)


# toxicity

def test_features():
    lists = [np.array(sorted(map(text_hash, words)), np.uint64) for words in (LEXICON, ["zork"], ["you"])]
    texts = ["you idiot! ok", "1d10t here", "i.d.i.o.t", "IDIOT### zork", "", "nooo way", "idiot a b c d e f g you"]
    rows = [dict(zip(FEATURES, r)) for r in text_features(*flat(texts), *lists)]
    assert rows[0]["lexicon_any"] == 1 and rows[0]["near_second"] == pytest.approx(1 / 3) and rows[0]["bangs"] > 0
    assert rows[1]["hidden_any"] == 1 and rows[1]["lexicon_any"] == 0
    assert rows[2]["hidden_any"] == 1
    assert rows[3]["lexicon_any"] == 1 and rows[3]["learned_any"] == 1 and rows[3]["capitals"] > 0
    assert set(rows[4].values()) == {0}
    assert rows[5]["stretched"] > 0
    assert rows[6]["near_second"] == 0


def test_toxicity_on_held_out_rows(spark, sf):
    big = sf.replace("sf0.001", "sf0.1")
    truth = spark.read.parquet(f"{big}/labels.parquet")
    rows = op7_toxicity(spark, big).filter("held_out").join(truth, "doc_id").collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.9
    assert np.mean([c >= 0.5 for c in clean]) < 0.01
    assert np.mean([t >= 0.5 for t in toxic]) > 0.8


def test_toxicity_without_labels(odd):
    rows = score_toxicity(odd.withColumn("score", F.lit("x")), odd.withColumn("toxic", F.lit(0)), keep=["doc_id"]).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.0, 0)} and len(rows) == odd.count()


def test_toxicity_of_odd_rows(odd, docs):
    """Both kinds of labels, repeated rows, a very long text, clashing columns, an empty table."""
    names = ["_features", "features", "_f0", "_x", "_p", "_prob", "_raw", "_s", "_c", "predicted"]
    known = docs([(i, "you idiot" if i % 3 == 0 else "a calm day", "a") for i in range(300)]).withColumn(
        "toxic", (F.col("doc_id") % 3 == 0).cast("int"))
    frame = odd.withColumns({c: F.lit(c) for c in names})
    got = score_toxicity(frame, known)
    assert got.columns == [*frame.columns[:-1], "score", "predicted"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.features == "features" for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert len({r.score for r in rows if r.text and r.text.startswith("one")}) == 1
    judged = {r.text: r.predicted for r in score_toxicity(docs([(1, "you idiot", "a"), (2, "a calm day", "b")]), known).collect()}
    assert judged == {"you idiot": 1, "a calm day": 0}
    assert score_toxicity(docs([]), known).count() == 0
