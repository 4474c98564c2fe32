"""The pipeline over a small table, stage by stage against plain Python."""

import random
import re
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from patio.llm.plans.learned import MODEL
from patio.session import durable

WORDS = re.compile("[^\x20\x09-\x0d]+")
STOPS = "the of and to in is that it was for on with as".split()


def prose(seed, n=90):
    rng = random.Random(seed)
    words = [rng.choice(STOPS) if i % 3 == 0 else "".join(rng.choices("aeioulnrst", k=rng.randint(3, 8))) for i in range(n)]
    return " ".join(words) + "."


FOOTER = "All rights are kept by the owners of the site"
LONG = prose(77, 20_000)


def rows():
    """Clean pages with a footer, copies, junk, and odd rows."""
    out = [(i, prose(i) + "\n" + FOOTER, "abc"[i % 3]) for i in range(24)]
    out += [(100, out[0][1], "b"), (101, prose(1) + " one more word here\n" + FOOTER, "c"),  # copies of 0 and 1
            (102, "too short", "a"), (103, "### " * 80, "b"), (104, None, "a"), (105, "", None), (106, " \n ", "c"),
            (107, "same same same " * 40, "a"), (108, LONG, None), (109, LONG, "a"), (5, out[5][1], "c"),
            (6, prose(600), "a"), (None, prose(700), "b"), (None, None, None)]
    return out


def shingles(text):
    words = [w.lower() for w in WORDS.findall(text)]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after every stage but the last, and the result of the whole run."""
    folder = tmp_path_factory.mktemp("pipeline")
    table = [(i, t, "en", s, len(t or "")) for i, t, s in rows()]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, str(folder)))
        steps[name] = docs
    return {k: v.collect() for k, v in steps.items()} | {"run": corpus_pipeline.run(spark, str(folder)).collect()}


def test_columns_stay(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert set(stages[name][0].__fields__) == set(stages["documents"][0].__fields__)


def test_quality(stages):
    gone = Counter((r.doc_id, r.text) for r in stages["documents"]) - Counter((r.doc_id, r.text) for r in stages["quality_rules"])
    bad = {102, 103, 104, 105, 106, 107}
    assert gone == Counter((r.doc_id, r.text) for r in stages["documents"] if r.doc_id in bad or r.text is None)


def test_lines(stages):
    """The footer is on more than 1 % of the pages of a, b and c, three at least, and on nothing else."""
    want = Counter((r.doc_id, r.text.removesuffix("\n" + FOOTER), r.source) for r in stages["quality_rules"])
    assert Counter((r.doc_id, r.text, r.source) for r in stages["line_dedup"]) == want
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"])


def test_copies(stages):
    before, after = stages["line_dedup"], stages["ngram_jaccard"]
    sets = [shingles(r.text) for r in before]
    group = list(range(len(before)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 75 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for g, r in zip(group, before):
        key = (r.doc_id is None, r.doc_id or 0)
        best[g] = min(best.get(g, (key, r.text)), (key, r.text), key=lambda x: x[0])
    assert Counter((r.doc_id, r.text) for r in after) == Counter(
        (None if none else i, t) for (none, i), t in best.values())
    assert {0, 1, 5, 6, 108} <= {r.doc_id for r in after} and not {100, 101, 109} & {r.doc_id for r in after}


def test_mix(stages):
    before, after = stages["ngram_jaccard"], stages["mix_sources"]
    count = lambda rs: sum((Counter({r.source: len(WORDS.findall(r.text))}) for r in rs), Counter())
    sizes, taken = count(before), count(after)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = dict(zip(order, [5, 2, 1] * len(order)))
    target, open_, rest = {}, list(order), sum(sizes.values())
    while open_:
        share = {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not full:
            target |= share
            break
        target |= {s: 3 * sizes[s] for s in full}
        rest -= sum(3 * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    assert all(abs(taken[s] - target[s]) <= 256 for s in order)
    texts = {(r.doc_id, r.source): [] for r in before}
    for r in before:
        texts[r.doc_id, r.source].append(r.text)
    words = {k: Counter(w for t in v for w in WORDS.findall(t)) for k, v in texts.items()}
    for r in after:
        own = Counter(WORDS.findall(r.text))  # a cut text is one or more ranges of words
        assert own and any(own <= Counter(WORDS.findall(t)) for t in texts[r.doc_id, r.source])
        assert r.n_chars == len(r.text)
    for key in words:
        used = Counter(w for r in after if (r.doc_id, r.source) == key for w in WORDS.findall(r.text))
        assert all(n <= 3 * words[key][w] for w, n in used.items())


def test_ids(stages):
    tool = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = Counter((r.doc_id, r.source, tuple(tool.encode(r.text))) for r in stages["mix_sources"])
    assert Counter((r.doc_id, r.source, tuple(r.ids)) for r in stages["run"]) == want
    assert all(r.n_tokens == len(r.ids) for r in stages["run"])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
