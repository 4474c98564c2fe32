"""Near-duplicate texts and vectors against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from patio.llm import texts as texts_module
from patio.llm.components import components
from patio.llm.shingles import dense_sketch, fold, set_keys, shingle_sets, signatures
from patio.llm.texts import drop_near_copies, near_texts
from patio.llm.vectors import near_vectors, plan_tables


class Classes:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def alike(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    classes = Classes(sets)
    for a in sets:
        for b in sets:
            if a < b and alike(sets[a], sets[b]):
                classes.join(a, b)
    return {i: (len(s), classes.find(i)) for i, s in sets.items()}


def corpus(seed, passage=True):
    """Copies of growing distance, a passage that many texts share, and chains of edits."""
    random.seed(seed)
    word = lambda: f"w{random.randint(0, 4000)}"
    shared = [word() for _ in range(60)]
    rows = []
    for _ in range(40):
        base = [word() for _ in range(random.choice([1, 4, 5, 6, 9, 30, 80, 200]))]
        if passage and random.random() < 0.5:
            base = base[:5] + shared + base[5:]
        for _ in range(random.choice([1, 1, 2, 6])):
            rows.append(list(base))
            for _ in range(random.randint(0, 1 + len(base) // 25)):
                base = list(base)
                base[random.randrange(len(base))] = word()
    random.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_components_of_texts(docs, monkeypatch):
    monkeypatch.setattr(texts_module, "CHUNK", 8)
    for seed in (1, 2):
        rows = corpus(seed)
        got = near_texts(docs([(i, t, "a") for i, t in rows]), keep=["doc_id"]).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_every_link_shares_a_signature():
    linked = 0
    for seed in range(30):
        texts = [t for _, t in corpus(seed, passage=seed % 2 == 0)]
        data = [t.encode() for t in texts]
        flat, bounds = shingle_sets(np.frombuffer(b"".join(data), np.uint8),
                                    np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))
        sets = [shingles(t) for t in texts]
        keys = list(zip(*set_keys(flat, bounds)))
        hot = (lambda s: (s % np.uint64(3) == 0).astype(np.int64)) if seed % 3 else lambda s: np.zeros(len(s), np.int64)
        signs = [set() for _ in texts]
        for i, s in zip(*signatures(flat, bounds, hot)):
            signs[i].add(int(s))
        sketches = [np.frombuffer(dense_sketch(flat[a:b]), np.uint64) for a, b in zip(bounds, bounds[1:])]
        for i in range(len(texts)):
            for j in range(i):
                assert (keys[i] == keys[j]) == (sets[i] == sets[j])
                size = min(len(sketches[i]), len(sketches[j]))
                far = int(np.bitwise_count(fold(sketches[i], size) ^ fold(sketches[j], size)).sum())
                assert far <= len(sets[i] ^ sets[j])
                if alike(sets[i], sets[j]):
                    linked += 1
                    assert signs[i] & signs[j]
    assert linked > 500


def test_texts_of_odd_rows(odd, docs):
    rows = near_texts(odd.withColumns({"a": F.lit(1), "n": F.lit(2), "row": F.lit(3)})).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].component_id == 1 and by[6].component_id == by[5].component_id == 5
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0 and by[4].component_id == 4
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id is None} == {(2, 1), (0, None)}
    assert near_texts(docs([])).count() == 0


def test_one_of_each_group_stays(odd):
    left = drop_near_copies(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 8] and ids.count(None) == 1


def test_texts_that_share_an_id(docs):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    left = drop_near_copies(docs([(1, one, "s"), (1, two, "s"), (2, two, "s"), (None, two, "s"), (None, one + " x", "s"),
                                  (3, two.upper(), "s"), (None, "of its own it is", "s"), (2, None, "s")]))
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted([
        (1, one), (1, two), (0, "of its own it is"), (2, "")])
    rows = near_texts(docs([(4, one, "s"), (4, two, "s"), (3, two, "s"), (None, one, "s")])).collect()
    assert sorted((r.doc_id or 0, r.text[0], r.component_id) for r in rows) == [
        (0, "a", 4), (3, "b", 3), (4, "a", 4), (4, "b", 3)]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def brute_vectors(rows, cosine=0.93):
    good = [(i, np.array(v, float), l) for i, v, l in rows if v and l is not None and None not in v
            and np.isfinite(v).all() and any(v)]
    classes, links = Classes([i for i, _, _ in rows]), {i: 0 for i, _, _ in rows}
    for a, x, l in good:
        for b, y, k in good:
            if a < b and l == k and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                classes.join(a, b)
                links[a] += 1
                links[b] += 1
    return {i: (links[i], classes.find(i), classes.find(i) == i) for i in links}


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_vectors_match_brute_force(spark, monkeypatch):
    from patio.llm import vectors
    monkeypatch.setattr(vectors, "BLOCK", 16)  # large buckets are cut
    rng = np.random.default_rng(5)
    rows = []
    for c in range(30):
        centre = rng.normal(size=24)
        for _ in range(rng.choice([1, 2, 5, 25])):
            rows.append((len(rows), (centre + rng.normal(scale=0.08, size=24)).astype(np.float32).tolist(), int(c % 2)))
    rows += [(900 + i, rows[3][1], rows[3][2]) for i in range(4)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), miss=1e-6).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_vectors(rows)


def test_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2),
            (12, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows + [(None, [1.0, 0.0], 1)], SCHEMA).withColumn("node", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(frame).collect()}
    assert got.pop(None) == (0, None, False)
    assert got == brute_vectors(rows)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_vectors_with_clashing_columns(spark):
    names = ["_ra", "_rb", "_links", "_component", "_good", "_a", "_b", "_node", "node", "copies", "n_links"]
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in names})
    got = near_vectors(frame)
    assert got.columns == [*frame.columns[:-1], "n_links", "component_id", "kept"]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept, r._links) for r in got.collect()} == {
        k: (*v, "_links") for k, v in brute_vectors(rows).items()}


def test_recall_at_the_default(spark):
    """Pairs planted just above the threshold, with the tables that the default plans."""
    rng = np.random.default_rng(2)
    a = rng.normal(size=(6000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9305, 0.95, size=(6000, 1))
    b = cosine * a + np.sqrt(1 - cosine ** 2) * side
    both = np.concatenate([a, b]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(both)], SCHEMA)
    got = {r.vec_id: r.n_links for r in near_vectors(frame, keep=["vec_id"]).collect()}
    links = sum(got.values())
    units = both.astype(float) / np.linalg.norm(both.astype(float), axis=1, keepdims=True)
    want = sum(int((units[i:i + 1000] @ units.T >= 0.93).sum()) for i in range(0, len(units), 1000)) - len(units)
    print(f"recall {links / want:.4f} of {want // 2} links")
    assert 0.98 * want <= links <= want


def test_planned_miss():
    import math
    for rows in (0, 10, 10**5, 10**9):
        bits, tables = plan_tables(rows)
        agree = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - agree) ** tables <= 0.01
