"""The mix against plain Sainte-Lague, and its promises."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from patio.llm.mixing import apportion, mix_documents, plan_mix, sized_rows, source_targets, with_tickets


def brute_seats(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def test_apportion_matches_highest_quotients(spark):
    random.seed(4)
    rows, want = [], {}
    for g in range(25):
        votes = [random.choice([1, 5, 50, 1000]) * random.randint(1, 9) for _ in range(random.randint(1, 9))]
        seats = random.choice([0, 1, 3, 17, 400])
        for k, (v, s) in enumerate(zip(votes, brute_seats(votes, seats))):
            rows.append((g, k, float(v), seats))
            if seats:
                want[g, k] = s
    frame = spark.createDataFrame(rows, "g int, k int, v double, n long")
    got = {(r.g, r.k): r.won for r in apportion(frame, ["g"], "k", "v", "n").collect()}
    assert {k: got.get(k, 0) for k in want} == want


def brute_targets(sizes, weights, cap=3):
    total, names = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        shares = sum(w[s] for s in names if s not in full)
        now = {s: cap * sizes[s] if s in full else rest * w[s] / shares for s in names}
        above = {s for s in names if s not in full and now[s] > cap * sizes[s]}
        if not above:
            return now
        full |= above


def test_targets_reshare_the_excess(spark):
    random.seed(6)
    for _ in range(6):
        sizes = {s: random.choice([0, 1, 10, 500, 4000]) for s in random.sample(["a", "b", "c", "Z", "é", None], 5)}
        if not sum(sizes.values()):
            continue
        sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(sized).collect()}
        assert got == pytest.approx(brute_targets(sizes, (5, 2, 1)))


def test_named_weights(spark):
    sized = spark.createDataFrame([("a", 100), ("b", 100), (None, 100)], "source string, size long")
    got = {r.source: r.target for r in source_targets(sized, {"a": 1, None: 1}).collect()}
    assert got == {"a": 150, "b": 0, None: 150}


def _words(i, n):
    return " ".join(f"d{i}w{k}" for k in range(n))


@pytest.fixture
def corpus(docs):
    random.seed(8)
    rows = [(i, _words(i, random.randint(1, 300)), random.choice("aaaaab") if i % 9 else None) for i in range(300)]
    return docs(rows + [(900, "", "a"), (901, None, "b"), (1, "again and again", "a")])


def test_plan_keeps_its_promises(corpus):
    sized = sized_rows(corpus)
    plan = plan_mix(sized, shard_words=4000).cache()
    assert plan.count() == corpus.count()
    assert plan.filter("taken > 3 * size").count() == 0
    for r in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target"),
                                        F.first("source_size").alias("s"), F.sum("size").alias("z")).collect():
        assert r.z == r.s
        assert abs(r.t - r.target) <= 128 * (r.s // 4000 + 2)
    again = plan_mix(sized_rows(corpus), shard_words=4000)
    key = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, plan.select(*key).collect())) == sorted(map(tuple, again.select(*key).collect()))


def test_documents_of_the_mix(corpus):
    plan = plan_mix(sized_rows(corpus), shard_words=4000)
    texts = {}
    for r in corpus.collect():
        texts.setdefault(r.doc_id, []).append((r.text or "").split())
    out = mix_documents(corpus, length="n_chars", shard_words=4000)
    assert out.columns == corpus.columns
    rows = out.collect()
    taken = {}
    for r in rows:
        words = r.text.split()
        assert any(set(words) <= set(t) for t in texts[r.doc_id])
        assert r.n_chars == len(r.text)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(words)
    want = {r.doc_id: r.t for r in plan.groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()}
    assert taken == {k: v for k, v in want.items() if v}


def test_small_sources_and_tables(docs):
    """Targets of less than a block: 25, 10 and 5 words of a table of 40; 3 words beside 9,000."""
    small = docs([(1, _words(1, 20), "a"), (2, _words(2, 10), "b"), (3, _words(3, 10), "c")])
    assert {r.source: r.taken for r in plan_mix(sized_rows(small)).collect()} == {"a": 25, "b": 10, "c": 5}
    assert sum(len(r.text.split()) for r in mix_documents(small).collect()) == 40
    large = docs([(i, _words(i, 300), "a") for i in range(30)] + [(98, "x", "b"), (99, "", "c"), (97, "y z", "b")])
    plan = plan_mix(sized_rows(large), shard_words=1000).collect()
    taken = lambda s: sum(r.taken for r in plan if r.source == s)
    assert taken("b") == round(next(r.target for r in plan if r.source == "b")) == 9 and taken("c") == 0
    assert abs(taken("a") - 8994) <= 128 * 10


def test_shared_ids_are_spread(spark, docs):
    """A third of the rows without an id, a third with one id, many of them equal: as many shards as others."""
    rows = [(i, _words(i, 20), "a") for i in range(400)] + [(None, _words(i % 9, 20), "a") for i in range(400)] + [
        (7, _words(1, 20), "a") for _ in range(400)]
    sized = sized_rows(docs(rows))
    tickets = [r._ticket for r in with_tickets(sized).collect()]
    assert len(tickets) == len(set(tickets)) == 1200
    plan = lambda frame: sorted((r.doc_id or -1, r["size"], r.taken) for r in plan_mix(
        sized_rows(frame), shard_words=1000).collect())
    first = plan(docs(rows))
    assert len(first) == 1200
    assert abs(sum(c for _, _, c in first) - 24_000) <= 128 * 24
    assert first == plan(docs(rows[::-1]).repartition(5))
    # the id alone draws the ticket where no other row has it
    alone = {r.doc_id: r._ticket for r in with_tickets(sized).collect() if r.doc_id not in (None, 7)}
    assert alone[3] == hashlib.md5(b"17:3").hexdigest()


def test_odd_rows_and_empty_table(odd, docs):
    plan = plan_mix(sized_rows(odd)).collect()
    assert len(plan) == odd.count()
    assert all(r.taken == 0 for r in plan if r["size"] == 0)
    assert plan_mix(sized_rows(docs([]))).count() == 0
    assert mix_documents(docs([])).count() == 0
    clash = odd.withColumns({"_row": F.lit(1), "_of": F.lit(2), "shard": F.lit(3)})
    assert mix_documents(clash).columns == clash.columns
