"""Conversation repair against a search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from patio.llm.conversations import (KEPT, SuffixAutomaton, conversation_digests, conversation_key,
                                     repair_conversations, solve)
from patio.llm.plans.repairs import damaged, op11_conversation_repair

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
GRAMMAR = re.compile("(s?(ua)+)?")


def brute_faults(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        visible = re.findall("[^\x20\x09-\x0d]", text)
        fault = ("blank" if not visible else "duplicate" if (role, text) in seen
                 else "truncated" if visible[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute_repair(rows):
    """Least (cost, audit, result) over all edit sequences, by search over (row, initials so far)."""
    rows = brute_faults(rows)

    @functools.cache
    def best(at, state, inserted=0):  # state: what the initials so far amount to: "", "s", "u", "a"
        ways = [(0, "", ())] if at == len(rows) and state in ("", "a") else []
        turn = "a" if state == "u" else "u"
        word = {"u": "user", "a": "assistant"}[turn]

        def add(cost, edit, row, way):
            ways.append((cost + way[0], edit + way[1], row + way[2]))
        if at < len(rows):
            role, text, fault = rows[at]
            add(4, "D", (), best(at + 1, state))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                if role[:1] == turn or role[:1] == "s" and state == "":
                    add(extra, "K", ((role, text),), best(at + 1, role[0]))
                add(3 + extra, "R", ((word, text),), best(at + 1, turn))
        if inserted < 3:
            add(3, "I", ((word, ""),), best(at, turn, inserted + 1))
        return min(ways, default=(1 << 30, "", ()), key=lambda w: w[:2])

    cost, audit, result = best(0, "")
    assert GRAMMAR.fullmatch("".join(r[0][0] for r in result))
    return cost, audit, result


def expected(rows):
    """Result of one conversation's rows (turn, role, text), in order."""
    clean = [(" " if r is None else r, " " if x is None else x) for _, r, x in rows]
    faults = [f for _, _, f in brute_faults(clean)]
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(clean, clean[1:])]
    cost, audit, result = brute_repair(tuple(clean))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in result).encode()).hexdigest())


def in_order(rows):
    dig = lambda x: hashlib.sha256((" " if x is None else x).encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", (r[2] if r[2] is not None else " ")[:64],
                                       dig(r[2])))


def random_rows(seed, n, conv):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \n", None, "so on", "ok!", "a. ", "b.\x0b", "c .x"]
    rows = []
    for _ in range(n):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ufo"])
        text = rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}{rng.choice('.!?')}"
        rows.append((conv, rng.choice([None, *range(max(n, 1) * 2)]), role, text))
    return rows


def compare(spark, rows, parts=None):
    df = spark.createDataFrame(rows, ROWS)
    fixed = repair_conversations(df, parts=parts)
    got = {r.conv: r for r in fixed.conversations.collect()}
    digests = {r.conv: r.sha256 for r in conversation_digests(fixed.rows).collect()}
    by = {}
    for c, *row in rows:
        by.setdefault(c, []).append(tuple(row))
    assert len(got) == len(by)
    for c, own in by.items():
        r = got["" if c is None else f"={c}"]
        digest = digests.get(r.conv, hashlib.sha256(b"").hexdigest())
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digest) == expected(in_order(own))


def test_brute_force_grammar():
    assert brute_repair((("user", "a."), ("assistant", "b.")))[:2] == (0, "KK")
    assert brute_repair((("user", "a."),))[:2] == (3, "KI")
    assert brute_repair((("system", "a."),))[:2] == (4, "D")
    assert brute_repair(())[:2] == (0, "")


@pytest.mark.parametrize("parts", [None, 1, 5, 40])
def test_small_conversations(spark, parts):
    rows = []
    for c in range(60):
        rows += random_rows(c, c % 11, None if c == 13 else c)
    compare(spark, rows, parts)


@pytest.mark.parametrize("parts", [3, 30])
def test_one_conversation_over_many_tasks(spark, parts):
    rows = random_rows(99, 150, 7) + random_rows(5, 4, 6) + random_rows(6, 4, 8) + [(7, 3, "user", "Same.")] * 40
    compare(spark, rows, parts)


def test_equal_rows_and_all_null(spark):
    compare(spark, [(1, 2, "user", "Same.")] * 500 + [(1, None, None, None)] * 3 + [(None, None, None, None)] * 2, 4)


def test_automaton_shares_suffixes():
    made = []

    class Counting(SuffixAutomaton):
        def _node(self, letter, after):
            made.append(letter)
            return super()._node(letter, after)

    automaton = Counting()
    for signature in sorted(["suaua$", "uaua$", "xua$", "ua$"], key=lambda s: s[::-1]):
        automaton.load(signature, (0, 0, 0, 0))
    assert len(made) == len({s[i:] for s in ["suaua$", "uaua$", "xua$"] for i in range(len(s))})
    assert KEPT[0, "s"] == 1


def test_equal_signatures_are_solved_once(spark):
    jobs = spark.createDataFrame([("ua$", [0, 0, 0, 0], 0)] * 5, "signature string, end array<bigint>, start int")
    assert solve(jobs).count() == 1


def test_empty_and_clashing(spark):
    fixed = repair_conversations(spark.createDataFrame([], ROWS))
    assert fixed.conversations.count() == 0 and conversation_digests(fixed.rows).count() == 0
    df = spark.createDataFrame([(1, 1, "user", "a.", 5, 6)], "conv_id long, turn long, role string, text string, part int, letter int")
    assert [r.audit for r in repair_conversations(df).conversations.collect()] == ["KI"]
    other = df.toDF("part", "place", "row", "digest", "conv", "text")
    assert repair_conversations(other, "part", "place", "row", "digest").conversations.first().audit == "KI"
    assert df.select(conversation_key("conv_id")).first()[0] == "=1"


def test_very_long_text(spark):
    compare(spark, [(1, 1, "user", "long " * 200_000), (1, 2, "assistant", "x" * 500_000 + "."), (1, 3, "user", "y")], 2)


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else " " if role is None else role
        out += [(c, t, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def test_damage(spark):
    rows = [r for c in range(80) for r in random_rows(c, 6, c or None)]
    got = damaged(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_damage(rows)))


def test_query(spark, sf):
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    by = {c: [] for c, *_ in given}
    for c, *row in brute_damage(given):
        by[c].append(tuple(row))
    got = op11_conversation_repair(spark, sf).collect()
    assert len(got) == len(by)
    for r in got:
        assert tuple(r)[1:] == expected(in_order(by[r.conv_id]))
