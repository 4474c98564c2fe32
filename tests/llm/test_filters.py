"""Quality rules, URL filters and line dedup: brute force and odd rows."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from patio.llm.lines import drop_boilerplate
from patio.llm.quality import filter_quality, judge_quality
from patio.llm.urls import UrlRule, explicit_rule, filter_urls, host_of, matches, mine_rules, path_of

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_metrics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, c in Counter(windows).items() if c > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_metrics_match_brute_force(odd, docs):
    more = docs([(i, t, "a") for i, t in enumerate([
        "a b c a b c a b", "a a a a", "a\na\n\na \nb", "x y z w x y z", "#a <b> $", "a b a b a b a", "one",
        "a b\x0bc\x0cd\re a b c d e"])])
    for frame in (odd, more):
        got = judge_quality(frame).select("text", *METRICS).collect()
        assert [tuple(r)[1:] for r in got] == [brute_metrics(r.text) for r in got]


def test_base_rules_and_odd_rows(odd):
    rows = judge_quality(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        n, _, _, _, repeated = brute_metrics(r.text)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert r.kept <= (not r.base_failed)


def test_filter_keeps_columns_with_clashing_names(odd):
    clash = odd.withColumns({"kept": F.lit("x"), "n_words": F.lit(-1), "_Body": F.lit(1)})
    out = filter_quality(clash)
    assert out.columns == clash.columns
    assert {(r["kept"], r.n_words) for r in out.collect()} <= {("x", -1)}


def test_prose_stays_and_junk_goes(docs):
    prose = " ".join(f"the man{i} and a house{i} of stone." for i in range(12))
    rows = [(1, prose, "a"), (2, " | ".join(f"w{i}" for i in range(90)), "a"),
            (3, " ".join(f"X{i}Y!!" for i in range(90)), "a"), (4, "buy this now " * 30, "a")]
    assert [r.doc_id for r in filter_quality(docs(rows)).collect()] == [1]


def test_book_length_prose_stays(docs):
    book = " ".join(f"the man{i} and a house{i} of stone{i}." for i in range(15_000))
    frame = docs([(1, book, "a"), (2, "the end " * 60_000, "a")])
    verdicts = {r.doc_id: (r.n_words, r.kept, r.failed) for r in judge_quality(frame).collect()}
    assert verdicts == {1: (105_000, True, ""), 2: (120_000, False, "repetitive")}
    assert [r.doc_id for r in filter_quality(frame).collect()] == [1]


def test_empty_table(docs):
    assert judge_quality(docs([])).count() == 0
    assert drop_boilerplate(docs([])).count() == 0


@pytest.mark.parametrize("url, host, path", [
    ("http://A.Example.net/En/1?x#y", "a.example.net", "/En/1"), ("x", "", ""), (None, "", ""),
    ("http://h", "h", ""), ("http://h?q/r", "h", ""), ("http://h#://z", "h", ""), ("://a/b", "a", "/b"),
    ("a\nb://c/d\ne", "c", "/d\ne"), ("http://u@h:80/p://q/z", "u@h:80", "/p://q/z"),
])
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "u string").select(host_of(F.col("u")), path_of(F.col("u"))).first()
    assert tuple(row) == (host, path)


def test_longest_rule_wins(spark):
    hosts = [("a.net", "/x"), ("net", "/"), ("anet", "/"), ("b.example.net", "/en/1"), ("example.net", "/de/"),
             ("example.com", "/de/1"), ("example.com", "/en/"), ("w.org", "/fr/a"), ("a.net", "")]
    rule, verdict = explicit_rule(F.col("host"), F.col("path"))
    got = [tuple(r) for r in spark.createDataFrame(hosts, "host string, path string").select(rule, verdict).collect()]
    assert got == [("net/", "block"), ("net/", "block"), (None, None), ("example.net/en/", "allow"), ("net/", "block"),
                   ("example.com/de/", "block"), (None, None), ("org/fr/", "allow"), (None, None)]


def test_mined_rules_block(spark):
    rows = [(["h:spam", f"p:{i % 3}"], True) for i in range(30)] + [(["h:good", f"p:{i % 3}"], False) for i in range(30)]
    labelled = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    rules = mine_rules(labelled)
    assert [r.tokens for r in rules.collect()] == [["h:spam"]]
    pages = spark.createDataFrame(
        [(1, "http://spam/a"), (2, "http://good/a"), (3, None), (4, "http://spam/a")], "page_id long, url string")
    out = filter_urls(pages, labelled, rules=[UrlRule("allow", "good")])
    assert {r.page_id: (r.rule, r.verdict, r.mined_rules) for r in out.collect()} == {
        1: (None, "block", 1), 2: ("good/", "allow", 0), 3: (None, "allow", 0), 4: (None, "block", 1)}


def brute_rules(rows, least, confidence):
    total, bad = Counter(), Counter()
    for tokens, label in rows:
        for k in range(1, len(tokens) + 1):
            for combo in combinations(sorted(tokens), k):
                total[combo] += 1
                bad[combo] += label
    good = {c for c in total if bad[c] >= least and bad[c] / total[c] >= confidence}
    return {c for c in good if not any(set(s) < set(c) for s in good)}


def test_rare_hosts_and_long_rules(spark):
    """A bad host with 6 of 2,000 urls blocks; so do four tokens no three of which do."""
    rows = [(["h:ads", "h:com"], True)] * 6 + [(["h:com", f"h:site{i % 40}"], i % 10 == 0) for i in range(1970)]
    four = ["p:a", "p:b", "p:c", "p:d"]
    rows += [(four, True)] * 6 + [([t for t in four if t != out], False) for out in four for _ in range(6)]
    found = mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    got = [tuple(r.tokens) for r in found.collect()]
    assert len(got) == len(set(got)) and {("h:ads",), tuple(four)} <= set(got)
    assert set(got) == brute_rules(rows, 5, 0.6)


def test_rules_match_brute_force(spark, monkeypatch):
    from patio.llm import urls
    monkeypatch.setattr(urls, "REPEATS", 3)
    random.seed(19)
    rows = []
    for _ in range(60):
        tokens = random.sample([f"h:{i}" for i in range(4)] + [f"p:{i}" for i in range(5)], random.randint(0, 6))
        share = random.choice([0.2, 0.5, 0.7])
        rows += [(random.sample(tokens, len(tokens)), random.random() < share) for _ in range(random.randint(1, 9))]
    want = brute_rules(rows, 5, 0.6)
    assert any(len(c) > 3 for c in want)
    got = [tuple(r.tokens) for r in mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("good_holds_all", [False, True])
def test_equal_urls_of_many_tokens(spark, good_holds_all):
    """2^20 sets of tokens with the same bad urls are one item; only pairs are counted."""
    tokens = [f"p:{i:02}" for i in range(20)]
    rows = [(tokens, True)] * 5 + [([t], False) for t in tokens for _ in range(5)]
    rows += [(tokens, False)] * 5 if good_holds_all else []
    found = mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    want = [] if good_holds_all else sorted(combinations(tokens, 2))
    assert sorted(tuple(r.tokens) for r in found) == want


def test_urls_with_odd_rows_and_clashing_columns(spark):
    labelled = spark.createDataFrame([(["h:spam"], True)] * 6, "tokens array<string>, bad boolean")
    names = ["_url", "_key", "_mined", "_body", "Host", "rule", "tokens", "rule_id", "url"]
    long = "http://spam/" + "x" * 1_000_000
    pages = spark.createDataFrame([(*range(8), u) for u in ("http://spam/a", None, "", "no url", long, "http://spam/a")],
                                  ", ".join(f"{c} {'string' if c == 'url' else 'long'}" for c in names))
    out = filter_urls(pages, labelled)
    assert out.columns == ["_url", "_key", "_mined", "_body", "tokens", "rule_id", "url", "host", "path", "rule",
                           "verdict", "mined_rules"]
    got = sorted(((r.url or "")[:14], r.host, r.verdict) for r in out.collect())
    assert got == [("", "", "allow"), ("", "", "allow"), ("http://spam/a", "spam", "block"),
                   ("http://spam/a", "spam", "block"), ("http://spam/xx", "spam", "block"), ("no url", "", "allow")]
    assert filter_urls(pages.filter("1 = 0"), labelled).count() == 0


def test_index_needs_all_tokens(spark):
    rules = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "rule_id long, tokens array<string>")
    rows = spark.createDataFrame([("x", ["a", "c"]), ("y", ["b", "a"]), ("z", [])], "key string, tokens array<string>")
    assert {tuple(r) for r in matches(rows, rules, "key").collect()} == {("x", 2), ("y", 1)}


def test_no_labels_no_rules(spark):
    none = spark.createDataFrame([], "tokens array<string>, bad boolean")
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert filter_urls(pages, none).select("verdict").first()[0] == "block"


def brute_lines(rows, ratio, min_pages):
    pages, held = Counter(), Counter()
    strip = lambda x: x.strip("\t\n\x0b\x0c\r ")
    for _, t, s in rows:
        pages[s] += 1
        held.update({(s, strip(x)) for x in (t or "").split("\n") if strip(x)})
    out = []
    for i, t, s in rows:
        if t is not None:
            t = "\n".join(x for x in t.split("\n") if not (
                strip(x) and held[s, strip(x)] >= min_pages and held[s, strip(x)] > ratio * pages[s]))
        out.append((i, t, s))
    return out


def test_lines_match_brute_force(docs):
    rows = [(i, f"menu\ntext {i}\n footer \n\n{'rare' if i < 3 else 'x' + str(i)}", "s" if i % 3 else None)
            for i in range(40)] + [(99, None, "s"), (98, "menu", "t"), (97, "", "s"), (96, "menu\nmenu", "s")]
    got = drop_boilerplate(docs(rows), dropped="gone", length="n_chars").collect()
    key = lambda r: (r[0], r[1] or "")
    assert sorted(((r.doc_id, r.text, r.source) for r in got), key=key) == sorted(brute_lines(rows, 0.1, 10), key=key)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_lines_of_small_and_large_hosts(docs):
    """A host of nine pages loses what all of them hold; a large one what 2 % hold, but no line of two pages."""
    rows = [(i, f"small {i}\nMIT License\nlast {i}", "tiny") for i in range(9)]
    rows += [(100 + i, f"{'notice' if i % 50 == 0 else 'own'} {'x' if i % 50 == 0 else i}\ntext {i}\n"
              + ("twice" if i < 2 else f"end {i}"), "big") for i in range(400)]
    got = drop_boilerplate(docs(rows), dropped="gone").collect()
    want = brute_lines(rows, 0.01, 3)
    assert sorted((r.doc_id, r.text, r.source) for r in got) == sorted(want)
    assert sum(r.gone for r in got) == 9 + 8
    assert not any("MIT License" in r.text or "notice" in r.text for r in got)
    assert sum("twice" in r.text for r in got) == 2


def test_lines_that_go_anywhere_in_a_page(docs):
    """Runs of dropped lines at both ends, next to each other, and with blank lines between."""
    rows = [(i, f"a\nb\n\n mine {i}\na\n \nown {i}\nb \n\n", "s") for i in range(4)]
    rows += [(9, "a\nb", "s"), (10, "\n", "s"), (11, None, "s"), (12, "c", "s")]
    got = drop_boilerplate(docs(rows), dropped="gone", length="n_chars").collect()
    key = lambda r: (r[0], r[1] or "")
    assert sorted(((r.doc_id, r.text, r.source) for r in got), key=key) == sorted(brute_lines(rows, 0.01, 3), key=key)
    assert {r.doc_id: r.gone for r in got} == {0: 4, 1: 4, 2: 4, 3: 4, 9: 2, 10: 0, 11: 0, 12: 0}


def test_lines_with_clashing_columns(odd):
    clash = odd.withColumns({"_host": F.lit(1), "_Found": F.lit(2), "lines": F.lit(3)})
    out = drop_boilerplate(clash)
    assert out.columns == clash.columns and out.count() == clash.count()
