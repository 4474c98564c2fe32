"""URL filtering: explicit host and path rules, and association rules mined from labels.

Token combinations of labelled urls that at least ``min_count`` bad urls hold (``support`` of all
labelled urls, if that is more), and whose urls are mostly bad (``confidence``), block; combinations
that contain a shorter one that blocks by itself are pruned, and nothing else limits their length.
Single tokens are counted first; a token that blocks, or that too few bad urls hold, is in no longer
rule. Tokens that the same bad urls hold are merged into one item, and Spark's FP-growth finds the sets
of such items that enough bad urls hold. The token sets inside them are then counted over all distinct
urls, shorter ones first. Equal urls of many tokens are one item; urls that differ in ever other tokens
still give many sets. The rules form an inverted index, each under its rarest token; a
url matches a rule when it holds all of its tokens. Urls are judged once per distinct url, so a url
that a third of the pages share costs one row per task.

Results for odd rows: a null url, or one without ``://``, has empty host and path, fits no rule and
is allowed; without labelled urls nothing is mined and the explicit rules decide alone; repeated rows give
repeated results, and an empty table an empty one; given columns named like a result are replaced.
"""

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.llm.common import private
from patio.session import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label:bad"


@dataclass(frozen=True)
class UrlRule:
    """Fits the host and its subdomains when the url's path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed rules of the contract.
RULES = [
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
]

#: Mining parameters: share and number of bad urls among the labelled ones, share of bad ones.
SUPPORT = 0.00001
MIN_COUNT = 5
CONFIDENCE = 0.6
#: Rows that one step of a repetition makes.
REPEATS = 4096


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:(?!://).)*://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^(?s)(?:(?!://).)*://[^/?#]*([^?#]*)", 1)


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
        path, F.lit(rule.path))


def explicit_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        hit = fits(rule, host, path)
        name = F.when(hit, F.lit(rule.name)).otherwise(name)
        verdict = F.when(hit, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, and path segments without numbers, each marked by its place."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(F.lower(path), "[/._-]"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.filter(
        F.concat(labels, segments), lambda x: ~x.rlike("^[hp]:$") & ~x.rlike("^p:[0-9]+$")))


def mine_rules(labelled: DataFrame, support: float = SUPPORT, min_count: int = MIN_COUNT,
               confidence: float = CONFIDENCE) -> DataFrame:
    """Blocking combinations of (tokens array, bad boolean) rows: ``rule_id``, ``tokens``."""
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    baskets = durable(
        labelled.select(F.array_sort(F.array_distinct("tokens")).alias("tokens"), F.lit(1).cast("long").alias("n"),
                        F.col("bad").cast("long").alias("bad"))
        .groupBy("tokens").agg(*sums).withColumn("basket", F.monotonically_increasing_id()))
    n = baskets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(min_count, math.ceil(support * n - 1e-6))
    tokens = baskets.select("basket", "n", "bad", F.explode("tokens").alias("token"))
    frequent = durable(tokens.groupBy("token").agg(*sums).filter(F.col("bad") >= least).withColumn(
        "blocks", F.col("bad") / F.col("n") >= confidence))
    single = frequent.filter("blocks").select(F.array("token").alias("tokens"))

    open_tokens = frequent.filter("not blocks").select("token")
    rest = durable(
        tokens.join(open_tokens, "token").groupBy("basket", "n", "bad")
        .agg(F.array_sort(F.collect_list("token")).alias("tokens")).filter(F.size("tokens") > 1)
        .groupBy("tokens").agg(*sums).withColumn("basket", F.monotonically_increasing_id()))
    longer = _longer_rules(rest, frequent.filter("not blocks").select(F.array("token").alias("tokens"), "n", "bad"),
                           least, confidence)
    return durable(single.unionByName(longer).select(F.xxhash64("tokens").alias("rule_id"), "tokens"))


def _classes(rest: DataFrame) -> DataFrame:
    """(token, class): tokens that the same bad urls hold are one class, named by its first token. Sets
    of urls are compared by their size and two sums of hashes."""
    held = rest.filter("bad > 0").select("basket", F.explode("tokens").alias("token"))
    marks = [F.sum(F.xxhash64("basket", F.lit(seed)).cast("decimal(20,0)")).alias(f"s{seed}") for seed in (1, 2)]
    marked = held.groupBy("token").agg(F.count(F.lit(1)).alias("s0"), *marks)
    same = marked.groupBy("s0", "s1", "s2").agg(F.min("token").alias("class"))
    return durable(marked.join(same, ["s0", "s1", "s2"]).select("token", "class"))


def _frequent_classes(rest: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """(classes, held): sets of classes that at least ``least`` bad urls hold, by FP-growth."""
    n_bad = rest.agg(F.coalesce(F.sum("bad"), F.lit(0))).first()[0]
    if n_bad < least:
        return rest.sparkSession.createDataFrame([], "classes array<string>, held long")
    of_basket = rest.filter("bad > 0").select("basket", "bad", F.explode("tokens").alias("token")).join(
        classes, "token").groupBy("basket", "bad").agg(F.collect_set("class").alias("items"))
    # FP-growth takes a row for each bad url
    step, steps = F.explode(F.expr(f"sequence(0L, (bad - 1) div {REPEATS})")), F.col("step") * REPEATS
    items = of_basket.withColumn("step", step).select("items", F.explode(
        F.sequence(F.lit(1).cast("long"), F.least(F.lit(REPEATS), F.col("bad") - steps))).alias("copy"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_bad).fit(items.select("items"))
    return durable(model.freqItemsets.select(F.array_sort("items").alias("classes"), F.col("freq").alias("held")))


def _longer_rules(rest: DataFrame, open_sets: DataFrame, least: int, confidence: float) -> DataFrame:
    """Minimal blocking token sets of two tokens and more, level by level.

    A set's bad urls follow from its classes. A set that blocks, or that holds the same urls as one of its
    subsets, is in no longer minimal rule, so only the others are extended, and only sets all of whose
    subsets are such others are counted.
    """
    classes = _classes(rest)
    frequent = _frequent_classes(rest, classes, least)
    members = classes.groupBy("class").agg(F.array_sort(F.collect_list("token")).alias("members"))
    found = rest.sparkSession.createDataFrame([], "tokens array<string>")
    alive = durable(open_sets.join(classes, F.get("tokens", F.lit(0)) == F.col("token")).select(
        "tokens", F.array("class").alias("classes"), "n", "bad"))
    size = 1
    while True:
        size += 1
        wider = frequent.filter(F.size("classes") == size).select(
            F.slice("classes", 1, size - 1).alias("classes"), F.get("classes", F.lit(size - 1)).alias("class"), "held")
        new_class = alive.join(wider, "classes").join(members, "class").select(
            F.col("tokens").alias("old"), F.concat("classes", F.array("class")).alias("classes"),
            F.col("held").alias("bad"), F.explode("members").alias("token"))
        same_class = alive.select("tokens", "classes", "bad", F.explode("classes").alias("class")).join(
            members.filter(F.size("members") > 1), "class").select(
            F.col("tokens").alias("old"), "classes", "bad", F.explode(F.filter("members", lambda m: m > F.array_max(
                F.array_intersect("members", "tokens")))).alias("token"))
        tried = new_class.unionByName(same_class).select(
            F.array_sort(F.concat("old", F.array("token"))).alias("tokens"), "classes", "bad").distinct()
        parts = tried.select("tokens", "classes", "bad", F.explode("tokens").alias("left_out")).select(
            "tokens", "classes", "bad", F.array_remove("tokens", F.col("left_out")).alias("part"))
        known = alive.select(F.col("tokens").alias("part"), F.col("n").alias("part_n"), F.col("bad").alias("part_bad"))
        whole = durable(parts.join(known, "part").groupBy("tokens", "classes", "bad").agg(
            F.count(F.lit(1)).alias("parts"), F.collect_set(F.struct("part_n", "part_bad")).alias("counts"))
            .filter(F.col("parts") == size).withColumn("rule_id", F.xxhash64("tokens")))
        if whole.isEmpty():
            return found
        held = matches(rest, whole, "basket").join(rest.select("basket", "n"), "basket").groupBy("rule_id").agg(
            F.sum("n").alias("n"))
        counted = durable(whole.join(held, "rule_id").withColumn("blocks", F.col("bad") / F.col("n") >= confidence))
        found = found.unionByName(counted.filter("blocks").select("tokens"))
        same = F.exists("counts", lambda c: (c["part_n"] == F.col("n")) & (c["part_bad"] == F.col("bad")))
        alive = counted.filter(~F.col("blocks") & ~same).select("tokens", "classes", "n", "bad")


def matches(rows: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, rule_id) for each row whose tokens hold all of a rule's, by inverted index: a rule is
    listed under the token that the fewest rows hold."""
    listed = rules.select("rule_id", F.col("tokens").alias("need"), F.explode("tokens").alias("token"))
    posted = rows.select(key, "tokens", F.explode(F.array_distinct("tokens")).alias("token"))
    held = posted.join(listed.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    index = listed.join(held, "token").groupBy("rule_id").agg(
        F.min("need").alias("need"), F.min(F.struct("count", "token")).alias("rarest")).select(
        "rule_id", "need", F.col("rarest.token").alias("token"))
    return posted.join(index, "token").filter(F.size(F.array_except("need", "tokens")) == 0).select(key, "rule_id")


def labelled_urls(urls: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """Tokens and label of the urls whose last path number is a labelled document: bad when its
    quality is 0 or it is toxic."""
    named = urls.select(F.col(url).alias("_url")).withColumn(
        "doc_id", F.regexp_extract(path_of(F.col("_url")), r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1))
    bad = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    joined = named.filter("doc_id != ''").withColumn("doc_id", F.col("doc_id").cast("long")).join(
        bad.filter("bad is not null"), "doc_id")
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    return joined.select(url_tokens(host, path).alias("tokens"), "bad")


def filter_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, url: str = "url", **mining) -> DataFrame:
    """The table with ``host``, ``path``, ``rule``, ``verdict`` and ``mined_rules`` (how many mined
    rules the url matches). Given columns of these names are replaced."""
    mined = mine_rules(labelled, **mining)
    made = {"host", "path", "rule", "verdict", "mined_rules"}
    name, key, count, body = (private(pages, c) for c in ("_url", "_key", "_mined", "_body"))
    distinct = pages.select(F.col(f"`{url}`").alias(key)).filter(F.col(key).isNotNull()).distinct()
    tokens = distinct.withColumn("tokens", url_tokens(host_of(F.col(key)), path_of(F.col(key))))
    hits = matches(tokens, mined, key).groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias(count))
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in made]
    host, path = host_of(F.col(body)), path_of(F.col(body))
    rule, verdict = explicit_rule(host, path, rules)
    joined = pages.withColumn(body, F.col(f"`{url}`")).join(hits, F.col(body) == F.col(name), "left")
    return joined.select(
        *kept, host.alias("host"), path.alias("path"), rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col(count) > 0, "block").otherwise("allow")).alias("verdict"),
        F.coalesce(count, F.lit(0)).alias("mined_rules"))
