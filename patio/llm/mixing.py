"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Every source gets a target number of words: its weight's share of all words, stopped at ``cap``
   times what the source has; the excess is shared again by weight until no source is above.
2. The total is a number of blocks of ``block`` words. Blocks go to sources by highest quotients
   target / (2 * seats + 1). Only the few seats that the divisor's bounds leave open are ranked, so
   the work grows with the number of sources, not of blocks. A source whose target is positive but
   too small for a block gets its target in whole words, one at least.
3. Sources are cut into shards by a seeded hash; the same apportionment gives each shard an integer
   number of blocks. A source with a third of the rows is spread over many shards.
4. Inside a shard the documents lie in seeded order and form one row of words, cut into blocks. The
   quota takes whole passes over the shard, then blocks in seeded order. The last block of a shard
   may be shorter.

Only built-in functions are used. Results for odd rows: documents without words take 0; a null
source is a source of its own, last in order; repeated rows are drawn for themselves, and rows without
an id or with a shared one are spread over shards like others; very long texts are cut into blocks; an
empty table gives an empty mix; the documents of a mix keep extra columns of any name. A rerun over the same rows gives the same mix.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.llm.common import WORD, private
from patio.session import durable

#: Fixed values of the default mix.
WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 128
SHARD_WORDS = 1 << 18
MAX_SHARDS = 100_000
LANES = 1024
SEED = 17


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: ``src`` (1-based place in code point order, null last), ``source_size``,
    ``weight``, ``target``. A dict names the weight of each source (others 0), a sequence repeats."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    ordered = totals.withColumn(
        "src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    if isinstance(weights, dict):
        weight = F.lit(0.0)
        for name, value in weights.items():
            same = F.col("source").isNull() if name is None else F.col("source") == name
            weight = F.when(same, F.lit(float(value))).otherwise(weight)
    else:
        turns = F.array(*[F.lit(float(x)) for x in weights])
        weight = F.get(turns, (F.col("src") - 1) % len(weights))
    everything = Window.partitionBy()
    most = (F.lit(cap) * F.col("source_size")).cast("double")
    rated = ordered.withColumn("weight", weight).withColumns({
        "_most": most,
        "_ratio": F.when(F.col("weight") > 0, most / F.col("weight")).otherwise(F.lit(-1.0)),
    })
    by_ratio = Window.orderBy("_ratio", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    gone = F.when(F.col("weight") > 0, F.col("_most")).otherwise(F.lit(0.0))
    steps = rated.withColumns({
        "_at": F.row_number().over(by_ratio),
        "_rest": F.sum("source_size").over(everything) - F.coalesce(F.sum(gone).over(before), F.lit(0.0)),
        "_shares": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    # the first source, by how soon it fills up, that stays below its stop
    open_here = (F.col("_shares") > 0) & (F.col("weight") > 0) & (
        F.col("_rest") <= F.col("_ratio") * F.col("_shares"))
    first = F.min(F.when(open_here, F.struct("_at", "_rest", "_shares"))).over(everything)
    target = F.when(F.col("weight") <= 0, F.lit(0.0)).when(
        first.isNull() | (F.col("_at") < first["_at"]), F.col("_most")).otherwise(
        first["_rest"] * F.col("weight") / first["_shares"])
    return steps.select("source", "src", "source_size", "weight", target.alias("target"))


def apportion(votes: DataFrame, group: list[str], key: str, vote: str, seats: str) -> DataFrame:
    """Sainte-Lague seats of every row of a group with ``seats`` seats: columns group, key, ``won``.

    With quotas q (their sum is the seats N) and m rows, the divisor of the highest-quotient rule
    lies between N/(N+m/2) and N/(N-m/2). Seats below the lower bound are certain, those above the
    upper bound lost; only the seats between are ranked by quotient, about two per row.
    """
    w = Window.partitionBy(*group)
    n, m = F.col(seats).cast("double"), F.col("_m")
    quota = F.col(vote) / F.col("_votes") * n
    low = F.when(n > m / 2, F.greatest(F.floor(quota * (n - m / 2) / n - 1.5), F.lit(0))).otherwise(F.lit(0))
    high = F.ceil(quota * (n + m / 2) / n + 1.5)
    bounded = (
        votes.filter(F.col(vote) > 0)
        .withColumns({"_votes": F.sum(vote).over(w), "_m": F.count(F.lit(1)).over(w)})
        .filter(F.col(seats) > 0)
        .withColumns({"_low": low.cast("long"), "_high": high.cast("long")})
        .withColumn("_open", F.col(seats) - F.sum("_low").over(w))
        .withColumn("_j", F.explode(F.expr("sequence(_low, _high - 1)"))))
    ranked = Window.partitionBy(*group).orderBy(F.desc("_quotient"), key)
    return (
        bounded.withColumn("_quotient", F.col(vote) / (2 * F.col("_j") + 1))
        .withColumn("_rank", F.row_number().over(ranked))
        .groupBy(*group, key).agg(
            F.min("_low").alias("_low"),
            F.count(F.when(F.col("_rank") <= F.col("_open"), 1)).alias("_more"))
        .select(*group, key, (F.col("_low") + F.col("_more")).alias("won")))


def _draw(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def with_tickets(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows with ``_ticket``, a seeded draw of the id. Rows that share an id, null included, draw by
    source, size and hash of the text as well, and equal rows by their place among each other, so that no
    id fills a shard. Equal rows may change places between runs, which leaves the result as it is; they are
    numbered in ``LANES`` lanes, so that no task numbers a whole group."""
    if "hash" not in sized.columns:
        sized = sized.withColumn("hash", F.lit(0).cast("long"))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    shared = sized.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        F.col("doc_id").alias("_id"), F.lit(True).alias("_shared"))
    marked = durable(sized.join(shared, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id"))
    alone = marked.filter("_shared is null").withColumn("_ticket", _draw(F.lit(seed), ident))
    equal = marked.filter("_shared").withColumns({
        "_ticket": _draw(F.lit(seed), ident, F.coalesce("source", F.lit("")), F.col("size"), F.col("hash")),
        "_lane": F.pmod(F.xxhash64("row"), F.lit(LANES))})
    earlier = Window.partitionBy("_ticket").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = equal.groupBy("_ticket", "_lane").agg(F.count(F.lit(1)).alias("_n")).select(
        "_ticket", "_lane", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_ticket", "_lane").orderBy("row"))
    dealt = equal.withColumn("_place", place).join(lanes, ["_ticket", "_lane"]).withColumn(
        "_ticket", _draw(F.col("_ticket"), F.col("_before") + F.col("_place"))).select(alone.columns)
    return alone.unionByName(dealt).drop("_shared", "hash")


def plan_mix(sized: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK,
             shard_words: int = SHARD_WORDS, max_shards: int = MAX_SHARDS, seed: int = SEED) -> DataFrame:
    """The mix of a stored table (doc_id, source, size, row): its columns with ``source_size``,
    ``target``, ``taken``, ``passes`` (whole copies) and ``parts`` (word ranges taken besides).

    ``row`` tells rows apart and must not change between reads; a column ``hash`` of the text, if there is
    one, tells apart rows that share the rest. ``shard_words`` grows with the table
    beyond ``max_shards`` shards, so that neither the shards of a source nor the rows of a shard get
    too many for a task.
    """
    sources = durable(source_targets(sized, weights, cap))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    shard_words = max(shard_words, -(-total // max_shards))
    blocks = round(total / block)
    won = apportion(sources.withColumn("_all", F.lit(0)).withColumn("_n", F.lit(blocks).cast("long")),
                    ["_all"], "src", "target", "_n").select("src", F.col("won").alias("_seats"))
    sources = durable(
        sources.join(won, "src", "left").fillna(0, ["_seats"])
        .withColumn("_few", F.when((F.col("_seats") == 0) & (F.col("target") > 0), F.greatest(
            F.round("target"), F.lit(1))).otherwise(0).cast("long"))
        .withColumn("_shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))))

    side = sources.withColumnRenamed("source", "_source")
    drawn = (
        with_tickets(sized, seed).join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("shard", _number(F.col("_ticket")) % F.col("_shards")))
    shards = drawn.groupBy("src", "shard").agg(
        F.sum("size").alias("words"), F.min("_seats").alias("_seats"),
        F.min("_few").alias("_few")).filter("words > 0")
    shards = durable(shards)
    # a source has either blocks or a few words
    quotas = apportion(shards, ["src"], "shard", "words", "_seats").withColumn("won", F.col("won") * block).unionByName(
        apportion(shards, ["src"], "shard", "words", "_few"))
    need = F.least(F.col("won"), cap * F.col("words"))
    quotas = shards.select("src", "shard", "words").join(quotas, ["src", "shard"]).withColumn("_need", need)

    # blocks of each shard in seeded order: the quota left after whole passes takes the first ones
    length = F.least(F.lit(block), F.col("words") - F.col("block") * block)
    turn = Window.partitionBy("src", "shard").orderBy("_turn", "block")
    used = F.coalesce(F.sum("_length").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.col("_need") % F.col("words")
    taken_blocks = (
        quotas.withColumn("block", F.explode(F.expr(f"sequence(0L, (words - 1) div {block})")))
        .withColumns({"_length": length,
                      "_turn": _draw(F.lit(seed), F.col("src"), F.col("shard"), F.col("block"))})
        .select("src", "shard", "block", F.expr("_need div words").alias("_passes"),
                F.least(F.greatest(left - used, F.lit(0)), F.col("_length")).alias("_take")))

    order = Window.partitionBy("src", "shard").orderBy("_ticket", "doc_id", "size", "row")
    at = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = drawn.withColumn("_at", at).withColumn("block", F.explode(F.expr(
        f"if(size > 0, sequence(_at div {block}, (_at + size - 1) div {block}), array(-1L))")))
    start = F.greatest(F.col("_at") - F.col("block") * block, F.lit(0))
    stop = F.least(F.col("_at") + F.col("size") - F.col("block") * block, F.lit(block))
    part = F.struct((F.col("block") * block + start - F.col("_at")).alias("start"),
                    (F.least(stop, F.col("_take")) - start).alias("words"))
    # both sides lie by (src, shard) already and both grow with the table: no broadcast
    joined = placed.join(taken_blocks.hint("merge"), ["src", "shard", "block"], "left")
    mixed = joined.groupBy("src", "shard", "row", "doc_id", "source", "size", "source_size", "target").agg(
        F.coalesce(F.max("_passes"), F.lit(0)).alias("passes"),
        F.array_sort(F.collect_list(F.when(F.least(stop, F.col("_take")) > start, part))).alias("parts"))
    extra = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return mixed.select(
        "doc_id", "source", "size", "row", "source_size", "target", "passes", "parts",
        (F.col("passes") * F.col("size") + extra).alias("taken"))


def sized_rows(docs: DataFrame, text: str = "text", source: str = "source", ident: str = "doc_id") -> DataFrame:
    """The stored narrow form that ``plan_mix`` reads."""
    return durable(docs.select(
        F.col(ident).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.xxhash64(text).alias("hash"))
        .withColumn("row", F.monotonically_increasing_id()))


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", ident: str = "doc_id",
                  length: str | None = None, **options) -> DataFrame:
    """The documents of the mix, with the table's columns: whole copies, and one row for the words
    taken besides. A cut text keeps the white space inside its ranges. ``length`` names a column that
    holds the text's number of characters.

    The rows are stored first, numbered; the plan is made on the numbers and joined back once.
    """
    row, size = private(docs, "_row"), private(docs, "_size")
    stored = durable(docs.withColumns({
        size: word_count(F.col(text)), row: F.monotonically_increasing_id()}))
    plan = plan_mix(stored.select(
        F.col(ident).alias("doc_id"), F.col(source).alias("source"), F.col(size).alias("size"),
        F.xxhash64(text).alias("hash"), F.col(row).alias("row")), **options)
    of, passes, parts, full = (private(docs, n) for n in ("_of", "_passes", "_parts", "_whole"))
    # each piece is a word with the white space before it
    pieces = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.flatten(F.transform(parts, lambda p: F.slice(
        pieces, (p["start"] + 1).cast("int"), p["words"].cast("int")))), "")
    takes = plan.filter("taken > 0").select(
        F.col("row").alias(of), F.col("passes").alias(passes), F.col("parts").alias(parts))
    whole = F.expr(f"if({passes} > 0, array_repeat(true, cast({passes} as int)), array())")
    part = F.expr(f"if(size({parts}) > 0, array(false), array())")
    copies = (
        stored.join(takes, F.col(row) == F.col(of))
        .withColumn(full, F.explode(F.concat(whole, part)))
        .withColumn(text, F.when(F.col(full), F.col(text)).otherwise(cut)))
    if length is not None:
        copies = copies.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return copies.select(*docs.columns)
