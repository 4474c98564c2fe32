"""Near-duplicate texts: an exact similarity join on word shingles by parity sketches.

Two texts link when the Jaccard similarity of their shingle sets is 0.75 or more. No link is lost:

1. Equal sets become one node, a number of its own. Everything after works on distinct sets, and ids come
   back at the end.
2. Each set is cut into parts by its shingles' hashes; a part's signature is the hash of its parity
   sketch. Sets that link differ in at most s parts (``shingles.max_difference``), so by pigeonhole the
   first s + 1 parts of both, in a common order, share a signature (``shingles.signatures``). Sizes are
   banded by powers of two; a set also takes part in the next band if a partner can be there.
   Signatures that more than ``HOT`` sets carry are marked in a bit map of fixed size, and the order
   puts them last: shared passages then bring hardly any candidates. The marks change the order only,
   so they can't cost a link.
3. Sets that share a signature meet in a group under the smallest key in it. Every set proposes its
   nearest set and its group's head, in blocks, by the Hamming distance of dense parity sketches, which
   never exceeds the true difference. Proposals are verified on the exact sets. A last round verifies
   every pair that is still possible and not yet connected, so the components are those of all links;
   that round gives one row per such pair, so very many sets just below the threshold cost rows that
   grow with the square of their number, and in the first round a group of n sets is copied n / CHUNK
   times.

Results for odd rows: null, empty and blank texts have no shingles and link with nothing; texts of
fewer than five words are one shingle; equal texts link; rows without an id are compared like others and
get the smallest id they reach, none if there is none; an empty table gives an empty result. Ids are whole
numbers. Rows with the same id and different texts are compared as separate sets.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.batches import add_columns, steps
from patio.llm.common import WHITE, private
from patio.llm.components import components
from patio.llm.shingles import (dense_sketch, fold, max_difference, set_keys, shingle_sets, signatures,
                                sketch_bits)
from patio.session import durable

HOT = 64
HOT_BITS = 24
GROUP_SIGNS = 1 << 21
CHUNK = 512
NEAREST_ROUNDS = 1

_FEATURES = T.StructType([T.StructField("n", T.LongType()), T.StructField("a", T.LongType()),
                          T.StructField("b", T.LongType()), T.StructField("sketch", T.BinaryType())])


def shingle_features(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Per row: size of the shingle set, two keys of it, and its dense sketch."""
    def work(body, offsets):
        flat, bounds = shingle_sets(body, offsets)
        a, b = set_keys(flat, bounds)
        sketches = [dense_sketch(flat[x:y]) if y > x else b"" for x, y in zip(bounds, bounds[1:])]
        return [pa.array(np.diff(bounds)), pa.array(a), pa.array(b), pa.array(sketches, pa.binary())]

    return add_columns(docs, text, _FEATURES, work, keep)


def _hot_test(marks: np.ndarray | None):
    def test(signs: np.ndarray) -> np.ndarray:
        if marks is None:
            return np.zeros(len(signs), np.int64)
        place = (signs >> np.uint64(32)).astype(np.int64) & ((1 << HOT_BITS) - 1)
        return ((marks[place >> 3] >> (place & 7)) & 1).astype(np.int64)
    return test


def _signature_groups(texts: DataFrame, groups: int, marks: np.ndarray | None) -> DataFrame:
    """Signatures dealt to groups, packed: one row per step of text and group. Equal sets of a step
    give their signatures once."""
    hot = _hot_test(marks)

    def run(batches):
        for _, body, offsets in steps(batches, "text"):
            flat, bounds = shingle_sets(body, offsets)
            a, _ = set_keys(flat, bounds)
            sizes = np.diff(bounds)
            _, first = np.unique(a, return_index=True)
            first = np.sort(first[sizes[first] > 0])
            sub = np.concatenate([[0], np.cumsum(sizes[first])])
            index = np.arange(sub[-1]) + np.repeat(bounds[first] - sub[:-1], sizes[first])
            owner, sign = signatures(flat[index], sub, hot)
            if not len(owner):
                continue
            group = (sign % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((owner, group))
            owner, sign, group = owner[order], (sign[order] >> np.uint64(32)).astype(np.uint32), group[order]
            runs = np.flatnonzero(np.concatenate(
                [[True], (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])]))
            counts = np.diff(np.concatenate([runs, [len(owner)]])).astype(np.uint32)
            keys, of_run = a[first][owner[runs]], group[runs]
            edges = np.flatnonzero(np.concatenate([[True], of_run[1:] != of_run[:-1], [True]]))
            sign_at = np.concatenate([runs, [len(owner)]])
            rows = [(int(of_run[x]), sign[sign_at[x]:sign_at[y]].tobytes(), keys[x:y].tobytes(),
                     counts[x:y].tobytes()) for x, y in zip(edges, edges[1:])]
            g, s, k, c = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, pa.int32()), pa.array(s, pa.binary()), pa.array(k, pa.binary()),
                 pa.array(c, pa.binary())], names=["g", "signs", "sets", "counts"])

    return texts.mapInArrow(run, "g int, signs binary, sets binary, counts binary")


def _unpack(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (signature, set) rows of a group, sorted."""
    def joined(name, kind):
        return np.frombuffer(b"".join(group[name].to_pylist()), kind)

    signs = joined("signs", np.uint32)
    sets = np.repeat(joined("sets", np.int64), joined("counts", np.uint32))
    order = np.lexsort((sets, signs))
    signs, sets = signs[order], sets[order]
    fresh = np.concatenate([[True], (signs[1:] != signs[:-1]) | (sets[1:] != sets[:-1])])
    return signs[fresh], sets[fresh]


def _hot_places(group: pa.Table) -> pa.Table:
    signs, _ = _unpack(group)
    values, counts = np.unique(signs, return_counts=True)
    places = np.unique(values[counts > HOT].astype(np.int64) & ((1 << HOT_BITS) - 1))
    return pa.table({"place": places.astype(np.int32)})


def _heads(group: pa.Table) -> pa.Table:
    """(set, smallest set that shares a signature, number of signatures it heads)."""
    signs, sets = _unpack(group)
    runs = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]]))
    head = np.repeat(sets[runs], np.diff(np.concatenate([runs, [len(signs)]])))
    other = sets != head
    x, head = sets[other], head[other]
    order = np.lexsort((head, x))
    x, head = x[order], head[order]
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (head[1:] != head[:-1])])) if len(x) else []
    counts = np.diff(np.concatenate([first, [len(x)]])).astype(np.int64)
    return pa.table({"x": x[first], "head": head[first], "shared": counts})


def _marks(places: DataFrame) -> np.ndarray | None:
    """The bit map of hot signatures: 2^HOT_BITS bits, whatever the size of the table."""
    found = np.asarray(places.distinct().toArrow()["place"]).astype(np.int64)
    if not len(found):
        return None
    bits = np.zeros(1 << HOT_BITS, np.uint8)
    bits[found] = 1
    return np.packbits(bits, bitorder="little")


def candidate_heads(texts: DataFrame, shingles: int) -> DataFrame:
    """Stored (x, head, shared) rows over the keys of all sets of the column ``text``."""
    spark = texts.sparkSession
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shingles // GROUP_SIGNS + 1)
    places = _signature_groups(texts, groups, None).groupBy("g").applyInArrow(_hot_places, "place int")
    marks = _marks(places)
    heads = _signature_groups(texts, groups, marks).groupBy("g").applyInArrow(
        _heads, "x long, head long, shared long")
    return durable(heads.groupBy("x", "head").agg(F.sum("shared").alias("shared")))


_PROPOSAL = "x long, y long, distance double"


def _sketch_words(raw: list[bytes], size: int) -> np.ndarray:
    return np.array([fold(np.frombuffer(r, np.uint64), size) for r in raw]).reshape(len(raw), size)


def _hamming(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int64)


def _nearest(every: bool):
    """Proposals of one block: for each set of the asking side its nearest possible partner in another
    component, and the group head if possible; with ``every`` all possible partners."""
    def compare(group: pa.Table) -> pa.Table:
        asks = np.asarray(group["asks"])
        node, label, n = (np.asarray(group[c]) for c in ("node", "label", "n"))
        is_head = np.asarray(group["is_head"])
        raw = group["sketch"].to_pylist()
        width = np.array([len(r) // 8 for r in raw])
        xs, ys, ds = [], [], []
        for w in np.unique(width[asks]):
            for v in (w // 2, w, w * 2):
                left, right = np.flatnonzero(asks & (width == w)), np.flatnonzero(~asks & (width == v))
                if not len(left) or not len(right):
                    continue
                size = min(w, v)
                a, b = _sketch_words([raw[i] for i in left], size), _sketch_words([raw[i] for i in right], size)
                # folded further, a sketch still bounds the difference from below: a cheap first test
                short = max(1, size // 4)
                a4 = np.array([fold(r, short) for r in a])
                b4 = np.array([fold(r, short) for r in b])
                for i, u in enumerate(left):
                    most = max_difference(n[u], n[right])
                    fits = (4 * np.minimum(n[u], n[right]) >= 3 * np.maximum(n[u], n[right])) & (
                        label[right] != label[u]) & (node[right] != node[u])
                    j = np.flatnonzero(fits)
                    j = j[_hamming(a4[i], b4[j]) <= most[j]]
                    if not len(j):
                        continue
                    far = _hamming(a[i], b[j])
                    possible = far <= most[j]
                    j, far = j[possible], far[possible]
                    if not len(j):
                        continue
                    distance = far / (n[u] + n[right[j]])
                    pick = np.arange(len(j)) if every else np.unique(np.concatenate(
                        [[distance.argmin()], np.flatnonzero(is_head[right[j]])]))
                    xs.append(np.full(len(pick), node[u]))
                    ys.append(node[right[j[pick]]])
                    ds.append(distance[pick] - 1.0 * is_head[right[j[pick]]])
        if not xs:
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64()),
                             "distance": pa.array([], pa.float64())})
        return pa.table({"x": np.concatenate(xs), "y": np.concatenate(ys), "distance": np.concatenate(ds)})
    return compare


def _propose(members: DataFrame, labels: DataFrame | None, every: bool, first: bool) -> DataFrame:
    """Stored (x, y) proposals over the groups that still hold several components.

    Sets of a group's largest component don't ask, in the first round all do. Both sides are dealt in
    chunks, so a task holds two chunks at most. Without ``every`` a set proposes its nearest partner
    and, in the first round, its nearest group head.
    """
    if labels is not None:
        named = labels.select(F.col("node").alias("_n"), "component")
        members = members.join(named, F.col("node") == F.col("_n"), "left").drop("_n")
        members = durable(members.withColumn("label", F.coalesce("component", "node")).drop("component"))
    else:
        members = members.withColumn("label", F.col("node"))
    labelled = members.groupBy("head", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = labelled.groupBy("head").agg(
        F.max(F.struct("size", "label")).alias("top"), F.sum("size").alias("total"),
        F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select(
        F.col("head").alias("_head"), "top", F.col("total"))
    asking = F.lit(True) if first else (F.col("label") != F.col("top.label"))
    n_asks = F.col("total") if first else (F.col("total") - F.col("top.size"))
    chunks = lambda count: F.ceil(count / CHUNK).cast("int")
    sided = members.join(largest, F.col("head") == F.col("_head")).select(
        "head", "node", "is_head", "label", asking.alias("can_ask"), chunks(n_asks).alias("ask_chunks"),
        chunks(F.col("total")).alias("all_chunks"))
    mine = F.xxhash64("node", F.lit(7))
    asks = sided.filter("can_ask").select(
        "head", "node", "is_head", "label", F.lit(True).alias("asks"), F.pmod(mine, F.col("ask_chunks")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_chunks").cast("long") - 1)).alias("j"))
    answers = sided.select(
        "head", "node", "is_head", "label", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("ask_chunks").cast("long") - 1)).alias("i"),
        F.pmod(mine, F.col("all_chunks")).alias("j"))
    return asks.unionByName(answers.select(asks.columns))


def near_components(docs: DataFrame, text: str, ident: str) -> tuple[DataFrame, DataFrame]:
    """Stored features of every row (``id``, ``t`` of its text, ``n``, keys), and stored distinct sets
    (keys, ``node``, ``component``, which is a node too, and ``component_id``)."""
    plain = docs.select(F.col(ident).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                        F.md5(F.col(text).cast("string")).alias("t"))
    features = durable(shingle_features(plain, "text", ["id", "t"]))
    known = features.filter("n > 0")
    nodes = durable(known.groupBy("a", "b").agg(F.min("id").alias("id"), F.min(F.struct(
        "t", "n", "sketch")).alias("r")).select("a", "b", "id", "r.*").withColumn("node", F.monotonically_increasing_id()))
    shingles = features.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heads = candidate_heads(plain.select("text"), shingles)

    # (group, set) rows; a group is named by its head's key
    keyed = heads.select("head", F.col("x").alias("key")).unionByName(
        heads.select("head", F.col("head").alias("key")).distinct())
    members = durable(
        keyed.join(nodes.select(F.col("a").alias("_a"), "node"), F.col("key") == F.col("_a"))
        .select("head", "node", (F.col("key") == F.col("head")).alias("is_head")))
    sketches = nodes.select("node", "n", "sketch")

    verified, sets, labels = None, None, None
    for round_no in range(NEAREST_ROUNDS + 1):
        every, first = round_no == NEAREST_ROUNDS, round_no == 0
        dealt = _propose(members, labels, every, first)
        filled = dealt.join(sketches, "node")
        found = filled.groupBy("head", "i", "j").applyInArrow(_nearest(every), _PROPOSAL)
        if not every:
            kind = (F.col("distance") < 0).alias("to_head")
            found = found.groupBy("x", kind).agg(F.min_by("y", F.struct("distance", "y")).alias("y"))
        fresh = found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        fresh = durable(fresh)
        if fresh.isEmpty():
            if first:
                continue
            break
        wanted = fresh.select(F.explode(F.array("x", "y")).alias("node")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("node"), "node", "left_anti")
        more = durable(_sets(plain, wanted.join(nodes.select("node", "t"), "node")))
        sets = more if sets is None else sets.unionByName(more)
        links = durable(_verified(fresh, sets))
        verified = links if verified is None else verified.unionByName(links)
        if not every:
            # settled labels: sets of one group with two labels would give all their pairs in the last round
            labels = components(verified.select(F.col("x").alias("a"), F.col("y").alias("b")))
    if verified is None:
        named = nodes.withColumn("component", F.col("node"))
    else:
        final = components(verified.select(F.col("x").alias("a"), F.col("y").alias("b")))
        named = nodes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = durable(named.select("a", "b", "id", "node", "component"))
    ids = named.groupBy("component").agg(F.min("id").alias("component_id"))
    return features.drop("sketch"), named.join(ids, "component").select("a", "b", "node", "component", "component_id")


def _sets(plain: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, set) rows: the sorted shingles of the wanted (node, t) rows' texts."""
    def work(body, offsets):
        flat, bounds = shingle_sets(body, offsets)
        return [pa.array([flat[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary())]

    texts = plain.select("t", "text").join(wanted, "t").dropDuplicates(["node"]).select("node", "text")
    added = T.StructType([T.StructField("set", T.BinaryType())])
    return add_columns(texts, "text", added, work, ["node"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose exact similarity is 0.75 or more."""
    def run(batches):
        for batch in batches:
            a, b = batch.column("set_x"), batch.column("set_y")
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                one = np.frombuffer(a[i].as_buffer(), np.uint64)
                two = np.frombuffer(b[i].as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(two, one), len(two) - 1)
                both = int((two[at] == one).sum())
                good[i] = 100 * both >= 75 * (len(one) + len(two) - both)
            yield batch.select(["x", "y"]).filter(pa.array(good))

    one = sets.select(F.col("node").alias("x"), F.col("set").alias("set_x"))
    two = sets.select(F.col("node").alias("y"), F.col("set").alias("set_y"))
    return pairs.join(one, "x").join(two, "y").select("x", "y", "set_x", "set_y").mapInArrow(run, "x long, y long")


def near_texts(df: DataFrame, text: str = "text", ident: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with ``n_shingles`` and ``component_id`` (smallest id reachable by links, its own
    included)."""
    made = ("n_shingles", "component_id")
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    features, nodes = near_components(df, text, ident)
    if keep == [ident]:
        rows = features.select(F.struct(F.col("id").cast(df.schema[ident].dataType).alias(ident)).alias("row"),
                               "id", "n", "a", "b")
    else:
        packed = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                           F.col(ident).cast("long").alias("id"), F.col(text).alias("text"))
        rows = shingle_features(packed, "text", ["row", "id"]).drop("sketch")
    by_set = nodes.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "component_id")
    joined = rows.join(by_set, (F.col("n") > 0) & (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left")
    return joined.select("row.*", F.col("n").alias("n_shingles"), F.when(
        F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def drop_near_copies(df: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row of each component: the one with the smallest id (rows without an id last), of several texts
    under that id the one with the smallest digest, and one of rows equal in id and text. Rows without
    words stay."""
    def named(row_id, digest):
        return F.concat_ws(":", F.coalesce(row_id.cast("string"), F.lit("-")), digest)

    features, nodes = near_components(df, text, ident)
    decided = features.filter("n > 0").join(nodes.select("a", "b", "component"), ["a", "b"])
    best = decided.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("r"))
    keep = best.select(named(F.col("r.id"), F.col("r.t")).alias("_gone"))
    gone = durable(decided.select(named(F.col("id"), F.col("t")).alias("_gone")).distinct().join(keep, "_gone", "left_anti"))
    own, body = private(df, "_row"), F.coalesce(F.col(text).cast("string"), F.lit(""))
    left = df.withColumn(own, F.when(
        F.btrim(body, F.lit(WHITE)) != "", named(F.col(ident).cast("long"), F.md5(body))).otherwise(
        F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))))
    gone = gone.withColumnRenamed("_gone", private(left, "_gone"))
    left = left.join(gone, F.col(own) == F.col(gone.columns[0]), "left_anti")
    return left.dropDuplicates([own]).drop(own)
