"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, connected components.

Exact copies become one row with a count. Every vector gets, in each of several tables, the signs of
its products with random hyperplanes; vectors of one label whose signs agree in a table share a bucket.
Bits grow with the logarithm of the rows, tables so that a pair at the threshold is missed in all of
them with probability ``miss`` at most. Buckets are compared in blocks of at most ``BLOCK`` vectors by
matrix products in double precision; a large bucket is cut into blocks and every pair of blocks is a
task of its own, so no task holds a whole hot bucket. A pair counts in the first table in which it
meets, so nothing has to be made distinct; tasks return one count per vector and a spanning forest of
their links, never pairs.

Results for odd rows: vectors that are null, empty, all zero, or hold a null or non-finite component,
and rows with a null label, link with nothing; vectors of different lengths don't link; equal rows link
as separate vectors; a row without an id has no links, a null component and isn't kept; an empty table
gives an empty result; columns named like those the join makes stay as they are, columns named like a
result are replaced.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.common import private
from patio.llm.components import components
from patio.session import durable

COSINE = 0.93
MISS = 0.01
BUCKET = 64
BLOCK = 1024
SEED = 11


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def plan_tables(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits per table and number of tables."""
    bits = max(6, math.ceil(math.log2(max(rows, 1) / BUCKET + 1)))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def unit_rows(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def sign_codes(units: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """(rows, tables) integers of sign bits."""
    planes = np.random.default_rng([seed, units.shape[1]]).normal(size=(units.shape[1], tables * bits))
    signs = (units @ planes > 0).reshape(len(units), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def _hashed(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    schema = T.StructType(reps.schema.fields + [T.StructField("codes", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            codes = np.zeros((batch.num_rows, tables), np.int64)
            dims = np.asarray(batch.column("dim"))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                codes[at] = sign_codes(unit_rows(_matrix(batch.column("vector").take(pa.array(at)))), bits, tables)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables), pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=schema.names)

    return reps.mapInArrow(run, schema)


LINKS = "node long, n long, low long"


def _compare(cosine: float):
    """One block, or the pairs across two blocks, of one bucket: link counts and a forest."""
    def compare(group: pa.Table) -> pa.Table:
        nodes, table = np.asarray(group["node"]), group["table"][0].as_py()
        by = np.argsort(nodes, kind="stable")
        nodes = nodes[by]
        copies, half = np.asarray(group["copies"])[by], np.asarray(group["half"])[by]
        codes = _matrix(group["codes"]).astype(np.int64)[by]
        units = unit_rows(_matrix(group["vector"])[by])
        near = units @ units.T >= cosine
        np.fill_diagonal(near, False)
        if group["first"][0].as_py() != group["second"][0].as_py():
            near &= half[:, None] != half[None, :]
        counted = near.copy()
        for t in range(table):
            counted &= codes[:, t][:, None] != codes[:, t][None, :]
        linked = near.any(axis=1)
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label, np.where(near, label[None, :], len(nodes)).min(axis=1))
            low = low[low]
            if (low == label).all():
                break
            label = low
        return pa.table({"node": nodes[linked], "n": (counted @ copies)[linked].astype(np.int64),
                         "low": nodes[label[linked]]})
    return compare


def near_vectors(df: DataFrame, vector: str = "embedding", label: str = "label", ident: str = "vec_id",
                 cosine: float = COSINE, miss: float = MISS, keep: list[str] | None = None) -> DataFrame:
    """The kept columns with ``n_links``, ``component_id`` (smallest id reachable) and ``kept``."""
    made = ("n_links", "component_id", "kept")
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    good, a, b = (private(df, n) for n in ("_good", "_a", "_b"))
    v, same = F.col(vector), F.col(label)
    marked = df.withColumns({
        good: usable(v) & same.isNotNull() & F.col(ident).isNotNull(),
        a: F.xxhash64(v, same), b: F.xxhash64(F.lit(1), v, same)})
    # exact copies as one row: the smallest id stands for them
    reps = durable(
        marked.filter(good).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(
            F.min(F.struct(F.col(ident).cast("long").alias("node"), same.alias("label"), v.alias("vector"))).alias("r"),
            F.count(F.lit(1)).alias("copies"))
        .select("a", "b", "r.*", "copies", F.size("r.vector").alias("dim")))
    bits, tables = plan_tables(reps.count(), cosine, miss)
    hashed = durable(_hashed(reps.select("node", "label", "vector", "copies", "dim"), bits, tables))
    bucket = ["label", "dim", "table", "code"]
    members = hashed.select("node", "label", "dim", F.posexplode("codes").alias("table", "code"))
    sizes = members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumn(
        "blocks", F.ceil(F.col("size") / (BLOCK // 2)).cast("int"))
    placed = hashed.select("*", F.posexplode("codes").alias("table", "code")).join(
        durable(sizes), bucket).withColumn(
        "half", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int"))
    # task (i, i) holds the pairs inside block i, task (i, j) those across i and j
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
        "first": F.least("half", "other"), "second": F.greatest("half", "other")})
    compared = durable(
        spread.groupBy(*bucket, "first", "second")
        .applyInArrow(_compare(cosine), LINKS))
    counts = compared.groupBy("node").agg(F.sum("n").alias("_n"))
    groups = components(compared.select(F.col("node").alias("a"), F.col("low").alias("b")))
    ra, rb, links, low = (private(df, n) for n in ("_ra", "_rb", "_links", "_component"))
    per_rep = durable(
        reps.select("a", "b", F.col("node").alias("_node"), "copies")
        .join(counts, F.col("_node") == counts["node"], "left").drop("node")
        .join(groups, F.col("_node") == groups["node"], "left").drop("node")
        .select(F.col("a").alias(ra), F.col("b").alias(rb),
                (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias(links),
                F.coalesce("component", "_node").alias(low)))
    out = marked.join(per_rep, F.col(good) & (F.col(a) == F.col(ra)) & (F.col(b) == F.col(rb)), "left")
    component = F.coalesce(F.col(low), F.col(ident).cast("long"))
    return out.select(
        *keep, F.coalesce(F.col(links), F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col(ident) == component, F.lit(False)).alias("kept"))
