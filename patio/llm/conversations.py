"""Cheapest repair of conversations to the role order ``system? (user assistant)+`` or nothing.

Each row becomes one letter: the initial of its role, in upper case if its text breaks off, or ``x`` if
it must go (blank, or role and text seen earlier). The letters of a conversation are its signature, with
``$`` at the end. Equal signatures are repaired once. Signatures sorted from their ends form an automaton
that shares suffixes: a node is a suffix, and going from one signature to the next only the nodes in front
of their common suffix are made. A node holds, per grammar state, the cost to the end and the first edit
of the cheapest, ASCII-least way. From a state every edit leads to one other state, so the least of the
cheapest first edits at each node gives the least audit.

Rows are ordered by turn (nulls first), role, the text's first 64 characters and its digest. They are dealt
to tasks by ranges of (conversation, turn, ...), so one conversation may span many tasks: each piece gives
a 4 x 4 matrix of costs between states, the matrices of a conversation (one per task at most) give every
piece's costs at its end and its start state, and pieces are then repaired like whole signatures. Equal
rows are counted before that. Texts are joined to the rows that stay, and digests are streamed.

Results for odd rows: null roles and texts count as one space; a null turn comes first; rows without a
conversation id form one conversation; equal rows are duplicates of the first; a conversation whose rows
all go is repaired to nothing; an empty table gives empty results; columns beside the four aren't read, so
their names can't clash.
"""

import hashlib
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.common import WHITE
from patio.session import durable

#: Costs of the edits, and what a row that breaks off adds unless it is deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

#: Grammar states: nothing yet, after the system turn, a user turn is open, a pair is complete. The state
#: after a new user or assistant turn, and after a kept turn by its initial.
STATES = range(4)
TURN = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
COMPLETE = (0, 3)
ROLES = {2: "user", 3: "assistant"}  # by the state after the turn
FAR = 1 << 40


def moves(letter: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits that use up the letter."""
    if letter == "$":
        return [("", 0, state)] if state in COMPLETE else []
    out = [("D", DELETE, state)]
    if letter != "x":
        extra = TRUNCATED if letter.isupper() else 0
        if (state, letter.lower()) in KEPT:
            out.append(("K", extra, KEPT[state, letter.lower()]))
        out.append(("R", REROLE + extra, TURN[state]))
    return out


class SuffixAutomaton:
    """The nodes of the last signature's suffixes, shared with the signature before it."""

    def __init__(self):
        self.rules: dict = {}
        self.reverse, self.end = "", None
        self.costs: list[tuple[int, ...]] = []
        self.edits: list[tuple[str | None, ...]] = []

    def load(self, signature: str, end: tuple[int, ...]) -> None:
        """Makes the nodes of a signature after whose last letter the states cost ``end``."""
        reverse = signature[::-1]
        same = 0
        if end == self.end:
            top = min(len(reverse), len(self.reverse))
            while same < top and reverse[same] == self.reverse[same]:
                same += 1
        self.reverse, self.end = reverse, end
        del self.costs[same:], self.edits[same:]
        costs = self.costs[-1] if same else end
        for letter in reverse[same:]:
            costs, edits = self._node(letter, costs)
            self.costs.append(costs)
            self.edits.append(edits)

    def _node(self, letter, after):
        low = min(after)
        key = (letter, *(min(c - low, FAR) for c in after))
        if key not in self.rules:
            self.rules[key] = self._rule(letter, key[1:])
        costs, edits = self.rules[key]
        return tuple(min(c + low, FAR) for c in costs), edits

    def _rule(self, letter, after):
        costs = [min([cost + after[to] for _, cost, to in moves(letter, q)], default=FAR) for q in STATES]
        for _ in range(2):  # at most two inserted turns in a row are of use
            costs = [min(costs[q], INSERT + costs[TURN[q]]) for q in STATES]
        edits = []
        for q in STATES:
            ways = [(edit, cost + after[to]) for edit, cost, to in moves(letter, q)]
            ways.append(("I", INSERT + costs[TURN[q]]))
            edits.append(min((e for e, c in ways if c == costs[q] < FAR), default=None))
        return tuple(costs), tuple(edits)

    def start_costs(self) -> tuple[int, ...]:
        return self.costs[-1] if self.costs else self.end

    def walk(self, state: int):
        """(audit, last state, rows that stay): the number of the row in the signature, none if it is
        inserted, and its new role, none if it keeps its own."""
        audit, places, roles = [], [], []
        at, n = 0, len(self.edits)
        while at < n:
            edit = self.edits[n - 1 - at][state]
            if edit is None:
                return None, None, [], []
            audit.append(edit)
            if edit == "K":
                state = KEPT[state, self.reverse[n - 1 - at].lower()]
                places.append(at)
                roles.append(None)
            elif edit in ("I", "R"):
                state = TURN[state]
                places.append(at if edit == "R" else None)
                roles.append(ROLES[state])
            at += edit != "I"
        return "".join(audit), state, places, roles


_JOB = ["signature", "end", "start"]
_SOLVED = T.StructType([
    T.StructField("signature", T.StringType()), T.StructField("end", T.ArrayType(T.LongType())),
    T.StructField("start", T.IntegerType()), T.StructField("cost", T.LongType()),
    T.StructField("audit", T.StringType()), T.StructField("last", T.IntegerType()),
    T.StructField("places", T.ArrayType(T.LongType())), T.StructField("roles", T.ArrayType(T.StringType()))])


def _arrays(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)


def solve(jobs: DataFrame, rows: bool = True) -> DataFrame:
    """Cost, audit, last state and rows of each distinct (signature, end, start), one automaton per range
    of reversed signatures. Without ``rows`` only cost and last state are given."""
    sorted_jobs = jobs.select(*_JOB).distinct().repartitionByRange(F.reverse("signature")).sortWithinPartitions(
        "end", F.reverse("signature"), "start")

    def run(batches):
        automaton = SuffixAutomaton()
        for batch in batches:
            out = []
            for job in batch.to_pylist():
                automaton.load(job["signature"], tuple(job["end"]))
                audit, last, places, roles = automaton.walk(job["start"])
                cost = automaton.start_costs()[job["start"]]
                out.append((*job.values(), cost, audit if rows else None, last, places if rows else [],
                            roles if rows else []))
                if len(out) >= 1000 or len(places) > 100_000:
                    yield _arrays(out, _SOLVED)
                    out = []
            yield _arrays(out, _SOLVED)

    return sorted_jobs.mapInArrow(run, _SOLVED)


def _matrices(pieces: DataFrame) -> DataFrame:
    """Costs from every state at a piece's start to every state at its end, row by row."""
    schema = T.StructType([pieces.schema["conv"], pieces.schema["part"],
                           T.StructField("costs", T.ArrayType(T.LongType()))])
    units = [tuple(0 if q == to else FAR for q in STATES) for to in STATES]

    def run(batches):
        for batch in batches:
            out = []
            for piece in batch.to_pylist():
                columns = []
                for end in units:
                    automaton = SuffixAutomaton()
                    automaton.load(piece["signature"], end)
                    columns.append(automaton.start_costs())
                out.append((piece["conv"], piece["part"], [columns[to][q] for q in STATES for to in STATES]))
            yield _arrays(out, schema)

    return pieces.select("conv", "part", "signature").mapInArrow(run, schema)


def _chain_ends(pieces: pd.DataFrame) -> pd.DataFrame:
    """Costs at the end of every piece of one conversation, from the last piece on."""
    pieces = pieces.sort_values("part", ascending=False)
    end, ends = [0] * len(STATES), []
    for costs in pieces["costs"]:
        ends.append(end)
        end = [min(int(costs[4 * q + to]) + end[to] for to in STATES) for q in STATES]
    return pieces.assign(end=ends)[["conv", "part", "end"]]


def _chain_starts(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of every piece of one conversation, from the first piece on."""
    pieces = pieces.sort_values("part")
    state, starts = 0, []
    for lasts in pieces["lasts"]:
        starts.append(state)
        state = int(lasts[state])
    return pieces.assign(start=starts)[["conv", "part", "start"]]


def _linked(pieces: DataFrame) -> DataFrame:
    """Costs at the end and the state at the start of the pieces of conversations that span tasks."""
    ends = _matrices(pieces).groupBy("conv").applyInPandas(
        _chain_ends, T.StructType([pieces.schema["conv"], pieces.schema["part"], _SOLVED["end"]]))
    ended = durable(pieces.join(ends, ["conv", "part"]))
    tried = ended.withColumn("start", F.explode(F.array(*map(F.lit, STATES))))
    lasts = tried.join(solve(tried, rows=False), _JOB).groupBy("conv", "part").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("start", F.coalesce("last", F.lit(-1)).alias("last")))),
        lambda s: s["last"]).alias("lasts"))
    starts = lasts.groupBy("conv").applyInPandas(
        _chain_starts, T.StructType([pieces.schema["conv"], pieces.schema["part"], _SOLVED["start"]]))
    return ended.join(starts, ["conv", "part"])


def _key(*columns: Column) -> Column:
    return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Key columns and the text of every row. ``conv`` names the conversation, and equal rows have
    equal ``row``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    named = df.select(conversation_key(conv).alias("conv"),
                      F.col(f"`{turn}`").cast("long").alias("turn"),
                      F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), body.alias("text"))
    dig = named.withColumn("digest", F.sha2("text", 256))
    return dig.withColumn("row", _key(F.col("conv"), F.col("turn"), F.col("role"), F.col("digest")))


def _counted(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number, letter and faults."""
    seen = F.rtrim("text", F.lit(WHITE))
    keys = ["row", "conv", "turn", "role", F.substring("text", 1, 64).alias("head"), "digest",
            (seen == "").alias("blank"), (~F.right(seen, F.lit(1)).isin(*".!?")).alias("cut")]
    runs = rows.groupBy(*keys).count()
    first = runs.groupBy(_key(F.col("conv"), F.col("role"), F.col("digest"))).agg(
        F.min_by("row", F.struct(F.col("turn").isNotNull(), "turn")).alias("row"))
    marked = runs.join(first.select("row", F.lit(True).alias("first")), "row", "left").withColumn(
        "fresh", F.coalesce("first", F.lit(False)) & ~F.col("blank"))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return marked.select(
        "row", "conv", "turn", "role", "head", "digest", "count", initial.alias("initial"),
        F.when(~F.col("fresh"), "x").when(F.col("cut"), F.upper(known)).otherwise(known).alias("letter"),
        F.when(F.col("blank"), F.col("count")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).otherwise(F.col("count") - F.col("fresh").cast("long")).alias("duplicate"),
        (F.col("fresh") & F.col("cut")).cast("long").alias("truncated"))


def _placed(runs: DataFrame, parts: int | None) -> DataFrame:
    """Rows dealt to ranges, each with its place in its conversation's piece of the range and the number
    of forbidden neighbours up to it."""
    order = [F.col("turn").asc_nulls_first(), "role", "head", "digest"]
    dealt = runs.repartitionByRange(*([parts] if parts else []), "conv", *order).withColumn(
        "part", F.spark_partition_id())
    piece = Window.partitionBy("conv", "part").orderBy(*order)
    before = F.sum("count").over(piece.rowsBetween(Window.unboundedPreceding, -1))
    pair = F.concat(F.lag("initial").over(piece), "initial")
    # equal rows next to each other are never in order
    return dealt.withColumn("place", F.coalesce(before, F.lit(0))).withColumn(
        "illegal", F.col("count") - 1 + F.when(pair.isin("su", "ua", "au"), 0).when(pair.isNotNull(), 1).otherwise(0))


def _pieces(placed: DataFrame) -> DataFrame:
    letters = F.array_sort(F.collect_list(F.struct("place", "letter", "count")))
    return placed.groupBy("conv", "part").agg(
        F.array_join(F.transform(letters, lambda s: F.concat(s["letter"], F.repeat(F.lit("x"), (s["count"] - 1).cast("int")))),
                     "").alias("signature"),
        F.sum("illegal").alias("illegal"), F.min_by("initial", "place").alias("opens"),
        F.max_by("initial", "place").alias("closes"))


@dataclass
class Repaired:
    """``conversations``: gaps, faults, cost and audit of each conversation. ``rows``: the rows that stay or
    are inserted, with their role and text, in the order of (part, number) within a conversation. Both name
    a conversation by ``conv``, see ``conversation_key``."""

    conversations: DataFrame
    rows: DataFrame


def conversation_key(conv: str) -> Column:
    """The name of a conversation in repaired tables: "=" and its id, or nothing if it has none."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{conv}`").cast("string")), F.lit(""))


def repair_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", parts: int | None = None) -> Repaired:
    """Finds each row's first fault and the cheapest edits; see the module."""
    rows = _rows(df, conv, turn, role, text)
    placed = durable(_placed(_counted(rows), parts))
    pieces = durable(_pieces(placed))

    along = Window.partitionBy("conv").orderBy("part")
    border = F.concat(F.lag("closes").over(along), "opens")
    marks = durable(pieces.drop("signature").select(
        "conv", "part", (F.count("*").over(Window.partitionBy("conv")) > 1).alias("several"),
        F.lead("part").over(along).isNull().alias("ends"),
        (F.col("illegal") + F.when(border.isin("su", "ua", "au"), 0).when(border.isNotNull(), 1).otherwise(0)).alias("illegal")))
    closed = pieces.select("conv", "part", "signature").join(marks.drop("illegal"), ["conv", "part"]).withColumn(
        "signature", F.concat("signature", F.when(F.col("ends"), "$").otherwise("")))
    nothing = F.array(*[F.lit(0).cast("long") for _ in STATES])
    jobs = closed.filter("NOT several").select("conv", "part", "signature", nothing.alias("end"), F.lit(0).alias("start"))
    if not marks.filter("several").isEmpty():
        spanning = durable(closed.filter("several").select("conv", "part", "signature"))
        jobs = jobs.unionByName(_linked(spanning).select(jobs.columns))
    solved = durable(jobs.join(solve(jobs), _JOB).select("conv", "part", "cost", "audit", "places", "roles"))

    turns = placed.groupBy("conv", "turn").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    faults = turns.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    in_order = F.array_sort(F.collect_list(F.struct("part", "audit")))
    edits = solved.groupBy("conv").agg(
        F.min_by("cost", "part").alias("cost"),
        F.array_join(F.transform(in_order, lambda s: s["audit"]), "").alias("audit"))
    order = marks.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    conversations = faults.join(order, "conv").join(edits, "conv")

    stay = solved.select("conv", "part", F.posexplode(F.arrays_zip("places", "roles")).alias("number", "s")).select(
        "conv", "part", "number", F.col("s.places").alias("place"), F.col("s.roles").alias("new_role"))
    keyed = stay.join(placed.select("conv", "part", "place", "row", "role", "turn"), ["conv", "part", "place"], "left")
    bodies = rows.groupBy("row").agg(F.max("text").alias("text"))
    repaired = keyed.join(bodies, "row", "left").select(
        "conv", "part", "number", "turn", F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("place").isNull().alias("inserted"),
        (F.col("place").isNotNull() & F.col("new_role").isNotNull()).alias("reroled"))
    return Repaired(conversations, repaired)


def conversation_digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's ``role:text`` lines. A digest is sequential, so a conversation's
    lines pass through one task, as a stream that is never held."""
    schema = T.StructType([T.StructField("conv", T.StringType()), T.StructField("sha256", T.StringType())])

    def run(batches):
        name, state = None, None
        for batch in batches:
            out = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv != name:
                    if state:
                        out.append((name, state.hexdigest()))
                    name, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            yield _arrays(out, schema)
        if state:
            yield _arrays([(name, state.hexdigest())], schema)

    lines = rows.select("conv", F.concat_ws(":", "role", "text").alias("line"), "part", "number")
    return lines.repartition("conv").sortWithinPartitions("conv", "part", "number").select(
        "conv", "line").mapInArrow(run, schema)
