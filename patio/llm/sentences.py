"""SentencePiece encoding and decoding by a batched Viterbi search in NumPy.

A text is cut at places that no piece crosses (before white space, around characters that are in no
piece), and each distinct word of a batch is encoded once. All substrings of all new words are hashed;
lengths grow together and only prefixes of pieces go on, so few substrings are probed. The probes
search the sorted keys of the pieces. Words of equal length then advance together, one position at a
time: the best way to every position is a vectorised maximum over piece lengths, kept as a back
pointer.

Unigram models maximise the sum of scores. For BPE models the score of a step is 0 or minus infinity:
a piece may follow the last piece of the prefix only if merging by rank gives back exactly that pair;
one way passes at every position, and it is what the merges give. Pairs once judged are kept in a hash
table.

Characters that are in no piece become byte pieces, or the unknown piece in models without them.
Models with a character map are refused.

Results for odd rows: null and empty texts give no tokens; a text that holds the word-boundary sign
itself is decoded with a space in its place, as in the library; repeated rows give repeated results;
whole texts are encoded, however long.
"""

import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.batches import add_columns
from patio.llm.hashing import BASE, INVERSE, mix

#: Fixed values of the model file's format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"

#: Characters of new words that are encoded at once, words kept by a task, bits of the number of judged
#: pairs kept by a task, ids decoded at once.
STEP_CHARS = 400_000
KEEP_WORDS = 400_000
JUDGED_BITS = 21
STEP_IDS = 250_000
_NONE = np.int64(1) << 40


def _fields(data: bytes):
    """(number, value) of a message in the protocol-buffer wire format."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at:at + size]
        at += size


@dataclass
class PieceModel:
    """The pieces of a model file and what the search needs of them."""

    pieces: list[str]
    scores: np.ndarray
    types: np.ndarray
    kind: int = UNIGRAM
    dummy_prefix: bool = True
    squeeze: bool = True
    _built: dict = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> "PieceModel":
        with open(path, "rb") as f:
            data = f.read()
        pieces, scores, types, options = [], [], [], {"kind": UNIGRAM, "dummy_prefix": True, "squeeze": True}
        for number, value in _fields(data):
            if number == 1:
                one = dict(_fields(value))
                pieces.append(one.get(1, b"").decode())
                scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
                types.append(one.get(3, NORMAL))
            elif number == 2:
                options["kind"] = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("models with a character map are not supported")
                options["dummy_prefix"] = bool(spec.get(3, 1))
                options["squeeze"] = bool(spec.get(4, 1))
        if options["kind"] not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return cls(pieces, np.array(scores), np.array(types), **options)

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    def build(self) -> "PieceModel":
        """Numbers the tokens by merge order (single characters first) and makes the tables."""
        usable = [i for i, t in enumerate(self.types) if t in (NORMAL, USER) and self.pieces[i]]
        single = [i for i in usable if len(self.pieces[i]) == 1]
        longer = sorted((i for i in usable if len(self.pieces[i]) > 1), key=lambda i: (-self.scores[i], i))
        order = single + longer
        text = {self.pieces[i]: n for n, i in enumerate(order)}
        v = len(order)  # the number of the unknown character
        left, right = np.arange(v + 1), np.arange(v + 1)
        reachable = np.ones(v + 1, bool)
        pairs = {}
        for n in range(len(single), v):
            piece = self.pieces[order[n]]
            for k in range(1, len(piece)):
                a, b = text.get(piece[:k]), text.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * (v + 1) + b] = n
        if self.kind == BPE:
            for n in range(len(single), v):
                last = _last_merge(self.pieces[order[n]], text, pairs, v)
                reachable[n] = last is not None
                if last:
                    left[n], right[n] = last
        prefixes = {}
        for piece, n in text.items():
            for k in range(1, len(piece)):
                prefixes.setdefault(piece[:k], -1)
            prefixes[piece] = n if reachable[n] else prefixes.get(piece, -1)
        keys = np.array([_text_key(p) for p in prefixes], np.uint64)
        by = np.argsort(keys)
        pair_keys = np.array(sorted(pairs), np.int64)
        alphabet = set("".join(text))
        loose = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in alphabet)
        rest = f"[^{SPACE}{loose}]+"
        byte_ids = np.full(256, -1)
        for i, t in enumerate(self.types):
            if t == BYTE:
                byte_ids[int(self.pieces[i][1:-1], 16)] = i
        unknown = next((i for i, t in enumerate(self.types) if t == UNKNOWN), 0)
        raw = [b"" if t == CONTROL else bytes([int(p[1:-1], 16)]) if t == BYTE
               else " ⁇ ".encode() if t == UNKNOWN else p.replace(SPACE, " ").encode()
               for p, t in zip(self.pieces, self.types)]
        self._built = dict(
            v=v, ids=np.array(order + [unknown]), left=left, right=right, keys=keys[by],
            tokens=np.array(list(prefixes.values()), np.int64)[by], longest=max(map(len, text)),
            pair_keys=pair_keys, pair_to=np.array([pairs[k] for k in pair_keys.tolist()], np.int64),
            word=f"{SPACE}*{rest}|{SPACE}+" + (f"|[{loose}]" if loose else ""),
            token_scores=np.append(self.scores[order], min(self.scores[order], default=0) - 10),
            bytes=byte_ids, raw=np.frombuffer(b"".join(raw), np.uint8),
            raw_at=np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
        return self


def _last_merge(piece: str, text: dict, pairs: dict, v: int):
    """The two tokens whose merge gives the piece, merging its characters by rank; else None."""
    tokens = [text.get(c, v) for c in piece]
    while len(tokens) > 1:
        best, at = min((pairs.get(a * (v + 1) + b, _NONE), i) for i, (a, b) in enumerate(zip(tokens, tokens[1:])))
        if best == _NONE:
            return None
        if len(tokens) == 2:
            return (tokens[0], tokens[1]) if best == text[piece] else None
        tokens[at:at + 2] = [best]
    return None


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _sums(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the rolling hash, and the factors that free a substring of its place."""
    up = np.full(len(points), BASE, np.uint64)
    down = np.full(len(points) + 1, INVERSE, np.uint64)
    if len(points):
        up[0] = 1
    down[0] = 1
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * np.cumprod(up), out=sums[1:])
    return sums, np.cumprod(down)


def _text_key(piece: str) -> int:
    sums, down = _sums(_points(piece))
    return int(mix(sums[-1:] * down[0] + np.uint64(len(piece)))[0])


class Encoder:
    """Encodes texts with a built model; keeps a bounded number of encoded words."""

    def __init__(self, model: PieceModel):
        self.model, self.b = model, model._built
        self.word = re.compile(self.b["word"])
        self._forget()
        self.judged = np.full(1 << JUDGED_BITS, -1, np.int64)  # keys of pairs
        self.verdict = np.zeros(1 << JUDGED_BITS, bool)

    def _forget(self):
        self.known: dict[str, int] = {}
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the n + 1 offsets of the texts."""
        if len(self.known) > KEEP_WORDS:
            self._forget()
        words, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.word.findall(self.model.normalise(text))
            counts[i] = len(found)
            words += found
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        at = 0
        while at < len(new):
            chars, end = 0, at
            while end < len(new) and (end == at or chars + len(new[end]) <= STEP_CHARS):
                chars += len(new[end])
                end += 1
            flat, sizes = self._words(new[at:end])
            for w in new[at:end]:
                self.known[w] = len(self.known)
            self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
            at = end
        slots = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        starts = np.cumsum(self.sizes) - self.sizes
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(starts[slots] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.concatenate([[0], ends])[bounds]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        b = self.b
        points = _points("".join(words))
        lengths = np.array([len(w) for w in words])
        bases = np.cumsum(lengths) - lengths
        total, longest = len(points), min(b["longest"], int(lengths.max()))
        room = np.repeat(bases + lengths, lengths) - np.arange(total)
        # every substring that is a piece, lengths growing together; a character in no piece is unknown
        sums, down = _sums(points)
        live, firsts, sizes, tokens = np.arange(total), [], [], []
        for size in range(1, longest + 1):
            live = live[room[live] >= size]
            keys = mix((sums[live + size] - sums[live]) * down[live] + np.uint64(size))
            at = np.minimum(np.searchsorted(b["keys"], keys), len(b["keys"]) - 1)
            hit = b["keys"][at] == keys
            token = np.where(hit, b["tokens"][at], -1)
            if size == 1:
                token = np.where(token < 0, b["v"], token)
            whole = token >= 0
            firsts.append(live[whole])
            tokens.append(token[whole])
            sizes.append(np.full(len(tokens[-1]), size))
            live = live[hit]
        first, size, token = np.concatenate(firsts), np.concatenate(sizes), np.concatenate(tokens)
        # in the order in which they are needed: words of equal length, then the place where they end
        width = np.repeat(lengths, lengths)
        kinds, group = np.unique(lengths, return_inverse=True)
        step_at = np.cumsum(kinds) - kinds
        offset = width[first] - room[first]
        turn = np.repeat(step_at[group], lengths)[first] + offset + size - 1
        n_steps = int(kinds.sum())
        by = np.argsort(turn.astype(np.uint16) if n_steps < 65536 else turn, kind="stable")
        first, size, token, fresh = first[by], size[by], token[by], (offset == 0)[by]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(turn, minlength=n_steps))])
        last = np.zeros(total, np.int64)  # token of the best way to a character, and its length
        back = np.ones(total, np.int64)
        value = np.full(total, -np.inf)
        for k in range(n_steps):
            f, z, t, start = (x[bounds[k]:bounds[k + 1]] for x in (first, size, token, fresh))
            before, end = f - 1, f + z - 1
            if self.model.kind == BPE:
                fits = start | self._follows(last[before], t)
                f, z, t, end = f[fits], z[fits], t[fits], end[fits]
                value[end] = 0
            else:
                score = np.where(start, 0, value[before]) + b["token_scores"][t]
                np.maximum.at(value, end, score)
                best = score == value[end]
                z, t, end = z[best][::-1], t[best][::-1], end[best][::-1]  # the shortest piece of equals
            last[end], back[end] = t, z
        # follow the pointers of all words together, from their ends
        at, alive, picked = bases + lengths - 1, np.arange(len(words)), []
        while len(alive):
            picked.append((alive, at[alive]))
            at[alive] -= back[at[alive]]
            alive = alive[at[alive] >= bases[alive]]
        owner = np.concatenate([p[0] for p in picked])
        place = np.concatenate([p[1] for p in picked])
        by = np.argsort(place)
        owner, place = owner[by], place[by]
        tokens = last[place]
        ids = b["ids"][tokens].astype(np.int32)
        strange = np.flatnonzero(tokens == b["v"])
        if len(strange) and (b["bytes"] >= 0).all():
            parts = [b["bytes"][list(chr(points[place[k]]).encode())] for k in strange]
            repeats = np.ones(len(ids), np.int64)
            repeats[strange] = [len(p) for p in parts]
            owner = np.repeat(owner, repeats)
            spread = np.repeat(tokens == b["v"], repeats)
            ids = np.repeat(ids, repeats)
            ids[spread] = np.concatenate(parts)
        return ids, np.bincount(owner, minlength=len(words))

    def _follows(self, a: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Whether merging by rank leaves the pair of tokens as it is."""
        keys = a * (self.b["v"] + 1) + c
        slots = self._slots(keys)
        miss = self.judged[slots] != keys
        out = self.verdict[slots]
        if miss.any():
            fresh, back = np.unique(keys[miss], return_inverse=True)
            n = self.b["v"] + 1
            judged = self._judge(fresh // n, fresh % n)
            out[miss] = judged[back]
            slots = self._slots(fresh)
            self.judged[slots] = fresh
            self.verdict[slots] = judged[np.searchsorted(fresh, self.judged[slots])]
        return out

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - JUDGED_BITS)).astype(np.int64)

    def _merged(self, a: np.ndarray, c: np.ndarray) -> np.ndarray:
        keys, to = self.b["pair_keys"], self.b["pair_to"]
        if not len(keys):
            return np.full(len(a), _NONE)
        key = a * (self.b["v"] + 1) + c
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, to[at], _NONE)

    def _judge(self, a: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Takes the two tokens apart, later merge first, and looks at every stage whether a merge
        across the border would have come before the merge that is taken back."""
        left, right = self.b["left"], self.b["right"]
        good = np.ones(len(a), bool)
        limit = np.full(len(a), _NONE)
        open_ = np.arange(len(a))
        a, c = a.copy(), c.copy()
        while len(open_):
            good[open_[self._merged(a, c) < limit]] = False
            going = good[open_]
            open_, a, c, limit = open_[going], a[going], c[going], limit[going]
            # the later merge is taken back first; at equal rank the right one, as merges go from the left
            a_whole, c_whole = right[a] == a, left[c] == c
            take_a = ((a > c) | c_whole) & ~a_whole
            take_c = ~take_a & ~c_whole
            done = ~take_a & ~take_c
            limit = np.where(take_a, a, c + 1)
            a, c = np.where(take_a, right[a], a), np.where(take_c, left[c], c)
            open_, a, c, limit = open_[~done], a[~done], c[~done], limit[~done]
        return good


def encode_texts(df: DataFrame, model: PieceModel, text: str = "text", into: str = "ids", keep=None) -> DataFrame:
    """The kept columns and the ids of each text's pieces."""
    model.build()

    def worker():
        encoder = Encoder(model)

        def work(body, offsets):
            data = body.tobytes()
            texts = [data[a:b].decode(errors="replace") for a, b in zip(offsets, offsets[1:])]
            ids, bounds = encoder.encode(texts)
            return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
        return work

    added = T.StructType([T.StructField(into, T.ArrayType(T.IntegerType()))])
    return add_columns(df, text, added, worker, keep, per_task=True)


def decode_ids(df: DataFrame, model: PieceModel, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The table and the text of each row's ids; ids outside the model count as unknown pieces."""
    model.build()
    raw, at, n = model._built["raw"], model._built["raw_at"], len(model.pieces)
    unknown = int(model._built["ids"][-1])

    def decode(values: np.ndarray, bounds: np.ndarray) -> list[str]:
        values = np.where((values >= 0) & (values < n), values, unknown)
        sizes = at[values + 1] - at[values]
        ends = np.cumsum(sizes)
        data = raw[np.repeat(at[values] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        cuts = np.concatenate([[0], ends])[bounds]
        out = [data[a:b].decode(errors="replace") for a, b in zip(cuts, cuts[1:])]
        return [t[1:] if model.dummy_prefix and t.startswith(" ") else t for t in out]

    kept = [c for c in df.columns if c.lower() != into.lower()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(into, T.StringType())])

    def run(batches):
        for batch in batches:
            lists = batch.column(len(kept))
            lists = pc.fill_null(lists, []) if lists.null_count else lists
            bounds = np.asarray(lists.offsets).astype(np.int64)
            row = 0
            while row < batch.num_rows:
                end = int(np.searchsorted(bounds, bounds[row] + STEP_IDS, "right")) - 1
                end = min(max(end, row + 1), batch.num_rows)
                values = lists.values.slice(bounds[row], bounds[end] - bounds[row]).fill_null(-1)
                texts = decode(np.asarray(values).astype(np.int64), bounds[row:end + 1] - bounds[row])
                columns = [c.slice(row, end - row) for c in batch.columns[:len(kept)]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=schema.names)
                row = end

    wide = df.select(*[F.col(f"`{c}`") for c in kept], F.col(ids).cast("array<int>").alias("_ids"))
    return wide.mapInArrow(run, schema)
