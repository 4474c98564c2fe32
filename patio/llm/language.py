"""Language identification by a small convolutional network over bytes.

Byte embeddings, convolutions of widths 2, 3 and 4, the maximum over a window's positions, and a
softmax layer, trained in NumPy on a bounded sample of labelled texts (``per_language`` texts of each
language, ``windows_per_text`` windows each). Every text is cut into windows of ``WINDOW`` bytes that
cover all of it; a text's verdict is the length-weighted mean of its windows' log-probabilities.

For scoring, a convolution over bytes is a sum of table rows: one row per pair of bytes. Windows go
through in blocks, so memory is bounded however long a text is.

Results for odd rows: ``und`` with score 0 if the text is null or has no letter, or if nothing was
learned; ties go to the first label in order; repeated rows give repeated results.
"""

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.batches import add_columns
from patio.llm.common import private

WINDOW = 256
WIDTHS = (2, 3, 4)
REACH = max(WIDTHS) - 1
#: Windows that are worked on at once.
PER_BLOCK = 128
#: A-Z count as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
UNKNOWN = "und"


class ByteNetwork:
    """``labels`` in order; ``score`` gives one probability vector per text."""

    def __init__(self, labels: list[str], dim: int = 8, filters: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.labels, self.dim, self.filters = labels, dim, filters
        self.params = {"embed": rng.normal(0, 0.5, (256, dim))}
        for w in WIDTHS:
            self.params[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * dim), (w, dim, filters))
            self.params[f"b{w}"] = np.zeros(filters)
        n = len(WIDTHS) * filters
        self.params["out"] = rng.normal(0, 1 / np.sqrt(n), (n, len(labels)))
        self.params["bias"] = np.zeros(len(labels))
        self.params = {k: v.astype(np.float32) for k, v in self.params.items()}

    def fit(self, windows: np.ndarray, classes: np.ndarray, epochs: int = 8,
            batch: int = 64, rate: float = 0.005, seed: int = 7) -> "ByteNetwork":
        """Adam on windows (n, WINDOW + REACH bytes)."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.params.items()}
        square = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(classes))
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for at in range(0, len(order), batch):
                pick = order[at:at + batch]
                grads = self._gradients(windows[pick], classes[pick])
                step += 1
                for k, g in grads.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.params[k] -= (now * (mean[k] / (1 - 0.9 ** step))
                                       / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return self

    def _gradients(self, x, classes):
        p, n = self.params, len(x)
        size = x.shape[1] - REACH
        vectors = p["embed"][x]
        pooled, best = [], []
        for w in WIDTHS:
            total = sum(vectors[:, k:k + size] @ p[f"w{w}"][k] for k in range(w))
            where = total.argmax(axis=1)
            best.append(where)
            pooled.append(np.take_along_axis(total, where[:, None], 1)[:, 0] + p[f"b{w}"])
        features = np.concatenate(pooled, axis=1)
        active = np.maximum(features, 0)
        logits = active @ p["out"] + p["bias"]
        prob = np.exp(logits - logits.max(axis=1, keepdims=True))
        prob /= prob.sum(axis=1, keepdims=True)
        delta = prob
        delta[np.arange(n), classes] -= 1
        delta /= n
        grads = {"out": active.T @ delta, "bias": delta.sum(axis=0)}
        back = (delta @ p["out"].T) * (features > 0)
        d_embed = np.zeros_like(p["embed"])
        rows = np.arange(n)[:, None]
        for i, w in enumerate(WIDTHS):
            g = back[:, i * self.filters:(i + 1) * self.filters]
            grads[f"b{w}"] = g.sum(axis=0)
            dw = np.empty_like(p[f"w{w}"])
            for k in range(w):
                at = best[i] + k
                dw[k] = np.einsum("nfd,nf->df", vectors[rows, at], g)
                np.add.at(d_embed, x[rows, at], g[:, :, None] * p[f"w{w}"][k].T[None])
            grads[f"w{w}"] = dw
        grads["embed"] = d_embed
        return grads

    @cached_property
    def _tables(self):
        """Rows added per pair of bytes (as uint16) and per single byte, for each width."""
        p = self.params
        part = {(w, k): p["embed"] @ p[f"w{w}"][k] for w in WIDTHS for k in range(w)}
        pair = lambda w, k: (part[w, k][:, None] + part[w, k + 1][None]).reshape(65536, -1)
        return {"2": pair(2, 0) + p["b2"], "3a": pair(3, 0) + p["b3"], "3b": part[3, 2],
                "4a": pair(4, 0) + p["b4"], "4b": pair(4, 2)}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def _pool(self, windows: np.ndarray) -> np.ndarray:
        """Largest filter values of each window (n, WINDOW + REACH bytes)."""
        t = self._tables
        pairs = (windows[:, :-1].astype(np.intp) << 8) | windows[:, 1:]
        first, third = pairs[:, :WINDOW], pairs[:, 2:WINDOW + 2]
        pooled = []
        for parts in ([("2", first)], [("3a", first), ("3b", windows[:, 2:WINDOW + 2].astype(np.intp))],
                      [("4a", first), ("4b", third)]):
            total = np.take(t[parts[0][0]], parts[0][1], axis=0)
            for name, index in parts[1:]:
                total += np.take(t[name], index, axis=0)
            half = WINDOW // 2
            while half:  # halves against each other: long runs of numbers, not one row at a time
                total = np.maximum(total[:, :half], total[:, half:])
                half //= 2
            pooled.append(total[:, 0])
        return np.concatenate(pooled, axis=1)

    def score(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities (texts, labels); a text of no bytes gets equal ones."""
        n, lengths = len(offsets) - 1, np.diff(offsets)
        source = np.concatenate([LOWER[body], np.zeros(1, np.uint8)])
        counts = -(-lengths // WINDOW)
        text_of = np.repeat(np.arange(n), counts)
        nth = np.arange(len(text_of)) - (np.cumsum(counts) - counts)[text_of]
        starts = offsets[text_of] + WINDOW * nth
        stops = offsets[text_of + 1]
        logs = np.zeros((len(starts), len(self.labels)))
        reach = np.arange(WINDOW + REACH)
        for at in range(0, len(starts), PER_BLOCK):
            index = starts[at:at + PER_BLOCK, None] + reach
            index = np.where(index < stops[at:at + PER_BLOCK, None], index, len(body))  # past the text: 0
            active = np.maximum(self._pool(source[index]), 0)
            logits = active @ self.params["out"] + self.params["bias"]
            logits -= logits.max(axis=1, keepdims=True)
            logs[at:at + PER_BLOCK] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        sizes = np.minimum(WINDOW, stops - starts)
        total = np.zeros((n, len(self.labels)))
        for k in range(len(self.labels)):
            total[:, k] = np.bincount(text_of, logs[:, k] * sizes, minlength=n)
        total /= np.maximum(lengths, 1)[:, None]
        prob = np.exp(total - total.max(axis=1, keepdims=True)) if n else total
        return prob / prob.sum(axis=1, keepdims=True) if n else prob


def training_windows(labelled: DataFrame, text: str, label: str, ident: str, per_language: int,
                     windows_per_text: int) -> list:
    """(label, window) rows of about ``per_language`` texts each, chosen by a hash of the id, with
    windows from seeded places of the whole text."""
    known = labelled.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in known.groupBy(label).count().collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col(label) == name, F.lit(min(1.0, per_language / n))).otherwise(share)
    ticket = F.pmod(F.xxhash64(F.col(ident).cast("string")), F.lit(1_000_000)) / 1e6
    spots = F.transform(F.sequence(F.lit(1), F.lit(windows_per_text)), lambda k: F.substring(
        F.col(text),
        (F.pmod(F.xxhash64(F.col(ident).cast("string"), k), F.greatest(F.length(text) - WINDOW // 2, F.lit(1)))
         + 1).cast("int"), F.lit(WINDOW)))
    rows = known.filter(ticket < share).select(label, F.explode(spots)).collect()
    return sorted(tuple(r) for r in rows)


def train_language(labelled: DataFrame, text: str = "text", label: str = "lang", ident: str = "doc_id",
                   per_language: int = 500, windows_per_text: int = 3, **fit) -> ByteNetwork | None:
    """The network, or None without labelled rows."""
    rows = training_windows(labelled, text, label, ident, per_language, windows_per_text)
    if not rows:
        return None
    labels = sorted({r[0] for r in rows})
    windows = np.zeros((len(rows), WINDOW + REACH), np.uint8)
    for i, (_, window) in enumerate(rows):
        data = np.frombuffer(window.encode()[:WINDOW], np.uint8)
        windows[i, :len(data)] = LOWER[data]
    classes = np.array([labels.index(r[0]) for r in rows])
    return ByteNetwork(labels).fit(windows, classes, **fit)


def predict_language(df: DataFrame, model: ByteNetwork | None, text: str = "text", into: str = "lang_pred",
                     score: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, the predicted label and its probability."""
    flag = private(df, "_letters")
    flagged = df.withColumn(flag, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in (into.lower(), score.lower())]
    added = T.StructType([T.StructField(into, T.StringType()), T.StructField(score, T.DoubleType())])

    def work(body, offsets):
        n = len(offsets) - 1
        if model is None:
            return [pa.array([UNKNOWN] * n), pa.array(np.zeros(n))]
        prob = model.score(body, offsets)
        names = pa.array(model.labels).take(pa.array(prob.argmax(axis=1)))
        return [names, pa.array(np.clip(prob.max(axis=1), 0, 1))]

    out = add_columns(flagged, text, added, work, [*kept, flag])
    return out.withColumns({
        into: F.when(F.col(flag), F.col(into)).otherwise(UNKNOWN),
        score: F.when(F.col(flag), F.col(score)).otherwise(0.0)}).drop(flag)
