"""Token counts of whole texts with the libraries of public tokenizers, in Arrow batches.

Texts are cut into parts, the parts dealt to batches of about equal bytes, each batch encoded by one
call, and only the lengths come back. A long text is cut at safe boundaries: before white space that
follows a visible ASCII character. No piece of the known word patterns goes from such a character to
white space, so the parts have as many tokens as the whole. Where a tokenizer gives no such guarantee
(other word patterns, added tokens with white space, pieces that hold a space inside) texts stay whole.

Results for odd rows: null and empty texts have 0 bytes and 0 tokens; a text without a safe boundary is
encoded in one piece, however long; repeated rows give repeated results; an empty table gives an empty
one. Given columns named like a result are replaced by it, others are carried.
"""

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patio.llm.batches import add_columns

#: Bytes after which a text is cut at the next safe boundary, and bytes encoded by one call.
PART_BYTES = 1 << 16
BATCH_BYTES = 1 << 18

#: Word patterns that never go from a visible character to white space.
SAFE_PATTERNS = {r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
SPACE = "▁"

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True


class JsonCounter:
    """Counts with the library of JSON tokenizers. Special strings inside texts count as it sees them;
    nothing is added, truncated or padded."""

    drop_space = False

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(data)
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        steps = spec.get("pre_tokenizer") or {}
        steps = steps.get("pretokenizers", [steps])
        first = steps[0]
        known = (first.get("type") == "ByteLevel" and first.get("use_regex", True)
                 or first.get("type") == "Split" and first["pattern"].get("Regex") in SAFE_PATTERNS)
        self.splits = known and not any(
            t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])

    def count(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceCounter:
    """Counts with the library of piece models. A part after a cut loses its space, which the library
    puts before every text by itself."""

    drop_space = True

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_proto=data)
        inside = any(SPACE in self.pieces.id_to_piece(i).lstrip(SPACE)
                     for i in range(self.pieces.get_piece_size()))
        self.splits = not inside and (
            self.pieces.encode("a b") == self.pieces.encode("a") + self.pieces.encode("b"))

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.pieces.encode(texts, num_threads=1)]


def counter(name: str, data: bytes) -> JsonCounter | PieceCounter:
    """The counter of a tokenizer file, chosen by the file's ending."""
    if name.endswith(".json"):
        return JsonCounter(data)
    if name.endswith(".model"):
        return PieceCounter(data)
    raise ValueError(f"no library for {name}")


def safe_cuts(body: np.ndarray, single_space: bool, part_bytes: int) -> np.ndarray:
    """Places inside one text where it is cut: the first safe boundary at or after each part's end."""
    if len(body) <= part_bytes:
        return np.zeros(0, np.int64)
    if single_space:  # a space between two visible characters
        safe = _VISIBLE[body[:-2]] & (body[1:-1] == 32) & _VISIBLE[body[2:]]
    else:
        safe = _VISIBLE[body[:-1]] & ((body[1:] == 32) | (body[1:] == 10))
    places = np.flatnonzero(safe) + 1
    at = np.searchsorted(places, np.arange(part_bytes, len(body), part_bytes))
    return np.unique(places[at[at < len(places)]])


def count_parts(tool: JsonCounter | PieceCounter, body: np.ndarray, offsets: np.ndarray,
                part_bytes: int = PART_BYTES, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Tokens of each text of a step."""
    starts, ends, owners = [], [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        cuts = (a + safe_cuts(body[a:b], tool.drop_space, part_bytes)).tolist() if tool.splits else []
        starts += [a] + [c + tool.drop_space for c in cuts]
        ends += cuts + [b]
        owners += [i] * (len(cuts) + 1)
    data = body.tobytes()
    counts = np.zeros(len(starts), np.int64)
    sizes = np.cumsum(np.array(ends) - np.array(starts)) if starts else np.zeros(0, np.int64)
    at = 0
    while at < len(starts):
        done = sizes[at - 1] if at else 0
        end = max(int(np.searchsorted(sizes, done + batch_bytes, "right")), at + 1)
        counts[at:end] = tool.count([data[a:b].decode(errors="replace")
                                     for a, b in zip(starts[at:end], ends[at:end])])
        at = end
    return np.bincount(owners, weights=counts, minlength=len(offsets) - 1).astype(np.int64)


def count_tokens(df: DataFrame, tokenizer: str, limit: int = 512, text: str = "text", keep=None) -> DataFrame:
    """The kept columns (all by default), ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``tokenizer`` is the path of a .json or .model file. The driver reads it, and tasks get its bytes.
    """
    with open(tokenizer, "rb") as f:
        data = f.read()

    def worker():
        tool = counter(tokenizer, data)

        def work(body, offsets):
            counts = count_parts(tool, body, offsets)
            return [pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)]
        return work

    added = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                          T.StructField("over_limit", T.BooleanType())])
    return add_columns(df, text, added, worker, keep, per_task=True)
