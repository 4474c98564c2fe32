"""Texts of an Arrow batch as one byte array, cut into steps of bounded size."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.common import private

#: Bytes of text that are worked on at once; a longer single text is worked on alone.
STEP_BYTES = 1 << 21

#: The six bytes that separate words.
IS_WHITE = np.zeros(256, bool)
IS_WHITE[[9, 10, 11, 12, 13, 32]] = True


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in a row, and n + 1 offsets; null rows are empty."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(batches, text: str, step_bytes: int = STEP_BYTES):
    """(batch slice, bytes, offsets) of consecutive rows holding about ``step_bytes`` of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        body, offsets = flat_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + step_bytes, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield (batch.slice(at, end - at), body[offsets[at]:offsets[end]],
                   offsets[at:end + 1] - offsets[at])
            at = end


def code_points(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points before each byte of ``offsets``."""
    starts = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
    return starts[offsets]


def add_columns(df: DataFrame, text: str, added: T.StructType, work, keep: list[str] | None = None,
                per_task: bool = False) -> DataFrame:
    """The kept columns (all by default) and new ones that ``work(body, offsets)`` computes from the
    texts, as one Arrow array per new column. Columns of the same names are replaced. Rows stay in
    their tasks: nothing is shuffled. Spark bounds the bytes of a batch by itself. With ``per_task``, ``work()`` is called once in every task and gives
    the function."""
    names = {f.name.lower() for f in added.fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    body = private(df, "_text")
    schema = T.StructType([df.schema[c] for c in kept] + added.fields)

    def run(batches):
        compute = work() if per_task else work
        for part, data, offsets in steps(batches, body):
            carried = [part.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*carried, *compute(data, offsets)], names=schema.names)

    wide = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias(body))
    return wide.mapInArrow(run, schema)
