"""SentencePiece encoding and decoding with a table of distinct chunks.

If no piece of a vocabulary has a white space marker behind another character, no merge crosses the place before a run of
markers. A text then falls into chunks (a run of markers and the characters up to the next run), each of which is segmented on
its own: once, when it first appears. The ids of a text are the table's entries for its chunks, joined by position. A vocabulary
with other pieces, or one that rewrites texts before it cuts them, is refused. The way back is the library's own.

A null text is empty: its ids are the end id alone. Null ids decode to the empty text. Repeated rows are encoded as often as they
come, an empty table gives no rows, and the other columns of the input ride along unchanged; one that is named like the new
column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import steps

#: Fixed value: the character that stands for a space.
MARKER = "▁"
#: Bytes of chunks and ids that a worker remembers at most, besides those of one step. Longer chunks are not remembered.
TABLE_BYTES = 96 << 20
LONG_CHUNK = 1000
#: Bytes of text and number of ids that a worker takes apart at once; a single longer text is taken at once.
STEP_BYTES = 1 << 20
STEP_IDS = 1 << 18

_CHUNK = re.compile(" +[^ ]*")
_INNER_MARKER = re.compile(f"[^{MARKER}]{MARKER}")


class ChunkTable:
    """Ids of distinct chunks, by the text behind the chunk's first marker.

    Chunks are kept in two halves: once the newer is full it becomes the older, whose chunks move back as they come again. So
    common chunks stay known, and rare ones are forgotten.
    """

    def __init__(self, model_path: str, table_bytes: int = TABLE_BYTES):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model_path)
        _refuse_other_vocabularies(self.model)
        self.table_bytes, self.held = table_bytes, 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The chunks of a text without their first marker; the model puts one before the text."""
        if not text:
            return []
        text = text.replace(MARKER, " ")
        if "  " in text or text[0] == " ":
            return [chunk[1:] for chunk in _CHUNK.findall(" " + text)]
        return text.split(" ")

    def _segment(self, chunks: list[str]) -> list[bytes]:
        found = self.model.encode(chunks, num_threads=1)
        # The model marks no empty text, so a marker alone is looked up.
        lone = [self.model.piece_to_id(MARKER)]
        return [np.array(ids if chunk else lone, "<i4").tobytes() for chunk, ids in zip(chunks, found)]

    def __call__(self, batch: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, without an end id."""
        if 2 * self.held > self.table_bytes:
            self.older, self.known, self.held = self.known, {}, 0
        split = [self.chunks(text) for text in batch]
        found = [list(map(self.known.get, chunks)) for chunks in split]
        lacking = [i for i, ids in enumerate(found) if None in ids]
        new = {chunk for i in lacking for chunk, ids in zip(split[i], found[i]) if ids is None}
        fresh = {chunk: self.older[chunk] for chunk in new if chunk in self.older}
        unknown = [chunk for chunk in new if chunk not in fresh]
        fresh.update(zip(unknown, self._segment(unknown)))
        for i in lacking:
            found[i] = [fresh[chunk] if ids is None else ids for chunk, ids in zip(split[i], found[i])]
        for chunk, ids in fresh.items():
            if len(chunk) <= LONG_CHUNK:
                self.known[chunk] = ids
                self.held += len(chunk) + len(ids) + 200
        return [b"".join(ids) for ids in found]


def _refuse_other_vocabularies(model) -> None:
    from sentencepiece import sentencepiece_model_pb2 as parts

    spec = parts.ModelProto.FromString(model.serialized_model_proto())
    # Kind 4 is a piece that the user defined, which is cut out of a text before all else.
    if any(_INNER_MARKER.search(p.piece) or p.type == 4 for p in spec.pieces):
        raise ValueError("a piece of this vocabulary crosses a white space marker")
    rules = spec.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
        raise ValueError("this vocabulary rewrites texts before it cuts them")
    if spec.trainer_spec.treat_whitespace_as_suffix or model.is_unknown(model.piece_to_id(MARKER)):
        raise ValueError("this vocabulary does not mark white space in front")


@lru_cache(maxsize=1)
def chunk_table(model_path: str) -> ChunkTable:
    """One table for all tasks that a Python worker runs."""
    return ChunkTable(model_path)


def lists(ids: list[bytes]) -> pa.ListArray:
    stops = np.cumsum([0, *(len(i) // 4 for i in ids)])
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def _added(df: DataFrame, column: str, kind: T.DataType, needed: str, run) -> DataFrame:
    """``df`` and one more column, which ``run`` makes of the steps of column ``needed``."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    work = df.select(F.struct(F.lit(0).alias("_"), *kept).alias("row"), F.col(f"`{needed}`").alias("needed"))
    schema = T.StructType([work.schema["row"], T.StructField("made", kind)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from run(batch)

    made = work.mapInArrow(task, schema)
    return made.select(*(F.col(f"row.`{c}`") for c in df.columns if c != column), F.col("made").alias(column))


def _steps_of_ids(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose lists hold at most ``STEP_IDS`` ids, or one row."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("needed")), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + STEP_IDS, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode(docs: DataFrame, model_path: str, column: str = "ids", end_id: bool = True) -> DataFrame:
    """``docs`` with the ids of each text; ``model_path`` is opened by every worker and must be a file of the installation."""
    end = end_id

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model_path)
        last = np.array([table.model.eos_id()], "<i4").tobytes() if end else b""
        for step in steps(batch, "needed", STEP_BYTES):
            ids = [i + last for i in table([t or "" for t in step.column("needed").to_pylist()])]
            yield pa.RecordBatch.from_arrays([step.column("row"), lists(ids)], ["row", "made"])

    return _added(docs, column, T.ArrayType(T.IntegerType()), "text", run)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``rows`` with the text that the model makes of the list in column ``ids``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model_path)
        for step in _steps_of_ids(batch):
            texts = table.model.decode([i or [] for i in step.column("needed").to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([step.column("row"), pa.array(texts, pa.string())], ["row", "made"])

    return _added(rows, column, T.StringType(), ids, run)
