"""Units of text that a tokenizer treats independently, with bounded memory."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

#: Entries a worker keeps; the table is emptied when it is full.
CACHE_ENTRIES = 400_000
#: Longer units are computed each time, so that the table's memory is bounded.
CACHE_LENGTH = 64


class Cache(dict):
    """``cache[unit]`` computes a value once and keeps it while there is room."""

    def __init__(self, compute: Callable[[str], object]):
        super().__init__()
        self.compute = compute

    def __missing__(self, unit: str):
        value = self.compute(unit)
        if len(unit) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[unit] = value
        return value


def text_of(value: pa.Scalar) -> str:
    """A text that was read as binary; null is empty, invalid UTF-8 is U+FFFD."""
    return (value.as_py() or b"").decode("utf-8", "replace")


def chunks(long_docs: DataFrame, chunk: int, overlap: int = 0) -> DataFrame:
    """Rows ``(uid, doc, n_bytes, idx, part)``: overlapping chunks of each text, in characters."""
    kind = long_docs.schema["doc"].dataType.simpleString()
    arrow_kind = long_docs.select("doc").limit(0).toArrow().schema.field("doc").type

    def cut(batches):
        for batch in batches:
            for uid, doc, text in zip(*(batch.column(c) for c in ("uid", "doc", "text")), strict=True):
                whole, n_bytes = text_of(text), len(text.as_py() or b"")
                for idx, at in enumerate(range(0, max(len(whole), 1), chunk)):
                    part = whole[at : at + chunk + overlap].encode()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([uid.as_py()], pa.int64()),
                            pa.array([doc.as_py()], arrow_kind),
                            pa.array([n_bytes], pa.int64()),
                            pa.array([idx], pa.int32()),
                            pa.array([part], pa.binary()),
                        ],
                        ["uid", "doc", "n_bytes", "idx", "part"],
                    )

    return long_docs.mapInArrow(cut, f"uid long, doc {kind}, n_bytes long, idx int, part binary")
