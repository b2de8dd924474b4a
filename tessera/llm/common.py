"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import checkpoint_dir

#: Rows turned into Python objects at a time inside an Arrow batch.
SLICE_ROWS = 512


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage (a lost executor costs one task, not the whole history)
    and gives the planner true sizes, so that it broadcasts a side only when
    its bytes are under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Memo(dict):
    """Bounded cache of a pure function; it starts afresh when full."""

    def __init__(self, fn: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.fn, self.limit, self.longest = fn, limit, longest

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def per_worker(key: tuple, make: Callable):
    """``make()``, kept for the life of the Python worker under ``key``.

    Functions reach the workers by value, so a module's globals do not last
    from task to task; ``sys`` does. Only the latest key is kept, so caches of
    several operators never add up in one worker.
    """
    held = getattr(sys, "_tessera_worker", None)
    if held is None or held[0] != key:
        sys._tessera_worker = None
        held = sys._tessera_worker = (key, make())
    return held[1]


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def tokenizer_file(name_or_path: str) -> str:
    """A path as it is; a bare name is looked up among the public tokenizers."""
    if os.path.dirname(name_or_path):
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def load_tokenizer(name_or_path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(name_or_path))
