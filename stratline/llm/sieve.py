"""A filter of fixed size for keys that may be wanted, put before a join on whole texts.

It lets every wanted key pass and nearly no other while the keys are few for its size; when
they are many it lets more pass and the join that follows does the work. Results never
depend on it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

from stratline.llm import texts

WORDS = 1 << 18  # 64-bit words: 2 MB


def marks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word of each key and four bits in it."""
    h = texts.mix(keys.astype(np.int64).view(np.uint64))
    bits = np.zeros(len(h), np.uint64)
    for k in range(4):
        bits |= texts.U(1) << ((h >> texts.U(24 + 6 * k)) & texts.U(63))
    return (h & texts.U(WORDS - 1)).astype(np.int64), bits


class Sieve:
    """Built from a column of 64-bit keys; at most WORDS rows reach the driver."""

    def __init__(self, df: DataFrame, key: str):
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                word, bits = marks(batch.column(0).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

        rows = df.select(F.col(key).cast("bigint").alias("key")).where("key is not null").mapInArrow(run, "word bigint, bits bigint")
        words = np.zeros(WORDS, np.uint64)
        for r in rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
            words[r.word] = np.int64(r.bits).view(np.uint64)
        self.words = df.sparkSession.sparkContext.broadcast(words)

    def has(self, keys: np.ndarray) -> np.ndarray:
        word, bits = marks(keys)
        return (self.words.value[word] & bits) == bits

    def column(self, key: Column) -> Column:
        """Whether a key, never null, may be wanted."""

        def maybe(keys: pd.Series) -> pd.Series:
            return pd.Series(self.has(keys.to_numpy()))

        return F.pandas_udf(maybe, BooleanType())(key)

    def __getstate__(self):
        return {"words": self.words}
