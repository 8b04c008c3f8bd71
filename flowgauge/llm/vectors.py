"""What the operators on embeddings share."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import ship, spread_sample

ship(__name__)

#: Vectors that an index is fitted on at most.
SAMPLE = 20_000


def usable(vector: Column) -> Column:
    """Whether a vector is there, has finite components only, and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def sample(vectors: DataFrame, id: str = "id", column: str = "vec", size: int = SAMPLE) -> np.ndarray:
    """Different vectors among ``size`` rows of the smallest id hashes, of the most frequent length."""
    rows = spread_sample(vectors, F.xxhash64(id), size).select(F.col(column).alias("v")).collect()
    lengths = Counter(len(r.v) for r in rows)
    if not lengths:
        return np.zeros((0, 0))
    most = max(lengths, key=lambda n: (lengths[n], n))
    return np.unique(np.array([r.v for r in rows if len(r.v) == most], float), axis=0)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
