"""Text to vector, by expressions or by a user's model."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embedding import DEFAULT_DIM, bucket_counts, unit_vector, word_buckets
from ..functions.text import words


def embed(
    df: DataFrame,
    text: str = "text",
    fn: Callable[[list[str]], list[list[float]]] | None = None,
    dim: int = DEFAULT_DIM,
    out: str = "embedding",
) -> DataFrame:
    """Adds an ``array<float>``; without ``fn`` words are hashed into ``dim`` buckets.

    ``fn`` gets a batch of texts and runs in the executors.
    """
    if fn is not None:

        @F.pandas_udf("array<float>")
        def model(texts: pd.Series) -> pd.Series:
            return pd.Series([[float(x) for x in v] for v in fn(texts.tolist())])

        return df.withColumn(out, model.asNondeterministic()(F.coalesce(text, F.lit(""))))
    hashed = df.withColumn("_buckets", word_buckets(words(F.coalesce(text, F.lit(""))), dim))
    counted = hashed.withColumn("_counts", bucket_counts("_buckets", dim))
    return counted.withColumn(out, unit_vector("_counts")).drop("_buckets", "_counts")
