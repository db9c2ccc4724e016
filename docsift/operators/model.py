"""One primitive for model calls: a user's function over batches of prompts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stored import stored

# Fixed default temperatures per kind of call.
TEMPERATURE_DEFAULT = 0.2
TEMPERATURE_MAIL = 0.3
TEMPERATURE_JUDGE = 0.0
TEMPERATURE_QA = 0.7
TEMPERATURE_RECEIPT = 0.1
MAX_RETRIES = 3

Model = Callable[[list[str], float], list[str]]


def _caller(fn: Model, temperature: float, retries: int, on_error: str, backoff: float, batch_size: int):
    def attempt(prompts):
        import time

        last = None
        for n in range(retries + 1):
            try:
                replies = list(fn(prompts, temperature))
                if len(replies) != len(prompts):
                    raise ValueError("the model must give one reply per prompt")
                return replies
            except Exception as e:  # noqa: BLE001 - any failure of the user's function counts
                last = e
                if n < retries and backoff > 0:
                    time.sleep(backoff * 2**n)
        raise last

    def call(prompts):
        replies, errors = [], []
        for i in range(0, len(prompts), batch_size):
            part = prompts[i : i + batch_size]
            try:
                replies += attempt(part)
                errors += [None] * len(part)
            except Exception:  # noqa: BLE001
                if on_error == "raise":
                    raise
                for p in part:  # find the prompts that fail on their own
                    try:
                        replies += attempt([p])
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001
                        replies.append(None)
                        errors.append(str(e) or type(e).__name__)
        return replies, errors

    def run(batches):
        for pdf in batches:
            replies, errors = call(pdf["_prompt"].tolist())
            yield pdf[["_key"]].assign(_reply=replies, _error=errors)

    return run


def complete(
    df: DataFrame,
    prompt: str,
    fn: Model,
    temperature: float = TEMPERATURE_DEFAULT,
    out: str = "reply",
    retries: int = MAX_RETRIES,
    on_error: str = "raise",
    backoff: float = 1.0,
    batch_size: int = 64,
    keep: bool = False,
) -> DataFrame:
    """Adds ``out`` and ``out_error``: the reply to each row's prompt.

    Equal prompts are sent once and share the reply; null prompts are not sent. A prompt
    that most rows share is reduced before the shuffle; its rows meet the reply in a plain
    join, which the adaptive skew join splits. ``keep=True`` stores the replies in the
    checkpoint folder, so a paid model is not called again when the result is used twice
    or an executor is lost.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error is raise or null")
    keyed = df.withColumn("_key", F.sha2(F.col(prompt), 256))
    distinct = (
        keyed.where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.first(F.col(prompt)).alias("_prompt"))
    )
    schema = T.StructType(
        [
            T.StructField("_key", T.StringType()),
            T.StructField("_reply", T.StringType()),
            T.StructField("_error", T.StringType()),
        ]
    )
    replies = distinct.mapInPandas(_caller(fn, temperature, retries, on_error, backoff, batch_size), schema)
    if keep:
        replies = stored(replies)
    joined = keyed.join(replies, on="_key", how="left")
    return joined.select(*df.columns, F.col("_reply").alias(out), F.col("_error").alias(f"{out}_error"))
