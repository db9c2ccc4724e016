"""Scoring of answers: pairing, three judged scores, flags, roll-ups and checks."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions.scores import FLAG_THRESHOLD, has_empty, low_score, mean_score, score_from_reply
from .model import TEMPERATURE_JUDGE, Model, complete
from .order import RANGE_ROWS, global_index, range_size
from .stored import stored

METRICS = ("faithfulness", "relevancy", "correctness")

# Fixed targets stated for the metrics.
TARGETS = {
    "faithfulness": 0.85,
    "relevancy": 0.80,
    "context_precision": 0.75,
    "correctness": 0.70,
    "field_f1": 0.90,
    "exact_match": 0.75,
}


def attach_answers(qa: DataFrame, answers: DataFrame, on: str = "question") -> DataFrame:
    """Each QA pair with its answer; a failed call (no row, or a row with ``error``) is
    kept as the answer ``ERROR: ...`` with an empty context.

    One row per QA pair, repeated questions included. Of several answers to a question one
    without an error wins, then the least by error, answer and context.
    """
    error = F.col("error").cast("string") if "error" in answers.columns else F.lit(None).cast("string")
    given = F.struct(
        error.isNotNull().alias("failed"), error.alias("error"), F.col("answer").alias("answer"), F.col("retrieved_context").alias("context")
    )
    a = answers.groupBy(on).agg(F.min(given).alias("_given"))
    failed = F.coalesce(F.col("_given.failed"), F.lit(True))
    reason = F.coalesce("_given.error", F.lit("no answer"))
    return qa.join(a, on=on, how="left").select(
        *qa.columns,
        F.when(failed, F.concat(F.lit("ERROR: "), reason)).otherwise(F.coalesce("_given.answer", F.lit(""))).alias("rag_answer"),
        F.when(failed, "").otherwise(F.coalesce("_given.context", F.lit(""))).alias("retrieved_context"),
    )


def judge(
    rows: DataFrame,
    fn: Model,
    row_id: str = "id",
    question: str = "question",
    truth: str = "ground_truth",
    answer: str = "rag_answer",
    context: str = "retrieved_context",
    answer_chars: int | None = None,
    context_chars: int | None = None,
    **call,
) -> DataFrame:
    """Adds ``faithfulness, relevancy, correctness``, each from 0 to 1.

    Rows with an empty input score 0 and are not sent. All three prompts of all rows go
    through one batch call, whole unless ``answer_chars`` or ``context_chars`` cut them. ``call`` is
    passed on (retries, on_error, keep, ...); with ``keep`` the rows are stored too, as they are read twice.
    """
    if call.get("keep"):
        rows = stored(rows)
    a, c, q, t = F.col(answer), F.col(context), F.col(question), F.col(truth)
    asked = F.array(
        F.struct(F.lit(METRICS[0]).alias("metric"), F.when(~has_empty(a, c), prompts.faithfulness_prompt(a, c, answer_chars, context_chars)).alias("prompt")),
        F.struct(F.lit(METRICS[1]).alias("metric"), F.when(~has_empty(a, q), prompts.relevancy_prompt(a, q, answer_chars)).alias("prompt")),
        F.struct(F.lit(METRICS[2]).alias("metric"), F.when(~has_empty(a, t), prompts.correctness_prompt(a, t, answer_chars)).alias("prompt")),
    )
    long = rows.select(row_id, F.inline(asked)).where(F.col("prompt").isNotNull())
    replied = complete(long, "prompt", fn, temperature=TEMPERATURE_JUDGE, **call)
    one = F.when(F.col("reply_error").isNull(), score_from_reply("reply"))
    scored = (
        replied.select(row_id, "metric", one.alias("score"), F.lit(True).alias("sent"))
        .groupBy(row_id)
        .agg(
            *[F.max(F.when(F.col("metric") == m, F.col("score"))).alias(f"_{m}") for m in METRICS],
            *[F.max(F.when(F.col("metric") == m, F.col("sent"))).alias(f"_sent_{m}") for m in METRICS],
        )
    )
    joined = rows.join(scored, on=row_id, how="left")
    return joined.select(
        *rows.columns,
        *[
            F.when(F.coalesce(F.col(f"_sent_{m}"), F.lit(False)), F.col(f"_{m}")).otherwise(0.0).alias(m)
            for m in METRICS
        ],
    )


def flag_low(scored: DataFrame, threshold: float = FLAG_THRESHOLD) -> DataFrame:
    """Adds the unrounded ``average`` and ``flagged``."""
    return scored.withColumn("average", mean_score(*METRICS)).withColumn("flagged", low_score("average", threshold))


def evaluation_rows(flagged: DataFrame) -> DataFrame:
    """The shape of a stored evaluation row, the mean shown with three digits."""
    scores = F.struct(*METRICS, F.bround("average", 3).alias("average"))
    return flagged.select("id", "question", "ground_truth", "rag_answer", scores.alias("scores"), "flagged")


def summarise(flagged: DataFrame, digits: int | None = 3) -> DataFrame:
    """Totals, three means, flagged count and rate. An empty set: null means, rate 0."""
    n = F.count(F.lit(1))
    hits = F.count_if(F.col("flagged"))
    rate = F.coalesce(F.try_divide(hits.cast("double"), n), F.lit(0.0))

    def shown(c: Column) -> Column:
        return c if digits is None else F.bround(c, digits)

    return flagged.agg(
        n.alias("total_questions"),
        *[shown(F.avg(m)).alias(f"avg_{m}") for m in METRICS],
        hits.alias("flagged_count"),
        shown(rate).alias("flag_rate"),
    )


def judge_alignment(
    scored: DataFrame, labels: DataFrame, on: str, score: str, label: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Agreement of automatic scores with human labels: rows, correlation, mean absolute gap, rank agreement.

    ``spearman`` is the correlation of average ranks and ``kendall`` is tau-b; both allow for ties
    and are null where either side has a single value. No pair of rows is made: see ``discordant``.
    Rows without a score or a label count in ``n_pairs`` alone.
    """
    pairs = stored(
        scored.select(on, F.col(score).cast("double").alias("_s")).join(labels.select(on, F.col(label).cast("double").alias("_l")), on=on).select("_s", "_l")
    )
    both = pairs.where(F.col("_s").isNotNull() & F.col("_l").isNotNull())
    by_score = stored(global_index(both, ["_s", "_l"], "_ps", range_rows=range_rows))
    placed = stored(global_index(by_score, ["_l", "_ps"], "_pl", range_rows=range_rows))
    ranks = placed
    for value, place in (("_s", "_ps"), ("_l", "_pl")):
        ranks = ranks.join(placed.groupBy(value).agg(F.avg(place).alias(f"_r{value}")), on=value)
    n = F.count(F.lit(1))
    tied = F.coalesce(F.sum((F.col("n") * (F.col("n") - 1) / 2).cast("decimal(38,0)")), F.lit(0))

    def fact(df: DataFrame, **values: Column) -> DataFrame:
        """The values of a one-row table as rows of name and value."""
        return df.agg(*[v.cast("double").alias(k) for k, v in values.items()]).select(
            F.inline(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in values]))
        )

    def correlation(a: str, b: str) -> Column:
        """Null, not an error, where a side has a single value."""
        a, b = (F.when(F.col("_s").isNotNull() & F.col("_l").isNotNull(), F.col(c)) for c in (a, b))
        varied = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))  # a deviation of equal values may differ from 0 by rounding
        return F.when(varied, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))

    facts = [
        fact(pairs, n_pairs=n, correlation=correlation("_s", "_l"), mean_abs_gap=F.avg(F.abs(F.col("_s") - F.col("_l")))),
        fact(ranks, spearman=correlation("_r_s", "_r_l")),
        fact(placed, all_pairs=n.cast("double") * (n - 1) / 2),
        fact(placed.groupBy("_s").agg(n.alias("n")), tied_s=tied),
        fact(placed.groupBy("_l").agg(n.alias("n")), tied_l=tied),
        fact(placed.groupBy("_s", "_l").agg(n.alias("n")), tied_both=tied),
        fact(discordant(placed, "_ps", "_pl", range_rows), opposed=F.max("discordant")),
    ]
    names = ("n_pairs", "correlation", "mean_abs_gap", "spearman", "all_pairs", "tied_s", "tied_l", "tied_both", "opposed")
    known = reduce(DataFrame.unionByName, facts).agg(*[F.max(F.when(F.col("name") == k, F.col("value"))).alias(k) for k in names])
    untied_s, untied_l = F.col("all_pairs") - F.col("tied_s"), F.col("all_pairs") - F.col("tied_l")
    agreed = untied_s - F.col("tied_l") + F.col("tied_both") - 2 * F.col("opposed")
    return known.select(
        F.col("n_pairs").cast("bigint").alias("n_pairs"), "correlation", "mean_abs_gap", "spearman",
        F.try_divide(agreed, F.sqrt(untied_s) * F.sqrt(untied_l)).alias("kendall"),
    )


def _inversions(values) -> int:
    """Pairs with the larger value first, bit by bit: each pair is told apart at one bit."""
    import numpy as np

    order, total = np.asarray(values, np.int64), 0
    top = int(order.max()).bit_length() if len(order) else 0
    for bit in range(top - 1, -1, -1):
        head = order >> (bit + 1)
        one = (order >> bit) & 1
        starts = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
        ones = np.cumsum(one)
        before = np.repeat((ones - one)[starts], np.diff(np.r_[starts, len(order)]))
        total += int(((ones - before) * (1 - one)).sum())
        order = order[np.argsort(order >> bit, kind="stable")]
    return total


def discordant(placed: DataFrame, x: str, y: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row: the pairs of rows whose positions ``x`` and ``y`` stand in opposite order.

    Both positions are cut into ranges. Pairs within a range of x are counted in its task; of the
    other pairs, those within a range of y in its task, and the rest from the counts per cell of both ranges
    (rows squared over ``range_rows`` squared of them at most, in one task).
    """
    range_rows = range_size(placed.count(), range_rows)

    def within(rows: pd.DataFrame, order: str, value: str) -> pd.DataFrame:
        return pd.DataFrame({"n": [_inversions(rows.sort_values(order)[value].to_numpy())]})

    def between(cells: pd.DataFrame) -> pd.DataFrame:
        total, above = 0, {}
        for _, row in cells.sort_values("_rx").groupby("_rx"):
            ranges, sizes = np.array(sorted(above), np.int64), None
            if len(ranges):
                sizes = np.cumsum([above[r] for r in ranges][::-1])[::-1]  # rows of this range and those above it
                at = np.searchsorted(ranges, row["_ry"].to_numpy(), side="right")
                total += sum(int(sizes[a]) * int(n) for a, n in zip(at, row["n"]) if a < len(sizes))
            for r, n in zip(row["_ry"], row["n"]):
                above[r] = above.get(r, 0) + int(n)
        return pd.DataFrame({"n": [total]})

    cut = placed.select(F.col(x).alias("_x"), F.col(y).alias("_y"), F.floor(F.col(x) / range_rows).alias("_rx"), F.floor(F.col(y) / range_rows).alias("_ry"))
    counts = cut.groupBy("_rx", "_ry").agg(F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(1))
    parts = (
        cut.groupBy("_rx").applyInPandas(lambda rows: within(rows, "_x", "_y"), "n long")
        .unionByName(cut.groupBy("_ry").applyInPandas(lambda rows: within(rows, "_y", "_rx"), "n long"))
        .unionByName(counts.groupBy("_one").applyInPandas(between, "n long"))
    )
    return parts.agg(F.coalesce(F.sum(F.col("n").cast("decimal(38,0)")), F.lit(0)).cast("double").alias("discordant"))


def context_precision(
    hits: DataFrame, relevant: DataFrame, k: int, question_id: str = "question_id", vector_id: str = "id"
) -> DataFrame:
    """Share of the first ``k`` hits that are relevant, per question.

    ``relevant`` holds the (question, id) pairs judged relevant.
    """
    marks = relevant.select(question_id, vector_id).distinct().withColumn("_relevant", F.lit(1.0))
    top = hits.where(F.col("rank") <= k).select(question_id, vector_id)
    return (
        top.join(marks, on=[question_id, vector_id], how="left")
        .groupBy(question_id)
        .agg(F.avg(F.coalesce("_relevant", F.lit(0.0))).alias("context_precision"))
    )


def check_targets(summary: DataFrame, targets: dict[str, float]) -> DataFrame:
    """One row per metric of a one-row summary: value, target, and whether it is above it."""
    pairs = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(float(t)).alias("target"))
            for m, t in targets.items()
        ]
    )
    return summary.select(F.inline(pairs)).withColumn(
        "met", F.coalesce(F.col("value") > F.col("target"), F.lit(False))
    )


