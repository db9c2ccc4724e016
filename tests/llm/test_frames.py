"""What a Python worker holds is bounded: rows of a frame, and the caches of one operator."""

from pyspark.sql import functions as F

from docsift.llm import toxicity
from docsift.llm.common import FRAME_ROWS, kept_by_worker, map_frames


def test_a_frame_has_bounded_rows_and_none_is_lost(spark):
    rows = spark.range(0, 2 * FRAME_ROWS + 5, numPartitions=1).select(F.when(F.col("id") != 3, F.col("id") + 2**53).alias("id"))

    def sizes(frames):
        for frame in frames:
            yield frame.assign(held=len(frame))

    found = map_frames(rows, sizes, "id long, held long").collect()
    assert max(r.held for r in found) <= FRAME_ROWS
    assert {r.id for r in found} == {None if i == 3 else i + 2**53 for i in range(2 * FRAME_ROWS + 5)} and len(found) == 2 * FRAME_ROWS + 5


def test_a_worker_keeps_the_caches_of_one_operator():
    model = toxicity.fit(["you vile fool", "a kind word here"] * 4, [1, 0] * 4)
    first = toxicity.score(model, ["you vile fool", "a kind word"])
    assert kept_by_worker("toxicity")["inputs"].model is model
    kept_by_worker("tokens")["path"] = 1
    assert kept_by_worker("tokens") == {"path": 1} and kept_by_worker("toxicity") == {}
    assert toxicity.score(model, ["you vile fool", "a kind word"]) == first
