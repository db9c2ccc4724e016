"""Nearest vectors by cosine distance: the k nearest, those within a distance, and re-ranked.

No plan here pairs rows. Vectors meet questions as blocks of bounded size inside a task,
as one matrix product per block, and only the ``k`` best of each block leave the task.
The three plans are exact and differ in what moves:

* ``scan_vectors``: few questions; their matrix goes to every task, the vectors are scanned in place;
* ``scan_questions``: few vectors; their matrix goes to every task, the questions are scanned in place;
* ``cells``: neither is few. Every vector belongs to the cell of its nearest centre and, in it, to a
  band of angles to that centre. A question meets its nearest cells first, which gives a bound, and
  then only bands that can hold something within the bound: by the triangle inequality on angles,
  a vector is at least as far as the angle to its centre differs from the question's.

"Few" is checked by reading at most ``small_rows + 1`` rows. In all plans null, empty and zero
vectors are never found and find nothing, and vectors of different lengths fail the job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.embedding import DISTANCE_DIGITS
from .order import best_per_group
from .stored import stored

SMALL_ROWS = 4096
SMALL_BYTES = 64 << 20
BLOCK_BYTES = 16 << 20  # of one side's vectors in a block, as doubles
BLOCK_QUESTIONS = 16_384
STRIP = 64  # distances of a question, of which the least stands for all at first
MAX_CELLS = 16_384
BANDS = 32  # of angles, over half a turn
GRID_PAIRS = 50_000_000  # of question and vector, from which it is looked at whether the bands leave enough out
PAIRS_PER_ROW = 2048  # compared in the time that a row takes to be sent on
BROADCAST_HITS = 200_000
BROADCAST_GROUPS = 200_000  # rows of three numbers
SLACK = 1e-7  # of a distance: what rounding and the arc cosine can be off by
PLANS = ("scan_vectors", "scan_questions", "cells")


def _block_functions(digits: int):
    """Matrix helpers for the executors (nested, so they travel with the task)."""

    def matrix(column, dim=None):
        """Arrow list column -> unit rows (n x dim); null, empty and zero vectors give zero rows."""
        import numpy as np

        if hasattr(column, "combine_chunks"):
            column = column.combine_chunks()
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        found = np.unique(sizes[sizes > 0])
        if len(found) > 1 or (dim and len(found) and found[0] != dim):
            raise ValueError("all vectors must have the same length")
        rows = np.zeros((len(column), dim or (int(found[0]) if len(found) else 1)))
        if len(found):
            rows[sizes > 0] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, int(found[0]))
        norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)

    def id_array(column):
        import numpy as np

        if hasattr(column, "combine_chunks"):
            column = column.combine_chunks()
        if str(column.type) in ("string", "large_string"):
            return np.array(column.to_pylist(), dtype=str)
        return column.to_numpy(zero_copy_only=False)

    def distances(q, v):
        """Rounded cosine distances; infinite where either vector has no length."""
        import numpy as np

        d = np.round(1.0 - q @ v.T, digits) + 0.0
        d[~q.any(axis=1), :] = np.inf
        d[:, ~v.any(axis=1)] = np.inf
        return d

    def pick(d, k):
        """Column positions of the k smallest per row; equal values go to the lower position."""
        import numpy as np

        rows, n = d.shape
        if n <= k:
            return np.argsort(d, axis=1, kind="stable")
        last = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
        less = d < last
        equal = d == last
        need = k - less.sum(axis=1)
        chosen = less | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= need[:, None]))
        at = np.nonzero(chosen)[1].reshape(rows, k)
        order = np.argsort(np.take_along_axis(d, at, axis=1), axis=1, kind="stable")
        return np.take_along_axis(at, order, axis=1)

    def few_near(q, v, single_q, single_v, zero_v, bound, k):
        """``pick`` with its distances, taken from few of the columns; null where these are not few.

        All cosines are computed in single precision. The k-th largest of the maxima of column strips is no more than the
        k-th largest cosine, so what is below it (by more than rounding) or beyond the bound is not among the k best."""
        import numpy as np

        rows, n = len(q), len(v)
        if n < 4 * k * STRIP:
            return None
        zero_q = ~q.any(axis=1)
        sims = single_q @ single_v.T
        if not np.isfinite(sims.sum()):
            return None
        sims[:, zero_v] = -np.inf
        strips = sims[:, : n // STRIP * STRIP].reshape(rows, STRIP, -1).max(axis=1)
        least = np.partition(strips, strips.shape[1] - k, axis=1)[:, -k]
        if bound is not None:
            least = np.maximum(least, 1 - bound)
        off = 2 * 10.0**-digits + 4 * q.shape[1] * np.finfo(np.float32).eps
        least = np.where(zero_q, np.inf, least.astype(float) - off).astype(np.float32)
        row, at = np.nonzero(sims >= least[:, None])
        if len(row) > sims.size // (4 * q.shape[1]):
            return None
        d = np.round(1.0 - np.einsum("ij,ij->i", q[row], v[at]), digits) + 0.0
        d[zero_v[at]] = np.inf
        order = np.lexsort((at, d, row))
        row, at, d = row[order], at[order], d[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < k
        out_d, out_at = np.full((rows, k), np.inf), np.zeros((rows, k), np.int64)
        out_d[row[kept], place[kept]], out_at[row[kept], place[kept]] = d[kept], at[kept]
        return out_d, out_at

    def nearest(q, v, ids, k, bounds=None):
        """(distances, ids) of the k best columns per question row; ids break ties. Where a question has a bound,
        what is farther may be left out (infinite)."""
        import numpy as np

        order = np.argsort(ids, kind="stable")
        v, ids = v[order], ids[order]
        zero_v = ~v.any(axis=1)
        single_q, single_v = q.astype(np.float32), v.astype(np.float32)
        step = max(1, 4_000_000 // max(1, len(ids)))
        ds, js = [], []
        for i in range(0, len(q), step):
            part = slice(i, i + step)
            found = few_near(q[part], v, single_q[part], single_v, zero_v, None if bounds is None else bounds[part], k)
            if found is None:
                d = distances(q[part], v)
                at = pick(d, k)
                found = np.take_along_axis(d, at, axis=1), at
            ds.append(found[0])
            js.append(ids[found[1]])
        return np.concatenate(ds), np.concatenate(js)

    def merge(d1, j1, d2, j2, k):
        import numpy as np

        d, j = np.hstack([d1, d2]), np.hstack([j1, j2])
        at = np.lexsort((j, d), axis=1)[:, :k]
        return np.take_along_axis(d, at, axis=1), np.take_along_axis(j, at, axis=1)

    return matrix, id_array, nearest, merge


def _hit_schema(questions: DataFrame, question_id: str, vectors: DataFrame, vector_id: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(question_id, questions.schema[question_id].dataType),
            T.StructField(vector_id, vectors.schema[vector_id].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.StringType):
        return pa.string()
    if isinstance(t, T.IntegerType):
        return pa.int32()
    if isinstance(t, T.LongType):
        return pa.int64()
    raise TypeError("ids are strings, ints or longs")


def _usable(df: DataFrame, id_col: str, embedding: str) -> DataFrame:
    """Id and vector only. Vectors without length are left out inside the tasks: a filter
    here would have Spark compute an embedding expression once more just to test it."""
    return df.select(id_col, embedding)


def _fits(df: DataFrame, small_rows: int) -> pa.Table | None:
    """The rows as an Arrow table when they are few; null when they are not."""
    table = df.limit(small_rows + 1).toArrow()
    return table if table.num_rows <= small_rows and table.nbytes <= SMALL_BYTES else None


def vector_search(
    questions: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    where: Column | None = None,
    question_id: str = "question_id",
    vector_id: str = "id",
    embedding: str = "embedding",
    small_rows: int = SMALL_ROWS,
    plan: str | None = None,
) -> DataFrame:
    """The ``k`` nearest vectors of each question: ``question_id, rank, id, distance``.

    Exact; the distance is a cosine distance (small is near), ties go to the lower id.
    ``where`` narrows the vectors ahead of the search and reaches their scan. ``plan`` (one of
    ``PLANS``) overrides the choice by size; a scan plan then takes its small side whole.
    """
    return _search(questions, vectors, k, where, question_id, vector_id, embedding, small_rows, plan)[0]


def search_chunks(
    questions: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    where: Column | None = None,
    texts: DataFrame | None = None,
    question_id: str = "question_id",
    vector_id: str = "id",
    embedding: str = "embedding",
) -> DataFrame:
    """``vector_search`` with the texts and metadata of the hits.

    The search reads ids and vectors only. With few questions the hits are at most ``k``
    each and are broadcast to the texts (``texts``, or the vector table itself), so no text
    is shuffled; otherwise both sides are joined by id.
    """
    hits, most = _search(questions, vectors, k, where, question_id, vector_id, embedding, SMALL_ROWS)
    return attach_chunks(hits, vectors if texts is None else texts, vector_id, most)


def _search(
    questions, vectors, k, where, question_id, vector_id, embedding, small_rows, plan=None, tau=None
) -> tuple[DataFrame, int | None]:
    """The hits, and how many there can be when the questions were few."""
    if plan is not None and plan not in PLANS:
        raise ValueError(f"plan is one of {PLANS}")
    if where is not None:
        vectors = vectors.where(where)
    q = _usable(questions, question_id, embedding)
    v = _usable(vectors, vector_id, embedding)
    few = most = None
    if plan in (None, "scan_vectors"):
        few = q.toArrow() if plan else _fits(q, small_rows)
        if few is not None:
            plan, most = "scan_vectors", few.num_rows * k
    if plan in (None, "scan_questions"):
        few = v.toArrow() if plan else _fits(v, small_rows)
        if few is not None:
            plan = "scan_questions"
    if plan == "scan_vectors":
        hits = _scan_vectors(few, q, v, k, question_id, vector_id)
    elif plan == "scan_questions":
        hits = _scan_questions(few, q, v, k, question_id, vector_id)
    else:
        cells = pick_cells(v, vector_id=vector_id, embedding=embedding)
        hits = _search_cells(q, cells, k, question_id, tau)
    if tau is not None:
        hits = hits.where(F.col("distance") <= tau)
    best = best_per_group(hits, [question_id], ["distance", vector_id], k)
    return best.select(question_id, "rank", vector_id, "distance"), most


def _scan_vectors(few, q, v, k, question_id, vector_id) -> DataFrame:
    schema = _hit_schema(q, question_id, v, vector_id)
    types = [_arrow_type(schema[0].dataType), _arrow_type(schema[1].dataType)]
    matrix, id_array, nearest, merge = _block_functions(DISTANCE_DIGITS)
    shared = v.sparkSession.sparkContext.broadcast((few.column(0).to_pylist(), matrix(few.column(1))))
    names = [question_id, vector_id, "distance"]

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        q_ids, q_rows = shared.value
        best = None
        for batch in batches:
            if batch.num_rows == 0 or not q_rows.any():
                matrix(batch.column(1))
                continue
            found = nearest(q_rows, matrix(batch.column(1), q_rows.shape[1]), id_array(batch.column(0)), k)
            best = found if best is None else merge(*best, *found, k)
        if best is not None:
            d, j = best
            row, at = np.nonzero(np.isfinite(d))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([q_ids[r] for r in row], types[0]),
                    pa.array(j[row, at].tolist(), types[1]),
                    pa.array(d[row, at], pa.float64()),
                ],
                names=names,
            )

    return v.mapInArrow(scan, schema)


def _scan_questions(few, q, v, k, question_id, vector_id) -> DataFrame:
    schema = _hit_schema(q, question_id, v, vector_id)
    types = [_arrow_type(schema[0].dataType), _arrow_type(schema[1].dataType)]
    matrix, id_array, nearest, _ = _block_functions(DISTANCE_DIGITS)
    shared = q.sparkSession.sparkContext.broadcast((id_array(few.column(0)), matrix(few.column(1))))
    names = [question_id, vector_id, "distance"]

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        ids, rows = shared.value
        for batch in batches:
            if batch.num_rows == 0 or not rows.any():
                matrix(batch.column(1))
                continue
            d, j = nearest(matrix(batch.column(1), rows.shape[1]), rows, ids, k)
            row, at = np.nonzero(np.isfinite(d))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)).cast(types[0]),
                    pa.array(j[row, at].tolist(), types[1]),
                    pa.array(d[row, at], pa.float64()),
                ],
                names=names,
            )

    return q.mapInArrow(scan, schema)


def _meet(q: DataFrame, v: DataFrame, k: int, question_id: str, vector_id: str, dim: int) -> DataFrame:
    """The ``k`` nearest within the bound, per question and block; both sides meet by ``_group`` on a grid.

    A group of any size is cut by id hash into blocks of bounded bytes, so a hot group becomes
    many tasks. What is repeated is one side's block, once per block of the other side.
    """
    schema = _hit_schema(q, question_id, v, vector_id)
    types = [_arrow_type(schema[0].dataType), _arrow_type(schema[1].dataType)]
    per_block = max(1, BLOCK_BYTES // (8 * dim))
    sizes = (
        v.groupBy("_group").agg(F.count(F.lit(1)).alias("_nv"))
        .join(q.groupBy("_group").agg(F.count(F.lit(1)).alias("_nq")), on="_group")
        .select(
            "_group",
            F.ceil(F.col("_nv") / per_block).cast("int").alias("_vb"),
            F.ceil(F.col("_nq") / min(per_block, BLOCK_QUESTIONS)).cast("int").alias("_qb"),
        )
    )
    sizes = stored(sizes)
    if sizes.count() <= BROADCAST_GROUPS:
        sizes = F.broadcast(sizes)
    vb = v.join(sizes, on="_group").select(
        vector_id, v.columns[1], "_group",
        F.pmod(F.xxhash64(vector_id), F.col("_vb")).cast("int").alias("_v"),
        F.explode(F.sequence(F.lit(0), F.col("_qb") - 1)).alias("_q"),
    )
    qb = q.join(sizes, on="_group").select(
        question_id, q.columns[1], "_bound", "_group",
        F.explode(F.sequence(F.lit(0), F.col("_vb") - 1)).alias("_v"),
        F.pmod(F.xxhash64(question_id), F.col("_qb")).cast("int").alias("_q"),
    )
    matrix, id_array, nearest, _ = _block_functions(DISTANCE_DIGITS)
    names = [question_id, vector_id, "distance"]

    def meet(left, right):
        import numpy as np
        import pyarrow as pa

        if left.num_rows == 0 or right.num_rows == 0:
            empty = [pa.array([], types[0]), pa.array([], types[1]), pa.array([], pa.float64())]
            return pa.Table.from_arrays(empty, names=names)
        bounds = left.column(2).to_numpy()
        d, j = nearest(matrix(left.column(1), dim), matrix(right.column(1), dim), id_array(right.column(0)), k, bounds)
        row, at = np.nonzero(np.isfinite(d) & (d <= bounds[:, None]))
        return pa.Table.from_arrays(
            [
                left.column(0).take(pa.array(row)).combine_chunks().cast(types[0]),
                pa.array(j[row, at].tolist(), types[1]),
                pa.array(d[row, at], pa.float64()),
            ],
            names=names,
        )

    keys = ["_group", "_v", "_q"]
    return qb.groupBy(*keys).cogroup(vb.groupBy(*keys)).applyInArrow(meet, schema)


@dataclass
class Cells:
    """Centres, the bands of angles in their cells, and the vectors with the band each belongs to.

    ``bands`` has a row per band that holds vectors (at most ``MAX_CELLS * BANDS``): cell, least
    and largest angle to the centre, number of vectors. ``vectors`` is a stored table of id,
    embedding and ``_group`` (``cell * BANDS + band``).
    """

    centres: np.ndarray
    bands: np.ndarray
    groups: np.ndarray
    vectors: DataFrame
    vector_id: str
    embedding: str


def _as_cells(v: DataFrame, centres: np.ndarray, vector_id: str, embedding: str) -> Cells:
    """Every vector with its nearest centre, scanned in place."""
    shared = v.sparkSession.sparkContext.broadcast(centres)
    schema = T.StructType([*v.schema.fields, T.StructField("_group", T.LongType()), T.StructField("_angle", T.DoubleType())])
    matrix, _, _, _ = _block_functions(DISTANCE_DIGITS)
    names = [*v.columns, "_group", "_angle"]

    def assign(batches):
        import numpy as np
        import pyarrow as pa

        c = shared.value
        step = max(1, 4_000_000 // len(c))
        for batch in batches:
            rows = matrix(batch.column(1), c.shape[1])
            kept = np.flatnonzero(rows.any(axis=1))
            for i in range(0, len(kept), step):
                part = kept[i : i + step]
                cosines = rows[part] @ c.T
                cell = cosines.argmax(axis=1)
                angle = np.arccos(np.clip(np.take_along_axis(cosines, cell[:, None], 1)[:, 0], -1, 1))
                band = np.minimum((angle * (BANDS / np.pi)).astype("int64"), BANDS - 1)
                columns = [*batch.take(pa.array(part)).columns, pa.array(cell * BANDS + band), pa.array(angle)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    assigned = stored(v.mapInArrow(assign, schema))
    angles = assigned.groupBy("_group").agg(
        F.min("_angle").alias("low"), F.max("_angle").alias("high"), F.count(F.lit(1)).alias("n")
    ).orderBy("_group").toArrow()  # at most MAX_CELLS * BANDS rows
    bands = np.zeros((angles.num_rows, 4))
    for i, name in enumerate(("_group", "low", "high", "n")):
        bands[:, i] = angles.column(name).to_numpy()
    bands[:, 0] //= BANDS
    groups = angles.column("_group").to_numpy()
    return Cells(centres, bands, groups, assigned.drop("_angle"), vector_id, embedding)


def _default_cells(n: int) -> int:
    return max(1, min(MAX_CELLS, round(n**0.5)))


def pick_cells(vectors: DataFrame, n_cells: int | None = None, vector_id: str = "id", embedding: str = "embedding") -> Cells:
    """Cells around some of the vectors themselves, those of least id hash: one scan, no training.

    A search over them is exact; how many cells it can leave out depends on the centres. By
    default there are as many as the root of the number of vectors.
    """
    v = _usable(vectors, vector_id, embedding)
    usable = v.where(F.exists(embedding, lambda x: x != 0))
    n_cells = n_cells or _default_cells(v.count())
    _check_cells(n_cells)
    picked = usable.orderBy(F.xxhash64(vector_id), vector_id).limit(n_cells).select(embedding).toArrow()
    matrix, _, _, _ = _block_functions(DISTANCE_DIGITS)
    return _as_cells(v, matrix(picked.column(0)) if picked.num_rows else np.zeros((1, 1)), vector_id, embedding)


def _check_cells(n_cells: int) -> None:
    if not 1 <= n_cells <= MAX_CELLS:
        raise ValueError(f"1 to {MAX_CELLS} cells")


def build_cells(
    vectors: DataFrame,
    n_cells: int | None = None,
    vector_id: str = "id",
    embedding: str = "embedding",
    seed: int = 17,
    train_rows: int | None = None,
    iterations: int = 10,
) -> Cells:
    """Cells around k-means centres under cosine distance.

    The centres are trained on all vectors, or on about ``train_rows`` of them when asked to;
    every vector is assigned and searched either way.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = _usable(vectors, vector_id, embedding)
    total = v.count()
    n_cells = n_cells or _default_cells(total)
    _check_cells(n_cells)
    train = v.where(F.exists(embedding, lambda x: x != 0))
    if train_rows is not None and total > train_rows:
        train = train.sample(fraction=train_rows / total, seed=seed)
    features = train.select(array_to_vector(F.col(embedding).cast("array<double>")).alias("features")).persist()
    try:
        if features.isEmpty():
            return pick_cells(vectors, n_cells, vector_id, embedding)
        model = KMeans(k=n_cells, distanceMeasure="cosine", seed=seed, maxIter=iterations, initSteps=2).fit(features)
    finally:
        features.unpersist()
    centres = np.array(model.clusterCenters(), dtype="float64")
    norms = np.linalg.norm(centres, axis=1, keepdims=True)
    return _as_cells(v, (centres / np.where(norms > 0, norms, 1))[norms[:, 0] > 0], vector_id, embedding)


def _route(q: DataFrame, cells: Cells, k: int, question_id: str, turn: int, last: bool, count: bool = False) -> DataFrame:
    """Each question once per band it has to meet in this round (``_group``), scanned in place.

    The nearest cells that hold ``k`` vectors are met first, four times as many in each later
    round, all others in the last; of them only the bands that can hold something within the bound.
    With ``count`` only the numbers of such rows (``met``) leave the tasks.
    """
    shared = q.sparkSession.sparkContext.broadcast((cells.centres, cells.bands, cells.groups))
    schema = T.StructType([T.StructField("met", T.LongType())] if count else [*q.schema.fields, T.StructField("_group", T.LongType())])
    matrix, _, _, _ = _block_functions(DISTANCE_DIGITS)
    names = schema.names

    def route(batches):
        import numpy as np
        import pyarrow as pa

        centres, bands, groups = shared.value
        cell, low, high, n = bands.T
        cell = cell.astype(int)
        held = np.bincount(cell, n, len(centres))
        step = max(1, 2_000_000 // max(len(groups), len(centres)))
        for batch in batches:
            rows = matrix(batch.column(1), centres.shape[1] if len(groups) else None)
            if not len(groups):
                continue
            bound = batch.column(2).to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(rows.any(axis=1))
            for i in range(0, len(kept), step):
                part = kept[i : i + step]
                angle = np.arccos(np.clip(rows[part] @ centres.T, -1, 1))
                near = np.argsort(angle, axis=1, kind="stable")
                first = (np.cumsum(held[near], axis=1) < k).sum(axis=1, keepdims=True) + 1
                place = np.empty_like(near)
                np.put_along_axis(place, near, np.arange(len(centres))[None, :], 1)
                now = place >= (first * 4 ** (turn - 1) if turn else 0)
                if not last:
                    now &= place < first * 4**turn
                to_centre = angle[:, cell]
                gap = np.maximum(np.maximum(to_centre - high, low - to_centre), 0)
                meets = now[:, cell] & (1 - np.cos(gap) <= bound[part, None] + SLACK)
                if count:
                    yield pa.RecordBatch.from_arrays([pa.array([int(meets.sum())], pa.int64())], names=names)
                    continue
                row, at = np.nonzero(meets)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(part[row])).columns, pa.array(groups[at])], names=names)

    return q.mapInArrow(route, schema)


def _grid_is_less(asked: DataFrame, cells: Cells, k: int, question_id: str, turn: int) -> bool:
    """Whether a question would be sent on once per band so often that comparing all pairs in blocks is less."""
    n_questions, n_vectors = asked.count(), int(cells.bands[:, 3].sum())
    if n_questions * n_vectors < GRID_PAIRS:
        return False
    per_block = max(1, BLOCK_BYTES // (8 * cells.centres.shape[1]))
    sent = n_questions * -(-n_vectors // per_block) + n_vectors * -(-n_questions // min(per_block, BLOCK_QUESTIONS))
    met = _route(asked, cells, k, question_id, turn, True, count=True).agg(F.sum("met")).first()[0] or 0
    return met > sent + n_questions * n_vectors // PAIRS_PER_ROW


def _search_cells(
    q: DataFrame, cells: Cells, k: int, question_id: str, tau: float | None = None, rounds: int = 2, record: dict | None = None
) -> DataFrame:
    """Rounds over the cells; after each, a question's bound is the distance of its k-th hit so far."""
    far = float("inf") if tau is None else float(tau)
    q = stored(q)
    hits = bounds = None
    for turn in range(rounds):
        if bounds is None:
            asked = q.withColumn("_bound", F.lit(far))
        else:
            asked = q.join(bounds, on=question_id, how="left").withColumn("_bound", F.least(F.coalesce("_bound", F.lit(far)), F.lit(far)))
        asked, last = asked.select(*q.columns, "_bound"), turn == rounds - 1
        if last and turn and _grid_is_less(asked, cells, k, question_id, turn):
            # Vectors whose angles say little: all blocks of questions meet all blocks of vectors, the earlier hits among them.
            whole = asked.withColumn("_group", F.lit(0).cast("bigint"))
            if record is not None:
                record["met"] = record.get("met", 0) + whole.count() * len(cells.groups)
            found = _meet(whole, cells.vectors.withColumn("_group", F.lit(0).cast("bigint")), k, question_id, cells.vector_id, cells.centres.shape[1])
            hits = stored(best_per_group(found, [question_id], ["distance", cells.vector_id], k).drop("rank"))
            break
        routed = stored(_route(asked, cells, k, question_id, turn, last))
        if record is not None:
            record["met"] = record.get("met", 0) + routed.count()
        found = _meet(routed, cells.vectors, k, question_id, cells.vector_id, cells.centres.shape[1])
        hits = stored(best_per_group(found if hits is None else hits.unionByName(found), [question_id], ["distance", cells.vector_id], k).drop("rank"))
        full = F.when(F.count(F.lit(1)) >= k, F.max("distance"))
        bounds = hits.groupBy(question_id).agg(full.alias("_bound"))
    if record is not None:
        record["all"] = q.count() * len(cells.groups)
    return hits


def vector_search_cells(
    questions: DataFrame,
    cells: Cells,
    k: int = 5,
    tau: float | None = None,
    question_id: str = "question_id",
    rounds: int = 2,
    record: dict | None = None,
) -> DataFrame:
    """``vector_search`` over cells that are built already, and as exact.

    With ``tau`` only hits within that distance are looked for, so the work follows the number of
    near vectors. More ``rounds`` tighten the bounds sooner and cost a shuffle each. ``record``
    gets the pairs of question and band ``met``, and ``all`` there are.
    """
    q = _usable(questions, question_id, cells.embedding)
    hits = _search_cells(q, cells, k, question_id, tau, rounds, record)
    return best_per_group(hits, [question_id], ["distance", cells.vector_id], k).select(
        question_id, "rank", cells.vector_id, "distance"
    )


def attach_chunks(
    hits: DataFrame, texts: DataFrame, vector_id: str = "id", most_hits: int | None = None
) -> DataFrame:
    """Texts and metadata for the hits. ``most_hits`` is a known bound on their number; up to
    ``BROADCAST_HITS`` (some tens of bytes each) they are broadcast."""
    if most_hits is not None and most_hits <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    carried = [c for c in texts.columns if c != "embedding"]
    return texts.select(*carried).join(hits, on=vector_id, how="inner")


def rerank(
    hits: DataFrame,
    score: Column,
    m: int,
    question_id: str = "question_id",
    tie: str = "id",
) -> DataFrame:
    """The best ``m`` hits of each question by a second score (larger is better), re-ranked."""
    scored = hits.drop("rank").withColumn("rerank_score", score)
    return best_per_group(scored, [question_id], [F.desc("rerank_score"), tie], m)


def score_pairs(
    hits: DataFrame, fn: Callable[[list[str], list[str]], list[float]], question: str, text: str, out: str = "pair_score"
) -> DataFrame:
    """A scoring model over (question, text) pairs, batch by batch, for ``rerank``."""
    schema = T.StructType([*hits.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches):
        for pdf in batches:
            scores = fn(pdf[question].tolist(), pdf[text].tolist()) if len(pdf) else []
            yield pdf.assign(**{out: [float(s) for s in scores]})

    return hits.mapInPandas(run, schema)


def cached_answers(
    prompts: DataFrame,
    cache: DataFrame,
    tau: float,
    prompt_id: str = "question_id",
    cache_id: str = "id",
    answer: str = "answer",
    cells: Cells | None = None,
    plan: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Earlier answers for prompts whose nearest cached prompt is within ``tau``, and the rest.

    Returns (hits: prompt id, cache id, distance, answer) and (misses: prompt rows). A large cache
    is searched by cells (given, or picked here), where a prompt only meets the bands that can
    hold a cached prompt within ``tau``.
    """
    if cells is not None:
        near = vector_search_cells(prompts, cells, 1, tau, prompt_id).where(F.col("distance") <= tau)
    else:
        near = _search(prompts, cache, 1, None, prompt_id, cache_id, "embedding", SMALL_ROWS, plan, tau)[0]
    near = near.drop("rank")
    hits = near.join(cache.select(cache_id, answer), on=cache_id).select(prompt_id, cache_id, "distance", answer)
    misses = prompts.join(near.select(prompt_id), on=prompt_id, how="left_anti")
    return hits, misses
