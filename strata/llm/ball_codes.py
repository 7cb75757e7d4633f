"""Vector codes by exact k-means on the parts of vectors, searched through balls.

Vectors become integers and are cut into parts; each part position has a codebook of entries. A
code names, part by part, the nearest entry. All arithmetic is on integers, so results do not
depend on how rows are spread.

The parts of one entry are a ball with a radius. Only entries whose centre is within twice the
radius can take a part away: the neighbours of the ball. A part nearer than half the way to the
first neighbour is in the stable core and keeps its entry. The others lie in rings: between half
the ways to the k-th and the next neighbour, only the k nearest neighbours are candidates. Where
an entry has not moved since the last round, its neighbours that have not moved either are out
too. Radii are those of a task's own share of a ball, which are never larger than the whole
ball's, so nothing has to be known before the pass.

Vectors stay in written tables with the codes of the last round. Only codebooks (entries times
components) and their sums, of the same size, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import attach, picked, prepared
from strata.scratch import materialise

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Components beyond this stop the job: their squares would not add up exactly.
LARGEST = 1 << 26
# Components that are held at a time in a Python worker.
BLOCK = 1 << 21


# --- search -------------------------------------------------------------------------------


def squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``left`` to all of ``right``, exact."""
    squares = (left * left).sum(axis=1)[:, None] + (right * right).sum(axis=1)[None, :]
    return squares - 2 * (left @ right.T)


def exact_form(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays as float64 where all sums of squares are whole numbers in it, else as int64."""
    most = max((int(np.abs(a).max(initial=0)) for a in arrays), default=0)
    bound = 4 * most * most * arrays[0].shape[1]
    if bound >= 1 << 62:
        raise ValueError("components are too large for exact distances")
    return tuple(a.astype(np.float64 if bound < 1 << 52 else np.int64) for a in arrays)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the first of equally near ones) and squared distance of every row."""
    rows, entries = exact_form(rows, entries)
    found = squared_distances(rows, entries)
    codes = found.argmin(axis=1)
    return codes, found[np.arange(len(rows)), codes].astype(np.int64)


def nearest_by_balls(
    rows: np.ndarray, entries: np.ndarray, codes: np.ndarray, moved: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`nearest`, out of the ``codes`` of the entries before some ``moved``."""
    rows, entries = exact_form(rows, entries)
    between = squared_distances(entries, entries)
    codes = codes.astype(np.int64)
    apart = rows - entries[codes]
    own = (apart * apart).sum(axis=1)
    found, best = codes.copy(), own.copy()
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(entries)))
    for entry in np.unique(codes):
        ball = order[ends[entry - 1] if entry else 0 : ends[entry]]
        near = between[entry] <= 4 * own[ball].max()
        near[entry] = False
        if not moved[entry]:
            near &= moved
        neighbours = np.flatnonzero(near)
        neighbours = neighbours[np.argsort(between[entry][neighbours], kind="stable")]
        # How many neighbours each part has to look at; none in the stable core.
        reach = np.searchsorted(between[entry][neighbours], 4 * own[ball], side="right")
        inner = 0
        while inner < len(neighbours):
            outer = min(2 * inner or 1, len(neighbours))
            ring = ball[(reach > inner) & (reach <= outer)]
            if len(ring):
                candidates = np.sort(np.append(neighbours[:outer], entry))
                distances = squared_distances(rows[ring], entries[candidates])
                at = distances.argmin(axis=1)
                found[ring] = candidates[at]
                best[ring] = distances[np.arange(len(ring)), at]
            inner = outer
    return found, best.astype(np.int64)


# --- passes over the vectors --------------------------------------------------------------


def _blocks(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[pa.Table]:
    """Rows of several batches together, up to BLOCK components."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows * dim >= BLOCK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    listed = table["_values"].combine_chunks()
    return listed.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def _codes(table: pa.Table, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(table["_codes"].to_pylist()), dtype=np.uint8).reshape(-1, parts)


def _assigned(batches, shared, moved) -> Iterator[pa.RecordBatch]:
    books = shared.value
    parts, _, width = books.shape
    for table in _blocks(batches, parts * width):
        rows = _matrix(table, parts * width).reshape(-1, parts, width)
        old = None if moved is None else _codes(table, parts)
        codes = np.empty((len(rows), parts), dtype=np.uint8)
        error = np.zeros(len(rows), dtype=np.int64)
        for part in range(parts):
            own = rows[:, part]
            if old is None:
                found, distance = nearest(own, books[part])
            else:
                found, distance = nearest_by_balls(own, books[part], old[:, part], moved[part])
            codes[:, part] = found
            error += distance
        done = table.select(["_key", "_label", "_values"])
        done = done.append_column("_codes", pa.array([row.tobytes() for row in codes], pa.binary()))
        done = done.append_column("_error", pa.array(error))
        yield from done.combine_chunks().to_batches()


def _summed(batches, parts: int, entries: int, width: int) -> Iterator[pa.RecordBatch]:
    """Per part, entry and place the sum of a task's rows; place -1 counts them."""
    total = np.zeros((parts, entries, width + 1), dtype=np.int64)
    for table in _blocks(batches, parts * width):
        rows = _matrix(table, parts * width).reshape(-1, parts, width)
        codes = _codes(table, parts)
        for part in range(parts):
            np.add.at(total[part, :, 1:], codes[:, part], rows[:, part])
            total[part, :, 0] += np.bincount(codes[:, part], minlength=entries)
    part, entry, place = (axis.ravel() for axis in np.indices(total.shape))
    used = np.repeat(total[:, :, 0].ravel() > 0, width + 1)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array((part * entries + entry)[used].astype(np.int32)),
            pa.array((place - 1)[used].astype(np.int32)),
            pa.array(total.ravel()[used]),
        ],
        ["slot", "place", "total"],
    )


def _with_codes(stored: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    shared = stored.sparkSession.sparkContext.broadcast(books)
    names = ["_key", "_label", "_values"]
    schema = T.StructType([stored.schema[n] for n in names])
    schema = schema.add("_codes", T.BinaryType()).add("_error", T.LongType())
    rows = stored.select(*names, *([] if moved is None else ["_codes"]))
    return materialise(rows.mapInArrow(partial(_assigned, shared=shared, moved=moved), schema), "codes")


def _centred(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The entries as the mean of their parts, rounded down; unused ones stay."""
    parts, entries, width = books.shape
    task = partial(_summed, parts=parts, entries=entries, width=width)
    sums = stored.select("_values", "_codes").mapInArrow(task, "slot int, place int, total long")
    # At most one row per entry and component.
    rows = sums.groupBy("slot", "place").agg(F.sum("total").alias("total")).collect()
    total = np.zeros((parts * entries, width + 1), dtype=np.int64)
    for slot, place, value in rows:
        total[slot, place + 1] = value
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, :1]
    return np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)


# --- codes --------------------------------------------------------------------------------


def _whole_numbers(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    rows = picked(vectors, _key=key, _vector=vector, _label=label)
    infinite = F.lit(float("inf"))

    def finite(x):
        value = x.cast("double")
        return x.isNotNull() & ~F.isnan(value) & (F.abs(value) < infinite)

    def whole(x):
        scaled = x.cast("double") * scale
        too_large = F.raise_error(F.lit("a component is too large")).cast("int")
        return F.when(F.abs(scaled) < LARGEST, F.floor(scaled).cast("int")).otherwise(too_large)

    kept = rows.filter((F.size("_vector") > 0) & F.forall("_vector", finite))
    return kept.select("_key", "_label", F.transform("_vector", whole).alias("_values"))


def vector_codes(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """``key``, code, error, label_error and codebooks_sha256 of every vector that has numbers only.

    Left out are vectors that are NULL or empty or hold a NULL, a NaN or an infinity. A component
    x becomes ``floor(scale * x)``. Codebooks begin with the parts of the first ``entries``
    vectors by key (NULL keys last, of equal keys the smaller vector first; fewer vectors make
    smaller codebooks); ``rounds`` times every part goes to the nearest entry, the first of
    equally near ones, and every used entry to the mean of its parts, rounded down. Then parts
    are coded: two hexadecimal digits a part. error is the sum of the squared distances,
    label_error its sum over all vectors with the same label (NULL is a label),
    codebooks_sha256 that of all components of all entries.

    Rows that repeat a key, or all of a row, are coded each for itself. Other columns are left
    out and may have any name. No vectors give no rows. Vectors of different lengths, a length
    that ``parts`` does not divide and components beyond ``LARGEST / scale`` stop the job.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits, so 1 to 256 entries")
    spark = vectors.sparkSession
    prepared(spark)
    stored = materialise(_whole_numbers(vectors, key, vector, label, scale), "vectors")
    shortest, longest = stored.agg(F.min(F.size("_values")), F.max(F.size("_values"))).first()
    if shortest != longest or (longest or 0) % parts:
        raise ValueError(f"vectors of {shortest} to {longest} components cannot be cut into {parts} parts")
    first = stored.orderBy(F.col("_key").asc_nulls_last(), "_values").limit(entries)
    books = np.array([r["_values"] for r in first.select("_values").collect()], dtype=np.int64)
    # A part position, an entry, a component.
    books = books.reshape(len(books), parts, (longest or 0) // parts).transpose(1, 0, 2)
    moved = None
    for _ in range(rounds):
        stored = _with_codes(stored, books, moved)
        centred = _centred(stored, books)
        moved, books = (centred != books).any(axis=2), centred
    coded = _with_codes(stored, books, moved).drop("_values")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    # NULL is a label like others.
    name = F.coalesce(F.concat(F.lit("="), F.col("_label").cast("string")), F.lit("NULL"))
    named = coded.withColumn("_name", name)
    totals = named.groupBy("_name").agg(
        F.sum("_error").alias("label_error"), F.count(F.lit(1)).alias("_size")
    )
    found = attach(named, totals, "_name", "_size", ["_key", "_codes", "_error"], coded.count())
    return found.select(
        F.col("_key").alias(key),
        F.lower(F.hex("_codes")).alias("code"),
        F.col("_error").alias("error"),
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
