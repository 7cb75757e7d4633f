"""Packing documents into sequences by bin completion.

Sizes are whole numbers up to the capacity, so a corpus of any size is a histogram of at most
``capacity`` entries, and a plan is a list of fillings with a number of copies each. Only the
histogram comes to the driver. The search takes the largest size left, enumerates fillings
around it that no other filling dominates (none that leaves room for a size still there), and
opens as many sequences of a filling as the counts allow. A branch is cut where its waste
already exceeds what a better plan could afford; best-fit plans are the first incumbents, and
a plan that reaches the lower bound ends the search. Each document then finds its sequence by
its rank among the documents of its size, in one pass without a sort.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import picked
from strata.llm.encoding import encoder, id_bytes
from strata.scratch import materialise

CAPACITY = 2048
# Choices of the search, and partial fillings looked at for each, after which the best plan seen
# is taken.
STEPS = 20_000
PARTIAL = 100


# --- the plan ----------------------------------------------------------------------------


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No plan has fewer sequences: total size, and large items that cannot share (L2 bound).

    ``counts[s]`` is the number of items of size ``s``.
    """
    sizes = np.arange(len(counts))
    best = -(-int((counts * sizes).sum()) // capacity)
    after = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])  # items of at least a size
    weight = np.concatenate([np.cumsum((counts * sizes)[::-1])[::-1], [0]])
    half = capacity // 2 + 1
    for k in range(1, capacity // 2 + 1):
        huge = int(after[min(capacity - k + 1, capacity + 1)])
        large = int(after[half]) - huge
        room = large * capacity - int(weight[half] - weight[min(capacity - k + 1, capacity + 1)])
        small = int(weight[k] - weight[half])
        best = max(best, huge + large + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over the histogram: (copies, sizes) per filling.

    Groups of equal items go to the fullest open sequences with room; equal sequences are one
    entry, so the work follows the number of sizes and not the number of items.
    """
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    rooms: list[int] = []

    def put(filling: tuple[int, ...], copies: int) -> None:
        room = capacity - sum(filling)
        if room not in open_:
            open_[room] = {}
            bisect.insort(rooms, room)
        open_[room][filling] = open_[room].get(filling, 0) + copies

    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                if left >= each:
                    put((size,) * each, left // each)
                left %= each
                if left:
                    put((size,) * left, 1)
                break
            fillings = open_[rooms[at]]
            filling, copies = fillings.popitem()
            if not fillings:
                del open_[rooms.pop(at)]
            used = min(copies, left)
            put((*filling, size), used)
            if copies > used:
                put(filling, copies - used)
            left -= used
    return [(n, f) for fillings in open_.values() for f, n in fillings.items()]


class _Left:
    """Sizes that are left, as a sorted list and their counts."""

    def __init__(self, counts: np.ndarray):
        self.count = {int(s): int(counts[s]) for s in np.flatnonzero(counts) if s}
        self.sizes = sorted(self.count)
        self.total = sum(s * n for s, n in self.count.items())

    def take(self, filling: tuple[int, ...], copies: int) -> None:
        for s in filling:
            self.count[s] -= copies
            self.total -= s * copies
        for s in set(filling):
            if not self.count[s]:
                self.sizes.pop(bisect.bisect_left(self.sizes, s))

    def give(self, filling: tuple[int, ...], copies: int) -> None:
        for s in set(filling):
            if not self.count[s]:
                bisect.insort(self.sizes, s)
        for s in filling:
            self.count[s] += copies
            self.total += s * copies


def completions(
    left: _Left, capacity: int, waste: int, budget: list[int]
) -> Iterator[tuple[int, ...]]:
    """All undominated fillings around the largest size that waste at most ``waste``.

    Those with the least waste come first: each round of the depth-first search takes a range
    of wastes twice as wide as the one before. Companions are taken by falling size, any number
    of them. A filling is dominated if something left fits into what it wastes, or if something
    left could take the place of a smaller companion. ``budget[0]`` is the number of partial
    fillings that may still be looked at.
    """
    first, sizes = left.sizes[-1], left.sizes
    chosen: dict[int, int] = {first: 1}

    def free(size: int) -> bool:
        return left.count[size] > chosen.get(size, 0)

    def dominated(room: int) -> bool:
        if not room:
            return False
        for size in chosen:
            # From the companion's own size on, upwards: also what fits beside it all.
            at = bisect.bisect_right(sizes, size)
            while size != first and at < len(sizes) and sizes[at] <= size + room:
                if free(sizes[at]):
                    return True
                at += 1
        return any(free(s) for s in sizes[: bisect.bisect_right(sizes, room)])

    def search(top: int, room: int, low: int, high: int) -> Iterator[tuple[int, ...]]:
        """Companions among ``sizes[:top]`` so that between ``low`` and ``high`` is wasted."""
        budget[0] -= 1
        if budget[0] < 0:
            return
        if low <= room <= high and not dominated(room):
            yield tuple(sorted((s for s, n in chosen.items() for _ in range(n)), reverse=True))
        for at in range(min(top, bisect.bisect_right(sizes, room)) - 1, -1, -1):
            size, before = sizes[at], chosen.get(sizes[at], 0)
            for more in range(min(left.count[size] - before, room // size), 0, -1):
                chosen[size] = before + more
                yield from search(at, room - more * size, low, high)
            if before:
                chosen[size] = before
            else:
                chosen.pop(size, None)

    low = 0
    while low <= waste:
        high = min(waste, 2 * low)
        yield from search(len(sizes), capacity - first, low, high)
        low = high + 1


def _copies(left: _Left, filling: tuple[int, ...]) -> int:
    return min(left.count[s] // filling.count(s) for s in set(filling))


def plan(
    counts: np.ndarray, capacity: int = CAPACITY, steps: int = STEPS
) -> list[tuple[int, tuple[int, ...]]]:
    """(copies, sizes) per filling; every item of the histogram is in exactly one.

    Depth first: each filling around the largest size left is opened as often as the counts
    allow, and, where that leads to no better plan, once. A branch that wastes more than a
    better plan can, or that came up before with no more sequences open, is cut. That tries all
    plans, unless ``steps`` choices or ``PARTIAL`` partial fillings for each of them have been
    looked at; then the best plan seen is returned, which is never worse than best fit.
    """
    counts = np.asarray(counts)
    best = best_fit(counts, capacity)
    fewest, bound = sum(n for n, _ in best), lower_bound(counts, capacity)
    left = _Left(counts)
    path: list[tuple[int, tuple[int, ...]]] = []
    opened = 0
    seen: dict[tuple[tuple[int, int], ...], int] = {}
    budget = [steps * PARTIAL]

    def moves() -> Iterator[tuple[int, tuple[int, ...]]]:
        """Copies and fillings to try where ``left`` is now."""
        waste = (fewest - 1 - opened) * capacity - left.total
        for filling in completions(left, capacity, waste, budget):
            most = _copies(left, filling)
            yield most, filling
            if most > 1:
                yield 1, filling

    frames = [moves()] if fewest > bound else []
    while frames and fewest > bound and steps > 0:
        move = next(frames[-1], None)
        steps -= 1
        if move is None:
            frames.pop()
            if path:
                copies, filling = path.pop()
                left.give(filling, copies)
                opened -= copies
            continue
        copies, filling = move
        left.take(filling, copies)
        path.append(move)
        opened += copies
        state = tuple((s, left.count[s]) for s in left.sizes)
        if not left.sizes and opened < fewest:
            best, fewest = list(path), opened
        hopeless = opened - (-left.total // capacity) >= fewest or seen.get(state, fewest) <= opened
        seen[state] = min(opened, seen.get(state, opened))
        frames.append(iter(()) if hopeless else moves())
    return best


@dataclass
class Slots:
    """Where the items of each size go: for the ranks from ``ranks`` on, sequence and offset."""

    ranks: dict[int, list[int]] = field(default_factory=dict)
    places: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    @classmethod
    def of(cls, fillings: list[tuple[int, tuple[int, ...]]]) -> Slots:
        slots, taken, sequence = cls(), {}, 0
        for copies, filling in fillings:
            offset = 0
            for size in filling:
                slots.ranks.setdefault(size, []).append(taken.get(size, 0))
                slots.places.setdefault(size, []).append((sequence, offset))
                taken[size] = taken.get(size, 0) + copies
                offset += size
            sequence += copies
        return slots

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for s in np.unique(size):
            mine = np.flatnonzero(size == s)
            ranks, places = np.array(self.ranks[s]), np.array(self.places[s])
            at = np.searchsorted(ranks, rank[mine], side="right") - 1
            sequence[mine] = places[at, 0] + rank[mine] - ranks[at]
            offset[mine] = places[at, 1]
        return sequence, offset


# --- over the corpus ---------------------------------------------------------------------


def pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: _key, _piece, _start, _length, _crc32 and _ids.

    Each document ends with ``end_id``; NULL is an empty text. Longer documents are cut into
    pieces of ``capacity``, the first of which takes what is left over. _part and _rank number
    the pieces of a size within a task.
    """
    end = id_bytes([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows: list[tuple] = []
            encoded = encode(batch.column("_text").to_pylist())
            for at, data in enumerate(encoded):
                data += end
                total = len(data) // 4
                first = total % capacity or capacity
                bounds = [0, *range(first, total + 1, capacity)]
                for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    own = data[4 * a : 4 * b]
                    rows.append((at, number, a, b - a, zlib.crc32(own), part, seen[b - a], own))
                    seen[b - a] += 1
            if not rows:
                continue
            at, *columns, ids = zip(*rows)
            if not keep_ids:
                ids = [None] * len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key").take(pa.array(at)),
                    *[pa.array(c, pa.int64()) for c in columns],
                    pa.array(ids, pa.binary()),
                ],
                names=["_key", "_piece", "_start", "_length", "_crc32", "_part", "_rank", "_ids"],
            )

    kind = docs.schema[key].dataType.simpleString()
    numbers = ", ".join(f"{c} bigint" for c in "_piece _start _length _crc32 _part _rank".split())
    rows = picked(docs, _key=key, _text=text)
    return rows.mapInArrow(cut, f"_key {kind}, {numbers}, _ids binary")


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
    steps: int = STEPS,
) -> DataFrame:
    """One row per piece: ``key``, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most ``capacity`` ids, without gaps. Empty and NULL texts are a piece of
    the end id alone; repeated rows and equal keys are packed one by one; an empty table gives
    no rows. ``ids`` (little-endian unsigned 32-bit numbers) is NULL without ``keep_ids``.
    """
    stored = materialise(pieces(docs, tokenizer, end_id, capacity, key, text, keep_ids), "pieces")
    parts = stored.groupBy("_length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per size comes to the driver.
    sizes = parts.groupBy("_length").agg(F.sum("_n").alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in sizes:
        counts[row["_length"]] = row["n"]
    slots = Slots.of(plan(counts, capacity, steps))

    earlier = Window.partitionBy("_length").orderBy("_part")
    before = F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_length", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = stored.join(parts, ["_length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_rank")).drop("_before", "_part")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("_length", "_rank"))
            sequence, offset = slots.find(size, rank)
            yield batch.append_column("_sequence", pa.array(sequence)).append_column(
                "_offset", pa.array(offset)
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema)
    placed = ranked.mapInArrow(place, f"{kinds}, _sequence bigint, _offset bigint")
    return placed.select(
        F.col("_key").alias(key),
        F.col("_piece").cast("int").alias("piece"),
        F.col("_start").alias("start"),
        F.col("_length").alias("length"),
        F.col("_crc32").alias("ids_crc32"),
        F.col("_sequence").alias("sequence_id"),
        F.col("_offset").alias("offset"),
        F.col("_ids").alias("ids"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences of :func:`packed` with ``keep_ids``: sequence_id, n_ids, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    whole = placed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_ids"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return whole.select("sequence_id", "n_ids", joined.alias("ids"))
