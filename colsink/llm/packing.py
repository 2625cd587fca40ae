"""Packing of token sequences by a configuration linear program.

The lengths' histogram is all that the driver needs: at most ``capacity`` counts,
whatever the data's size. A configuration says how many pieces of each length class go
into one sequence. The linear program, to cover all classes with fewest configurations,
is started by multiplicative weights: each class has a price that falls as it is covered,
and a knapsack dynamic program finds the configuration of highest price. From these
configurations a simplex method goes on with the same pricing until none has a price above
one, so at most as many configurations remain as there are classes. All lengths take part.
The solution is rounded down to whole multiplicities and each is unfolded into exact
lengths; what the rounding leaves over is put best-fit decreasing into the room that
remains, all on counts.

The plan is a list of blocks, (multiplicity, lengths), whose number is bounded by the
classes, the lengths and the iterations. Each piece finds its place from its length and
its number among pieces of that length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsink.llm.common import Scratch, buckets_for, global_rank, read_table
from colsink.llm.tokenizing import END_ID, WORD_BPE, crc32_ids, encoder, id_lists, small_batches, texts_in_parts, vocabulary

CAPACITY = 2048


@dataclass
class Block:
    """``times`` sequences alike: pieces of these lengths, in order."""

    times: int
    lengths: list[int]


def best_configuration(prices: np.ndarray, capacity: int) -> np.ndarray:
    """Counts by class of the configuration of highest total price; class k takes k + 1 units."""
    n = len(prices)
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        k = min(w, n)
        values = best[w - k : w][::-1] + prices[:k]  # class j leaves w - 1 - j
        j = int(values.argmax())
        best[w] = best[w - 1]
        if values[j] > best[w]:
            best[w], pick[w] = values[j], j
    counts, w = np.zeros(n, np.int64), capacity
    while w > 0:
        j = int(pick[w])
        counts[j] += j >= 0
        w -= max(j, 0) + 1
    return counts


def configuration_lp(counts: np.ndarray, capacity: int, iterations: int = 2500, step: float = 0.1) -> list[tuple[float, np.ndarray]]:
    """(weight, configuration) pairs that together cover ``counts``, by multiplicative weights."""
    need = counts.astype(float)
    live = need > 0
    if not live.any():
        return []
    covered = np.zeros(len(need))
    weights: dict[bytes, float] = {}
    shapes: dict[bytes, np.ndarray] = {}
    eta = np.log(max(2, live.sum())) * 4
    for _ in range(iterations):
        low = covered[live].min()
        prices = np.where(live, np.exp(-eta * (covered - low)) / np.maximum(need, 1), -1.0)
        shape = best_configuration(prices, capacity)
        used = shape > 0
        amount = step * float((need[used] / shape[used]).min())
        covered[used] += amount * shape[used] / need[used]
        name = shape.tobytes()
        shapes[name] = shape
        weights[name] = weights.get(name, 0.0) + amount
    scale = 1 / max(covered[live].min(), 1e-9) if covered[live].min() > 0.25 else 1 / covered[live].max()
    return sorted(((w * scale, shapes[n]) for n, w in weights.items()), key=lambda x: (-x[0], x[1].tobytes()))


def solved_lp(counts: np.ndarray, capacity: int, weighted: int = 200, rounds: int = 2000) -> list[tuple[float, np.ndarray]]:
    """(weight, configuration) pairs that cover ``counts`` exactly, by column generation.

    It begins with one class a configuration and takes in those of ``weighted`` rounds of
    multiplicative weights first; a solution is valid after any number of ``rounds``.
    """
    live = np.flatnonzero(counts > 0)
    if not len(live):
        return []
    need = counts[live].astype(float)
    basis = np.diag((capacity // (live + 1)).astype(float))
    x = need / np.diag(basis)
    prices = np.full(len(counts), -1.0)
    waiting = np.array([shape[live] for _, shape in configuration_lp(counts, capacity, weighted)], float)
    for _ in range(rounds):
        prices[live] = price = np.linalg.solve(basis.T, np.ones(len(live)))
        worth = waiting @ price
        if len(worth) and worth.max() > 1 + 1e-7:
            column = waiting[worth.argmax()]
        else:
            waiting = waiting[:0]
            column = best_configuration(prices, capacity)[live].astype(float)
            if column @ price <= 1 + 1e-7:
                break
        step = np.linalg.solve(basis, column)
        ratio = np.full(len(step), np.inf)
        np.divide(x, step, out=ratio, where=step > 1e-9)
        k = int(ratio.argmin())
        x = np.maximum(x - ratio[k] * step, 0)
        x[k], basis[:, k] = ratio[k], column
    shapes = np.zeros((len(live), len(counts)), np.int64)
    shapes[:, live] = basis.T
    return sorted(zip(x.tolist(), shapes), key=lambda p: (-p[0], p[1].tobytes()))


def best_fit(blocks: list[Block], left: dict[int, int], capacity: int) -> list[Block]:
    """Put the pieces ``left`` (length: count) into the blocks' room and then into new blocks.

    Best-fit decreasing on counts: the longest pieces first, each into the least room that
    holds it, as many sequences at a time as are alike.
    """
    room: dict[int, list[Block]] = {}
    heaps: list[int] = []

    def put(b: Block) -> None:
        free = capacity - sum(b.lengths)
        if free not in room:
            room[free] = []
            heapq.heappush(heaps, free)
        room[free].append(b)

    for b in blocks:
        put(b)
    for length in sorted((n for n, c in left.items() if c > 0), reverse=True):
        todo = left[length]
        sizes = sorted(f for f, bs in room.items() if bs and f >= length)
        while todo:
            free = next((f for f in sizes if room.get(f)), None)
            if free is None:
                fit = capacity // length
                times, rest = divmod(todo, fit)
                if times:
                    put(Block(times, [length] * fit))
                if rest:
                    put(Block(1, [length] * rest))
                todo = 0
                break
            b = room[free].pop()
            fit = 1
            if todo < b.times:
                put(Block(b.times - todo, list(b.lengths)))
                b = Block(todo, list(b.lengths))
            else:
                fit = max(1, min(free // length, todo // b.times))
            b.lengths.extend([length] * fit)
            todo -= b.times * fit
            put(b)
            rest = capacity - sum(b.lengths)
            if rest >= length and rest not in sizes:
                sizes = sorted([*sizes, rest])
    return [b for bs in room.values() for b in bs]


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, unit: int = 16) -> list[Block]:
    """Blocks that hold exactly the pieces of a histogram (length: count).

    The program is solved with lengths rounded to the nearest unit and up to the next one,
    and the plan of fewest sequences is kept; one that meets the lower bound ends the search.
    """
    least = max(-(-sum(n * c for n, c in histogram.items()) // capacity), sum(c for n, c in histogram.items() if 2 * n > capacity))
    best: tuple[int, list[Block]] | None = None
    for up in (False, True):
        plan = best_fit(*unfolded(histogram, capacity, unit, up), capacity)
        total = sum(b.times for b in plan)
        if best is None or total < best[0]:
            best = total, plan
        if total <= least:
            break
    return best[1]


def unfolded(histogram: dict[int, int], capacity: int, unit: int = 16, up: bool = False) -> tuple[list[Block], dict[int, int]]:
    """Blocks of the rounded program over all lengths, and the pieces (length: count) it leaves over.

    Up to 64 lengths are not rounded at all.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("piece lengths must be from 1 to the capacity")
    units = capacity if len(left) <= 64 else capacity // min(unit, max(1, capacity // 128))
    of = lambda n: max(1, -(-n * units // capacity) if up else (2 * n * units + capacity) // (2 * capacity)) - 1
    counts = np.zeros(units, np.int64)
    queues: list[list[int]] = [[] for _ in range(units)]
    for n in sorted(left):
        counts[of(n)] += left[n]
        queues[of(n)].append(n)
    blocks: list[Block] = []
    for weight, shape in solved_lp(counts, units):
        slots = [int(k) for k in np.flatnonzero(shape)[::-1] for _ in range(shape[k])]
        todo = int(weight + 1e-6)
        while todo:
            uses = _filled(slots, queues, left, capacity)
            if not uses:
                break
            times = min(todo, *(left[n] // u for n, u in uses.items()))
            blocks.append(Block(times, [n for n in sorted(uses, reverse=True) for _ in range(uses[n])]))
            todo -= times
            for n, u in uses.items():
                left[n] -= times * u
                if not left[n]:
                    queues[of(n)].remove(n)
    return blocks, left


def _filled(slots: list[int], queues: list[list[int]], left: dict[int, int], capacity: int) -> dict[int, int]:
    """A length for each slot, the longest of its class that leaves room for the other slots; empty where none is."""
    if not all(queues[k] for k in slots):
        return {}
    uses: dict[int, int] = {}
    room = capacity - sum(queues[k][0] for k in slots)
    for k in slots:
        room += queues[k][0]
        n = next((n for n in reversed(queues[k]) if n <= room and left[n] > uses.get(n, 0)), None)
        if n is None:
            return {}
        uses[n] = uses.get(n, 0) + 1
        room -= n
    return uses


def placement_index(blocks: list[Block]) -> dict[str, np.ndarray]:
    """Sorted runs of pieces: those of ``length`` numbered from ``first`` go to sequences from ``sequence``."""
    taken: dict[int, int] = {}
    runs, sequence = [], 0
    for b in sorted(blocks, key=lambda b: (-b.times, b.lengths)):
        at = 0
        for n in b.lengths:
            runs.append((n, taken.get(n, 0), sequence, at))
            taken[n] = taken.get(n, 0) + b.times
            at += n
        sequence += b.times
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "first", "sequence", "offset"), columns))


def pack(pieces: DataFrame, key: list[str], length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; each piece is placed once.

    ``key`` tells pieces apart and its columns order equal lengths; rows equal in all of
    them are interchangeable. Lengths must be from 1 to ``capacity``. An empty table
    gives an empty result.
    """
    spark = pieces.sparkSession
    histogram = {int(r[0]): int(r[1]) for r in pieces.groupBy(length).count().collect()}
    index = placement_index(pack_histogram(histogram, capacity))
    held = spark.sparkContext.broadcast(index)  # bounded: it follows the lengths, not the rows
    row = F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("_row")  # so that no column's name clashes
    by = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(key)]
    order = [F.col(f"_k{i}") for i in range(len(key))]
    narrow = pieces.select(row, F.col(f"`{length}`").cast("long").alias("_length"), *by)
    ranked = global_rank(narrow, ["_length"], [k.asc_nulls_first() for k in order], F.struct(*order), buckets_for(sum(histogram.values()))).select("_row", "_length", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = held.value
        span = np.int64(1) << 44
        keys = runs["length"] * span + runs["first"]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, batch.column("_length").to_numpy() * span + rank, side="right") - 1
            sequence = runs["sequence"][at] + rank - runs["first"][at]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(sequence), pa.array(runs["offset"][at])], names=["_row", "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in pieces.schema)
    placed = ranked.mapInArrow(place, f"_row struct<{kinds}>, sequence_id long, offset long")
    return placed.select(*[F.col(f"_row.`{c}`").alias(c) for c in pieces.columns if c not in ("sequence_id", "offset")], "sequence_id", "offset")


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids): a document's ids and the end id, cut only where longer than ``capacity``.

    A null text counts as empty and gives the end id alone.
    """
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END_ID], "<u4").tobytes()
        wide = 4 * capacity
        for batch in batches:
            keys = batch.column(0)
            for at, texts in texts_in_parts(batch.column(1)):
                rows, piece, start, ids = [], [], [], []
                for i, made in enumerate(encoder(tokenizer).encode(texts)):
                    made += end
                    for p, s in enumerate(range(0, len(made), wide)):
                        rows.append(at + i)
                        piece.append(p)
                        start.append(s // 4)
                        ids.append(made[s : s + wide])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), id_lists(ids)],
                    names=[key, "piece", "start", "length", "ids"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, docs[text].cast("string")).mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids array<int>")


def op4_config_lp_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 2048 tokens.

    Repeated rows are packed once each.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = Scratch(spark, "pack").keep(token_pieces(docs, vocabulary(WORD_BPE)), "pieces")
    narrow = pieces.select("doc_id", "piece", "start", "length", crc32_ids(F.col("ids")).alias("ids_crc32"))
    return pack(narrow, ["doc_id", "piece", "start"])
