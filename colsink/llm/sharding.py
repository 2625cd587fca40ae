"""Sharding by a hierarchical weighted hash tree (law ``key``).

The tree has regions, racks and shards. A row's key draws a region by the regions'
weights, then one of that region's racks, then one of that rack's shards; only children
of the chosen node draw, so a row costs as many hashes as the nodes on its way have
children. A rack or shard draws an exponential time at a rate equal to its weight, and
the earliest wins. Weights that change move rows only into or out of the subtrees that
hold them.

Growth takes rows only into the new shard, at every size:

* A tree is founded with a fixed number of places. A place whose shard doesn't exist yet
  is vacant; a row that draws it draws again, so a shard that moves in takes just those rows.
* A shard beyond the founded places adds a slice to its region's weight. Regions draw
  consistent weighted samples (Ioffe, 2010): a time at a rate equal to the region's whole
  weight and a point that is uniform on it, and both stay as they are until the
  weight passes the next point. A row whose point lies on an added slice goes to
  the shard that added it; any other descends in the founded part.

So the key and the number of shards of equal weight decide, however the tree came to have them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsink.llm.common import crc32_text, global_rank, read_table, text_of

SEED = 20_477
_U = np.uint64
_REGION, _RACK, _SHARD, _AGAIN = (k << 56 for k in (1, 2, 3, 4))


def _unit(key: np.ndarray, name: int, k: int = 0) -> np.ndarray:
    """Numbers between 0 and 1, both excluded, from keys, a node's name and the number of the draw."""
    x = key ^ _U((name + (k << 48)) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0xD6E8FEB86659FD93), (32, 1)):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return ((x >> _U(11)).astype(float) + 0.5) * 2.0**-53


@dataclass(frozen=True)
class HashTree:
    """Shards 0 .. len(weights) - 1, ``per_rack`` to a rack, ``per_region`` racks to a region.

    ``founded`` is the number of places that draw at all levels; a vacant one weighs 1, as
    a whole shard does. It belongs to the law like the shape: trees to be compared share it.
    """

    weights: tuple[float, ...]
    per_rack: int = 4
    per_region: int = 2
    founded: int = 16

    @staticmethod
    def even(shards: int, per_rack: int = 4, per_region: int = 2, founded: int = 16) -> HashTree:
        return HashTree((1.0,) * shards, per_rack, per_region, founded)

    def __post_init__(self) -> None:
        if not any(w > 0 for w in self.weights) or min(self.weights) < 0:
            raise ValueError("a tree needs a shard with a weight above 0 and none below 0")

    def grown(self, weight: float = 1.0) -> HashTree:
        return HashTree((*self.weights, weight), self.per_rack, self.per_region, self.founded)

    def places(self) -> dict[int, dict[int, dict[int, float]]]:
        """The founded part: region, rack and place with their weights above 0."""
        out: dict[int, dict[int, dict[int, float]]] = {}
        for s in range(self.founded):
            weight = self.weights[s] if s < len(self.weights) else 1.0
            if weight > 0:
                rack = s // self.per_rack
                out.setdefault(rack // self.per_region, {}).setdefault(rack, {})[s] = float(weight)
        return out

    def slices(self) -> dict[int, list[tuple[int, float]]]:
        """The added part: by region, the shards beyond the founded places in order of their coming."""
        out: dict[int, list[tuple[int, float]]] = {}
        for s in range(self.founded, len(self.weights)):
            if self.weights[s] > 0:
                out.setdefault(s // self.per_rack // self.per_region, []).append((s, float(self.weights[s])))
        return out

    def descend(self, keys: np.ndarray) -> np.ndarray:
        """The shards of hashed keys (unsigned 64-bit)."""
        out = np.empty(len(keys), np.int32)
        todo, again = np.arange(len(keys)), 0
        while len(todo):  # a vacant place makes a row draw again
            place = self._draw(keys[todo] + _U((_AGAIN + 1) * again % 2**64))
            there = place < len(self.weights)
            out[todo[there]] = place[there]
            todo, again = todo[~there], again + 1
        return out

    def _draw(self, keys: np.ndarray) -> np.ndarray:
        founded, added = self.places(), self.slices()
        base = {r: sum(sum(rack.values()) for rack in racks.values()) for r, racks in founded.items()}
        time, point = np.full(len(keys), np.inf), np.zeros(len(keys))
        region = np.zeros(len(keys), np.int64)
        for r in sorted(base.keys() | added.keys()):
            when, where = sample(keys, _REGION + r, base.get(r, 0.0) + sum(w for _, w in added.get(r, ())))
            first = when < time
            time[first], point[first], region[first] = when[first], where[first], r
        out = np.empty(len(keys), np.int64)
        for r in base.keys() | added.keys():
            mine = np.flatnonzero(region == r)
            if r in added:
                ends = base.get(r, 0.0) + np.cumsum([w for _, w in added[r]])
                beyond = point[mine] >= base.get(r, 0.0)
                which = np.minimum(np.searchsorted(ends, point[mine[beyond]], side="right"), len(ends) - 1)
                out[mine[beyond]] = np.array([s for s, _ in added[r]])[which]
                mine = mine[~beyond]
            racks = founded.get(r, {})
            rack = earliest(keys[mine], _RACK, {k: sum(shards.values()) for k, shards in racks.items()})
            for k, shards in racks.items():
                own = mine[rack == k]
                out[own] = earliest(keys[own], _SHARD, shards)
        return out


def sample(keys: np.ndarray, name: int, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """(time, point) of a consistent weighted sample: exponential at rate ``weight``, uniform below it.

    While the weight grows both stay the same until it passes another point, whose time is earlier.
    """
    step = -np.log(_unit(keys, name, 0)) - np.log(_unit(keys, name, 1))
    shape = -np.log(_unit(keys, name, 2)) - np.log(_unit(keys, name, 3))
    shift = _unit(keys, name, 4)
    point = np.exp(step * (np.floor(np.log(weight) / step + shift) - shift))
    return shape / (point * np.exp(step)), point


def earliest(keys: np.ndarray, level: int, weights: dict[int, float]) -> np.ndarray:
    """The child of earliest exponential time for each key."""
    time, child = np.full(len(keys), np.inf), np.zeros(len(keys), np.int64)
    for c, weight in weights.items():
        when = -np.log(_unit(keys, level + c)) / weight
        first = when < time
        time[first], child[first] = when[first], c
    return child


def sharded(key: Column, tree: HashTree) -> Column:
    """The shard of a key of any type; null keys hash like any value."""

    def run(keys: pa.Array) -> pa.Array:
        return pa.array(tree.descend(keys.to_numpy(zero_copy_only=False).astype(np.int64).view(_U)))

    return F.arrow_udf(run, "int")(F.xxhash64(key, F.lit(SEED)))


def assign_shards(docs: DataFrame, tree: HashTree, key: str = "doc_id", into: str = "shard") -> DataFrame:
    """Each row with its shard; a narrow projection without a shuffle.

    Null keys share one shard, and so do equal keys, whatever the other columns hold, so
    repeated rows and ties don't matter. Only the key's hash travels to Python, so long texts
    don't. An empty table stays empty. A column named ``into`` is replaced.
    """
    return docs.withColumn(into, sharded(docs[key], tree))


def number_slots(rows: DataFrame, shard: str = "shard", key: str = "doc_id", tie: tuple[str, ...] = ()) -> DataFrame:
    """Add ``slot``: the row's place in its shard, gapless from 0.

    Shards are few and may be large, so places are counted in buckets of the key and the ties.
    Rows equal in all of these are interchangeable.
    """
    order = [F.col(c).asc_nulls_first() for c in (key, *tie)]
    return global_rank(rows, [shard], order, F.struct(key, *tie)).withColumnRenamed("rank", "slot")


def op5_hash_tree_shards(spark, sf_dir: str, shards: int = 16) -> DataFrame:
    """All ``documents`` in shards 0 to 15 by law ``key``.

    Null texts have size 1 and the CRC of no bytes; repeated rows keep a slot each.
    """
    docs = read_table(spark, sf_dir, "documents")
    text = text_of(docs)
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), crc32_text(text).cast("long").alias("text_crc32"))
    tree = HashTree.even(shards)
    rows = assign_shards(assign_shards(rows, tree), tree.grown(), into="grown_shard")
    rows = number_slots(rows, tie=("text_crc32", "size"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
