"""Near duplicates by min-max hashing with exact confirmation.

Each of ``perms`` permutations of the shingle hashes gives a document two values, its
minimum and its maximum, so a signature takes half the hash evaluations that minima
alone would. Four values make a band; documents that share a band's bucket are
candidates, and every link is confirmed on the full shingle sets.

How large groups are kept from making all pairs:

* Documents with equal sets form a class; only its smallest id goes on.
* Each bucket is first compared with one centre, the member that shares its buckets
  with most others. Confirmed links merge what lies close to a centre, and every member
  keeps how much it shares with the centre and which shingles the centre lacks.
* Only pairs that are still in different components and share a bucket remain. Two
  members share at most what the lesser of them shares with the centre, and what both
  have beyond it. That exact bound, the sizes and the first shared band stand in the
  join's condition, so a pair comes out at most once and only where it may be a link.

At the similarities in use, a link shares no band with a chance of about 1 in 10^5 or less.

Defined cases: a row with a null id has no component and is kept; null or empty texts and texts without words have an empty set, stay
their own component and are kept. Repeated rows with one id and one text belong to one
class. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsink.llm.common import Scratch, read_table
from colsink.llm.shingles import shingle_sets
from colsink.llm.tokenizing import small_batches

_U32 = np.uint32


@dataclass(frozen=True)
class NearDup:
    """``percent``: least similarity; ``bands`` of ``rows`` signature values each."""

    width: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 4

    @property
    def perms(self) -> int:
        """Each permutation gives two values."""
        return -(-self.bands * self.rows // 2)

    def linked(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)


def signatures(hashes: np.ndarray, sizes: np.ndarray, perms: int) -> np.ndarray:
    """Rows of [min, max] pairs, one pair a permutation; sets must not be empty."""
    x = (hashes >> np.uint64(32)).astype(_U32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    draw = np.random.default_rng(77_003).integers(0, 2**32, (perms, 2), dtype=np.uint64).astype(_U32) | _U32(1)
    out = np.empty((len(sizes), 2 * perms), _U32)
    # blocks of whole sets that stay in cache
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + 65_536, side="right")))
        part, cuts = x[starts[at] : ends[to - 1]], starts[at:to] - starts[at]
        for p in range(perms):
            y = part * draw[p, 0]
            y ^= y >> _U32(16)
            y *= draw[p, 1]
            out[at:to, 2 * p] = np.minimum.reduceat(y, cuts)
            out[at:to, 2 * p + 1] = np.maximum.reduceat(y, cuts)
        at = to
    return out


def band_keys(sig: np.ndarray, how: NearDup) -> np.ndarray:
    """A 64-bit key for each row and band; keys of different bands differ."""
    keys = np.empty((len(sig), how.bands), np.uint64)
    for b in range(how.bands):
        key = np.full(len(sig), b + 1, np.uint64)
        for v in range(b * how.rows, (b + 1) * how.rows):
            key = (key ^ sig[:, v]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, b] = key * np.uint64(0xBF58476D1CE4E5B9)
    return keys


def signed(docs: DataFrame, how: NearDup, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, s1, s2, keys): set size, a 128-bit name of the set and the band keys of its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, hashes, sizes in shingle_sets(batch.column(1), how.width):
                full = sizes > 0
                n = len(sizes)
                s1, s2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                keys = np.zeros((n, how.bands), np.uint64)
                if full.any():
                    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    s1[full] = np.add.reduceat(hashes * (hashes | np.uint64(1)), starts)
                    s2[full] = np.bitwise_xor.reduceat(hashes * np.uint64(0xD6E8FEB86659FD93) ^ hashes >> np.uint64(31), starts)
                    keys[full] = band_keys(signatures(hashes, sizes[full], how.perms), how)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, n),
                        pa.array(sizes),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * how.bands), pa.array(keys.view(np.int64).ravel())),
                    ],
                    names=["id", "n", "s1", "s2", "keys"],
                )

    narrow = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, n long, s1 long, s2 long, keys array<long>")


def compared(pairs: DataFrame, texts: DataFrame, how: NearDup) -> DataFrame:
    """(a, b, shared, linked, extra) of ``pairs`` (a, b) by their full shingle sets; ``texts`` is (id, t).

    ``extra`` has the shingles of a that b lacks, where they are less than half of a's.
    Texts travel to pairs, never pairs to a driver; ``b`` is the side that repeats, so
    its text is joined last and not shuffled again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, str | None] = (None, None)
        right = np.empty(0, np.uint64)
        for batch in batches:
            b, tb = batch.column("b").to_pylist(), batch.column("tb")
            left: list[np.ndarray] = []
            for _, hashes, sizes in shingle_sets(batch.column("ta"), how.width):
                left += np.split(hashes, np.cumsum(sizes)[:-1])
            shared, linked, extra = [], [], []
            for i, mine in enumerate(left):
                now = b[i], tb[i].as_py()
                if last != now:
                    last, right = now, next(shingle_sets(tb.slice(i, 1), how.width))[1]
                at = np.minimum(np.searchsorted(right, mine), len(right) - 1)
                both = right[at] == mine
                n = int(both.sum())
                shared.append(n)
                linked.append(how.linked(n, len(mine), len(right)))
                extra.append(mine[~both].view(np.int64) if 2 * n > len(mine) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(linked, pa.bool_()), pa.array(extra, pa.list_(pa.int64()))],
                names=["a", "b", "shared", "linked", "extra"],
            )

    both = pairs.join(texts.withColumnsRenamed({"id": "a", "t": "ta"}), "a").join(texts.withColumnsRenamed({"id": "b", "t": "tb"}), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, shared long, linked boolean, extra array<long>")


def may_link(how: NearDup) -> Column:
    """Sizes, and what both share with the bucket's centre, allow r and m a link."""
    n, k = F.col("r.n"), F.col("m.n")
    beyond = F.size(F.array_intersect("r.extra", "m.extra"))
    most = F.least(F.col("r.shared"), F.col("m.shared")) + beyond
    known = F.col("r.extra").isNotNull() & F.col("m.extra").isNotNull()
    most = F.when(known, F.least(most, n, k)).otherwise(F.least(n, k))
    return (F.least(n, k) * 100 >= F.greatest(n, k) * how.percent) & (most * 100 >= (n + k - most) * how.percent)


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(id, component) of all ids in ``links`` (a, b): the smallest id reachable.

    Each round takes the least label among neighbours and then the label of that label,
    so chains shorten by halves. Labels are written each round to cut lineage.
    """
    spark = links.sparkSession
    edges = scratch.keep(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")), f"{label}-edges")
    now = scratch.keep(edges.groupBy(F.col("u").alias("id")).agg(F.least(F.col("id"), F.min("v")).alias("component")), f"{label}-0")
    at = 0
    while True:
        near = edges.join(now.withColumnRenamed("id", "v"), "v").groupBy(F.col("u").alias("id")).agg(F.min("component").alias("near"))
        step = now.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        up = step.select(F.col("id").alias("new"), F.col("new").alias("root"))
        made = step.join(up, "new").select("id", F.least("new", "root").alias("component"), F.least("new", "root") != F.col("old"))
        made = scratch.keep(made.toDF("id", "component", "moved"), f"{label}-{at + 1}")
        done = made.where("moved").isEmpty()
        scratch.drop(f"{label}-{at}")
        now, at = made.select("id", "component"), at + 1
        if done:
            scratch.drop(f"{label}-edges")
            return now


def near_dup(docs: DataFrame, how: NearDup = NearDup(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    Rows are judged by their own text; where one id has several texts and is the
    smallest of their classes, those classes share a component.
    """
    spark = docs.sparkSession
    small_batches(docs)
    scratch = Scratch(spark, "near-dup")
    every = scratch.keep(signed(docs, how, key, text), "signed")

    # classes of equal sets; what a class keeps besides its id is the same for all its rows
    named = every.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("id"), F.first(F.struct("n", "keys")).alias("x"))
    classes = scratch.keep(named.select("s1", "s2", "id", "x.n", "x.keys"), "classes")

    # buckets with two classes or more
    members = classes.select("id", F.posexplode("keys").alias("band", "key"))
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("in_bucket")).where("in_bucket > 1")
    shared = scratch.keep(members.join(counts, "key"), "shared")
    mates = shared.groupBy("id").agg(F.sum("in_bucket").alias("mates"))
    near = scratch.keep(classes.select("id", "n", "keys").join(mates, "id"), "near")
    texts = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("t"))
    texts = scratch.keep(texts.join(near.select("id"), "id", "left_semi").distinct(), "texts")

    # first against a centre
    rank = F.struct("mates", (-F.col("id")).alias("least"))
    centres = scratch.keep(shared.join(near.select("id", "mates"), "id").groupBy("key").agg((-F.max(rank)["least"]).alias("b")), "centres")
    first = shared.join(centres, "key").where("id != b").select(F.col("id").alias("a"), "b").distinct()
    first = scratch.keep(compared(first, texts, how), "first")
    links = first.where("linked").select("a", "b")
    labels = components(links, scratch, "first")

    # then what is still apart within a bucket
    tagged = scratch.keep(shared.join(labels, "id", "left").select("key", "band", "id", F.coalesce("component", "id").alias("c")), "tagged")
    sizes = tagged.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"))
    parted = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("k", "c"))["c"].alias("major")).where("parts > 1").select("key", "major")
    apart = tagged.join(parted, "key").join(centres, "key").join(near.select("id", "n", "keys"), "id")
    met = first.select(F.col("a").alias("id"), "b", F.col("shared").alias("s"), F.col("extra").alias("e"))
    own = F.col("id") == F.col("b")
    none = F.array().cast("array<bigint>")
    apart = apart.join(met, ["id", "b"], "left").withColumns({"shared": F.when(own, F.col("n")).otherwise(F.col("s")), "extra": F.when(own, none).otherwise(F.col("e"))})
    apart = scratch.keep(apart.drop("s", "e", "b"), "apart")
    r, m = apart.where("c != major").alias("r"), apart.alias("m")
    before = F.col("r.band")  # bands count from 0: as many bands come before
    unseen = ~F.arrays_overlap(F.slice("r.keys", F.lit(1), before), F.slice("m.keys", F.lit(1), before))
    once = (F.col("m.c") == F.col("m.major")) | (F.col("r.id") < F.col("m.id"))
    on = (F.col("r.key") == F.col("m.key")) & (F.col("r.c") != F.col("m.c")) & once & may_link(how) & unseen
    rest = r.join(m, on).select(F.col("r.id").alias("a"), F.col("m.id").alias("b"))
    more = scratch.keep(compared(rest, texts, how).where("linked").select("a", "b"), "rest")
    if not more.isEmpty():
        labels = components(links.union(more), scratch, "all")

    roots = classes.select("s1", "s2", F.col("id").alias("root")).join(labels.withColumnRenamed("id", "root"), "root", "left")
    roots = roots.select("s1", "s2", F.coalesce("component", "root").alias("component"))
    out = every.select("id", "n", "s1", "s2").join(roots, ["s1", "s2"], "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"))


def op3_minmax_near_dup(spark, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` at 85% of three-word shingles."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_dup(docs, NearDup(width=3, percent=85))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: What ``op3_minmax_near_dup`` returns: all pairs that share a shingle are compared, and links are followed from each document.
OP3_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS s FROM worded),
classes AS (SELECT min(doc_id) AS id, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
members AS (SELECT x.doc_id, c.id FROM sets x JOIN classes c ON list_sort(x.s) = c.s),
held AS (SELECT id, len(s) AS n, unnest(s) AS k FROM classes),
pairs AS (
    SELECT a.id AS a, b.id AS b FROM held a JOIN held b ON a.k = b.k AND a.id < b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT id AS a, id AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id, coalesce(l.component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN members m ON m.doc_id = s.doc_id LEFT JOIN least l ON l.a = m.id
"""
