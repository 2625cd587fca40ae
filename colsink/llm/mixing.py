"""Mixing sources to target weights by entropy balancing.

Documents get weights, their expected numbers of copies. Among all weights from 0 to
``most`` whose token total is right for every source, the balance takes those of least
relative entropy to the corpus as it is: minimise sum_d w_d ln w_d - w_d subject to
sum_d w_d n_d = T_s for each source s, n_d being a document's tokens. The dual of that
problem is convex, and its optimum is an exponential tilt, w_d = min(most, exp(l_s n_d)).

Each Newton step on the dual is a job: a source's total (the gradient) and its change
(the Hessian, diagonal as each document has one source) are summed over the histogram of
(source, size). A step that leaves the interval known to hold the optimum halves it
instead. Sums are of whole numbers, so reruns agree to the last bit. Multipliers are a
table of one row a source that stays on the executors, as do targets: nothing that grows
with the sources reaches the driver.

Rates become whole copies without a random draw: documents of a source are dealt
into size classes and put in order by a hash, and a document gets as many copies as whole
numbers lie between the running totals of rates before and after it. Within a class the
error stays under one document. What the classes leave over is then repaid by moving
single documents, one per class at most, largest class first.

Defined cases: documents without words get no copies; a null source is one of its own, the
last; a null key is a key. Rows equal in key, source and size (repeated rows) get the same
copies. Sources that tie in the order can't be, as they are distinct. A very long document
counts by its size alone. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsink.llm.common import Scratch, buckets_for, n_words, never_null, read_table, running_total, shuffle_width

SEED = 31_337
#: Rates are whole numbers of this part while they are rounded, and of a finer one while they are solved.
ONE, FINE = 1 << 20, 1 << 30
NEAR = 1e-7  # of a source's total from its target


def source_targets(narrow: DataFrame, scratch: Scratch, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, most: int = 3) -> DataFrame:
    """(_s, source_size, target), a row for each source of ``narrow`` (_s, _n).

    Sources are taken by code point, null last, and weigh ``weights`` in turn. Those whose
    share of the total is above ``most`` times their size get that much and the excess is
    shared out again; each round is one aggregate. If all are capped, the rest is not given out.
    """
    totals = narrow.groupBy("_s").agg(F.sum("_n").alias("source_size"))
    # numbered in their order over range partitions; "" stands for null and comes last
    order = [F.col("_s") == "", F.col("_s")]
    placed = totals.repartitionByRange(shuffle_width(narrow.sparkSession), *order).sortWithinPartitions(*order)
    placed = scratch.keep(placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "placed")
    counts = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}  # one row a partition
    firsts = {p: sum(n for q, n in counts.items() if q < p) for p in counts}
    first = F.element_at(F.create_map(*[F.lit(x) for pair in firsts.items() for x in pair]), F.col("_part")) if firsts else F.lit(0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(first + F.col("_at"), F.lit(len(weights))).cast("int") + 1)
    ranked = scratch.keep(placed.select("_s", "source_size", weight.cast("long").alias("_w")), "sources")

    whole = lambda c: c.cast("decimal(38,0)")
    total = round(share * int(ranked.agg(F.sum(whole(F.col("source_size")))).first()[0] or 0))
    left, mass = total, int(ranked.agg(F.sum("_w")).first()[0] or 0)
    while True:
        # those over the cap at one level of water stay over it as the level rises
        over = whole(F.col("_w")) * F.lit(left).cast("decimal(20,0)") > whole(F.col("source_size") * most) * F.lit(mass).cast("decimal(18,0)")
        capped = F.when(over, F.struct(whole(F.col("source_size")).alias("n"), whole(F.col("_w")).alias("w")))
        now = ranked.agg(F.sum(capped["n"]).alias("n"), F.sum(capped["w"]).alias("w"), F.sum("_w").alias("all")).first()
        after = total - most * int(now["n"] or 0), int(now["all"] or 0) - int(now["w"] or 0)
        if after == (left, mass) or not after[1]:
            break
        left, mass = after
    cap = F.col("source_size").cast("double") * float(most)
    target = F.when(over, cap).otherwise(F.least(cap, F.lit(float(left)) * F.col("_w") / F.lit(float(max(mass, 1)))))
    return scratch.keep(ranked.select("_s", "source_size", target.alias("target")), "targets")


def tilted(tilt: Column, size: Column, most: int) -> Column:
    """min(most, exp(l n)), 0 for a document without words."""
    return F.when(size > 0, F.least(F.exp(tilt * size), F.lit(float(most)))).otherwise(F.lit(0.0))


def tilts(histogram: DataFrame, targets: DataFrame, scratch: Scratch, most: int = 3) -> DataFrame:
    """(_s, target, source_size, tilt) that solve the dual; ``histogram`` is (_s, _n, _m) with sizes above 0.

    A tilt that has no finite value is infinite: a target of 0, or one that takes all copies.
    """
    sizes = histogram.groupBy("_s").agg(F.min("_n").alias("least"), F.max("_n").alias("top"), (F.sum(F.col("_m").cast("double") * F.col("_n") * F.col("_n")) / F.sum(F.col("_m").cast("double") * F.col("_n"))).alias("typical"))
    ratio = F.log(F.try_divide("target", "source_size"))
    none, every = F.col("target") <= 0, F.col("target") >= F.lit(float(most)) * F.col("source_size")
    state = targets.join(sizes, "_s", "left").withColumns({"_a": ratio / F.col("least"), "_b": ratio / F.col("top"), "_m": ratio / F.round("typical", 3)})
    start = F.when(none, F.lit(float("-inf"))).when(every, F.lit(float("inf"))).otherwise(F.greatest(F.least("_m", F.greatest("_a", "_b")), F.least("_a", "_b")))
    done = none | every | F.col("least").isNull()
    state = state.select("_s", "target", "source_size", start.alias("tilt"), F.least("_a", "_b").alias("lo"), F.greatest("_a", "_b").alias("hi"), done.alias("done"))
    state, at = scratch.keep(state, "tilts-0"), 0
    while not state.where("NOT done").isEmpty():
        state, before = scratch.keep(newton_step(histogram, state, most), f"tilts-{at + 1}"), at
        scratch.drop(f"tilts-{before}")
        at += 1
    return state.select("_s", "target", "source_size", "tilt")


def newton_step(histogram: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """The next multipliers: one distributed sum of gradient and Hessian over (source, size)."""
    rate = tilted(F.col("tilt"), F.col("_n"), most)
    fine = F.round(rate * FINE).cast("decimal(11,0)")
    tokens = F.col("_m").cast("decimal(15,0)") * F.col("_n").cast("decimal(11,0)")
    bending = F.when(rate < most, tokens * fine).otherwise(F.lit(0)).cast("decimal(30,0)") * F.col("_n").cast("decimal(8,0)")
    sums = histogram.join(state.where("NOT done").select("_s", "tilt"), "_s").groupBy("_s")
    sums = sums.agg((F.sum((tokens * fine).cast("decimal(38,0)")).cast("double") / FINE).alias("got"), (F.sum(bending.cast("decimal(38,0)")).cast("double") / FINE).alias("bend"))
    off = F.col("got") - F.col("target")
    lo, hi = F.when(off > 0, F.col("lo")).otherwise(F.col("tilt")), F.when(off > 0, F.col("tilt")).otherwise(F.col("hi"))
    newton = F.col("tilt") - off / F.when(F.col("bend") > 0, F.col("bend"))
    inside = F.coalesce((newton > lo) & (newton < hi), F.lit(False))
    met = F.coalesce((F.abs(off) <= NEAR * F.col("target")) | (lo >= hi), F.lit(True))
    moved = F.when(F.col("done") | met, F.col("tilt")).when(inside, newton).otherwise((lo + hi) / 2)
    joined = state.join(sums, "_s", "left")
    return joined.select("_s", "target", "source_size", moved.alias("tilt"), F.coalesce(lo, "lo").alias("lo"), F.coalesce(hi, "hi").alias("hi"), (F.col("done") | met).alias("done"))


def copies(narrow: DataFrame, solved: DataFrame, scratch: Scratch, most: int = 3) -> DataFrame:
    """(_k, _s, _n, copies, source_size, target): one row for each key, source and size of ``narrow``.

    Sources' totals come near their targets. The result doesn't depend on how the input is partitioned.
    """
    units = narrow.groupBy("_k", "_s", "_n").agg(F.count(F.lit(1)).alias("_m"))
    size_class = F.when(F.col("_n") > 0, F.floor(F.log2(F.col("_n").cast("double")) * 4)).otherwise(F.lit(-1)).cast("int")
    rated = units.join(solved, "_s").withColumns({"_class": size_class, "_rate": F.round(tilted(F.col("tilt"), F.col("_n"), most) * ONE).cast("long")})
    order = [F.xxhash64("_k", F.lit(SEED)), F.col("_k"), F.col("_n")]
    summed = running_total(rated, ["_s", "_class"], order, F.struct("_k", "_n"), F.col("_rate"), "_before", buckets_for(narrow.count()))
    start = F.col("_before") + F.pmod(F.xxhash64("_s", "_class", F.lit(SEED)), F.lit(ONE))
    drawn = F.shiftright(start + F.col("_rate"), ONE.bit_length() - 1) - F.shiftright(start, ONE.bit_length() - 1)
    names = ["_k", "_s", "_n", "source_size", "target"]
    rounded = scratch.keep(summed.select(*names, "_m", "_class", drawn.cast("int").alias("copies")), "rounded")
    settled = rounded.join(_repayments(rounded, most), ["_s", "_k", "_n"], "left")
    return settled.select(*names, (F.col("copies") + F.coalesce("move", F.lit(0))).cast("int").alias("copies"))


def _repayments(rounded: DataFrame, most: int) -> DataFrame:
    """(_s, _k, _n, move): single rows moved by one copy to bring sources' totals nearer.

    Of each source and class one row is offered for each direction, so a source has some
    hundred offers whatever the data's size (classes follow the logarithm of the size);
    they are settled on the executors, largest first, each taken if it brings the total nearer.
    """

    def at(which: Column) -> Column:
        return F.min(F.when(which & (F.col("_m") == 1) & (F.col("_n") > 0), F.struct(F.xxhash64("_k", F.lit(SEED + 1)).alias("h"), F.col("_k"), F.col("_n"))))

    per_class = rounded.groupBy("_s", "_class").agg(
        F.sum(F.col("copies") * F.col("_n") * F.col("_m")).alias("taken"), F.max("target").alias("target"), at(F.col("copies") < most).alias("up"), at(F.col("copies") > 0).alias("down")
    )
    offers = F.sort_array(F.collect_list(F.struct("_class", "up", "down")), asc=False).alias("offers")
    per_source = per_class.groupBy("_s").agg((F.max("target") - F.sum("taken")).alias("left"), offers)

    def settle(so_far: Column, offer: Column) -> Column:
        left = so_far["left"]
        row, sign = F.when(left > 0, offer["up"]).otherwise(offer["down"]), F.when(left > 0, 1).otherwise(-1)
        after = left - sign * row["_n"]
        better = F.coalesce(F.abs(after) < F.abs(left), F.lit(False))
        taken = F.array(F.struct(row["_k"].alias("_k"), row["_n"].alias("_n"), sign.alias("move")))
        return F.struct(F.when(better, after).otherwise(left).alias("left"), F.when(better, F.concat(so_far["moves"], taken)).otherwise(so_far["moves"]).alias("moves"))

    empty = F.array().cast("array<struct<_k:string,_n:bigint,move:int>>")
    moves = F.aggregate("offers", F.struct(F.col("left"), empty.alias("moves")), settle, lambda end: end["moves"])
    return per_source.select("_s", F.inline(moves))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, most: int = 3, key: str = "doc_id", source: str = "source", size: str = "size") -> DataFrame:
    """``docs`` with source_size, target and copies; one row each, the rows as they were.

    What decides, key, source and size, is written once and read from there, so that texts
    are measured once more at most. The caller may repeat rows ``copies`` times. Columns of
    ``docs`` keep their values, but for one named ``copies``, which is replaced.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    deciding = [never_null(docs[key]).alias("_k"), never_null(docs[source]).alias("_s"), F.coalesce(docs[size].cast("long"), F.lit(0)).alias("_n")]
    narrow = scratch.keep(docs.select(*deciding), "narrow")
    histogram = scratch.keep(narrow.where("_n > 0").groupBy("_s", "_n").agg(F.count(F.lit(1)).alias("_m")), "histogram")
    solved = tilts(histogram, source_targets(narrow, scratch, weights, share, most), scratch, most)
    made = copies(narrow, solved, scratch, most)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # so that no column's name clashes
    out = docs.select(row.alias("_row"), *deciding).join(made, ["_k", "_s", "_n"])
    added = [c for c in ("source_size", "target") if c not in docs.columns]
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != "copies"], *added, "copies")


def op7_entropy_mix(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, sources weighing 5, 2, 1 in turn, 100% of all words.

    Null and empty texts have size 0 and are not taken; repeated rows count one each.
    """
    docs = read_table(spark, sf_dir, "documents")
    sized = Scratch(spark, "sizes").keep(docs.select("doc_id", "source", n_words(docs["text"]).alias("size")), "sized")
    out = mix(sized)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
