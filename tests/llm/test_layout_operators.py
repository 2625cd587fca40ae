"""Packing, sharding, token files, mixing, the byte network, image copies and the pipeline."""

import glob
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from colsink.llm import byte_cnn, image_copies, mixing, packing, sharding, token_files
from colsink.llm.common import Scratch, global_rank
from colsink.llm.tokenizing import BYTE_BPE, WORD_BPE, Encoder, vocabulary

ODD = [
    "", "  ", " a", "a ", "a  b", "\n", "a\n\nb", "x\ty\rz", "don't stop. it's", "A.B. c,d", "\0 a", "\x01 b \x01", "é́ x", "<|endoftext|> hi", "Word,. 5. x5.",
    "a \x01. b", "İstanbul ΣΑΣ. ΟΔΟΣ, ß", "a.́ b", "12,345.67 a1. 二。 二.", "a\x1cb c", "x y  z", "w" * 5000, "é" * 100 + " 😀 .", "  a\x85b",
]


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["s"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def table(spark, folder, df, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def prose(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(n)) + "."


# tokens


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
@pytest.mark.parametrize("most", [0, 5, 10_000])
def test_pieces_equal_whole_texts(name, most):
    r = random.Random(2)
    texts = ODD + ["".join(r.choices("ab .,'\n5é\t<|>A", k=r.randint(0, 60))) for _ in range(1500)] + [prose(r, 50) for _ in range(20)]
    encoder = Encoder(vocabulary(name), most_pieces=most)
    assert encoder._whole(texts) == encoder.encode(texts)
    assert encoder._whole(texts) == encoder.encode(texts)


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_letters_go_straight_to_the_merges(name):
    letters = [chr(c) for c in range(33, 0x260)]
    texts = [f"{a}b {a} x{a}{b} {b.upper()}{a}, Y{a}. {a}'s" for a, b in zip(letters, [*letters[7:], *letters[:7]])]
    encoder = Encoder(vocabulary(name))
    assert encoder.mark is not None and encoder._whole(texts) == encoder.encode(texts)


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_contractions_at_a_texts_start_and_runs_of_marks(name):
    texts = [f"{a}{w}{m} {w}{m}" for a in ("", "'", "''") for w in ("s", "twas", "reß", "ll's", "dé") for m in ("", ".", "***", ",&&&", ".#", "$%'")]
    encoder = Encoder(vocabulary(name))
    assert encoder._whole(texts) == encoder.encode(texts)


def expected_ids(name, texts):
    return [np.append(np.frombuffer(x, "<u4"), np.uint32(0)).astype("<u4") for x in Encoder(vocabulary(name))._whole([t or "" for t in texts])]


def test_token_files(spark, tmp_path):
    r = random.Random(5)
    texts = [None, *ODD, *[prose(r, r.randint(1, 400)) for _ in range(60)], prose(r, 15_000)]
    df = documents(spark, texts).withColumn("doc_id", F.col("doc_id") * 7919 % 1000)
    made = token_files.op6_token_lists(spark, table(spark, tmp_path, df)).orderBy("doc_id").collect()
    ids = dict(zip([i * 7919 % 1000 for i in range(len(texts))], expected_ids(BYTE_BPE, texts)))
    at = 0
    for row, key in zip(made, sorted(ids), strict=True):
        assert tuple(row) == (key, at, len(ids[key]), zlib.crc32(ids[key].tobytes()))
        at += len(ids[key])


def test_token_file_format(spark, tmp_path):
    r = random.Random(6)
    df = documents(spark, [prose(r, 100) for _ in range(300)])
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df, path, vocabulary(BYTE_BPE), partitions=2, page_rows=20)
    file = sorted(glob.glob(f"{path}/*.parquet"))[0]
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings and columns["doc_id"].encodings == ("DELTA_BINARY_PACKED",)
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    some = token_files.read_tokens(spark, path, 100, 120)
    assert sorted(x["doc_id"] for x in some.collect()) == list(range(100, 121))
    plan = some.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan and "ReadSchema: struct<doc_id:bigint,n_tokens:int>" in plan


def test_token_files_of_odd_tables(spark, tmp_path):
    rows = [(3, "b"), (3, "b"), (3, "a"), (None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash"))
    made = token_files.op6_token_lists(spark, table(spark, tmp_path / "a", df)).orderBy("start").collect()
    assert [x["start"] for x in made] == [0, 2, 4, 6] and [x["doc_id"] for x in made] == [None, 3, 3, 3]
    assert token_files.op6_token_lists(spark, table(spark, tmp_path / "b", df.limit(0))).count() == 0


# packing


def check_plan(histogram, capacity):
    blocks = packing.pack_histogram(dict(histogram), capacity)
    packed = {}
    for b in blocks:
        assert b.times > 0 and 0 < sum(b.lengths) <= capacity
        for n in b.lengths:
            packed[n] = packed.get(n, 0) + b.times
    assert packed == {n: c for n, c in histogram.items() if c}
    return sum(b.times for b in blocks)


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece(seed):
    r = random.Random(seed)
    capacity = r.choice((64, 300, 2048))
    histogram = {}
    for _ in range(r.choice((5, 200, 5000))):
        n = min(capacity, int(r.expovariate(5 / capacity)) + 1)
        histogram[n] = histogram.get(n, 0) + 1
    total = check_plan(histogram, capacity)
    least = max(math.ceil(sum(n * c for n, c in histogram.items()) / capacity), sum(c for n, c in histogram.items() if 2 * n > capacity))
    assert total <= least * 1.02 + 2


def test_hard_plans():
    assert check_plan({1366: 30, 682: 30}, 2048) == 30
    assert check_plan({700: 600, 648: 300}, 2048) == 300
    assert check_plan({2048: 10**9, 1: 5}, 2048) == 10**9 + 1
    assert check_plan({1025: 7}, 2048) == 7 and check_plan({}, 2048) == 0
    with pytest.raises(ValueError):
        packing.pack_histogram({2049: 1})


def test_the_program_combines_the_pieces():
    """All lengths take part in the program; what it leaves over is a small part of the pieces."""
    r = random.Random(9)
    histogram = {}
    for n in (min(2048, int(r.expovariate(1 / 500)) + 1) for _ in range(20_000)):
        histogram[n] = histogram.get(n, 0) + 1
    blocks, left = packing.unfolded(histogram, 2048)
    assert sum(left.values()) < 0.25 * 20_000
    assert all(sum(b.lengths) <= 2048 for b in blocks)
    assert sum(b.times for b in blocks if len(b.lengths) > 1) > 0.7 * sum(b.times for b in blocks)
    assert check_plan(histogram, 2048) <= 1.005 * sum(n * c for n, c in histogram.items()) / 2048 + 1


def test_knapsack_equals_brute_force():
    r = np.random.default_rng(3)
    for _ in range(20):
        prices, capacity = r.random(6), int(r.integers(3, 14))
        best = np.zeros(capacity + 1)
        for w in range(1, capacity + 1):
            best[w] = max([best[w - 1], *(best[w - k - 1] + prices[k] for k in range(6) if k + 1 <= w)])
        shape = packing.best_configuration(prices, capacity)
        assert (shape * np.arange(1, 7)).sum() <= capacity and abs((shape * prices).sum() - best[capacity]) < 1e-9


def test_packing(spark, tmp_path):
    r = random.Random(7)
    texts = [None, "", *[prose(r, r.randint(1, 500)) for _ in range(80)], prose(r, 9000), prose(r, 9000)]
    df = documents(spark, texts).unionAll(documents(spark, texts).where("doc_id = 5"))
    made = packing.op4_config_lp_packing(spark, table(spark, tmp_path, df)).collect()
    ids = expected_ids(WORD_BPE, texts)
    expected = [(i, p, s, len(x[s : s + 2048]), zlib.crc32(x[s : s + 2048].tobytes())) for i, x in enumerate(ids) for p, s in enumerate(range(0, len(x), 2048)) for _ in range(1 + (i == 5))]
    assert sorted(tuple(m)[:5] for m in made) == sorted(expected)
    places = {}
    for m in made:
        places.setdefault(m["sequence_id"], []).append((m["offset"], m["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= math.ceil(sum(m["length"] for m in made) / 2048) + 3


def test_packing_of_odd_tables(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (None, 5, None)], "k long, length long, rank string").withColumn("sequence_id", F.lit("old"))
    made = packing.pack(df, ["k"], capacity=10).collect()
    assert len(made) == 3 and len({(m["sequence_id"], m["offset"]) for m in made}) == 3 and {m["rank"] for m in made} == {"a", None}
    assert packing.pack(df.limit(0), ["k"]).count() == 0


# sharding


def test_shards(spark, tmp_path):
    texts = [None, "", *[f"é{i}" for i in range(3000)]]
    df = documents(spark, texts)
    df = df.unionAll(df.where("doc_id < 5")).withColumn("shard", F.lit("clash"))
    made = sharding.op5_hash_tree_shards(spark, table(spark, tmp_path, df)).collect()
    assert len(made) == len(texts) + 5
    slots, by_doc = {}, {}
    for m in made:
        text = (texts[m["doc_id"]] or "").encode()
        assert (m["size"], m["text_crc32"], m["law"]) == (len(text) + 1, zlib.crc32(text), "key")
        slots.setdefault(m["shard"], []).append(m["slot"])
        by_doc.setdefault(m["doc_id"], set()).add((m["shard"], m["grown_shard"]))
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_doc.values())
    moved = [(a, b) for s in by_doc.values() for a, b in s if a != b]
    assert {b for _, b in moved} == {16} and 0.03 < len(moved) / len(by_doc) < 0.09 and max(map(len, slots.values())) < 300


KEYS = np.arange(1, 4001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


@pytest.mark.parametrize("shape", [(2, 2, 4), (4, 2, 16), (3, 3, 8), (1, 1, 1)])
def test_growth_moves_rows_into_the_new_shard_only(shape):
    rack, region, founded = shape
    last = sharding.HashTree.even(1, rack, region, founded).descend(KEYS)
    tree = sharding.HashTree.even(1, rack, region, founded)
    for n in range(1, 41):
        tree = tree.grown()
        now = sharding.HashTree.even(n + 1, rack, region, founded).descend(KEYS)
        assert set(now[now != last].tolist()) <= {n} and (tree.descend(KEYS) == now).all()
        counts = np.bincount(now, minlength=n + 1) / len(KEYS)
        assert np.abs(counts * (n + 1) - 1).max() < 5 * ((n + 1) / len(KEYS)) ** 0.5
        last = now


def test_levels_equal_brute_force():
    """Each level's draws one by one, in plain Python."""
    tree = sharding.HashTree(tuple(1.0 + s % 5 for s in range(20)), 3, 2, 14)

    def unit(key, node, k=0):
        return float(sharding._unit(np.array([key], np.uint64), node, k)[0])

    def descend(key):
        base = {r: sum(w for rack in racks.values() for w in rack.values()) for r, racks in tree.places().items()}
        added = tree.slices()
        draws = {}
        for r in range(4):
            weight = base.get(r, 0) + sum(w for _, w in added.get(r, ()))
            step, shape = (-math.log(unit(key, sharding._REGION + r, k)) - math.log(unit(key, sharding._REGION + r, k + 1)) for k in (0, 2))
            shift = unit(key, sharding._REGION + r, 4)
            point = math.exp(step * (math.floor(math.log(weight) / step + shift) - shift))
            draws[r] = (shape / (point * math.exp(step)), point)
        region = min(draws, key=draws.get)
        at = draws[region][1] - base.get(region, 0)
        if at >= 0:
            for s, w in added[region]:
                at -= w
                if at < 0:
                    return s
        racks = tree.places()[region]
        rack = min(racks, key=lambda k: -math.log(unit(key, sharding._RACK + k)) / sum(racks[k].values()))
        return min(racks[rack], key=lambda s: -math.log(unit(key, sharding._SHARD + s)) / racks[rack][s])

    assert [descend(k) for k in KEYS[:400]] == tree.descend(KEYS[:400]).tolist()


def test_shapes_and_weights():
    shapes = [sharding.HashTree.even(16, *s).descend(KEYS) for s in ((4, 2), (16, 1), (1, 1), (3, 3))]
    assert all((a != b).mean() > 0.3 for i, a in enumerate(shapes) for b in shapes[:i])
    weights = [1.0, 3.0, 0.0, 2.0, 1.0, 1.0, 2.0, 2.0, 4.0, 1.0, 1.0, 1.0, 1.0, 2.0, 1.0, 1.0, 3.0, 2.0]
    before = sharding.HashTree(tuple(weights)).descend(KEYS)
    counts = np.bincount(before, minlength=18) / len(KEYS)
    assert counts[2] == 0 and np.abs(counts - np.array(weights) / sum(weights)).max() < 0.02
    for shard, weight in ((5, 4.0), (9, 0.2), (16, 5.0), (2, 3.0)):
        after = sharding.HashTree((*weights[:shard], weight, *weights[shard + 1 :])).descend(KEYS)
        moved = after != before
        regions = (after if weight > weights[shard] else before)[moved] // 8
        assert moved.any() and set(regions.tolist()) == {shard // 8}  # into, or out of, the region whose weight changed
        if shard < 16:  # and within the region, of its racks
            inside = moved & (before // 8 == after // 8) & (before < 16) & (after < 16) & (before // 4 != after // 4)
            assert set(((after if weight > weights[shard] else before)[inside] // 4).tolist()) <= {shard // 4}
    for bad in ((), (0.0,), (1.0, -1.0)):
        with pytest.raises(ValueError):
            sharding.HashTree(bad)


def test_shards_of_odd_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (7, "x" * 300_000), (7, "x" * 300_000)], "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("slot", "rank", "law")})
    made = sharding.op5_hash_tree_shards(spark, table(spark, tmp_path / "a", df)).collect()
    assert len(made) == 4 and len({(m["shard"], m["slot"]) for m in made}) == 4 and len({m["shard"] for m in made if m["doc_id"] is None}) == 1
    assert sharding.op5_hash_tree_shards(spark, table(spark, tmp_path / "b", df.limit(0))).count() == 0


def test_ranks(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 3).alias("g"))
    ranks = {}
    for r in global_rank(df, ["g"], [F.col("id")], F.col("id")).collect():
        ranks.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())


# mixing


def water_fill(sizes, weights, total, most):
    """Shares of ``total`` by weight, none above ``most`` times its size, in exact fractions."""
    out = [None] * len(sizes)
    while True:
        free = [i for i, t in enumerate(out) if t is None]
        left, mass = total - sum(t for t in out if t is not None), sum(weights[i] for i in free)
        over = [i for i in free if Fraction(left * weights[i], mass) > most * sizes[i]]
        for i in over:
            out[i] = most * sizes[i]
        if not over:
            return [float(Fraction(left * weights[i], mass)) if t is None else float(t) for i, t in enumerate(out)]


def narrow_table(spark, rows):
    return spark.createDataFrame(rows, "_s string, _n long")


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 100], [0, 5], [0], [1, 2, 4, 1000, 0, 3, 50], [5] * 40])
def test_targets_equal_brute_force(spark, sizes):
    names = [f"={chr(0xE9 if i == 1 else 97 + i)}" for i in range(len(sizes) - 1)] + [""]
    names = sorted(names[:-1], key=str.encode) + [""]  # null is the last
    made = mixing.source_targets(narrow_table(spark, list(zip(names, sizes))).repartition(3), Scratch(spark, "t"))
    found = {r["_s"]: r["target"] for r in made.collect()}
    assert [found[n] for n in names] == water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], sum(sizes), 3)


def test_tilts_equal_brute_force(spark):
    """The optimum of the balance, found by halving, on tables of many shapes of sizes and targets."""
    r = random.Random(3)
    sizes = {"=a": [r.randint(1, 300) for _ in range(200)], "=b": [1], "=c": [5] * 30, "=d": [int(r.paretovariate(0.8)) + 1 for _ in range(300)], "=e": [10, 20_000], "=f": [7, 8], "=g": [3, 4]}
    parts = {"=a": 0.3, "=b": 2.2, "=c": 1.7, "=d": 2.9, "=e": 0.01, "=f": 3.0, "=g": 0.0}
    rows = [(s, n) for s, ns in sizes.items() for n in ns]
    histogram = narrow_table(spark, rows).groupBy("_s", "_n").agg(F.count(F.lit(1)).alias("_m"))
    targets = spark.createDataFrame([(s, sum(sizes[s]), parts[s] * sum(sizes[s])) for s in sizes], "_s string, source_size long, target double")
    found = {x["_s"]: x["tilt"] for x in mixing.tilts(histogram, targets, Scratch(spark, "t")).collect()}
    assert found["=f"] == math.inf and found["=g"] == -math.inf
    rate = lambda tilt, n: 3.0 if tilt * n > math.log(3) else math.exp(tilt * n)
    for s in "abcde":
        ns, goal = sizes[f"={s}"], parts[f"={s}"] * sum(sizes[f"={s}"])
        lo, hi = -20.0, 20.0
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if sum(n * rate(mid, n) for n in ns) > goal else (mid, hi)
        assert abs(sum(n * rate(found[f"={s}"], n) for n in ns) - goal) < 1e-5 * goal
        assert all(abs(rate(found[f"={s}"], n) - rate(lo, n)) < 1e-4 for n in ns)
        # no other weights of the same total have less entropy: moves along the constraint don't help
        weights = [rate(found[f"={s}"], n) for n in ns]
        entropy = lambda ws: sum(w * math.log(w) - w for w in ws if w > 0)
        for _ in range(50):
            i, j = r.randrange(len(ns)), r.randrange(len(ns))
            step = r.choice((-1, 1)) * 0.01 * weights[i]
            other = list(weights)
            other[i] += step
            other[j] -= step * ns[i] / ns[j]
            if i != j and min(other) > 0 and max(other) <= 3:
                assert entropy(other) >= entropy(weights) - 1e-6


def test_mix(spark, tmp_path):
    r = random.Random(8)
    sources = [r.choice(["b", "a", "é", None, "hot", "hot", "hot"]) for _ in range(900)]
    texts = [r.choice([None, "", prose(r, r.randint(1, 200))]) if i % 9 == 0 else prose(r, r.randint(1, 200)) for i in range(900)]
    df = documents(spark, texts, sources)
    df = df.unionAll(df.where("doc_id < 20")).withColumns({"copies": F.lit("clash"), "target": F.lit("clash")})
    folder = table(spark, tmp_path, df)
    made = mixing.op7_entropy_mix(spark, folder).collect()
    sizes = {}
    for i in [*range(900), *range(20)]:
        sizes[sources[i]] = sizes.get(sources[i], 0) + len((texts[i] or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = dict(zip(order, water_fill([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], sum(sizes.values()), 3)))
    taken = dict.fromkeys(order, 0)
    assert len(made) == 920
    for m in made:
        n = len((texts[m["doc_id"]] or "").split())
        assert (m["size"], m["source_size"]) == (n, sizes[m["source"]]) and abs(m["target"] - targets[m["source"]]) < 1e-6
        assert m["taken"] % max(n, 1) == 0 and m["taken"] <= 3 * n
        taken[m["source"]] += m["taken"]
    assert all(abs(taken[s] - targets[s]) <= 0.02 * targets[s] for s in order)
    again = mixing.op7_entropy_mix(spark, folder)
    assert sorted(map(str, again.repartition(7).collect())) == sorted(map(str, made))


def test_mix_of_odd_tables(spark, tmp_path):
    assert mixing.op7_entropy_mix(spark, table(spark, tmp_path / "a", documents(spark, []))).count() == 0
    made = mixing.op7_entropy_mix(spark, table(spark, tmp_path / "b", documents(spark, [None, ""], ["x", None]))).collect()
    assert [(m["taken"], m["target"]) for m in made] == [(0, 0.0)] * 2


def test_rates_follow_sizes(spark):
    """Where a source must shrink, long documents give way first, as the tilt has it."""
    r = random.Random(4)
    rows = [(i, s, r.randint(1, 400)) for i, s in enumerate(["a", "a", "b", "c", "c"] * 500)]
    made = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    sign = {}
    for s in "abc":
        mine = [m for m in made if m["source"] == s]
        sign[s] = np.corrcoef([m["size"] for m in mine], [m["copies"] for m in mine])[0, 1]
        assert abs(sum(m["size"] * m["copies"] for m in mine) - mine[0]["target"]) <= 0.01 * mine[0]["target"]
    assert sign["a"] > 0.3 and sign["c"] < -0.3


def test_mix_of_long_documents_and_null_keys(spark):
    rows = [(None, "a", 5), (None, "a", 5), (1, None, 10**7), (1, None, None), (2, "a", 3)]
    made = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    assert len(made) == 5 and all(0 <= m["copies"] <= 3 for m in made) and [m["copies"] for m in made if not m["size"]] == [0]


# byte network


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    parts = [rng.integers(97, 105, n).astype(np.uint8) for n in (3, 40, 90, 0)]
    data, sizes, y, w = np.concatenate(parts), np.array([len(p) for p in parts]), np.array([0, 1, 1, 0], "f4"), np.array([1, 2, 1, 1], "f4")
    net = byte_cnn.ByteCnn.fresh(seed=1, size=3, width=4, filters=5, cell=16)
    net.linear = rng.normal(0, 1, 15).astype("f4")

    def loss():
        net.tables = None
        p = net.score(data, sizes)
        return float((-np.log(np.where(y == 1, p, 1 - p)) * w).sum() / w.sum())

    grads = byte_cnn._gradients(net, data, sizes, y, w, 0.0)
    for values, grad in ((net.filters, grads[1]), (net.vectors, grads[0]), (net.linear, grads[3]), (net.offsets, grads[2])):
        for at in np.argsort(-np.abs(grad).ravel())[:4]:
            kept = values.ravel()[at]
            values.ravel()[at] = kept + 1e-2
            up = loss()
            values.ravel()[at] = kept - 1e-2
            down = loss()
            values.ravel()[at] = kept
            assert abs((up - down) / 2e-2 - grad.ravel()[at]) < 0.05 * abs(grad.ravel()[at]) + 2e-3


def test_chunks_cover_whole_texts():
    net = byte_cnn.ByteCnn.fresh(seed=2)
    net.linear[:] = 1
    net.prepare()
    long = np.full(5000, 97, np.uint8)
    changed = long.copy()
    changed[4990:4997] = [36, 36, 36, 35, 35, 35, 38]
    assert net.score(long, np.array([5000]))[0] != net.score(changed, np.array([5000]))[0]
    both = net.score(np.concatenate([long, changed]), np.array([5000, 5000]))
    assert both[0] == net.score(long, np.array([5000]))[0] and both[1] == net.score(changed, np.array([5000]))[0]


def test_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(4)
    net = byte_cnn.ByteCnn.fresh(seed=3)
    net.linear = rng.normal(0, 1, len(net.linear)).astype("f4")
    net.prepare()
    texts = [rng.integers(32, 127, n).astype(np.uint8) for n in range(521)]
    alone = np.array([net.score(t, np.array([len(t)]))[0] for t in texts])
    for order in (np.arange(521), rng.permutation(521)):
        together = net.score(np.concatenate([texts[i] for i in order]), np.array([len(texts[i]) for i in order]))
        assert np.abs(together - alone[order]).max() < 1e-6
    # every byte is read by a place that counts
    per, laid, live = net.layout(np.concatenate(texts), np.array([len(t) for t in texts]))
    assert live.sum() == sum(max(1, n - 6) for n in range(521)) and live.any(axis=1).all()


def test_scores_do_not_depend_on_partitions(spark):
    r = random.Random(12)
    df = documents(spark, [prose(r, 200)[:n] for n in (0, 1, 6, 7, 250, 253, 255, 256, 257, 262, 263, 511, 512, 513) for _ in range(6)])
    net = byte_cnn.ByteCnn.fresh(seed=3)
    net.linear[:] = 0.3
    scores = [sorted((x["doc_id"], round(x["score"], 6)) for x in byte_cnn.scored(df.repartition(n), net).collect()) for n in (1, 7)]
    assert scores[0] == scores[1]


def test_sample_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c" * 50), (3, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3)], "doc_id long, quality int")
    every = [byte_cnn.labelled_sample(docs.repartition(n), labels, longest=40) for n in (1, 3, 5)]
    assert every[0] == every[1] == every[2] and b"b" not in every[0][0] and b"c" * 50 not in every[0][0]


def test_classifier(spark, tiny, tmp_path):
    out = byte_cnn.op10_byte_cnn(spark, tiny.replace("sf0.001", "sf0.01"))
    made = {r["doc_id"]: r for r in out.collect()}
    labels = spark.read.parquet(tiny.replace("sf0.001", "sf0.01") + "/labels.parquet").collect()
    held = [(r["quality"], made[r["doc_id"]]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(m["held_out"] for _, m in held) and sum(q == m["predicted"] for q, m in held) / len(held) > 0.9
    assert all(0 <= m["score"] <= 1 and m["predicted"] == int(m["score"] >= 0.3) for m in made.values())


def test_classifier_of_odd_tables(spark, tmp_path):
    folder = table(spark, tmp_path, documents(spark, [None, "", "x" * 300_000, "a"]).withColumn("score", F.lit("clash")))
    labels = spark.createDataFrame([(0, None), (None, 1), (9, 1)], "doc_id long, quality int")
    table(spark, folder, labels, "labels")
    made = byte_cnn.op10_byte_cnn(spark, folder).orderBy("doc_id").collect()
    assert len(made) == 4 and made[0]["score"] == made[1]["score"] and all(0 <= m["score"] <= 1 for m in made)


# image copies


def texture(seed, h=160, w=150):
    return np.kron(np.random.default_rng(seed).integers(0, 255, (h // 4, w // 4)), np.ones((4, 4))).astype(np.uint8)


def test_copies(spark):
    base = texture(1)
    edited = base.copy()
    edited[50:80, 40:80] = 0
    pictures = {0: texture(2), 1: base, 2: base[30:130, 20:130], 3: edited, 4: np.rot90(base).copy(), 5: base, 6: texture(3), 7: base[:8, :8], 8: base[:8, :8]}
    rows = [(i, image_copies.to_pgm(m)) for i, m in pictures.items()] + [(9, None), (10, b""), (11, b"P5 9 9 255\nshort"), (1, image_copies.to_pgm(base)), (None, image_copies.to_pgm(base))]
    made = image_copies.find_copies(spark.createDataFrame(rows, "id long, image binary").withColumn("name", F.lit("clash"))).collect()
    groups = {r["id"]: r["component_id"] for r in made}
    assert len(made) == len(rows) and groups == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11, None: None}
    assert image_copies.find_copies(spark.createDataFrame([], "id long, image binary")).count() == 0


def test_scales_agree():
    how, base = image_copies.Copies(), texture(4)
    half = base.reshape(80, 2, base.shape[1] // 2, 2).mean(axis=(1, 3)).astype(np.uint8)
    a, b, c = image_copies.features([base, half, texture(5)], how)
    assert image_copies.agreeing(b, a, how) > 0.8 * len(b.y) and image_copies.agreeing(c, a, how) < how.least_agreeing


def smooth_texture(seed, h=220, w=220):
    r = np.random.default_rng(seed)
    m = sum(image_copies._summed(r.normal(0, 1, (h, w)).astype("f4"), k) / (2 * k + 1) for k in (1, 2, 4, 8))
    return (m - m.min()) / (m.max() - m.min()) * 255


def warped(m, angle, scale, size):
    """Turned and scaled about the middle, between pixels in straight lines."""
    y, x = (v - size / 2 for v in np.mgrid[:size, :size].astype(float))
    y, x = (np.cos(angle) * y - np.sin(angle) * x) / scale + m.shape[0] / 2, (np.sin(angle) * y + np.cos(angle) * x) / scale + m.shape[1] / 2
    i, j = (np.clip(np.floor(v).astype(int), 0, n - 2) for v, n in zip((y, x), m.shape))
    fy, fx = np.clip(y - i, 0, 1), np.clip(x - j, 0, 1)
    return m[i, j] * (1 - fy) * (1 - fx) + m[i + 1, j] * fy * (1 - fx) + m[i, j + 1] * (1 - fy) * fx + m[i + 1, j + 1] * fy * fx


def test_distorted_copies(spark):
    """Turns, sizes between factors of two, noise, brightness and crops; recall against all pairs."""
    how = image_copies.Copies()
    bases = [smooth_texture(s) for s in range(6)]
    noise = np.random.default_rng(5).normal(0, 10, bases[0].shape)
    edits = {
        "turn": lambda m: warped(m, np.pi / 12, 1, 160), "smaller": lambda m: warped(m, 0, 0.8, 176), "larger": lambda m: warped(m, 0, 1.25, 220),
        "noise": lambda m: m + noise, "brightness": lambda m: m * 0.7 + 40, "crop": lambda m: m[30:180, 20:190], "quarter": lambda m: np.rot90(m), "half": lambda m: warped(m, 0, 0.5, 110),
    }
    pictures = [(k * 100 + i, np.clip(np.rint(f(m)), 0, 255).astype(np.uint8)) for k, f in enumerate([lambda m: m, *edits.values()]) for i, m in enumerate(bases)]
    made = {r["id"]: r["component_id"] for r in image_copies.find_copies(spark.createDataFrame([(i, image_copies.to_pgm(m)) for i, m in pictures], "id long, image binary"), how).collect()}
    assert made == {i: i % 100 for i, _ in pictures}


def test_page_links_equal_all_pairs(spark, tiny):
    """Components are those of all pairs' links: queries are the pages whose id is divisible by 50, against all."""
    pages = spark.read.parquet(tiny.replace("sf0.001", "sf0.01") + "/pages.parquet").collect()
    found = {r["page_id"]: r["component_id"] for r in image_copies.op1_image_copies(spark, tiny.replace("sf0.001", "sf0.01")).collect()}
    how = image_copies.PAGES
    drawn = {r["page_id"]: image_copies.page_picture(r["html"]) for r in pages}
    every = dict(zip(drawn, image_copies.features([image_copies.from_pgm(m) for m in drawn.values()], how)))
    links = lost = 0
    for q in (i for i in drawn if i % 50 == 0 or found[i] != i):
        for i in drawn:
            a, b = sorted((every[q], every[i]), key=lambda f: len(f.y))
            if i != q and len(a.y) >= how.least_agreeing and image_copies.agreeing(a, b, how) >= max(how.least_agreeing, how.least_share * len(a.y)):
                links += 1
                lost += found[q] != found[i]
    assert links > 10 and lost <= 0.1 * links


def test_noisy_copies(spark):
    how, pictures = image_copies.Copies(), [texture(s) for s in range(30, 38)]
    noise = np.random.default_rng(1).normal(0, 20, (8, *pictures[0].shape))
    noisy = [np.clip(m + n, 0, 255).astype(np.uint8) for m, n in zip(pictures, noise)]
    rows = [(i, image_copies.to_pgm(m)) for i, m in enumerate([*pictures, *noisy])]
    made = image_copies.find_copies(spark.createDataFrame(rows, "id long, image binary")).collect()
    assert {r["id"]: r["component_id"] for r in made} == {i: i % 8 for i in range(16)}
    a, b = image_copies.features([np.tile(texture(8, 48, 48), (4, 4)), np.tile(texture(8, 48, 48), (4, 4))[60:, 60:]], how)
    assert image_copies.agreeing(b, a, how) > 0.8 * len(b.y)  # repeats, the first of them cut off


def test_grey_maps():
    base = texture(6)
    assert (image_copies.from_pgm(image_copies.to_pgm(base)) == base).all()
    assert (image_copies.from_pgm(b"P5\n# note\n2 1\n255\nab") == [[97, 98]]).all()
    deep = b"P5 2 1 65535\n" + np.array([[0, 65535]], ">u2").tobytes()
    assert image_copies.from_pgm(deep).tolist() == [[0, 255]] and image_copies.from_pgm(b"P5 2 1 15\n\x00\x0f").tolist() == [[0, 255]]
    assert image_copies.from_pgm(b"P6 1 1 255\nabc") is None and image_copies.from_pgm(None) is None and image_copies.page_picture("") is None


def test_pairs_with_too_few_corners_that_match_go_first():
    r, how = np.random.default_rng(5), image_copies.Copies(most_bits=16)
    common = r.integers(0, 1 << 63, (40, 2), np.uint64)
    images = []
    for n in [0, 1, 5, 6, 7, 20, 35, 60, 90, 20, 8]:
        own, some = r.integers(0, 1 << 63, (n, 2), np.uint64), r.random(n) < r.random()
        own[some] = common[r.integers(0, 40, some.sum())] ^ np.uint64(1) << r.integers(0, 63, (some.sum(), 2)).astype(np.uint64)
        images.append(image_copies.Features(*[np.zeros(n, np.int64)] * 4, own))
    pairs = [(a, b) for b in range(11) for a in range(11)]
    sides = [[images[x].words for x in side] for side in zip(*pairs)]
    p, q = ((np.concatenate(s), np.cumsum([0, *map(len, s)])) for s in sides)
    expected = []
    for a, b in pairs:
        few, many = sorted((images[a], images[b]), key=lambda f: len(f.y))
        met = sum(len(np.unique(i)) for i, _ in image_copies._nearest(few, many, how)) if len(few.y) else 0
        expected.append(met >= max(how.least_agreeing, how.least_share * len(few.y)))
    assert image_copies.possible(np.array([b for _, b in pairs]), p, q, how).tolist() == expected
    assert 10 < sum(expected) < 100
    assert image_copies.possible(np.empty(0, np.int64), (p[0][:0], p[1][:1]), (q[0][:0], q[1][:1]), how).tolist() == []


def test_page_copies(spark, tmp_path):
    r = random.Random(1)
    body, other = prose(r, 600), prose(r, 600)
    pages = [f"<html><head><title>x</title></head><nav>a b</nav><p>{t}</p></html>" for t in (body, body[900:], body[:2000] + " new words " + body[2000:], other)]
    df = spark.createDataFrame([*enumerate(pages), (4, None), (5, ""), (6, pages[0])], "page_id long, html string")
    made = image_copies.op1_image_copies(spark, table(spark, tmp_path, df, "pages")).collect()
    assert {r["page_id"]: r["component_id"] for r in made} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 6: 0}


def test_copies_that_share_words_with_smaller_ids(spark):
    """Each part of a pair's common pixels also stands in a picture of smaller id that is no copy."""
    base, other = texture(7, 288, 288), [texture(s, 288, 288) for s in range(20, 56)]
    for k, m in enumerate(other):
        y, x = (32 * v for v in divmod(k, 6))
        m[y : y + 128, x : x + 128] = base[y : y + 128, x : x + 128]
    rows = [*enumerate(other), (500, base), (700, base[40:248, 40:248])]
    made = image_copies.find_copies(spark.createDataFrame([(i, image_copies.to_pgm(m)) for i, m in rows], "id long, image binary"), image_copies.Copies(least_share=0.5)).collect()
    assert {r["id"]: r["component_id"] for r in made} == {**{i: i for i in range(36)}, 500: 500, 700: 500}


# the pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as pipeline

    r = random.Random(11)
    clean = [prose(r, 80) + "\n" + prose(r, 40) for _ in range(30)]
    texts = [*clean, clean[0], clean[1] + " extra", "### " + " $$$ ".join(prose(r, 1) for _ in range(60)), None, "short", clean[2].replace(".", ". Mail a@b.co now.", 1)]
    df = documents(spark, texts, ["abc"[i % 3] for i in range(len(texts))]).withColumn("rank", F.lit(1))
    folder, scratch = table(spark, tmp_path, df), Scratch(spark, "test")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, folder), name)
        seen[name] = docs
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == df.columns
    ids = {n: sorted(x["doc_id"] for x in d.select("doc_id").collect()) for n, d in seen.items()}
    assert ids["quality_rules"] == [i for i in range(len(texts)) if i not in (32, 33, 34)]
    assert ids["near_dedup"] == ids["personal_data"] == list(range(30))
    assert not seen["personal_data"].where("text LIKE '%a@b.co%'").count()
    counts = {i: ids["mix_sources"].count(i) for i in set(ids["mix_sources"])}
    assert max(counts.values()) <= 3 and set(counts) <= set(range(30))
    words = {s: seen["mix_sources"].where(F.col("source") == s).select(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] for s in "abc"}
    assert abs(words["a"] / sum(words.values()) - 5 / 8) < 0.1
    packed = seen["best_fit_packing"]
    assert sorted(x["doc_id"] for x in packed.where("piece = 0").collect()) == ids["mix_sources"]
    assert pipeline.run(spark, folder).count() == packed.count()
    empty = table(spark, tmp_path / "empty", df.limit(0))
    assert pipeline.run(spark, empty).count() == 0
