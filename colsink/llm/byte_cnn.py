"""Document quality by a byte-level convolutional network in numpy.

Bytes have learned vectors; filters of ``width`` bytes slide over the whole text. The
positive part of each filter is max-pooled over chunks of two cells, so chunks overlap by
half and cover every byte. A document's features are the mean, the largest and the least
of its chunks' maxima; a linear layer and the logistic function make one probability.

The network is trained on the driver with Adam from a bounded sample of labelled rows:
``per_class`` documents of each label, weighted back to the labels' own shares, none
longer than ``longest`` bytes. Scoring is a map over all rows with the weights broadcast,
a few thousand numbers whatever the data's size.

Defined cases: a null or empty text gets the score of no bytes, a null id is held out,
repeated rows get equal scores, very long texts are read whole in bounded blocks, an empty
table stays empty. A score depends on the row's own text alone, wherever the row lies. Only
the id and the text are read, so other columns' names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsink.llm.common import read_table
from colsink.llm.tokenizing import small_batches

THRESHOLD = 0.3


@dataclass
class ByteCnn:
    """Weights: byte vectors, filters by place, filter offsets, linear layer and its offset."""

    vectors: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    linear: np.ndarray
    bias: float
    cell: int = 256
    tables: np.ndarray | None = field(default=None, repr=False)

    @staticmethod
    def fresh(seed: int = 5, size: int = 8, width: int = 7, filters: int = 16, cell: int = 256) -> ByteCnn:
        rng = np.random.default_rng(seed)
        return ByteCnn(
            rng.normal(0, 1, (256, size)).astype("f4"),
            rng.normal(0, (width * size) ** -0.5, (width, size, filters)).astype("f4"),
            np.zeros(filters, "f4"),
            np.zeros(3 * filters, "f4"),
            0.0,
            cell,
        )

    def prepare(self) -> None:
        """Each place's response to each byte."""
        self.tables = np.einsum("bs,wsf->wbf", self.vectors, self.filters).astype("f4")

    def layout(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells by document, the bytes each cell's places read (a row each), and which places count."""
        width = len(self.filters)
        places = np.maximum(1, sizes - width + 1)
        per = -(-places // self.cell)
        laid = np.zeros((int(per.sum()), self.cell + width - 1), np.uint8)
        live = np.zeros((len(laid), self.cell), bool)
        at = row = 0
        for n, cells, count in zip(sizes.tolist(), per.tolist(), places.tolist()):
            own = np.zeros(cells * self.cell + width - 1, np.uint8)
            own[:n] = data[at : at + n]
            laid[row : row + cells] = np.lib.stride_tricks.sliding_window_view(own, laid.shape[1])[:: self.cell]
            live[row : row + cells].reshape(-1)[:count] = True
            at, row = at + n, row + cells
        return per, laid, live

    def cells(self, data: np.ndarray, sizes: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Largest response of each filter in each cell, its place if asked for, and cells by document.

        ``data`` has the documents' bytes one after another. A place is one where a filter
        reads bytes of its own document alone; a text shorter than a filter has one place,
        with zeros behind it.
        """
        width, n_filters = len(self.tables), self.tables.shape[2]
        per, laid, live = self.layout(data, sizes)
        total = int(per.sum())
        best = np.empty((total, n_filters), "f4")
        place = np.empty((total, n_filters), np.int32) if where else None
        step = 64
        take, acc = np.empty((step * self.cell, n_filters), "f4"), np.empty((step * self.cell, n_filters), "f4")
        for c in range(0, total, step):
            part = laid[c : c + step]
            n = len(part) * self.cell
            np.take(self.tables[0], part[:, : self.cell].ravel(), axis=0, out=acc[:n], mode="clip")
            for w in range(1, width):
                np.take(self.tables[w], part[:, w : w + self.cell].ravel(), axis=0, out=take[:n], mode="clip")
                acc[:n] += take[:n]
            dead = np.flatnonzero(~live[c : c + step].ravel())
            if len(dead):
                acc[dead] = -1e9
            shaped = acc[:n].reshape(-1, self.cell, n_filters)
            if where:
                arg = shaped.argmax(axis=1)
                place[c : c + len(arg)] = arg
                best[c : c + len(arg)] = np.take_along_axis(shaped, arg[:, None, :], 1)[:, 0]
            else:
                shaped.max(axis=1, out=best[c : c + n // self.cell])
        best += self.offsets
        np.maximum(best, 0, out=best)
        return best, place, per

    def features(self, best: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features by document, the chunks' maxima and each document's first chunk."""
        firsts = np.concatenate([[0], np.cumsum(per)[:-1]])
        following = np.arange(len(best)) + 1
        last = firsts + per - 1
        following[last] = last  # the last chunk is one cell; it repeats the end of the one before
        chunks = np.maximum(best, best[following])
        mean = np.add.reduceat(chunks, firsts, axis=0) / per[:, None]
        return np.concatenate([mean, np.maximum.reduceat(chunks, firsts, axis=0), np.minimum.reduceat(chunks, firsts, axis=0)], axis=1), chunks, firsts

    def score(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each document."""
        if self.tables is None:
            self.prepare()
        best, _, per = self.cells(data, sizes)
        logit = self.features(best, per)[0] @ self.linear + self.bias
        return 1 / (1 + np.exp(-np.clip(logit.astype(float), -30, 30)))


def _gradients(net: ByteCnn, data: np.ndarray, sizes: np.ndarray, labels: np.ndarray, weights: np.ndarray, decay: float) -> list[np.ndarray]:
    """Of the weighted log loss, by vectors, filters, offsets, linear and bias."""
    net.prepare()
    best, place, per = net.cells(data, sizes, where=True)
    feats, chunks, firsts = net.features(best, per)
    p = 1 / (1 + np.exp(-np.clip(feats @ net.linear + net.bias, -30, 30)))
    delta = ((p - labels) * weights / weights.sum()).astype("f4")
    g_linear, g_bias = feats.T @ delta + decay * net.linear, float(delta.sum())
    f = best.shape[1]
    doc = np.repeat(np.arange(len(per)), per)
    back = delta[:, None] * net.linear[None, :]
    g_chunk = back[doc, :f] / per[doc][:, None]
    for part in (1, 2):
        hit = chunks == feats[doc][:, part * f : (part + 1) * f]
        ties = np.add.reduceat(hit.astype("f4"), firsts, axis=0)
        g_chunk += hit * (back[:, part * f : (part + 1) * f] / np.maximum(ties, 1))[doc]
    following = np.arange(len(best)) + 1
    last = firsts + per - 1
    following[last] = last
    own = best >= best[following]
    g_cell = np.where(own, g_chunk, 0)
    np.add.at(g_cell, following, np.where(own, 0, g_chunk))
    g_cell[best <= 0] = 0
    # back to bytes: each cell and filter has one place
    width = len(net.tables)
    laid = net.layout(data, sizes)[1]
    cell, flt = np.nonzero(g_cell)
    where = place[cell, flt]
    value = g_cell[cell, flt]
    g_vectors, g_filters = np.zeros_like(net.vectors), np.zeros_like(net.filters)
    for w in range(width):
        table = np.bincount(laid[cell, where + w].astype(np.int64) * f + flt, value, 256 * f).reshape(256, f).astype("f4")
        g_vectors += table @ net.filters[w].T
        g_filters[w] = net.vectors.T @ table
    return [g_vectors, g_filters, g_cell.sum(axis=0).astype("f4"), g_linear, np.float32(g_bias)]


def train(texts: list[bytes], labels: list[int], weights: list[float], steps: int = 350, batch: int = 48, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> ByteCnn:
    """A network fitted to labelled documents; the same input gives the same weights.

    Without documents of both labels it gives the share of label 1 for every text.
    """
    net = ByteCnn.fresh(seed)
    y, w = np.array(labels, "f4"), np.array(weights, "f4")
    if len(y):
        share = float(np.clip((y * w).sum() / w.sum(), 0.01, 0.99))
        net.bias = float(np.log(share / (1 - share)))
    if len(set(labels)) < 2:
        net.prepare()
        return net
    rng = np.random.default_rng(seed)
    sides = [np.flatnonzero(y == v) for v in (0, 1)]
    state = None
    for t in range(1, steps + 1):
        # as many of either label; weights keep their shares in the loss
        pick = np.concatenate([rng.choice(s, min(batch // 2, len(s)), replace=False) for s in sides])
        scale = np.concatenate([np.full(min(batch // 2, len(s)), w[s].sum() / min(batch // 2, len(s)), "f4") for s in sides])
        parts = [np.frombuffer(texts[i], np.uint8) for i in pick]
        grads = _gradients(net, np.concatenate(parts), np.array([len(p) for p in parts]), y[pick], scale, decay)
        if state is None:
            state = [(np.zeros_like(g), np.zeros_like(g)) for g in grads]
        moved = []
        for k, g in enumerate(grads):
            m, v = state[k]
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            state[k] = m, v
            lr = rate * min(1.0, 2 * (1 - t / (steps + 1)))
            moved.append(lr * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8))
        net.vectors -= moved[0].astype("f4")
        net.filters -= moved[1].astype("f4")
        net.offsets -= moved[2].astype("f4")
        net.linear -= moved[3].astype("f4")
        net.bias -= float(moved[4])
    net.prepare()
    return net


def held_out(key: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is held out."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1200, longest: int = 32_768) -> tuple[list[bytes], list[int], list[float]]:
    """Texts, labels and weights of at most ``per_class`` rows of each label outside the held-out fold.

    Rows are chosen by a hash of their id; of several texts of one id, the least is taken.
    The chosen ids are few by their bound, so they are broadcast and only their texts move.
    At most ``2 * per_class * longest`` bytes reach the driver; longer texts train nothing.
    """
    named = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    named = named.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    ids = []
    for v in sorted(counts):
        ids += [(r["doc_id"], v) for r in named.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    if not ids:
        return [], [], []
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType())])
    chosen = F.broadcast(spark.createDataFrame(ids, schema))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).where(F.octet_length("text") <= longest).join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    share = {v: counts[v] / max(1, sum(r["label"] == v for r in rows)) for v in counts}
    return [r["text"].encode() for r in rows], [r["label"] for r in rows], [share[r["label"]] for r in rows]


def scored(docs: DataFrame, net: ByteCnn, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each row; null and empty texts get the score of no bytes."""
    small_batches(docs)
    held = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from colsink.llm.shingles import blocks

        model = held.value
        for batch in batches:
            for at, data, offsets in blocks(batch.column(1), 2 << 20):
                score = model.score(data, np.diff(offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(score)), pa.array(score)], names=[key, "score"])

    return docs.select(key, docs[text].cast("string")).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")


def op10_byte_cnn(spark, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``, learned from ``labels`` outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(*labelled_sample(docs, read_table(spark, sf_dir, "labels")))
    out = scored(docs, net)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
