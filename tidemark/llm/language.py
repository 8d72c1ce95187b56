"""Language identification by a small convolutional network over bytes.

A text is cut into windows of `WINDOW` bytes.  Filters of several widths slide over the
embedded bytes of a window; the largest response of each filter goes through a softmax
layer.  A text's probabilities are those of its windows, weighted by their bytes, and
all windows of the text count.

The response of a filter is a sum over its places of (embedding x filter), so for use
those products are laid out as tables, indexed by single bytes and by pairs of
neighbours.  Many windows run through numpy at once, place by place, which keeps the
working set in the processor's cache.

The network is trained in numpy on the driver, on windows of a bounded sample: about
`PER_LABEL` documents of each language, `WINDOWS_PER_TEXT` windows of each, and at most
`MOST_SAMPLED` windows, shared out so that each language has one at least.

Defined results: `und`, score 0, for a null text and one without a letter.  With nothing
to learn from, every text is `und`.  Ties go to the first language by code point.
Repeated rows are predicted alike; rows without a language teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
PER_LABEL, MOST_SAMPLED, WINDOWS_PER_TEXT = 768, 16_384, 2
EPOCHS, BATCH, RATE = 8, 64, 0.01
CLASSES = 64
UNKNOWN = "und"


def byte_classes() -> np.ndarray:
    """64 classes: 0 blank, letters without case, digits, others, and parts of UTF-8."""
    of = np.full(256, 28)
    of[[0x20, *range(9, 14)]] = 0
    for i in range(26):
        of[ord("a") + i] = of[ord("A") + i] = 1 + i
    of[ord("0") : ord("9") + 1] = 27
    of[0x80:0xC0] = 32 + np.arange(64) % 32  # upper and lower case of Latin letters share one
    of[0xC0:0xC4], of[0xC4:0xE0], of[0xE0:] = 29, 30, 31
    return of.astype(np.uint8)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (CLASSES, EMBEDDING)
    filters: list[np.ndarray]  # for each width: (width, EMBEDDING, FILTERS)
    dense: np.ndarray  # (len(WIDTHS) * FILTERS, languages)
    bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """For each width: the response to a byte at each place, (width, CLASSES, FILTERS)."""
        return [np.einsum("ce,wef->wcf", self.embedding, f).astype(np.float32) for f in self.filters]

    def pooled(self, x: np.ndarray, where: bool = False):
        """Largest responses of windows `x` (window, byte); with their places if `where`."""
        across = np.ascontiguousarray(x.T)
        pairs = across[:-1].astype(np.intp) * CLASSES + across[1:]
        best, places = [], []
        for table in self.tables():
            width = len(table)
            chunks = [(table[i][:, None] + table[i + 1][None]).reshape(-1, FILTERS) for i in range(0, width - 1, 2)]
            top = np.full((x.shape[0], FILTERS), -np.inf, np.float32)
            place = np.zeros(top.shape, np.int64)
            for p in range(x.shape[1] - width + 1):
                value = chunks[0].take(pairs[p], axis=0)
                for k in range(1, len(chunks)):
                    value += chunks[k].take(pairs[p + 2 * k], axis=0)
                if width % 2:
                    value += table[-1].take(across[p + width - 1], axis=0)
                if where:
                    place[value > top] = p
                np.maximum(top, value, out=top)
            best.append(top)
            places.append(place)
        pooled = np.hstack(best)
        return (pooled, places) if where else pooled

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.dense + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 0) -> Network:
    """Adam on the cross entropy of windows `x` (bytes' classes) with languages `y`."""
    rng = np.random.default_rng(seed)
    net = Network(
        languages,
        rng.normal(0, 0.5, (CLASSES, EMBEDDING)),
        [rng.normal(0, 0.3, (w, EMBEDDING, FILTERS)) for w in WIDTHS],
        rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages))),
        np.zeros(len(languages)),
    )
    weights = [net.embedding, *net.filters, net.dense, net.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            pooled, places = net.pooled(x[rows], where=True)
            error = net.probabilities(pooled)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            active = np.maximum(pooled, 0)
            back = (error @ net.dense.T) * (pooled > 0)
            d_embedding, d_filters = np.zeros_like(net.embedding), []
            for i, (w, f) in enumerate(zip(WIDTHS, net.filters, strict=True)):
                mine, d = back[:, i * FILTERS : (i + 1) * FILTERS], np.zeros_like(f)
                for k in range(w):  # only the place of the maximum learns
                    seen = x[rows[:, None], places[i] + k]
                    table = np.zeros((CLASSES, FILTERS))
                    np.add.at(table, (seen, np.arange(FILTERS)[None]), mine)
                    d[k] = net.embedding.T @ table
                    d_embedding += table @ f[k].T
                d_filters.append(d)
            step += 1
            for j, g in enumerate([d_embedding, *d_filters, active.T @ error, error.sum(axis=0)]):
                first[j] += 0.1 * (g - first[j])
                second[j] += 0.001 * (g * g - second[j])
                size = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[j] -= size * first[j] / (np.sqrt(second[j]) + 1e-8)
    return net


def _windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts (window, byte), the row of each, and its bytes."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = byte_classes()[np.frombuffer(buffer, np.uint8)] if buffer else np.zeros(0, np.uint8)
    count = -(-np.diff(offsets) // WINDOW)
    row = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][row] + nth * WINDOW
    size = np.minimum(offsets[1:][row] - start, WINDOW)
    data = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    x = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[start]
    short = np.flatnonzero(size < WINDOW)
    x[short] *= np.arange(WINDOW)[None] < size[short][:, None]
    return x, row, size


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows to learn from: (lang, place, classes), spread over each text."""
    for batch in batches:
        for part in slices(batch):
            x, row, size = _windows(part.column("text"))
            first = np.searchsorted(row, np.arange(part.num_rows))
            count = np.bincount(row, minlength=part.num_rows)
            for nth in range(WINDOWS_PER_TEXT):
                has = np.flatnonzero(count > nth)
                at = first[has] + nth * count[has] // WINDOWS_PER_TEXT
                yield pa.record_batch(
                    {
                        "lang": part.column("lang").take(pa.array(has)),
                        "place": part.column("place").take(pa.array(has)),
                        "classes": pa.array([x[i].tobytes() for i in at], pa.binary()),
                    }
                )


def learn(docs: DataFrame, learns: Column) -> Network:
    """A network from text and lang of the rows for which `learns` holds."""
    spark = docs.sparkSession
    known = docs.filter(learns & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # By the text as well, since many rows may share an id.
    known = known.select("text", "lang", F.xxhash64("doc_id", "text").alias("place"))
    counts = known.groupBy("lang").count().limit(MOST_SAMPLED + 1).collect()
    if len(counts) > MOST_SAMPLED:
        raise ValueError(f"more than {MOST_SAMPLED} languages to learn")
    # Of each language the texts whose places lie in the lowest share of all places.  The
    # shares are a row per language, so no text is shuffled to learn whether it is taken.
    shares = [(r["lang"], min(1.0, PER_LABEL / r["count"])) for r in counts]
    shares = spark.createDataFrame(shares, "lang string, share double")
    spot = F.pmod("place", F.lit(1 << 30)) / F.lit(1 << 30)
    few = known.join(F.broadcast(shares), "lang").filter(spot < F.col("share"))
    windows = few.select("text", "lang", "place").mapInArrow(_sample, "lang string, place long, classes binary")
    # About PER_LABEL texts of a language are left here; each language keeps its own number.
    each = max(MOST_SAMPLED // max(len(counts), 1), 1)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "classes"))
    windows = windows.withColumn("nth", first).filter(F.col("nth") <= each).drop("nth")
    # A bounded number of rows to the driver.
    rows = windows.orderBy("place", "lang", "classes").collect()
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return Network([], np.zeros((0, 0)), [], np.zeros((0, 0)), np.zeros(0))
    x = np.stack([np.frombuffer(r["classes"], np.uint8) for r in rows])
    return train(x, np.array([languages.index(r["lang"]) for r in rows]), languages)


def _apply(net: Network):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x, row, size = _windows(part.column("text"))
                total = np.zeros((part.num_rows, len(net.languages)))
                for at in range(0, len(row), 4096):
                    p = net.probabilities(net.pooled(x[at : at + 4096]))
                    np.add.at(total, row[at : at + 4096], p * size[at : at + 4096, None])
                weight = np.bincount(row, size, part.num_rows)
                total /= np.maximum(weight, 1)[:, None]
                best = total.argmax(axis=1)
                score = total[np.arange(len(total)), best]
                names = [net.languages[b] if w else UNKNOWN for b, w in zip(best, weight, strict=True)]
                known = [f for f in part.schema.names if f not in ("text",)]
                yield pa.record_batch(
                    [part.column(f) for f in known] + [pa.array(names), pa.array(np.clip(score, 0, 1))],
                    names=[*known, "lang_pred", "score"],
                )

    return predict


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of `docs` (doc_id, text)."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not net.languages:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    given = docs.select("doc_id", "text", lettered.alias("lettered"))
    out = given.mapInArrow(
        _apply(net), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lettered boolean, lang_pred string, score double"
    )
    return out.select(
        "doc_id",
        F.when(F.col("lettered"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"),
    )
