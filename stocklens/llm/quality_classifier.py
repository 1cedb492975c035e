"""Quality classifier: supervised subword embeddings.

Each word, each pair of neighbouring words and each run of three and of four characters of a text
is hashed to one of ``BUCKETS`` learned vectors; a document is the mean of its vectors, and a
softmax layer gives its classes.
Vectors and layer are learned together by stochastic gradient descent in numpy, document by document.

Fitting: at most ``SAMPLE`` labelled documents outside the held-out fold (the first by hash of
their key), whole texts, as counts by bucket of at most ``SAMPLE_BYTES`` together, in one task; that task
returns the model only. Labels without a document take no place in the sample, and a text that a key
repeats counts once. Scoring: every document.
The mean is linear, so a document's score needs one number for each bucket (the vector times the
layer), and the model that is sent to the executors has ``BUCKETS`` numbers, whatever the data.

Never used as input: labels, language, source, key. The key only decides the fold.

Defined results: a null or empty text has no vectors and gets the score of the layer's bias; rows
with a null key count as held out; repeated rows get equal scores; labels other than 0 and 1, or
without a document, are not used; without any usable label all scores are 0.5; an empty table
gives no rows; a very long text is hashed in one piece, in memory of some 50 bytes a character; other
columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table, text_column

BITS = 17
BUCKETS = 1 << BITS
SAMPLE = 3000
SAMPLE_BYTES = 1 << 28
DIM = 8
EPOCHS = 8
RATE = 2.0
THRESHOLD = 0.3
FOLDS = 5
#: Odd multipliers of the hashes, fixed values.
MIX = (2654435761, 2246822519, 3266489917, 668265263, 374761393)


def buckets_of(text: str) -> np.ndarray:
    """Bucket of each word, each pair of neighbouring words, and each three and four neighbouring
    characters of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    if not len(points):
        return np.empty(0, np.uint32)
    a, b, c, d, e = (np.uint32(m) for m in MIX)
    found = []
    if len(points) > 2:
        three = points[:-2] * a ^ points[1:-1] * b ^ points[2:] * c
        found.append(three * e)
        if len(points) > 3:
            found.append((three[:-1] ^ points[3:] * d) * e + np.uint32(1))
    # Words: sums of characters times powers of an odd number, brought to the word's own start.
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, blank, True].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    power = np.full(len(points), b, np.uint32)
    power[0] = 1
    power = np.multiply.accumulate(power, dtype=np.uint32)
    sums = np.r_[np.uint32(0), np.add.accumulate(points * a * power, dtype=np.uint32)]
    inverse = np.uint32(pow(int(b), -1, 1 << 32))
    back = np.full(len(points), inverse, np.uint32)
    back[0] = 1
    back = np.multiply.accumulate(back, dtype=np.uint32)
    words = (sums[ends] - sums[starts]) * back[starts]
    found.append(words * e + np.uint32(2))
    # A pair of words is hashed by difference: all words that repeat their neighbour are one pair.
    found.append((words[1:] - words[:-1]) * e + np.uint32(3))
    mixed = np.concatenate(found)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * d) >> np.uint32(32 - BITS)


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 0) -> tuple[np.ndarray, float]:
    """(a number for each bucket, bias) whose sum is the log odds of label 1.

    ``samples``: the document's different buckets, their shares of it, and the label."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    total, done = max(1, EPOCHS * len(samples)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            places, shares, label = samples[i]
            rate = np.float32(RATE * (1 - done / total))
            done += 1
            mean = shares @ vectors[places] if len(places) else np.zeros(DIM, np.float32)
            odds = np.exp((z := mean @ layer + bias) - z.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            if len(places):
                # Shares of a long text are small: scale by their length, as for one vector.
                vectors[places] -= (rate / np.float32(shares @ shares) * shares)[:, None] * back * np.float32(0.1)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def fold(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> tuple[np.ndarray, float]:
    texts = docs.select(F.col(key).alias("k"), text_column(docs, text).alias("t"))
    chosen = (
        labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("k").isNotNull() & (fold(F.col("k")) != 0))
        .distinct().join(texts.select("k"), "k", "left_semi")
        .orderBy(F.xxhash64("k"), "k", "y").limit(SAMPLE)
    )
    sample = texts.join(F.broadcast(chosen), "k").dropDuplicates(["k", "y", "t"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.unique(buckets_of(t), return_counts=True) for t in batch["t"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["k"].cast(pa.string()), batch["y"].cast(pa.int32()),
                    pa.array([b.astype("<i4").tobytes() for b, _ in rows], pa.binary()),
                    pa.array([n.astype("<i4").tobytes() for _, n in rows], pa.binary()),
                ],
                ["k", "y", "buckets", "counts"],
            )

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*batches, pd.DataFrame(columns=["k", "y", "buckets", "counts"])])
        rows = rows.sort_values(["k", "y", "buckets"], kind="stable")
        samples = []
        for y, b, n in zip(rows["y"], rows["buckets"], rows["counts"], strict=True):
            counts = np.frombuffer(n, "<i4").astype(np.float32)
            samples.append((np.frombuffer(b, "<i4"), counts / max(1, counts.sum()), int(y)))
        values, bias = train(samples)
        yield pd.DataFrame({"bias": [bias], "values": [values.tobytes()]})

    features = settle(sample.mapInArrow(counted, "k string, y int, buckets binary, counts binary"), "sample")
    # A key with many texts has as many rows: the bounds hold for what reaches the fitting task.
    place = [F.xxhash64("k"), "k", "y", "buckets", "counts"]
    first = features.withColumn("bytes", F.octet_length("buckets") + F.octet_length("counts")).orderBy(*place).limit(SAMPLE)
    so_far = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounded = first.withColumn("so_far", F.sum("bytes").over(so_far)).where(F.col("so_far") <= SAMPLE_BYTES).drop("bytes", "so_far")
    row = bounded.repartition(1).mapInPandas(fitted, "bias double, values binary").first()
    return np.frombuffer(row["values"], "<f4"), row["bias"]


def scores(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text") -> Column:
    """Probability of label 1 of each row's text."""
    values = docs.sparkSession.sparkContext.broadcast(model[0])  # BUCKETS numbers
    bias = model[1]

    @F.arrow_udf(T.DoubleType())
    def of(texts: pa.Array) -> pa.Array:
        table_ = values.value
        found = np.empty(len(texts))
        for i, t in enumerate(texts.to_pylist()):
            places = buckets_of(t)
            found[i] = bias + (float(table_[places].mean(dtype=np.float64)) if len(places) else 0.0)
        return pa.array(1 / (1 + np.exp(-np.clip(found, -500, 500))))

    return of(text_column(docs, text))


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = fit(docs, labels, key, text, label)
    found = docs.select(
        F.col(key).alias("doc_id"), (fold(F.col(key)) == 0).alias("held_out"), scores(docs, model, text).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
