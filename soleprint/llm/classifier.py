"""Text classifier with supervised subword embeddings.

Words and their character n-grams are hashed into a table of vectors, and so is the pair of a word
with itself, under one name for all words. A document is the average of all these vectors, and a softmax layer on it gives the label. Vectors and
layer are learned together by stochastic gradient descent in numpy, on a bounded sample of labelled
rows; everything else runs over all rows.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soleprint.llm.encode import slices

BUCKET_BITS = 16
NGRAMS = (3, 4)
# The feature of each word that repeats the one before it.
AGAIN = zlib.crc32(b"word word") >> (32 - BUCKET_BITS)
# Odd multipliers that spread n-grams of bytes over 64 bits.
STEP, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Training:
    """``sample`` bounds the labelled rows that are learned from: those with the smallest hashes of
    their ids. ``dims`` is the length of a vector, ``rate`` falls to nothing over the epochs."""

    sample: int = 4000
    dims: int = 8
    epochs: int = 6
    rate: float = 0.5
    seed: int = 11


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For a list of different words: positions in the list, and a bucket of each feature."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(b"".join([b"<" + w + b">" for w in words]), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(data))
    owners = [np.arange(len(words))]
    whole = np.array([zlib.crc32(w) for w in words], np.uint64) + np.uint64(1 << 33)
    buckets = [whole * SPREAD >> np.uint64(64 - BUCKET_BITS)]
    for n in NGRAMS:
        value = np.full(len(data) - n + 1 if len(data) >= n else 0, np.uint64(n))
        for k in range(n):
            value = value * STEP + data[k:k + len(value)]
        inside = at[:len(value)] + n <= end[:len(value)]
        owners.append(owner[:len(value)][inside])
        value = value[inside]
        buckets.append((value ^ value >> np.uint64(29)) * SPREAD >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


def text_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text in ascending order, and the share of its features in each."""
    own = text.split()
    counts = Counter(own)
    owners, buckets = word_features(list(counts))
    weights = np.array(list(counts.values()), float)[owners]
    sums = np.bincount(buckets, weights=weights, minlength=1 << BUCKET_BITS).astype(float)
    sums[AGAIN] += sum(map(eq, own, own[1:]))
    used = np.flatnonzero(sums)
    return used, sums[used] / max(1.0, sums.sum())


@dataclass(frozen=True)
class Model:
    """What scoring needs of vectors and layer: their product for each bucket, and the bias.

    The average of vectors times the layer is the average of the products.
    """

    values: np.ndarray
    bias: float


def fit(rows: Iterator[tuple[np.ndarray, np.ndarray, int]], options: Training) -> Model:
    """Train on (buckets, shares, label); without rows of both labels, every score is the share of
    label 1, or 0.5 without rows."""
    rows = list(rows)
    labels = np.array([label for _, _, label in rows])
    if len(set(labels)) < 2:
        share = labels.mean() if len(labels) else 0.5
        odds = np.clip(share, 1e-3, 1 - 1e-3)
        return Model(np.zeros(1 << BUCKET_BITS), float(np.log(odds / (1 - odds))))
    rng = np.random.default_rng(options.seed)
    vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, options.dims)) / options.dims
    layer, bias = np.zeros((options.dims, 2)), np.zeros(2)
    steps, done = options.epochs * len(rows), 0
    for _ in range(options.epochs):
        for i in rng.permutation(len(rows)):
            used, share, label = rows[i]
            rate = options.rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[used]
            logits = hidden @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= rate * error
            # Shares of one text sum to 1 over many buckets; without this they would hardly move.
            vectors[used] -= rate * np.outer(share * len(used) ** 0.5, back)
    direction = layer[:, 1] - layer[:, 0]
    return Model(vectors @ direction, float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, options: Training = Training()) -> Model:
    """A model from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``label`` 0 or 1).

    Rows without id, text or label, and ids with both labels, are not learned from. Features are
    made where the texts are; one task gets those of the sample, at most one entry per bucket and
    text.
    """
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where(
        "doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    chosen = known.select("doc_id", "label", F.xxhash64("doc_id").alias("place")).orderBy(
        "place", "doc_id").limit(options.sample)
    texts = docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("text")).where(
        "text IS NOT NULL")
    # One row of each id, that with the smallest hash: the sample's bound holds for rows.
    sample = texts.join(chosen, "doc_id").groupBy("place", "doc_id", "label").agg(
        F.min(F.struct(F.xxhash64("text"), F.col("text")))["text"].alias("text")).drop("doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [text_features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("label"),
                 pa.array([used.astype(np.int32).tobytes() for used, _ in made]),
                 pa.array([share.astype(np.float32).tobytes() for _, share in made])],
                ["place", "label", "used", "share"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for place, label, used, share in zip(
                    *(batch.column(c).to_pylist() for c in ("place", "label", "used", "share")),
                    strict=True):
                rows.append((place, label, used, share))
        rows.sort()
        model = fit(((np.frombuffer(used, np.int32), np.frombuffer(share, np.float32), label)
                     for _, label, used, share in rows), options)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.values.tobytes()]), pa.array([model.bias])], ["values", "bias"])

    made = sample.mapInArrow(features, "place long, label int, used binary, share binary")
    row = made.repartition(1).mapInArrow(learn, "values binary, bias double").collect()
    if not row:
        return fit(iter(()), options)
    return Model(np.frombuffer(row[0]["values"]), row[0]["bias"])


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    """The probability of label 1 of each text."""
    own = [t.split() for t in texts]
    words = list(set().union(*own))
    owners, buckets = word_features(words)
    value = np.bincount(owners, weights=model.values[buckets], minlength=len(words))
    count = np.bincount(owners, minlength=len(words))
    place = dict(zip(words, range(len(words)), strict=True)).__getitem__
    logits = np.full(len(texts), model.bias)
    for i, one in enumerate(own):
        if one:
            at = np.fromiter(map(place, one), np.int64, len(one))
            again = np.count_nonzero(at[1:] == at[:-1])
            logits[i] += (value[at].sum() + again * model.values[AGAIN]) / (count[at].sum() + again)
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of each row.

    A null text counts as an empty one; texts without words get the score of the bias. Repeated
    rows are scored alike and all stay; very long texts are read whole; an empty table gives none.
    """
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
                       .alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_texts(part, model) for part in slices(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate([*scores, np.zeros(0)]))],
                ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def fold(doc_id: Column, folds: int) -> Column:
    """The CRC-32 of an id as text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
