"""Language-model scores by deleted interpolation of bigrams, words and a uniform share.

P(w | u) = a * c(u w) / c(u) + b * c(w) / N + c / (V + 1), where a, b and c depend on how often the
context u was seen (by powers of two). These weights are learned by expectation-maximisation on
held-out counts: each training token is taken out of the counts before it is predicted, so every
token serves as held out from all others. A context without any count keeps b and c.

Counts stay spread over the cluster, and texts are read and cut into tokens once. Each task takes its
rows in chunks as they come. A chunk is written as numbers of tokens, along with messages that ask
for the counts of its different words and bigrams; these travel as hashes, many to a message. The
tasks that add the counts up answer each chunk, and later passes read its numbers and answers.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soleprint.llm.tables import settled, shuffles_dropped

# Hashes have 56 bits; those of words, the end and the start of texts are odd, others even.
UNUSED, ODD = np.uint64(8), np.uint64(1)
END, START = np.uint64(0x220A957A6F1B5D), np.uint64(0xB21C651E98DF25)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(32))
# Contexts by the logarithm of their count; the first bucket is for contexts never seen.
BUCKETS = 32
# Steps of a factor of two in which ratios are told apart when the weights are learned.
STEPS, FINE = 160, 4


@dataclass(frozen=True)
class Shape:
    """``chunk_bytes`` of text make a chunk, hashes of n-grams are dealt to ``parts`` groups, one
    for each ``part_bytes`` of text if not given, and ``rounds`` of expectation-maximisation are
    made. Only ``rounds`` changes results."""

    chunk_bytes: int = 8 << 20
    part_bytes: int = 16 << 20
    parts: int | None = None
    rounds: int = 60


def pack(numbers: np.ndarray) -> bytes:
    """Numbers by their first, second and further bytes, compressed."""
    size = numbers.dtype.itemsize
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, size).T)
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Tokens:
    """The tokens of some texts: lower-case words, and an end after each text.

    ``kinds`` are the hashes of all different tokens and of the start of texts, ``word`` says which
    of them each token is, ``sizes`` how many tokens each text has. From these follow ``keys``, the
    hashes of all different tokens and bigrams, ``before`` and ``pair``, which of them precedes and
    ends at each token, ``text``, which text it belongs to, and ``order``, that of ascending keys.
    The last bit of a hash is 1 for words and 0 for bigrams, the others tell them apart.
    """

    def __init__(self, kinds: np.ndarray, word: np.ndarray, sizes: np.ndarray):
        self.kinds, self.word, self.sizes = kinds, word, sizes
        self.start = int(np.flatnonzero(kinds == START)[0])
        self.before = np.roll(word, 1)
        self.before[np.cumsum(sizes) - sizes] = self.start
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        pairs, pair = np.unique(self.before * len(kinds) + word, return_inverse=True)
        self.pair = pair + len(kinds)
        mixed = kinds[pairs // len(kinds)] * MIX[0] + kinds[pairs % len(kinds)]
        mixed = (mixed ^ mixed >> MIX[2]) * MIX[1]
        self.keys = np.append(kinds, ((mixed ^ mixed >> MIX[2]) >> UNUSED) & ~ODD)
        self.order = np.argsort(self.keys)


def cut(texts: list[bytes]) -> Tokens:
    """The tokens of ``texts``; frequent ones have small numbers, so that they pack well."""
    own = [t.lower().split() for t in texts]
    different = list(set().union(*own))
    place = dict(zip(different, range(len(different)), strict=True))
    hashes = [xxhash.xxh64_intdigest(w) for w in different]
    kinds = np.append(np.array(hashes, np.uint64) >> UNUSED | ODD, [END, START])
    sizes = np.fromiter(map(len, own), np.int64, len(own)) + 1
    word = np.full(int(sizes.sum()), len(different))
    inner = np.ones(len(word), bool)
    inner[np.cumsum(sizes) - 1] = False
    word[inner] = np.fromiter(
        map(place.__getitem__, chain.from_iterable(own)), np.int64, int(inner.sum()))
    frequent = np.argsort(-np.bincount(word, minlength=len(kinds)), kind="stable")
    number = np.empty(len(kinds), np.int64)
    number[frequent] = np.arange(len(kinds))
    return Tokens(kinds[frequent], number[word], sizes)


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """The rows in order, cut once ``limit`` bytes of text are reached; texts stay whole."""
    held, size = [], 0
    for batch in batches:
        first = 0
        for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
            size += n
            if size >= limit:
                held.append(batch.slice(first, i + 1 - first))
                yield pa.Table.from_batches(held)
                held, size, first = [], 0, i + 1
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held)


def _blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


ENCODED = ("chunk long, part long, keys binary, counts binary, rows binary, kinds binary, "
           "tokens binary")


def encode(rows: DataFrame, chunk_bytes: int, parts: int) -> DataFrame:
    """For each chunk a row without ``part``: ids and sizes of its texts, and its tokens; and a row
    for each part that any of its keys belong to, with these and their counts in training texts.

    Parts are ranges of keys, which are sent in ascending order as steps from one to the next. A
    chunk has at most as many messages as keys, however many parts there are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, table in enumerate(_chunks(batches, chunk_bytes)):
            tokens = cut(table.column("text").to_pylist())
            learned = np.asarray(table.column("learn").to_pylist(), bool)
            use = learned[tokens.text]
            counts = np.zeros(len(tokens.keys), np.int32)
            for own in (tokens.word[use], tokens.pair[use]):
                counts += np.bincount(own, minlength=len(counts)).astype(np.int32)
            counts[tokens.start] += int(learned.sum())
            keys, counts = tokens.keys[tokens.order], counts[tokens.order]
            part = ((keys >> np.uint64(24)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            own = table.drop_columns(["text"]).append_column("size", pa.array(tokens.sizes))
            none = [None] * len(spans)
            columns = [
                (pa.int64(), [task + number] * (1 + len(spans))),
                (pa.int64(), [None, *part[cuts[:-1]].tolist()]),
                (pa.binary(), [None, *(pack(np.diff(keys[a:b], prepend=np.uint64(0)))
                                       for a, b in spans)]),
                (pa.binary(), [None, *(pack(counts[a:b]) for a, b in spans)]),
                (pa.binary(), [_blob(own), *none]), (pa.binary(), [pack(tokens.kinds), *none]),
                (pa.binary(), [pack(tokens.word.astype(np.int32)), *none])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for kind, values in columns],
                ["chunk", "part", "keys", "counts", "rows", "kinds", "tokens"])

    return rows.mapInArrow(run, ENCODED)


def _answer(asked: DataFrame) -> DataFrame:
    """Each chunk's counts in the whole table, in the order in which they were asked for.

    ``tokens`` and ``kinds`` are the training tokens and different words of the part.
    """
    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in group["keys"]]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([unpack(c, np.int32) for c in group["counts"]])
        # As doubles, which hold whole numbers up to 2 ** 53.
        total = np.bincount(place, weights=counts, minlength=len(every)).astype(np.int64)
        words = total[(every & ODD == ODD) & (every != START)]
        ends = np.cumsum([0, *map(len, keys)])
        answers = [pack(total[place[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pd.DataFrame({
            "chunk": group["chunk"], "part": group["part"], "counts": answers,
            "tokens": [int(words.sum())] + [0] * (len(group) - 1),
            "kinds": [int((words > 0).sum())] + [0] * (len(group) - 1)})

    return asked.groupBy("part").applyInPandas(
        run, "chunk long, part long, counts binary, tokens long, kinds long")


class Counted:
    """A chunk's texts (``rows``, without the words) and tokens, with the tokens' counts in the
    whole table."""

    def __init__(self, chunk: pa.Table, answers: pa.Table):
        self.rows = pa.ipc.open_stream(chunk.column("rows")[0].as_py()).read_all()
        self.learn = np.asarray(self.rows.column("learn").to_pylist(), bool)
        tokens = Tokens(
            unpack(chunk.column("kinds")[0].as_py(), np.uint64),
            unpack(chunk.column("tokens")[0].as_py(), np.int32).astype(np.int64),
            self.rows.column("size").to_numpy())
        self.sizes, self.text = tokens.sizes, tokens.text
        counts = np.empty(len(tokens.keys), np.int64)
        counts[tokens.order] = np.concatenate(
            [unpack(c, np.int64) for c in answers.sort_by("part").column("counts").to_pylist()])
        self.word, self.pair, self.context = (
            counts[own] for own in (tokens.word, tokens.pair, tokens.before))


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1)


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0)


def _fine(ratio: np.ndarray) -> np.ndarray:
    """Ratios as steps of a quarter of a power of two; 0 for none."""
    step = np.rint(-FINE * np.log2(ratio, where=ratio > 0, out=np.zeros(len(ratio)))) + 1
    return np.where(ratio > 0, np.clip(step, 1, STEPS - 1), 0).astype(np.int64)


def _held_out(chunks: DataFrame, answers: DataFrame, total: int) -> np.ndarray:
    """How many training tokens have a context in each bucket, and each step of both ratios, with
    the token itself taken out of the counts: at most ``BUCKETS`` * ``STEPS`` ** 2 numbers."""
    def run(chunk: pa.Table, own: pa.Table) -> pa.Table:
        c = Counted(chunk, own)
        use = c.learn[c.text]
        context = c.context[use] - 1
        pair = _fine(_ratio(c.pair[use] - 1, context))
        word = _fine(_ratio(c.word[use] - 1, np.full(int(use.sum()), max(1, total - 1))))
        cells = (bucket_of(context) * STEPS + pair) * STEPS + word
        cell, n = np.unique(cells, return_counts=True)
        return pa.table({"cell": cell.astype(np.int64), "n": n.astype(np.int64)})

    rows = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        run, "cell long, n long")
    with shuffles_dropped(chunks.sparkSession):
        sums = rows.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(BUCKETS * STEPS * STEPS)
    table[sums["cell"].to_numpy(np.int64)] = sums["n"]
    return table.reshape(BUCKETS, STEPS, STEPS)


def learn_weights(table: np.ndarray, uniform: float, rounds: int) -> np.ndarray:
    """The three weights of each bucket of contexts, by expectation-maximisation.

    Buckets without held-out tokens get what is learned over all of them.
    """
    value = np.where(np.arange(STEPS) > 0, 2.0 ** (-(np.arange(STEPS) - 1) / FINE), 0)

    def fit(cells: np.ndarray) -> np.ndarray:
        at = np.nonzero(cells)
        n = cells[at]
        parts = np.stack([value[at[0]], value[at[1]], np.full(len(n), uniform)])
        weights = np.full(3, 1 / 3)
        for _ in range(rounds):
            mixed = weights[:, None] * parts
            weights = (mixed / mixed.sum(axis=0) * n).sum(axis=1) / n.sum()
        return np.maximum(weights, 1e-9) / np.maximum(weights, 1e-9).sum()

    overall = fit(table.sum(axis=0)) if table.any() else np.array([0.0, 0.5, 0.5])
    weights = np.array([fit(own) if own.any() else overall for own in table])
    weights[0] = [0, *(weights[0][1:] / weights[0][1:].sum())]
    return weights


def score_texts(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
    shape: Shape = Shape(),
) -> DataFrame:
    """``doc_id``, ``learned``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of each row; the model learns from rows where ``learn`` is true.

    ``base_score`` adds up log10((c + 1) / (N + V + 1)) over the tokens, with c the token's count
    and N and V all and different tokens of the training rows; ``score`` adds up the model's log10
    probabilities; ``n_known`` tokens have c > 0. A null text counts as an empty one, which is just
    its end. A null in ``learn`` is false. Ids may be of any type that Arrow carries, null included.
    Repeated rows count and are scored one by one; without training rows all tokens are equally
    improbable. An empty table gives none. A very long text stays whole and ends its chunk, so its
    tokens must fit into one task. Words are told apart by 55 bits of hash, and
    so are bigrams, apart from words.
    """
    identity = F.col(f"`{doc_id}`").alias("doc_id")
    rows = docs.select(
        identity, F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"))
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    parts = shape.parts or max(1, -(-size // shape.part_bytes))
    encoded = settled(encode(rows, shape.chunk_bytes, parts), "chunks")
    chunks = encoded.where("part IS NULL").select("chunk", "rows", "kinds", "tokens")
    asked = encoded.where("part IS NOT NULL").select("chunk", "part", "keys", "counts")
    answers = settled(_answer(asked), "counts")
    total, kinds = (n or 0 for n in answers.agg(F.sum("tokens"), F.sum("kinds")).first())
    answers = answers.select("chunk", "part", "counts")
    uniform = 1 / (kinds + 1)
    weights = learn_weights(_held_out(chunks, answers, total), uniform, shape.rounds)

    def run(chunk: pa.Table, own: pa.Table) -> pa.Table:
        c = Counted(chunk, own)
        mix = weights[bucket_of(c.context)]
        model = (mix[:, 0] * _ratio(c.pair, c.context) + mix[:, 1] * c.word / max(1, total)
                 + mix[:, 2] * uniform)
        base = np.log10(c.word + 1.0) - np.log10(total + kinds + 1.0)
        def per_text(x):
            return np.bincount(c.text, weights=x, minlength=len(c.learn))
        return pa.table([
            c.rows.column("doc_id"), pa.array(c.learn), pa.array(c.sizes),
            pa.array(per_text(c.word > 0).astype(np.int64)),
            pa.array(np.full(len(c.learn), total, np.int64)), pa.array(per_text(base)),
            pa.array(per_text(np.log10(model)))], names=schema.names)

    schema = T.StructType([docs.select(identity).schema[0], *(
        T.StructField(name, kind) for name, kind in (
            ("learned", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()),
            ("train_tokens", T.LongType()), ("base_score", T.DoubleType()),
            ("score", T.DoubleType())))])
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
