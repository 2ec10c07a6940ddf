"""Benchmark decontamination by latent semantic retrieval.

Benchmark passages become TF-IDF vectors, with passage frequencies from the whole corpus. Groups of
them get latent spaces, spanned by their leading right singular vectors, by a randomised SVD whose
passes over the passages run on Spark. A group has no more passages than its space dimensions, so
that no passage is shortened in it, however large the benchmark. Windows of every document are folded into it, and a high cosine makes a
candidate. A candidate counts if the longest common subsequence of its words and the passage's is
long enough, or somewhat shorter but with the passage's answer in it.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from soleprint.llm.encode import slices
from soleprint.llm.tables import saved, union

BUCKETS = 1 << 17
# Words folded into the latent space at a time; a multiple of all steps between windows.
WORDS_AT_ONCE = 16_000
# Bytes of text handled at a time.
SLICE = 500_000
# Words whose buckets a Python worker remembers, besides those of the slice at hand.
REMEMBERED = 50_000
# Passages of about the same length that share a bound.
BOUNDED = 8
# Bytes that are no part of a word when they stand at its ends.
MARKS = b".,;:!?\"'()[]{}<>|*#%&$-_"


@dataclass(frozen=True)
class Search:
    """``windows`` are lengths in words; a passage of n words is searched in the first window with
    room for n and a third more, at steps of a quarter. Longer items are cut into equal parts
    of at most three quarters of the longest window, each of them a passage. ``dims`` is the highest rank of a latent space and the
    number of passages that share one. ``cosine`` makes a candidate: it is the product of window
    and passage over the square of the passage's length, or over the product of both lengths if the
    window's is smaller. So a copy reaches 1 whatever words stand around it. Of a candidate, ``lcs`` is the share of the item, over all its parts, that suffices alone,
    ``lcs_answer`` the one that does if ``answer`` of the answer's words are there as well, where
    the item would be around a part of which ``lcs_answer`` was found. ``block`` is the number of
    passages looked for in one pass over the documents: it bounds what is sent to the tasks.
    """

    windows: tuple[int, ...] = (20, 40, 80, 160)
    dims: int = 256
    cosine: float = 0.4
    lcs: float = 0.8
    lcs_answer: float = 0.5
    answer: float = 0.8
    block: int = 2000


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case without marks at their ends; words of marks only are left out."""
    return [w for w in (w.strip(MARKS) for w in text.lower().split()) if w]


def bucket(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


class Places(dict):
    """Buckets of words in lower case, -1 without more than marks; each word is looked at once."""

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(MARKS)
        self[word] = at = bucket(plain) if plain else -1
        return at


# Of the words that this Python worker has met.
PLACES = Places()


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, as of ``words_of``, by their buckets; and where each text begins and
    the last one ends."""
    own = [t.lower().split() for t in texts]
    if len(PLACES) > REMEMBERED:
        PLACES.clear()
    at = np.fromiter(map(PLACES.__getitem__, chain.from_iterable(own)), np.int64,
                     sum(map(len, own)))
    real = np.concatenate(([0], np.cumsum(at >= 0)))
    return at[at >= 0], real[np.cumsum([0, *map(len, own)])]


def passage_frequencies(docs: DataFrame, length: int = 80) -> tuple[np.ndarray, int]:
    """Of all passages of ``length`` words, how many hold each bucket, and how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in slices(batch.column("text").to_pylist(), SLICE):
                at, ends = _numbered(part)
                sizes = np.diff(ends)
                parts = -(-sizes // length)
                first = np.repeat(np.cumsum(parts) - parts, sizes)
                inside = np.arange(len(at)) - np.repeat(ends[:-1], sizes)
                pairs = np.sort((first + inside // length) * BUCKETS + at)
                pairs = pairs[np.diff(pairs, prepend=-1) > 0]
                found += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
                total += int(parts.sum())
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used, -1]), pa.array([*found[used], total])], ["bucket", "n"])

    rows = docs.select(F.col("text")).mapInArrow(run, "bucket long, n long")
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS + 1
    counts = np.zeros(BUCKETS, np.int64)
    real = sums["bucket"] >= 0
    counts[sums["bucket"][real]] = sums["n"][real]
    return counts, int(sums["n"][~real].sum())


def cut_passages(words: list[bytes], search: Search) -> list[list[bytes]]:
    parts = max(1, -(-len(words) // (search.windows[-1] * 3 // 4)))
    ends = [len(words) * i // parts for i in range(parts + 1)]
    return [words[a:b] for a, b in pairwise(ends)]


@dataclass(frozen=True)
class Passage:
    """A part of an item, the words of the item's answer, how many words of the item come before
    the part, all words of the item, and the item's number in its block."""

    item: object
    words: list[bytes]
    answer: list[bytes]
    before: int
    whole: list[bytes]
    number: int


def passages_of(items: list[tuple[object, bytes]], search: Search) -> list[Passage]:
    made = []
    for number, (item, text) in enumerate(items):
        words, answer, before = words_of(text), answer_of(text), 0
        for part in cut_passages(words, search) if words else []:
            made.append(Passage(item, part, answer, before, words, number))
            before += len(part)
    return made


def weigh(words: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = np.unique([bucket(w) for w in words], return_counts=True)
    weights = counts * idf[at]
    return at, weights / max(1e-9, np.linalg.norm(weights))


@dataclass(frozen=True)
class Space:
    """The latent space: a row for each bucket of the benchmark, the leading right singular vectors
    of its TF-IDF matrix. All other buckets would have rows of zeros."""

    buckets: np.ndarray
    rows: np.ndarray

    def fold(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A vector of the space from buckets and their weights."""
        place = np.minimum(np.searchsorted(self.buckets, at), len(self.buckets) - 1)
        known = self.buckets[place] == at
        return weights[known] @ self.rows[place[known]]


def latent_space(passages: DataFrame, idf: np.ndarray, search: Search) -> Space:
    """The space of ``passages``, by randomised subspace iteration.

    Each pass multiplies the matrix, spread over Spark's tasks, with a thin one and the transposed
    matrix with the result; sums come back per bucket, of which there are at most ``BUCKETS``.
    """
    def parts(batch: pa.RecordBatch) -> list[list[bytes]]:
        return [part for text in batch.column("text").to_pylist()
                for part in cut_passages(words_of(text), search) if part]

    def found(batches):
        for batch in batches:
            own = {bucket(w) for part in parts(batch) for w in part}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(own), pa.int64())], ["bucket"])

    def times(batches, thin: Space):
        for batch in batches:
            sums: dict[int, np.ndarray] = {}
            for part in parts(batch):
                at, weights = weigh(part, idf)
                low = thin.fold(at, weights)
                for b, w in zip(at.tolist(), weights.tolist(), strict=True):
                    sums[b] = sums.get(b, 0) + w * low
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()],
                                                            pa.binary())], ["bucket", "row"])

    def add(group):
        found, place = np.unique(group.column("bucket").to_numpy(), return_inverse=True)
        total = np.zeros((len(found), width))
        for i, row in zip(place.tolist(), group.column("row").to_pylist(), strict=True):
            total[i] += np.frombuffer(row)
        return pa.table({"bucket": pa.array(found, pa.int64()),
                         "row": pa.array([v.tobytes() for v in total], pa.binary())})

    def applied(thin: Space) -> np.ndarray:
        rows = passages.mapInArrow(partial(times, thin=thin), "bucket long, row binary")
        sums = rows.groupBy(F.col("bucket") % 32).applyInArrow(add, "bucket long, row binary").collect()
        return np.array([np.frombuffer(r["row"]) for r in sorted(sums)])

    used = np.array(sorted(r["bucket"] for r in passages.mapInArrow(
        found, "bucket long").distinct().collect()), np.int64)
    if not len(used):
        return Space(np.zeros(1, np.int64) - 1, np.zeros((1, 1), np.float32))
    width = min(search.dims + 8, len(used))
    thin = Space(used, np.random.default_rng(7).standard_normal((len(used), width)))
    for _ in range(2):
        thin = Space(used, np.linalg.qr(applied(thin))[0])
    values, vectors = np.linalg.eigh(thin.rows.T @ applied(thin))
    kept = np.argsort(-values)[:search.dims]
    kept = kept[values[kept] > 1e-9 * values.max()]
    return Space(used, (thin.rows @ vectors[:, kept]).astype(np.float32))


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for word in b:
        match = row & places.get(word, 0)
        row = (row + match | row - match) & full
    return len(a) - row.bit_count()


def answer_of(text: bytes) -> list[bytes]:
    """The words behind the last question mark, or else of the last sentence with a word."""
    if b"?" in text and (after := words_of(text.rpartition(b"?")[2])):
        return after
    for sentence in reversed(text.replace(b"\n", b". ").split(b". ")):
        if own := words_of(sentence):
            return own
    return []


class Index:
    """Passages and their space, ready to be looked up in texts."""

    def __init__(self, passages: list[Passage], idf, space: Space, search: Search):
        self.search, self.passages = search, passages
        # All tables have a last entry of nothing, which is that of places without a word.
        self.idf = np.append(idf, 0).astype(np.float32)
        vectors, self.sparse = [], []
        for passage in passages:
            at, weights = weigh(passage.words, idf)
            self.sparse.append((at, weights))
            vectors.append(space.fold(at, weights))
        norms = np.array([np.linalg.norm(idf[at] * np.bincount(
            np.searchsorted(at, [bucket(w) for w in p.words]), minlength=len(at)))
            for p, (at, _) in zip(passages, self.sparse, strict=True)])
        self.norms = norms
        self.place = np.zeros(BUCKETS + 1, np.int32)
        self.place[space.buckets] = np.arange(1, len(space.buckets) + 1)
        weighed = space.rows * self.idf[space.buckets, None]
        self.space = np.vstack([np.zeros((1, space.rows.shape[1]), np.float32), weighed])
        sizes = np.array([len(p.words) for p in passages])
        self.groups = []
        before = 0
        for length in search.windows:
            own = np.flatnonzero((sizes > before) & (sizes <= length * 3 // 4))
            own = own[np.argsort(norms[own], kind="stable")]
            before = length * 3 // 4
            if len(own):
                few = np.array_split(own, -(-len(own) // BOUNDED))
                # What one word can add to the product with any passage of the few.
                most = np.zeros((len(self.space), len(few)), np.float32)
                for k, some in enumerate(few):
                    for at, weights in (self.sparse[i] for i in some):
                        place = self.place[at]
                        most[place, k] = np.maximum(most[place, k], weights * idf[at])
                most[0] = 0
                self.groups.append((length, own, np.array([vectors[i] for i in own], np.float32),
                                    norms[own].astype(np.float32), most,
                                    norms[[some[0] for some in few]].astype(np.float32)))

    def candidates(self, at: np.ndarray,
                   ends: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """Passage, text, first word in it, window length and cosine of each window that comes near
        a passage. ``ends`` is where each text begins and the last one ends.

        Windows begin at every quarter of their length, so sums over short steps give all of them.
        Each text is filled up to a whole number of quarters of the longest window, and windows end
        with their text, so that no other text has a part in them.
        No window is left out too early: a product is at most the sum of what each word can add to
        that with any of a few passages, and a window at least as long as if no word came twice.
        Those that may come near any of them are folded, and measured exactly by their counted words.
        """
        lengths = [length for length, *_ in self.groups]
        step, most = min(lengths, default=4) // 4, max(lengths, default=4)
        least = self.search.cosine
        sizes = np.diff(ends)
        padded = -(-sizes // (most // 4)) * (most // 4)
        begins = np.concatenate(([0], np.cumsum(padded)))
        filled = np.full(begins[-1], -1)
        filled[np.arange(len(at)) + np.repeat(begins[:-1] - ends[:-1], sizes)] = at
        owners = np.repeat(np.arange(len(sizes)), padded // step)
        for base in range(0, len(filled), WORDS_AT_ONCE):
            own = filled[base:base + WORDS_AT_ONCE + most]
            owner = owners[base // step:base // step + len(own) // step]
            rest = -len(own) % most + most
            own = np.concatenate((own, np.full(rest, -1)))
            owner = np.concatenate((owner, np.full(rest // step, -1)))
            square = self.idf[own] ** 2
            place = self.place[own]
            chosen = []
            needed = np.zeros(len(own) // step, bool)
            for length, _, _, _, adds, lows in self.groups:
                whose = owner[::length // 4 // step]
                same = [whose[i:len(whose) - 3 + i] == whose[:-3] for i in range(4)]
                total, bound = (
                    sum(x[i:len(x) - 3 + i] * same[i][:, None] for i in range(4)) for x in (
                        y.reshape(-1, length // 4, y.shape[1]).sum(axis=1)
                        for y in (square[:, None], adds[place])))
                small = np.minimum(lows, np.sqrt(total))
                total = total[:, 0]
                starts = np.arange(len(total)) * (length // 4)
                near = np.flatnonzero((bound >= 0.999 * least * small).any(axis=1) & (total > 0)
                                      & (starts < WORDS_AT_ONCE))
                chosen.append((near, total[near], [x[near, None] for x in same]))
                for i in range(0, length // step):
                    needed[near * (length // 4 // step) + i] = True
            if not needed.any():
                continue
            places = place.reshape(-1, step)[needed]
            rows = np.zeros((len(needed), self.space.shape[1]), np.float32)
            folded = np.zeros((len(places), self.space.shape[1]), np.float32)
            for column in places.T:
                known = np.flatnonzero(column)
                folded[known] += self.space[column[known]]
            rows[needed] = folded
            for (length, passages, vectors, norms, *_), (near, total, same) in zip(
                    self.groups, chosen, strict=True):
                if not len(near):
                    continue
                many = length // 4 // step
                quarters = rows.reshape(-1, many, rows.shape[1]).sum(axis=1)
                products = sum(quarters[near + i] * same[i] for i in range(4)) @ vectors.T
                enough = products >= (least * 0.999) * np.minimum(
                    norms, np.sqrt(total)[:, None])
                for i in np.flatnonzero(enough.any(axis=1)):
                    k = int(owner[near[i] * many])
                    start = base + int(near[i]) * (length // 4) - int(begins[k])
                    window = Window(at[ends[k] + start:min(ends[k] + start + length, ends[k + 1])],
                                    self.idf)
                    for j in passages[enough[i]]:
                        product = window.product(*self.sparse[j])
                        if product >= least * min(self.norms[j], window.norm):
                            yield int(j), k, start, length, product / window.norm


class Window:
    """The counted and weighed words of a window."""

    def __init__(self, at: np.ndarray, idf: np.ndarray):
        self.buckets, counts = np.unique(at, return_counts=True)
        self.weights = counts * idf[self.buckets].astype(np.float64)
        self.norm = max(1e-9, float(np.linalg.norm(self.weights)))

    def product(self, at: np.ndarray, weights: np.ndarray) -> float:
        """With a vector of these sorted buckets and weights."""
        place = np.minimum(np.searchsorted(self.buckets, at), len(self.buckets) - 1)
        return float(np.where(self.buckets[place] == at, self.weights[place], 0) @ weights)


def matches(indexes: list[Index], texts: list[bytes], at: np.ndarray, ends: np.ndarray,
            search: Search) -> list[dict]:
    """For each text and item found in it: the share of the item's words that its parts, or
    the whole around one of them, have in order, the cosine of the best part's window, and whether the answer is there.
    """
    near: list[dict[tuple, dict[int, tuple[int, float]]]] = [{} for _ in texts]
    answered, whole, lengths = set(), {}, {}
    words = lru_cache(maxsize=4)(lambda k: words_of(texts[k]))
    for index in indexes:
        for i, k, start, length, cosine in index.candidates(at, ends):
            own = index.passages[i]
            a, b = start - length // 4, start + length + length // 4
            common = common_subsequence(own.words, words(k)[max(0, a):b])
            item = (own.item, own.number)
            best = near[k].setdefault(item, {})
            best[own.before] = max(best.get(own.before, (0, 0.0)), (common, cosine))
            if common < search.lcs_answer * len(own.words):
                continue
            total = len(own.whole)
            text = words(k)[max(0, a - own.before):b + total - own.before - len(own.words)]
            if total > len(own.words):
                whole[k, item] = max(whole.get((k, item), 0), common_subsequence(own.whole, text))
            if own.answer and (k, item) not in answered and (
                    common_subsequence(own.answer, text) >= search.answer * len(own.answer)):
                answered.add((k, item))
            lengths[item] = total
    found: list[dict[object, tuple[float, float, bool]]] = [{} for _ in texts]
    for k, items in enumerate(near):
        for item, parts in items.items():
            if item not in lengths:  # no part with the smaller share, so none over all parts
                continue
            common = max(sum(c for c, _ in parts.values()), whole.get((k, item), 0))
            share = common / lengths[item]
            there = (k, item) in answered
            if share >= search.lcs or there and share >= search.lcs_answer:
                best = (share, max(parts.values())[1], there)
                found[k][item[0]] = max(found[k].get(item[0], best), best)
    return found


def _blocks(rows: DataFrame, size: int) -> Iterator[list[tuple[object, bytes]]]:
    block = []
    for row in rows.toLocalIterator():
        block.append((row["item_id"], bytes(row["text"])))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """``doc_id``, ``mark``, ``item_id``, ``share``, ``cosine`` and ``answer``: a row for each row
    of ``docs`` and item of ``benchmark`` whose text it holds.

    ``mark`` is a hash of the document's text. Texts are compared word by word in lower case. Null
    texts and texts without words match nothing; ids may be of any atomic type, and null ids are kept
    as they are. Repeated documents give repeated rows, repeated items one row per document. Empty
    tables give none. A very long text is searched whole, in pieces of ``WORDS_AT_ONCE`` words.
    """
    items = saved(benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where(
        "text IS NOT NULL").distinct())
    rows = docs.where("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    item_kind, doc_kind = items.schema["item_id"].dataType, rows.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", doc_kind), T.StructField("mark", T.LongType()),
        T.StructField("item_id", item_kind), T.StructField("share", T.DoubleType()),
        T.StructField("cosine", T.DoubleType()), T.StructField("answer", T.BooleanType())])
    if items.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    frequency, total = passage_frequencies(rows)
    idf = np.log((total + 1) / (frequency + 1)) + 0.05
    spark = docs.sparkSession

    def with_spaces(block: list[tuple[object, bytes]]) -> list[tuple[list[Passage], Space]]:
        all_parts = passages_of(block, search)
        groups = [all_parts[a:a + search.dims] for a in range(0, len(all_parts), search.dims)]
        return [(group, latent_space(spark.createDataFrame(
            [(b" ".join(p.words),) for p in group], "text binary"), idf, search))
            for group in groups]

    def run(batches, shared):
        indexes = [Index(group, idf_shared.value, space, search) for group, space in shared.value]
        for batch in batches:
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
            out = []
            first = 0
            for part in slices(batch.column("text").to_pylist(), SLICE):
                for k, hits in enumerate(
                        matches(indexes, part, *_numbered(part), search)):
                    out += [(ids[first + k], marks[first + k], item, *values)
                            for item, values in hits.items()]
                first += len(part)
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["doc_id", "mark", "item_id", "share", "cosine", "answer"]
    types = to_arrow_schema(schema).types
    context = spark.sparkContext
    # Bounded by BUCKETS, ``dims`` and ``block``.
    idf_shared = context.broadcast(idf)
    passes = [rows.mapInArrow(partial(run, shared=context.broadcast(with_spaces(block))), schema)
              for block in _blocks(items, search.block)]
    return union(passes)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, in the columns of ``docs``."""
    marks = find_leaks(docs, benchmark, search).select(F.col("mark").alias("leaked")).distinct()
    return docs.join(marks, F.xxhash64("text") == F.col("leaked"), "left_anti")
