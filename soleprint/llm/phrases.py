"""Removal of repeated phrases with automata over the phrases that recur.

A window is ``length`` words in a row. All windows count by their first occurrence: the others go.

1. Different texts are kept once, in buckets, with a place in one order over all of them.
2. Each window is filed under its anchor, the ``gram`` words in it that hash lowest. A window that
   recurs has an anchor that recurs, so only windows under such anchors are looked at further: they
   are counted by hash, and the recurring ones learn where the first of them is.
3. Windows in a row whose first occurrences are in a row too make one passage. Its words are taken
   from the text that has it first, and sent to the texts that are believed to repeat it.
4. Those texts are dealt into shards. A shard compiles an Aho-Corasick automaton of its passages,
   and streams its texts through it, word by word. What the automaton finds is repeated for certain,
   wherever it is; only the first occurrence itself is left out.

Hashes only decide what is sent where; nothing goes that an automaton has not found. A text without
a recurring anchor has no recurring window, so it needs no automaton.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soleprint.llm.tables import settled, shared_path, shuffles_dropped

KEY = ["t1", "t2"]
# Bytes of text that a task holds as words at a time, and words of passages in an automaton.
SLICE_BYTES, AUTOMATON_WORDS = 4 << 20, 200_000
FACTOR, MIX = 0x9E3779B97F4A7C15, np.uint64(0xC4CEB9FE1A85EC53)


@dataclass(frozen=True)
class Shape:
    """Words in a window, and in an anchor; the latter changes no results."""

    length: int = 20
    gram: int = 8

    @property
    def spread(self) -> int:
        """Anchors that a window has to choose from."""
        return self.length - min(self.gram, self.length) + 1


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` entries in a row."""
    if k == 1:
        return values
    half = k // 2
    part = rolling(values, half)
    both = part[:len(part) - half] * np.uint64(pow(FACTOR, half, 1 << 64)) + part[half:]
    return both if k % 2 == 0 else both[:-1] * np.uint64(FACTOR) + values[k - 1:]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(29)) * MIX
    return values ^ values >> np.uint64(32)


def anchors(hashes: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors' hashes, and the first and last window filed under each."""
    grams = mixed(rolling(hashes, shape.length - shape.spread + 1))
    # The lowest hash, of equal ones the leftmost.
    keys = grams >> np.uint64(32) << np.uint64(32) | np.arange(len(grams), dtype=np.uint64)
    lowest = np.lib.stride_tricks.sliding_window_view(keys, shape.spread).min(axis=1)
    at = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate(([0], cuts))
    return grams[at[first]].view(np.int64), first, np.concatenate((cuts, [len(at)])) - 1


def hashed(batches: Iterator[pa.RecordBatch]):
    """The rows of each slice of the batches, and the hashes of the words of each text."""
    for batch in batches:
        for part, own in split(batch):
            different = list(set().union(*own))
            place = dict(zip(different, range(len(different)), strict=True))
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in different], np.uint64)
            sizes = [len(words) for words in own]
            ids = np.fromiter(map(place.__getitem__, chain.from_iterable(own)), np.int64,
                              sum(sizes))
            yield part, np.split(hashes[ids], np.cumsum(sizes)[:-1])


def split(batch: pa.RecordBatch):
    """A batch cut into slices of bounded size, and the words of each text."""
    texts, at = batch.column("bytes").to_pylist(), 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
            size += len(texts[end])
            end += 1
        yield batch.slice(at, end - at), [t.split() for t in texts[at:end]]
        at = end


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(whole).alias("t1"),
                       F.xxhash64(F.lit(1), whole).alias("t2"), whole.cast("binary").alias("bytes"))


def different_texts(docs: DataFrame) -> DataFrame:
    """Each text once, with the smallest id it has; kept in buckets, so that what is found out about
    texts meets them without moving them again."""
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "texts")
    texts = docs.groupBy(*KEY).agg(
        F.min(F.struct("doc_id")).alias("at"), F.first("bytes").alias("bytes"))
    name = f"texts_{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        texts.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *KEY).option(
            "path", path).option("compression", "zstd").saveAsTable(name, format="parquet")
    return spark.table(name)


def _numbered(texts: DataFrame) -> DataFrame:
    """``base`` of each text: the bytes of all texts before it, by id and then by hash.

    So ``base`` plus a word's number orders all words of all texts. Only one number per task's
    share of the texts meets the others.
    """
    order = ["at", *KEY]
    rows = settled(texts.select(*order, (F.octet_length("bytes") + 1).cast("long").alias("size"))
                   .repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("size").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("start")
    return settled(rows.join(parts, "part").select(*KEY, base.alias("base")), "numbers")


def _anchored(texts: DataFrame, shape: Shape) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in hashed(batches):
            bases, rows = np.asarray(part.column("base")), [(np.zeros(0, np.int64),) * 4]
            for base, hashes in zip(bases, own, strict=True):
                if len(hashes) >= shape.length:
                    h, first, last = anchors(hashes, shape)
                    rows.append((np.full(len(h), base), h, first, last - first + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(kind)) for c, kind in zip(
                    zip(*rows, strict=True), (np.int64, np.int64, np.int32, np.int32),
                    strict=True)], ["base", "h", "first", "n"])

    long_enough = texts.where(F.octet_length("bytes") >= 2 * shape.length - 1)
    return settled(long_enough.select("base", "bytes").mapInArrow(
        run, "base long, h long, first int, n int"), "anchors")


def _by_text(rows: DataFrame, numbers: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` as one list per text, with the text's bucket key."""
    entries = F.struct(*[c for c in rows.columns if c != key])
    lists = rows.groupBy(F.col(key).alias("base")).agg(F.collect_list(entries).alias(name))
    return lists.join(numbers, "base")


def _windows(texts: DataFrame, shape: Shape) -> DataFrame:
    """The windows under the anchors of ``open``: hash, text and first word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in hashed(batches):
            lists = part.column("open")
            entries, ends = lists.flatten(), np.cumsum([0, *lists.value_lengths().to_pylist()])
            h, first, sizes = (np.asarray(entries.field(c)) for c in ("h", "first", "n"))
            rows = []
            for i, (base, hashes) in enumerate(
                    zip(part.column("base").to_pylist(), own, strict=True)):
                mine = slice(ends[i], ends[i + 1])
                n = sizes[mine]
                starts = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                window = mixed(rolling(hashes, shape.length)).view(np.int64)
                rows.append((np.repeat(h[mine], n), window[starts], np.full(len(starts), base),
                             starts.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)],
                ["h", "w", "base", "start"])

    return settled(texts.select("base", "bytes", "open").mapInArrow(
        run, "h long, w long, base long, start int"), "windows")


def _passages(repeats: DataFrame) -> DataFrame:
    """Repeats in a row as one: ``base``, the first window's ``start``, the number ``n`` of windows,
    and where the first occurrence of all this is (``lead``, ``lead_start``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, start, lead, at = (np.asarray(batch.column(c)) for c in
                                     ("base", "start", "lead", "lead_start"))
            new = np.ones(len(base), bool)
            new[1:] = ((np.diff(base) != 0) | (np.diff(start) != 1) | (np.diff(lead) != 0)
                       | (np.diff(at) != 1))
            first = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (base[first], start[first], np.diff([*first, len(base)]),
                                       lead[first], at[first])],
                ["base", "start", "n", "lead", "lead_start"])

    # A run that ends with a batch or a task is two passages that overlap, which does no harm.
    return settled(repeats.repartition("base").sortWithinPartitions("base", "start").mapInArrow(
        run, "base long, start int, n long, lead long, lead_start int"), "passages")


def _words_of(texts: DataFrame, shape: Shape) -> DataFrame:
    """The words of each passage in ``wanted``, from the text that has it first."""
    names = ["lead", "lead_start", "n", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in split(batch):
                rows = [
                    (lead, p["lead_start"], p["n"], b" ".join(
                        words[p["lead_start"]:p["lead_start"] + p["n"] + shape.length - 1]))
                    for lead, wanted, words in zip(
                        part.column("base").to_pylist(), part.column("wanted").to_pylist(), own,
                        strict=True) for p in wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                        (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names)

    return texts.select("base", "bytes", "wanted").mapInArrow(
        run, "lead long, lead_start int, n long, words binary")


class Automaton:
    """An Aho-Corasick automaton over the words of some passages."""

    def __init__(self, passages: dict[bytes, tuple[int, int]]):
        self.numbers: dict[bytes, int] = {}
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for passage, lead in passages.items():
            own = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in passage.split())
            self.machine.add_word(own, (len(own), *lead))
        self.machine.make_automaton()

    def find(self, base: int, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """First and last word of each passage in a text, but for the first occurrences."""
        get = self.numbers.get
        for end, (size, lead, start) in self.machine.iter(tuple([get(w, 0) for w in words])):
            if (lead, start) != (base, end - size + 1):
                yield end - size + 1, end


def located(rows: list[tuple[int, list[bytes], list[dict]]]) -> list[list[list[int]]]:
    """For each text, given its place, its words and the passages it is believed to hold: the runs
    of words that automata find in it, as first word and end."""
    runs, at = [], 0
    while at < len(rows):
        end, size, passages = at, 0, {}
        while end < len(rows) and (end == at or size < AUTOMATON_WORDS):
            for p in rows[end][2]:
                if p["words"] not in passages:
                    passages[p["words"]] = (p["lead"], p["lead_start"])
                    size += p["words"].count(b" ") + 1
            end += 1
        machine = Automaton(passages) if passages else None
        for base, words, own in rows[at:end]:
            merged: list[list[int]] = []
            for first, last in sorted(machine.find(base, words)) if own else ():
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], last + 1)
                else:
                    merged.append([first, last + 1])
            runs.append(merged)
        at = end
    return runs


def repeated_phrases(texts: DataFrame, numbers: DataFrame, shape: Shape) -> DataFrame:
    """``base`` of each text that repeats something, its bucket key, and ``phrases``: the words of
    all passages that it is believed to repeat, with the place of their first occurrence."""
    found = _anchored(texts.join(numbers, KEY), shape)
    shared = settled(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"),
                     "shared")
    open_texts = _by_text(found.join(shared, "h", "left_semi"), numbers, "base", "open")
    windows = _windows(texts.join(open_texts, KEY), shape)
    # A text is before another if its base is smaller, so both minima are of the same occurrence.
    first = settled(windows.groupBy("h", "w").agg(
        F.count("*").alias("n"), F.min("base").alias("lead"),
        F.min(F.col("base") + F.col("start")).alias("place")).where("n > 1").select(
        "h", "w", "lead", (F.col("place") - F.col("lead")).cast("int").alias("lead_start")),
        "first")
    repeats = windows.join(first, ["h", "w"]).where(
        (F.col("base") != F.col("lead")) | (F.col("start") != F.col("lead_start")))
    passages = _passages(repeats.select("base", "start", "lead", "lead_start"))
    passages = passages.drop("start").distinct()
    place = ["lead", "lead_start", "n"]
    wanted = _by_text(passages.select(*place).distinct(), numbers, "lead", "wanted")
    words = _words_of(texts.join(wanted, KEY), shape)
    # Passages and not texts are joined, so that a text which very many repeat meets them one by one.
    phrases = passages.join(words, place).select("base", "words", "lead", "lead_start")
    return _by_text(phrases, numbers, "base", "phrases")


def remove_phrases(
    docs: DataFrame, shape: Shape = Shape(), doc_id: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """What is left of each different text, and which rows have it.

    The first table has ``t1``, ``t2``, ``at`` (the smallest id with this text), ``n_words``,
    ``removed`` (runs of words as first and end) and ``kept`` (the words that stay where the text
    comes first, joined by spaces, as UTF-8 bytes). The second has ``doc_id``, ``t1`` and ``t2`` of
    each row; :func:`for_rows` joins them.

    A word goes if a window of ``length`` words that covers it also starts earlier: in a row with a
    smaller id, or in the same text. A null id comes before all others; of different texts with one
    id, hashes say which is first; equal rows are one text, and keep the same. A null text counts
    as an empty one, which has no words, as have texts without any; those with fewer than
    ``length`` words keep them all. Long texts are read whole. An empty table gives none.
    """
    rows = _keyed(docs, doc_id, text)
    texts = different_texts(rows)
    numbers = _numbered(texts)
    phrases = repeated_phrases(texts, numbers, shape)
    joined = texts.join(numbers, KEY).join(phrases.drop("base"), KEY, "left")
    schema = T.StructType([
        *texts.select(*KEY, "at").schema.fields, T.StructField("n_words", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])
    run_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in split(batch):
                phrases = part.column("phrases").to_pylist()
                runs = located([(base, words, p or []) for base, words, p in zip(
                    part.column("base").to_pylist(), own, phrases, strict=True)])
                kept = []
                for words, gone in zip(own, runs, strict=True):
                    ends, starts = [0, *(b for _, b in gone)], [*(a for a, _ in gone), len(words)]
                    kept.append(b" ".join(chain.from_iterable(
                        words[a:b] for a, b in zip(ends, starts, strict=True))))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in (*KEY, "at")),
                     pa.array([len(words) for words in own], pa.int64()),
                     pa.array([[{"first": a, "end": b} for a, b in r] for r in runs], run_type),
                     pa.array(kept, pa.binary())], schema.names)

    left = joined.select(*KEY, "at", "base", "bytes", "phrases").mapInArrow(run, schema)
    return left, rows.select("doc_id", *KEY)


def removed_words(removed: Column) -> Column:
    """The number of words in all runs."""
    return F.aggregate(removed, F.lit(0).cast("long"),
                       lambda total, run: total + run["end"] - run["first"])


def for_rows(texts: DataFrame, rows: DataFrame, shape: Shape, kept: str, none: Column) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``n_runs`` and ``kept`` of each row.

    ``texts`` has what is kept of a text, or something made of it, in the column ``kept``; ``none``
    is the same of no words. Rows after the first with a text repeat all of it if it has a window.
    """
    joined = rows.join(texts, KEY)
    own = F.col("doc_id").eqNullSafe(F.col("at.doc_id")) | (F.col("n_words") < shape.length)
    return joined.select(
        "doc_id", "n_words",
        F.when(own, removed_words(F.col("removed"))).otherwise(F.col("n_words")).alias("n_removed"),
        F.when(own, F.size("removed")).otherwise(1).cast("long").alias("n_runs"),
        F.when(own, F.col(kept)).otherwise(none).alias("kept"))
