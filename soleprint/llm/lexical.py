"""Ranked lexical search for many items at once, by common-subexpression evaluation.

An item's score of a document is a sum over the item's terms, so the scores of all items are many
sums over the same addends. Terms that the same items hold are one addend from the start. Then pairs
of addends that several items share are mined, the most shared first, and each becomes a sum of its
own, until no two items share a pair: a graph of sums, in which each is made once for a document and
used by all that need it.

Documents are read once: what is kept of each is its length and the counts of the items' terms.
These rows give the statistics, and then the scores: a task fills the addends of some thousand
documents, goes through the graph in order, and keeps each item's best.
"""

import heapq
import math
import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soleprint.llm.tables import saved, union, written

# ASCII letters and digits belong to terms, with A-Z lower-cased, and so does all beyond ASCII.
LOWER = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
# Bytes of item texts that are answered in one pass over the documents, and documents whose sums a
# task holds at a time. Neither changes results.
BLOCK_BYTES, CHUNK = 1 << 20, 2000


def terms(text: str) -> list[bytes]:
    return text.encode().translate(LOWER).split()


@dataclass
class Graph:
    """``vocabulary`` gives each term its addend; node i is the sum of addend i for the first
    ``addends`` of them, and of the two nodes ``pairs[i - addends]`` after that; item i is the sum
    of the nodes ``items[i]``. ``ids`` are the items' ids."""

    ids: pa.Array
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    addends: int = 0
    pairs: list[tuple[int, int]] = field(default_factory=list)
    items: list[list[int]] = field(default_factory=list)


def share(ids: pa.Array, texts: list[str]) -> Graph:
    """The graph for some items: classes of terms first, then pairs that items share."""
    graph, holders = Graph(ids), defaultdict(list)
    for i, text in enumerate(texts):
        for term in set(terms(text)):
            holders[term].append(i)
    classes: dict[tuple[int, ...], int] = {}
    for term, own in sorted(holders.items()):
        graph.vocabulary[term] = classes.setdefault(tuple(own), len(classes))
    graph.addends = len(classes)
    nodes: list[set[int]] = [set() for _ in texts]
    users = {node: set(own) for own, node in classes.items()}
    for own, node in classes.items():
        for i in own:
            nodes[i].add(node)
    # Pairs are counted among nodes that more than one item uses.
    shared = {n for n, own in users.items() if len(own) > 1}
    counts = Counter(pair for own in nodes for pair in combinations(sorted(own & shared), 2))
    heap = [(-n, pair) for pair, n in counts.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        both = users[a] & users[b]
        if len(both) < 2:
            continue
        if len(both) < -n:  # some of its items have been given another sum meanwhile
            heapq.heappush(heap, (-len(both), (a, b)))
            continue
        new = graph.addends + len(graph.pairs)
        graph.pairs.append((a, b))
        users[a], users[b], users[new] = users[a] - both, users[b] - both, both
        near = Counter()
        for i in both:
            nodes[i] -= {a, b}
            near.update(node for node in nodes[i] if node in shared)
            nodes[i].add(new)
        shared.add(new)
        for node, m in near.items():
            if m > 1:
                heapq.heappush(heap, (-m, (node, new)))
    graph.items = [sorted(own) for own in nodes]
    return graph


def _blocks(items: DataFrame) -> DataFrame:
    """A row for each block of items: its graph."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = items.withColumn(
        "block", F.pmod(F.xxhash64("item_id", "text"), F.lit(-(-size // BLOCK_BYTES) or 1)))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        graph = share(group.column("item_id").chunk(0), group.column("text").to_pylist())
        return pa.table({"graph": pa.array([pickle.dumps(graph)], pa.binary())})

    return saved(dealt.groupBy("block").applyInArrow(run, "graph binary"))


def _postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, the number of terms, and those of the vocabulary with their counts, of every
    document that has a term."""
    place = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, get = place.value.keys(), place.value.__getitem__
        for batch in batches:
            rows, sizes, ends, found, counts = [], [], [0], [], []
            for row, text in enumerate(batch.column("text")):
                own = terms(text.as_py())
                if own:
                    tally = Counter(filter(known.__contains__, own))
                    rows.append(row)
                    sizes.append(len(own))
                    found.append(np.fromiter(map(get, tally), np.int32, len(tally)))
                    counts.append(np.fromiter(tally.values(), np.int32, len(tally)))
                    ends.append(ends[-1] + len(tally))
            def lists(parts):
                flat = np.concatenate([np.zeros(0, np.int32), *parts])
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())),
                 pa.array(sizes, pa.int64()), lists(found), lists(counts)], schema.names)

    return written(docs.mapInArrow(run, schema), "postings")


def _statistics(postings: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """The number of documents with a term, of all their terms, and of documents with each term
    of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, total, holders = 0, 0, np.zeros(size, np.int64)
        for batch in batches:
            docs += len(batch)
            total += int(np.asarray(batch.column("n")).sum())
            holders += np.bincount(np.asarray(batch.column("terms").flatten()), minlength=size)
        own = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *own.tolist()], pa.int64()),
             pa.array([docs, total, *holders[own].tolist()], pa.int64())], ["term", "n"])

    sums = postings.select("n", "terms").mapInArrow(run, "term long, n long")
    sums = dict(sums.groupBy("term").agg(F.sum("n")).collect())
    return (sums.get(-2, 0), sums.get(-1, 0),
            np.array([sums.get(i, 0) for i in range(size)], np.int64))


class Scorer:
    """A graph with the corpus's statistics."""

    def __init__(self, graph: Graph, docs: int, total: int, holders: np.ndarray):
        self.graph, self.docs, self.total = graph, docs, max(1, total)
        self.addend = np.array(list(graph.vocabulary.values()), np.int64)
        self.weight = np.array([
            math.floor(1000 * math.log((2 * docs + 2) / (2 * int(df) + 1))) for df in holders],
            np.int64)

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        """A row for each item, with its score of each document."""
        graph, size = self.graph, len(batch)
        found, tf = (np.asarray(batch.column(c).flatten()).astype(np.int64)
                     for c in ("terms", "counts"))
        doc = np.repeat(np.arange(size), np.diff(np.asarray(batch.column("terms").offsets)))
        n = np.asarray(batch.column("n"))
        m = 100 - 50 + 50 * n * self.docs // self.total
        part = self.weight[found] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        nodes = np.zeros((graph.addends + len(graph.pairs), size), np.int64)
        # As doubles, which are exact here: a term adds less than 2 ** 36, a block has fewer than
        # 2 ** 17 terms unless a single item is that long.
        nodes[:graph.addends] = np.bincount(
            self.addend[found] * size + doc, weights=part, minlength=graph.addends * size
        ).reshape(graph.addends, size).astype(np.int64)
        for i, (a, b) in enumerate(graph.pairs, graph.addends):
            np.add(nodes[a], nodes[b], out=nodes[i])
        return np.array([nodes[own].sum(axis=0) for own in graph.items]).reshape(-1, size)


class Best:
    """The best documents of each item among those that one task has seen."""

    def __init__(self, items: int, top: int):
        self.top, self.floor = top, np.ones(items, np.int64)
        self.parts: list[pa.Table] = []
        self.size, self.limit = 0, 4 * items * top + CHUNK

    def add(self, scores: np.ndarray, doc_id: pa.Array) -> None:
        for item, own in enumerate(scores):
            at = np.flatnonzero(own >= self.floor[item])
            if len(at) > self.top:
                least = np.partition(own[at], len(at) - self.top)[len(at) - self.top]
                self.floor[item] = max(self.floor[item], least)
                at = at[own[at] >= least]
            if len(at):
                self.parts.append(pa.table({
                    "item": np.full(len(at), item), "score": own[at],
                    "doc_id": doc_id.take(pa.array(at))}))
                self.size += len(at)
        if self.size > self.limit:
            kept = self.rows()
            self.parts, self.size = [kept], len(kept)
            item, score = (kept.column(c).to_numpy() for c in ("item", "score"))
            last = np.flatnonzero(np.append(np.diff(item) != 0, True))
            full = last[np.diff(np.append(-1, last)) == self.top]
            self.floor[item[full]] = score[full]

    def rows(self) -> pa.Table | None:
        if not self.parts:
            return None
        rows = pa.concat_tables(self.parts).sort_by(
            [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
        item = rows.column("item").to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        return rows.take(pa.array(np.flatnonzero(place < self.top)))


def _ranked(docs: DataFrame, graph: Graph, item_type: T.DataType, top: int) -> DataFrame:
    """Each task's best documents of each item of the graph."""
    vocabulary = list(graph.vocabulary)
    postings = _postings(docs, vocabulary)
    scorer = docs.sparkSession.sparkContext.broadcast(
        Scorer(graph, *_statistics(postings, len(vocabulary))))
    schema = T.StructType([
        T.StructField("item_id", item_type), docs.schema["doc_id"],
        T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = scorer.value.graph.ids
        best = Best(len(ids), top)
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.slice(at, CHUNK)
                best.add(scorer.value.scores(part), part.column("doc_id"))
        rows = best.rows()
        if rows is not None:
            made = pa.table({"item_id": ids.take(rows.column("item").combine_chunks()),
                             "doc_id": rows.column("doc_id"), "score": rows.column("score")})
            yield from made.combine_chunks().to_batches()

    return postings.mapInArrow(run, schema)


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = 50, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``top`` documents with a
    score above 0, equal scores in ascending order of ``doc_id``, null last.

    Each document counts and is ranked by itself, also where rows repeat; rows of ``items`` with
    the same id are one item with the terms of all their texts. Null and empty texts have no terms: such documents are not found, such items find
    none. Long texts are read whole. Empty tables give no rows. Items are answered in blocks of
    about a megabyte of text, each with one pass over the documents; ids of any type that can be
    sorted will do.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")
                       ).where(F.col("text").isNotNull())
    items = items.select(F.col(f"`{item_id}`").alias("item_id"),
                         F.col(f"`{item_text}`").alias("text")).groupBy("item_id").agg(
        F.array_join(F.sort_array(F.collect_set("text")), "\n").alias("text"))
    kind = items.schema["item_id"].dataType
    parts = []
    for row in _blocks(items).toLocalIterator():  # one block's graph at a time
        parts.append(_ranked(docs, pickle.loads(row["graph"]), kind, top))
    if not parts:
        empty = T.StructType([T.StructField("item_id", kind), docs.schema["doc_id"],
                              T.StructField("score", T.LongType())])
        parts = [docs.sparkSession.createDataFrame([], empty)]
    # Tasks' rows meet in two steps, so that no task gets all those of an item at once.
    rows = union(parts).withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(64)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item_id", "slot"], ["item_id"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= top)
    return rows.select("item_id", "rank", "doc_id", "score")
