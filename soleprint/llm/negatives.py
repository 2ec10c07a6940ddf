"""Hard negatives by a BOND scan: vectors are kept dimension by dimension, and read that way.

Vectors are dealt into blocks, and a block keeps one column per dimension with its smallest and
largest entry. For an anchor, columns are read in order of the anchor's largest components. After
each few columns, what the others can still add lies between two sums of those extremes, so every
candidate's score has a lower and an upper bound. Candidates that cannot matter any more leave the
bitmap, and later columns are read for the rest only. Once all columns are read, scores are exact.

Anchors are dealt into packs, and each task scans one block for one pack, so neither the vectors nor
the anchors meet in one place. A block answers with at most as many rows as are asked for.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soleprint.llm.tables import saved, written


@dataclass(frozen=True)
class Mining:
    """``positives`` of each anchor's label, ``negatives`` for each; a negative's score is between
    ``low`` and ``high`` hundredths of the positive's. Components are multiplied by ``scale`` and
    rounded down. The others are sizes, which do not change results: vectors in a block, anchors in
    a pack, columns read between two looks at the bounds."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    block: int = 8192
    pack: int = 512
    step: int = 8


def usable(rows: DataFrame, scale: int, vec_id: str, vector: str, label: str) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` of whole numbers, of rows without any null or
    non-finite entry. Each id has one row: the smallest, should there be several."""
    entries = F.col(f"`{vector}`")
    finite = F.forall(entries, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(entries, lambda x: F.floor(x.cast("double") * scale))
    return rows.where(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull()
                      & entries.isNotNull() & finite).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.struct(
            F.col(f"`{label}`").cast("string").alias("label"), whole.alias("vector")).alias("own")
    ).groupBy("vec_id").agg(F.min("own").alias("own")).select("vec_id", "own.label", "own.vector")


def _wide(vectors: pa.Array, width: int) -> np.ndarray:
    """One row per vector; shorter ones end in zeros."""
    ends = np.asarray(vectors.offsets)
    values = np.asarray(vectors.flatten()).astype(np.int64, copy=False)
    sizes = np.diff(ends)
    table = np.zeros((len(vectors), width), np.int64)
    table[np.arange(width) < sizes[:, None]] = values
    return table


def _columns(rows: DataFrame, blocks: int, width: int) -> DataFrame:
    """A row for each block: its ids, its labels, and the entries of each dimension together."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        table = np.ascontiguousarray(_wide(group.column("vector").chunk(0), width).T)
        return pa.table({
            "block": group.column("block")[:1], "vec_id": [group.column("vec_id").to_pylist()],
            "label": [group.column("label").to_pylist()],
            "columns": pa.array([[c.tobytes() for c in table]], pa.list_(pa.binary())),
            "low": pa.array([table.min(axis=1).tolist()], pa.list_(pa.int64())),
            "high": pa.array([table.max(axis=1).tolist()], pa.list_(pa.int64()))})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return written(dealt.groupBy("block").applyInArrow(
        run, "block long, vec_id array<long>, label array<string>, columns array<binary>, "
             "low array<long>, high array<long>"), "columns")


class Block:
    """The vectors of a block, by dimension."""

    def __init__(self, row: pa.Table):
        self.ids = np.array(row.column("vec_id")[0].as_py(), np.int64)
        names, self.labels = np.unique(
            np.array(row.column("label")[0].as_py(), object).astype(str), return_inverse=True)
        self.names = {name: i for i, name in enumerate(names)}
        self.columns = np.array(
            [np.frombuffer(c, np.int64) for c in row.column("columns")[0].as_py()],
            np.int64).reshape(-1, len(self.ids))
        self.low = np.array(row.column("low")[0].as_py(), np.int64)
        self.high = np.array(row.column("high")[0].as_py(), np.int64)
        self.reach = max([0, *(abs(int(x)) for x in (*self.low, *self.high))])
        self.doubles = self.columns.astype(np.float64)

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, step: int,
             keep: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        """The places and exact scores of the candidates that ``keep``, given their lower and upper
        bounds, never drops."""
        bound = self.reach * sum(abs(int(x)) for x in anchor)
        if bound >= 1 << 62:
            raise ValueError("inner products of these vectors may not fit into a long")
        # Doubles hold these sums exactly up to 2 ** 53, and are faster.
        columns, q = ((self.doubles, anchor.astype(np.float64)) if bound < 1 << 53
                      else (self.columns, anchor))
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.sort([anchor * self.low, anchor * self.high], axis=0)[:, order]
        rest = np.concatenate((ends[:, ::-1].cumsum(axis=1)[:, ::-1], [[0], [0]]), axis=1)
        alive = np.flatnonzero(candidates)
        score = np.zeros(len(alive), q.dtype)
        for at in range(0, len(order), step):
            own = order[at:at + step]
            part = columns[own]
            score += q[own] @ (part if len(alive) == part.shape[1] else part[:, alive])
            left = rest[:, min(at + step, len(order))]
            stay = keep(score + left[0], score + left[1])
            if not stay.all():
                alive, score = alive[stay], score[stay]
            if not len(alive):
                break
        return alive, score.astype(np.int64)


def _kth(values: np.ndarray, k: int):
    """The ``k``-th largest value."""
    return np.partition(values, len(values) - k)[len(values) - k]


def _best(block: Block, places: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which of the scored places are the first ``k``: high scores first, then small ids."""
    return np.lexsort((block.ids[places], -score))[:k]


def _same_label(block: Block, anchor_id: int, label: str, anchor: np.ndarray, mining: Mining):
    """The block's first rows of the anchor's label: ids and scores."""
    k = mining.positives
    candidates = (block.labels == block.names.get(label, -1)) & (block.ids != anchor_id)

    def keep(low, high):
        return high >= _kth(low, k) if len(low) > k else np.ones(len(low), bool)

    places, score = block.scan(anchor, candidates, mining.step, keep)
    first = _best(block, places, score, k)
    return block.ids[places[first]], score[first]


def _other_labels(block: Block, anchor_id: int, label: str, anchor: np.ndarray,
                  positives: list[int], mining: Mining):
    """For each positive's score, the block's first rows within its window: ids and scores."""
    k = mining.negatives
    windows = [(-(-mining.low * p // 100), mining.high * p // 100) for p in positives]
    candidates = (block.labels != block.names.get(label, -1)) & (block.ids != anchor_id)

    def keep(low, high):
        stay = np.zeros(len(low), bool)
        for least, most in windows:
            may = (high >= least) & (low <= most)
            sure = low[(low >= least) & (high <= most)]
            if len(sure) >= k:
                may &= high >= _kth(sure, k)
            stay |= may
        return stay

    places, score = block.scan(anchor, candidates, mining.step, keep)
    for least, most in windows:
        inside = np.flatnonzero((score >= least) & (score <= most))
        first = inside[_best(block, places[inside], score[inside], k)]
        yield block.ids[places[first]], score[first]


def _scanned(blocks: DataFrame, packs: DataFrame, n_blocks: int, n_packs: int, run, schema: str):
    """``run`` over each block with each pack of anchors."""
    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left, right = blocks.withColumn("pack", numbers(n_packs)), packs.withColumn(
        "block", numbers(n_blocks))
    return left.groupBy("block", "pack").cogroup(right.groupBy("block", "pack")).applyInArrow(
        run, schema)


def _packed(anchors: DataFrame) -> DataFrame:
    return anchors.groupBy("pack").agg(F.collect_list(F.struct(
        *[c for c in anchors.columns if c != "pack"])).alias("anchors"))


def _first(rows: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def mine_negatives(
    rows: DataFrame, is_anchor: Column, mining: Mining = Mining(), vec_id: str = "vec_id",
    vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``: for each anchor and each of its first rows of the same label, the first
    rows of other labels whose score lies in the positive's window.

    A score is the inner product with the anchor; higher ones come first, then smaller ids.
    ``is_anchor`` is a condition on the column ``vec_id``. Rows with a null id or label, a null
    vector, or a null or non-finite component take no part; of several rows with one id, the one
    with the smallest label and vector does. Shorter vectors are filled up
    with zeros; an empty vector has a score of 0 with all. A positive without any negative gives no
    row, nor does an empty table. Scores that may leave the range of a long raise an error.
    """
    every = written(usable(rows, mining.scale, vec_id, vector, label), "vectors")
    n_rows, width, n_anchors = every.agg(
        F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0)),
        F.count(F.when(is_anchor, 1))).first()
    n_blocks, n_packs = -(-n_rows // mining.block) or 1, -(-n_anchors // mining.pack) or 1
    blocks = _columns(every, n_blocks, width)
    anchors = every.where(is_anchor).withColumn(
        "pack", F.pmod(F.xxhash64("vec_id"), F.lit(n_packs)))

    def opened(left: pa.Table, right: pa.Table):
        """The block, and each anchor of the pack with its vector."""
        if not len(left) or not len(right):
            return
        block = Block(left)
        own = right.column("anchors").combine_chunks().flatten()
        vectors = _wide(own.field("vector"), width)
        for anchor, q in zip(own.to_pylist(), vectors, strict=True):
            yield block, anchor, q

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(a["vec_id"], a["label"], i, s) for block, a, q in opened(left, right)
                 for i, s in zip(*_same_label(block, a["vec_id"], a["label"], q, mining),
                                 strict=True)]
        return pa.table([pa.array([r[i] for r in found], kind) for i, kind in enumerate(
            (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
            ["vec_id", "label", "other_id", "score"])

    positives = _first(
        _scanned(blocks, _packed(anchors), n_blocks, n_packs, near,
                 "vec_id long, label string, other_id long, score long"),
        ["vec_id", "label"], mining.positives, "place")
    positives = positives.groupBy("vec_id", "label").agg(
        F.collect_list(F.struct("other_id", "score")).alias("positives"))
    asked = saved(anchors.join(positives, ["vec_id", "label"]))

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for block, a, q in opened(left, right):
            scores = [p["score"] for p in a["positives"]]
            answers = _other_labels(block, a["vec_id"], a["label"], q, scores, mining)
            for p, (ids, score) in zip(a["positives"], answers, strict=True):
                found += [(a["vec_id"], p["other_id"], p["score"], i, s)
                          for i, s in zip(ids.tolist(), score.tolist(), strict=True)]
        return pa.table([pa.array([r[i] for r in found], pa.int64()) for i in range(5)],
                        ["anchor_id", "positive_id", "positive_score", "other_id", "score"])

    negatives = _scanned(
        blocks, _packed(asked), n_blocks, n_packs, hard,
        "anchor_id long, positive_id long, positive_score long, other_id long, score long")
    return _first(negatives, ["anchor_id", "positive_id"], mining.negatives, "rank").select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
