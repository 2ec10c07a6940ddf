"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into two segments. If two of them differ in at most ``distance`` bits, then
either the first segments differ in at most ``distance // 2`` bits, or the second ones in at most
``(distance - 1) // 2``: else there would be more than ``distance`` in all. So a table of segments
is enough to find all pairs: each fingerprint looks up every value in such a ball around its own
segments, and the complete distance of what it finds is checked.

A segment value that very many fingerprints share (near copies of one page) is not paired up:
members look up complete fingerprints instead, all values within ``distance``, so each
lookup meets one row at most and the work stays in proportion to the number of fingerprints.
"""

import json
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soleprint.llm.graph import components
from soleprint.llm.tables import least, saved, union, written

# Fixed value: the seed of the shingle hash.
SEED = 42
SEGMENT_BITS = 32


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text as a signed integer; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(last)]
    digest = xxhash.xxh64_digest
    hashes = b"".join([
        digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), last.tolist(), strict=True)])
    # In blocks, so that the bits of a very long text are never all in memory.
    size, ones = 8 << 15, np.zeros(64, np.int64)
    for at in range(0, len(hashes), size):
        block = np.frombuffer(hashes[at:at + size], np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(last))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and ``fp`` (long) of each row; a null text counts
    as an empty one."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(whole).alias("mark"),
                       whole.cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(values, pa.int64())],
                ["doc_id", "mark", "fp"])

    schema = T.StructType(rows.schema.fields[:2] + [T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def _balls(bits: int, distance: int, least: int = 0):
    """All ways to change ``least`` to ``distance`` of the lowest ``bits`` bits, as an array
    column of the change and its highest bit."""
    changes = [sum(1 << b for b in chosen) for n in range(least, distance + 1)
               for chosen in combinations(range(bits), n)]
    entries = [{"mask": c - (1 << 64) if c >> 63 else c, "high": max(0, c.bit_length() - 1)}
               for c in changes]
    return F.from_json(F.lit(json.dumps(entries)), "array<struct<mask:bigint,high:int>>")


def _segment(fp: Column, index: int) -> Column:
    if index == 0:
        return F.shiftrightunsigned(fp, SEGMENT_BITS)
    return fp.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _probes(fps: DataFrame, distance: int) -> DataFrame:
    """``fp``, the segment ``seg`` and the value ``val`` to look up there.

    Of two values that differ, only the one whose highest differing bit is 0 looks up the other.
    """
    radii = [distance // 2] + ([(distance - 1) // 2] if distance else [])
    parts = []
    for index, radius in enumerate(radii):
        rows = fps.select("fp", _segment(F.col("fp"), index).alias("own"),
                          F.inline(_balls(SEGMENT_BITS, radius)))
        rows = rows.where((F.col("mask") == 0) | (F.getbit("own", "high") == 0))
        parts.append(rows.select("fp", F.lit(index).alias("seg"),
                                 F.col("own").bitwiseXOR(F.col("mask")).alias("val")))
    return union(parts)


def _pair(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))


def links(fps: DataFrame, distance: int = 2, crowd: int = 500) -> DataFrame:
    """Pairs ``a`` < ``b`` of different fingerprints at most ``distance`` (up to 3) bits apart.

    ``fps`` holds distinct ``fp``. A segment value with more than ``crowd`` fingerprints counts as
    crowded, and its members look up complete fingerprints. Results do not depend on ``crowd``; at
    500 a lookup in a segment costs about as much as the ball around a complete fingerprint.
    """
    if not 0 <= distance <= 3:
        raise ValueError("distance must be 0 to 3")
    table = union([fps.select(F.lit(i).alias("seg"), _segment(F.col("fp"), i).alias("val"), "fp")
                   for i in (0, 1)])
    crowded = saved(table.groupBy("seg", "val").agg(F.count("*").alias("n"))
                    .where(F.col("n") > crowd).select("seg", "val"))
    probes = _probes(fps, distance).join(crowded, ["seg", "val"], "left_anti")
    entries = table.withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    met = probes.join(entries, ["seg", "val"]).where(near & (F.col("fp") != F.col("other")))
    # Whoever would meet a member of a crowded value is in the ball around that member.
    members = table.join(crowded, ["seg", "val"], "left_semi").select("fp").distinct()
    around = members.select("fp", F.inline(_balls(64, distance, least=1))).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("other"))
    met_there = around.join(fps.select(F.col("fp").alias("other")), "other")
    return union([_pair(met), _pair(met_there)]).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
    distance: int = 2, crowd: int = 500,
) -> DataFrame:
    """``doc_id``, ``mark``, ``fp``, ``component_id`` and ``label`` of each row.

    ``component_id`` is the smallest ``doc_id`` that links of at most ``distance`` bits lead to,
    ``label`` the smallest fingerprint, ``mark`` a hash of the row's text. A null text and one
    without words have fingerprint 0 and are linked like any other. Null ids come after all
    others: a component has a null id only if all of its rows do. Repeated rows have the same
    values and all stay; an empty table gives none.
    """
    rows = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    firsts = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = components(links(firsts.select("fp"), distance, crowd))
    joined = saved(firsts.join(labels, firsts["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")))
    least = saved(joined.groupBy("label").agg(F.min("first").alias("component_id")))
    classes = saved(joined.join(least, "label").select("fp", "component_id", "label"))
    return rows.join(classes, "fp").select("doc_id", "mark", "fp", "component_id", "label")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of each group of near-duplicates, in the columns of ``docs``.

    The row with the smallest ``doc_id`` stays (null last); of several with that id in a group one
    with the smallest text hash; of rows equal in both, the smallest in all columns, where maps
    count by their JSON text.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("best")
    stay = near_duplicates(docs, shingle=shingle, distance=distance).groupBy("label").agg(
        best).select("best.doc_id", F.col("best.mark").alias("kept"))
    same = rows["id"].eqNullSafe(stay["doc_id"]) & (rows["mark"] == stay["kept"])
    return rows.join(stay, same, "left_semi").groupBy("id", "mark").agg(
        least("row", docs.schema).alias("row")).select("row.*")
