"""Removal of long repeated byte strings by hashing ranges of them around anchors.

Prefix doubling would sort all positions by the rank of ever longer strings that start there, one
row per byte and round; this is another method. Positions are thinned first, without losing a match:
every string of ``length`` bytes is filed under one of its positions, its anchor, that depends on
nothing but the string (the leftmost one whose next ``gram`` bytes hash lowest). Equal strings have
anchors at equal distances. So the strings filed under an anchor are a range of distances, cut at
fixed distances into cells, and all strings of a cell share a core of about half of ``length``.

Cells are compared first, by a hash of the core and one of the cell's whole surroundings. A cell
whose core is nowhere else holds no repeated string. One whose surroundings occur elsewhere too is
repeated all through. The strings of the other cells are then compared one by one, by their own
hashes, with one cell of each different surroundings of their core.

Texts are numbered into chunks as tasks meet them, and kept one to a row; only a task that works on
a chunk puts its texts together. So no row is larger than its text: rows of many texts filled the
executors' heap. A chunk sends its hashes in packed form, one message to each range of hashes it
has any of, and what is equal inside it only once; so frequent strings weigh no more than one entry
per chunk.
"""

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soleprint.llm.tables import settled, shared_path, small_batches, union

# Bytes of text in a chunk, in which a text counts for so many more, and for one range of hashes, of
# which there are at most so many.
CHUNK_BYTES = 8 << 20
TEXT_BYTES = 100
RANGE_BYTES = 1 << 20
MOST_RANGES = 1024
# Bytes of what a chunk knows by itself that one message carries; a multiple of all entries' sizes.
KNOWN_BYTES = 1 << 16
# Bytes of a table's rows that are written, and later read, together.
ROWS = {"parquet.block.size": str(2 << 20)}
# Starts whose anchors are looked for at a time, and strings hashed at a time.
BLOCK = 1 << 16
HASHED = 1 << 18

# An entry of a cell: hashes of core and surroundings, first and last start, and what is known.
CELL = np.dtype([("k", "<u8"), ("u1", "<u8"), ("u2", "<u8"), ("first", "<i4"), ("last", "<i4"),
                 ("known", "<i4")])
# The surroundings occur again in the chunk; the core occurs in the chunk with others.
AGAIN, SEVERAL = 1, 2
# An entry of a string: its hash, and its start, or -1 minus it if it occurs again in the chunk.
STRING = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("start", "<i4")])


@dataclass(frozen=True)
class Scale:
    """Lengths that follow from the length of the strings."""

    length: int

    @property
    def gram(self) -> int:
        """The greatest power of two in a twelfth of the length."""
        return 1 << max(0, (self.length // 12).bit_length() - 1)

    @property
    def cell(self) -> int:
        """Distances in a cell; two cells cover all."""
        return -(-(self.length - self.gram + 1) // 2)


def _lowest(keys: np.ndarray, window: int) -> np.ndarray:
    """The minimum of each ``window`` entries in a row."""
    have = 1
    while have * 2 <= window:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    more = window - have
    return np.minimum(keys[:len(keys) - more], keys[more:])


MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(31))


def _anchor_of_each(text: np.ndarray, scale: Scale) -> np.ndarray:
    """For each string of a short run of bytes, the position of its anchor."""
    value = (text.astype(np.uint64) + np.uint64(1)) * MIX[1]
    value ^= value >> MIX[2]
    have = 1
    while have < scale.gram:
        value = value[:-have] * MIX[0] + value[have:]
        value ^= value >> MIX[2]
        value *= MIX[1]
        have *= 2
    # Hash and position in one number: the lowest is the leftmost of the lowest hashes.
    keys = value >> np.uint64(32) << np.uint64(32) | np.arange(len(value), dtype=np.uint64)
    return _lowest(keys, scale.length - scale.gram + 1) & np.uint64(0xFFFFFFFF)


def anchors(text: bytes, ends: np.ndarray, scale: Scale,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts that end at ``ends`` of ``text``, and the first and last start of the
    strings filed under each."""
    n = len(text) - scale.length + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none, none
    raw, at = np.frombuffer(text, np.uint8), np.empty(n, np.int32)
    for low in range(0, n, BLOCK):
        high = min(n, low + BLOCK)
        at[low:high] = _anchor_of_each(raw[low:high + scale.length - 1], scale) + np.uint64(low)
    begin = 0
    for end in ends.tolist():  # strings do not cross texts
        at[max(begin, end - scale.length + 1):end] = -1
        begin = end
    cuts = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate(([0], cuts))
    last = np.concatenate((cuts, [n])) - 1
    real = at[first] >= 0
    return at[first[real]].astype(np.int64), first[real], last[real]


def _pairs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def cells(text: bytes, ends: np.ndarray, scale: Scale) -> np.ndarray:
    """The cells of all anchors, as entries of which nothing is known."""
    length, size = scale.length, scale.cell
    a, first, last = anchors(text, ends, scale)
    lowest, highest = (a - last) // size, (a - first) // size
    n = highest - lowest + 1
    a, first, last, lowest = (np.repeat(x, n) for x in (a, first, last, lowest))
    low = (lowest + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)) * size
    high = low + size - 1
    text_no = np.searchsorted(ends, a, "right")
    begins = np.concatenate(([0], ends))[text_no]
    # Where the text ends sooner, equal surroundings end with it at the same place.
    before, after = np.minimum(a - begins, high), np.minimum(ends[text_no] - a, length - low)
    made, view = np.zeros(len(a), CELL), memoryview(text)
    core, around = xxhash.xxh3_64_digest, xxhash.xxh3_128_digest
    made["k"] = np.frombuffer(b"".join([core(view[i:j], seed) for i, j, seed in zip(
        (a - low).tolist(), (a + length - high).tolist(), low.tolist(), strict=True)]), "<u8")
    made["u1"], made["u2"] = _pairs([around(view[i:j], seed) for i, j, seed in zip(
        (a - before).tolist(), (a + after).tolist(),
        (low | before << 20 | after << 40).tolist(), strict=True)])
    made["first"], made["last"] = np.maximum(first, a - high), np.minimum(last, a - low)
    return made


def _groups(rows: np.ndarray, *keys: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of ``rows`` by ``keys``, and in that order, for each key, the number of each row's
    group of rows with equal values up to that key."""
    order = np.lexsort([rows[k] for k in reversed(keys)])
    new, numbers = np.arange(len(rows)) == 0, []
    for key in keys:
        new = new.copy()
        new[1:] |= np.diff(rows[key][order]) != 0
        numbers.append(np.cumsum(new) - 1)
    return order, numbers


def _firsts(numbers: np.ndarray) -> np.ndarray:
    """Whether each row is the first of its group."""
    return np.diff(numbers, prepend=-1) > 0


def _spans(rows: np.ndarray) -> np.ndarray:
    return np.stack([rows["first"], rows["last"]], 1)


def _sent_cells(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a chunk sends of its cells, and the spans of starts that are repeated, and that are
    open, by what the chunk itself knows.

    A core with several surroundings in the chunk is sent once, without any of them, and the strings
    of all of them are compared.
    """
    order, (core, _, around) = _groups(rows, "k", "u1", "u2")
    rows = rows[order]
    again, one = np.bincount(around)[around] > 1, _firsts(around)
    several = np.bincount(core[one])[core] > 1
    rows["known"] = np.where(several, SEVERAL, np.where(again, AGAIN, 0))
    sent = rows[np.where(several, _firsts(core), one)]
    for name in ("u1", "u2"):
        sent[name][sent["known"] == SEVERAL] = 0
    return sent, _spans(rows[again]), _spans(rows[several & one])


def _judged_cells(rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Which of the cells that chunks have sent are repeated all through, and which are open: their
    numbers and spans.

    A core is open if it has different surroundings of which some occur once. Of each of them one
    cell is, whether it is repeated itself or not.
    """
    order, (core, _, around) = _groups(rows, "k", "u1", "u2")
    rows = rows[order]
    several = rows["known"] == SEVERAL
    total = np.bincount(around, 1 + (rows["known"] == AGAIN))[around]
    one = _firsts(around)
    differ = (np.bincount(core[one])[core] > 1) | (np.bincount(core, several)[core] > 0)
    single = np.bincount(core, several | (total == 1))[core] > 0
    return [(order[found], _spans(rows[found])) for found in (
        (total > 1) & (rows["known"] == 0), differ & single & one & ~several)]


def _strings(text: bytes, spans: np.ndarray, length: int) -> np.ndarray:
    """The strings that start in ``spans``, as entries."""
    n = spans[:, 1] - spans[:, 0] + 1
    starts = np.repeat(spans[:, 0] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    made, view = np.zeros(len(starts), STRING), memoryview(text)
    for low in range(0, len(starts), HASHED):
        part = slice(low, low + HASHED)
        made["h1"][part], made["h2"][part] = _pairs(
            [xxhash.xxh3_128_digest(view[i:i + length]) for i in starts[part].tolist()])
    made["start"] = starts
    return made


def _sent_strings(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a chunk sends of its strings, and the starts of those that are repeated in it."""
    order, (_, same) = _groups(rows, "h1", "h2")
    rows = rows[order]
    again, one = np.bincount(same)[same] > 1, _firsts(same)
    sure = rows["start"][again]
    rows["start"][again] = -1 - rows["start"][again]
    return rows[one], sure


def _judged_strings(rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Which of the strings that chunks have sent are repeated: their numbers and starts."""
    order, (_, same) = _groups(rows, "h1", "h2")
    start = rows["start"][order]
    found = (np.bincount(same)[same] > 1) & (start >= 0)
    none = np.zeros(0, np.int64)
    return [(order[found], start[found]), (none, none)]


def _messages(rows: np.ndarray, by: str, ranges: int) -> tuple[list[int], list[bytes]]:
    """Entries by range of hashes."""
    part = (rows[by] % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, begins = np.unique(part[order], return_index=True)
    rows, bounds = rows[order], [*begins.tolist(), len(rows)]
    return found.tolist(), [rows[a:b].tobytes() for a, b in pairwise(bounds)]


def _chunks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The texts with the number of their chunk, texts in a row, and their own in it; kept in
    buckets, so that what is found out about a chunk meets it without moving it."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(
        F.col(f"`{text}`"), F.lit("")).cast("binary").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, no, filled = uuid.uuid4().int >> 65, 0, 0
        for batch in batches:
            sizes, chunks, numbers = pc.binary_length(batch.column("bytes")), [], []
            for size in sizes.to_pylist():
                if no and filled + size > CHUNK_BYTES:
                    chunk, no, filled = uuid.uuid4().int >> 65, 0, 0
                chunks.append(chunk)
                numbers.append(no)
                no, filled = no + 1, filled + size + TEXT_BYTES
            made = pa.RecordBatch.from_arrays(
                [pa.array(chunks, pa.int64()), pa.array(numbers, pa.int32()),
                 sizes.cast(pa.int64()), *batch.columns],
                ["chunk", "no", "size", "doc_id", "bytes"])
            cuts = [i for i, n in enumerate(numbers) if i and not n]
            for at, end in pairwise([0, *cuts, len(numbers)]):
                yield made.slice(at, end - at)

    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "chunks")
    kind = rows.schema["doc_id"].dataType.simpleString()
    name = f"chunks_{uuid.uuid4().hex}"
    made = rows.mapInArrow(run, f"chunk long, no int, size long, doc_id {kind}, bytes binary")
    made.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").options(
        path=path, compression="zstd", **ROWS).saveAsTable(name, format="parquet")
    return spark.table(name)


def _texts(rows: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """The texts of a chunk, whose ``rows`` are in order, and the ends of them put together."""
    texts = rows.column("bytes").to_pylist()
    return texts, np.cumsum([len(t) for t in texts], dtype="<i8")


ASKED = "part int, chunk long, entries binary, sure binary, open binary"


def _dealt(known: bytes, chunk: int, parts: int) -> list[bytes]:
    """What a chunk knows, over its messages; not the same of them for all chunks."""
    dealt = [[] for _ in range(parts)]
    for i, at in enumerate(range(0, len(known), KNOWN_BYTES)):
        dealt[(chunk + i) % parts].append(known[at:at + KNOWN_BYTES])
    return [b"".join(own) for own in dealt]


def _asked(chunk: int, sent: np.ndarray, by: str, ranges: int, *known: bytes) -> pa.Table:
    """A chunk's messages; some of them also carry what it knows."""
    parts, entries = _messages(sent, by, ranges)
    return pa.table(
        [pa.array(parts, pa.int32()), pa.array([chunk] * len(parts), pa.int64()),
         pa.array(entries, pa.binary()),
         *(pa.array(_dealt(own, chunk, len(parts)), pa.binary()) for own in known)],
        ["part", "chunk", "entries", "sure", "open"])


def _told(asked: DataFrame, kind: np.dtype, judged: Callable, name: str) -> DataFrame:
    """``sure`` and ``open`` for each ``chunk``, by what all chunks have sent; in several rows."""
    def run(table: pa.Table) -> pa.Table:
        entries = table.column("entries").to_pylist()
        sizes = [len(e) // kind.itemsize for e in entries]
        row = np.repeat(np.arange(len(sizes)), sizes)
        answers = []
        for own, (of, answer) in zip(
                ("sure", "open"), judged(np.frombuffer(b"".join(entries), kind)), strict=True):
            order = np.argsort(row[of], kind="stable")
            answer = answer[order]
            bounds = np.searchsorted(row[of][order], np.arange(len(sizes) + 1)).tolist()
            answers.append(pa.array([known + answer[a:b].tobytes() for known, (a, b) in zip(
                table.column(own).to_pylist(), pairwise(bounds), strict=True)], pa.binary()))
        return pa.table([table.column("chunk"), *answers], ["chunk", "sure", "open"])

    told = asked.groupBy("part").applyInArrow(run, "chunk long, sure binary, open binary")
    return settled(told.where("octet_length(sure) + octet_length(open) > 0"), name, **ROWS)


def _numbers(values: pa.ChunkedArray) -> np.ndarray:
    """The numbers in several binaries."""
    return np.frombuffer(b"".join(values.to_pylist()), "<i4")


def _asked_cells(chunks: DataFrame, scale: Scale, ranges: int) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        texts, ends = _texts(rows.sort_by("no"))
        sent, sure, left = _sent_cells(cells(b"".join(texts), ends, scale))
        return _asked(rows["chunk"][0].as_py(), sent, "k", ranges, sure.tobytes(), left.tobytes())

    return chunks.select("chunk", "no", "bytes").groupBy("chunk").applyInArrow(run, ASKED)


def _asked_strings(chunks: DataFrame, told: DataFrame, length: int, ranges: int) -> DataFrame:
    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        text = b"".join(_texts(rows.sort_by("no"))[0]) if len(told) else b""
        sent, sure = _sent_strings(_strings(text, _numbers(told["open"]).reshape(-1, 2), length))
        return _asked(rows["chunk"][0].as_py(), sent, "h1", ranges, sure.tobytes(), b"")

    left = told.where("octet_length(open) > 0").select("chunk", "open")
    return chunks.select("chunk", "no", "bytes").groupBy("chunk").cogroup(
        left.groupBy("chunk")).applyInArrow(run, ASKED)


def removed_runs(spans: np.ndarray, ends: np.ndarray, length: int,
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of bytes, first and end, covered by strings that start in ``spans``, and the number
    of the text that each lies in."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")].astype(np.int64)
    of = np.searchsorted(ends, spans[:, 0], "right")
    stop = np.maximum.accumulate(spans[:, 1] + length)
    new = np.ones(len(spans), bool)
    new[1:] = (spans[1:, 0] > stop[:-1]) | (np.diff(of) != 0)
    return spans[new, 0], stop[np.append(new[1:], True)] if len(spans) else stop, of[new]


def remove_repeats(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text",
                   ) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``removed`` (runs as ``first`` and ``end``) and ``kept`` (bytes) of
    each row: every byte covered by a string of ``length`` bytes that also starts elsewhere goes.

    Strings are judged on the input, as UTF-8 bytes, and do not cross rows. A null text counts as
    an empty one; repeated rows are copies of each other, so all of theirs goes if they are long
    enough. An empty table gives none. A text must be shorter than 2 GB.
    """
    scale = Scale(length)
    with small_batches(docs.sparkSession):
        chunks = _chunks(docs, doc_id, text)
        ranges = min(MOST_RANGES, 1 + (chunks.agg(F.sum("size")).first()[0] or 0) // RANGE_BYTES)
        by_cells = _told(_asked_cells(chunks, scale, ranges), CELL, _judged_cells, "cells")
        by_strings = _told(_asked_strings(chunks, by_cells, length, ranges), STRING,
                           _judged_strings, "strings")
    none = F.lit(b"")
    found = union([
        by_cells.select("chunk", F.col("sure").alias("spans"), none.alias("starts")),
        by_strings.select("chunk", none.alias("spans"), F.col("sure").alias("starts"))])

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows = rows.sort_by("no")
        texts, ends = _texts(rows)
        one = _numbers(found["starts"])
        first, end, of = removed_runs(np.concatenate(
            [_numbers(found["spans"]).reshape(-1, 2), np.stack([one, one], 1)]), ends, length)
        begins = np.concatenate(([0], ends[:-1]))
        bounds = np.searchsorted(of, np.arange(len(ends) + 1))
        first, end = first - begins[of], end - begins[of]
        runs = pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["first", "end"])
        kept, firsts, stops = [], first.tolist(), end.tolist()
        for value, (i, j) in zip(texts, pairwise(bounds.tolist()), strict=True):
            kept.append(value if i == j else b"".join([value[x:y] for x, y in zip(
                [0, *stops[i:j]], [*firsts[i:j], len(value)], strict=True)]))
        return pa.table(
            [rows["doc_id"], pa.array(ends - begins),
             pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
             pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return chunks.select("chunk", "no", "doc_id", "bytes").groupBy("chunk").cogroup(
        found.groupBy("chunk")).applyInArrow(
            run, f"doc_id {kind}, n_bytes long, "
            "removed array<struct<first:bigint,end:bigint>>, kept binary")
