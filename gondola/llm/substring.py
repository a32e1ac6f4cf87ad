"""Substring deduplication with a count-min prefilter.

Pass one counts the hash of every window of ``window`` words in count-min sketches,
one per task, that are merged by adding their cells. A sketch never underestimates,
so every window that occurs twice is estimated as repeated. Pass two sends on only the
windows estimated repeated and groups them exactly, by 96 bits of hash.

Within a task only the occurrences in a window's smallest document go on. All others
are known to be later copies, so a window that a third of all documents share is a
row per task and not a row per document.

The merged sketch is the only thing that is broadcast. It has ``2 x CELLS_PER_BYTE``
bits per byte of text and never more than ``sketch_mb`` megabytes. Past that bound the
estimates grow and pass two groups more windows; the result stays the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import key_of, pick, word_chunks, word_hashes

WINDOW = 13
#: Rows of the sketch; a window's two cells come from the halves of its hash.
ROWS = 2
#: Cells per sketch row for a byte of text: about two per word.
CELLS_PER_BYTE = 0.3125
#: Largest size of the merged sketch.
SKETCH_MB = 128
#: Cells that one merge step holds together.
SEGMENT = 1 << 16
#: Windows a task gathers before it sends them on: for the sketch, and to be grouped.
SKETCH_FLUSH, FLUSH = 3 << 20, 1 << 18

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def window_hashes(text: str | None, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """64 and 32 bits of hash of every window, and the number of words."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    first, second, n_words, carried = [], [], 0, 0
    for words in word_chunks(data, width - 1):
        n_words += len(words) - carried
        carried = min(width - 1, len(words))
        n = len(words) - width + 1
        if n < 1:
            continue
        a = word_hashes(words)
        b = _mixed(a)
        h, g = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        for k in range(width):
            h = h * _MUL + a[k:k + n]
            g = g * _MUL2 + b[k:k + n]
        first.append(_mixed(h))
        second.append(_mixed(g))
    if not first:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), n_words
    return (np.concatenate(first),
            (np.concatenate(second) >> np.uint64(32)).astype(np.uint32), n_words)


def _cells(h: np.ndarray, segments: int) -> list[np.ndarray]:
    """Cell of every hash in each sketch row, rows one after the other."""
    width = np.uint64(segments * SEGMENT)
    low, bits = np.uint64(0xFFFFFFFF), np.uint64(32)
    return [((part * width) >> bits) + width * np.uint64(row)
            for row, part in enumerate((h >> bits, h & low))]


def _packed(cells: np.ndarray, segments: int, wide: bool) -> pa.Array:
    """Sorted distinct cells as one binary value per segment.

    Wide: two bytes per place. Else a byte per gap from the place before, where 255
    means 255 further and no place yet.
    """
    starts = np.arange(segments + 1, dtype=np.uint64) * np.uint64(SEGMENT)
    bounds = np.searchsorted(cells, starts)
    places = (cells & np.uint64(SEGMENT - 1)).astype(np.int64)
    if wide:
        ends, data = bounds * 2, places.astype("<u2")
    else:
        gaps = places.copy()
        gaps[1:] -= places[:-1]
        first = bounds[:-1][bounds[:-1] < bounds[1:]]
        gaps[first] = places[first]
        ends = np.concatenate(([0], np.cumsum(gaps // 255 + 1)))
        data = np.full(ends[-1], 255, np.uint8)
        data[ends[1:] - 1] = gaps % 255
        ends = ends[bounds]
    return pa.Array.from_buffers(pa.binary(), segments, [
        None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _places(packed: bytes, wide: bool) -> np.ndarray:
    if wide:
        return np.frombuffer(packed, "<u2")
    gaps = np.frombuffer(packed, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def _sketches(width: int, segments: int):
    """Arrow function: sparse sketch segments of a task's windows, one count a document."""
    def flushed(gathered: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(gathered)
        for row in range(ROWS):
            cells = _cells(h, segments)[row] - np.uint64(row * segments * SEGMENT)
            cells.sort()
            first = np.ones(len(cells), bool)
            first[1:] = cells[1:] != cells[:-1]
            many = np.diff(np.append(np.flatnonzero(first), len(cells))) > 1
            cells = cells[first]
            wide = len(cells) * 512 < segments * SEGMENT
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row * segments, (row + 1) * segments, dtype=np.int32)),
                 pa.array(np.full(segments, wide)), _packed(cells[~many], segments, wide),
                 _packed(cells[many], segments, wide)],
                names=["segment", "wide", "seen", "again"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in batches:
            for text in batch.column(0):
                h = np.unique(window_hashes(text.as_py(), width)[0])
                gathered.append(h)
                n += len(h)
                if n >= SKETCH_FLUSH:
                    yield from flushed(gathered)
                    gathered, n = [], 0
        if n:
            yield from flushed(gathered)

    return build


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the sparse segments of all tasks; a bit per cell that counts two or more."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, wide, seen, again in zip(*(c.to_pylist() for c in batch.columns)):
            cells = counts.setdefault(segment, np.zeros(SEGMENT, np.uint8))
            at = _places(seen, wide)
            cells[at] = np.minimum(cells[at] + 1, 2)
            cells[_places(again, wide)] = 2
    for segment, cells in counts.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int32()), pa.array([np.packbits(cells == 2).tobytes()])],
            names=["segment", "bits"])


def repeated_sketch(texts: DataFrame, n_bytes: int, width: int, sketch_mb: int,
                    tasks: int) -> np.ndarray:
    """Bits of the merged sketch: is a cell's count two or more?"""
    most = (sketch_mb << 20) * 8 // (ROWS * SEGMENT)
    segments = max(1, min(most, int(n_bytes * CELLS_PER_BYTE) // SEGMENT + 1))
    parts = texts.mapInArrow(_sketches(width, segments),
                             "segment int, wide boolean, seen binary, again binary")
    rows = (parts.filter((F.length("seen") > 0) | (F.length("again") > 0))
            .repartitionById(tasks, "segment").mapInArrow(_merged, "segment int, bits binary"))
    bits = np.zeros((ROWS * segments, SEGMENT // 8), np.uint8)
    for segment, packed in rows.collect():  # at most sketch_mb
        bits[segment] = np.frombuffer(packed, np.uint8)
    return bits


def _planes(values: np.ndarray) -> bytes:
    """The values' 16-bit digits, digit by digit: high digits are zeros that compress."""
    digits = np.ascontiguousarray(values).view("<u2").reshape(len(values), -1)
    return digits.T.tobytes()


def _whole(planes: bytes, kind: str) -> np.ndarray:
    digits = np.frombuffer(planes, "<u2").reshape(np.dtype(kind).itemsize // 2, -1)
    return np.ascontiguousarray(digits.T).view(kind).reshape(-1)


_PACKED = pa.schema([("part", pa.int32()), ("h1", pa.binary()), ("h2", pa.binary()),
                     ("pos", pa.binary()), ("ids", pa.binary()), ("ths", pa.binary()),
                     ("counts", pa.binary()), ("_id", pa.int64()), ("_th", pa.int64()),
                     ("known", pa.binary())])
_PACKED_SQL = ("part int, h1 binary, h2 binary, pos binary, ids binary, ths binary, "
               "counts binary, _id bigint, _th bigint, known binary")


def _occurrences(width: int, sketch, parts: int):
    """Arrow function: windows estimated repeated, or later copies known by the task.

    Windows go on in blocks, one per ``part`` of the hashes; a row with ``known`` has the
    positions of later copies in one document.
    """
    def estimated(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
        flat, passes = bits.reshape(-1), np.ones(len(h), bool)
        for cells in _cells(h, bits.shape[0] // ROWS):
            byte = flat[(cells >> np.uint64(3)).astype(np.int64)]
            passes &= (byte >> (7 - (cells & np.uint64(7)).astype(np.uint8))) & 1 == 1
        return passes

    def block(part: int, h1, h2, pos, ids, ths) -> tuple:
        starts = np.ones(len(h1), bool)
        starts[1:] = (ids[1:] != ids[:-1]) | (ths[1:] != ths[:-1])
        first = np.flatnonzero(starts)
        counts = np.diff(np.append(first, len(h1))).astype("<u4")
        # Ids ascend within a block, so their differences are small.
        gaps = np.diff(ids[first], prepend=np.int64(0)).astype("<i8")
        return (part, h1.astype("<u8").tobytes(), h2.astype("<u4").tobytes(), _planes(pos),
                _planes(gaps), ths[first].astype("<i8").tobytes(), _planes(counts),
                None, None, None)

    def flushed(gathered: list) -> pa.RecordBatch:
        h1, h2, pos = (np.concatenate([g[k] for g in gathered]) for k in range(3))
        sizes = [len(g[0]) for g in gathered]
        ids = np.repeat(np.array([g[3] for g in gathered], np.int64), sizes)
        ths = np.repeat(np.array([g[4] for g in gathered], np.int64), sizes)
        order = np.lexsort((ids, h2, h1))
        starts = np.ones(len(order), bool)
        a, b = order[1:], order[:-1]
        starts[1:] = (h1[a] != h1[b]) | (h2[a] != h2[b])
        least = ids[order[np.flatnonzero(starts)]][np.cumsum(starts) - 1]
        later = np.zeros(len(order), bool)
        later[order] = ids[order] > least
        part = (h1 % np.uint64(parts)).astype(np.int64)
        ask = np.flatnonzero(~later)
        ask = ask[np.lexsort((pos[ask], ths[ask], ids[ask], part[ask]))]
        rows = []
        if len(ask):
            for at in np.split(ask, np.flatnonzero(np.diff(part[ask])) + 1):
                rows.append(block(int(part[at[0]]), *(x[at] for x in (h1, h2, pos, ids, ths))))
        known = np.flatnonzero(later)
        known = known[np.lexsort((ths[known], ids[known]))]
        if len(known):
            change = (np.diff(ids[known]) != 0) | (np.diff(ths[known]) != 0)
            for at in np.split(known, np.flatnonzero(change) + 1):
                one = at[0]
                # By document: copies share their windows, and thus the windows' part.
                rows.append((int(ids[one] % parts), *[None] * 6, int(ids[one]), int(ths[one]),
                             pos[at].astype("<i4").tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], field.type) for k, field in enumerate(_PACKED)],
            schema=_PACKED)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, gathered, n = sketch.value, [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                h1, h2, _ = window_hashes(batch.column(2)[i].as_py(), width)
                at = np.flatnonzero(estimated(h1, bits))
                if len(at):
                    gathered.append((h1[at], h2[at], at.astype(np.uint32),
                                     batch.column(0)[i].as_py(), batch.column(1)[i].as_py()))
                    n += len(at)
                if n >= FLUSH:
                    yield flushed(gathered)
                    gathered, n = [], 0
        if n:
            yield flushed(gathered)

    return find


_ROWS = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("_id", pa.int64()),
                   ("_th", pa.int64()), ("pos", pa.int32()), ("known", pa.binary())])
_ROWS_SQL = "h1 bigint, h2 int, _id bigint, _th bigint, pos int, known binary"


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of the blocks; rows of known positions as they are."""
    for batch in batches:
        for row in batch.to_pylist():
            if row["known"] is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.get(f.name) if f.name in ("_id", "_th", "known") else None],
                              f.type) for f in _ROWS], schema=_ROWS)
                continue
            counts = _whole(row["counts"], "<u4")
            h1 = np.frombuffer(row["h1"], "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1), pa.array(np.frombuffer(row["h2"], "<i4")),
                 pa.array(np.repeat(np.cumsum(_whole(row["ids"], "<i8")), counts)),
                 pa.array(np.repeat(np.frombuffer(row["ths"], "<i8"), counts)),
                 pa.array(_whole(row["pos"], "<u4").astype(np.int32)),
                 pa.nulls(len(h1), pa.binary())], schema=_ROWS)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by window and id, those whose id isn't the window's smallest."""
    last, least = None, 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        known = table.filter(pc.is_valid(table["known"]))
        if known.num_rows:
            yield from known.select(["_id", "_th", "pos", "known"]).to_batches()
        table = table.filter(pc.is_null(table["known"]))
        if not table.num_rows:
            continue
        h1, h2, ids = (table[c].to_numpy() for c in ("h1", "h2", "_id"))
        starts = np.ones(len(h1), bool)
        starts[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts[0] = last != (h1[0], h2[0])
        of = np.concatenate(([least], ids[starts]))[np.cumsum(starts)]
        last, least = (h1[-1], h2[-1]), of[-1]
        found = table.filter(pa.array(ids > of)).select(["_id", "_th", "pos", "known"])
        yield from found.to_batches()


def later_copies(keyed: DataFrame, width: int, sketch_mb: int) -> DataFrame:
    """``_id, _th`` and the start positions of windows that a smaller id also has."""
    spark = keyed.sparkSession
    sums = (keyed.groupBy("_id").agg(F.sum(F.octet_length("text")).alias("n"),
                                     (F.min("_th") != F.max("_th")).alias("again"))
            .agg(F.sum("n").alias("n"), F.max("again").alias("again")).first())
    # Where no id has two texts, its text's hash says nothing more.
    texts = keyed.select("_id", (F.col("_th") if sums["again"] else
                                 F.lit(0).cast("bigint")).alias("_th"), "text")
    tasks = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sketch = spark.sparkContext.broadcast(
        repeated_sketch(texts.select("text"), sums["n"] or 0, width, sketch_mb, tasks))
    blocks = texts.mapInArrow(_occurrences(width, sketch, tasks), _PACKED_SQL)
    # Rows of one window: at most one task's smallest document each. The sort spills.
    found = (blocks.repartitionById(tasks, "part").mapInArrow(_unpacked, _ROWS_SQL)
             .sortWithinPartitions("h1", "h2", "_id")
             .mapInArrow(_later, "_id bigint, _th bigint, pos int, known binary"))
    copies = found.groupBy("_id", "_th").agg(
        F.collect_list("pos").alias("starts"), F.collect_list("known").alias("known"))
    return copies if sums["again"] else copies.drop("_th")


def covered(n_words: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which words any of the windows covers."""
    steps = np.zeros(n_words + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def _kept(width: int, with_text: bool):
    """Arrow function: what is left of each text."""
    def cut(text: str | None, starts: np.ndarray) -> tuple[int, int, bytes, str]:
        data = text.encode("utf-8", "surrogatepass") if text else b""
        chunks = list(word_chunks(data)) if len(starts) else word_chunks(data)
        gone = (covered(sum(map(len, chunks)), starts, width) if len(starts) else None)
        sha, at, removed, pieces = hashlib.sha256(), 0, 0, []
        for words in chunks:
            n = len(words)
            if gone is not None:
                drop = gone[at:at + n]
                removed += int(drop.sum())
                words = [w for w, d in zip(words, drop.tolist()) if not d]
            if words:
                piece = b" ".join(words)
                sha.update(b" " + piece if pieces else piece)
                pieces.append(piece if with_text else b"")
            at += n
        kept = b" ".join(pieces).decode("utf-8", "surrogatepass") if with_text else None
        return at, removed, sha.hexdigest(), kept

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts, known in zip(*batch.columns[1:]):
                places = [starts.values.to_numpy()] if starts.is_valid and len(starts) else []
                if known.is_valid:
                    places += [np.frombuffer(k.as_py(), "<i4") for k in known]
                rows.append(cut(text.as_py(), np.concatenate(places).astype(np.int64)
                                if places else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return cut_all


def substring_dedup(docs: DataFrame, width: int = WINDOW, doc_id: str = "doc_id",
                    text: str = "text", sketch_mb: int = SKETCH_MB,
                    with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text``, one row per input row.

    A word goes if a window of ``width`` words that covers it also starts in a row
    with a smaller id. All windows are judged on the input. Words stand between
    ASCII white space; kept words are joined by one space.

    A null text has no words. A text of fewer than ``width`` words has no windows. A
    row whose id is null is neither smaller nor larger than any other: nothing is
    removed from it or because of it. Rows that repeat with the same id don't remove
    words from each other. An empty table gives an empty result.
    """
    rows = pick(docs, doc_id=doc_id, text=text).withColumns(key_of())
    copies = later_copies(rows.filter(F.col("doc_id").isNotNull()), width, sketch_mb)
    keys = [c for c in ("_id", "_th") if c in copies.columns]
    joined = rows.join(copies, keys, "left").select("doc_id", "text", "starts", "known")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        _kept(width, with_text), f"doc_id {kind}, n_words bigint, n_removed bigint, "
        "kept_sha256 string, kept_text string")


ORACLE = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, k, w[k:k + {WINDOW - 1}] AS win FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS k FROM texts WHERE len(w) >= {WINDOW})),
later AS (
  SELECT doc_id, k FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY win)),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + {WINDOW})) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts),
kept AS (
  SELECT w.doc_id, count(g.p) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY w.p) FILTER (WHERE g.p IS NULL), '') AS kept
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.p = w.p GROUP BY w.doc_id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""
