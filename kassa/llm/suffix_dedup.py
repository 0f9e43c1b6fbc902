"""Exact repeated-passage removal by a distributed merge sort of suffixes.

Every text is a string of UTF-8 bytes (null: empty).  A byte goes if it is
covered by a ``MATCH``-byte string that also starts in a document with a smaller
doc_id; strings are judged on the input and never cross documents.

1. Texts are packed into chunks, written once, bucketed by chunk.
2. Anchors: the smallest 24-byte hash of each 50-byte window (a minimiser), so
   equal windows have equal anchors.  Each chunk sends its distinct anchor
   hashes in sorted runs; a hash that only one document has is dropped.  A hot
   hash costs one entry a chunk, however often it occurs.
3. For the rest a chunk sorts the suffixes at its anchors (50 bytes on, then
   the 26 bytes before, nearest first; ordered by anchor hash, then bytes, so
   that ranges are even for any text), keeps one entry for equal ones, and
   sends the sorted runs front-coded: only the bytes after the prefix common
   with the entry before.
4. A task merges the runs of its range with a loser tree over common-prefix
   lengths: of two heads the one with more bytes in common with the last output
   is smaller, and only on equal lengths are bytes compared, from there on.  Of
   equal suffixes, and of all 50-byte windows in a group of suffixes with one
   anchor, the smallest doc_id is known then and goes back to the chunks.
5. Chunks mark the bytes to remove.

Result: one row per row, with all columns of the input.  A row with null doc_id
loses nothing and removes nothing; repeated rows with one doc_id do not remove
each other; an empty table gives an empty result.  Cuts may fall inside a
multi-byte character; ``clean_text`` leaves out what is left of it, while
``kept_sha256`` is that of the exact bytes.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm import text as T
from kassa.session import ensure_checkpoint_dir

MATCH = 50
GRAM = 24
SPAN = MATCH - GRAM + 1  # grams in a window
LEFT = SPAN - 1
KEY = 8 + MATCH + LEFT + 2
GROUP = 8 + GRAM
CHUNK_BYTES = 4 << 20
RANGE_BYTES = 32 << 20
SLICE = 1 << 18
_B = 0xD6E8FEB86659FD93


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_B, n, 1 << 64))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling."""
    h = T.mix(np.arange(1, 257, dtype=np.uint64))[data]
    held = {}
    width = 1
    while width < 16:
        h = h[:-width] * _power(width) + h[width:]
        width *= 2
        held[width] = h
    h16, h8 = held[16], held[8]
    n = len(data) - GRAM + 1
    return T.mix(h16[:n] * _power(8) + h8[16 : 16 + n])


def _slide(values: np.ndarray, pick) -> np.ndarray:
    """pick (minimum or maximum) of each SPAN neighbours."""
    width = 1
    while width * 2 <= SPAN:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = SPAN - width
    return pick(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all windows inside documents, and their hashes."""
    places, hashes = [], []
    for at in range(0, max(len(data) - MATCH + 1, 0), SLICE):
        part = data[at : at + SLICE + MATCH - 1]
        h = _grams(part)
        rank = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        low = _slide(rank, np.minimum)
        # a window that crosses a document's end chooses nothing
        first = np.searchsorted(ends, at, side="right")
        for end in ends[first:]:
            if end - MATCH + 1 - at >= len(low):
                break
            low[max(end - MATCH + 1 - at, 0) : max(end - at, 0)] = 0
        padded = np.zeros(len(low) + 2 * (SPAN - 1), np.uint32)
        padded[SPAN - 1 : SPAN - 1 + len(low)] = low
        chosen = np.flatnonzero(_slide(padded, np.maximum) == rank)
        places.append(chosen + at)
        hashes.append(T.mix(h[chosen]))  # minima are small numbers: spread them again
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, at = np.unique(np.concatenate(places), return_index=True)  # slices overlap
    return place, np.concatenate(hashes)[at]


# ---- chunks


def _chunks(text_col: str):
    def pack(batches):
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        squeeze = zstandard.ZstdCompressor(level=6)
        for block in T.blocks(batches, text_col, CHUNK_BYTES):
            rest = block.batch.drop_columns([text_col])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as out:
                out.write_batch(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([len(block.data)], pa.int64()),
                    pa.array([squeeze.compress(sink.getvalue().to_pybytes())], pa.binary()),
                    pa.array([np.append(0, block.ends).astype(np.int64).tobytes()], pa.binary()),
                    pa.array([squeeze.compress(block.data.tobytes())], pa.binary()),
                ],
                names=["chunk", "n_bytes", "rest", "bounds", "packed"],
            )
            number += 1

    return pack


_CHUNK = "chunk long, n_bytes long, rest binary, bounds binary, packed binary"
_COLUMNS = ["chunk", "n_bytes", "rest", "bounds", "packed"]


class _Chunk:
    def __init__(self, row: dict, id_col: str):
        unpack = zstandard.ZstdDecompressor()
        self.number = row["chunk"]
        self.rest = pa.ipc.open_stream(unpack.decompress(row["rest"])).read_next_batch()
        bounds = np.frombuffer(row["bounds"], np.int64)
        self.starts, self.ends = bounds[:-1], bounds[1:]
        self.data = np.frombuffer(unpack.decompress(row["packed"]), np.uint8)
        ids = self.rest.column(self.rest.schema.get_field_index(id_col)).cast(pa.int64())
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, h = anchors(self.data, self.starts, self.ends)
        doc = np.searchsorted(self.ends, place, side="right")
        good = self.known[doc]
        return place[good], h[good], doc[good]


def _rows(batches, *columns):
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for i in range(batch.num_rows):
            yield {c: col[i].as_py() for c, col in zip(columns, cols, strict=True)}
    T.give_back()


def _pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values: differences by byte plane, compressed."""
    steps = np.diff(values, prepend=values[:1] * 0)
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_sorted(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _cuts(ordered: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of equal hash ranges in ascending hashes."""
    edges = np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64)
    return np.concatenate(([0], np.searchsorted(ordered, edges), [len(ordered)])).astype(np.int64)


# ---- which anchors do two documents share?


def _hash_runs(id_col: str, ranges: int):
    def runs(batches):
        for row in _rows(batches, *_COLUMNS):
            chunk = _Chunk(row, id_col)
            _, h, doc = chunk.anchors()
            ids = chunk.ids[doc]
            order = np.lexsort((ids, h))
            h, ids = h[order], ids[order]
            head = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
            tail = np.append(head[1:], len(h)) - 1
            several = ids[head] != ids[tail] if len(h) else np.zeros(0, bool)
            once = h[head]
            cuts = _cuts(once, ranges)
            for r in range(ranges):
                part = slice(cuts[r], cuts[r + 1])
                if part.stop > part.start:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r], pa.int32()),
                            pa.array([chunk.number], pa.int64()),
                            pa.array([_pack_sorted(once[part])], pa.binary()),
                            pa.array([np.packbits(several[part]).tobytes()], pa.binary()),
                        ],
                        names=["range", "chunk", "hashes", "several"],
                    )

    return runs


def _by_range(rows):
    """Consecutive rows of one range (the input is sorted by it)."""
    held, at = [], None
    for row in rows:
        if at is not None and row["range"] != at:
            yield at, held
            held = []
        at = row["range"]
        held.append(row)
    if held:
        yield at, held


def _shared(batches):
    for _, rows in _by_range(_rows(batches, "range", "chunk", "hashes", "several")):
        runs, sure = [], []
        for row in rows:
            h = _unpack_sorted(row["hashes"])
            runs.append(h)
            sure.append(h[np.unpackbits(np.frombuffer(row["several"], np.uint8), count=len(h)).astype(bool)])
        every = np.sort(np.concatenate(runs))
        wanted = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *sure]))
        del every
        if not len(wanted):
            continue
        for row, h in zip(rows, runs, strict=True):
            at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            own = h[wanted[at] == h]
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]], pa.int64()), pa.array([_pack_sorted(own)], pa.binary())],
                    names=["chunk", "hashes"],
                )


# ---- sorted, front-coded suffix runs


def _keys(data, place, h, start, end) -> np.ndarray:
    """KEY bytes for each anchor: hash, bytes on, bytes before (nearest first), both lengths."""
    n = len(place)
    out = np.zeros((n, KEY), np.uint8)
    out[:, :8] = h.astype(">u8").view(np.uint8).reshape(n, 8)
    right = np.minimum(end - place, MATCH)
    left = np.minimum(place - start, LEFT)
    wide = np.concatenate([np.zeros(LEFT, np.uint8), data, np.zeros(MATCH, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(wide, LEFT + MATCH)[place]
    steps = np.arange(MATCH)
    out[:, 8 : 8 + MATCH] = np.where(steps < right[:, None], views[:, LEFT:], 0)
    out[:, 8 + MATCH : 8 + MATCH + LEFT] = np.where(steps[:LEFT] < left[:, None], views[:, LEFT - 1 :: -1], 0)
    out[:, -2], out[:, -1] = right, left
    return out


def _common(keys: np.ndarray) -> np.ndarray:
    """Bytes each key has in common with the one before (the first: none)."""
    out = np.zeros(len(keys), np.uint8)
    differ = keys[1:] != keys[:-1]
    out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), KEY)
    return out


def _suffix_runs(id_col: str, ranges: int):
    def runs(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for row in _rows(batches, *_COLUMNS, "hashes"):
            chunk = _Chunk(row, id_col)
            place, h, doc = chunk.anchors()
            wanted = np.sort(np.concatenate([_unpack_sorted(x) for x in row["hashes"]]))
            at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            good = wanted[at] == h
            place, h, doc = place[good], h[good], doc[good]
            order = np.argsort(h, kind="stable")
            place, h, doc = place[order], h[order], doc[order]
            cuts = _cuts(h, ranges)
            for r in range(ranges):
                part = slice(cuts[r], cuts[r + 1])
                if part.stop == part.start:
                    continue
                p, d = place[part], doc[part]
                keys = _keys(chunk.data, p, h[part], chunk.starts[d], chunk.ends[d])
                order = np.argsort(keys.view(f"S{KEY}").ravel(), kind="stable")
                keys, p, ids = keys[order], p[order], chunk.ids[d[order]]
                common = _common(keys)
                head = np.flatnonzero(common < KEY)
                common, keys = common[head], keys[head]
                rest = keys[np.arange(KEY) >= common[:, None]].tobytes()
                arrays = [
                    common,
                    np.diff(np.append(head, len(p))).astype(np.int32),
                    p.astype(np.int64),
                    np.minimum.reduceat(ids, head),
                    np.maximum.reduceat(ids, head),
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r], pa.int32()),
                        pa.array([chunk.number], pa.int64()),
                        pa.array([len(head)], pa.int32()),
                        *[
                            pa.array([squeeze.compress(x)], pa.binary())
                            for x in (rest, *(_planes(a) for a in arrays))
                        ],
                    ],
                    names=["range", "chunk", "n", "rest", "common", "counts", "places", "low", "high"],
                )

    return runs


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplanes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_RUN = "range int, chunk long, n int, rest binary, common binary, counts binary, places binary, low binary, high binary"


def merge(runs: list[tuple[list[int], bytes]]):
    """Merge front-coded runs ``(common lengths, concatenated rests)``; yields
    ``(bytes in common with the entry before, key, run, index in run)`` in order."""
    k = len(runs)
    key: list[bytes] = [b""] * k
    common = [-1] * k  # with the last output; -1: the run has ended
    index = [-1] * k
    taken = [0] * k

    def advance(run: int) -> None:
        lengths, rest = runs[run]
        index[run] += 1
        if index[run] == len(lengths):
            common[run] = -1
            return
        n = lengths[index[run]]
        end = taken[run] + KEY - n
        key[run] = key[run][:n] + rest[taken[run] : end]
        taken[run] = end
        common[run] = n

    for run in range(k):
        advance(run)
    losers = [-1] * k  # node 0 holds the winner

    def play(run: int, node: int) -> int:
        """The run that passes on above ``node``; the other one stays there."""
        other = losers[node]
        a, b = common[run], common[other]
        if a > b:
            return run
        if a == b and a >= 0:
            x, y = key[run], key[other]
            n = a
            while n < KEY and x[n] == y[n]:
                n += 1
            if n == KEY:
                if run < other:
                    common[other] = n
                    return run
                common[run] = n
            elif x[n] < y[n]:
                common[other] = n
                return run
            else:
                common[run] = n
        losers[node] = run
        return other

    for run in range(k):  # a node's first arrival waits there for the second
        node = (run + k) >> 1
        winner = run
        while node:
            if losers[node] < 0:
                losers[node] = winner
                winner = -1
                break
            winner = play(winner, node)
            node >>= 1
        if winner >= 0:
            losers[0] = winner
    winner = losers[0] if k > 1 else 0
    while common[winner] >= 0:
        yield common[winner], key[winner], winner, index[winner]
        advance(winner)
        node = (winner + k) >> 1
        while node:
            winner = play(winner, node)
            node >>= 1


def _smallest(keys: list[bytes], docs: list[int]) -> list[list[tuple[int, int, int]]]:
    """For suffixes with one anchor: ``(first, last offset, smallest doc_id)`` of
    the windows that start ``offset`` bytes before the anchor."""
    if len(keys) == 1:
        right, left = keys[0][-2], keys[0][-1]
        return [[(MATCH - right, left, docs[0])]]
    lows: list[list[int | None]] = [[None] * SPAN for _ in keys]
    for offset in range(SPAN):
        best: dict[bytes, int] = {}
        own = []
        for i, key in enumerate(keys):
            if key[-1] >= offset and key[-2] >= MATCH - offset:
                window = key[8 : 8 + MATCH - offset] + key[8 + MATCH : 8 + MATCH + offset]
                own.append((i, window))
                if best.get(window, docs[i]) >= docs[i]:
                    best[window] = docs[i]
        for i, window in own:
            lows[i][offset] = best[window]
    out = []
    for low in lows:
        pieces: list[tuple[int, int, int]] = []
        for offset, doc in enumerate(low):
            if doc is None:
                continue
            if pieces and pieces[-1][2] == doc and pieces[-1][1] == offset - 1:
                pieces[-1] = (pieces[-1][0], offset, doc)
            else:
                pieces.append((offset, offset, doc))
        out.append(pieces)
    return out


def _merged(batches):
    names = ("range", "chunk", "n", "rest", "common", "counts", "places", "low", "high")
    unpack = zstandard.ZstdDecompressor()
    for _, rows in _by_range(_rows(batches, *names)):
        runs = [(_unplanes(r["common"], np.uint8).tolist(), unpack.decompress(r["rest"])) for r in rows]
        lows = [_unplanes(r["low"], np.int64).tolist() for r in rows]
        highs = [_unplanes(r["high"], np.int64).tolist() for r in rows]
        found: list[tuple[list, list, list, list]] = [([], [], [], []) for _ in rows]

        def close(keys, docs, entries):
            for pieces, own in zip(_smallest(keys, docs), entries, strict=True):
                for run, index in own:
                    high = highs[run][index]
                    for first, last, doc in pieces:
                        if doc < high:
                            to = found[run]
                            to[0].append(index)
                            to[1].append(first)
                            to[2].append(last)
                            to[3].append(doc)

        keys: list[bytes] = []
        docs: list[int] = []
        entries: list[list[tuple[int, int]]] = []
        for same, key, run, index in merge(runs):
            low = lows[run][index]
            if same == KEY:
                entries[-1].append((run, index))
                if low < docs[-1]:
                    docs[-1] = low
                continue
            if same < GROUP and keys:
                close(keys, docs, entries)
                keys, docs, entries = [], [], []
            keys.append(key)
            docs.append(low)
            entries.append([(run, index)])
        if keys:
            close(keys, docs, entries)
        for row, (index, first, last, doc) in zip(rows, found, strict=True):
            if not index:
                continue
            counts = _unplanes(row["counts"], np.int32)
            places = _unplanes(row["places"], np.int64)
            begin = np.append(0, np.cumsum(counts))
            index = np.array(index)
            times = counts[index]
            at = np.repeat(begin[index] - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
            order = np.argsort(places[at], kind="stable")
            packed = [
                places[at][order],
                np.repeat(np.array(first, np.uint8), times)[order],
                np.repeat(np.array(last, np.uint8), times)[order],
                np.repeat(np.array(doc, np.int64), times)[order],
            ]
            squeeze = zstandard.ZstdCompressor(level=3)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["chunk"]], pa.int64()), *[pa.array([squeeze.compress(_planes(x))], pa.binary()) for x in packed]],
                names=["chunk", "places", "first", "last", "doc"],
            )


_FOUND = "chunk long, places binary, first binary, last binary, doc binary"


# ---- removal


def _removed(chunk: _Chunk, found: list[dict] | None) -> np.ndarray:
    """Which bytes of the chunk go."""
    step = np.zeros(len(chunk.data) + 1, np.int32)
    for piece in found or []:
        place = _unplanes(piece["places"], np.int64)
        first = _unplanes(piece["first"], np.uint8).astype(np.int64)
        last = _unplanes(piece["last"], np.uint8).astype(np.int64)
        doc = np.searchsorted(chunk.ends, place, side="right")
        later = _unplanes(piece["doc"], np.int64) < chunk.ids[doc]
        np.add.at(step, (place - last)[later], 1)
        np.add.at(step, (place - first + MATCH)[later], -1)
    return np.cumsum(step[:-1], dtype=np.int32) > 0


def _apply(id_col: str, schema: pa.Schema):
    def apply(batches):
        for row in _rows(batches, *_COLUMNS, "found"):
            chunk = _Chunk(row, id_col)
            gone = _removed(chunk, row["found"])
            before = np.append(False, gone[:-1])
            some = chunk.ends > chunk.starts
            before[chunk.starts[some]] = False
            sums = np.append(np.int32(0), np.cumsum(gone, dtype=np.int32))
            heads = np.append(np.int32(0), np.cumsum(gone & ~before, dtype=np.int32))
            kept = [
                chunk.data[a:b][~gone[a:b]].tobytes()
                for a, b in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True)
            ]
            extra = {
                "n_bytes": chunk.ends - chunk.starts,
                "n_removed": sums[chunk.ends] - sums[chunk.starts],
                "n_spans": heads[chunk.ends] - heads[chunk.starts],
                "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept],
                "clean_text": [x.decode("utf-8", "ignore") for x in kept] if "clean_text" in schema.names else None,
            }
            table = dict(zip(chunk.rest.schema.names, chunk.rest.columns, strict=True))
            for at in range(0, len(kept), 500):
                yield pa.RecordBatch.from_arrays(
                    [
                        table[f.name][at : at + 500].cast(f.type) if f.name in table else pa.array(extra[f.name][at : at + 500], f.type)
                        for f in schema
                    ],
                    schema=schema,
                )

    return apply


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """All columns of ``docs`` but the text, then n_bytes, n_removed, n_spans,
    kept_sha256 (long, long, long, hex string) and, if asked for, ``clean_text``.

    Input columns with one of these names or those of ``_COLUMNS`` do not clash:
    they travel inside the chunks; an input column named like a result column is
    replaced by it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructType

    spark = docs.sparkSession
    results = {"n_bytes": LongType(), "n_removed": LongType(), "n_spans": LongType(), "kept_sha256": StringType()}
    if with_text:
        results["clean_text"] = StringType()
    source = docs.select(*[c for c in docs.columns if c not in results])
    rest = [f for f in source.schema.fields if f.name != text_col]
    out = StructType(rest)
    for name, kind in results.items():
        out = out.add(name, kind)

    # written once, bucketed: the two joins on chunk below move no text
    name = f"kassa_chunks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kassa-llm/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        source.mapInArrow(_chunks(text_col), _CHUNK)
        .write.bucketBy(buckets, "chunk")
        .option("path", path)
        .option("compression", "none")
        .saveAsTable(name)
    )
    chunks = spark.table(name)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = 1 + total // RANGE_BYTES

    runs = chunks.mapInArrow(_hash_runs(id_col, ranges), "range int, chunk long, hashes binary, several binary")
    shared = (
        runs.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(_shared, "chunk long, hashes binary")
    )
    wanted = shared.groupBy("chunk").agg(F.collect_list("hashes").alias("hashes"))
    runs = chunks.join(wanted.hint("merge"), "chunk").select(*_COLUMNS, "hashes").mapInArrow(
        _suffix_runs(id_col, 4 * ranges), _RUN
    )
    found = (
        runs.repartition(4 * ranges, "range").sortWithinPartitions("range").mapInArrow(_merged, _FOUND)
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("places", "first", "last", "doc")).alias("found"))
    )
    return (
        chunks.join(found.hint("merge"), "chunk", "left")
        .select(*_COLUMNS, "found")
        .mapInArrow(_apply(id_col, to_arrow_schema(out)), out)
    )
