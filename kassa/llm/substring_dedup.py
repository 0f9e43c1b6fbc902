"""Exact removal of repeated word windows by super-k-mer partitioning.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text (null: none).  A window is
``WINDOW`` consecutive words of one row; a word goes if a window over it has the
same words as a window anywhere else, the same row included.

1. Every task packs the texts it reads into compressed chunks of about
   ``CHUNK_BYTES``, written once, bucketed by the task: the write moves nothing,
   and the two joins that need texts again move none either.
2. The minimiser of a window is the smallest hash of its ``GRAM``-word grams,
   the leftmost on ties, so equal windows have equal minimisers at the same
   place.  Consecutive windows with one minimiser form a super-k-mer; two equal
   windows are never in the same one, so a minimiser with a single super-k-mer
   has no repeated window.  Only the minimisers' hashes are counted first, one
   row for each that a chunk has.
3. Super-k-mers of the others travel as one packed string each, its words joined
   by one blank, to the bucket of their minimiser.  There equal strings are
   counted once, and the windows of different strings are sorted, bytes against
   bytes: equal neighbours are repeated windows.
4. A minimiser with more than ``hot`` super-k-mers (a line that very many texts
   hold between words of their own) would make one large bucket.  Its windows
   travel one by one instead, as a 128-bit hash of their words, one row for each
   that a chunk has, and are counted by that; nothing is dropped or capped, and no
   task gets more than ``hot`` strings, or one short row a chunk, for one key.
5. Chunks mark the words that repeated windows cover.

Result: one row per row, with all columns of the input but the text.  Repeated
rows and rows with a null id count like any other; texts of fewer than
``WINDOW`` words lose nothing; an empty table gives an empty result.  Columns
travel inside the chunks, so their names cannot clash; an input column named
like a result column is replaced by it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kassa.llm import text as T
from kassa.session import ensure_checkpoint_dir

WINDOW = 35
GRAM = 8
HOT = 4096
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 256 << 20

_CHUNK = "part int, chunk long, n_rows int, n_bytes long, keys binary, rest binary, sizes binary, body binary"
_MARK = "part int, chunk long, firsts binary, lasts binary"
_SECOND = np.uint64(0xA0761D6478BD642F)


class Words:
    """Words of a chunk: ``data`` is every row's words, each followed by one
    blank; word i is ``data[first[i]:last[i]]``; ``bounds`` are the first words
    of the rows (n + 1)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        first, last, self.bounds = T.word_spans(data, starts, ends, T.NOT_SPACE)
        lengths = last - first
        self.last = np.cumsum(lengths + 1) - 1
        self.first = self.last - lengths
        # a word's bytes, and a blank where the text may have any white space
        self.data = np.full(int(self.last[-1]) + 1 if len(first) else 0, 0x20, np.uint8)
        mark = np.zeros(len(data) + 1, np.int8)
        mark[first] += 1
        np.subtract.at(mark, last, 1)
        inside = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
        keep = np.ones(len(self.data), bool)
        keep[self.last] = False
        self.data[keep] = data[inside]

    def __len__(self) -> int:
        return len(self.first)

    def hashes(self) -> np.ndarray:
        return T.word_hashes(self.data, self.first, self.last)


def super_kmers(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser hash of each super-k-mer."""
    n = len(words)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, np.zeros(0, np.uint64)
    grams = T.combine([hashes[i : n - GRAM + 1 + i] for i in range(GRAM)])
    span = WINDOW - GRAM + 1
    low, width = np.arange(len(grams)), 1
    while width < span:  # place of the smallest gram of `width` grams, leftmost on ties
        step = min(width, span - width)
        left, right = low[:-step], low[step:]
        low = np.where(grams[right] < grams[left], right, left)
        width += step
    end = words.bounds[1:][T.owners(words.bounds)]
    at = np.flatnonzero(np.arange(len(low)) + WINDOW <= end[: len(low)])
    place = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    return at[heads], np.diff(np.append(heads, len(at))), grams[place[heads]]


def _pack(text_col: str):
    """Chunks of the rows a task reads; ``part`` is the task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        squeeze = zstandard.ZstdCompressor(3).compress
        for i, block in enumerate(T.blocks(batches, text_col, CHUNK_BYTES)):
            words = Words(block.data, block.starts, block.ends)
            _, _, keys = super_kmers(words, words.hashes())
            rest = block.batch.drop_columns([text_col])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as out:
                out.write_batch(rest)
            row = {
                "part": [part],
                "chunk": [(part << 32) + i],
                "n_rows": [len(block)],
                "n_bytes": [len(block.data)],
                "keys": [keys.tobytes()],
                "rest": [squeeze(sink.getvalue().to_pybytes())],
                "sizes": [squeeze((block.ends - block.starts).tobytes())],
                "body": [squeeze(block.data.tobytes())],
            }
            yield pa.RecordBatch.from_pydict(row, schema=_schema(_CHUNK))

    return pack


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
    T.give_back()


def _unpack(row: dict) -> Words:
    grow = zstandard.ZstdDecompressor().decompress
    sizes = np.frombuffer(grow(row["sizes"]), np.int64)
    data = np.frombuffer(grow(row["body"]), np.uint8)
    ends = np.cumsum(sizes)
    return Words(data, ends - sizes, ends)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each minimiser of a chunk."""
    for row in _rows(batches):
        keys, n = np.unique(np.frombuffer(row["keys"], np.uint64), return_counts=True)
        size = len(keys)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.view(np.int64)),
                pa.array(np.full(size, row["part"], np.int32)),
                pa.array(np.full(size, row["chunk"], np.int64)),
                pa.array(n.astype(np.int64)),
            ],
            names=["key", "part", "chunk", "n"],
        )


_PACKED = "key long, part int, chunk long, head int, words binary"
_SINGLE = "one long, two long, part int, chunk long, n long, firsts binary"


def _chosen(row: dict, which: str) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The super-k-mers of a chunk whose minimiser is in the list ``which``."""
    words = _unpack(row)
    hashes = words.hashes()
    heads, sizes, keys = super_kmers(words, hashes)
    want = np.asarray(row[which] or [], np.int64).view(np.uint64)
    pick = np.isin(keys, want)
    return words, hashes, heads[pick], sizes[pick], keys[pick]


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed super-k-mers of the minimisers of usual size."""
    schema = _schema(_PACKED)
    for row in _rows(batches):
        words, _, heads, sizes, keys = _chosen(row, "usual")
        raw = words.data.tobytes()
        a = words.first[heads]
        b = words.last[heads + sizes + WINDOW - 2]
        for i in range(0, len(heads), 5000):
            cut = slice(i, i + 5000)
            packed = [raw[x:y] for x, y in zip(a[cut].tolist(), b[cut].tolist(), strict=True)]
            n = len(packed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[cut].view(np.int64)),
                    pa.array(np.full(n, row["part"], np.int32)),
                    pa.array(np.full(n, row["chunk"], np.int64)),
                    pa.array(heads[cut].astype(np.int32)),
                    pa.array(packed, pa.binary()),
                ],
                schema=schema,
            )


def _send_single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the hot minimisers, one row for each that a chunk has."""
    schema = _schema(_SINGLE)
    for row in _rows(batches):
        _, hashes, heads, sizes, _ = _chosen(row, "hot")
        if len(heads) == 0:
            continue
        at = np.repeat(heads, sizes) + _ramp(sizes)
        one = T.combine([hashes[at + i] for i in range(WINDOW)])
        two = T.combine([hashes[at + i] ^ _SECOND for i in range(WINDOW)])
        order = np.lexsort((at, two, one))
        at, one, two = at[order].astype(np.int32), one[order], two[order]
        new = np.ones(len(at), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        cut = np.append(np.flatnonzero(new), len(at))
        n = len(cut) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(one[new].view(np.int64)),
                pa.array(two[new].view(np.int64)),
                pa.array(np.full(n, row["part"], np.int32)),
                pa.array(np.full(n, row["chunk"], np.int64)),
                pa.array(np.diff(cut)),
                pa.array([at[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
            ],
            schema=schema,
        )


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _runs(strings: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each packed string of one minimiser the runs (first, last) of its
    windows that stand in another place too, as numbers of windows."""
    times = Counter(strings)
    whole = {s: [(0, s.count(b" ") - WINDOW + 1)] for s, n in times.items() if n > 1}
    if len(times) > 1:
        windows = []
        for s in times:
            ends = [i for i, c in enumerate(s) if c == 0x20]
            ends.append(len(s))
            start = 0
            for j in range(len(ends) - WINDOW + 1):
                windows.append((s[start : ends[j + WINDOW - 1]], j, s))
                start = ends[j] + 1
        windows.sort()
        again: dict[bytes, list[int]] = {}
        before = None
        for now in windows:  # equal windows are neighbours
            if before is not None and before[0] == now[0]:
                again.setdefault(before[2], []).append(before[1])
                again.setdefault(now[2], []).append(now[1])
            before = now
        for s, places in again.items():
            if s in whole:
                continue
            out: list[tuple[int, int]] = []
            for j in sorted(set(places)):
                if out and out[-1][1] == j - 1:
                    out[-1] = (out[-1][0], j)
                else:
                    out.append((j, j))
            whole[s] = out
    return [whole.get(s, []) for s in strings]


def _sorted_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by minimiser -> runs of repeated windows by chunk."""
    schema = _schema(_MARK)
    group: list[tuple[int, int, int, bytes]] = []  # the last, unfinished minimiser
    last = None
    found: list[tuple[int, int, int, int]] = []

    def close() -> None:
        if len(group) > 1:
            for (part, chunk, head, _), runs in zip(group, _runs([g[3] for g in group]), strict=True):
                found.extend((part, chunk, head + a, head + b) for a, b in runs)
        group.clear()

    def marks() -> pa.RecordBatch:
        table = np.array(found, np.int64).reshape(-1, 4)
        found.clear()
        table = table[np.argsort(table[:, 1], kind="stable")]
        cut = np.flatnonzero(np.append(True, table[1:, 1] != table[:-1, 1])) if len(table) else np.zeros(0, int)
        end = np.append(cut[1:], len(table))
        firsts, lasts = table[:, 2].astype(np.int32), table[:, 3].astype(np.int32)
        pairs = list(zip(cut, end, strict=True)) if len(table) else []
        return pa.RecordBatch.from_arrays(
            [
                pa.array(table[cut, 0].astype(np.int32)),
                pa.array(table[cut, 1]),
                pa.array([firsts[x:y].tobytes() for x, y in pairs], pa.binary()),
                pa.array([lasts[x:y].tobytes() for x, y in pairs], pa.binary()),
            ],
            schema=schema,
        )

    for batch in batches:
        for key, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != last:
                close()
                last = key
            group.append(tuple(rest))
        if len(found) > 50_000:
            yield marks()
    close()
    if found:
        yield marks()
    T.give_back()


def _cut(schema: pa.Schema):
    """Chunks without the words that repeated windows cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words = _unpack(row)
            n = len(words)
            change = np.zeros(n + 1, np.int64)
            for mark in row["marks"] or []:
                np.add.at(change, np.frombuffer(mark["firsts"], np.int32), 1)
                np.subtract.at(change, np.frombuffer(mark["lasts"], np.int32) + WINDOW, 1)
            gone = np.cumsum(change[:-1]) > 0
            kept = words.data[np.repeat(~gone, words.last - words.first + 1)].tobytes()
            ends = np.append(0, np.cumsum(np.where(gone, 0, words.last - words.first + 1)))[words.bounds]
            lost = np.append(0, np.cumsum(gone))[words.bounds]
            texts = [kept[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            rest = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["rest"])).read_next_batch()
            have = dict(zip(rest.schema.names, rest.columns, strict=True))
            have |= {
                "n_words": pa.array(np.diff(words.bounds).astype(np.int64)),
                "n_removed": pa.array(np.diff(lost).astype(np.int64)),
                "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            }
            if "clean_text" in schema.names:
                have["clean_text"] = pa.array([t.decode() for t in texts], pa.string())
            for at in range(0, row["n_rows"], 1000):
                columns = [have[f.name][at : at + 1000].cast(f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cut


def _least_partitions(spark: SparkSession) -> int:
    """With fewer buckets than this, Spark would shuffle the bucketed side."""
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or shuffle)


def _chunk_table(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """The chunks, written under spark.checkpoint.dir, and their buckets, sized
    by the bytes of text.  The catalogue's entry goes at once: the frame keeps
    the files and their buckets."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    buckets = max(_least_partitions(spark), 1 + total // BUCKET_BYTES)
    if buckets > int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")):
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", str(buckets))
    # joins on (part, chunk) may use that equal parts are in one bucket
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    name = f"kassa_words_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kassa-llm/{name}"
    packed = docs.mapInArrow(_pack(text_col), _CHUNK).write.bucketBy(buckets, "part").option("path", path)
    packed.option("compression", "none").saveAsTable(name)
    chunks = spark.table(name)
    chunks.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return chunks, buckets


def remove_repeated_windows(
    docs: DataFrame, text_col: str = "text", with_text: bool = True, hot: int = HOT
) -> DataFrame:
    """All columns of ``docs`` but the text, then n_words, n_removed (long),
    kept_sha256 (of the kept words joined by one blank, UTF-8) and, if asked for,
    ``clean_text``, these words."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructType

    results = {"n_words": LongType(), "n_removed": LongType(), "kept_sha256": StringType()}
    if with_text:
        results["clean_text"] = StringType()
    source = docs.select(*[c for c in docs.columns if c not in results])
    out = StructType([f for f in source.schema.fields if f.name != text_col])
    for name, kind in results.items():
        out = out.add(name, kind)

    chunks, buckets = _chunk_table(source, text_col)
    counts = chunks.select("part", "chunk", "keys").mapInArrow(_counted, "key long, part int, chunk long, n long")
    total = F.sum("n").over(Window.partitionBy("key"))
    wanted = (
        counts.withColumn("total", total)
        .where("total > 1")
        .repartition(buckets, "part")
        .groupBy("part", "chunk")
        .agg(
            F.collect_list(F.when(F.col("total") <= hot, F.col("key"))).alias("usual"),
            F.collect_list(F.when(F.col("total") > hot, F.col("key"))).alias("hot"),
        )
    )
    lists = chunks.join(wanted.hint("merge"), ["part", "chunk"]).select("part", "chunk", "sizes", "body", "usual", "hot")
    packed = lists.where(F.size("usual") > 0).mapInArrow(_send, _PACKED)
    usual = packed.repartition("key").sortWithinPartitions("key").mapInArrow(_sorted_counts, _MARK)
    single = lists.where(F.size("hot") > 0).mapInArrow(_send_single, _SINGLE)
    total = F.sum("n").over(Window.partitionBy("one", "two"))
    hot_marks = (
        single.withColumn("total", total)
        .where("total > 1")
        .select("part", "chunk", "firsts", F.col("firsts").alias("lasts"))
    )
    marks = (
        usual.unionByName(hot_marks)
        .repartition(buckets, "part")
        .groupBy("part", "chunk")
        .agg(F.collect_list(F.struct("firsts", "lasts")).alias("marks"))
    )
    columns = ["n_rows", "rest", "sizes", "body", "marks"]
    return (
        chunks.join(marks.hint("merge"), ["part", "chunk"], "left").select(*columns).mapInArrow(_cut(to_arrow_schema(out)), out)
    )
