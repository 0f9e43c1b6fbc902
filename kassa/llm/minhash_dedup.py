"""MinHash near-duplicates with tensored tables, links confirmed on full sets.

A document's set: its distinct shingles of ``width`` words (words
``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); fewer words: the whole sequence as one
shingle; no words or null text: the empty set, linked with nothing.

Documents are linked from a Jaccard similarity of ``percent`` hundredths on.  The
registered query takes ``SHINGLE`` words and ``PERCENT``; callers may name others.

Two collections of H small keys each (``ROWS`` minima a key) are drawn from
``2 * H * ROWS`` hash functions; a table key is a pair of one key of either
collection.  ``H ** 2`` tables of ``2 * ROWS`` minima thus cost 72 minima instead of
864 for 12 keys.  A pair at the limit s misses all tables with probability
2 * (1 - s ** 3) ** H, and closer pairs with less; ``keys_a_side`` takes the least
H that keeps it at ``MISS`` or below: 12 at 0.85, 16 at 0.8.

Documents with equal sets form one class, so copies cost one row each; a class has
a number of its own, and a doc_id that occurs with different sets links its classes.
Within
a table key every class is compared, on full shingle sets, with the key's centre,
the class that shares most keys.  That comparison leaves the differences from the
centre.  Classes of one centre that are then in different components are compared
with each other from these differences, in blocks of at most about ``BLOCK`` sets
and ``CELLS`` shingles against such blocks, so no link between different sets is
skipped, and only links leave a task.

Rows: one per input row.  Rows with one doc_id get one component; a row with a null
doc_id is linked with nothing: component_id null, ``kept`` true.  Other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm import text as T
from kassa.llm.components import components
from kassa.llm.store import save

SHINGLE = 3
PERCENT = 85
ROWS = 3
MISS = 2.2e-5
BLOCK = 512
CELLS = 1 << 23


def keys_a_side(percent: int) -> int:
    """Keys in each of the two collections for a limit of ``percent``."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be 1 to 100: {percent}")
    apart = 1 - (percent / 100) ** ROWS
    return max(1, math.ceil(math.log(MISS / 2) / math.log(apart))) if apart > 0 else 1


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and salts of the first ``n`` hash functions."""
    steps = np.arange(n, dtype=np.uint64)
    return T.mix(steps + np.uint64(1001)) | np.uint64(1), T.mix(steps + np.uint64(5001))


def shingle_sets(block: T.Block, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document, and bounds (n + 1)."""
    data = T.lower(block.data)
    first, last, bounds = T.word_spans(data, block.starts, block.ends, T.NOT_SPACE)
    words = T.word_hashes(data, first, last)
    owner = T.owners(bounds)
    at = np.flatnonzero(owner[width - 1 :] == owner[: len(owner) - width + 1]) if len(words) >= width else np.zeros(0, int)
    hashes = T.combine([words[at + k] for k in range(width)]) if len(at) else np.zeros(0, np.uint64)
    doc = owner[at]
    for d in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < width)):
        own = words[bounds[d] : bounds[d + 1]]
        hashes = np.append(hashes, T.combine([own[k : k + 1] for k in range(len(own))]))
        doc = np.append(doc, d)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, np.searchsorted(doc, np.arange(len(block) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _sketch(width: int, n_hashes: int):
    mult, salt = _functions(n_hashes)

    def sketch(batches):
        for block in T.blocks(batches):
            hashes, bounds = shingle_sets(block, width)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            minima = np.zeros((len(block), n_hashes), np.int32)
            if len(some):
                # only starts of non-empty sets: reduceat then ends each at the next start
                at = bounds[:-1][some]
                for k in range(n_hashes):
                    low = np.minimum.reduceat((hashes ^ salt[k]) * mult[k], at)
                    minima[some, k] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column(0).cast(pa.int64()),
                    pa.array(sizes.astype(np.int64)),
                    *_digests(hashes, bounds),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(block) + 1, dtype=np.int32) * n_hashes), pa.array(minima.ravel())
                    ),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "minima"],
            )

    return sketch


_SKETCH = "doc_id long, n_shingles long, d1 long, d2 long, minima array<int>"


def _digests(hashes: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """Two sums that tell sets apart."""
    return [pa.array(_sums(T.mix(h), bounds).view(np.int64)) for h in (hashes, hashes ^ np.uint64(0xABCDEF12345))]


def _squeeze(width: int):
    """Texts of candidates with their sets' digests, compressed: they travel once
    or twice more."""

    def squeeze(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for block in T.blocks(batches):
            packed = [pack.compress(block.text(i)) for i in range(len(block))]
            yield pa.RecordBatch.from_arrays(
                [block.batch.column(0), *_digests(*shingle_sets(block, width)), pa.array(packed, pa.binary())],
                names=["rep", "d1", "d2", "packed"],
            )

    return squeeze


def _compare(width: int, percent: int):
    """Rows (a, b, packed texts of both) -> how ``b``'s set differs from ``a``'s:
    which of a's sorted shingles it lacks (bits) and which it adds."""

    def compare(batches):
        unpack = zstandard.ZstdDecompressor()

        def own(packed: bytes) -> np.ndarray:
            data = np.frombuffer(unpack.decompress(packed), np.uint8)
            ends = np.array([len(data)])
            return shingle_sets(T.Block(None, data, np.zeros(1, int), ends), width)[0]

        centre, held = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            for i in range(len(a)):
                if centre != a[i]:
                    centre, held = a[i], own(batch.column(2)[i].as_py())
                other = own(batch.column(3)[i].as_py())
                there = other[np.minimum(np.searchsorted(other, held), len(other) - 1)] == held
                both = int(np.count_nonzero(there))
                new = held[np.minimum(np.searchsorted(held, other), len(held) - 1)] != other
                linked = 100 * both >= percent * (len(held) + len(other) - both)
                rows.append((linked, len(held), len(other), np.packbits(~there).tobytes(), other[new].tobytes()))
            columns = list(zip(*rows, strict=True)) or [[], [], [], [], []]
            kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["a", "b", "linked", "n_a", "n_b", "gone", "added"],
            )

    return compare


_COMPARED = "a long, b long, linked boolean, n_a long, n_b long, gone binary, added binary"


def _shared_additions(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every pair of an array of ``x`` and one of ``y``."""
    out = np.zeros((len(x), len(y)), np.float32)
    hx, hy = np.concatenate(x), np.concatenate(y)
    rx = np.repeat(np.arange(len(x)), [len(v) for v in x])
    ry = np.repeat(np.arange(len(y)), [len(v) for v in y])
    common = np.intersect1d(hx, hy)
    for at in range(0, len(common), 4096):
        part = common[at : at + 4096]
        sides = []
        for hashes, row, n in ((hx, rx, len(x)), (hy, ry, len(y))):
            place = np.minimum(np.searchsorted(part, hashes), len(part) - 1)
            good = part[place] == hashes
            side = np.zeros((n, len(part)), np.float32)
            side[row[good], place[good]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _cross(percent: int):
    """Rows of two blocks of sets that were compared with one centre -> links
    between them.  With R what a set lacks of the centre and A what it adds, two
    sets have n - |R1| - |R2| + |R1 & R2| + |A1 & A2| shingles in common."""

    def cross(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                sides = []
                for k in (0, 1):
                    rows = batch.column(k)[i].as_py()
                    n = rows[0]["n_a"]
                    gone = np.stack([np.unpackbits(np.frombuffer(r["gone"], np.uint8), count=n) for r in rows])
                    sides.append(
                        (
                            np.array([r["b"] for r in rows], np.int64),
                            np.array([r["component"] for r in rows], np.int64),
                            np.array([r["n_b"] for r in rows], np.float64),
                            gone.astype(np.float32),
                            [np.frombuffer(r["added"], np.uint64) for r in rows],
                        )
                    )
                (b1, c1, n1, g1, a1), (b2, c2, n2, g2, a2) = sides
                both = n - g1.sum(axis=1)[:, None] - g2.sum(axis=1)[None, :] + g1 @ g2.T + _shared_additions(a1, a2)
                linked = (100 * both >= percent * (n1[:, None] + n2[None, :] - both)) & (c1[:, None] != c2[None, :])
                x, y = np.nonzero(linked)
                # one link for each pair of components is enough
                _, once = np.unique(np.stack([c1[x], c2[y]], axis=1), axis=0, return_index=True)
                x, y = x[once], y[once]
                yield pa.RecordBatch.from_arrays([pa.array(b1[x]), pa.array(b2[y])], names=["a", "b"])

    return cross


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    n_halves = keys_a_side(percent)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketch = save(source.mapInArrow(_sketch(width, 2 * n_halves * ROWS), _SKETCH), "sketch")
    alike = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = save(
        alike.groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.min_by("minima", "doc_id").alias("minima"))
        .withColumn("cls", F.monotonically_increasing_id()),  # fixed once written
        "classes",
    )
    halves = classes.select(
        "cls",
        F.posexplode(
            F.array(
                *[
                    F.xxhash64(F.lit(k), *[F.col("minima")[k * ROWS + r] for r in range(ROWS)])
                    for k in range(2 * n_halves)
                ]
            )
        ).alias("k", "half"),
    )
    # a half that no other class has cannot be part of a shared table key
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1")
    own = (
        halves.join(shared, "half")
        .groupBy("cls")
        .agg(
            F.collect_list(F.when(F.col("k") < n_halves, F.col("half"))).alias("left"),
            F.collect_list(F.when(F.col("k") >= n_halves, F.col("half"))).alias("right"),
            F.sum("n").alias("company"),
        )
    )
    keys = save(
        own.select("cls", "company", "right", F.explode("left").alias("l"))
        .select("cls", "company", "l", F.explode("right").alias("r"))
        .select(F.xxhash64("l", "r").alias("key"), "cls", "company"),
        "keys",
    )
    # a key's centre is the class with the most company: most like the others
    best = F.max(F.struct("company", (-F.col("cls")).alias("minus")))
    centres = keys.groupBy("key").agg(best.alias("best"), F.count("*").alias("n")).where("n > 1")
    centres = centres.select("key", (-F.col("best.minus")).alias("a"))
    star = save(
        keys.join(centres, "key").where("cls <> a").select("a", F.col("cls").alias("b")).distinct(), "star"
    )
    asked = star.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    asked = save(classes.select("cls", "rep", "d1", "d2").join(asked, "cls", "left_semi"), "asked")
    ids = asked.select(F.col("rep").alias("id")).distinct()
    # the same joins at every size: these ids are not broadcast where they happen to be few
    texts = source.join(ids.hint("merge"), "id", "left_semi")
    texts = texts.mapInArrow(_squeeze(width), "rep long, d1 long, d2 long, packed binary")
    one = ["rep", "d1", "d2"]  # repeated rows, and other texts of a doc_id
    texts = texts.dropDuplicates(one).join(asked.hint("merge"), one).select("cls", "packed")
    texts = save(texts, "texts")
    rows = star.join(texts.toDF("b", "pb"), "b").join(texts.toDF("a", "pa"), "a")
    compared = save(rows.select("a", "b", "pa", "pb").mapInArrow(_compare(width, percent), _COMPARED), "compared")
    groups = components(compared.where("linked").select("a", "b"))

    # sets compared with one centre, but not in one component: compared with each other
    part = groups.withColumnRenamed("component", "part")
    near = compared.join(part.withColumnRenamed("node", "b"), "b", "left")
    near = near.withColumn("component", F.coalesce("part", "b")).drop("part")
    home = compared.select("a").distinct().join(part.withColumnRenamed("node", "a"), "a", "left")
    home = home.select("a", F.coalesce("part", "a").alias("home"))
    spread = near.groupBy("a").agg(
        F.count("*").alias("n"),
        F.max("n_a").alias("width"),
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("n") * F.col("width") / CELLS))
    mixed = spread.where("lo < hi").join(home, "a").select("a", "home", blocks.alias("blocks"))
    mixed = save(mixed, "mixed")  # so that the next join, with its hot centres, can be split
    near = near.join(mixed, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")))
    near = near.repartition("a", "block")  # a large group's blocks go to many tasks
    member = F.struct("b", "component", "n_a", "n_b", "gone", "added")
    every = near.groupBy("a", "block").agg(F.collect_list(member).alias("y"))
    apart = near.where("component <> home").groupBy("a", "block", "blocks").agg(F.collect_list(member).alias("x"))
    apart = apart.select("a", "x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    more = apart.join(every, ["a", "block"]).select("x", "y").mapInArrow(_cross(percent), "a long, b long")
    # a doc_id that has several sets links their classes
    spans = alike.groupBy("doc_id").agg(*[f(c).alias(f"{n}_{c}") for c in ("d1", "d2") for n, f in (("lo", F.min), ("hi", F.max))])
    several = spans.where("lo_d1 < hi_d1 OR lo_d2 < hi_d2").select("doc_id")
    several = alike.select("doc_id", "d1", "d2").join(several, "doc_id", "left_semi").distinct()
    several = save(several.join(classes.select("d1", "d2", "cls"), ["d1", "d2"]).select("doc_id", "cls"), "several")
    first = several.groupBy("doc_id").agg(F.min("cls").alias("a"))
    same = several.join(first, "doc_id").where("a < cls").select("a", F.col("cls").alias("b"))
    links = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = components(links.union(more).union(same))

    labels = classes.select("d1", "d2", "rep", "cls").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    labels = labels.withColumn("component", F.coalesce("component", "cls"))
    least = labels.groupBy("component").agg(F.min("rep").alias("label"))
    labels = labels.select("d1", "d2", "component").join(least, "component").drop("component")
    out = sketch.drop("minima").join(labels, ["d1", "d2"], "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows of a component other than its smallest doc_id;
    of repeated rows with that doc_id all stay, as they share it; so do rows with a
    null doc_id."""
    kept = near_duplicates(docs, width=width, percent=percent).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi").select(*docs.columns)
