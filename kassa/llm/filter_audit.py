"""What five filters remove alone, together and in every order.

The filters look at whole texts (null: empty; words: ``[^\\x20\\x09-\\x0D]+``):

* A: under 50 words
* B: 100 * distinct words < 65 * words
* C: 100 * ``[A-Z]`` characters > 5 * code points
* D: holds any of ``#$%&*|``
* E: the same text as a smaller doc_id's, table-wide, removed or not

1. One pass gives each row its bits A to D and the hash of its text; this narrow
   table is written once.
2. E is an existential self-join: a row fails if a row with the same hash, the
   same text and a smaller doc_id exists (left-semi).  Only hashes that two rows
   have take part; the right side has one row a text, the smallest doc_id, and is
   repeated once for every ``SPREAD`` rows of the hash, over which the left side
   is dealt, so a text that a third of all rows hold meets itself in many tasks.
3. The failures' ids of E are put beside those of A to D and the bits of an id
   combined; then one count for each (part, bits, labels) remains.
4. All 120 orders are read off these counts: a filter removes, at its step, what
   has its bit and none before it.  Over all orders a filter is the first of c
   failed ones in 120 / c of them, which gives its Shapley sum.

The result has a row for each part (the source; null: empty string), order and
step, zeros included.  A row without doc_id is never E and has no labels; rows
with one doc_id are no copies of each other and each counts; a doc_id with
several label rows is good or toxic if one of them says so; an empty table has no
parts.  Only the named columns of the inputs are read, so others cannot clash.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.llm.store import save

FILTERS = "ABCDE"
#: Rows of one text that are compared with one copy of its smallest doc_id.
SPREAD = 2000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def _sum_bits(**failed: Column) -> Column:
    total = F.lit(0)
    for name, condition in failed.items():
        total = total + F.when(condition, _bit(name)).otherwise(0)
    return total.cast("int")


def _texts(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.xxhash64(text).alias("hash"),
    )


def own_failures(texts: DataFrame) -> DataFrame:
    """(id, part, hash, bits): what a text fails by itself, A to D."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    seen = texts.select(
        "id",
        "part",
        "hash",
        F.length("text").alias("chars"),
        (F.length("text") - F.length(F.translate("text", UPPER, ""))).alias("capitals"),
        (F.length(F.translate("text", "#$%&*|", "")) < F.length("text")).alias("signs"),
        words.alias("words"),
    ).select("*", F.size("words").alias("n"), F.size(F.array_distinct("words")).alias("kinds"))
    return seen.select(
        "id",
        "part",
        "hash",
        _sum_bits(
            A=F.col("n") < 50,
            B=F.lit(100).cast("long") * F.col("kinds") < F.lit(65).cast("long") * F.col("n"),
            C=F.lit(100).cast("long") * F.col("capitals") > F.lit(5).cast("long") * F.col("chars"),
            D=F.col("signs"),
        ).alias("bits"),
    )


def copies(texts: DataFrame, rows: DataFrame, spread: int = SPREAD) -> DataFrame:
    """(id, part, hash) of the rows whose text a smaller id has.  ``rows`` is the
    narrow table of the same rows; what one hash's rows cost is proportional to
    their number."""
    several = rows.where("id is not null").groupBy("hash").agg(F.count("*").alias("rows")).where("rows > 1")
    # written: the aggregate below keeps the join from being dealt anew if a hash is hot;
    # the same join at every size, so what is shuffled is in proportion to the texts
    shared = save(texts.where("id is not null").join(several.hint("merge"), "hash"), "audit-shared")
    salts = F.ceil(F.col("rows") / spread).cast("int")
    left = shared.withColumn("salt", F.pmod(F.xxhash64("id"), salts).cast("int"))
    right = (
        shared.groupBy("hash", "text", "rows")
        .agg(F.min("id").alias("first"))
        .select("hash", "text", "first", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    )
    a, b = left.alias("a"), right.alias("b")
    same = (F.col("a.hash") == F.col("b.hash")) & (F.col("a.salt") == F.col("b.salt"))
    same = same & (F.col("a.text") == F.col("b.text")) & (F.col("b.first") < F.col("a.id"))
    return a.join(b, same, "left_semi").select("id", "part", "hash")


def combinations(rows: DataFrame, copied: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, bits, good, toxic, n): the rows with each combination of failures."""
    every = rows.select("id", "part", "hash", "bits", F.lit(1).alias("n")).unionByName(
        copied.select("id", "part", "hash", F.lit(_bit("E")).alias("bits"), F.lit(0).alias("n"))
    )
    by_id = every.groupBy("part", "id", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # rows without id: one for each (part, text), put past the join, which would gather them
    nobody = by_id.where("id is null").select("part", "bits", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n")
    known = by_id.where("id is not null").join(marked, "id", "left").select(
        "part",
        "bits",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
        "n",
    )
    return known.unionByName(nobody).groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n"))


def every_order(combined: DataFrame) -> DataFrame:
    """(part, filter_order, step, counts...) from the counts of combinations."""
    # one row for each part, with its at most 128 counts, then its 600 steps
    parts = combined.groupBy("part").agg(F.collect_list(F.struct("bits", "good", "toxic", "n")).alias("counts"))
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(FILTERS))), ",")
    rows = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(5))))
    place = {name: F.instr("filter_order", name) for name in FILTERS}
    rows = rows.select(
        "*",
        _sum_bits(**{name: at == F.col("step") for name, at in place.items()}).alias("bit"),
        _sum_bits(**{name: at < F.col("step") for name, at in place.items()}).alias("before"),
    )

    def total(test, of=lambda c: c["n"]) -> Column:
        return F.aggregate(
            "counts", F.lit(0).cast("long"), lambda acc, c: acc + F.when(test(c), of(c)).otherwise(F.lit(0).cast("long"))
        )

    bit, before = F.col("bit"), F.col("before")
    fails = lambda c: c["bits"].bitwiseAND(bit) != 0
    free = lambda c: c["bits"].bitwiseAND(before) == 0
    n_orders = F.lit(120).cast("long")
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: c["bits"].bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(lambda c: fails(c) & free(c)).alias("removed"),
        total(lambda c: fails(c) & ~free(c)).alias("redundant"),
        total(lambda c: c["bits"] == bit).alias("unique_fails"),
        total(lambda c: fails(c) & free(c) & c["good"]).alias("good_lost"),
        total(lambda c: fails(c) & free(c) & c["toxic"]).alias("toxic_lost"),
        total(fails, lambda c: (c["n"] * n_orders / F.bit_count(c["bits"])).cast("long")).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    spread: int = SPREAD,
) -> DataFrame:
    """The audit of ``docs``; ``labels`` has ``id_col``, quality and toxic."""
    texts = _texts(docs, id_col, text_col, part_col)
    rows = save(own_failures(texts), "audit-rows")
    return every_order(combinations(rows, copies(texts, rows, spread), labels, id_col))
