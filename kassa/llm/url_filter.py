"""URL filter: rules first, then words of the host judged by naive Bayes.

Host and path are cut from the url (``host_and_path``).  A rule ``host/path``
fits a host and its subdomains if the path starts with the rule's; the longest
rule wins.  Without a rule the method decides:

* Each part of the host (between dots and other signs) is split into words by a
  unigram Viterbi pass over a dictionary: on how many distinct hosts a
  letters-only token stands in host or path, plus ``SEED_WORDS`` with a share of
  the total.  A part as a whole is a word by its uses elsewhere only: in the path,
  or next to other tokens of a label, of hosts with no label of that name.  A name
  without such uses costs as a new word, by the letter, so its own pages never
  keep it from being split.  Unknown stretches cost more by the letter than any
  word.  Path tokens are taken as they are.
* A multinomial naive Bayes over these words says allow or block.  It is trained
  on the distinct hosts and digit-free paths that a rule decides, leaving out words that the rules themselves
  name (they would only repeat the rules), with ``SEED_WORDS`` as block words that
  weigh ``SEED_WEIGHT`` times what allowed urls say of them.

Dictionary, segments and weights are Spark tables without a limit.  Distinct parts
meet the dictionary rows of their substrings (at most ``LONGEST`` a position) and are
split one by one; weights are summed for distinct hosts and for distinct words of
paths, exactly, as decimals, and joined to the urls.

Null urls and urls without ``://`` have empty host and path and are judged like
any other.  Rows, also repeated ones, are judged one by one; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kassa.llm.store import save

#: Rules as (verdict, host/path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Words of host names that stand for sites to block.
SEED_WORDS = (
    "ads",
    "adult",
    "bet",
    "bets",
    "casino",
    "cheap",
    "escort",
    "farm",
    "gambling",
    "jackpot",
    "pills",
    "poker",
    "porn",
    "sex",
    "slots",
    "spam",
    "viagra",
    "warez",
    "win",
    "xxx",
)
SEED_WEIGHT = 20
SEED_COUNT = 50  # of each seed word in the dictionary, at least
SEED_SHARE = 1000  # and one in so many of all its counts
LONGEST = 24
#: Prior log-odds: the rules' own shares say nothing of the urls beyond them, and
#: a host is blocked only on more than weak evidence.
CAUTION = -0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    then up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def longest_rule(host: Column, path: Column, rules: tuple) -> tuple[Column, Column]:
    """Rule and verdict, both null where no rule fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


class Splitter:
    """Unigram Viterbi segmentation; ``alone``: counts of the words as whole parts,
    where they are not ``counts``; ``total``: that of a dictionary of which
    ``counts`` are a part."""

    def __init__(self, counts: dict[str, int], alone: dict[str, int] | None = None, total: int | None = None):
        self.total = total or sum(counts.values()) + 1
        self.alone = alone
        self.cost = {w: math.log(self.total / n) for w, n in counts.items() if len(w) <= LONGEST}
        self.letter = math.log(self.total) + 2.0  # a letter outside of words

    def whole(self, text: str) -> float:
        """Cost of a known word that is a part of its own."""
        if self.alone is None:
            return self.cost[text]
        uses = self.alone.get(text, 0)
        return math.log(self.total / uses) if uses else math.log(self.total) + len(text) * math.log(26)

    def split(self, text: str) -> list[str]:
        """Words of one part, unknown stretches kept together."""
        best = [0.0]
        back = [0]
        for j in range(1, len(text) + 1):
            cost, start = best[j - 1] + self.letter, j - 1
            for i in range(max(0, j - LONGEST), j):
                own = self.cost.get(text[i:j])
                if own is not None and j - i == len(text):
                    own = self.whole(text)
                if own is not None and best[i] + own < cost:
                    cost, start = best[i] + own, i
            best.append(cost)
            back.append(start)
        words: list[str] = []
        j = len(text)
        loose = False
        while j > 0:
            piece = text[back[j] : j]
            known = piece in self.cost
            if not known and loose:
                words[-1] = piece + words[-1]
            else:
                words.append(piece)
            loose = not known
            j = back[j]
        words.reverse()
        return words


def _pieces(batches):
    """Distinct substrings of each part, none longer than ``LONGEST``."""
    for batch in batches:
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = len(text)
            own = {text[i:j] for i in range(n) for j in range(i + 1, min(n, i + LONGEST) + 1)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(own), pa.int64()), pa.array(list(own), pa.string())], names=["id", "word"]
            )


def _split(total: int):
    def split(batches):
        for batch in batches:
            texts, known = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for text, rows in zip(texts, known, strict=True):
                rows = rows or []
                counts, alone = {x["word"]: x["n"] for x in rows}, {x["word"]: x["alone"] for x in rows}
                out.append(Splitter(counts, alone, total).split(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["part", "words"])

    return split


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), 1)


def word_counts(urls: DataFrame) -> DataFrame:
    """word, n, alone: distinct hosts that use a word, and those of them that use
    it in the path or next to other tokens of a label and have no label of that name."""
    labels = urls.select("host").distinct().select("host", F.explode(F.split("host", "[.]")).alias("label"))
    labels = labels.select("host", _tokens(F.col("label")).alias("own"))
    named = labels.select("host", F.explode("own").alias("word"), (F.size("own") == 1).alias("named"))
    paths = urls.select("host", F.explode(_tokens(F.lower("path"))).alias("word"), F.lit(False).alias("named"))
    uses = named.union(paths).groupBy("host", "word").agg(F.max("named").alias("named"))
    return uses.groupBy("word").agg(F.count("*").alias("n"), F.sum((~F.col("named")).cast("long")).alias("alone"))


def _seeds(spark: SparkSession, x: int, y: int) -> DataFrame:
    rows = [(w, x, y) for w in SEED_WORDS]
    return spark.createDataFrame(rows, "word string, x long, y long")


def host_words(urls: DataFrame) -> DataFrame:
    """host, word, times: the words that the parts of each distinct host are split into."""
    counts = save(word_counts(urls), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    seeds = max(SEED_COUNT, total // SEED_SHARE)
    total += seeds * len(SEED_WORDS) + 1
    words = counts.union(_seeds(urls.sparkSession, seeds, seeds)).where(F.length("word") <= LONGEST)
    words = words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("alone").alias("alone"))
    hosts = urls.select("host").distinct().select("host", F.explode(_tokens(F.col("host"))).alias("part"))
    hosts = save(hosts, "parts")
    parts = hosts.select("part").distinct().select(F.monotonically_increasing_id().alias("id"), "part")
    parts = save(parts, "ids")  # written once, so that the numbers hold
    known = parts.mapInArrow(_pieces, "id long, word string").join(words, "word")
    known = known.groupBy("id").agg(F.collect_list(F.struct("word", "n", "alone")).alias("known"))
    split = parts.join(known, "id", "left").select("part", "known")
    split = save(split.mapInArrow(_split(total), "part string, words array<string>"), "split")
    out = hosts.join(split, "part").select("host", F.explode("words").alias("word"))
    return out.groupBy("host", "word").agg(F.count("*").alias("times"))


def word_weights(urls: DataFrame, words: DataFrame, rules: tuple = RULES) -> DataFrame:
    """word, weight (positive: block) from ``urls(host, path, verdict)`` and
    ``words(host, word, times)``."""
    # many pages of one host say no more than one
    plain = F.regexp_replace("path", r"\d+", "").alias("path")
    labelled = save(urls.where("verdict IS NOT NULL").select("host", plain, "verdict").distinct(), "labelled")
    is_block = F.when(F.col("verdict") == "block", 1).otherwise(0)
    sums = (F.sum(is_block).alias("block"), F.sum(1 - is_block).alias("allow"))
    of_hosts = labelled.groupBy("host").agg(*sums).join(words, "host")
    of_hosts = of_hosts.select("word", *[(F.col("times") * F.col(c)).alias(c) for c in ("block", "allow")])
    of_paths = labelled.select(F.explode(_tokens(F.lower("path"))).alias("word"), "verdict").groupBy("word").agg(*sums)
    named = sorted({w for _, text in rules for w in re.findall(r"[^\W\d_]+", text)})
    every = of_hosts.union(of_paths).where(~F.col("word").isin(named)).union(_seeds(urls.sparkSession, 0, 0))
    every = every.groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    seeded = F.col("block") + SEED_WEIGHT * (F.col("allow") + 1)
    block = F.when(F.col("word").isin(list(SEED_WORDS)), seeded).otherwise(F.col("block"))
    every = save(every.select("word", block.alias("block"), "allow"), "sums")
    n_bad, n_good = every.agg(F.sum("block") + F.count("*"), F.sum("allow") + F.count("*")).first()
    weight = F.log((F.col("block") + 1) / n_bad) - F.log((F.col("allow") + 1) / n_good)
    return save(every.select("word", weight.cast("decimal(18,12)").alias("weight")), "weights")


def _scores(rows: DataFrame, weights: DataFrame, key: str, name: str) -> DataFrame:
    """Sum of the weights of the words of each key, from ``rows(key, word, times)``."""
    total = F.sum(F.col("weight") * F.col("times")).alias(name)
    return save(rows.join(weights, "word").groupBy(key).agg(total), name)


def filter_urls(pages: DataFrame, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (``allow`` or ``block``), score."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    urls = save(urls.select("*", rule.alias("rule"), verdict.alias("ruled")), "urls")
    words = save(host_words(urls), "host_words")
    weights = word_weights(urls.select("host", "path", F.col("ruled").alias("verdict")), words, rules)
    said = F.array_join(_tokens(F.lower("path")), " ")
    paths = urls.select(said.alias("said")).distinct()
    # a number stands for the words of a path, which may be long, where each is a row
    paths = save(paths.select(F.monotonically_increasing_id().alias("id"), "said"), "paths")
    each = paths.select("id", F.explode(F.split("said", " ")).alias("word")).groupBy("id", "word")
    of_hosts = _scores(words, weights, "host", "of_host")
    of_paths = _scores(each.agg(F.count("*").alias("times")), weights, "id", "of_path")
    of_paths = save(paths.join(of_paths, "id").select("said", "of_path"), "said")
    out = urls.withColumn("said", said).join(of_hosts, "host", "left").join(of_paths, "said", "left")
    zero = F.lit(0)
    score = F.lit(CAUTION) + (F.coalesce("of_host", zero) + F.coalesce("of_path", zero)).cast("double")
    out = out.withColumn("score", score)
    verdict = F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
