"""Line-first cleaning: rules judge lines, then documents that lose too much go.

Words are ``[^\\x20\\x09-\\x0D]+``; lines are cut at ``\\n``.  A line ends like a sentence
if one of ``ENDS`` is last, closing quotes and brackets aside.  A line with a word fails if

* it equals an earlier line of the text (``repeated``),
* it holds one of ``BOILERPLATE``, A-Z lower-cased (``boilerplate``),
* it does not end like a sentence and a quarter of its words or more, two at least,
  are separators like ``|`` or ``/``, or half of its words or more are words of
  menus (``navigation``),
* its characters of ``[#*$%&|<>]`` are a tenth of its words or more, and it does not
  end like a sentence or they are a third of its words or more (``symbols``): a per
  cent sign or an ampersand does not cost a sentence,
* or it does not end like a sentence and has fewer than ``SHORT_LINE`` words
  (``punctuation``).

Failed lines and lines without a word are removed.  A document is rejected if
it has fewer than ``MIN_WORDS`` words, if over half of its words stand in 3-word
windows that occur twice or more, or if failed lines hold over half of its words.

Null text is empty text: no words, rejected.  Rows, also repeated ones, are
judged one by one; an empty table gives an empty result; input columns named
like a result column are replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructType

from kassa.llm import text as T

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_LOST_PERCENT = 50
SHORT_LINE = 4
SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset("| > < >> << / // · • » « › ‹ → ←".encode().split())
MENU = frozenset(
    b"home about contact login logout register search news blog products services shop cart checkout account help"
    b" support faq sitemap careers press privacy terms imprint menu next previous back more share print rss".split()
)
BOILERPLATE = (
    b"all rights reserved",
    b"cookie policy",
    b"enable javascript",
    b"privacy policy",
    b"terms of service",
    b"subscribe to our newsletter",
    b"click here to",
    b"log in to",
    b"sign up for",
)
ENDS = (b".", b"!", b"?", b"\xe2\x80\xa6", b":", b";")
CLOSERS = b"\"')]}"

_RESULT = {
    "n_words": LongType(),
    "word_chars": LongType(),
    "n_symbols": LongType(),
    "n_dup_lines": LongType(),
    "n_repeat_words": LongType(),
    "n_lost_words": LongType(),
    "base_failed": BooleanType(),
    "kept": BooleanType(),
    "clean_text": StringType(),
}


def line_fails(line: bytes, n_words: int) -> bool:
    """The rules that need only the line itself."""
    folded = line.lower()
    if any(phrase in folded for phrase in BOILERPLATE):
        return True
    n_symbols = len(line) - len(line.translate(None, SYMBOLS))
    if line.rstrip().rstrip(CLOSERS).endswith(ENDS):
        return n_symbols > 0 and 3 * n_symbols >= n_words
    if n_words < SHORT_LINE or (n_symbols > 0 and 10 * n_symbols >= n_words):
        return True
    words = folded.split()
    separators = sum(word in SEPARATORS for word in words)
    return (separators > 1 and 4 * separators >= n_words) or 2 * sum(word in MENU for word in words) >= n_words


def _repeated_words(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each document inside 3-word windows that it has twice or more."""
    owner = T.owners(bounds)
    if len(words) < 3:
        return np.zeros(len(bounds) - 1, np.int64)
    at = np.flatnonzero(owner[2:] == owner[:-2])
    windows = T.combine([owner[at].astype(np.uint64), words[at], words[at + 1], words[at + 2]])
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    covered = np.zeros(len(words), bool)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
        hit = at[twice[place] == windows]
        for k in range(3):
            covered[hit + k] = True
    sums = np.append(0, np.cumsum(covered))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _judge(schema: pa.Schema, text_col: str):
    symbols = T.byte_class(SYMBOLS)

    def judge(batches):
        for block in T.blocks(batches, text_col):
            data, starts, ends = block.data, block.starts, block.ends
            first, last, bounds = T.word_spans(data, starts, ends, T.NOT_SPACE)
            n_words = np.diff(bounds)
            repeated = _repeated_words(T.word_hashes(data, first, last), bounds)
            points = np.append(0, np.cumsum(T.NOT_SPACE[data] & ((data & 0xC0) != 0x80)))
            signs = np.append(0, np.cumsum(symbols[data]))
            failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
            dup, lost, clean = [], [], []
            for i in range(len(block)):
                seen: set[bytes] = set()
                n_dup = n_lost = 0
                good = []
                for line in block.text(i).split(b"\n"):
                    n = len(line.split())
                    if not n:
                        continue
                    if line in seen:
                        n_dup += 1
                        n_lost += n
                        continue
                    seen.add(line)
                    if line_fails(line, n):
                        n_lost += n
                    else:
                        good.append(line)
                dup.append(n_dup)
                lost.append(n_lost)
                clean.append(b"\n".join(good).decode("utf-8", "replace"))
            lost_words = np.array(lost, np.int64)
            extra = {
                "n_words": n_words,
                "word_chars": points[ends] - points[starts],
                "n_symbols": signs[ends] - signs[starts],
                "n_dup_lines": dup,
                "n_repeat_words": repeated,
                "n_lost_words": lost_words,
                "base_failed": failed,
                "kept": ~failed & (100 * lost_words <= MAX_LOST_PERCENT * n_words),
                "clean_text": clean,
            }
            table = dict(zip(block.batch.schema.names, block.batch.columns, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(extra[f.name], f.type) if f.name in extra else table[f.name].cast(f.type) for f in schema],
                schema=schema,
            )

    return judge


def judge_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and those of ``_RESULT``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = docs.select(*[c for c in docs.columns if c not in _RESULT])
    out = StructType(list(source.schema.fields))
    for name, kind in _RESULT.items():
        out = out.add(name, kind)
    return source.mapInArrow(_judge(to_arrow_schema(out), text_col), out)


def clean_documents(docs: DataFrame) -> DataFrame:
    """Documents that pass, without their failed lines; ``n_chars`` follows."""
    done = judge_lines(docs).where("kept").withColumn("text", F.col("clean_text"))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)
