"""Benchmark decontamination with a generalised suffix automaton over words.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A window is
``WINDOW`` consecutive words of an item; an item of fewer words, but not none,
is one window.  The automaton holds all word sequences of all items; a document
streams through it, and the longest match that ends at each word tells which
windows end there.  Only stretches whose neighbouring words all occur together
in some item are streamed, so a clean document costs a few array passes.

The items are a stated query set: they are collected and broadcast, after a
check of their size against ``max_item_bytes``; every document is read whole.

Null text has no words.  Items without words match nothing; items that share an
item_id count once.  Rows, also repeated ones, are judged one by one; an empty
table gives an empty result; no items leave every document clean.  Input columns
named like a result column are replaced by it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructType

from kassa.llm import text as T

WINDOW = 10
MAX_ITEM_BYTES = 64 << 20
MAX_COVERAGE_PERCENT = 50


class Automaton:
    """Suffix automaton of several word sequences, with the items of each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        texts = []
        for item, words in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if codes:
                texts.append((item, codes))
                last = 0
                for code in codes:
                    last = self._extend(last, code)
        self.items: list[list[str]] = [[] for _ in self.next]
        self.short: list[list[tuple[int, str]]] = [[] for _ in self.next]
        pairs = set()
        for item, codes in texts:
            pairs.update(zip(codes, codes[1:], strict=False))
            self._mark(item, codes)
        self._inherit_short()
        self.least = min([window, *(len(codes) for _, codes in texts)], default=window)
        size = max(len(self.vocabulary), 1)
        self.pairs = np.unique(np.array([a * size + b for a, b in pairs], np.int64))
        words = list(self.vocabulary)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        hashes = T.word_hashes(raw, np.append(0, ends[:-1]), ends) if words else np.zeros(0, np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def _extend(self, last: int, code: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if code in nxt[last]:
            old = nxt[last][code]
            return old if length[old] == length[last] + 1 else self._split(last, code, old)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in nxt[at]:
            nxt[at][code] = new
            at = link[at]
        if at >= 0:
            old = nxt[at][code]
            link[new] = old if length[old] == length[at] + 1 else self._split(at, code, old)
        return new

    def _split(self, at: int, code: int, old: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[old]))
        self.link.append(self.link[old])
        self.length.append(self.length[at] + 1)
        self.link[old] = copy
        while at >= 0 and self.next[at].get(code) == old:
            self.next[at][code] = copy
            at = self.link[at]
        return copy

    def _mark(self, item: str, codes: list[int]) -> None:
        state = 0
        for code in codes:
            state = self.next[state][code]
            at = state
            while at > 0 and self.length[at] >= self.window:
                if self.items[at] and self.items[at][-1] == item:
                    break
                self.items[at].append(item)
                at = self.link[at]
        if len(codes) < self.window:
            self.short[state].append((len(codes), item))

    def _inherit_short(self) -> None:
        """A state also ends the short items of the states on its link path."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            if up > 0 and self.short[up]:
                self.short[state] = self.short[up] + self.short[state]

    def stream(self, codes: list[int]):
        """Yields (end, n, items): the last n words up to ``end`` are a window."""
        state = size = 0
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for i, code in enumerate(codes):
            while state and code not in nxt[state]:
                state = link[state]
                size = length[state]
            to = nxt[state].get(code)
            if to is None:
                continue
            state = to
            size += 1
            if size >= window:
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                yield i + 1, window, self.items[at]
            for n, item in self.short[state]:
                if n <= size:
                    yield i + 1, n, [item]

    def stretches(self, hashes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
        """Maximal runs of words (from, to) that might hold a window."""
        if not len(self.hashes) or not len(hashes):
            return []
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        code = np.where(known, self.order[at], -1)
        joined = np.zeros(len(code), bool)  # with the word before
        if len(self.pairs):
            key = code[:-1] * len(self.vocabulary) + code[1:]
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[1:] = (self.pairs[place] == key) & known[:-1] & known[1:] & (owner[1:] == owner[:-1])
        head = np.flatnonzero(known & ~joined)
        after = np.append(joined[1:], False)
        tail = np.flatnonzero(known & ~after) + 1
        long = tail - head >= self.least
        return list(zip(head[long].tolist(), tail[long].tolist(), strict=True))


def item_words(text: str | None) -> list[bytes]:
    data = T.lower(np.frombuffer((text or "").encode(), np.uint8))
    first, last, _ = T.word_spans(data, np.zeros(1, int), np.array([len(data)]), T.ALNUM)
    return [data[a:b].tobytes() for a, b in zip(first, last, strict=True)]


@lru_cache(maxsize=2)
def _automaton(items: tuple, window: int) -> Automaton:
    return Automaton([(item, item_words(text)) for item, text in items], window)


_RESULT = {
    "n_words": LongType(),
    "n_hit": LongType(),
    "n_items": LongType(),
    "items": ArrayType(StringType()),
    "items_sha256": StringType(),
    "contaminated": BooleanType(),
    "clean_text": StringType(),
}


def _scan(held, schema: pa.Schema, text_col: str, window: int):
    def scan(batches):
        automaton = _automaton(held.value, window)
        for block in T.blocks(batches, text_col):
            data = T.lower(block.data)
            first, last, bounds = T.word_spans(data, block.starts, block.ends, T.ALNUM)
            owner = T.owners(bounds)
            hit = np.zeros(len(first), bool)
            found: dict[int, set[str]] = {}
            for a, b in automaton.stretches(T.word_hashes(data, first, last), owner):
                words = [data[x:y].tobytes() for x, y in zip(first[a:b], last[a:b], strict=True)]
                for end, n, items in automaton.stream([automaton.vocabulary.get(w, -1) for w in words]):
                    hit[a + end - n : a + end] = True
                    found.setdefault(int(owner[a]), set()).update(items)
            sums = np.append(0, np.cumsum(hit))
            n_hit = sums[bounds[1:]] - sums[bounds[:-1]]
            items = [sorted(found.get(i, ())) for i in range(len(block))]
            clean = []
            for i in range(len(block)):
                raw = block.text(i)
                if n_hit[i]:
                    own = slice(bounds[i], bounds[i + 1])
                    raw = _without(raw, first[own] - block.starts[i], last[own] - block.starts[i], hit[own])
                clean.append(raw.decode("utf-8", "replace"))
            extra = {
                "n_words": np.diff(bounds),
                "n_hit": n_hit,
                "n_items": [len(x) for x in items],
                "items": items,
                "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items],
                "contaminated": n_hit > 0,
                "clean_text": clean,
            }
            table = dict(zip(block.batch.schema.names, block.batch.columns, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(extra[f.name], f.type) if f.name in extra else table[f.name].cast(f.type) for f in schema],
                schema=schema,
            )

    return scan


def _without(raw: bytes, first: np.ndarray, last: np.ndarray, hit: np.ndarray) -> bytes:
    """The text without its spans of hit words (from a span's first to its last byte)."""
    step = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    parts, at = [], 0
    for a, b in zip(np.flatnonzero(step > 0), np.flatnonzero(step < 0), strict=True):
        parts.append(raw[at : first[a]])
        at = last[b - 1]
    return b"".join([*parts, raw[at:]])


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """All columns of ``docs`` and those of ``_RESULT``; ``items`` has item_id and
    text.  ``clean_text`` lacks every span of hit words.  Raises ValueError if the
    items' texts exceed ``max_item_bytes``, the proven bound of what is broadcast."""
    from pyspark.sql.pandas.types import to_arrow_schema

    asked = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_item_bytes:
        raise ValueError(f"items hold {size} bytes; at most {max_item_bytes} are broadcast at once")
    rows = tuple(sorted((r.item_id, r.text or "") for r in asked.collect()))
    held = docs.sparkSession.sparkContext.broadcast(rows)
    source = docs.select(*[c for c in docs.columns if c not in _RESULT])
    out = StructType(list(source.schema.fields))
    for name, kind in _RESULT.items():
        out = out.add(name, kind)
    return source.mapInArrow(_scan(held, to_arrow_schema(out), text_col, window), out)


def remove_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without spans found in items, and without documents of which such
    spans cover over ``MAX_COVERAGE_PERCENT`` of the words; ``n_chars`` follows."""
    done = find_contamination(docs, items).where(f"100 * n_hit <= {MAX_COVERAGE_PERCENT} * n_words")
    done = done.withColumn("text", F.when(F.col("contaminated"), F.col("clean_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("contaminated"), chars).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)
