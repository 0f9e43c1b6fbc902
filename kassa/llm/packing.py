"""Packing documents into training sequences with the sum-of-squares rule.

A document's tokens are the ids of its whole text (null: empty) and the end id.
Full sequences are cut from its front; the rest, shorter than a sequence, is
placed online: of all fill levels that leave room for it, and an empty sequence,
the one that gives the smallest sum over levels of the squared count of open
sequences at that level.  The counts stand in one array by level.  When a task's
documents are done, what is still open is cut and joined, so that at most one
sequence of a task is padded.

Every task packs the documents it reads, with sequence ids of its own
(partition number in the upper bits), so nothing is shuffled, and a task that
is run again gives the same pieces.

Tokens: byte-level BPE of a public vocabulary, whose place is a parameter.
Pieces of the pre-tokeniser are found on whole blocks and looked up in a
bounded table of recent pieces; only new ones are encoded.  Documents with
characters other than U+0000-U+052F and U+2000-U+203F (Latin, Greek, Cyrillic,
general punctuation), or with a special token's string, go through the tokeniser
itself; ids are the same.

Rows, also repeated ones, are packed one by one; a null doc_id stays null; an
empty table gives no pieces; an empty text still has its end id.
"""

from __future__ import annotations

import base64
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm import text as T

LENGTH = 2048
END_ID = 1
TABLE = 1 << 20
POOL = 1 << 24
TOP = 0x2040


# ---- tokens


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, for characters below TOP."""
    import regex

    out = np.zeros(TOP, np.uint8)
    for code in range(TOP):
        for kind, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\s")):
            if regex.match(pattern, chr(code)):
                out[code] = kind
    return out


def piece_starts(codes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where a pre-token starts: runs of letters, of numbers, of other signs, each
    with one space before it; other white space; the contractions after ``'``.
    ``heads``: the first character of each document."""
    kind = _classes()[codes]
    n = len(kind)
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    start[heads] = True
    space = kind == 3
    follows = np.zeros(n, bool)  # the next character is of the same document and no space
    follows[:-1] = ~space[1:]
    follows[heads[heads > 0] - 1] = False
    last = np.flatnonzero(space & follows)
    start[last] = True
    start[last[codes[last] == 0x20] + 1] = False
    tail = np.zeros(n + 3, bool)
    tail[heads] = True
    padded = np.append(codes, [0, 0, 0])
    for i in np.flatnonzero(start & (codes == 0x27)).tolist():
        a, b = int(padded[i + 1]), int(padded[i + 2])
        if tail[i + 1]:
            continue
        if a in (0x73, 0x74, 0x6D, 0x64):  # 's 't 'm 'd
            size = 2
        elif (a, b) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)) and not tail[i + 2]:  # 're 've 'll
            size = 3
        else:
            continue
        start[i + 1 : i + size] = False
        if i + size < n and kind[i + size] == 1 and not tail[i + size]:
            start[i + size] = True
    return start


class Tokens:
    """Token ids of blocks of documents."""

    def __init__(self, tokenizer_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces = tiktoken.Encoding(
            "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.hashes = np.zeros(TABLE, np.uint64)
        self.at = np.zeros(TABLE, np.int64)
        self.size = np.zeros(TABLE, np.int32)
        self.pool = np.zeros(POOL, np.uint32)
        self.used = 0

    def of(self, block: T.Block) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(block)
        plain = []
        # lead bytes up to 0xD4 cover characters below U+0530, E2 80 those of U+2000-U+203F
        after = np.append(block.data[1:], np.uint8(0))
        odd = (block.data > 0xD4) & ~((block.data == 0xE2) & (after == 0x80))
        odd = np.append(0, np.cumsum(odd))
        for i in range(len(block)):
            raw = block.text(i)
            if odd[block.ends[i]] != odd[block.starts[i]] or any(s in raw for s in self.special):
                ids = self.whole.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids
                out[i] = np.array(ids, np.uint32)
            elif raw:
                plain.append((i, raw))
            else:
                out[i] = np.zeros(0, np.uint32)
        if plain:
            for (i, _), ids in zip(plain, self._plain([raw for _, raw in plain]), strict=True):
                out[i] = ids
        return out

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        codes = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
        byte_of = np.flatnonzero((data & 0xC0) != 0x80)
        ends = np.cumsum([len(t) for t in texts])
        heads = np.searchsorted(byte_of, np.append(0, ends[:-1]))
        first = byte_of[np.flatnonzero(piece_starts(codes, heads))]
        last = np.append(first[1:], len(data))
        at, size = self._look_up(data, first, last, T.word_hashes(data, first, last))
        begin = np.append(0, np.cumsum(size, dtype=np.int64))
        ids = self.pool[np.repeat(at - begin[:-1], size) + np.arange(begin[-1])]
        cuts = begin[np.append(0, np.searchsorted(first, ends))]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _look_up(self, data, first, last, hashes) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of ids of each piece."""
        slot = (hashes >> np.uint64(20)).astype(np.int64) & (TABLE - 1)
        known = self.hashes[slot] == hashes
        new = np.flatnonzero(~known)
        once, where = np.unique(hashes[new], return_index=True)
        texts = [data[a:b].tobytes().decode() for a, b in zip(first[new[where]], last[new[where]], strict=True)]
        ids = [self.pieces.encode_ordinary(t) for t in texts]
        sizes = np.array([len(x) for x in ids], np.int32)
        if self.used + sizes.sum() > len(self.pool) and self.used:
            self.hashes[:] = 0
            self.used = 0
            return self._look_up(data, first, last, hashes)
        if sizes.sum() > len(self.pool):
            self.pool = np.zeros(int(sizes.sum()), np.uint32)
        places = self.used + np.append(0, np.cumsum(sizes[:-1], dtype=np.int64))[: len(sizes)]
        if len(sizes):
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
            self.pool[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
        at, size = self.at[slot], self.size[slot]
        index = np.searchsorted(once, hashes[new])
        at[new], size[new] = places[index], sizes[index]
        slots = slot[new[where]]
        self.hashes[slots], self.at[slots], self.size[slots] = once, places, sizes
        return at, size


@lru_cache(maxsize=1)
def _tokens(tokenizer_path: str, ranks_path: str) -> Tokens:
    return Tokens(tokenizer_path, ranks_path)


# ---- packing


class Packer:
    """Online sum-of-squares packing of (key, start, ids) into sequences.

    ``counts[level]``: open sequences holding ``level`` ids; ``open[level]``
    lists them, each as its pieces in order."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.counts = np.zeros(length + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(length + 1)]

    def add(self, key, ids: np.ndarray):
        """Yields each sequence that is full, as its list of pieces."""
        whole = len(ids) // self.length * self.length
        for at in range(0, whole, self.length):
            yield [(key, at, ids[at : at + self.length])]
        if whole < len(ids):
            yield from self._place((key, whole, ids[whole:]))

    def _place(self, piece):
        size = len(piece[2])
        room = self.length - size
        # change of the sum of squares for a sequence at level h: it leaves h for h + size
        change = 2 * (self.counts[size : self.length + 1] - self.counts[: room + 1]) + 2
        change[0] = 2 * self.counts[size] + 1  # a new sequence
        change[room] = 1 - 2 * self.counts[room] if room else 0  # full ones are not counted
        change[1:][self.counts[1 : room + 1] == 0] = np.iinfo(np.int64).max
        level = int(np.argmin(change))
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.length:
            yield pieces
        else:
            self.open[level + size].append(pieces)
            self.counts[level + size] += 1

    def close(self):
        """The rest: emptier sequences are cut to fill the fuller ones."""
        left = [p for level in range(self.length - 1, 0, -1) for p in self.open[level]]
        a, b = 0, len(left) - 1
        while a <= b:
            fill = sum(len(p[2]) for p in left[a])
            while fill < self.length and a < b:
                key, start, ids = left[b].pop()
                n = min(len(ids), self.length - fill)
                left[a].append((key, start, ids[:n]))
                fill += n
                if n < len(ids):
                    left[b].append((key, start + n, ids[n:]))
                elif not left[b]:
                    b -= 1
            yield left[a]
            a += 1


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(paths: tuple[str, str], length: int, end_id: int, with_ids: bool):
    def pack(batches):
        tokens = _tokens(*paths)
        packer = Packer(length)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        rows: list[list] = [[] for _ in range(8)]

        def put(pieces) -> None:
            nonlocal number
            offset = 0
            for (doc_id, total), start, ids in pieces:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                values = (doc_id, start, len(ids), crc, total, number, offset, ids if with_ids else None)
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
                offset += len(ids)
            number += 1

        def flush():
            arrays = [pa.array(column, pa.int64()) for column in rows[:7]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in rows[7]], pa.list_(pa.int32())))
                names.append("ids")
            for column in rows:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for block in T.blocks(batches):
            doc_ids = block.batch.column(0).to_pylist()
            for doc_id, ids in zip(doc_ids, tokens.of(block), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                for pieces in packer.add((doc_id, len(ids)), ids):
                    put(pieces)
            if rows[0]:
                yield flush()
        for pieces in packer.close():
            put(pieces)
        if rows[0]:
            yield flush()

    return pack


def pack_sequences(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    ranks_path: str | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (all long), and ``ids`` (array<int>) if asked for.

    The vocabulary files default to the installed public ones: the tokeniser's
    own file, and the same vocabulary as ranks."""
    import public_tokenizers

    paths = (
        tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"),
        ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = _PIECE + (", ids array<int>" if with_ids else "")
    return source.mapInArrow(_pack(tuple(map(str, paths)), length, end_id, with_ids), schema)
