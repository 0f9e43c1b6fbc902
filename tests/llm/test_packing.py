import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ROWS, frame
from tokenizers import Tokenizer

from kassa.llm import packing as P
from kassa.llm import text as T


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.END_ID]


def check(spark, tokenizer, rows, length=P.LENGTH):
    docs = frame(spark, rows).repartition(3)
    got = P.pack_sequences(docs, length=length, with_ids=True).collect()
    whole, sequences = {}, {}
    for r in got:
        assert r.length == len(r.ids) > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        whole.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(ids_of(tokenizer, t))
    assert set(whole) == set(texts)
    for d, pieces in whole.items():
        want = texts[d][0]
        assert all(r.doc_tokens == len(want) for r in pieces)
        cover = sorted((r.start, r.start + r.length) for r in pieces)
        assert sum(b - a for a, b in cover) == len(want) * len(texts[d])
        for r in pieces:
            assert r.ids == want[r.start : r.start + r.length]
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    fills = [sum(r.length for r in p) for p in sequences.values()]
    assert sum(f < length for f in fills) <= 3  # at most one a task
    return fills


def test_edge_rows(spark, tokenizer):
    check(spark, tokenizer, ROWS)


def test_many_small_documents(spark, tokenizer):
    rng = random.Random(1)
    rows = [(d, " ".join(rng.choice(["on", "the", "Straße"]) for _ in range(rng.randrange(120)))) for d in range(400)]
    check(spark, tokenizer, rows, length=64)


def test_empty_table(spark):
    assert P.pack_sequences(frame(spark, [])).collect() == []


def test_ids_are_those_of_the_tokenizer(tokenizer):
    import pyarrow as pa

    rng = random.Random(2)
    signs = [*"aB'strvelmd  \n\t09.,!?%éßñ½²—’“…йα_-", "'s", "'re", "'ll", " '", "\u0085", "\u00a0", "日本", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x530), rng.randrange(0x2000, 0x2040), 32])) for _ in range(30)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tokens = P.Tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    got = [ids.tolist() for block in T.blocks(iter([batch]), size=9000) for ids in tokens.of(block)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_full_table_of_pieces_starts_anew(tokenizer, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(P, "POOL", 60)
    monkeypatch.setattr(P, "TABLE", 8)
    rng = random.Random(3)
    texts = [" ".join(f"{rng.choice('abc')}{rng.randrange(50)}x" for _ in range(25)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tokens = P.Tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    got = [ids.tolist() for block in T.blocks(iter([batch]), size=100) for ids in tokens.of(block)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_level_with_the_smallest_sum_of_squares_is_taken():
    packer = P.Packer(10)
    rng = np.random.default_rng(0)
    for i in range(500):
        before = packer.counts.copy()
        size = int(rng.integers(1, 10))
        list(packer.add(i, np.zeros(size, np.uint32)))
        options = []
        for level in range(0, 10 - size + 1):
            if level and not before[level]:
                continue
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < 10:
                after[level + size] += 1
            options.append((after[:10] ** 2).sum())
        assert (packer.counts[:10] ** 2).sum() == min(options)
        assert [len(x) for x in packer.open] == packer.counts.tolist()
