import random

from llm_cases import ROWS, frame

from kassa.llm import minhash_dedup
from kassa.llm.minhash_dedup import keep_one, near_duplicates


def shingles(text, width=3):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def brute(rows, width=3, percent=85):
    sets = {d: shingles(t, width) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def check(spark, rows):
    got = near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.component_id == r.doc_id)


def near_copies(n, seed, words=200, edits=8):
    """Copies with 0 to ``edits`` changed words, so many pairs stand near the limit;
    some are copies of copies."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(words)]
    texts = [base]
    for _ in range(n - 1):
        text = list(rng.choice(texts) if rng.random() < 0.3 else base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        texts.append(text)
    return [" ".join(t) for t in texts]


def test_edge_rows(spark):
    check(spark, ROWS)


def test_groups_near_the_limit(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)  # several blocks a group
    texts = near_copies(260, 1) + near_copies(40, 2, words=60, edits=3) + near_copies(30, 3)
    random.Random(4).shuffle(texts)
    check(spark, list(enumerate(texts, 1)))


def test_empty_table_and_one_of_each_group(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    docs = frame(spark)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 10]


def test_tables_for_a_limit():
    assert (minhash_dedup.keys_a_side(85), minhash_dedup.keys_a_side(80), minhash_dedup.keys_a_side(100)) == (12, 16, 1)


def test_five_words_and_four_fifths(spark):
    rng = random.Random(8)
    rows = []
    for i in range(40):
        text = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        footer = [f"f{rng.randrange(10**6)}" for _ in range(55 + i)]  # similarity 0.84 to 0.76
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text + footer))]
    docs = frame(spark, rows)
    kept = {r.doc_id for r in keep_one(docs, width=5, percent=80).collect()}
    # 296 five-word shingles and one more for each added word
    want = {2 * i for i in range(40)} | {2 * i + 1 for i in range(40) if 100 * 296 < 80 * (296 + 55 + i)}
    assert kept == want and 40 < len(want) < 80


def test_a_doc_id_with_two_texts_links_both(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = [(1, a), (1, b), (2, a), (3, b), (4, a + " x"), (5, b + " y"), (6, "alone")]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {
        (1, 98): (1, True),
        (2, 98): (1, False),
        (3, 98): (1, False),
        (4, 99): (1, False),
        (5, 99): (1, False),
        (6, 1): (6, True),
    }


def test_blocks_bounded_in_shingles(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "CELLS", 2000)  # ten sets of 200 shingles a block
    check(spark, list(enumerate(near_copies(80, 9), 1)))
