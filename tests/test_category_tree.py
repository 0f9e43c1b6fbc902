"""Category trees of any depth, with cycles reported."""

from __future__ import annotations

from fixtures import make_shop

from kassa.operators.shared import category_tree


def _tree(spark, categories):
    rows = category_tree(make_shop(spark, categories=categories)).collect()
    assert len(rows) == len({r.category_id for r in rows})
    return {r.category_id: (r.top_id, r.top_level, r.depth, r.cyclic) for r in rows}


def _plainly(categories):
    parents, names = {c[0]: c[2] for c in categories}, {c[0]: c[1] for c in categories}
    out = {}
    for start in parents:
        at, seen = start, [start]
        while parents[at] in parents and parents[at] not in seen:
            at = parents[at]
            seen.append(at)
        cyclic = parents[at] in parents
        out[start] = (None, None, None, True) if cyclic else (at, names[at], len(seen) - 1, False)
    return out


def test_deep_trees_orphans_and_cycles(spark):
    chain = [(i, f"c{i}", i - 1 if i > 1 else None) for i in range(1, 7)]  # depth five
    orphan = [(20, "orphan", 99), (21, "below", 20)]
    cycle = [(30, "a", 32), (31, "b", 30), (32, "c", 31), (33, "under a cycle", 31), (40, "own parent", 40)]
    rows = chain + orphan + cycle
    got = _tree(spark, rows)
    assert got == _plainly(rows)
    assert got[6] == (1, "c1", 5, False) and got[21] == (20, "orphan", 1, False)
    assert all(got[i] == (None, None, None, True) for i in (30, 31, 32, 33, 40))


def test_long_chain_and_no_category(spark):
    chain = [(i, f"c{i}", i - 1 if i else None) for i in range(38)]
    assert _tree(spark, chain) == _plainly(chain)
    assert _tree(spark, []) == {}
