"""Closure, cycles and levels against a plain walk of small graphs."""

import random

import pytest

from stratum.operators import lineage as L


def _walks(edges, keep_cycles=False):
    """(node, ancestor) -> (depth, smallest of the shortest paths), breadth first."""
    nexts = {}
    for a, b in edges:
        if keep_cycles or a != b:
            nexts.setdefault(a, set()).add(b)
    out = {}
    for a in nexts:
        paths = [(a,)]
        while paths:
            grown = {}
            for p in paths:
                if len(p) > 1 and p[-1] == a:
                    continue
                for b in nexts.get(p[-1], ()):
                    if (a, b) not in out and (keep_cycles or b != a):
                        grown[b] = min(grown.get(b, p + (b,)), p + (b,))
            for b, p in grown.items():
                out[a, b] = (len(p) - 1, list(p))
            paths = list(grown.values())
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("keep_cycles", [False, True])
def test_closure_equals_plain_walks(spark, seed, keep_cycles):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(12)}", f"n{rng.randrange(12)}") for _ in range(14)]  # a core with cycles
    edges += [(f"a{i}", f"n{rng.randrange(12)}") for i in range(60) for _ in range(2)]  # and layers of leaves over it
    edges += [(f"b{i}", f"a{rng.randrange(60)}") for i in range(500) for _ in range(2)] + [("b1", "n1"), (None, "n1"), ("b2", None)]
    df = spark.createDataFrame(edges, "node string, parent string")
    got = {(r.node, r.ancestor): (r.depth, r.path) for r in L.transitive_closure(df, keep_cycles=keep_cycles).collect()}
    assert got == _walks([e for e in edges if None not in e], keep_cycles)
    some = {(r.node, r.ancestor): r.depth for r in L.transitive_closure(df, start=["b1", "a3"]).collect()}
    assert some == {k: d for k, (d, _) in _walks([e for e in edges if None not in e]).items() if k[0] in ("b1", "a3")}


def test_closure_of_nothing_and_of_self_loops(spark):
    df = spark.createDataFrame([("a", "a")], "node string, parent string")
    assert L.transitive_closure(df).count() == 0 and L.transitive_closure(df.where("node = 'b'")).count() == 0
    assert [(r.node, r.depth) for r in L.transitive_closure(df, keep_cycles=True).collect()] == [("a", 1)]


def _levels(edges):
    nodes, ups = {n for e in edges for n in e}, {}
    for a, b in edges:
        ups.setdefault(a, set()).add(b)
    out = {n: 0 for n in nodes if n not in ups}
    while ready := [n for n in nodes if n not in out and all(u in out for u in ups[n])]:
        out |= {n: 1 + max(out[u] for u in ups[n]) for n in ready}
    return {n: out.get(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_levels_equal_plain_peeling(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(12)}", f"n{rng.randrange(12)}") for _ in range(10)] + [(f"m{i}", f"m{i + 1}") for i in range(9)]
    edges += [(f"a{i}", rng.choice(["n", "m"]) + str(rng.randrange(9))) for i in range(60) for _ in range(1 + i % 2)]
    edges += [(f"b{i}", f"a{rng.randrange(60)}") for i in range(500) for _ in range(1 + i % 3)] + [("b1", "a1")] * 2
    df = spark.createDataFrame(edges + [(None, "n1"), ("b2", None)], "node string, parent string")
    got = L.build_levels(df).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.level for r in got} == _levels(edges)
    assert all(r.blocked_by_cycle == (r.level is None) for r in got)
    assert L.build_levels(df.where("node = 'none'")).count() == 0


def test_peeled_layers_are_put_back_without_rounds_or_aggregates(spark):
    """Nodes with one parent need no aggregate of their pairs, and no round over all nodes."""
    edges = [(f"c{i}", f"b{i % 300}") for i in range(3000)] + [(f"b{i}", f"a{i % 20}") for i in range(300)] + [(f"a{i}", "r") for i in range(20)]
    df = spark.createDataFrame(edges + edges[:50], "node string, parent string")
    core, layers, roots = L._peel(L._named(df, "node", "parent"))
    assert core.count() == 0 and roots.count() == 1
    assert [x.single.count() for x in layers] == [3000, 300, 20] and all(x.several is None for x in layers)
    got = L.transitive_closure(df)
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString() and got.count() == 3 * 3000 + 2 * 300 + 20
