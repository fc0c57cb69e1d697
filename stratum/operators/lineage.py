"""Dependency graphs: transitive closure, cycles, build levels, column
lineage (G12-G15, G22).

Closure and levels peel off the nodes that nothing depends on, run their rounds over the
small rest, and put the peeled layers back with one join each. The closure's rounds
join the newest paths with the edge table on the path's end node,
so their cost follows the number of new paths, not the whole result. Each round is cut with a reliable
checkpoint (the loop would otherwise grow one long lineage), and the stop test
is a single ``isEmpty`` probe. There is no depth cap: every (node, ancestor)
pair is produced once, so the loop ends on any graph, cycles included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, write_out


def _named(edges: DataFrame, child: str, parent: str) -> DataFrame:
    return (edges.select(F.col(child).cast("string").alias("node"), F.col(parent).cast("string").alias("ancestor"))
            .where(F.col("node").isNotNull() & F.col("ancestor").isNotNull()))


def _edges(edges: DataFrame, child: str, parent: str) -> DataFrame:
    return _named(edges, child, parent).distinct()


class _Layer:
    """Nodes that nothing left depends on: ``single`` (node, ancestor) of those with one parent, ``several`` (distinct
    edges) of the others, None where there are none."""

    def __init__(self, single: DataFrame | None, several: DataFrame | None):
        self.single, self.several = single, several


def _peel(edges: DataFrame) -> tuple[DataFrame, list[_Layer], DataFrame]:
    """The distinct edges that are left (core), the layers peeled off, first to last, and the nodes without parents.

    One aggregate a layer tells each node's smallest and largest parent, and whether a node depends on it. Most nodes
    have one parent: their edge is known from that row, duplicates included, and their pairs need no aggregate
    later. Layers are peeled as long as one holds half of the nodes that are left.
    """
    rest, layers, roots = edges, [], None
    while True:
        ends = F.explode(F.array(F.struct(F.col("node").alias("node"), F.col("ancestor").alias("up")),
                                 F.struct(F.col("ancestor").alias("node"), F.lit(None).cast("string").alias("up")))).alias("e")
        per = rest.select(ends).groupBy("e.node").agg(F.min("e.up").alias("least"), F.max("e.up").alias("most"),
                                                      F.max(F.col("e.up").isNull()).alias("needed"))
        kind = (F.when(F.col("most").isNull(), "root").when(~F.col("needed") & (F.col("least") == F.col("most")), "single")
                .when(~F.col("needed"), "several").when(F.col("least") == F.col("most"), "inner_single").otherwise("inner_several"))
        table = write_out(per.select("node", F.col("least").alias("ancestor"), kind.alias("kind")), "kind")
        n = {r["kind"]: r["n"] for r in table.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}  # five rows at most
        of = lambda k: table.where(F.col("kind") == k).select("node", "ancestor")
        many = lambda k: rest.join(of(k).select("node"), "node", "left_semi").distinct()
        roots = of("root").select("node") if roots is None else roots  # of the whole graph: peeling makes no new ones
        outer, inner = n.get("single", 0) + n.get("several", 0), n.get("inner_single", 0) + n.get("inner_several", 0)
        if not outer or outer < inner:  # what is left is the core: its edges, once each
            parts = [of("single"), of("inner_single")] + [many(k) for k in ("several", "inner_several") if n.get(k)]
            return cut_lineage(_union(parts)), layers, roots
        layers.append(_Layer(of("single") if n.get("single") else None, cut_lineage(many("several")) if n.get("several") else None))
        rest = of("inner_single") if not n.get("inner_several") else cut_lineage(of("inner_single").unionByName(many("inner_several")))
        if not inner:
            return rest, layers, roots


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def transitive_closure(edges: DataFrame, child: str = "node", parent: str = "parent",
                       keep_cycles: bool = False, start: Sequence[str] | None = None) -> DataFrame:
    """All (node, ancestor) pairs reachable through ``child -> parent`` edges.

    Output: node, ancestor, depth (shortest), path (array of the nodes of the smallest of the shortest paths). With
    ``keep_cycles`` a path may end on its own start node, so cycles show up as rows with ``node = ancestor``. With
    ``start`` only paths from those nodes are walked.

    Most nodes of a lineage graph are ones that nothing depends on. They are peeled off in layers, as long as a layer
    holds half of the nodes that are left; the rounds of a fixpoint run over the small core only, which
    holds all cycles. A layer is then put back with one join to the closure below it: no pair
    found earlier has to be looked for, as no path leads to a peeled node, and only the pairs of nodes with several
    parents are aggregated.
    """
    e = _named(edges, child, parent)
    if not keep_cycles:
        e = e.where(F.col("node") != F.col("ancestor"))
    if start is not None:
        e = cut_lineage(e.distinct())
        return _walk(e, e.where(F.col("node").isin(list(start))), keep_cycles)
    core, layers, _ = _peel(e)
    found = _walk(core, core, keep_cycles).select("node", "ancestor", "depth", "path")
    for i, layer in enumerate(reversed(layers)):
        below = found if i == 0 else write_out(found)
        on = below.select(F.col("node").alias("__via"), F.col("ancestor").alias("__far"), "depth", F.col("path").alias("__path"))
        new = []
        for part, aggregate in ((layer.single, False), (layer.several, True)):
            if part is None:
                continue
            # a cycle's way back to the parent is longer than the edge to it
            longer = part.join(on.where(F.col("__far") != F.col("__via")), F.col("ancestor") == F.col("__via")).select(
                "node", F.col("__far").alias("ancestor"), (F.col("depth") + 1).alias("d"), F.concat(F.array("node"), "__path").alias("p"))
            pairs = part.select("node", "ancestor", F.lit(1).alias("d"), F.array("node", "ancestor").alias("p")).unionByName(longer)
            if aggregate:
                pairs = pairs.groupBy("node", "ancestor").agg(F.min(F.struct("d", "p")).alias("b")).select(
                    "node", "ancestor", F.col("b.d").alias("d"), F.col("b.p").alias("p"))
            new.append(pairs.select("node", "ancestor", F.col("d").alias("depth"), F.col("p").alias("path")))
        found = _union([below, *new])
    return found.select("node", "ancestor", F.col("depth").cast("int").alias("depth"), "path")


def _walk(edges: DataFrame, first: DataFrame, keep_cycles: bool) -> DataFrame:
    """Closure of the ``first`` edges by semi-naive rounds: each extends only the pairs found in the
    previous round, keeps one (shortest, then smallest) path per pair, and
    drops pairs found in earlier rounds. Every pair is produced exactly once,
    so graphs with many alternative paths (diamonds) cannot blow the frontier
    up, and the loop ends when a round finds nothing new.
    """
    step = edges.select(F.col("node").alias("__via"), F.col("ancestor").alias("__next"))
    frontier = first.select("node", "ancestor", F.lit(1).alias("depth"), F.array("node", "ancestor").alias("path"))
    found = frontier
    rounds = 0
    while True:
        ends = frontier.where(F.col("node") != F.col("ancestor"))
        # only the edges that go on from here: where many paths meet in few nodes these are few rows, which AQE broadcasts
        onward = step.join(ends.select(F.col("ancestor").alias("__via")).distinct(), "__via", "left_semi")
        nxt = ends.join(onward, F.col("ancestor") == F.col("__via"))
        if not keep_cycles:
            nxt = nxt.where(F.col("__next") != F.col("node"))
        nxt = (nxt.groupBy("node", F.col("__next").alias("ancestor"))
               .agg(F.min(F.struct((F.col("depth") + 1).alias("d"), F.concat("path", F.array("__next")).alias("p"))).alias("b"))
               .join(found.select("node", "ancestor"), ["node", "ancestor"], "left_anti")
               .select("node", "ancestor", F.col("b.d").alias("depth"), F.col("b.p").alias("path")))
        nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        found = found.unionByName(nxt)
        frontier = nxt
        rounds += 1
        if rounds % 16 == 0:  # deep graphs: keep the plan short
            found = cut_lineage(found)
    return found.select("node", "ancestor", F.col("depth").cast("int").alias("depth"), "path")


def upstream(closure: DataFrame, node: str) -> DataFrame:
    """Everything ``node`` depends on."""
    return closure.where(F.col("node") == node)


def downstream(closure: DataFrame, node: str) -> DataFrame:
    """Everything that depends on ``node``."""
    return closure.where(F.col("ancestor") == node)


def cyclic_core(edges: DataFrame, child: str = "node", parent: str = "parent") -> DataFrame:
    """The edges that are left when nodes that nothing depends on, and nodes that depend on nothing, are peeled off
    until none is left: those on cycles, and between them."""
    e = cut_lineage(_edges(edges, child, parent))
    while True:
        n = e.count()
        e = cut_lineage(e.join(e.select(F.col("ancestor").alias("node")).distinct(), "node", "left_semi")
                        .join(e.select(F.col("node").alias("ancestor")).distinct(), "ancestor", "left_semi")
                        .select("node", "ancestor"))
        if e.count() == n:
            return e


def find_cycles(edges: DataFrame, child: str = "node", parent: str = "parent") -> DataFrame:
    """Nodes on a dependency cycle, with one cycle path each (G14). Only the cyclic core is closed over."""
    c = transitive_closure(cyclic_core(edges, child, parent), "node", "ancestor", keep_cycles=True)
    return c.where(F.col("node") == F.col("ancestor"))


def build_levels(edges: DataFrame, child: str = "node", parent: str = "parent") -> DataFrame:
    """Topological level per node (G15): 0 for nodes without dependencies,
    else 1 + the longest chain below; lower levels run first. Nodes on a cycle, or above one, have no level: they
    come with NULL, and ``blocked_by_cycle`` is true for them.

    Nodes that nothing depends on are peeled off in layers first, and get their level from their parents' by one join a
    layer. In the core a node is ready when as many of its dependencies have a level as it has in all; each round
    only joins the newest nodes with the core's edges.
    """
    core, layers, roots = _peel(_named(edges, child, parent))
    known = _core_levels(core, roots)
    for layer in reversed(layers):
        known = write_out(known)
        up = known.select(F.col("n").alias("ancestor"), F.col("level").alias("below"))
        new = []
        if layer.single is not None:
            new.append(layer.single.join(up, "ancestor").select(F.col("node").alias("n"), (F.col("below") + 1).alias("level")))
        if layer.several is not None:
            most = F.when(F.count("below") == F.count(F.lit(1)), F.max("below") + 1)  # none, if one parent has none
            new.append(layer.several.join(up, "ancestor").groupBy("node").agg(most.alias("level")).select(F.col("node").alias("n"), "level"))
        known = _union([known, *new])
    return known.select(F.col("n").alias("node"), "level", F.col("level").isNull().alias("blocked_by_cycle"))


def _core_levels(e: DataFrame, roots: DataFrame) -> DataFrame:
    """(n, level) of ``roots``, which have no parents, and of the nodes of the distinct edges ``e``; level is null on and above cycles."""
    nodes = e.select("node").distinct()
    needs = cut_lineage(e.groupBy("node").agg(F.count(F.lit(1)).alias("left")))
    done = roots.select(F.col("node").alias("n"), F.lit(0).alias("level"))
    newest, level = done, 0
    while not needs.isEmpty() and not newest.isEmpty():
        level += 1
        met = e.join(newest.select(F.col("n").alias("ancestor")), "ancestor", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("met"))
        needs = cut_lineage(needs.join(met, "node", "left").select("node", (F.col("left") - F.coalesce("met", F.lit(0))).alias("left"),
                                                                   F.col("met").isNotNull().alias("moved")))
        newest = needs.where((F.col("left") == 0) & F.col("moved")).select(F.col("node").alias("n"), F.lit(level).alias("level"))
        needs = needs.where("left > 0").select("node", "left")
        done = done.unionByName(newest)
        if level % 16 == 0:  # deep graphs: keep the plan short
            done = cut_lineage(done)
    blocked = nodes.join(done.select(F.col("n").alias("node")), "node", "left_anti")
    return done.unionByName(blocked.select(F.col("node").alias("n"), F.lit(None).cast("int").alias("level")))


def column_lineage(mappings: DataFrame, target_col: str = "target_column",
                   sources_col: str = "source_columns") -> DataFrame:
    """Column-level lineage closed over layers.

    ``mappings`` has one row per target column with an array of the source
    columns it is computed from (qualified names such as ``silver.policy.id``).
    """
    edges = mappings.select(F.col(target_col).alias("node"), F.explode(sources_col).alias("parent"))
    return transitive_closure(edges)
