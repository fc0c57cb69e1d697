"""Balanced label propagation: linked documents share shards whose sizes stay nearly equal.

Documents are linked by a group key (by default: equal texts) and, where the caller gives
some, by pairs of ids. Links, not merging beforehand, bring equal texts together.

1. Every linked document is a node of its own, that starts on a line by a hash of the row, cut into shards of
   equal sizes: equal texts start scattered. Only a group larger than ``CHUNK_SHARE`` of a shard, in bytes or rows, is dealt into
   chunks of about that size, each a node, so a group with a third of all rows can be spread over as few shards as possible.
2. Rounds: an edge table (node, neighbour, links) joined with the labels gives what each node's
   neighbours carry. Nodes of one group are neighbours of each other, through one row for (group, shard)
   instead of all pairs. In each round half of the nodes, by a hash, may ask for the shard
   that holds most of their neighbours, if it holds more than their own. For each pair of shards the
   wishes are granted in a random order up to the capacity (bounded tables of shard by hash bucket
   decide, no sort in one task); what leaves a shard makes room in it.
3. Documents without links fill the shards up to equal sizes: those over ``LONG_SHARE`` of a shard (a bounded number)
   go to the emptiest shard each, the others are laid along a line by a hash, in proportion to each shard's room.
4. Rows get slots: counts of (shard, bucket) give each bucket its first slot, and
   rows are numbered within buckets of bounded size.

The law is ``bytes``: sizes of the shards are nearly equal (a document's size is
the bytes of its text plus one).

Defined cases: a null text has size 1 and counts as empty; equal texts are one group,
empty and null ones too; repeated rows are documents of their own; links that name an unknown or null id, or
one id twice, count for nothing; repeated links count once, in either direction; ties go to the
smaller shard; an empty table gives no rows; with fewer documents than shards some stay empty.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import reliable, text_or_empty, written

SHARDS = 16
#: Rounds of propagation at most; it ends before when no wish is left, or none was granted three times.
ROUNDS = 16
#: Groups larger than this share of an even shard move in chunks of at most about that size; documents of smaller ones move alone.
CHUNK_SHARE = 1 / 64
#: Unlinked documents over this share of an even shard are placed one by one (a bounded number), before the others.
LONG_SHARE = 1 / 256
#: Linked documents may fill a shard up to this share of an even one; the rest levels the sizes.
FILL = 0.97
#: Where nearly all documents are linked, so much above an even share is let be.
SLACK = 1.02
#: Hash buckets in which wishes are granted: the tables on the driver have shards x buckets rows.
BUCKETS = 256
#: Rows numbered by one task at a time, about.
SLOT_ROWS = 20_000


def _bucket(col: Column, n: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(col, F.lit(salt)), F.lit(n)).cast("int")


def _totals(df: DataFrame, by: str, size: str, shards: int) -> list[int]:
    got = {r[by]: r["s"] for r in df.groupBy(by).agg(F.sum(size).alias("s")).collect()}  # at most one row per shard
    return [int(got.get(i) or 0) for i in range(shards)]


NODE = ["group", "chunk"]


def _on_line(df: DataFrame, place: Column, room: list[float]) -> DataFrame:
    """``df`` (with ``size``) and its ``shard``: laid along a line by ``place``, in proportion to the room of each shard."""
    at = df.withColumn("line", F.pmod(place, F.lit(1 << 20)).cast("int"))
    spot = F.lit(len(room) - 1)
    for i, end in reversed(list(enumerate(_cuts(at, room)[:-1]))):
        spot = F.when(F.col("line") < end, F.lit(i)).otherwise(spot)
    return at.withColumn("shard", spot.cast("int")).drop("line")


def _wishes(labels: DataFrame, edges: DataFrame | None, open_shards: list[int]) -> DataFrame:
    """(group, chunk, to) of the nodes that one of ``open_shards`` holds more neighbours of than their own shard does."""
    hubs = labels.groupBy("group", "shard").agg(F.sum("n").alias("w")).withColumnRenamed("shard", "s")
    # a node is no neighbour of itself
    near = labels.join(hubs, "group").select(*NODE, "s", (F.col("w") - F.when(F.col("s") == F.col("shard"), F.col("n")).otherwise(0)).alias("w"))
    if edges is not None:
        there = labels.select(F.col("group").alias("group2"), F.col("chunk").alias("chunk2"), F.col("shard").alias("s"))
        near = near.unionAll(edges.join(there, ["group2", "chunk2"]).groupBy(*NODE, "s").agg(F.sum("w").alias("w")))
    near = near.where("w > 0").groupBy(*NODE, "s").agg(F.sum("w").alias("w")).join(labels.select(*NODE, "shard"), NODE)
    away = F.col("s").isin(open_shards) & (F.col("s") != F.col("shard"))
    best = near.groupBy(*NODE).agg(F.coalesce(F.max(F.when(F.col("s") == F.col("shard"), F.col("w"))), F.lit(0)).alias("own"),
                                   F.max(F.when(away, F.struct("w", (-F.col("s")).alias("s")))).alias("best"))
    return best.where("best.w > own").select(*NODE, (-F.col("best.s")).cast("int").alias("to"))


def _grants(asked: list, free: list[float]) -> dict[tuple[int, int], int]:
    """Buckets granted to each pair of shards, first to last; what leaves a shard makes room for others."""
    queues: dict[tuple[int, int], list] = {}
    for r in sorted(asked, key=lambda r: r["bucket"]):
        queues.setdefault((r["shard"], r["to"]), []).append((r["bucket"], r["s"]))
    done, granted = dict.fromkeys(queues, 0), {}
    progress = True
    while progress:
        progress = False
        for (a, b), queue in sorted(queues.items()):
            k = done[a, b]
            if k < len(queue) and queue[k][1] <= free[b]:
                free[b] -= queue[k][1]
                free[a] += queue[k][1]
                done[a, b], granted[a, b], progress = k + 1, queue[k][0] + 1, True
    return granted


def propagate(nodes: DataFrame, shards: int, capacity: float, edges: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(group, chunk, size, n, shard) of ``nodes`` (group, chunk, size, n: documents).

    ``edges`` (group, chunk, group2, chunk2, w) hold each link in both directions.
    """
    labels = written(_on_line(nodes, F.xxhash64("group", "chunk", F.lit(1)), [1.0] * shards))
    idle = 0
    for turn in range(rounds):
        free = [capacity - x for x in _totals(labels, "shard", "size", shards)]
        # where only exchanges are left, shards without room are asked every other time
        open_shards = [i for i in range(shards) if turn % 2 == 0 and idle or turn == 0 or free[i] > capacity * CHUNK_SHARE]
        wishes = _wishes(labels, edges, open_shards)
        want = written(labels.join(wishes, NODE, "left").withColumn("bucket", _bucket(F.struct(*NODE), BUCKETS, 100 + turn)))
        asks = F.col("to").isNotNull() & (_bucket(F.struct(*NODE), 2, 500 + turn) == 0)
        # at most shards x shards x BUCKETS rows
        asked = want.where(asks).groupBy("shard", "to", "bucket").agg(F.sum("size").alias("s")).collect()
        granted = _grants(asked, free)
        if not granted:
            idle += 1
            if idle == 3 or len(open_shards) == shards and want.where("to is not null").isEmpty():
                break
            continue
        idle = 0
        table = F.array(*[F.lit(granted.get((a, b), 0)) for a in range(shards) for b in range(shards)])
        limit = F.element_at(table, (F.col("shard") * shards + F.col("to") + 1).cast("int"))
        labels = want.select(*NODE, "size", "n", F.when(asks & (F.col("bucket") < limit), F.col("to")).otherwise(
            F.col("shard")).alias("shard"))
    return labels


def _edges(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(group, chunk, group2, chunk2, w): distinct pairs of linked ids between nodes, in both directions."""
    a, b = (F.col(f"`{c}`") for c in links.columns[:2])
    pairs = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    one = rows.select(F.col("id").alias("a"), *NODE)
    two = rows.select(F.col("id").alias("b"), F.col("group").alias("group2"), F.col("chunk").alias("chunk2"))
    half = pairs.join(one, "a").join(two, "b").where("group <> group2").groupBy(*NODE, "group2", "chunk2").agg(F.count("*").alias("w"))
    half = written(half)
    return half.unionAll(half.select(F.col("group2"), F.col("chunk2"), F.col("group"), F.col("chunk"), "w"))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          group: Column | None = None, links: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard (null), group.

    ``group`` links documents; by default equal texts. ``links`` adds pairs: its first two columns are ids.
    """
    text = text_or_empty(F.col(text_col))
    size = (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 1).cast("long")
    key = group if group is not None else F.concat_ws("-", F.xxhash64(text).cast("string"), F.xxhash64(text, F.lit(7)).cast("string"))
    rows = docs.select(F.col(id_col).alias("id"), size.alias("size"), F.crc32(text.cast("binary")).alias("crc"),
                       F.coalesce(key.cast("string"), F.lit("null")).alias("group"))
    # a row's place within its group's chunks: by id, and by where it was read for repeated ids
    rows = reliable(rows.withColumn("place", F.xxhash64("id", F.monotonically_increasing_id())))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    even = max(1.0, total / shards)
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n")).where("n > 1")
    chunk_size, chunk_rows = even * CHUNK_SHARE, max(1.0, count / shards) * CHUNK_SHARE
    chunks = F.least(F.col("n"), F.greatest(F.ceil(F.col("size") / F.lit(chunk_size)), F.ceil(F.col("n") / F.lit(chunk_rows)))).cast("int")
    # fewer than 2 x shards / CHUNK_SHARE groups are larger than a chunk in bytes or rows, so their table is broadcast
    large = groups.where((F.col("size") > F.lit(chunk_size)) | (F.col("n") > F.lit(chunk_rows))).select("group", chunks.alias("chunks"))
    # a group's rows are dealt by (group, part), so no task gets a large group whole
    rows = rows.join(F.broadcast(large), "group", "left").withColumn("part", F.coalesce(F.pmod("place", F.col("chunks")), F.lit(0)).cast("int"))
    small = groups.join(F.broadcast(large), "group", "left_anti").select("group", F.lit(0).alias("part"), F.lit(True).alias("several"))
    chunk = F.when(F.col("chunks").isNotNull(), F.col("part")).otherwise(F.col("place"))
    rows = reliable(rows.join(small, ["group", "part"], "left").withColumn("chunk", chunk.cast("long"))
                    .withColumn("near", F.col("chunks").isNotNull() | F.col("several").isNotNull())
                    .select("id", "size", "crc", "group", "place", "chunk", "near"))
    edges = _edges(rows, links) if links is not None else None
    nodes = rows.groupBy(*NODE).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("near").alias("near"))
    if edges is not None:
        nodes = nodes.join(edges.select(*NODE).distinct().withColumn("linked", F.lit(True)), NODE, "left").withColumn(
            "near", F.col("near") | F.col("linked").isNotNull())
    nodes = written(nodes.where("near").select(*NODE, "size", "n"))
    bound = nodes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] / shards
    labels = propagate(nodes, shards, max(even * FILL, bound * SLACK), edges, rounds)
    load = _totals(labels, "shard", "size", shards)
    known = labels.select(*NODE, "shard")
    placed = reliable(rows.join(known, NODE, "left").select("id", "size", "crc", "group", "place", "shard"))
    free = placed.where("shard is null").drop("shard")
    # fewer than shards / LONG_SHARE of them are long; these go one by one to the emptiest shard
    long = {r["place"]: r["s"] for r in free.where(F.col("size") > F.lit(even * LONG_SHARE)).groupBy("place").agg(F.sum("size").alias("s")).collect()}
    first = _by_room(long, load)
    if first:
        table = F.broadcast(docs.sparkSession.createDataFrame(sorted(first.items()), "place long, shard int"))
        free = free.join(table, "place", "left")
        sizes = _totals(free.where("shard is not null"), "shard", "size", shards)
        placed = placed.where("shard is not null").unionByName(free.where("shard is not null").select(*placed.columns))
        free, load = free.where("shard is null").drop("shard"), [x + y for x, y in zip(load, sizes)]
    else:
        placed = placed.where("shard is not null")
    alone = _on_line(free, F.col("place"), [max(0.0, even - x) for x in load])
    out = _slots(placed.unionByName(alone), shards, count)
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"), "group")


def _by_room(sizes: dict[int, int], load: list[int]) -> dict[int, int]:
    """The shard of each place, largest first, each time the one with the least load."""
    heap, out = [(x, i) for i, x in enumerate(load)], {}
    heapq.heapify(heap)
    for place, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        x, i = heap[0]
        heapq.heapreplace(heap, (x + size, i))
        out[place] = i
    return out


def _cuts(alone: DataFrame, room: list[float], cells: int = 4096) -> list[int]:
    """Ends of the shards' stretches on the line of 2 ** 20 places, from the sizes of ``cells`` cells of it."""
    width = (1 << 20) // cells
    got = {r["c"]: int(r["s"]) for r in alone.groupBy(F.floor(F.col("line") / width).alias("c")).agg(F.sum("size").alias("s")).collect()}
    total = sum(got.values())
    scale = total / (sum(room) or 1.0)
    ends, c, done, want = [], 0, 0.0, 0.0
    for r in room:
        want += r * scale
        while c < cells and done + got.get(c, 0) <= want:
            done += got.get(c, 0)
            c += 1
        part = (want - done) / got[c] if c < cells and got.get(c) else 0.0
        ends.append(int(c * width + max(0.0, min(1.0, part)) * width))
    return ends


def _slots(rows: DataFrame, shards: int, count: int) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps, in buckets of about ``SLOT_ROWS`` rows."""
    buckets = max(1, -(-count // (shards * SLOT_ROWS)) * 2)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("place", F.lit(9)), F.lit(buckets)).cast("int"))
    filled = rows.groupBy("shard", "bucket").agg(F.count("*").alias("c"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = filled.withColumn("first", F.coalesce(F.sum("c").over(before), F.lit(0))).select("shard", "bucket", "first")
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("place", "id", "group"))
    return rows.withColumn("at", place).join(first, ["shard", "bucket"]).withColumn("slot", (F.col("first") + F.col("at") - 1).cast("long"))


def cut_edges(sharded: DataFrame) -> DataFrame:
    """One row: linked documents (by ``group``), and those that don't share their group's main shard."""
    per = sharded.groupBy("group", "shard").agg(F.count("*").alias("n"))
    whole = per.groupBy("group").agg(F.sum("n").alias("n"), F.max("n").alias("most")).where("n > 1")
    return whole.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("linked"), F.coalesce(F.sum(F.col("n") - F.col("most")), F.lit(0)).alias("away"))


def cut_links(sharded: DataFrame, links: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row: distinct pairs of linked documents (``links``: two columns of ids), and those in different shards."""
    a, b = (F.col(f"`{c}`") for c in links.columns[:2])
    pairs = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    one, two = (sharded.select(F.col(id_col).alias(c), F.col("shard").alias(f"s{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").agg(F.count("*").alias("links"), F.count_if(F.col("sa") != F.col("sb")).alias("cut"))
