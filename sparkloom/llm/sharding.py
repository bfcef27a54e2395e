"""Sharding by balanced label propagation.

Documents with equal texts are linked; an edge is cut where its two documents lie in different shards. Every document
starts with a label, a shard, that its hash names. What its neighbours vote for is counted a group: how many documents
of it lie in which shard. In each round, a group's documents move towards the shard where most of the others are and
where the quota leaves room for those that come; where there is no such shard, towards the roomiest. Movers ask for room
together and are granted it in an order by hash, so that a shard never takes more than its quota; who is refused votes
again in the next round. Each move joins more of a group than it parts, so cut edges only fall, and rounds end when
none can.

Links are never listed: counts of (group, shard), at most one a shard, carry the same votes. Groups that are a large part
of a shard, few by that bound, are taken first, the largest first, and fill whole shards where they exceed one.

Sizes. A document larger than an even share has a shard of its own, and the quota is the even share of all others in the
other shards. Unlinked documents fill what room is left along a line of bytes, the large ones first and spread over all
shards, then the small ones, so that a shard's error is about a small document.

Defined results: a null text has size 8 and links with other nulls and with nothing else; an id that repeats is placed
once a row; rows without an id are told apart by their place in the files; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sparkloom.llm.common import attach, byte_length, materialize, passing_tables, row_name

LANES = 1024
#: A group of more than this part of a quota is placed by itself: there are at most so many times the shards of them.
LARGE_PART = 64
#: An unlinked document of more than this part of a quota is laid out before the others.
FIRST_PART = 1024
KEY = ["h1", "text_crc32", "size"]
#: Places don't depend on how the input is split, unless rows are alike in id and text.
ORDER = ["doc_id", "name", "row"]


def quotas(largest: list[int], total: int, shards: int) -> tuple[list[int], int]:
    """Sizes of the documents that get shards of their own, and the even share of the rest in the other shards."""
    own: list[int] = []
    for size in sorted(largest, reverse=True):
        if len(own) == shards - 1 or size * (shards - len(own)) <= total:
            break
        own.append(size)
        total -= size
    return own, -(-total // (shards - len(own)))


def _fill(room: list[int], at: Column) -> Column:
    """Shard in whose stretch of the line of free bytes ``at`` lies."""
    edge, shard = 0, F.lit(max(s for s, r in enumerate(room) if r > 0 or s == len(room) - 1))
    edges = []
    for s, r in enumerate(room):
        edge += max(0, r)
        edges.append((edge, s))
    for edge, s in reversed([e for e, r in zip(edges, room) if r > 0][:-1]):
        shard = F.when(at < F.lit(float(edge)), F.lit(s)).otherwise(shard)
    return shard.cast("int")


def _loads(df: DataFrame, shards: int, size: str = "size") -> list[int]:
    """Bytes a shard: ``shards`` numbers come to the driver."""
    found = {r["shard"]: int(r["b"] or 0) for r in df.groupBy("shard").agg(F.sum(size).alias("b")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _lane(name: str) -> Column:
    return F.pmod(F.xxhash64("name", F.lit(name)), F.lit(LANES)).cast("int")


def place_large(groups: list[tuple[int, int, list[int]]], room: list[int]) -> list[list[tuple[int, int]]]:
    """(shard, documents) of each group (size of a document, documents, documents a shard at the start), largest first.

    A group goes where most of it is and all of it fits, else where all of it fits; one that fits nowhere fills shards,
    those with the most room first. Takes what it uses from ``room``; what finds none is left to the line.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in groups]
    for k in sorted(range(len(groups)), key=lambda k: (-groups[k][0] * groups[k][1], k)):
        size, n, votes = groups[k]
        fits = [s for s, r in enumerate(room) if r >= size * n]
        while n:
            if fits:
                s = max(fits, key=lambda s: (votes[s], room[s], -s))
                take = n
            else:
                s = max(range(len(room)), key=lambda s: (room[s], -s))
                take = min(n, max(0, room[s]) // size)
                if not take:
                    break
            out[k].append((s, take))
            room[s] -= take * size
            n -= take
            fits = [s for s, r in enumerate(room) if r >= size * n]
    return out


def shard_documents(docs: DataFrame, *, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``bytes``)."""
    with passing_tables() as kept:
        final = materialize(_placed(docs, shards, id_col, text_col), "final", kept)
    return _slots(final).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _placed(docs: DataFrame, shards: int, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    base = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (byte_length(text) + 8).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
            F.xxhash64(F.coalesce(text, F.lit("")), text.isNull()).alias("h1"),
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col(id_col).cast("string"), row_name(docs)).alias("name"),
        ).withColumn("name", F.xxhash64("name", "h1")),
        "sizes",
    )
    columns = ["doc_id", *KEY, "name", "row"]
    total, rows = base.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not rows:
        return base.select(*columns, F.lit(0).alias("shard"))
    largest = [(r["size"], r["row"]) for r in base.orderBy(F.desc("size"), *ORDER).select("size", "row").limit(shards).collect()]
    own, quota = quotas([s for s, _ in largest], int(total), shards)
    alone = {row: s for s, (_, row) in enumerate(largest[: len(own)])}
    placed = base.where(F.col("row").isin(list(alone))).withColumn("shard", F.element_at(F.create_map(*[F.lit(x) for kv in alone.items() for x in kv]), F.col("row"))) if alone else None
    if alone:
        base = base.where(~F.col("row").isin(list(alone)))
    room = [0] * len(own) + [quota] * (shards - len(own))

    linked = materialize(base.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "linked")
    nodes = materialize(attach(base, linked, KEY, "name"), "nodes")
    homes = _homes(nodes.where("n IS NOT NULL"), linked, quota, room)
    if homes is not None:
        homes = materialize(homes, "homes")
        settled = materialize(_members(nodes.where("n IS NOT NULL"), homes), "settled")
        fixed = settled.where("shard IS NOT NULL").select(*columns, "shard")
        placed = fixed if placed is None else placed.unionByName(fixed)
        free = nodes.where("n IS NULL").select(*columns).unionByName(settled.where("shard IS NULL").select(*columns))
    else:
        free = nodes.select(*columns)
    free = free.withColumn("lane", _lane("line"))
    room = [r - x for r, x in zip([0] * len(own) + [quota] * (shards - len(own)), _loads(placed.where(F.col("shard") >= len(own)), shards))] if placed is not None else room
    # large ones first: spread in proportion to the room, so that every shard keeps some for the small ones
    bound = quota // FIRST_PART
    first = free.where(F.col("size") > bound)
    bytes_first = int(first.agg(F.sum("size")).first()[0] or 0)
    parts = [] if placed is None else [placed]
    if bytes_first:
        laid = materialize(_along(first, room, sum(max(0, r) for r in room) / bytes_first).select(*columns, "shard"), "large")
        parts.append(laid)
        room = [r - x for r, x in zip(room, _loads(laid, shards))]
    parts.append(_along(free.where(F.col("size") <= bound), room, 1.0).select(*columns, "shard"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _along(free: DataFrame, room: list[int], scale: float) -> DataFrame:
    """Rows along the line of free bytes, each at the middle of its own; the line is stretched by ``scale``."""
    ahead = F.coalesce(F.sum("b").over(Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = free.groupBy("lane").agg(F.sum("size").alias("b")).select("lane", ahead.alias("ahead"))  # one row a lane
    within = Window.partitionBy("lane").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    line = free.withColumn("upto", F.sum("size").over(within)).join(F.broadcast(heads), "lane")
    return line.withColumn("shard", _fill(room, (F.col("ahead") + F.col("upto") - F.col("size") / 2) * F.lit(float(scale))))


def _start(room: list[int]) -> Column:
    """The shard that a document's hash names, in proportion to the rooms."""
    return _fill(room, F.pmod(F.xxhash64("name", F.lit("start")), F.lit(2**30)) / F.lit(2**30) * F.lit(float(sum(max(0, r) for r in room))))


def _homes(nodes: DataFrame, linked: DataFrame, quota: int, room: list[int]) -> DataFrame | None:
    """KEY and places (array of documents, shard) of every group of linked documents; places may hold fewer than all.

    ``room`` is used up as groups settle.
    """
    shards = len(room)
    wide = F.col("n") * F.col("size") > quota // LARGE_PART
    large = sorted(tuple(r) for r in linked.where(wide).select(*KEY, "n").collect())  # at most LARGE_PART a shard
    schema = StructType([*(StructField(k, LongType()) for k in KEY), StructField("places", ArrayType(StructType([StructField("n", LongType()), StructField("shard", IntegerType())])))])
    homes = None
    if large:
        votes: dict[tuple, list[int]] = {g[:3]: [0] * shards for g in large}
        for r in nodes.where(wide).groupBy(*KEY, _start(room).alias("shard")).agg(F.count(F.lit(1)).alias("m")).collect():
            votes[r["h1"], r["text_crc32"], r["size"]][r["shard"]] = r["m"]
        found = place_large([(g[2], g[3], votes[g[:3]]) for g in large], room)
        homes = nodes.sparkSession.createDataFrame([(*g[:3], [(m, s) for s, m in places]) for g, places in zip(large, found)], schema)
    small = nodes.where(~wide)
    cells = small.groupBy(*KEY, _start(room).alias("shard")).agg(F.count(F.lit(1)).alias("m"))
    state = materialize(cells.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct(F.col("m").alias("n"), "shard"))).alias("places")), "labels")
    while True:
        loads = _loads(state.select(F.explode("places").alias("p"), "size").select("p.shard", (F.col("p.n") * F.col("size")).alias("b")), shards, "b")
        moved = _round(state, [r - x for r, x in zip(room, loads)])
        if moved is None:
            break
        state = materialize(moved, "labels")
    state = _within(state, room, loads)
    return state if homes is None else homes.unionByName(state)


def _round(state: DataFrame, room: list[int]) -> DataFrame | None:
    """One round of propagation: each parted group's wish, granted within the rooms. None if nothing can move."""
    rooms = F.array(*[F.lit(max(0, r)) for r in room])
    roomiest = room.index(max(room))
    whole = F.aggregate("places", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    comes = lambda x: (F.col("whole") - x["n"]) * F.col("size")
    fitting = F.filter("places", lambda x: F.element_at(rooms, x["shard"] + 1) >= comes(x))
    heaviest = F.array_max(F.transform(fitting, lambda x: F.struct(x["n"].alias("n"), (-x["shard"]).alias("s"))))
    parted = state.where(F.size("places") > 1).withColumn("whole", whole).withColumn("top", heaviest)
    elsewhere = F.when(F.col("whole") * F.col("size") <= F.lit(max(0, room[roomiest])), F.lit(roomiest))
    wished = parted.select(
        *KEY, F.coalesce(-F.col("top.s"), elsewhere).alias("wish"), "whole", ((F.col("whole") - F.coalesce("top.n", F.lit(0).cast("long"))) * F.col("size")).alias("b"), F.pmod(F.xxhash64(*KEY, F.lit("turn")), F.lit(LANES)).cast("int").alias("turn")
    ).where("wish IS NOT NULL")
    upto = F.sum("b").over(Window.partitionBy("wish").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0))
    asked = wished.groupBy("wish", "turn").agg(F.sum("b").alias("b")).withColumn("upto", upto)
    granted = asked.where(F.col("upto") <= F.element_at(rooms, F.col("wish") + 1)).select("wish", "turn")  # LANES rows a shard at most
    moves = materialize(wished.join(F.broadcast(granted), ["wish", "turn"]).select(*KEY, "wish", "whole"), "moves")
    if moves.isEmpty():
        return None
    places = F.when(F.col("wish").isNull(), F.col("places")).otherwise(F.array(F.struct(F.col("whole").alias("n"), F.col("wish").alias("shard"))))
    return state.join(moves, KEY, "left").select(*KEY, places.alias("places"))


def _within(state: DataFrame, room: list[int], loads: list[int]) -> DataFrame:
    """What hash labels put into a shard beyond its room, and no round could move, loses its place there."""
    over = [s for s, (r, x) in enumerate(zip(room, loads)) if x > r]
    if not over:
        return state
    rooms = F.array(*[F.lit(max(0, r)) for r in room])
    each = state.select(*KEY, F.explode("places").alias("p")).select(*KEY, "p.n", "p.shard").withColumn("turn", F.pmod(F.xxhash64(*KEY, F.lit("turn")), F.lit(LANES)).cast("int"))
    upto = F.sum("b").over(Window.partitionBy("shard").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0))
    beyond = each.groupBy("shard", "turn").agg(F.sum(F.col("n") * F.col("size")).alias("b")).withColumn("upto", upto).where(F.col("upto") > F.element_at(rooms, F.col("shard") + 1)).select("shard", "turn")
    return each.join(F.broadcast(beyond), ["shard", "turn"], "left_anti").groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("n", "shard"))).alias("places"))


def _members(nodes: DataFrame, homes: DataFrame) -> DataFrame:
    """Linked documents with their shard (null: none was left): by rank in the group, counted by lanes first."""
    laned = nodes.drop("n").withColumn("lane", _lane("rank"))
    ahead = F.coalesce(F.sum("m").over(Window.partitionBy(*KEY).orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = F.transform(F.sequence(F.lit(1), F.size("places")), lambda k: F.struct(F.aggregate(F.slice("places", 1, k), F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("upto"), F.element_at("places", k)["shard"].alias("shard")))
    bounds = homes.where(F.size("places") > 0).select(*KEY, upto.alias("upto"))
    heads = laned.groupBy(*KEY, "lane").agg(F.count(F.lit(1)).alias("m")).withColumn("ahead", ahead).join(bounds, KEY, "left").drop("m")
    place = F.col("ahead") + F.row_number().over(Window.partitionBy(*KEY, "lane").orderBy(*ORDER))
    ranked = laned.join(heads, [*KEY, "lane"]).withColumn("place", place)
    return ranked.withColumn("shard", F.get(F.filter("upto", lambda x: x["upto"] >= F.col("place")), 0)["shard"]).drop("upto", "ahead", "place", "lane")


def _slots(final: DataFrame) -> DataFrame:
    """Gapless places from 0 within a shard, counted by (shard, lane) first, so that no task holds a whole shard."""
    laned = final.withColumn("lane", _lane("slot"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = laned.groupBy("shard", "lane").agg(F.count(F.lit(1)).alias("n")).select("shard", "lane", ahead.alias("ahead"))
    place = F.row_number().over(Window.partitionBy("shard", "lane").orderBy(*ORDER))
    return laned.join(heads, ["shard", "lane"]).withColumn("slot", (F.col("ahead") + place - 1).cast("long"))


def cut_edges(placed: DataFrame) -> DataFrame:
    """One row: linked pairs (of equal text_crc32 and size) and how many of them lie in different shards. Counts, no pairs."""
    cells = placed.groupBy("text_crc32", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
    pairs = lambda n: n.cast("decimal(38,0)") * (n - 1) / 2
    groups = cells.groupBy("text_crc32", "size").agg(F.sum("n").alias("n"), F.sum(pairs(F.col("n"))).alias("joined"))
    return groups.agg(F.sum(pairs(F.col("n"))).cast("long").alias("edges"), F.sum(pairs(F.col("n")) - F.col("joined")).cast("long").alias("cut"))
