"""Near-duplicates by SimHash, verified and completed: all pairs of texts whose shingle sets have a Jaccard similarity of
at least 0.8.

SimHash comes first: fingerprints of the sets meet in op5's tables, and what lies within its reach is verified on whole
sets. Similar texts may lie further apart than any reach that can be searched, so the pairs that these links don't connect
are looked for by prefix filtering, which finds them all: with every set sorted by one order over all shingles, two sets that are similar enough
share k shingles among the first n - ceil(0.8 n) + k of each (the first k that they have in common). Rows meet by those
shingles; sizes and places discard pairs that can't reach the similarity, and so do meetings fewer than k; the others are
verified on whole sets. Any order is exact; shingles that a sample finds
often come last, so that groups stay small. Large groups link neighbours by size first, and then only list pairs that
those links don't connect already. Texts with equal sets are one node throughout. Before whole sets are compared, parity
bitmaps are: two sets differ in at least as many shingles as their bitmaps do in bits.

Defined results: words are ASCII-lowered and parted by ASCII white space; a text of fewer words than a shingle is one
shingle, so null and wordless texts are equal; a component's id is its smallest id; an empty table gives no rows. Ids
must tell rows apart. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import attach, give_back, hold, materialize, passing_tables, spread
from sparkloom.llm.simhash import SEED, connected_components, majority, near_links

SHINGLE = 5
SIMILARITY = 0.8
#: Rows that are asked which shingles are frequent, and how many of those are remembered: they order, they don't cut.
SAMPLE_ROWS = 10_000
FREQUENT = 200_000
#: Shingles that two sets have to share in their prefixes, which are so much longer; chance meetings share one or two.
SHARED = 3
#: Groups of more rows link this many neighbours by size before their pairs are listed.
LARGE_GROUP, NEIGHBOURS = 32, 4
SLACK = 1e-9
BITS = 1024
#: Texts to verify are found by a broadcast of their ids up to this many, by a shuffle of the texts beyond.
BROADCAST_ROWS = 200_000


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - shingle + 1
    if n <= 1:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64).view(np.int64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n).view(np.int64))


def _least(n: np.ndarray | int, similarity: float) -> np.ndarray:
    return np.ceil(np.asarray(n) * similarity - SLACK).astype(np.int64)


def _shared(n: np.ndarray | int, similarity: float) -> np.ndarray:
    """Meetings that a pair needs whose smaller set has n shingles."""
    return np.minimum(SHARED, _least(n, similarity))


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)))


def signed(x: int) -> int:
    """The signed long of the same 64 bits."""
    return x - (1 << 64) if x >> 63 else x


def parity(own: np.ndarray) -> bytes:
    """Bitmap with a bit for each of BITS parts of the hashes, set where the set has an odd number of them."""
    return np.packbits(np.bincount(own.view(np.uint64) % np.uint64(BITS), minlength=BITS).astype(np.uint8) & 1).tobytes()


def _frequent(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that a sample has three times or more, ascending, and their counts."""
    rows = docs.count()
    part = min(1.0, SAMPLE_ROWS / max(1, rows))
    sample = docs.where(F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 20)) < F.lit(int(part * (1 << 20))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                sets = [shingle_set(t.as_py(), shingle) for t in batch.column(0)[at : at + 200]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets))], ["h"])

    counts = sample.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    found = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    h, n = (found.column(k).to_numpy().astype(np.int64) for k in ("h", "n"))
    order = np.argsort(h)
    return h[order], n[order]


def prefixes(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node (hash of the whole set), size (of the set), fp (its SimHash), bits (parity bitmap), prefix (first
    shingles in the common order). A set that a task has seen before is named without fp, bits and prefix."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hold("shingles")
        often, counts = frequent.value
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes, fps, bits, firsts = [], [], [], [], []
            for t in batch.column(1):
                own = shingle_set(t.as_py(), shingle)
                nodes.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                sizes.append(len(own))
                if nodes[-1] in seen:
                    fps.append(None)
                    bits.append(None)
                    firsts.append(own[:0])
                    continue
                seen.add(nodes[-1])
                fps.append(signed(majority(own.astype(">i8"))))
                bits.append(parity(own))
                if len(often):
                    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    own = own[np.argsort(np.where(often[at] == own, counts[at], 0), kind="stable")]
                firsts.append(own[: sizes[-1] - int(_least(sizes[-1], similarity)) + int(_shared(sizes[-1], similarity))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), pa.array(bits, pa.binary()), _lists(firsts)],
                ["doc_id", "node", "size", "fp", "bits", "prefix"],
            )
        give_back()

    return spread(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, size int, fp long, bits binary, prefix array<long>")


def _pairs(groups: tuple[np.ndarray, ...], similarity: float, reach: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Meetings (u, v, meetings needed) among rows sorted by (key, size), at most ``reach`` rows apart: one lag at a time."""
    key, node, size, pos, comp = groups
    at = np.arange(len(key))
    lag = 0
    while len(at):
        lag += 1
        at = at[(at + lag < len(key)) & (reach[at] >= lag)]
        other = at + lag
        # sizes ascend within a key: who is too small for this partner is too small for all later ones
        stays = (key[at] == key[other]) & (size[at] >= _least(size[other], similarity))
        at, other = at[stays], other[stays]
        # of the first SHARED common shingles this is the last at most
        overlap = SHARED - 1 + np.minimum(size[at] - pos[at], size[other] - pos[other])
        take = (overlap >= _least(size[at] + size[other], similarity / (1 + similarity))) & (comp[at] != comp[other])
        if take.any():
            yield node[at[take]], node[other[take]], _shared(size[at[take]], similarity)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of rows sorted by their first, cut between its values."""
    kept: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        kept.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        rows += batch.num_rows
        if rows < 1 << 16 or kept[0][0][0] == kept[-1][0][-1]:
            continue
        whole = tuple(map(np.concatenate, zip(*kept)))
        cut = int(np.flatnonzero(whole[0] != whole[0][-1])[-1]) + 1
        yield tuple(c[:cut] for c in whole)
        kept, rows = [tuple(c[cut:] for c in whole)], rows - cut
    if rows:
        yield tuple(map(np.concatenate, zip(*kept)))


def _counted(meetings: list[tuple[np.ndarray, ...]]) -> list[pa.Array]:
    """u, v, meetings needed, meetings of each pair."""
    if not meetings:
        return [pa.array(np.empty(0, np.int64)), pa.array(np.empty(0, np.int64)), pa.array(np.empty(0, np.int32)), pa.array(np.empty(0, np.int32))]
    u, v, needed = (np.concatenate(x) for x in zip(*meetings))
    low, high = np.minimum(u, v), np.maximum(u, v)
    order = np.lexsort((high, low))
    low, high, needed = low[order], high[order], needed[order]
    starts = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    n = np.diff(np.r_[starts, len(low)])
    return [pa.array(low[starts]), pa.array(high[starts]), pa.array(needed[starts].astype(np.int32)), pa.array(n.astype(np.int32))]


def _first_round(similarity: float):
    """Meetings in small groups and of neighbours in large ones (u, v, needed, n); the large ones' rows come out too (u, key, size, pos)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["u", "v", "needed", "n", "key", "size", "pos"]
        for columns in _grouped(batches):
            key, node, size, pos = columns
            first = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]  # a node once a key, whatever tasks saw it
            key, node, size, pos = (c[first] for c in columns)
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            count = np.repeat(np.diff(np.r_[starts, len(key)]), np.diff(np.r_[starts, len(key)]))
            large = count > LARGE_GROUP
            found = _counted(list(_pairs((key, node, size, pos, node), similarity, np.where(large, NEIGHBOURS, count))))
            no = lambda n, t: pa.nulls(n, t)
            n = len(found[0])
            yield pa.RecordBatch.from_arrays([*found, no(n, pa.int64()), no(n, pa.int32()), no(n, pa.int32())], names)
            if n := int(large.sum()):
                yield pa.RecordBatch.from_arrays([pa.array(node[large]), no(n, pa.int64()), no(n, pa.int32()), no(n, pa.int32()), pa.array(key[large]), pa.array(size[large]), pa.array(pos[large])], names)
        give_back()

    return run


def _second_round(similarity: float):
    """All meetings (u, v, needed, n) in large groups of those that no link connects so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _grouped(batches):
            for meetings in _pairs(groups, similarity, np.full(len(groups[0]), len(groups[0]))):
                yield pa.RecordBatch.from_arrays(_counted([meetings]), ["u", "v", "needed", "n"])

    return run


def _enough(meetings: DataFrame) -> DataFrame:
    return meetings.groupBy("u", "v").agg(F.max("needed").alias("needed"), F.sum("n").alias("n"))


def _verified(pairs: DataFrame, prints: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of the pairs that are similar enough, by their whole sets."""
    sketches = prints.where("bits IS NOT NULL").dropDuplicates(["node"])
    side = lambda n: sketches.select(F.col("node").alias(n), F.col("size").alias("size_" + n), F.col("bits").alias("bits_" + n))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            total = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for k in (4, 5))
            apart = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
            stays = apart <= total - 2 * _least(total, similarity / (1 + similarity))
            yield batch.select(["u", "v"]).filter(pa.array(stays))

    met = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "size_u", "size_v", "bits_u", "bits_v")
    pairs = materialize(met.mapInArrow(near, "u long, v long"), "near")
    needed = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    owners = materialize(prints.select("doc_id", "node").join(needed, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "owners")
    texts = docs.join(F.broadcast(owners) if owners.count() <= BROADCAST_ROWS else owners, "doc_id").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([shingle_set(t.as_py(), shingle) for t in part.column(1)])], ["node", "own"])

    sets = materialize(texts.mapInArrow(run, "node long, own array<long>"), "sets")
    left, right = sets.select(F.col("node").alias("u"), F.col("own").alias("a")), sets.select(F.col("node").alias("v"), F.col("own").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return pairs.join(left, "u").join(right, "v").where(common >= (F.size("a") + F.size("b") - common) * F.lit(similarity) - F.lit(SLACK)).select("u", "v")


def simhash_links(prints: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (u, v) of nodes whose fingerprints SimHash's tables bring together, those that are similar enough."""
    own = materialize(prints.where("fp IS NOT NULL").select("fp", "node").distinct(), "fps")
    first = materialize(own.groupBy("fp").agg(F.min("node").alias("node")), "first")
    side = lambda n: first.select(F.col("fp").alias("fp_" + n), F.col("node").alias(n))
    met = near_links(first.select("fp")).select(F.col("u").alias("fp_u"), F.col("v").alias("fp_v")).distinct()
    near = met.join(side("u"), "fp_u").join(side("v"), "fp_v").select("u", "v")
    equal = own.select("fp", F.col("node").alias("u")).join(first.select("fp", F.col("node").alias("v")), "fp").where("u <> v").select("u", "v")
    return _verified(materialize(near.unionByName(equal), "candidates"), prints, docs, shingle, similarity)


def _unconnected(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (u, v) of which no component has both."""
    side = lambda n: roots.select(F.col("node").alias(n), F.col("root").alias("root_" + n))
    both = pairs.join(side("u"), "u", "left").join(side("v"), "v", "left")
    return both.where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")


def similar_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, component_id: components of all pairs of rows whose shingle sets are similar enough."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    with passing_tables() as kept:
        prints = materialize(prefixes(source, shingle, similarity), "prefixes")
        found = materialize(simhash_links(prints, source, shingle, similarity), "simhash")
        known = connected_components(found)
        rows = prints.select("node", "size", F.posexplode("prefix").alias("pos", "key")).select("key", "node", "size", "pos")
        met = materialize(
            rows.repartition("key").sortWithinPartitions("key", "size", "node").mapInArrow(_first_round(similarity), "u long, v long, needed int, n int, key long, size int, pos int"), "met"
        )
        pairs = materialize(_enough(met.where("key IS NULL")), "pairs")
        more = _unconnected(pairs.where("n >= needed").select("u", "v"), known)
        links = materialize(found.unionByName(_verified(more, prints, source, shingle, similarity)), "links")
        large = met.where("key IS NOT NULL")
        if not large.isEmpty():
            roots = connected_components(links)
            joined = large.join(roots, F.col("u") == F.col("node"), "left").select("key", F.col("u").alias("node"), "size", "pos", F.coalesce("root", "u").alias("comp"))
            more = joined.repartition("key").sortWithinPartitions("key", "size", "node").mapInArrow(_second_round(similarity), "u long, v long, needed int, n int")
            # meetings in small groups count beside those in large ones
            more = materialize(_enough(more.unionByName(pairs.where("n < needed").select("u", "v", "needed", F.col("n").cast("int").alias("n")))).where("n >= needed").select("u", "v"), "pairs")
            links = links.unionByName(_verified(more, prints, source, shingle, similarity))
        roots = connected_components(links)
        lows = prints.groupBy("node").agg(F.min("doc_id").alias("low"))
        owned = lows.join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("node", "low", F.coalesce("root", "node").alias("root"))
        owned = materialize(owned, "owned", kept)
        nodes = materialize(prints.select("doc_id", "node"), "nodes", kept)
    components = owned.select("node", "root").join(owned.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("node", "component_id")
    return attach(nodes, components, ["node"], "doc_id").select("doc_id", "component_id")
