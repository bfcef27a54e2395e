"""SimHash near-duplicates: fingerprints, exact neighbour search with pivot distance tables, components.

Candidates: two 64-bit fingerprints at 3 or fewer differing bits agree on one of four 16-bit blocks, and on one of
four 12-bit parts of the other 48 bits; each of the 16 (block, part) tables therefore groups fingerprints by 28 bits.
In a group, distances to many reference fingerprints are tabulated once; a pair whose coordinates differ by more than
3 anywhere can't be within 3 bits (triangle inequality) and is discarded; survivors are verified. Groups emit a
spanning star of each linked set, never their pairs. Large groups are split again by further bits, which is exact too.

Defined results: a null or wordless text has fingerprint zero and links like any other; equal fingerprints always
link; repeated rows keep their rows; a component's id is its smallest document id, null ids never win over others; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import attach, drop_tables, hold, materialize, passing_tables, spread

SHINGLE = 3
REACH = 3
SEED = 42
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 24, dtype=np.uint64)
SMALL_GROUP = 1024
#: Fingerprints of one key that a task takes at once.
HOT_KEY = 1 << 18
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text's word shingles, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype=">u8", count=len(words) - shingle + 1))


def majority(h: np.ndarray) -> int:
    """The bits that over half of the hashes (big-endian) have."""
    n = len(h)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, HASHES_AT_ONCE):
        ones += np.unpackbits(h[i : i + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long)."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("simhash")
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return spread(source).mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp long")


def _roots(n: int, left: np.ndarray, right: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable, by repeated minimum over links and pointer jumping."""
    root = np.arange(n) if root is None else root
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while not np.array_equal(root, jumped := root[root]):
            root = jumped
        if np.array_equal(root, before):
            break
    return root


def _near(fps: np.ndarray, table: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in a small group. Ordered by the first pivot, a fingerprint's partners lie in a window of that distance."""
    order = np.argsort(table[:, 0], kind="stable")
    t, f = table[order], fps[order]
    ends = np.searchsorted(t[:, 0], t[:, 0] + reach, side="right")
    lefts, rights = [], []
    for i in range(len(f)):
        j = np.arange(i + 1, ends[i])
        if not len(j):
            continue
        j = j[np.abs(t[j, 1:] - t[i, 1:]).max(axis=1, initial=0) <= reach]
        j = j[np.bitwise_count(f[j] ^ f[i]) <= reach]
        if len(j):
            lefts.append(np.full(len(j), order[i]))
            rights.append(order[j])
    if not lefts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(lefts), np.concatenate(rights)


def linked_roots(fps: np.ndarray, reach: int = REACH) -> np.ndarray:
    """For distinct fingerprints, the index of the smallest member of each one's component within the group."""
    n = len(fps)
    if n < 2:
        return np.arange(n)
    varying = int(np.bitwise_or.reduce(fps) ^ np.bitwise_and.reduce(fps))
    bits = [b for b in range(64) if varying >> b & 1]
    if len(bits) <= reach:
        return np.zeros(n, np.int64)
    if n <= SMALL_GROUP:
        table = np.bitwise_count(fps[:, None] ^ PIVOTS).astype(np.int16)
        return _roots(n, *_near(fps, table, reach))
    root = np.arange(n)
    for k in range(reach + 1):  # one of reach + 1 parts of the varying bits agrees
        mask = np.uint64(sum(1 << b for b in bits[k :: reach + 1]))
        part = fps & mask
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]])
        lefts, rights = [], []
        for s, e in zip(starts, np.r_[starts[1:], n]):
            if e - s > 1:
                own = order[s:e]
                lefts.append(own)
                rights.append(own[linked_roots(fps[own], reach)])
        if lefts:
            root = _roots(n, np.concatenate(lefts), np.concatenate(rights), root)
    return root


def block_keys(fp: Column) -> Column:
    """The 16 table keys of a fingerprint: table number and 28 bits of it."""
    keys = []
    for i in range(4):
        block = F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
        low = F.lit(0).cast("long") if i == 0 else fp.bitwiseAND(F.lit((1 << 16 * i) - 1))
        high = F.lit(0).cast("long") if i == 3 else F.shiftrightunsigned(fp, 16 * (i + 1))
        rest = low.bitwiseOR(F.shiftleft(high, 16 * i))  # the other 48 bits
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((i * 4 + j) << 28).bitwiseOR(F.shiftleft(block, 12)).bitwiseOR(part))
    return F.array(*keys)


def other_keys(fp: Column) -> Column:
    """Keys by which rows of one of ``block_keys`` are cut further: every fourth bit instead of neighbouring ones."""
    keys = []
    for i in range(4):
        quarter = sum(1 << b for b in range(64) if b % 4 == i)
        for j in range(4):
            mask = quarter | sum(1 << b for b in range(64) if b % 4 != i and b // 4 % 4 == j)
            keys.append(F.xxhash64(F.lit(i * 4 + j), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))))
    return F.array(*keys)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key, in; spanning links, out. A key's rows may cross batches."""
    kept_key, kept_fp = np.empty(0, np.int64), np.empty(0, np.int64)

    def solve(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        ends = np.r_[starts[1:], len(keys)]
        us, vs = [], []
        many = ends - starts > 1
        for s, e in zip(starts[many], ends[many]):
            own = np.unique(fps[s:e].view(np.uint64))
            root = linked_roots(own)
            moved = root != np.arange(len(own))
            us.append(own[moved])
            vs.append(own[root[moved]])
        u, v = (np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64) for x in (us, vs))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        key = np.concatenate([kept_key, batch.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([kept_fp, batch.column(1).to_numpy(zero_copy_only=False)])
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        kept_key, kept_fp = key[cut:], fp[cut:]
        yield solve(key[:cut], fp[:cut])
    yield solve(kept_key, kept_fp)


def near_links(distinct: DataFrame, hot: int = HOT_KEY) -> DataFrame:
    """(u, v): links that connect all fingerprints (column fp, distinct) within reach of one another.

    Keys of more than ``hot`` fingerprints are few, since each has that many. Their groups are cut before they meet: two
    fingerprints within reach agree on one of four quarters of the bits, whatever else they agree on, and on one of four
    parts of the other three quarters, so a group's rows meet again under 16 longer keys of other bits.
    """
    keyed = distinct.select(F.explode(block_keys(F.col("fp"))).alias("key"), "fp").withColumn("more", F.lit(0).cast("long"))
    if distinct.count() > hot:  # else no key can have as many
        large = materialize(keyed.groupBy("key").count().where(F.col("count") > hot).select("key", F.lit(True).alias("large")), "hot")
        marked = attach(keyed, large, ["key"], "fp")
        cut = marked.where("large").select("key", "fp", F.explode(other_keys(F.col("fp"))).alias("more"))
        keyed = marked.where("large IS NULL").select("key", "fp", "more").unionByName(cut)
    return keyed.repartition("key", "more").select(F.xxhash64("key", "more").alias("key"), "fp").sortWithinPartitions("key").mapInArrow(_links, "u long, v long")


def connected_components(links: DataFrame, kept: set[str] | None = None) -> DataFrame:
    """(node, root) of every node of a link: large-star and small-star rounds until nothing changes.

    Rounds shuffle the links of the still open forest only, and are cut by a table in the shared folder; the last one's
    path is added to ``kept``. A node of many links meets one row of the other side, so that adaptive execution splits its
    partition where it is skewed.
    """
    with passing_tables() as last:
        edges = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges", last)

        def sign(e: DataFrame) -> tuple:
            return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

        seen = sign(edges)
        while seen[0]:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            lowest = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
            former = set(last)
            last.clear()
            edges = materialize(small.where("u <> v").distinct(), "edges", last)
            drop_tables(former)
            now = sign(edges)
            if now == seen:
                break
            seen = now
        if kept is not None:
            kept |= last
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    with passing_tables() as kept:
        prints = fingerprints(docs, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id())
        prints = materialize(prints, "prints", kept)  # written once: from here on a row's number is a fact
        distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
        roots = connected_components(near_links(distinct.select("fp")))
        owned = materialize(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "owned", kept)
    lows = owned.groupBy("root").agg(F.min("low").alias("component_id"))
    found = attach(prints, owned.select("fp", "root").join(lows, "root").select("fp", "component_id"), ["fp"], "row")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
