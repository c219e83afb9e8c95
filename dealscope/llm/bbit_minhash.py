"""Near-duplicates by b-bit MinHash.

A document's set of distinct word shingles gets 256 minima under multiplicative hashes. The
first 128 make 32 bands of four whole minima, whose keys put sets into buckets. Of every
minimum only four bits are kept, packed into 16 longs; the similarity of two sets is
estimated from the bit count of differing minima, corrected for the one in sixteen that agree
by chance. Pairs whose estimate is five standard deviations below the threshold or more are
dropped. The others are confirmed on the full sets, after a bound that is exact: a set also
has a bitmap with the parity of its shingles' hashes, and two bitmaps differ in no more bits
than the sets differ in shingles. So few sets that are not similar have to be compared whole.

A pair at the threshold of 0.8 shares no band with probability (1 - 0.8**4)**32 < 1e-7, and
is lost to the estimate with about the same one.

Only distinct sets are compared. First, the members of each bucket are compared with one hub
of it, which a ``groupBy`` finds, so a large group makes a linear number of pairs; a second
round does so with another hub for members that the first one has not put into one group. In
buckets that still hold several groups, the members outside the largest one are then compared
with all others, in blocks that are dealt over the cluster; of those, only pairs that the
estimate lets pass are emitted. So no link is lost to the size of a bucket, and none has a
cap. Groups between the rounds only save comparisons: components are found at the end, from
all confirmed links.

Defined results: documents without words have an empty set and are linked with nothing; fewer
words than a shingle make one shingle; very long texts are taken whole; copies of a set are
one set; repeated rows each get a row; a null doc_id never is a component's id unless all are
null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, bytes_of, written
from .simhash import components, shingle_hashes

SHINGLE = 4
PERCENT = 80
MINIMA, BANDS, BAND_ROWS = 256, 32, 4
KEPT_BITS = 4
DEVIATIONS = 5.0

_WORDS = MINIMA * KEPT_BITS // 64
_BLOCK = 512  # members of a block
_SET_ROWS = 256
_NIBBLE = 0x1111111111111111

_numbers = np.random.default_rng(12)
_FLIP = _numbers.integers(0, 1 << 32, (MINIMA, 1), np.uint32)
_FACTOR = _numbers.integers(0, 1 << 32, (MINIMA, 1), np.uint32) | np.uint32(1)
_BAND_FACTOR = _numbers.integers(0, 1 << 63, (BANDS, BAND_ROWS), np.uint64) | np.uint64(1)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    return np.unique(shingle_hashes(text, size))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least of each hash function's values."""
    short = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 2048):
        mixed = short[None, at : at + 2048] ^ _FLIP
        mixed *= _FACTOR
        np.minimum(least, mixed.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key per band for each row of minima."""
    rows = least[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    mixed = (rows + np.uint64(1)) * _BAND_FACTOR
    mixed ^= mixed >> np.uint64(29)
    keys = (mixed * _BAND_FACTOR[::-1]).sum(axis=2, dtype=np.uint64)
    return keys ^ (keys >> np.uint64(32))


def signatures(least: np.ndarray) -> np.ndarray:
    """Low bits of the mixed minima, packed into longs, for each row."""
    mixed = (least ^ (least >> np.uint32(16))) * np.uint32(0x7FEB352D)
    low = ((mixed >> np.uint32(15)) & np.uint32(15)).astype(np.uint8)
    packed = low[:, ::2] | (low[:, 1::2] << 4)
    return np.ascontiguousarray(packed).view("<u8")


def parity_map(shingles: np.ndarray) -> bytes:
    """For each value of the low bits, whether an odd number of hashes has it.

    There are four bits or more for each shingle, so that few of them share one.
    """
    bits = max(8, (4 * len(shingles) - 1).bit_length())
    low = (shingles & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.packbits(np.bincount(low, minlength=1 << bits) & 1 > 0, bitorder="little").tobytes()


def too_different(x: bytes, y: bytes, sizes: int, percent: int = PERCENT) -> bool:
    """Whether the bitmaps of sets with ``sizes`` shingles in all prove them dissimilar."""
    a, b = (np.frombuffer(z, np.uint8) for z in sorted((x, y), key=len))
    while len(a) < len(b):  # with a bit less, the halves fall on each other
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    odd = int(np.bitwise_count((a ^ b).view("<u8")).sum())
    return odd * (100 + percent) > (100 - percent) * sizes


def most_differing(percent: int = PERCENT) -> int:
    """Differing minima up to which a pair may have that similarity."""
    chance = 1 / (1 << KEPT_BITS)
    agree = percent / 100 + (1 - percent / 100) * chance
    spread = math.sqrt(agree * (1 - agree) * MINIMA)
    return math.floor(MINIMA * (1 - agree) + DEVIATIONS * spread)


def estimate(differing: int) -> float:
    """Similarity from the number of differing minima, without agreement by chance."""
    chance = 1 / (1 << KEPT_BITS)
    return (1 - differing / MINIMA - chance) / (1 - chance)


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing minima of signatures, over the last axis."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    x &= np.uint64(_NIBBLE)
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def _differing_columns(a: str, b: str) -> Column:
    total = F.lit(0)
    for k in range(_WORDS):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.bit_count(x.bitwiseAND(F.lit(_NIBBLE)))
    return total


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def minhash_sets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, text_hash, key, n_shingles, bands, signature, parity).

    The key, the bitmap and the bands are null or empty for empty sets.
    """
    made = (
        T.StructType()
        .add("text_hash", "long")
        .add("key", "binary")
        .add("n_shingles", "long")
        .add("bands", T.ArrayType(T.LongType()))
        .add("signature", T.ArrayType(T.LongType()))
        .add("parity", "binary")
    )
    schema = T.StructType([docs.schema[doc_id], *made])
    names = [f.name for f in schema]

    def lists(values: np.ndarray, there: np.ndarray) -> pa.Array:
        width = values.shape[1]
        offsets = np.r_[0, np.cumsum(np.where(there, width, 0))].astype(np.int32)
        return pa.ListArray.from_arrays(offsets, values.ravel().view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, rows, maps = [], [], [], []
            for x in bytes_of(batch.column(2)):
                found = shingle_set(x, shingle)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                maps.append(parity_map(found) if len(found) else None)
                if len(found):
                    rows.append(minima(found))
            least = np.stack(rows) if rows else np.empty((0, MINIMA), np.uint32)
            there = np.array(sizes) > 0
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    lists(band_keys(least), there),
                    lists(signatures(least), there),
                    pa.array(maps, pa.binary()),
                ],
                names=names,
            )

    column = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`"), F.xxhash64(column), column).mapInArrow(run, schema)


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(bucket, node) of the buckets that two or more sets are in."""
    members = nodes.select(F.explode("bands").alias("bucket"), "node")
    counts = members.groupBy("bucket").agg(F.count("*").alias("n"))
    return members.join(counts.where("n > 1").select("bucket"), "bucket")


def _hub_pairs(named: DataFrame, turn: int) -> DataFrame:
    """(a, b): each bucket's hub of this round, and its members that are in other groups."""
    drawn = F.xxhash64("node", "bucket", F.lit(turn)) if turn else F.col("node")
    hubs = named.groupBy("bucket").agg(
        F.min(F.struct(drawn.alias("drawn"), F.col("node").alias("hub"), "root")).alias("least"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    hubs = hubs.where("low <> high").select(
        "bucket", F.col("least.hub").alias("hub"), F.col("least.root").alias("hub_root")
    )
    return _ordered(named.join(hubs, "bucket").where("root <> hub_root"), "node", "hub")


def regrouped(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root), with groups joined along links, a step or two at a time.

    Nodes of one root are connected; connected nodes may have several roots still.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    other = groups.select(F.col("node").alias("other"), F.col("root").alias("other_root"))
    joined = both.join(groups, "node").join(other, "other")
    low = joined.groupBy("root").agg(F.min("other_root").alias("low")).where("low < root")
    low = written(low, "lower_roots")
    then = low.select(F.col("root").alias("low"), F.col("low").alias("lowest"))
    low = low.join(then, "low", "left").select("root", F.coalesce("lowest", "low").alias("low"))
    return groups.join(low, "root", "left").select("node", F.coalesce("low", "root").alias("root"))


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def estimated(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) that may have the similarity, by size, signature and bitmap."""
    kept = nodes.select("node", "n_shingles", "signature", "parity")
    left, right = (kept.toDF(n, f"size_{n}", f"sig_{n}", f"map_{n}") for n in "ab")
    both = pairs.join(left, "a").join(right, "b")
    near = _differing_columns("sig_a", "sig_b") <= most_differing(percent)
    fitting = both.where(_sizes_fit(F.col("size_a"), F.col("size_b"), percent) & near)
    sizes = (F.col("size_a") + F.col("size_b")).alias("sizes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)
            stay = pa.array([not too_different(*row, percent) for row in rows], pa.bool_())
            named = pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"])
            yield named.filter(stay)

    return fitting.select("a", "b", "map_a", "map_b", sizes).mapInArrow(run, "a long, b long")


def confirmed(
    pairs: DataFrame,
    nodes: DataFrame,
    docs: DataFrame,
    doc_id: str,
    text: str,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """The (a, b), a stored table, whose full sets have the similarity; written."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = nodes.join(wanted, "node", "left_semi").select("node", "id", "text_hash")
    texts = docs.select(
        F.col(f"`{doc_id}`").alias("doc"),
        F.xxhash64(F.col(f"`{text}`")).alias("hash"),
        F.col(f"`{text}`").alias("text"),
    )
    same = F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash"))
    found = texts.join(chosen, same).select("node", "text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x, shingle).tobytes() for x in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = (np.frombuffer(p, np.uint64) for p in pair)
                common = len(np.intersect1d(x, y, assume_unique=True))
                near.append(100 * common >= percent * (len(x) + len(y) - common))
            both = pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"])
            yield both.filter(pa.array(near, pa.bool_()))

    with arrow_rows(docs.sparkSession, _SET_ROWS):
        sets = found.mapInArrow(shingled, "node long, shingles binary")
        # Rows that repeat an id and a text give a set several times.
        sets = written(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")
        left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return written(both.mapInArrow(compare, "a long, b long"), "confirmed")


def block_pairs(named: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): all pairs of one bucket in different groups that the estimate lets pass.

    The members of a bucket are dealt to blocks by a hash; those outside its largest group go
    to every block of it, where they are compared with the block's own members.
    """
    counts = named.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    shape = counts.groupBy("bucket").agg(
        F.max(F.struct("n", "root"))["root"].alias("main"),
        F.ceil(F.sum("n") / _BLOCK).alias("blocks"),
        F.count("*").alias("groups"),
    )
    rows = named.join(shape.where("groups > 1"), "bucket").join(
        nodes.select("node", "n_shingles", "signature", "parity"), "node"
    )
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks"))
    columns = ["bucket", "block", "probe", "node", "root", "n_shingles", "signature", "parity"]
    members = rows.withColumn("block", own).withColumn("probe", F.lit(False))
    probes = (
        rows.where("root <> main")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("probe", F.lit(True))
    )
    dealt = members.select(*columns).unionByName(probes.select(*columns))
    most = most_differing(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, probes = None, [], None

        def joined(parts: list) -> tuple[np.ndarray, ...]:
            return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

        def compare(part: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            node, root, size, sig, maps = joined(members)
            for i in range(len(part[0])):
                low, high = np.minimum(size, part[2][i]), np.maximum(size, part[2][i])
                hit = (root != part[1][i]) & (100 * low >= percent * high)
                hit[hit] = _differing(sig[hit], part[3][i]) <= most
                near = [
                    k for k in np.flatnonzero(hit).tolist()
                    if not too_different(maps[k], part[4][i], int(size[k] + part[2][i]), percent)
                ]
                if near:
                    other = node[near]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.minimum(other, part[0][i])),
                            pa.array(np.maximum(other, part[0][i])),
                        ],
                        names=["a", "b"],
                    )

        for batch in batches:
            bucket, block, probe, node, root, size = (
                batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)
            )
            sig = batch.column(6).flatten().to_numpy().view(np.uint64).reshape(-1, _WORDS)
            maps = np.array([*batch.column(7).to_pylist(), None], object)[:-1]
            change = np.r_[True, (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])
                           | (probe[1:] != probe[:-1]), True]
            edges = np.flatnonzero(change).tolist()
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                if (bucket[low], block[low]) != now:
                    now, members = (bucket[low], block[low]), []
                part = tuple(x[low:high] for x in (node, root, size, sig, maps))
                if probe[low]:
                    if members:
                        yield from compare(part)
                else:
                    members.append(part)

    ordered = dealt.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "probe")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def cluster(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    identity = F.col(f"`{doc_id}`")
    sets = written(minhash_sets(docs, doc_id, text, shingle), "minhash_sets")
    first = F.min(F.struct(identity.alias("id"), "text_hash", "n_shingles"))
    known = sets.where(F.col("key").isNotNull())
    chosen = known.groupBy("key").agg(
        first.alias("row"),
        F.min(identity).alias("least_id"),
        F.any_value("bands").alias("bands"),
        F.any_value("signature").alias("signature"),
        F.any_value("parity").alias("parity"),
    )
    nodes = written(
        chosen.select(
            F.monotonically_increasing_id().alias("node"), "key", "row.*", "least_id", "bands",
            "signature", "parity",
        ),
        "distinct_sets",
    )
    buckets = written(bucket_members(nodes), "buckets")

    def link(pairs: DataFrame) -> DataFrame:
        near = written(estimated(pairs, nodes, percent), "estimated")
        return confirmed(near, nodes, docs, doc_id, text, shingle, percent)

    groups = buckets.select("node", F.col("node").alias("root")).distinct()
    links: list[DataFrame] = []
    for turn in range(2):
        named = buckets.join(groups, "node")
        links.append(link(_hub_pairs(named, turn)))
        groups = written(regrouped(groups, links[-1]), "groups")
    named = buckets.join(groups, "node")
    rest = written(block_pairs(named, nodes, percent), "block_pairs")
    links.append(confirmed(rest, nodes, docs, doc_id, text, shingle, percent))
    roots = components(links[0].unionByName(links[1]).unionByName(links[2]))
    owned = nodes.select("node", "key", "least_id").join(roots, "node", "left")
    owned = owned.select("key", "least_id", F.coalesce("root", "node").alias("root"))
    least = owned.groupBy("root").agg(F.min("least_id").alias("component_id"))
    components_of = owned.join(least, "root").select("key", "component_id")
    linked = known.join(components_of, "key").select(identity, "n_shingles", "component_id")
    empty = sets.where(F.col("key").isNull())
    return linked.unionByName(
        empty.select(identity, "n_shingles", identity.alias("component_id"))
    )
