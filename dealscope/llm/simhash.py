"""Near-duplicates by SimHash and the generalised pigeonhole principle.

Fingerprints that differ in at most ``radius`` bits are linked. The 64 bits are dealt into
parts; if the thresholds t of the parts satisfy sum(t + 1) = radius + 1, a linked pair
differs in at most t bits in one part at least. Bits that are correlated go into the same
part, so that the others stay selective. Number of parts and thresholds, which may differ
and may be -1 (part not probed), come from dynamic programming over the estimated cost of
probes and candidates. Each fingerprint is put in the bucket of its own part value and
probes the values within the threshold; buckets are verified on all 64 bits.

The estimates come from bit counts over all fingerprints and only steer the cost: any choice
finds every link. Only distinct fingerprints are compared. A bucket gives a spanning forest
of its links, not all pairs of a large group, so near copies make a linear number of rows.
Components are found by alternating star contraction on tables in the shared folder.

``drop_near_copies``, for pipelines, keeps one document of each component.

Defined results: null text has no words; documents without words have fingerprint zero and
are linked like any other; a null doc_id never is a component's id unless all are null;
repeated rows each get a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, free_name, long_array, small_or_shuffled, written

RADIUS = 4
SHINGLE = 4
SEED = 42
BITS = 64

# Cost of a probe row that is shuffled, and of a pair that is compared, in microseconds.
_PROBE_COST, _PAIR_COST = 1.5, 0.004


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` words, space-joined; of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    spans = zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Unsigned 64 bits: a bit is set if it is in more than half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8", copy=False).view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    majority = np.packbits(2 * counts > n, bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """(doc_id, text_hash, print): the fingerprint as a signed long."""
    made = T.StructType().add("text_hash", "long").add("print", "long")
    schema = T.StructType([docs.schema[doc_id], *made])
    names = [f.name for f in schema]

    def of(text: bytes) -> int:
        return fingerprint(shingle_hashes(text, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = bytes_of(batch.column(2))
            signed = long_array(np.array([of(x) for x in texts], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], signed], names=names)

    return docs.select(doc_id, F.xxhash64(text).alias("text_hash"), text).mapInArrow(run, schema)


def bit_moments(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set (64 x 64)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 1 << 14):
                bits = _bits(values[at : at + (1 << 14)]).astype(np.float32)
                total += bits.T @ bits
                n += len(bits)
        yield pa.RecordBatch.from_pydict(
            {"i": [-1, *range(BITS)], "row": [[float(n)], *total.tolist()]}
        )

    rows = (
        prints.select("print")
        .mapInArrow(run, "i long, row array<double>")
        .select("i", F.posexplode("row").alias("j", "n"))
        .groupBy("i", "j")
        .agg(F.sum("n"))
        .collect()
    )  # 4097 rows at most
    both = np.zeros((BITS, BITS))
    n = 0
    for i, j, value in rows:
        if i < 0:
            n = int(value)
        else:
            both[i, j] = value
    return n, both


def _bits(values: np.ndarray) -> np.ndarray:
    view = np.ascontiguousarray(values.astype("<i8", copy=False)).view(np.uint8)
    return np.unpackbits(view.reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits into parts of even size, the bits of a part as correlated as can be."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    bond = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free = set(range(BITS))
    dealt = []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        seed = max(free, key=lambda b: (sum(bond[b, c] for c in free if c != b), -b))
        part = [seed]
        free.discard(seed)
        while len(part) < size:
            best = max(free, key=lambda b: (bond[b, part].sum(), -b))
            part.append(best)
            free.discard(best)
        dealt.append(sorted(part))
    return dealt


def _within(agree: np.ndarray, radius: int) -> np.ndarray:
    """Probability that at most r of independent bits differ, for r up to ``radius``."""
    chance = np.zeros(len(agree) + 1)
    chance[0] = 1
    for a in agree:
        chance[1:] = chance[1:] * a + chance[:-1] * (1 - a)
        chance[0] *= a
    upto = np.cumsum(chance)[: radius + 1]
    return np.pad(upto, (0, radius + 1 - len(upto)), constant_values=1.0)


def _ball(width: int, radius: int) -> int:
    """Values within ``radius`` bits of a value of ``width`` bits."""
    total = term = 1
    for r in range(radius):
        term = term * (width - r) // (r + 1)
        total += term
    return total


def allocate(n: int, both: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Parts with their thresholds, of least estimated cost.

    For each number of parts, dynamic programming deals radius + 1 shares of (t + 1); the
    cost of a part at threshold t is its probes plus the candidates expected from them.
    """
    p = np.diag(both) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(2, radius + 2):
        parts = correlated_parts(n, both, m)
        cost = []
        for part in parts:
            chance = _within(agree[part], radius)
            cost.append(
                [0.0]
                + [
                    _PROBE_COST * n * _ball(len(part), t)
                    + _PAIR_COST * n * n * chance[t]
                    for t in range(radius + 1)
                ]
            )
        table = {0: (0.0, [])}
        for k in range(m):
            following: dict[int, tuple[float, list[int]]] = {}
            for used, (spent, chosen) in table.items():
                for share in range(radius + 2 - used):
                    total = spent + cost[k][share]
                    if used + share not in following or total < following[used + share][0]:
                        following[used + share] = (total, [*chosen, share - 1])
            table = following
        total, thresholds = table[radius + 1]
        if best is None or total < best[0]:
            best = total, list(zip(parts, thresholds, strict=True))
    return [(part, t) for part, t in best[1] if t >= 0]


def _masks(part: list[int], threshold: int) -> tuple[int, np.ndarray]:
    """Mask of a part's bits, and the patterns of up to ``threshold`` of them."""
    flips = [
        sum(1 << b for b in chosen)
        for r in range(threshold + 1)
        for chosen in combinations(part, r)
    ]
    return sum(1 << b for b in part), np.array(flips, np.uint64)


# Buckets of up to so many values are compared pair by pair, many at a time.
_SWEEP = 48


def bucket_links(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that span all linked values of one bucket.

    A search from each value looks only at values not reached yet, so a dense group costs
    about one pass and gives a spanning tree.
    """
    rest = np.unique(values)
    left, right = [], []
    while len(rest) > 1:
        tree, waiting, rest = [], [rest[:1]], rest[1:]
        while waiting and len(rest):
            for x in waiting.pop():
                hit = np.bitwise_count(rest ^ x) <= radius
                if hit.any():
                    found, rest = rest[hit], rest[~hit]
                    tree.append((np.full(len(found), x), found))
                    waiting.append(found)
                if not len(rest):
                    break
        left += [a for a, _ in tree]
        right += [b for _, b in tree]
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _run_links(
    keys: np.ndarray, values: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys; ``keys`` are sorted."""
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    sizes = np.diff(edges)
    run = np.repeat(np.arange(len(sizes)), sizes)
    small = np.repeat(sizes <= _SWEEP, sizes)
    left, right = [], []
    for shift in range(1, int(min(sizes.max(), _SWEEP))):
        a, b = values[:-shift], values[shift:]
        hit = (run[:-shift] == run[shift:]) & small[:-shift]
        hit &= np.bitwise_count(a ^ b) <= radius
        hit &= a != b
        left.append(a[hit])
        right.append(b[hit])
    for k in np.flatnonzero(sizes > _SWEEP):
        a, b = bucket_links(values[edges[k] : edges[k + 1]], radius)
        left.append(a)
        right.append(b)
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) with a < b: links that connect all distinct ``print`` values within ``radius``."""
    n, both = bit_moments(prints)
    plan = [_masks(part, t) for part, t in allocate(max(n, 1), both, radius)]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (mask, flips) in enumerate(plan):
                own = values & np.uint64(mask)
                step = max(1, (1 << 18) // max(1, len(own)))
                for at in range(0, len(flips), step):
                    some = flips[at : at + step]
                    keys = (own[:, None] ^ some[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(keys), k, np.int32)),
                            long_array(keys.view(np.int64)),
                            long_array(np.repeat(values, len(some)).view(np.int64)),
                        ],
                        names=["part", "key", "print"],
                    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            part = batch.column(0).to_numpy().astype(np.int64)
            got = np.stack([part, batch.column(1).to_numpy()])
            values = batch.column(2).to_numpy().view(np.uint64)
            if held and len(values):
                got = np.concatenate([held[0][0], got], axis=1)
                values = np.concatenate([held[0][1], values])
            # The last bucket may go on in the next batch.
            same = (got == got[:, -1:]).all(axis=0)
            cut = int(np.argmax(same)) if len(values) else 0
            yield from _verified(got[:, :cut], values[:cut], radius)
            held = [(got[:, cut:], values[cut:])]
        if held:
            yield from _verified(*held[0], radius)

    sorted_buckets = (
        prints.select("print")
        .mapInArrow(probe, "part int, key long, print long")
        .repartition("part", "key")
        .sortWithinPartitions("part", "key")
    )
    return sorted_buckets.mapInArrow(verify, "a long, b long")


def _verified(
    got: np.ndarray, values: np.ndarray, radius: int
) -> Iterator[pa.RecordBatch]:
    if len(values) < 2:
        return
    change = np.r_[True, (got[:, 1:] != got[:, :-1]).any(axis=0)]
    left, right = _run_links(np.cumsum(change), values, radius)
    if len(left):
        a, b = left.view(np.int64), right.view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        yield pa.RecordBatch.from_arrays(
            [long_array(pairs[0]), long_array(pairs[1])], names=["a", "b"]
        )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes that have an edge.

    Alternating large-star and small-star contraction; both are a minimum per node, which is
    combined before the shuffle, and a join that adaptive execution can split.
    """
    now = written(edges.where("a <> b").select("a", "b").distinct(), "links")
    size = _signature(now)
    for _ in range(most_rounds):
        now = written(_star(_star(now, large=True), large=False), "links")
        after = _signature(now)
        if after == size:
            break
        size = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _signature(edges: DataFrame) -> tuple:
    """Count and order-free digest of a set of edges; equal once nothing changes."""
    mixed = F.xxhash64("a", "b")
    return tuple(
        edges.agg(
            F.count("*"),
            F.bit_xor(mixed),
            F.sum(F.shiftright(mixed, 20)),
        ).first()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (a < b).

    Large star: each node's greater neighbours are tied to its smallest neighbour or itself.
    Small star: each node and its smaller neighbours are tied to the smallest of them.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    low = F.least("low", "u")
    tied = both.join(least, "u")
    if large:
        made = tied.where("v > u").select(low.alias("a"), F.col("v").alias("b"))
    else:
        made = tied.select(low.alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("low").alias("a"), F.col("u").alias("b"))
        )
    return made.where("a <> b").distinct()


def cluster(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(doc_id, text_hash, print, component_id) of every document."""
    marked = written(fingerprints(docs, doc_id, text, shingle), "prints")
    classes = written(
        marked.groupBy("print").agg(F.min(doc_id).alias("least_id")), "print_classes"
    )
    rooted = components(links(classes, radius))
    grouped = classes.join(rooted.withColumnRenamed("node", "print"), "print")
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    moved = grouped.join(least, "root").select("print", "component_id")
    assigned = written(
        classes.join(moved, "print", "left").select(
            "print", F.coalesce("component_id", "least_id").alias("component_id")
        ),
        "assigned",
    )
    return marked.join(assigned, "print", "left")


def drop_near_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Of rows that repeat that id, one stays. Components whose ids are all null keep one row
    for each distinct text.
    """
    near = cluster(docs, doc_id, text, radius, shingle)
    groups = written(near.select(doc_id, "text_hash", "component_id"), "groups")
    identity = [doc_id, "text_hash"]
    first = F.struct(F.col("text_hash"))
    same_id = groups.where(F.col(doc_id).eqNullSafe(F.col("component_id")))
    chosen = same_id.groupBy("component_id").agg(F.min(first).alias("k"))
    keep = chosen.select(F.col("component_id").alias(doc_id), F.col("k.text_hash"))
    nameless = groups.where(F.col("component_id").isNull()).select(*identity).distinct()
    keep = keep.where(F.col(doc_id).isNotNull()).unionByName(nameless)
    rows = groups.select(*identity).distinct()
    drop = written(
        rows.join(
            keep.select(F.col(doc_id).alias("_kid"), F.col("text_hash").alias("_khash")),
            rows[doc_id].eqNullSafe(F.col("_kid")) & (rows["text_hash"] == F.col("_khash")),
            "left_anti",
        ),
        "dropped",
    ).select(F.col(doc_id).alias("_drop_id"), F.col("text_hash").alias("_drop_hash"))
    met = docs[doc_id].eqNullSafe(drop["_drop_id"]) & (
        F.xxhash64(docs[text]) == drop["_drop_hash"]
    )
    left = docs.join(small_or_shuffled(drop), met, "left_anti")
    repeated = groups.groupBy(*identity).count().where("count > 1").limit(1).count()
    if not repeated:
        return left
    extra = free_name(left, "text_key")
    return (
        left.withColumn(extra, F.xxhash64(text)).dropDuplicates([doc_id, extra]).drop(extra)
    )
