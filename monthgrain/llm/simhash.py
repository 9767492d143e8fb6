"""Near-duplicate groups by SimHash and the generalised pigeonhole principle.

A text's fingerprint has a bit set where over half of its shingles' hashes (XXH64, seed 42) have it.
Fingerprints at most TAU bits apart are linked, and documents reachable over links are a group.

To find links, the 64 bits are parted into groups, and group i gets a threshold T_i >= -1 such that
the T_i + 1 add up to TAU + 1: two fingerprints within TAU bits are then within T_i in some group i
(else they were at least the sum of T_i + 1 apart). Bits that go together in the corpus share a
group, so that groups are near independent. The thresholds, and how many groups there are, come
from a dynamic program on the estimated cost: the signatures a group needs (one per choice of T_i
bits that may differ) and the candidate pairs that agree on one, from the bits' frequencies over
all fingerprints. Any choice finds all links; it only sets the work.

Only distinct fingerprints are linked, so exact copies cost nothing. Rows of one signature come
together in sorted runs; links are verified in blocks of a run, of which only a spanning forest
leaves the task. Of a signature that more than RUN fingerprints share, those within TAU bits of one of them, its
hub, are linked by it; the rest go to each chunk of these, or, if they are many, all are dealt out as all
pairs of chunks. So no task holds more than two chunks at once, and no link is left out but between what is linked already.

`drop_near_copies` puts the same search to texts of which most word shingles are the same (Jaccard): two
fingerprints of a text's set of shingles, from independent hashes, are searched in turn, and what is
found by one and not refuted by the other is held against the whole sets. A third of all texts may be
copies of one: keys of many rows are looked up by broadcast (`look_up`) or dealt out in chunks.

Defined cases: null text is the empty text; a text of fewer than `words` words is one shingle, one
without words has the fingerprint 0, linked like any other; very long texts are read whole, and leave
a fingerprint or a set of hashes, of 8 bytes a shingle; repeated ids and rows are rows like others;
of equal least ids the row of the least hash stands for its group; null ids belong to groups but don't
name them unless there is nothing else; an empty table gives an empty result; other columns pass
through `drop_near_duplicates` and `drop_near_copies`, whatever their names and types.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, look_up, not_sent, own_name, row_hash

WORDS = 4
TAU = 4
BITS = 64
#: Members of a run that are compared in one block; also the size of a chunk of larger ones.
RUN = 2048
#: Relative costs of moving a signature and of comparing two fingerprints, in microseconds.
SIGNATURE_COST, COMPARE_COST = 1.0, 0.01
#: Signatures of a fingerprint that a group's threshold may ask for; there is always a plan with one a group.
MAX_SIGNATURES = 3000
#: Of texts that share most of their sets of shingles: words of a shingle, the Jaccard similarity as a fraction,
#: so that the comparison is exact, and the bits by which one fingerprint and the other may differ.
SET_WORDS, SIMILARITY = 5, (4, 5)
SET_TAU, OTHER_TAU = 13, 22
#: Texts that a task is made for where groups of them are worked on.
NODES_A_TASK = 20_000
#: Sets of shingles that are compared in one block.
SET_RUN = 2048
#: Keys of many rows that are few enough to be broadcast, with some 50 bytes each.
FEW_KEYS = 50_000
#: The same of texts' hashes, and of the bytes of sets; what is broadcast passes through the driver, several times as large there.
FEW_NODES, FEW_BYTES = 250_000, 4 << 20
#: Members of a component over which its hub counts as hot.
HUB = 5_000


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as an unsigned number. Only A-Z are lower-cased, only ASCII space splits."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxh64_intdigest(b" ".join(parts), 42)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = [0, *(ends[:-words] + 1).tolist()]
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255):  # counts of a part fit a byte
        some = hashes[at : at + 255]
        set_bits += np.add.reduce(np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS, keep: list[str] | None = None) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number; with the long columns in keep."""
    keep = keep or []

    def make():
        def step(ids: pa.Array, texts: pa.Array, *kept: pa.Array):
            return [ids, np.array([fingerprint(t, words) for t in texts.to_pylist()], np.uint64).view(np.int64), *kept]

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
    return arrow_map(rows, make, ", ".join(["doc_id long", "fp long", *(f"{k} long" for k in keep)]), ["doc_id", "text", *keep])


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j set (64 x 64), over all of fps."""

    def make():
        def step(fp: pa.Array):
            bits = np.unpackbits(fp.to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both = (bits.T @ bits).astype(np.int64).ravel()
            return [np.arange(BITS * BITS + 1), np.append(both, len(bits))]

        return step

    rows = arrow_map(fps, make, "cell long, n long", ["fp"]).groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in rows:
        counts[cell] = n
    return int(counts[-1]), counts[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, groups: int) -> list[list[int]]:
    """Parts the bits into groups of near equal size; each grows by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    alike = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(alike, 0)
    left, out = set(range(BITS)), []
    for g in range(groups):
        size = len(left) // (groups - g)
        order = sorted(left)
        own = [order[int(np.argmax(alike[np.ix_(order, order)].sum(1)))]]
        left.discard(own[0])
        while len(own) < size:
            order = sorted(left)
            own.append(order[int(np.argmax(alike[np.ix_(order, own)].sum(1)))])
            left.discard(own[-1])
        out.append(sorted(own))
    return out


def plan(n: int, both: np.ndarray, tau: int = TAU) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds; those with -1 are left out."""
    p = np.diag(both) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m in range(1, tau + 2):
        groups = group_bits(n, both, m)
        costs = []
        for bits in groups:
            row = [0.0]
            for e in range(tau + 1):
                signatures = comb(len(bits), e)
                if e >= len(bits):  # no bit would have to agree
                    row.append(float("inf"))
                    continue
                # pairs that agree on all but e bits of the group: the average over which bits those are
                odds = np.exp(np.log(agree[bits]).mean() * (len(bits) - e))
                row.append(float("inf") if signatures > MAX_SIGNATURES else n * signatures * max(1.0, n * odds / RUN) * SIGNATURE_COST + n * n / 2 * odds * signatures * COMPARE_COST)
            costs.append(row)
        least = {0: (0.0, [])}  # bits of tau + 1 dealt out so far: cost, thresholds
        for row in costs:
            least = {
                total: min(((c + row[k], [*t, k - 1]) for used, (c, t) in least.items() if 0 <= (k := total - used) < len(row)), default=(float("inf"), []))
                for total in range(tau + 2)
            }
        cost, thresholds = least[tau + 1]
        if cost < best[0]:
            best = cost, [(b, t) for b, t in zip(groups, thresholds, strict=True) if t >= 0]
    return best[1]


def signature_masks(groups: list[tuple[list[int], int]]) -> list[int]:
    """For each signature the bits that must agree, as a signed 64-bit mask."""
    masks = [sum(1 << b for b in bits if b not in dropped) for bits, e in groups for dropped in combinations(bits, e)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(near: Callable[[np.ndarray, np.ndarray], np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, least member of its component) in each run of rows; ends: where runs end. near
    says of two arrays of row numbers (of shapes that go together) which rows are linked."""
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    n = int(ends[-1])
    left, right = [], []
    end_of = np.repeat(ends, sizes)
    short = end_of - np.repeat(starts, sizes) <= 128
    for k in range(1, int(sizes[sizes <= 128].max(initial=1))):
        i = np.flatnonzero(short[: n - k] & (np.arange(k, n) < end_of[: n - k]))
        i = i[near(i, i + k)]
        left.append(i)
        right.append(i + k)
    label = np.arange(n)
    if left:
        label = _hook(label, np.concatenate(left), np.concatenate(right))
    for a, b in zip(starts[sizes > 128].tolist(), ends[sizes > 128].tolist(), strict=True):
        own = np.arange(b - a)
        for at in range(a, b, 512):
            i, j = np.nonzero(near(np.arange(at, min(at + 512, b))[:, None], np.arange(at, b)[None, :]))
            own = _hook(own, i + at - a, j + at - a)
        label[a:b] = own + a
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joins the components of i and j; labels are the least index of a component."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]


def links(nodes: DataFrame, tau: int = TAU, run: int = RUN, other_tau: int | None = None) -> DataFrame:
    """Edges a > b that connect all linked nodes. nodes has fp, distinct; with other_tau it has node, fp
    and other, and links also need the others to be within other_tau bits."""
    n, both = bit_counts(nodes)
    masks = signature_masks(plan(n, both, tau))
    carried = ["fp"] if other_tau is None else ["node", "fp", "other"]
    key = F.xxhash64(F.col("mask"), F.col("fp").bitwiseAND(F.col("mask")))
    signed = nodes.select(*carried, F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("mask")).select(*carried, key.alias("key"))
    hot = cut(signed.groupBy("key").count().filter(F.col("count") > run).select("key", "count", F.ceil(F.col("count") / run).cast("int").alias("chunks")))
    by_hub = None
    if not hot.isEmpty():
        signed, by_hub = _dealt(signed, hot, n * len(masks), carried, tau, other_tau, run)
    runs = signed.repartition("key").sortWithinPartitions("key", carried[0])  # so that one node is the hub of many runs
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(batches):
        held = np.zeros((len(carried) + 1, 0), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            ends = np.flatnonzero(held[0, 1:] != held[0, :-1]) + 1  # the last run may go on in the next batch
            if len(ends):
                yield from edges(held[1:, : ends[-1]], ends)
                held = held[:, ends[-1] :]
        if held.shape[1]:
            yield from edges(held[1:], np.array([held.shape[1]]))

    def edges(rows, ends):
        if other_tau is None:
            fps = rows[0].view(np.uint64)
            near = lambda i, j: np.bitwise_count(fps[i] ^ fps[j]) <= tau
        else:
            fps, others = rows[1].view(np.uint64), rows[2].view(np.uint64)

            def near(i, j):
                close = np.bitwise_count(fps[i] ^ fps[j]) <= tau
                at = np.nonzero(close)
                i, j = (np.broadcast_to(x, close.shape)[at] for x in (i, j))
                close[at] = np.bitwise_count(others[i] ^ others[j]) <= other_tau
                return close

        a, b = (rows[0][x] for x in forest(near, ends))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], schema=schema)

    found = runs.select("key", *carried).mapInArrow(linked, "a long, b long")
    return hung(found if by_hub is None else found.union(by_hub))


def _beside(signed: DataFrame, hot: DataFrame, total: int) -> DataFrame:
    """signed with the columns of hot (a row per key, with the key's count among total) beside each row of its keys."""
    if hot.count() <= FEW_KEYS:
        return signed.join(F.broadcast(hot.drop("count")), "key", "left")
    return look_up(signed, "key", hot, "count", total, ["fp"])


def _dealt(signed: DataFrame, hot: DataFrame, total: int, carried: list[str], tau: int, other_tau: int | None, run: int) -> tuple[DataFrame, DataFrame]:
    """signed with the rows of hot keys dealt out under keys of their own, and the edges that link rows of these to a hub.

    A hot key's hub is one of its rows. What is within the bits of it is linked by it, and needn't be compared with each other.
    The rest must be compared with all: if it is no larger than a run, it goes to each chunk of the others, and else
    all rows are dealt out as all pairs of chunks. Where there is no rest, no row is left to compare."""
    at = _beside(signed, hot, total).filter("chunks IS NOT NULL")
    first = at.groupBy("key").agg(F.min(F.struct(F.xxhash64("fp").alias("h"), *carried)).alias("hub"))
    hubs = cut(first.join(not_sent(hot), "key").select("key", "count", "chunks", *(F.col(f"hub.{c}").alias(f"hub_{c}") for c in carried)))

    def close() -> Column:
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub_fp"))) <= tau
        return near if other_tau is None else near & (F.bit_count(F.col("other").bitwiseXOR(F.col("hub_other"))) <= other_tau)

    hung_on = _beside(signed, hubs, total).filter("chunks IS NOT NULL").withColumn("close", close())
    rest = hung_on.groupBy("key").agg(F.count_if(~F.col("close")).alias("rest"))
    known = cut(hubs.join(not_sent(rest), "key"))
    node, hub = carried[0], f"hub_{carried[0]}"
    by_hub = hung_on.filter(F.col("close") & (F.col(node) != F.col(hub))).select(F.greatest(node, hub).alias("a"), F.least(node, hub).alias("b")).distinct()
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks"))
    every = F.sequence(F.lit(0).cast("long"), (F.col("chunks") - 1).cast("long"))
    pair = lambda i, j: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))
    one, all_chunks = F.array(pair(own, F.lit(-1))), F.transform(every, lambda c: pair(c, F.lit(-1)))
    all_pairs = F.transform(every, lambda c: pair(F.least(c, own), F.greatest(c, own)))
    hot_pairs = F.when(F.col("rest") == 0, F.array().cast("array<struct<i: bigint, j: bigint>>")).when(F.col("rest") > run, all_pairs).when(close(), one).otherwise(all_chunks)
    pairs = F.when(F.col("chunks").isNull(), F.array(pair(F.lit(0), F.lit(0)))).otherwise(hot_pairs)
    dealt = _beside(signed, known, total).select(*carried, "key", F.explode(pairs).alias("pair"))
    return dealt.select(*carried, F.xxhash64("key", "pair.i", "pair.j").alias("key")), by_hub


def hung(edges: DataFrame) -> DataFrame:
    """Edges a > b that connect the same nodes: each node and those below it that it is linked to hang on the
    least of these. A node has no more links here than there are runs that it was in."""
    below = edges.filter("a <> b").groupBy("a").agg(F.collect_set("b").alias("below"), F.min("b").alias("m"))
    return below.select(F.explode(F.array_append("below", F.col("a"))).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 50, few: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """node and root, the least node of its component, for each node in edges (a > b).

    Large-star and small-star rounds in turn: every node's neighbours are hung on the least of them,
    until all hang on the least node. Each round is cut off in the shared folder. Where a node has over
    HUB neighbours, those look up the least of them by `look_up` rather than by a join on the node. few may put
    what a step gives on fewer tasks."""
    e = cut(few(edges))
    n, state, busiest = _state(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = few(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))).select(F.col("a").alias("u"), F.least("a", "m").alias("m"), "n")
        large = few(_least_of(both.filter("b > a"), least, 2 * n, busiest).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())
        if busiest > HUB:
            large = cut(large)
        least = few(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))).select(F.col("a").alias("u"), "m", "n")
        small = few(_least_of(large, least, n, busiest).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b"))
        e = cut(few(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()))
        before = n, state
        n, state, busiest = _state(e)
        if (n, state) == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _state(e: DataFrame) -> tuple[int, int | None, int]:
    """How many edges there are, a sum of their hashes, and the most that hang on one node."""
    ends = e.select(F.explode(F.array("a", "b")).alias("u"), F.xxhash64("a", "b").cast("decimal(38,0)").alias("h"))
    n, state, busiest = ends.groupBy("u").agg(F.count("*").alias("n"), F.sum("h").alias("h")).agg(F.sum("n"), F.sum("h"), F.max("n")).first()
    return (n or 0) // 2, state, busiest or 0


def _least_of(edges: DataFrame, least: DataFrame, n: int, busiest: int) -> DataFrame:
    """edges with m, the least neighbour of a."""
    if busiest <= HUB:
        return edges.join(not_sent(least), F.col("a") == F.col("u"))
    return look_up(edges, "a", cut(least).withColumnRenamed("u", "a"), "n", n, ["b"])


def near_duplicates(docs: DataFrame, words: int = WORDS, tau: int = TAU, keep: list[str] | None = None) -> DataFrame:
    """doc_id, fp, root (a fingerprint that stands for the group) and component_id (the least id of the
    group) of every row; with the columns in keep. Where ids repeat, groups may share their least id."""
    fps = cut(fingerprints(docs, words, keep))
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")))
    found, total = cut(links(nodes.select("fp"), tau)), fps.count()
    if not found.isEmpty():
        stars = components(found)
        rooted = cut(nodes.join(not_sent(stars), F.col("fp") == F.col("node"), "left").select("fp", "least_id", "n", F.coalesce("root", "fp").alias("root")))
        lowest = cut(rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("size")))
        nodes = cut(look_up(rooted, "root", lowest, "size", nodes.count(), ["fp"]).select("fp", "root", "component_id", "n"))
    else:
        nodes = nodes.select("fp", F.col("fp").alias("root"), F.col("least_id").alias("component_id"), "n")
    return look_up(fps, "fp", nodes, "n", total, ["doc_id", *(keep or [])])


def _first_of_each(rows: DataFrame, group: str, row: str) -> DataFrame:
    """The ids and row hashes that stand for the groups of rows (doc_id, group, row): the least id, null
    ids last, and of several the least hash."""
    first = rows.groupBy(group).agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.col(row).alias("r"))).alias("first"))
    return first.select(F.col("first.doc_id").alias("i"), F.col("first.r").alias("r"))


def _rows_of(docs: DataFrame, row: str, chosen: DataFrame) -> DataFrame:
    """The rows of docs (with the column row) that are chosen (i, r), each once."""
    i, r = own_name(docs, "chosen_id"), own_name(docs, "chosen_row")
    keys = chosen.select(F.col("i").alias(i), F.col("r").alias(r))
    kept = docs.join(not_sent(keys), F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (F.col(row) == F.col(r)), "left_semi")
    return kept.dropDuplicates(["doc_id", row]).drop(row)


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, tau: int = TAU) -> DataFrame:
    """One row of each group of docs, all columns: that of the least id (null ids last); of several, one
    of the least hash of its columns."""
    row = own_name(docs, "row_hash")
    hashed = docs.withColumn(row, row_hash(docs))
    grouped = near_duplicates(hashed.select("doc_id", "text", F.col(row).alias("r")), words, tau, keep=["r"])
    return _rows_of(hashed, row, _first_of_each(grouped, "root", "r"))


# --- texts that share most of their shingles ------------------------------------------------------------------

_PLACE = np.random.default_rng(42).integers(0, 2**64, 64, np.uint64) | np.uint64(1)


def shingle_set(text: str | None, words: int = SET_WORDS) -> np.ndarray:
    """The sorted hashes of the distinct shingles, each rolled from those of its words."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(parts) <= words:
        return np.array([xxh64_intdigest(b" ".join(parts), 42)], np.uint64)
    each = np.fromiter(map(xxh64_intdigest, parts), np.uint64, len(parts))
    n = len(parts) - words + 1
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total += (each[k : k + n] ^ (each[k : k + n] >> np.uint64(31))) * _PLACE[k]
    return np.unique(_mixed(total))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def set_fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint of a set of hashes, as a signed number."""
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255):
        some = hashes[at : at + 255]
        set_bits += np.add.reduce(np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def alike(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of a and b members that share so many reach SIMILARITY."""
    return SIMILARITY[1] * shared >= SIMILARITY[0] * (a + b - shared)


def _sets(texts: DataFrame, nodes: DataFrame, words: int, few: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node and set, its shingles as bytes, of each of nodes (column node). Equal texts are one before they
    are shuffled to meet the nodes."""

    def make():
        return lambda ids, some: [ids, [shingle_set(t, words).tobytes() for t in some.to_pylist()]]

    if nodes.count() <= FEW_NODES:  # else all texts are shuffled to meet them
        texts = texts.join(F.broadcast(nodes), "node", "left_semi")
    once = texts.groupBy("node").agg(F.first("text").alias("text"))
    return cut(few(arrow_map(once.join(not_sent(nodes), "node", "left_semi"), make, "node long, set binary", ["node", "text"])))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs (a, b) whose sets are alike. A node's set is sent once, with all that it is to be held against (no more than
    there are signatures); sets of the other side are broadcast if their bytes are counted and few, and else looked up: those
of many pairs by broadcast, all others by shuffle."""

    def make():
        def step(a: pa.Array, b: pa.Array, x: pa.Array, y: pa.Array):
            sides = [[np.frombuffer(s, np.uint64) for s in side.to_pylist()] for side in (x, y)]
            shared = np.array([len(np.intersect1d(s, t, assume_unique=True)) for s, t in zip(*sides, strict=True)])
            keep = pa.array(alike(shared, *(np.array([len(s) for s in side]) for side in sides)))
            return [a.filter(keep), b.filter(keep)]

        return step

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    each = pairs.groupBy("a").agg(F.collect_set("b").alias("bs")).join(not_sent(left), "a").select("a", "x", F.explode("bs").alias("b"))
    counts = cut(pairs.groupBy("b").agg(F.count_distinct("a").alias("n")))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("y")).join(not_sent(counts), "b")
    size, total = right.agg(F.sum(F.length("y") + 64), F.sum("n")).first()
    met = each.join(F.broadcast(right.drop("n")), "b") if (size or 0) <= FEW_BYTES else look_up(each, "b", right, "n", total, ["a"])
    return arrow_map(met, make, "a long, b long", ["a", "b", "x", "y"])


def _all_within(members: DataFrame, sets: DataFrame, run: int) -> DataFrame:
    """Edges that connect all alike sets of a group; members has node, group and n, the members of the group.
    A group is dealt out as all pairs of chunks of run members."""
    chunks, own = F.ceil(F.col("n") / run), F.pmod(F.xxhash64("node", F.lit("chunk")), F.ceil(F.col("n") / run))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda c: F.struct(F.least(c, own).alias("i"), F.greatest(c, own).alias("j")))
    dealt = members.select("node", "group", F.explode(pairs).alias("pair")).select("node", F.xxhash64("group", "pair.i", "pair.j").alias("key"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(nodes: list[int], sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        column = np.unique(np.concatenate(sets), return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        mark, label = np.zeros(column.max() + 1, bool), np.arange(len(sets))
        for i in range(len(sets) - 1):
            own = column[starts[i] : starts[i + 1]]
            mark[own] = True
            shared = np.add.reduceat(mark[column[starts[i + 1] :]], starts[i + 1 : -1] - starts[i + 1], dtype=np.int64)
            mark[own] = False
            j = np.flatnonzero(alike(shared, sizes[i], sizes[i + 1 :])) + i + 1
            label = _hook(label, np.full(len(j), i), j)
        moved = np.flatnonzero(label != np.arange(len(sets)))
        if len(moved):
            a, b = np.array(nodes)[moved], np.array(nodes)[label[moved]]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], schema=schema)

    def linked(batches):
        last, nodes, held = None, [], []
        for batch in batches:
            for key, node, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last and nodes:
                    yield from edges(nodes, held)
                    nodes, held = [], []
                last = key
                nodes.append(node)
                held.append(np.frombuffer(s, np.uint64))
        if nodes:
            yield from edges(nodes, held)

    runs = dealt.join(not_sent(sets), "node").repartition("key").sortWithinPartitions("key")
    return runs.select("key", "node", "set").mapInArrow(linked, "a long, b long")


def _centres(members: DataFrame, total: int) -> DataFrame:
    """group and centre, the member whose fingerprint is nearest to the majority of the group's, bit by bit;
    members has node, group and fp."""

    def make():
        def step(groups: pa.Array, fp: pa.Array):
            own, at = np.unique(groups.to_numpy(), return_inverse=True)
            counts = np.zeros((len(own), BITS), np.int64)
            np.add.at(counts, at, np.unpackbits(fp.to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64) * 2 - 1)
            return [np.repeat(own, BITS), np.tile(np.arange(BITS), len(own)), counts.ravel()]

        return step

    votes = arrow_map(members, make, "group long, bit long, n long", ["group", "fp"]).groupBy("group", "bit").agg(F.sum("n").alias("n"))
    middle = votes.groupBy("group").agg(F.bit_or(F.when(F.col("n") > 0, F.expr("shiftleft(1L, CAST(bit AS INT))")).otherwise(F.lit(0).cast("long"))).alias("middle"))
    sized = members.groupBy("group").agg(F.count("*").alias("n")).join(not_sent(middle), "group")
    near = look_up(members, "group", cut(sized), "n", total, ["node"]).select("node", "group", F.bit_count(F.col("fp").bitwiseXOR(F.col("middle"))).alias("d"))
    return near.groupBy("group").agg(F.min(F.struct("d", "node"))["node"].alias("centre"), F.count("*").alias("n"))


def set_groups(texts: DataFrame, words: int = SET_WORDS, tau: int = SET_TAU, other_tau: int = OTHER_TAU, run: int = SET_RUN) -> DataFrame:
    """node and root, the least node of its group, of those nodes of texts (node, a hash of the text, and
    text) whose sets are alike, over any number of steps, to a lesser one's.

    The members of a group that the fingerprints connect are held against the one in its centre. If that
    leaves some over, what was linked in the group is held against each other, and if it still falls apart,
    all of it."""

    def make():
        def step(ids: pa.Array, some: pa.Array):
            sets = [shingle_set(t, words) for t in some.to_pylist()]
            return [ids, [set_fingerprint(s) for s in sets], [set_fingerprint(_mixed(s)) for s in sets]]

        return step

    prints = cut(arrow_map(texts, make, "node long, fp long, other long", ["node", "text"]).dropDuplicates(["node"]))
    tasks = max(8, -(-prints.count() // NODES_A_TASK))

    def few(df: DataFrame) -> DataFrame:
        """On tasks for the number of texts: each task of a small table would leave files of its own in every shuffle."""
        return df.coalesce(tasks)

    swapped = prints.select("node", F.col("other").alias("fp"), F.col("fp").alias("other"))
    found = cut(few(hung(links(prints, tau, other_tau=other_tau).union(links(swapped, tau, other_tau=other_tau)))))
    stars = components(found, few=few)
    members = stars.select("node", F.col("root").alias("group")).union(stars.select("root", "root").distinct())
    members = cut(few(members.join(not_sent(prints.select("node", "fp")), "node")))
    total, sets = members.count(), _sets(texts, members.select("node"), words, few)
    centred = cut(few(look_up(members.drop("fp"), "group", cut(few(_centres(members, total))), "n", total, ["node"])))
    true = cut(few(_verified(centred.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")), sets)))
    held = centred.join(not_sent(true.select(F.col("a").alias("node"), F.lit(True).alias("true"))), "node", "left").select("node", "group", (F.col("true").isNotNull() | (F.col("node") == F.col("centre"))).alias("true"))
    held = cut(few(look_up(held, "group", cut(few(held.groupBy("group").agg(F.count("*").alias("n"), F.every("true").alias("whole")))), "n", total, ["node"])))
    rest = held.filter("NOT whole").select("node", "group")
    if rest.isEmpty():
        return stars
    down = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    done = held.filter("whole AND node <> group").select("node", F.col("group").alias("root"))
    within = found.join(not_sent(rest.select(F.col("node").alias("a"))), "a", "left_semi").join(not_sent(true.select("a", "b").union(true.select("b", "a"))), ["a", "b"], "left_anti")
    edges = cut(down(true.join(not_sent(rest.select(F.col("node").alias("a"))), "a", "left_semi")).union(_verified(cut(few(within)), sets)).distinct())
    parts = components(edges, few=few)
    rooted = rest.join(not_sent(parts), "node", "left").select("node", "group", F.coalesce("root", "node").alias("root"))
    sized = cut(few(rooted.groupBy("group").agg(F.count("*").alias("n"), F.count("*").alias("size"), (F.min("root") == F.max("root")).alias("whole"))))
    rooted = cut(few(look_up(rooted, "group", sized, "n", total, ["node"])))
    done = done.union(rooted.filter("whole AND node <> root").select("node", "root"))
    apart = rooted.filter("NOT whole").select("node", "group", F.col("size").alias("n"))
    if apart.isEmpty():
        return done
    edges = edges.join(not_sent(apart.select(F.col("node").alias("a"))), "a", "left_semi").union(_all_within(apart, sets, run)).distinct()
    return done.union(components(edges, few=few))


def drop_near_copies(docs: DataFrame, words: int = SET_WORDS, tau: int = SET_TAU, other_tau: int = OTHER_TAU) -> DataFrame:
    """One row of each group of docs whose sets of shingles are alike (SIMILARITY), all columns, chosen as
    by `drop_near_duplicates`. Texts are told apart by a 64-bit hash."""
    row, node = own_name(docs, "row_hash"), own_name(docs, "text_hash")
    hashed = docs.withColumn(row, row_hash(docs)).withColumn(node, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = cut(hashed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("r"), F.col(node).alias("node")))
    stars = set_groups(hashed.select(F.col(node).alias("node"), "text"), words, tau, other_tau)
    sized = cut(rows.groupBy("node").agg(F.count("*").alias("n")).join(not_sent(stars), "node", "left").select("node", "n", F.coalesce("root", "node").alias("root")))
    rooted = look_up(rows, "node", sized, "n", rows.count(), ["doc_id", "r"])
    return _rows_of(hashed, row, _first_of_each(rooted, "root", "r")).drop(node)
