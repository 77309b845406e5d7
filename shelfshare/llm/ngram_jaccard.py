"""N-gram Jaccard join by vertical partitioning, and the groups that its links form.

Every n-gram has a place in one global order: that of its 64-bit hash. The order is cut into fragments twice.

* Fine fragments find candidates. Two sets with a Jaccard likeness of t or more differ in at most d n-grams, d growing with
  their size; so if the order is cut into d + 1 fragments, both agree wholly in one of them at least. A set emits a hash of
  its part in each fragment; sets with an equal part meet. Sizes go in classes; a set emits for its class, and for the next
  if it can link with a set there, so that both sets of a pair use one cut.
* Coarse fragments count overlaps. Each candidate pair's common n-grams are counted in each fragment separately and the
  partial counts are summed per pair.

Texts with equal sets share one node. Within a meeting, pairs are not all made. Each member x is compared with one of them,
the hub, which also tells in which n-grams they differ: D(x). Two members differ by |D(x)| + |D(y)| - 2 |D(x) and D(y)|. If
|D(x)| + |D(y)| is within the bound already, both link with the hub, by the triangle inequality. If not, they must differ
from the hub in common n-grams. They are found by a prefix-filtered join on what they differ in, the n-grams ordered by how
many members of the meeting have them in their D, the rarest first: what the hub alone has or lacks comes last and makes no
pairs. Their overlap is counted per fragment too, on the D. So a large group of near copies makes few pairs, and no link is
lost. N-grams and sets are told apart by 64-bit hashes: of 10^12 different n-grams some 30,000 pairs share one, which can
only add to a pair's overlap, by one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, Tables, map_texts, mix, run_hashes, slices, small, texts_of, utf8, words
from .components import connected

N, LIKENESS = 3, Fraction(9, 10)
#: Fragments in which overlaps are counted.
FRAGMENTS = 8
#: A key that a task meets so often is dealt out over SALTS tasks; a hub's members are dealt out in parts of about MEMBERS.
OFTEN, SALTS, MEMBERS = 4, 64, 512
#: Nodes remembered per task, so that copies emit their keys once; forgetting only costs repeats.
REMEMBERED = 1 << 17
#: A node with a 1/HEAVY part of all rows or more, of which there are HEAVY at most, is broadcast to its rows.
HEAVY = 1000


def shingle_sets(column: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-gram hashes of each row, end to end, and the offsets of the rows.

    A row with fewer than n words has one n-gram, its whole sequence; a row without words has none.
    """
    data, at = utf8(column)
    data = LOWER[data]
    start, end = words(data, at)
    h, rows = run_hashes(data, start, end), len(at) - 1
    row = np.searchsorted(at[1:], start, "right")
    per_row = np.bincount(row, minlength=rows) if rows else np.zeros(0, np.int64)
    first = np.cumsum(per_row) - per_row
    grams, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    if len(h) >= n:
        whole = row[: len(h) - n + 1] == row[n - 1 :]
        g = np.zeros(len(h) - n + 1, U64)
        for k in range(n):
            g = mix(g + h[k : k + len(g)] * U64(2 * k + 3))
        grams, owner = g[whole], row[: len(g)][whole]
    short = np.flatnonzero((per_row > 0) & (per_row < n))
    if len(short):
        extra = np.zeros(len(short), U64)
        for k in range(n - 1):
            has = per_row[short] > k
            extra[has] = mix(extra[has] + h[first[short[has]] + k] * U64(2 * k + 3) + U64(k + 1))
        grams, owner = np.concatenate([grams, extra]), np.concatenate([owner, short])
    size = np.bincount(owner, minlength=rows) if rows else np.zeros(0, np.int64)
    grams = grams[np.argsort(owner, kind="stable")] if len(short) else grams
    out, lengths, lo = [], np.zeros(rows, np.int64), 0
    for i, k in enumerate(size):
        out.append(np.unique(grams[lo : lo + k]))
        lengths[i] = len(out[-1])
        lo += k
    return np.concatenate(out) if out else grams, np.append(0, np.cumsum(lengths))


#: Size classes span so many factors of the likeness: wider ones let fewer sets emit for two, but cut small sets finer.
SPAN = 3


@cache
def _classes(likeness: Fraction) -> tuple[list[int], list[int]]:
    """The least size of each size class, and the number of fragments for pairs with one set in the class and none above it.

    Neighbouring limits have the ratio `likeness` or more, so the two sets of a pair are at most one class apart.
    """
    limits = [1]
    while limits[-1] < 1 << 40:
        limits.append(int(limits[-1] / likeness**SPAN) + 1)
    most = [differing(high - 1, high - 1, likeness) for high in limits[1:]]
    return limits, [d + 1 + _spare(d) for d in most]


def _spare(d: int) -> int:
    """How many fragments more than d + 1 there are, so that two sets that link agree in so many more.

    A set with no more empty fragments than that emits none for them: its agreements with another are not all empty ones.
    """
    return d // 100


def node_of(grams: np.ndarray) -> int:
    """A hash of a whole set."""
    return int(mix(np.array([mix(grams).sum() ^ U64(len(grams))])).view(np.int64)[0])


def differing(a: int, b: int, likeness: Fraction) -> int:
    """In how many n-grams sets of a and b can differ at most while their likeness is reached."""
    return int((a + b) * (1 - likeness) / (1 + likeness))


def parts(grams: np.ndarray, likeness: Fraction = LIKENESS) -> np.ndarray:
    """A hash of the set's part in each fragment, for its own size class and the next; grams is sorted and not empty."""
    n = len(grams)
    limits, cuts = _classes(likeness)
    own = bisect_right(limits, n) - 1
    total = np.append(U64(0), np.cumsum(mix(grams)))
    out = [np.zeros(0, U64)]
    for k in (own, own + 1):  # the pairs with one set in class k-1 or k and the other in k
        fragments = cuts[k]
        if fragments == 1 or k > own and n < limits[k] * likeness:  # one fragment: only equal sets link, and they are one node
            continue
        edge = np.searchsorted(grams >> U64(32), (np.arange(fragments + 1, dtype=U64) << U64(32)) // U64(fragments))
        edge[-1] = n
        content = total[edge[1:]] - total[edge[:-1]]
        key = mix(content ^ mix(np.arange(fragments, dtype=U64) + U64(k << 32)))
        full = edge[1:] > edge[:-1]
        out.append(key[full] if fragments - full.sum() <= _spare(differing(limits[k + 1] - 1, limits[k + 1] - 1, likeness)) else key)
    return np.concatenate(out)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))


def describe(docs: DataFrame, n: int = N, likeness: Fraction = LIKENESS) -> DataFrame:
    """doc_id, n_shingles, node (a hash of the whole set and its size; null for an empty set), keys (hashes of its parts)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, at = shingle_sets(batch.column("text"), n)
        keys, nodes, offsets = [], [], [0]
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            own = grams[lo:hi]
            if len(own):
                nodes.append(node_of(own))
                keys.append(parts(own, likeness))
            else:
                nodes.append(None)
            offsets.append(offsets[-1] + (len(keys[-1]) if len(own) else 0))
        values = np.concatenate(keys) if keys else np.zeros(0, U64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(at)), pa.array(nodes, pa.int64()), _lists(values, np.array(offsets))], names=["doc_id", "n_shingles", "node", "keys"])

    return map_texts(docs, run, "doc_id long, n_shingles long, node long, keys array<long>")


KEYED = "key long, salt int, node long, size long"


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per key of every node that is new to the task. Rows of a key that is met often go to salts above 0, where they
    count as met; one of them also goes to salt 0, where it waits for the key's rows from other tasks."""
    seen: set[int] = set()
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        _, first = np.unique(nodes, return_index=True)
        new = np.array([i for i in np.sort(first) if int(nodes[i]) not in seen], np.int64)
        if len(seen) > REMEMBERED:
            seen.clear()
        seen.update(nodes[new].tolist())
        rows = batch.take(pa.array(new))
        count = rows.column("keys").value_lengths().to_numpy()
        key = rows.column("keys").flatten().to_numpy()
        node, size = (np.repeat(rows.column(c).to_numpy(), count) for c in ("node", "n_shingles"))
        order = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else np.zeros(0, np.int64)
        run = np.diff(np.append(start, len(key)))
        often = np.zeros(len(key), bool)
        often[order] = np.repeat(run >= OFTEN, run)
        beacon = order[start[run >= OFTEN]]
        pick = np.append(np.arange(len(key)), beacon)
        salt = np.where(often, 1 + (node.view(U64) % U64(SALTS)).astype(np.int32), 0).astype(np.int32)
        salt = np.append(salt, np.zeros(len(beacon), np.int32))
        for lo in range(0, len(pick), 1 << 16):
            p = pick[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(key[p]), pa.array(salt[lo : lo + (1 << 16)]), pa.array(node[p]), pa.array(size[p])], names=["key", "salt", "node", "size"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by key, salt and node, that meet another node; the last row waits to see whether the next has its key."""
    held, held_met = None, False
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("key", "salt", "node", "size")]
        if held is not None:
            columns = [np.append(h, c) for h, c in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        key, salt, node, _ = columns
        same = np.append(False, (key[1:] == key[:-1]) & (salt[1:] == salt[:-1]))
        fresh = ~(same & np.append(False, node[1:] == node[:-1]))
        columns = [c[fresh] for c in columns]
        same = same[fresh]
        met = same | np.append(same[1:], False) | (columns[1] > 0)
        met[0] |= held_met
        held, held_met = [c[-1:] for c in columns], bool(met[-1])
        met[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(c[met]) for c in columns], names=["key", "salt", "node", "size"])
    if held_met:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, held)), names=["key", "salt", "node", "size"])


def _meetings(sets: DataFrame) -> DataFrame:
    """key, node, size of every key that two different nodes have. Of the rows of one node, each task sends one."""
    rows = sets.where("node is not null and doc_id is not null").select("node", "n_shingles", "keys").mapInArrow(_dealt, KEYED)
    rows = rows.repartition("key", "salt").sortWithinPartitions("key", "salt", "node")
    return rows.mapInArrow(_met, KEYED).select("key", "node", "size")


def _stars(met: DataFrame) -> DataFrame:
    """a, size_a, b, size_b: every member of a meeting with its hub, the one of them that has the most meetings."""
    weight = met.groupBy("node").agg(F.count("*").alias("weight"))
    best = met.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node", "size")).alias("top"))
    pairs = met.join(best, "key").where("node <> top.node")
    return pairs.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("top.node").alias("b"), F.col("top.size").alias("size_b")).distinct()


PARTS = "b long, fragment int, salt int, member int, node long, size long, grams array<long>"


def _parts(docs: DataFrame, sets: DataFrame, stars: DataFrame, n: int, fragments: int) -> DataFrame:
    """The n-grams of every node of stars in each fragment, once for each of its hubs; a hub's own for each salt of its members."""
    salts = stars.groupBy("b").agg((1 + F.floor(F.count("*") / MEMBERS)).cast("int").alias("salts"))
    roles = stars.join(salts, "b").select(F.col("a").alias("node"), "b", "salts").unionByName(salts.select(F.col("b").alias("node"), "b", "salts"))
    hubs = roles.groupBy("node").agg(F.collect_list(F.struct("b", "salts")).alias("hubs"))  # at most one per key of the node
    stand = sets.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(hubs, "node")
    rows = docs.join(small(stand, 64), "doc_id").select("text", "node", "hubs")

    def emitted(batch: pa.RecordBatch) -> Iterator[tuple]:
        grams, at = shingle_sets(batch.column("text"), n)
        for i, (node, own_hubs) in enumerate(zip(batch.column("node").to_pylist(), batch.column("hubs").to_pylist(), strict=True)):
            own = grams[at[i] : at[i + 1]]
            if not len(own) or node_of(own) != node:  # another text under the same id
                continue
            edge = np.searchsorted(own >> U64(32), (np.arange(1, fragments + 1, dtype=U64) << U64(32)) // U64(fragments))
            edge[-1] = len(own)
            lists = [own[lo:hi].view(np.int64) for lo, hi in zip(np.append(0, edge[:-1]), edge, strict=True)]
            for hub in own_hubs:
                member = hub["b"] != node
                for salt in [node % hub["salts"]] if member else range(hub["salts"]):
                    yield from ((hub["b"], k, salt, int(member), node, len(own), part) for k, part in enumerate(lists))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            for some in batched(emitted(piece), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), PART_KINDS, strict=True)], names=PART_NAMES)

    return rows.mapInArrow(run, PARTS)


PART_NAMES = [c.split()[0] for c in PARTS.split(", ")]
PART_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
PARTIAL = "a long, b long, size_a long, size_b long, fragment int, common long, apart array<long>"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member's part against its hub's, which comes before it: how many n-grams are common, and which are not."""
    at, hub, hub_size, last = None, None, 0, None
    for batch in batches:
        b, fragment, salt, member, node, size = (batch.column(c).to_numpy() for c in PART_NAMES[:-1])
        lists = batch.column("grams")
        offsets, grams = lists.offsets.to_numpy(), lists.values.to_numpy().view(U64)
        found = []
        for i in range(batch.num_rows):
            place, own = (b[i], fragment[i], salt[i]), grams[offsets[i] : offsets[i + 1]]
            if not member[i]:
                at, hub, hub_size, last = place, own.copy(), size[i], None
            elif at == place and last != node[i]:  # a row of one id and text may come twice
                last = node[i]
                where = np.searchsorted(hub, own)
                hit = (where < len(hub)) & (np.append(hub, U64(0))[where] == own)
                alone = np.ones(len(hub), bool)
                alone[where[hit]] = False
                found.append((node[i], b[i], size[i], hub_size, fragment[i], int(hit.sum()), np.concatenate([own[~hit], hub[alone]]).view(np.int64)))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), PARTIAL_KINDS, strict=True)], names=PARTIAL_NAMES)


PARTIAL_NAMES = [c.split()[0] for c in PARTIAL.split(", ")]
PARTIAL_KINDS = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.list_(pa.int64())]


def _differing(a: str, b: str, likeness: Fraction) -> str:
    """The SQL form of differing()."""
    p, q = likeness.numerator, likeness.denominator
    return f"(({a} + {b}) * {q - p}) div {q + p}"


def _linked(likeness: Fraction):
    """Whether a pair reaches the likeness."""
    return F.expr(f"apart <= {_differing('size_a', 'size_b', likeness)}")


def _candidates(partial: DataFrame, pairs: DataFrame, group: DataFrame, likeness: Fraction, tables: Tables) -> DataFrame:
    """hub, a, b, their sizes and apart of members of a hub in different groups that may reach the likeness.

    partial has the n-grams in which a member differs from its hub; pairs its size and how many they are.
    """
    group = group.join(group.groupBy("group").agg(F.count("*").alias("nodes")), "group")
    members = pairs.select("b", F.col("a").alias("node"), F.col("size_a").alias("size"), "size_b", "apart").join(group, "node", "left").withColumns({"group": F.coalesce("group", "node"), "nodes": F.coalesce("nodes", F.lit(1))})
    # Sets that link differ by so much at most in size, and in how far they are from the hub: all meetings of a hub are in two size classes.
    width = F.expr(f"1 + cast(size_b * {2 * float((1 - likeness) / (1 + likeness) / likeness ** (2 * SPAN + 1))} as long)")
    members = members.withColumns({"cell": F.floor(F.col("size") / width), "ring": F.floor(F.col("apart") / width)})
    near = lambda c: F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)).alias(c)
    around = members.groupBy("b", "cell", "ring").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    around = around.select("b", near("cell"), "ring", "low", "high").select("b", "cell", near("ring"), "low", "high")
    open_ = around.groupBy("b", "cell", "ring").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("b", "cell", "ring")
    open_ = small(tables.store(open_, "open"), 24)
    members = small(tables.store(members.join(open_, ["b", "cell", "ring"]).select("b", "node", "size", "apart", "group", "nodes"), "open"), 64)
    grams = partial.select("b", F.col("a").alias("node"), F.explode("apart").alias("gram")).join(members, ["b", "node"])
    shared = grams.groupBy("b", "gram").agg(F.count("*").alias("n"), F.min("group").alias("low"), F.max("group").alias("high"), F.max_by("group", F.struct("nodes", "group")).alias("top")).where("n > 1")
    ranked = grams.join(shared, ["b", "gram"]).groupBy("b", "node", "size", "apart", "group").agg(F.sort_array(F.collect_list(F.struct("n", "gram", F.expr("low < high").alias("mixed"), "top"))).alias("grams"))  # a set's own at most
    rows = tables.store(ranked.mapInArrow(lambda batches: _prefixes(batches, likeness), PREFIX), "open")
    x, y = (rows.select("b", "gram", "key", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "size", "place", "apart", "group", "lead", "top")]) for side in "xy")
    # Of the pairs in one gram those within its largest group, which are of no use, aren't made.
    met = x.where("lead_x and not top_x").join(y, ["b", "gram", "key"]).unionByName(x.where("lead_x and top_x").join(y.where("not top_y"), ["b", "gram", "key"]))
    # If this is the first n-gram of the order that both have, so many of them at most are common.
    room = "least(apart_x - place_x, apart_y - place_y)"
    met = met.where("group_x <> group_y").where(f"apart_x + apart_y - 2 * {room} <= {_differing('size_x', 'size_y', likeness)}")
    side = lambda c: F.struct(F.col(f"node_{c}").alias("node"), F.col(f"size_{c}").alias("size"), F.col(f"apart_{c}").alias("apart"))
    met = met.select(F.col("b").alias("hub"), F.least(side("x"), side("y")).alias("x"), F.greatest(side("x"), side("y")).alias("y"))
    met = met.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b")).agg(F.min(F.struct("hub", F.col("x.apart").alias("x"), F.col("y.apart").alias("y"))).alias("by"))
    return met.select("a", "b", "size_a", "size_b", "by.hub", "by.x", "by.y")


PREFIX = "b long, gram long, key long, node long, size long, place long, apart long, group long, lead boolean, top boolean"
PREFIX_NAMES = [c.split()[0] for c in PREFIX.split(", ")]
PREFIX_KINDS = [pa.int64()] * 8 + [pa.bool_()] * 2
#: An n-gram that more members differ from their hub in is common; so far below the bound, two of them must agree in more to meet.
COMMON, LEVELS = 4, 3


def _prefixes(batches: Iterator[pa.RecordBatch], likeness: Fraction) -> Iterator[pa.RecordBatch]:
    """The first n-grams of each member's D, those of one member alone counted but left out.

    Two members in reach have one of their prefixes in common. Say the first is at places p and q of the two. The p and q
    n-grams before it aren't common, so of those after it at most e = d - p - q differ. For a rare n-gram every member
    leads, that is, meets all others. For a common one, members with d/2 - p above LEVELS lead. Two other members meet
    where what comes after it agrees in a fragment: with 2 * level + 1 fragments, level the greater of d/2 - p and d/2 - q,
    one fragment has none of the e differences at least. They emit keys for all levels that a partner may have.
    """
    p, q = likeness.numerator, likeness.denominator
    for batch in batches:
        found: list[tuple] = []
        lists = batch.column("grams")
        offsets, entries = lists.offsets.to_numpy(), lists.values
        n, gram, mixed, top = (entries.field(c).to_numpy(zero_copy_only=False) for c in ("n", "gram", "mixed", "top"))
        hashes = gram.view(U64)
        for i, (b, node, size, apart, group) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("b", "node", "size", "apart", "group")), strict=True)):
            lo, hi = int(offsets[i]), int(offsets[i + 1])
            alone, half = apart - (hi - lo), -(-size * (q - p) // (q + p))  # n-grams of this member only; half of what may differ
            within = min(hi, lo + max(0, differing(size, size * q // p, likeness) - alone + 1))
            for j in (lo + np.flatnonzero(mixed[lo:within])).tolist():
                place = alone + j - lo
                late = n[j] > COMMON and half - place <= LEVELS
                fixed, largest = (node, size, place, apart, group), bool(group == top[j])
                found.append((b, gram[j], 0, *fixed, not late, largest))
                for level in range(abs(half - place), LEVELS + 1) if late else ():
                    found += [(b, gram[j], key, *fixed, True, largest) for key in _suffix_keys(hashes[j + 1 : hi], level)]
            if len(found) > 1 << 14:
                yield _prefix_batch(found)
                found = []
        if found:
            yield _prefix_batch(found)


def _prefix_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), PREFIX_KINDS, strict=True)], names=PREFIX_NAMES)


def _suffix_keys(grams: np.ndarray, level: int) -> list[int]:
    fragments = 2 * level + 1
    content = np.zeros(fragments, U64)
    np.add.at(content, ((grams >> U64(32)) * U64(fragments) >> U64(32)).astype(np.int64), mix(grams))
    return mix(content ^ mix(np.arange(fragments, dtype=U64) + U64(level + 1 << 32))).view(np.int64).tolist()


def _apart(candidates: DataFrame, partial: DataFrame) -> DataFrame:
    """The candidates with `apart`, in how many n-grams they differ: what they differ from their hub in alike is counted in
    each fragment and summed up per pair."""
    x, y = (partial.select(F.col("b").alias("hub"), F.col("a").alias(node), "fragment", F.col("apart").alias(side)) for node, side in (("a", "in_x"), ("b", "in_y")))
    both = candidates.join(x, ["hub", "a"]).join(y, ["hub", "b", "fragment"])  # partial has the rows of candidates only
    summed = both.groupBy("a", "b", "size_a", "size_b", "x", "y").agg(F.sum(F.size(F.array_intersect("in_x", "in_y"))).alias("alike"))
    return summed.withColumn("apart", F.col("x") + F.col("y") - 2 * F.col("alike"))


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, likeness: Fraction = LIKENESS, fragments: int = FRAGMENTS) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that a chain of links reaches, its own included.

    Two rows link when the Jaccard likeness of their sets is at least `likeness`; the test is in whole numbers. Null, empty
    and wordless texts have empty sets and link with nothing. Repeated rows have equal sets, so they link. A row
    with a null id links with equal sets only, is passed over when the smallest is sought, and alone has a null component.
    Rows of one id and different texts are each linked by their own text. One row out per row in, none of an empty table.
    """
    docs, tables = texts_of(df, id_col, text_col), Tables(df.sparkSession)
    described = tables.store(describe(docs, n, likeness), "described")
    met = tables.store(_meetings(described), "meetings")
    sets = tables.store(described.select("doc_id", "n_shingles", "node"), "sets")
    tables.drop("described")
    stars = tables.store(_stars(met), "stars")
    tables.drop("meetings")
    parts = _parts(docs, sets, stars, n, fragments).repartition("b", "fragment", "salt").sortWithinPartitions("b", "fragment", "salt", "member", "node")
    partial = tables.store(parts.mapInArrow(_compared, PARTIAL), "partial")
    pairs = tables.store(partial.groupBy("a", "b", "size_a", "size_b").agg((F.col("size_a") + F.col("size_b") - 2 * F.sum("common")).alias("apart")), "pairs")
    group = connected(pairs.where(_linked(likeness)).select("a", "b")).withColumnRenamed("component", "group")
    # Then the members of each hub with each other, where they are in different groups still.
    candidates = tables.store(_candidates(partial, pairs, group, likeness, tables), "candidates")
    wanted = candidates.select(F.col("hub").alias("b"), F.explode(F.array("a", "b")).alias("a")).distinct()
    more = tables.store(_apart(small(candidates, 64), partial.join(small(wanted, 16), ["b", "a"], "left_semi")).where(_linked(likeness)).select("a", "b"), "links")
    tables.drop("stars", "partial", "pairs", "open", "candidates")
    if not more.isEmpty():
        group = connected(group.select(F.col("node").alias("a"), F.col("group").alias("b")).unionByName(more)).withColumnRenamed("component", "group")
    # Each node's smallest id, then each group's. A row of its own text that links with none needs no look-up.
    nodes = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    linked = nodes.join(group, "node")
    low = linked.groupBy("group").agg(F.min("least").alias("low"))
    found = nodes.join(linked.join(low, "group").select("node", "low"), "node", "left").where("n > 1 or low is not null")
    found = tables.store(found.select("node", "n", F.coalesce("low", "least").alias("component_id")), "found")
    return _with_component(sets, found)


def _with_component(sets: DataFrame, found: DataFrame) -> DataFrame:
    """Each row's component. Nodes with very many rows are few, and their rows stay where they are."""
    total = sets.count()
    heavy = F.broadcast(found.where(F.col("n") * HEAVY >= total).select("node", "component_id"))  # at most HEAVY rows
    light = small(found.where(F.col("n") * HEAVY < total).select("node", "component_id"), 24)
    some = sets.where("node is not null")
    rows = some.join(heavy, "node").unionByName(some.join(heavy, "node", "left_anti").join(light, "node", "left"))
    rows = rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return rows.unionByName(sets.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
