"""Near copies by similarity: SimHash fingerprints of five-word shingles, joined by binary tries, and every link checked exactly.

Texts at a Jaccard similarity of 0.8 differ in some ten of 64 fingerprint bits, too many to share an equal block of bits. So
the roots of the tries are not blocks of bits here but the smallest hashes of a text's shingles: each of ``ROOTS`` roots is
a pair of minima, and a pair of texts of similarity s shares one with a chance of 1 - (1 - s * s) ** ROOTS, 0.99996 at 0.8. Below
a root node pairs are walked together and left as soon as more than ``BUDGET`` bits differ (nearly five standard deviations above ten).

Of what a trie finds, its task returns each text's ``NEAREST`` closest partners and a spanning forest over all it found, both by the
fewest differing bits, ties by the nodes' names: tries with the same nodes return the same links, a group of m near copies gives
some m links, not m * m. A root that holds more than ``LEAVES`` texts is cut into parts by a hash; every component of a part then sends its
lowest node on, and what is left of that root is joined once more, part by part with every other part if it is still too large.
Every link is checked on the two whole sets of shingles before it counts; components are taken over links that hold.

What that choice of links leaves out is settled by ``others``: roots of more texts than the closest partners cover, whose texts are
not in one component by then, are joined again, every part of them with every other part. Each pair that a trie finds between two
components is checked on the whole sets, in the task, and a spanning forest of the pairs that hold is returned. So no pair that shares a
root within the budget is left unchecked unless its texts are tied already. That work, not its output, is quadratic in the texts that
share a root and are no copies of each other. The number of Spark steps is the same for any table.

Defined cases: null text counts as empty; texts without words have the empty set and are one node; a text of fewer words than a
shingle is one shingle; texts with one set of shingles are one node; repeated rows count once, null ids go last; an empty table
stays empty; other columns of the input are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import connected_components, keyed, stored
from urndraw.llm.simhash import forest, lowest_of_each, trie_pairs

SHINGLE, LEAST, OF = 5, 4, 5
ROOTS, BUDGET, LEAVES = 10, 24, 2048
#: Closest partners of a text that are checked besides the links of the spanning forest.
NEAREST = 8
#: Bits that the tries walk over; the bits above them name the trie, and the budget holds for all 64.
WALKED, WALK_BUDGET = 48, 20
#: Rows that one task call takes, on average.
GROUP = 8192
#: Shingles that a trie of whole sets holds, on average, but for sets that are larger themselves.
SHINGLES = 1 << 21
_random = np.random.default_rng(42)
FACTORS = _random.integers(0, 1 << 63, 2 * ROOTS, dtype=np.uint64) | np.uint64(1)
ADDED = _random.integers(0, 1 << 63, 2 * ROOTS, dtype=np.uint64)
U = np.uint64


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the different word shingles; words are split and lower-cased as for fingerprints."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, U)
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1:].tolist())), U, len(starts)))


def signature(hashes: np.ndarray) -> tuple[int, int, list[int]]:
    """(node, fingerprint, roots) of a set of shingles: a hash of it, its majority bits, and pairs of its minima."""
    import xxhash

    node = xxhash.xxh64_intdigest(hashes.tobytes(), 42) - (1 << 63)
    if not len(hashes):
        return node, 0, []
    ones, least = np.zeros(64, np.int64), np.full(2 * ROOTS, ~U(0))
    for at in range(0, len(hashes), 1 << 14):  # a very long text takes no more memory than this many shingles
        part = hashes[at:at + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        mixed = part[:, None] * FACTORS + ADDED
        least = np.minimum(least, (mixed ^ (mixed >> U(32))).min(axis=0))
    bits = np.packbits((ones * 2 > len(hashes)).astype(np.uint8), bitorder="little").view(np.int64)[0]
    return node, int(bits), [xxhash.xxh64_intdigest(least[2 * i:2 * i + 2].tobytes(), i) - (1 << 63) for i in range(ROOTS)]


def signatures(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, version, node, size, fingerprint, roots): one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t, shingle) for t in batch.column(2).to_pylist()]
            nodes, prints, roots = zip(*map(signature, sets)) if sets else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array(prints, pa.int64()), pa.array(roots, pa.list_(pa.int64()))],
                ["doc_id", "version", "node", "size", "fingerprint", "roots"])

    return keyed(docs, id_column, text_column).mapInArrow(
        run, "doc_id long, version long, node long, size int, fingerprint long, roots array<long>")


def sets_of(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, hashes) for rows of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t, shingle).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "hashes"])

    return rows.mapInArrow(run, "node long, hashes array<long>")


def close_pairs(trie: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, bits): all index pairs of one trie whose fingerprints differ in ``BUDGET`` bits or fewer; tries are small numbers."""
    keys = (trie.astype(U) << U(WALKED)) | (prints & U((1 << WALKED) - 1))
    order = np.argsort(keys, kind="stable")
    values, first, times = np.unique(keys[order], return_index=True, return_counts=True)
    found = list(trie_pairs(values, WALK_BUDGET, WALKED))
    left, right = (np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in (0, 1))
    left, right = np.r_[left, np.arange(len(values))], np.r_[right, np.arange(len(values))]  # equal keys are pairs, too
    many = times[left] * times[right]
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    wide = np.repeat(times[right], many)
    a = order[np.repeat(first[left], many) + at // wide]
    b = order[np.repeat(first[right], many) + at % wide]
    bits = np.bitwise_count(prints[a] ^ prints[b])
    keep = (a != b) & (bits <= BUDGET) & (np.repeat(left != right, many) | (a < b))
    return np.minimum(a, b)[keep], np.maximum(a, b)[keep], bits[keep]


def spanning(size: int, a: np.ndarray, b: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(links, component): the pairs of a spanning forest of the fewest bits, ties by a and b, and each index's lowest one."""
    order = np.lexsort((b, a, bits))
    a, b = a[order], b[order]
    rank, component, chosen = np.arange(len(a)), np.arange(size), []
    while len(rank):
        left, right = component[a[rank]], component[b[rank]]
        apart = left != right
        rank, left, right = rank[apart], left[apart], right[apart]
        best = np.full(size, len(a))
        np.minimum.at(best, left, rank)
        np.minimum.at(best, right, rank)
        new = np.unique(best[best < len(a)])
        chosen.append(new)
        # the links so far, not only the new ones, lead every index to the lowest of its component
        taken = np.concatenate(chosen)
        component = forest(size, iter([(a[taken], b[taken])]))
    return order[np.concatenate([np.zeros(0, np.int64), *chosen])], component


def closest(a: np.ndarray, b: np.ndarray, bits: np.ndarray, most: int = NEAREST) -> np.ndarray:
    """The pairs that are among the ``most`` closest of one of their ends, ties by the other end."""
    pair = np.tile(np.arange(len(a)), 2)
    mine, other = np.r_[a, b], np.r_[b, a]
    order = np.lexsort((other, bits[pair], mine))
    starts = np.flatnonzero(np.r_[True, np.diff(mine[order]) != 0][:len(order)])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return np.unique(pair[order[place < most]])


def _sorted(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows by part, root and node, and the number of each row's trie."""
    order = np.lexsort((table.column("node").to_numpy(), table.column("root").to_numpy(), table.column("part").to_numpy()))
    table = table.take(pa.array(order))
    root, part = table.column("root").to_numpy(), table.column("part").to_numpy()
    return table, np.cumsum(np.r_[True, (np.diff(root) != 0) | (np.diff(part) != 0)][:len(root)]) - 1


def _found(trie: np.ndarray, prints: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, a, b, bits) of some tries at a time: their rows, and the index pairs among these that can be similar."""
    for low in range(0, int(trie[-1]) + 1, 1 << (64 - WALKED - 1)):
        mine = np.flatnonzero((trie >= low) & (trie < low + (1 << (64 - WALKED - 1))))
        a, b, bits = close_pairs(trie[mine] - low, prints[mine])
        # sets whose sizes differ by more can not be that similar
        fits = np.minimum(size[mine][a], size[mine][b]) * OF >= np.maximum(size[mine][a], size[mine][b]) * LEAST
        yield mine, a[fits], b[fits], bits[fits]


def _joined(table: pa.Table) -> pa.Table:
    """Links within each trie of a call, and for parts of a large root each component's lowest node as a link with itself."""
    table, trie = _sorted(table)
    root, part, node = (table.column(c).to_numpy() for c in ("root", "part", "node"))
    prints, size = table.column("fingerprint").to_numpy().view(U), table.column("size").to_numpy().astype(np.int64)
    large = table.column("large").to_numpy()
    out_a, out_b, out_at = [], [], []
    for mine, a, b, bits in _found(trie, prints, size):
        links, component = spanning(len(mine), a, b, bits)
        links = np.union1d(links, closest(a, b, bits))
        tops = np.flatnonzero((component == np.arange(len(mine))) & large[mine])
        out_a += [mine[a[links]], mine[tops]]
        out_b += [mine[b[links]], mine[tops]]
        out_at += [mine[a[links]], mine[tops]]
    a, b, at = map(np.concatenate, (out_a, out_b, out_at))
    return pa.table({"root": root[at], "part": part[at], "a": node[a], "b": node[b], "size": size[at].astype(np.int32), "fingerprint": prints[at].view(np.int64)})


def _apart(table: pa.Table) -> pa.Table:
    """The rows of each trie that have a pair between two components which was not among the links of ``_joined``."""
    table, trie = _sorted(table)
    prints, size = table.column("fingerprint").to_numpy().view(U), table.column("size").to_numpy().astype(np.int64)
    component, whole = table.column("component").to_numpy(), table.column("whole").to_numpy()
    met = np.zeros(len(trie), bool)
    for mine, a, b, bits in _found(trie, prints, size):
        unchecked = component[mine[a]] != component[mine[b]]
        if (unchecked & whole[mine[a]]).any():  # the same rows gave the same links then
            links = np.union1d(spanning(len(mine), a, b, bits)[0], closest(a, b, bits))
            unchecked[links[whole[mine[a[links]]]]] = False
        met[mine[a[unchecked]]] = met[mine[b[unchecked]]] = True
    return table.filter(pa.array(met)).select(["root", "part", "node", "size", "fingerprint", "component"])


def similar_pairs(sets: pa.ListArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the index pairs of ``sets`` (of different hashes, none empty) are similar enough."""
    ends = np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))
    size = np.diff(ends, prepend=0)
    _, ids = np.unique(sets.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    order = np.argsort(a, kind="stable")
    firsts, starts = np.unique(a[order], return_index=True)
    marked, holds = np.zeros(int(ids.max(initial=-1)) + 1, bool), np.zeros(len(a), bool)
    for one, some in zip(firsts.tolist(), np.split(order, starts[1:]) if len(order) else []):
        mine = ids[ends[one] - size[one]:ends[one]]
        marked[mine] = True
        both = np.array([np.count_nonzero(marked[ids[ends[i] - size[i]:ends[i]]]) for i in b[some].tolist()], np.int64)
        holds[some] = both * OF >= (size[one] + size[b[some]] - both) * LEAST
        marked[mine] = False
    return holds


def _checked(table: pa.Table) -> pa.Table:
    """(a, b): a spanning forest of the pairs between components whose whole sets are similar, for each trie."""
    table, trie = _sorted(table)
    node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
    prints, size = table.column("fingerprint").to_numpy().view(U), table.column("size").to_numpy().astype(np.int64)
    out_a, out_b = [node[:0]], [node[:0]]
    for low in np.flatnonzero(np.diff(trie, prepend=-1)).tolist():
        here = table.slice(low, int(np.searchsorted(trie, trie[low], "right")) - low)
        mine = np.arange(low, low + len(here))
        sets = here.column("hashes").combine_chunks()
        for _, a, b, bits in _found(trie[mine] - trie[low], prints[mine], size[mine]):
            unlike = component[mine[a]] != component[mine[b]]
            a, b, bits = a[unlike], b[unlike], bits[unlike]
            holds = similar_pairs(sets, a, b)
            a, b, bits = a[holds], b[holds], bits[holds]
            links, _ = spanning(len(mine), a, b, bits)
            out_a.append(node[mine[a[links]]])
            out_b.append(node[mine[b[links]]])
    return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def _tries(rows: DataFrame, total: int) -> DataFrame:
    """(root, part, a, b, size, fingerprint) for rows of (root, part, node, size, fingerprint, large)."""
    slot = F.pmod(F.xxhash64("root", "part"), F.lit(max(1, total // GROUP))).alias("slot")
    return rows.select("root", "part", "node", "size", "fingerprint", "large", slot).groupBy("slot").applyInArrow(
        _joined, "root long, part long, a long, b long, size int, fingerprint long")


def candidates(one: DataFrame) -> DataFrame:
    """(a, b): links to check among the rows (node, size, fingerprint, roots) of ``one``, which should be stored."""
    rows = one.select(F.explode("roots").alias("root"), "node", "size", "fingerprint")
    shared = stored(rows.groupBy("root").agg(F.count("*").alias("n")).where("n > 1"), "similar")
    parts = F.ceil(F.col("n") / LEAVES)
    first = rows.join(shared, "root").select("root", F.pmod(F.xxhash64("node", "root"), parts).alias("part"), "node", "size", "fingerprint", (F.col("n") > LEAVES).alias("large"))
    found = stored(_tries(first, _sum(shared)), "similar")
    # roots in several parts: the lowest nodes of the parts' components go on, each part of them with every other
    large = shared.where(F.col("n") > LEAVES).select("root")
    tops = stored(found.where("a = b").join(large, "root", "left_semi").select("root", F.col("a").alias("node"), "size", "fingerprint"), "similar")
    left = stored(tops.groupBy("root").agg(F.count("*").alias("n")).where("n > 1"), "similar")
    own = F.pmod(F.xxhash64("node"), F.col("halves"))
    blocks = tops.join(left.withColumn("halves", F.ceil(F.col("n") * 2 / LEAVES)), "root")
    # a part of the second round is a pair of halves; a node stands in all that hold its own
    paired = blocks.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("halves") - 1)))
    paired = paired.where("halves = 1 or own <> other").select(
        "root", (F.least("own", "other") * F.col("halves") + F.greatest("own", "other")).alias("part"), "node", "size", "fingerprint",
        F.lit(False).alias("large"))
    second = stored(_tries(paired, _sum(left)), "similar")
    return found.unionAll(second).where("a <> b").select("a", "b").distinct()


def others(one: DataFrame, tied: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): links between the components ``tied`` (node, component) that hold and were no candidates.

    ``one`` is as for ``candidates``; ``sets`` gives the shingles (node, hashes) of the nodes of a table.
    """
    tied = tied.withColumnRenamed("node", "of")
    named = one.join(tied, one["node"] == tied["of"], "left").select("node", "size", "fingerprint", "roots", F.coalesce("component", "node").alias("component"))
    rows = named.select(F.explode("roots").alias("root"), "node", "size", "fingerprint", "component")
    # a text's closest partners are all of a smaller root, and texts of one component need no more links
    open_roots = rows.groupBy("root").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"), F.min("component").alias("low"), F.max("component").alias("high"))
    halves = F.greatest(F.ceil(F.col("n") * 2 / LEAVES), F.ceil(F.col("shingles") * 2 / SHINGLES))
    open_roots = stored(open_roots.where((F.col("n") > NEAREST + 1) & (F.col("low") != F.col("high"))).select("root", "n", halves.alias("halves")), "similar")
    # a trie is a pair of halves; a node stands in all that hold its own
    blocks = rows.join(open_roots, "root").withColumn("own", F.pmod(F.xxhash64("node", "root"), F.col("halves")))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("halves") - 1))).where("halves = 1 or own <> other")
    blocks = blocks.select(
        "root", (F.least("own", "other") * F.col("halves") + F.greatest("own", "other")).alias("part"), "node", "size", "fingerprint", "component",
        ((F.col("halves") <= 2) & (F.col("n") <= LEAVES)).alias("whole"))
    total = open_roots.agg(F.sum(F.col("n") * F.greatest(F.col("halves") - 1, F.lit(1)))).first()[0] or 0
    slot = F.pmod(F.xxhash64("root", "part"), F.lit(max(1, total // GROUP))).alias("slot")
    met = stored(blocks.select("*", slot).groupBy("slot").applyInArrow(
        _apart, "root long, part long, node long, size int, fingerprint long, component long"), "similar")
    weight = met.agg(F.sum("size")).first()[0] or 0
    slot = F.pmod(F.xxhash64("root", "part"), F.lit(max(1, weight // SHINGLES))).alias("slot")
    whole = met.join(sets(met.select("node").distinct()), "node").select("root", "part", "node", "size", "fingerprint", "component", "hashes", slot)
    return whole.groupBy("slot").applyInArrow(_checked, "a long, b long")


def _sum(counts: DataFrame) -> int:
    return counts.agg(F.sum("n")).first()[0] or 0


def links(docs: DataFrame, signed: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """(a, b): links between nodes of similarity ``LEAST / OF`` or more. ``signed`` should be stored."""
    one = signed.groupBy("node").agg(F.min(F.struct("doc_id", "version", "size", "fingerprint", "roots")).alias("one")).select("node", "one.*")
    one = stored(one, "similar")
    prints = one.select("node", "size", "fingerprint", "roots")
    pairs = stored(candidates(prints), "similar")
    texts = keyed(docs, id_column, text_column)

    def sets(nodes: DataFrame) -> DataFrame:
        met = nodes.withColumnRenamed("node", "met")
        # by sorting at every size, so that the need for disk grows evenly with the input
        wanted = one.join(met.hint("merge"), one["node"] == met["met"], "left_semi").select("node", F.col("doc_id").alias("of"), "version")
        wanted = stored(wanted, "similar")
        same = texts["doc_id"].eqNullSafe(wanted["of"]) & (texts["version"] == wanted["version"])
        # a row listed more than once gives its set once
        return stored(sets_of(texts.join(wanted.hint("merge"), same).select("node", "text"), shingle).dropDuplicates(["node"]), "similar")

    of_pairs = sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    left = of_pairs.select(F.col("node").alias("a"), F.col("hashes").alias("of_a"))
    right = of_pairs.select(F.col("node").alias("b"), F.col("hashes").alias("of_b"))
    # sets whose sizes differ by more can not be that similar
    fits = F.least(F.size("of_a"), F.size("of_b")) * OF >= F.greatest(F.size("of_a"), F.size("of_b")) * LEAST
    both = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - both
    held = stored(pairs.join(left, "a").join(right, "b").where(fits & (both * OF >= either * LEAST)).select("a", "b"), "similar")
    return held.unionAll(stored(others(prints, connected_components(held, "a", "b", "similar"), sets), "similar"))


def near_copies(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """(doc_id, version, group): rows of one group are near copies, directly or through others."""
    signed = stored(signatures(docs, shingle, id_column, text_column), "similar")
    tied = stored(connected_components(links(docs, signed, shingle, id_column, text_column), "a", "b", "similar"), "similar")
    tied = tied.withColumnRenamed("node", "of")
    return signed.join(tied, signed["node"] == tied["of"], "left").select("doc_id", "version", F.coalesce("component", "node").alias("group"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the lowest id stays."""
    return lowest_of_each(docs, near_copies(docs, shingle, id_column, text_column), id_column, text_column)
