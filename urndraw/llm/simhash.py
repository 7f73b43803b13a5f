"""SimHash near-duplicates: fingerprints of word shingles, joined by a binary trie with itself.

Two nodes of the trie are visited together, the bits that differ on the way down are summed, and a pair of
nodes is left as soon as the sum exceeds the error budget. Spark deals the work out: of ``budget + 1`` blocks
of a fingerprint at least one is equal in any pair within the budget, so each block value is the root of one
trie over the other bits, and a root with too many leaves is divided in the same way again.

Defined cases: null text counts as empty; texts without words have fingerprint zero and link like any other;
rows that repeat, or have null ids, are fingerprinted like any other row, and a component's id is the smallest
id in it that is not null. Columns of the input other than id and text are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import connected_components, keyed, stored, text_or_empty

BITS = 64
#: A trie with more leaves is divided further.
LEAVES = 2048
#: Fingerprints whose tries are joined together, on average.
GROUP = 8192
#: Node pairs that are expanded together.
FRONTIER = 1 << 18


def fingerprint(text: str, shingle: int = 3) -> int:
    """The majority bits of XXH64 (seed 42) over all word shingles, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # both treat ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    stops = ends[size - 1:].tolist()
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(BITS, np.int64), len(stops)
    for at in range(0, total, 1 << 16):  # a very long text takes no more memory than this many shingles
        hashes = np.fromiter(
            (digest(joined[a:b], 42) for a, b in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)])), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, version, fingerprint as a signed long): one row per row of ``docs``; ``version`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "version", "fingerprint"])

    return keyed(docs, id_column, text_column).mapInArrow(run, "doc_id long, version long, fingerprint long")


def trie_pairs(values: np.ndarray, budget: int, depth_end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of ``values`` (distinct, sorted) that agree above the lowest ``depth_end`` bits and
    differ in at most ``budget`` of these.

    A node is a run of the sorted values with one prefix; what lies above ``depth_end`` names the trie. Pairs of nodes
    are kept as arrays and expanded one bit at a time, the deepest first, so memory stays bounded by depth times the
    size of a frontier.
    """
    tops = values >> np.uint64(depth_end) if depth_end < BITS else np.zeros(len(values), np.uint64)
    starts = np.flatnonzero(np.r_[True, tops[1:] != tops[:-1]]) if len(values) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(values)]
    roots = np.stack([starts, ends, starts, ends, np.zeros_like(starts)], axis=1)[ends - starts > 1]
    stack = [(0, roots)]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > FRONTIER:
            half = len(nodes) // 2
            stack += [(depth, nodes[half:]), (depth, nodes[:half])]
            continue
        if depth == depth_end:
            yield nodes[:, 0], nodes[:, 2]
            continue
        bit = np.uint64(1 << (depth_end - 1 - depth))
        a0, a1, b0, b1, errors = nodes.T
        # the right child of a run starts where its prefix, a one and zeros would stand
        mask = ~np.uint64((int(bit) << 1) - 1)
        amid = np.clip(np.searchsorted(values, (values[a0] & mask) | bit), a0, a1)
        same = a0 == b0
        bmid = np.where(same, amid, np.clip(np.searchsorted(values, (values[b0] & mask) | bit), b0, b1))
        children = []
        for low, high, low2, high2, cost in (
            (a0, amid, b0, bmid, 0), (amid, a1, bmid, b1, 0), (a0, amid, bmid, b1, 1), (amid, a1, b0, bmid, 1),
        ):
            keep = (high > low) & (high2 > low2) & (errors + cost <= budget)
            if cost and low is amid:
                keep &= ~same  # the mirror image within one node
            keep &= ~((low == low2) & (high - low <= 1))  # a single leaf with itself
            if keep.any():
                children.append(np.stack([low, high, low2, high2, errors + cost], axis=1)[keep])
        if children:
            stack.append((depth + 1, np.concatenate(children)))


def _rearranged(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The named bits of each value, the first of them highest."""
    out = np.zeros(len(values), np.uint64)
    for bit in bits:
        out = (out << np.uint64(1)) | ((values >> np.uint64(bit)) & np.uint64(1))
    return out


def forest(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each index below ``size`` the smallest index linked to it, directly or not."""
    root = np.arange(size)
    for left, right in pairs:
        while True:
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                break
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:  # shorten every path
                above = root[root]
                if (above == root).all():
                    break
                root = above
    return root


def _blocks(bits: list[int], count: int) -> list[list[int]]:
    size, more = divmod(len(bits), count)
    out, at = [], 0
    for i in range(count):
        step = size + (i < more)
        out.append(bits[at:at + step])
        at += step
    return out


def _bits_left(path: str, budget: int) -> list[int]:
    """The bits that the roots named in ``path`` have not yet fixed."""
    bits = list(range(BITS))
    for step in path:
        fixed = set(_blocks(bits, budget + 1)[int(step)])
        bits = [b for b in bits if b not in fixed]
    return bits


def links(prints: DataFrame, budget: int = 3, leaves: int = LEAVES, rows_per_group: int = GROUP) -> DataFrame:
    """(a, b): enough links between distinct fingerprints to join all that differ in ``budget`` bits or fewer.

    A link that others imply is left out: each group of tries returns a spanning forest of its links, so m close
    fingerprints give m rows, not m * m. ``prints`` should be stored: it is read once for the sizes and once for the work.
    """

    def divided(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                paths = np.array(batch.column(1).to_pylist(), object)
                prefixes = batch.column(2).to_numpy(zero_copy_only=False)
                for path in sorted(set(paths)):
                    mine = paths == path
                    for i, block in enumerate(_blocks(_bits_left(path, budget), budget + 1)):
                        value = _rearranged(values[mine], block).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(values[mine].view(np.int64)), pa.array([f"{path}{i}"] * int(mine.sum()), pa.string()),
                             pa.array((prefixes[mine] << len(block)) | value)], ["fingerprint", "path", "prefix"])

        return df.mapInArrow(run, "fingerprint long, path string, prefix long")

    tries = divided(prints.select("fingerprint", F.lit("").alias("path"), F.lit(0).cast("long").alias("prefix")))
    total = prints.count() * (budget + 1)
    parts, depth = [], 1
    while len(_bits_left("0" * depth, budget)) > np.log2(leaves):  # else the bits left bound the leaves
        large = stored(tries.groupBy("path", "prefix").agg(F.count("*").alias("n")).where(F.col("n") > leaves), "simhash")
        if large.limit(1).count() == 0:
            break
        parts.append(tries.join(large, ["path", "prefix"], "left_anti").select("fingerprint", "path", "prefix"))
        tries = stored(divided(tries.join(large, ["path", "prefix"], "left_semi").select("fingerprint", "path", "prefix")), "simhash")
        total += tries.count()
        depth += 1
    parts.append(tries)
    work = parts[0]
    for more in parts[1:]:
        work = work.unionAll(more)
    slots = max(1, total // ((budget + 1) * rows_per_group))

    def joined(table: pa.Table) -> pa.Table:
        values = table.column("fingerprint").to_numpy().view(np.uint64)
        bits = _bits_left(table.column("path")[0].as_py(), budget)[::-1]
        _, trie = np.unique(table.column("prefix").to_numpy(), return_inverse=True)
        keys = (trie.astype(np.uint64) << np.uint64(len(bits))) | _rearranged(values, bits)
        order = np.argsort(keys)
        values, keys = values[order], keys[order]
        root = forest(len(values), trie_pairs(keys, budget, len(bits)))
        tied = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": values[tied].view(np.int64), "b": values[root[tied]].view(np.int64)})

    slot = F.pmod(F.xxhash64("prefix"), F.lit(slots)).alias("slot")
    return work.select("fingerprint", "path", "prefix", slot).groupBy("path", "slot").applyInArrow(joined, "a long, b long")


def near_duplicates(docs: DataFrame, budget: int = 3, shingle: int = 3, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(doc_id, version, fingerprint, group, component_id): over links of ``budget`` bits or fewer.

    ``group`` is the smallest fingerprint reachable and ``component_id`` the smallest id, null if no row of the group has one.
    """
    prints = stored(fingerprints(docs, shingle, id_column, text_column), "simhash")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("own")), "simhash")
    parts = stored(connected_components(links(distinct, budget), "a", "b", "simhash"), "simhash")
    tied = parts.withColumnRenamed("node", "fingerprint").join(distinct, "fingerprint").select("fingerprint", "component", "own")
    first = tied.groupBy("component").agg(F.min("own").alias("first"))
    # only fingerprints that have a link are looked up by group; the others keep their own id
    tied = stored(tied.select("fingerprint", "component").join(first, "component"), "simhash")
    named = distinct.join(tied, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("group"),
        F.when(F.col("component").isNull(), F.col("own")).otherwise(F.col("first")).alias("component_id"))
    return prints.join(stored(named, "simhash"), "fingerprint").select("doc_id", "version", "fingerprint", "group", "component_id")


def one_of_each(docs: DataFrame, budget: int = 3, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the lowest id stays, null ids last, and
    rows equal in id and text count once."""
    return lowest_of_each(docs, near_duplicates(docs, budget, shingle, id_column, text_column), id_column, text_column)


def lowest_of_each(docs: DataFrame, near: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The same for any (doc_id, version, group) of the rows of ``docs``."""
    near = stored(near.select("doc_id", "version", "group"), "simhash")
    best = near.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "version")).alias("best"))
    counted = near.groupBy("group", "doc_id", "version").agg(F.count("*").alias("times")).withColumnRenamed("group", "of")
    same = (counted["of"] == best["group"]) & counted["doc_id"].eqNullSafe(F.col("best.doc_id")) & (counted["version"] == F.col("best.version"))

    def key(column) -> list:
        return [F.coalesce(column.cast("string"), F.lit("")).alias("__id")]  # an id that every row has

    chosen = stored(counted.join(best, same).select(*key(counted["doc_id"]), counted["version"].alias("__version"), "times"), "simhash")
    # the row itself is one column, so that its own names are of no matter
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       key(F.col(f"`{id_column}`").cast("long"))[0], F.xxhash64(text_or_empty(f"`{text_column}`")).alias("__version"))
    at = ["__id", "__version"]
    # by sorting at every size, so that the need for disk grows evenly with the input
    out = rows.join(chosen.where("times = 1").hint("merge"), at, "left_semi")
    several = chosen.where("times > 1")
    if several.limit(1).count():
        out = out.unionByName(rows.join(several, at, "left_semi").dropDuplicates(at))
    return out.select("row.*")
