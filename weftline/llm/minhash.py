"""Near-duplicate documents: MinHash with tensored banding, verified on full shingle sets.

Two small collections of sketches, left and right, hold ``tables`` sketches of ``rows`` minima
each.  Every pair (left i, right j) is the key of one table, so ``tables``^2 tables need only
``2 * tables * rows`` minima.  A pair of documents shares a table exactly when it agrees in some
left and in some right sketch, so keys are paired inside a left bucket, where the right
sketches of its members lie side by side.

Documents with equal shingle sets are one class from the start.  Buckets give candidate pairs
whose sketches agree widely; these pairs span candidate groups, and inside a group every pair
is compared by its complete shingle sets.  Buckets and groups beyond a cap are dealt into
blocks that meet pairwise in cells, so none is gathered in one task.

With the defaults two documents of similarity 0.85 meet in no table with probability 1e-5, and
less for closer ones; links below the threshold never pass the full comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from weftline.llm import words as W
from weftline.llm.groups import Forest, components, sorted_groups, stage, with_cells
from weftline.operators.lookup import lookup_join

SHINGLE = 5
_SHORT = np.uint64(0xA5A5A5A5A5A5A5A5)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Joined sorted distinct shingle hashes and their number per text.

    Words stand between ASCII white space, with A-Z in lower case.  A text of fewer than ``k``
    words has its whole sequence as one shingle; one without words has none.
    """
    w = W.words(texts, W.NOT_SPACE, W.LOWER_CASE)
    counts = w.counts
    starts = W.gram_starts(w.first, k)
    h = W.grams(w.hash, k)[starts] if len(starts) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(counts)), np.maximum(0, counts - k + 1))
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            whole[has] = W.mix(whole[has] * np.uint64(31) + w.hash[w.first[short[has]] + j])
        h, doc = np.concatenate([h, W.mix(whole ^ _SHORT)]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(counts))


def sketches(h: np.ndarray, sizes: np.ndarray, tables: int, rows: int) -> np.ndarray:
    """Minima of each set under ``2 * tables * rows`` hash functions, cut to 32 bits; empty sets get zeros."""
    functions = 2 * tables * rows
    out = np.zeros((len(sizes), functions), np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        at = (np.cumsum(sizes) - sizes)[full]
        seeds = np.random.default_rng(77).integers(1, 1 << 63, (functions, 2), dtype=np.uint64) | np.uint64(1)
        for f, (a, b) in enumerate(seeds):
            v = (h ^ b) * a
            v ^= v >> np.uint64(32)
            out[full, f] = np.minimum.reduceat((v * a) >> np.uint64(32), at)
    return out


def _features(tables: int, rows: int):
    def run(texts: pa.Array) -> list[pa.Array]:
        h, sizes = shingle_sets(texts)
        m = sketches(h, sizes, tables, rows)
        # equal sets have equal sums of their mixed members, size and minima
        total = np.zeros(len(sizes), np.uint64)
        full = np.flatnonzero(sizes)
        if len(full):
            at = (np.cumsum(sizes) - sizes)[full]
            total[full] = np.add.reduceat(W.mix(h * np.uint64(3)), at)
        other = W.grams(m[:, 0].astype(np.uint64) << np.uint64(32) | m[:, -1], 1) if len(m) else total
        return [pa.array(sizes, pa.int64()),
                pa.array([f"{a:016x}{b:016x}{s:x}" if s else None for a, b, s in zip(total.tolist(), other.tolist(), sizes.tolist())], pa.string()),
                pa.array([r.tobytes() for r in m], pa.binary())]

    return run


def _sets(texts: pa.Array) -> list[pa.Array]:
    h, sizes = shingle_sets(texts)
    ends = np.cumsum(sizes)
    raw = h.tobytes()
    return [pa.array([raw[8 * (e - s):8 * e] for e, s in zip(ends.tolist(), sizes.tolist())], pa.binary())]


def _sketch_edges(m: np.ndarray, tables: int, rows: int, least: int, cross: np.ndarray | None) -> list[tuple[int, int]]:
    """Pairs that span the candidate groups of one bucket: an agreeing right sketch, and ``least`` equal minima."""
    n = len(m)
    right = W.grams(m[:, tables * rows:].astype(np.uint64).reshape(n * tables, rows).ravel(), rows)[::rows].reshape(n, tables) if n else m
    forest, edges = Forest(n), []
    for i in range(n - 1):
        later = np.arange(i + 1, n)
        later = later[forest.up[later] != forest.root(i)]
        if cross is not None:
            later = later[cross[later] != cross[i]]
        if not len(later):
            continue
        near = (right[later] == right[i]).any(1)
        later = later[near]
        later = later[(m[later] == m[i]).sum(1) >= least] if len(later) else later
        for j in later:
            if forest.root(int(j)) != forest.root(i):
                forest.union(i, int(j))
                edges.append((i, int(j)))
    return edges


def _linked(sets: list[np.ndarray], percent: int, cross: np.ndarray | None) -> Forest:
    """Union of all pairs whose full sets are at least ``percent`` similar."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    forest = Forest(n)
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(inverse, kind="stable")
    owner, value = owner[order], inverse[order]
    first = np.searchsorted(value, np.arange(len(values) + 1))
    at = np.concatenate([[0], np.cumsum(size)])
    for i in range(n):
        root = forest.root(i)
        runs = inverse[at[i]:at[i + 1]]
        begin, count = first[runs], first[runs + 1] - first[runs]
        common = np.bincount(owner[np.repeat(begin, count) + W.ranges(count)], minlength=n)
        hit = 100 * common >= percent * (size + size[i] - common)
        hit[i] = False
        if cross is not None:
            hit &= cross != cross[i]
        for j in np.flatnonzero(hit):
            if forest.up[j] != root:
                forest.union(i, int(j))
                root = forest.root(i)
    return forest


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85,
                    tables: int = 10, rows: int = 2, cap: int = 1000) -> DataFrame:
    """Classes and components of documents whose shingle sets are at least ``percent`` % similar.

    Rows ``(id, n_shingles, class_id, component_id, kept)``, one per distinct non-null id:
    ``class_id`` is the smallest id with an equal set, ``component_id`` the smallest id reachable
    over links, ``kept`` whether that is the id itself.

    Null and empty texts and texts without words have no set and link with nothing.  Repeated
    rows count once; of several texts with one id the one that sorts first by hash is used.
    Rows with a null id are left out.  An empty table gives no rows.
    """
    source = docs.select(W.column(id_col).alias("id"), W.column(text).cast("string").alias("text")).filter("id is not null")
    source = source.withColumn("version", F.xxhash64("text"))
    facts = W.text_map(source, "text", ["id", "version"], _features(tables, rows), "n bigint, same string, sketch binary")
    facts = facts.select("row.*", "n", "same", "sketch").groupBy("id").agg(
        F.min(F.struct("version", "n", "same", "sketch")).alias("one")).select("id", "one.*")
    facts = stage(facts, "sketches")
    id_type = dict(facts.dtypes)["id"]

    # equal sets: one class, one representative
    classes = facts.filter("same is not null").groupBy("same").agg(F.min("id").alias("class_id"), F.first("sketch").alias("sketch"))
    reps = stage(classes.select(F.col("class_id").alias("id"), "same", "sketch"), "classes")
    edges = stage(_candidates(reps, id_type, tables, rows, cap, max(1, 2 * tables * rows // 2)), "candidates")
    groups = components(edges).withColumnRenamed("component", "grp").withColumnRenamed("node", "id")
    groups = stage(groups.join(facts.select("id", "version"), "id"), "groups")
    links = stage(_verified(source, groups, id_type, percent, cap), "links")
    joined = components(links).withColumnRenamed("node", "class_id").withColumnRenamed("component", "component_id")

    member = facts.select("id", "n", "same").join(reps.select("same", F.col("id").alias("class_id")), "same", "left")
    class_id = F.coalesce("class_id", "id")
    member = member.select("id", F.col("n").alias("n_shingles"), class_id.alias("class_id")).join(joined, "class_id", "left")
    component = F.coalesce("component_id", "class_id")
    return member.select("id", "n_shingles", "class_id", component.alias("component_id"), (component == F.col("id")).alias("kept"))


def _candidates(reps: DataFrame, id_type: str, tables: int, rows: int, cap: int, least: int) -> DataFrame:
    """Edges (src, dst) that span the candidate groups of every left bucket."""

    def left_keys(batches):
        for batch in batches:
            m = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1)[:, :tables * rows].astype(np.uint64)
            keys = W.grams(m.reshape(-1), rows)[::rows].reshape(-1, tables) if len(m) else m
            keys = W.mix(keys + np.arange(tables, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), W.list_array(keys.ravel().view(np.int64), np.full(batch.num_rows, tables), pa.int64())], ["id", "keys"])

    W.small_batches(reps, 5000)
    keyed = stage(reps.select("id", "sketch").mapInArrow(left_keys, f"id {id_type}, keys array<bigint>").select("id", F.explode("keys").alias("key")), "left-keys")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    in_cells = with_cells(keyed.join(shared, "key"), F.col("size"), F.col("id"), cap).select("key", "cell_a", "cell_b", "block", "id")
    in_cells = in_cells.join(reps.select("id", "sketch"), "id")

    def decode(batch: pa.RecordBatch) -> list[np.ndarray]:
        m = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
        return [*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "block")), m]

    def pairs(key: tuple, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids, block, m = columns
        found = np.array(_sketch_edges(m, tables, rows, least, None if key[1] == key[2] else block), np.int64).reshape(-1, 2)
        return ids[found[:, 0]], ids[found[:, 1]]

    return _edges_of_groups(in_cells, ["key", "cell_a", "cell_b"], decode, pairs, id_type).distinct()


def _edges_of_groups(cells: DataFrame, keys: list[str], decode, pairs, id_type: str) -> DataFrame:
    """Edges (src, dst) that ``pairs`` finds in each cell; rows of a cell come in the order of their ids."""
    placed = cells.repartition(*keys).sortWithinPartitions(*keys, "id")
    kind = placed.schema["id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), arrow) for c in zip(*held)], ["src", "dst"])

        for key, columns in sorted_groups(batches, keys, decode):
            found = pairs(key, columns)
            if len(found[0]):
                held.append(found)
                n += len(found[0])
            if n >= 10_000:
                yield batch_of()
                held, n = [], 0
        if held:
            yield batch_of()

    return placed.mapInArrow(run, f"src {id_type}, dst {id_type}")


def _verified(source: DataFrame, groups: DataFrame, id_type: str, percent: int, cap: int) -> DataFrame:
    """Edges (src, dst) that span the true components inside each candidate group, by full sets."""
    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    wanted = groups.join(sizes, "grp").select("id", "version", "grp", "size")
    # a repeated row meets its twin in the same cell, which changes nothing
    texts = lookup_join(source, stage(wanted, "wanted"), ["id", "version"])
    sets = W.text_map(texts, "text", ["id", "grp", "size"], _sets, "members binary").select("row.*", "members")
    cells = with_cells(sets, F.col("size"), F.col("id"), cap // 2)

    def decode(batch: pa.RecordBatch) -> list[np.ndarray]:
        members = np.empty(batch.num_rows, object)
        members[:] = batch.column("members").to_pylist()
        return [*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "block")), members]

    def compare(key: tuple, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids, block, members = columns
        roots = _linked([np.frombuffer(x, np.uint64) for x in members], percent, None if key[1] == key[2] else block).roots()
        linked = roots != np.arange(len(roots))
        return ids[linked], ids[roots[linked]]

    W.small_batches(cells)
    return _edges_of_groups(cells.select("grp", "cell_a", "cell_b", "block", "id", "members"), ["grp", "cell_a", "cell_b"], decode, compare, id_type)
