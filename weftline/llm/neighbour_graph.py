"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors of a label become one node with a weight, so copies cost one node.
2. A bounded sample of nodes gives cluster centres per label, none of them close to another.  Every node joins its
   ``overlap`` nearest clusters, so the shards overlap.  A shard beyond ``cap`` rows is dealt into blocks, and every
   two blocks meet in one cell, so a hot shard is many tasks.
3. Each cell builds a flat graph: the nearest candidates of a node are pruned robustly (a candidate goes when a kept
   neighbour is ``alpha`` times nearer to it), and edges hold both ways.
4. The adjacency lists of all cells are united per node.
5. Each cell searches for every member: a greedy walk from the medoid finds its surroundings, then the range expands
   over all nodes within ``(1 + 1 / alpha)`` times the link distance.  What lies within the link distance is verified
   in double precision and counted.  A pair that meets in several cells counts in the first one only.
6. The recall is audited by brute force for a bounded sample of vectors, half of them vectors with links, against all
   rows.  Below ``min_recall`` the links are completed by :func:`_cover_links`: a node then visits every cluster that
   could be the home of a neighbour (:func:`visits`), so any two linked nodes meet, and clusters are compared in full.

A node is compared with at most ``overlap`` shards, whatever the size of the table; the completion has no such bound.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.groups import Forest, components, stage, with_cells
from weftline.llm.words import column
from weftline.operators.lookup import lookup_join

MAX_CENTRES = 20_000
PRODUCT = 1 << 20  # cosines to centres at a time
SLACK = 1e-6  # for rounding, in favour of a visit


def unit_rows(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    largest = np.abs(x).max(1)
    odd = (largest < 1e-100) | (largest > 1e100)  # squares of these would be lost
    x[odd] /= largest[odd, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def spread_out(x: np.ndarray, nearest: float) -> np.ndarray:
    """Rows in order, without those whose cosine to an earlier kept one is above ``nearest``.

    A dense group then has one centre, which is the nearest of all its members, so they share a shard.
    """
    kept = np.empty_like(x)
    n = 0
    for row in x:
        if not n or (kept[:n] @ row).max() <= nearest:
            kept[n] = row
            n += 1
    return kept[:n]


def _usable(embeddings: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """One row per id that can be linked: vectors, labels and ids present, finite, not zero."""
    v = column(vector).cast("array<double>")
    ok = F.size(v) > 0
    ok &= ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0)
    rows = embeddings.select(column(id_col).alias("id"), column(label).alias("label"), v.alias("v"), ok.alias("ok"))
    rows = rows.filter("id is not null and label is not null and v is not null and ok").drop("ok")
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("one")).select("id", "one.label", "one.v")


def visits(x: np.ndarray, centres: np.ndarray, radii: np.ndarray, link: float) -> np.ndarray:
    """Which clusters (columns) could be the home of a vector with a cosine of at least ``link`` to a unit row of ``x``.

    Let ``d`` be the link angle, ``a`` the nearest centre of ``x`` and ``y`` a neighbour at home with ``c``.  Then
    ``y`` is at least as near to ``c`` as to ``a``; within ``d`` of ``x`` that needs ``x.(c - a) >= -|c - a| sin d``.
    And no member of ``c`` is farther from it than its radius, so the angle of ``x`` and ``c`` is at most that plus ``d``.
    ``radii`` holds angles, negative for clusters without members.
    """
    sims = x @ centres.T
    nearest = sims.argmax(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * (centres[nearest] @ centres.T)))
    d = np.arccos(np.clip(link, -1, 1))
    side = sims >= sims.max(1)[:, None] - apart * (np.sin(d) if d < np.pi / 2 else 1) - SLACK
    return side & (sims >= np.cos(np.minimum(np.pi, radii + d)) - SLACK) & (radii >= 0)


def robust_prune(x: np.ndarray, near: np.ndarray, sims: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Which candidates each node keeps: ``near`` holds rows of ``x`` per node, nearest first, ``sims`` their cosines to it.

    The nearest candidate left is kept, and those go to which it is ``alpha`` times nearer than the node is, until
    ``degree`` are kept.  Many nodes are pruned in step.
    """
    own = np.sqrt(np.maximum(0, 2 - 2 * sims))
    c = x[near]
    between = alpha * np.sqrt(np.maximum(0, 2 - 2 * (c @ c.transpose(0, 2, 1))))
    alive = np.ones(near.shape, bool)
    kept = np.zeros(near.shape, bool)
    for k in range(near.shape[1]):
        kept[:, k] = alive[:, k] & (kept.sum(1) < degree)
        alive &= ~kept[:, k, None] | (between[:, k] > own)
    return kept


def build_graph(x: np.ndarray, alpha: float, degree: int, pool: int) -> list[np.ndarray]:
    """Adjacency lists of one cell: pruned nearest candidates, edges in both directions."""
    n = len(x)
    take = min(pool, n - 1)
    if take < 1:
        return [np.zeros(0, np.int64) for _ in range(n)]
    small = x.astype(np.float32)  # only chooses edges; links are verified in double precision
    ends = []
    for begin in range(0, n, 256):
        sims = small[begin:begin + 256] @ small.T
        rows = np.arange(len(sims))
        sims[rows, begin + rows] = -2
        near = np.argpartition(-sims, take - 1, axis=1)[:, :take]
        near = np.take_along_axis(near, np.take_along_axis(-sims, near, 1).argsort(1, kind="stable"), 1)
        row, place = np.nonzero(robust_prune(small, near, np.take_along_axis(sims, near, 1), alpha, degree))
        ends.append(np.stack([begin + row, near[row, place]]))
    # a chain over a fixed order keeps separated groups reachable from the medoid
    a, b = np.concatenate([*ends, np.stack([np.arange(n - 1), np.arange(1, n)])], axis=1)
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, n)))


def range_search(x: np.ndarray, graph: list[np.ndarray], q: int, start: int, link: float, alpha: float, steps: int = 8) -> np.ndarray:
    """Nodes with cosine to ``q`` of at least ``link``, found from ``start`` by walking and expanding."""
    at, best = start, float(x[start] @ x[q])
    for _ in range(steps):  # the walk; the query is a node itself, so its place is known in the end
        nbrs = graph[at]
        if at == q or not len(nbrs):
            break
        s = x[nbrs] @ x[q]
        k = int(s.argmax())
        if s[k] <= best:
            break
        at, best = int(nbrs[k]), float(s[k])
    reach = np.sqrt(max(0.0, 2 - 2 * link)) * (1 + 1 / alpha)
    wide = 1 - reach * reach / 2
    seen = np.zeros(len(x), bool)
    seen[q] = True
    frontier = np.array(sorted({q, at} if best >= wide else {q}), np.int64)
    seen[frontier] = True
    found = [frontier]
    while len(frontier):
        nxt = np.unique(np.concatenate([graph[i] for i in frontier]))
        nxt = nxt[~seen[nxt]]
        seen[nxt] = True
        frontier = nxt[x[nxt] @ x[q] >= wide]
        found.append(frontier)
    nodes = np.concatenate(found)
    nodes = nodes[nodes != q]
    return nodes[np.einsum("ij,j->i", x[nodes], x[q]) >= link]


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                    link: float = 0.93, overlap: int = 2, per_shard: int = 500, cap: int = 2000, alpha: float = 1.2,
                    degree: int = 24, pool: int = 64, audit: int = 500, min_recall: float = 1.0) -> DataFrame:
    """Links and components of vectors with equal labels and a cosine of at least ``link``.

    Rows ``(id, n_links, component_id, kept, audit_recall, audit_links)``, one per distinct non-null id; the last two say
    which share of how many true links of the audited vectors the graph search found (1 of 0 where they had none).
    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, link
    with nothing.  Vectors of different lengths never link.  A repeated row counts once; of
    several vectors with one id the smallest (label, vector) is used.  Empty in, empty out.
    """
    rows = usable(embeddings, id_col, vector, label)
    nodes = stage(rows.groupBy("label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")), "nodes")
    named = stage(lookup_join(rows, nodes.select("label", "v", F.col("id").alias("node"), "weight"), ["label", "v"]).drop("v", "label"), "named")
    centres = _centres(nodes, link, per_shard)
    result = stage(_graph_links(nodes, centres, link, overlap, cap, alpha, degree, pool), "links")
    recall, seen = audit_recall(rows, _per_row(named, result), link, audit)
    if recall < min_recall:
        result = stage(_cover_links(nodes, centres, link, cap), "covered")
    linked = components(result.select(F.col("id").alias("src"), F.explode("roots").alias("dst")))
    found = _per_row(named, result).join(linked.withColumnRenamed("component", "top"), "node", "left")
    everyone = embeddings.select(column(id_col).alias("id")).filter("id is not null").distinct()
    out = everyone.join(found, "id", "left")
    component = F.coalesce("top", "node", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), (component == F.col("id")).alias("kept"),
                      F.lit(float(recall)).alias("audit_recall"), F.lit(int(seen)).cast("bigint").alias("audit_links"))


def _per_row(named: DataFrame, result: DataFrame) -> DataFrame:
    """``(id, node, n_links)``: copies link with their node's links and with each other."""
    counts = result.select(F.col("id").alias("node"), "n_links")
    return lookup_join(named, counts, ["node"], "left").select("id", "node", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Staged rows (id, label, v) that can be linked; the label carries the length of the vector."""
    return stage(_usable(embeddings, id_col, vector, label).withColumn(
        "label", F.concat_ws(":", F.col("label").cast("string"), F.size("v").cast("string"))), "vectors")


def _centres(rows: DataFrame, link: float, per_shard: int) -> dict[str, np.ndarray]:
    n = rows.count()
    share = min(1.0 / per_shard, MAX_CENTRES / max(1, n))
    hashed = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.filter(hashed < share).select("label", "id", "v").toPandas() if n else pd.DataFrame()
    return {name: spread_out(unit_rows(part.sort_values("id")["v"]), link - 0.1)
            for name, part in (picked.groupby("label") if len(picked) else ())}


def _slices(pdf: pd.DataFrame, centres: dict[str, np.ndarray]):
    """(label, rows, unit vectors, centres or none) in slices whose products with the centres stay small."""
    for name, part in pdf.groupby("label"):
        c = centres.get(name)
        step = len(part) if c is None else max(1, PRODUCT // len(c))
        for begin in range(0, len(part), step):
            some = part.iloc[begin:begin + step]
            yield name, some, unit_rows(some["v"]), c


def _cover_links(rows: DataFrame, centres: dict[str, np.ndarray], link: float, cap: int) -> DataFrame:
    """(id, n_links, roots) of every node by exact comparison of all clusters that may hold a neighbour."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(centres)
    id_type = dict(rows.dtypes)["id"]

    def settle(batches):
        for pdf in batches:
            for _, some, x, c in _slices(pdf, shared.value):
                sims = x @ c.T if c is not None else np.ones((len(x), 1))
                home = sims.argmax(1)
                yield some.assign(home=home.astype(np.int32), near=sims[np.arange(len(x)), home])

    kinds = f"id {id_type}, weight bigint, label string, v array<double>"
    homes = stage(rows.select("id", "weight", "label", "v").mapInPandas(settle, f"{kinds}, home int, near double"), "homes")
    # one row per cluster centre (or label without one): at most MAX_CENTRES plus the labels
    widest: dict[str, np.ndarray] = {name: np.full(len(c), -1.0) for name, c in centres.items()}
    for r in homes.groupBy("label", "home").agg(F.min("near").alias("near")).collect():
        if r["label"] in widest:
            widest[r["label"]][r["home"]] = np.arccos(np.clip(r["near"], -1, 1))
    radii = context.broadcast(widest)

    def visit(batches):
        for pdf in batches:
            for name, some, x, c in _slices(pdf, shared.value):
                goes = visits(x, c, radii.value[name], link) if c is not None else np.ones((len(x), 1), bool)
                home = some["home"].to_numpy()
                goes[np.arange(len(x)), home] = True
                row, shard = np.nonzero(goes)
                for begin in range(0, len(row), 2000):
                    r, k = row[begin:begin + 2000], shard[begin:begin + 2000]
                    part = some[["id", "weight", "label", "v"]].iloc[r]
                    yield part.assign(shard=k.astype(np.int32), at_home=k == home[r])

    members = stage(homes.mapInPandas(visit, f"{kinds}, shard int, at_home boolean"), "members")
    sizes = members.groupBy("label", "shard").agg(F.count(F.lit(1)).alias("size"))
    cells = with_cells(members.join(sizes, ["label", "shard"]), F.col("size"), F.col("id"), cap)
    keys = ["label", "shard", "cell_a", "cell_b"]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        ids, block, x = pdf["id"].to_numpy(), pdf["block"].to_numpy(), unit_rows(pdf["v"])
        spans = pdf["cell_a"].iloc[0] != pdf["cell_b"].iloc[0]  # pairs inside a block belong to its own cell
        base = np.flatnonzero(pdf["at_home"].to_numpy())
        weight = pdf["weight"].to_numpy()[base]
        forest = Forest(len(ids))
        counts = np.zeros(len(ids), np.int64)
        for begin in range(0, len(ids), 256):
            some = np.arange(begin, min(begin + 256, len(ids)))
            hit = x[some] @ x[base].T >= link
            hit &= block[some][:, None] != block[base][None, :] if spans else some[:, None] != base[None, :]
            counts[some] = hit @ weight
            forest.add_matrix(hit, some, base)
        return pd.DataFrame({"id": ids, "n": counts, "root": ids[forest.roots()]})

    found = cells.select("id", "weight", *keys, "block", "at_home", "v").groupBy(*keys).applyInPandas(compare, f"id {id_type}, n bigint, root {id_type}")
    return found.groupBy("id").agg(F.sum("n").alias("n_links"), F.collect_set("root").alias("roots"))


def _graph_links(nodes: DataFrame, centres: dict[str, np.ndarray], link: float, overlap: int, cap: int, alpha: float, degree: int, pool: int) -> DataFrame:
    """(id, n_links, roots): links of each node by weight, and the smallest ids of its local components."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)

    def assign(batches):
        for pdf in batches:
            for _, some, x, c in _slices(pdf, shared.value):
                if c is None:
                    near = np.zeros((len(x), 1), np.int32)
                else:
                    take = min(overlap, len(c))
                    near = np.sort(np.argpartition(-(x @ c.T), take - 1, axis=1)[:, :take], axis=1)
                yield some.assign(shards=[list(map(int, n)) for n in near])

    id_type = dict(nodes.dtypes)["id"]
    homes = nodes.select("id", "weight", "label", "v").mapInPandas(assign, f"id {id_type}, weight bigint, label string, v array<double>, shards array<int>")
    members = stage(homes.withColumn("shard", F.explode("shards")), "members")
    sizes = members.groupBy("label", "shard").agg(F.count(F.lit(1)).alias("size"))
    # one row per cluster centre (or label without one): at most MAX_CENTRES plus the labels
    cells = members.join(sizes, ["label", "shard"])
    cells = with_cells(cells, F.col("size"), F.col("id"), cap).select("id", "weight", "label", "shard", "shards", "block", "cell_a", "cell_b", "v")
    keys = ["label", "shard", "cell_a", "cell_b"]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        ids = pdf["id"].to_numpy()
        graph = build_graph(unit_rows(pdf["v"]), alpha, degree, pool)
        return pd.DataFrame({"id": ids, "nbrs": [ids[g] for g in graph]})

    lists = cells.select("id", *keys, "v").groupBy(*keys).applyInPandas(build, f"id {id_type}, nbrs array<{id_type}>")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        ids, block, shard = pdf["id"].to_numpy(), pdf["block"].to_numpy(), int(pdf["shard"].iloc[0])
        x = unit_rows(pdf["v"])
        place = pd.Index(ids)
        weight = pdf["weight"].to_numpy()
        graph = []
        for i, nbrs in enumerate(pdf["nbrs"]):
            g = place.get_indexer(np.asarray(nbrs, ids.dtype))  # edges into other cells are walked there
            graph.append(g[g >= 0])
        width = max(len(s) for s in pdf["shards"])
        homes = np.full((len(ids), width), -1)
        for i, s in enumerate(pdf["shards"]):
            homes[i, :len(s)] = s
        a, b = pdf["cell_a"].iloc[0], pdf["cell_b"].iloc[0]
        medoid = int((x @ x.mean(0)).argmax())
        forest = Forest(len(ids))
        counts = np.zeros(len(ids), np.int64)
        for q in range(len(ids)):
            hits = range_search(x, graph, q, medoid, link, alpha)
            if not len(hits):
                continue
            if a != b:
                hits = hits[block[hits] != block[q]]  # pairs inside a block belong to its own cell
            common = (homes[hits][:, :, None] == np.where(homes[q] < 0, -2, homes[q])[None, None, :])
            first = np.where(common.any(2), homes[hits], np.iinfo(np.int64).max).min(1)
            hits = hits[first == shard]
            counts[q] = weight[hits].sum()
            root = forest.root(q)
            for j in hits[forest.up[hits] != root]:
                forest.union(q, int(j))
        return pd.DataFrame({"id": ids, "n": counts, "root": ids[forest.roots()]})

    found = cells.join(united, "id").groupBy(*keys).applyInPandas(search, f"id {id_type}, n bigint, root {id_type}")
    return found.groupBy("id").agg(F.sum("n").alias("n_links"), F.collect_set("root").alias("roots"))


def audit_recall(rows: DataFrame, result: DataFrame, link: float, queries: int) -> tuple[float, int]:
    """Share of the links of a bounded sample of vectors that ``result`` has, by brute force against all rows, and their number.

    Half of the sample are vectors with links, so that it sees links where they are rare.
    """
    linked = result.filter("n_links > 0").select("id")
    order = [F.xxhash64(F.lit(23), "id"), F.col("id")]
    some = linked.orderBy(*order).limit(queries - queries // 2).union(rows.select("id").orderBy(*order).limit(queries // 2)).distinct()
    sample = rows.join(F.broadcast(some), "id").toPandas()  # at most ``queries`` rows
    if not len(sample):
        return 1.0, 0
    groups = {name: (part["id"].to_numpy(), unit_rows(part["v"])) for name, part in sample.groupby("label")}
    shared = rows.sparkSession.sparkContext.broadcast(groups)

    def count(batches):
        for pdf in batches:
            for name, part in pdf.groupby("label"):
                if name in shared.value:
                    ids, q = shared.value[name]
                    hits = (q @ unit_rows(part["v"]).T >= link) & (ids[:, None] != part["id"].to_numpy()[None, :])
                    yield pd.DataFrame({"id": ids, "n": hits.sum(1)})

    true = rows.mapInPandas(count, f"id {dict(rows.dtypes)['id']}, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    pair = true.join(result, "id").agg(F.sum("n").alias("t"), F.sum(F.least("n", "n_links")).alias("f")).first()
    return (pair["f"] / pair["t"], pair["t"]) if pair["t"] else (1.0, 0)
