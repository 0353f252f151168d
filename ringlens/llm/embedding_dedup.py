"""Near duplicates of embeddings by a robust-pruned flat graph.

Equal vectors of a label are one node. The nodes of a label are split into cluster shards, level by level, until a shard has at
most ``SHARD`` nodes; a node goes to the shards of its nearest ``overlap`` pivots, so shards overlap. A large shard that its pivots
do not divide is compared in full, block against block. In each other shard
every node gets a bounded list of neighbours by robust pruning (a candidate is dropped if a chosen neighbour is nearer to it by a factor). The
lists of a node from all its shards are united. A greedy search then runs for every node in each of its shards: it starts at
the shard's medoids and the node itself, follows the lists to ever nearer nodes, and, once within range, expands every
node within range. What it finds is verified in double precision and joins nodes to components across all shards.

The search stays within a shard, so it does not meet every link of a component that spans several. The links are therefore counted
by comparing all nodes of a component, in blocks of about ``SHARD`` nodes; block pairs that the triangle inequality on angles rules
out are left out. Links are counted, never written as pairs.

Links between different components can still be missing. The recall is audited: a bounded sample of nodes is compared with all nodes
of its label. If it is below ``RECALL`` the index is built again with more overlap, and after the last overlap all
nodes of a label are compared in the same blocks, which misses none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import broadcast_checked, connected_components, only_columns, small_batches
from ringlens.plans.runtime import materialize

SHARD = 1024
PIVOTS = 32  # that a shard is split by at once
DEGREE, POOL, ALPHA = 16, 64, 1.2
BEAM = 24
STEP = 8  # nodes within range that a row expands at once
SLACK = 0.05  # nodes this much below the range are expanded too
MEDOIDS = 4
OVERLAPS = (2, 3, 4)
RECALL = 0.95
AUDITED = 128  # nodes in the audit's sample, about
DIVIDED = 0.5  # of its parent's nodes a large shard has at most, or it is not divided further


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (vec_id, embedding, label): (vec_id, node) of every row, and (node, home, copies, vec) of every distinct vector.

    ``node`` is a hash of label and vector, null for rows that link with nothing; ``home`` stands for the label and the number
    of components; ``vec`` holds the components as doubles.
    """

    def run(column: pa.Array) -> pa.Array:
        out = []
        for v in column.to_pylist():
            x = None if v is None or None in v else np.array(v, np.float64)
            good = x is not None and len(x) and np.isfinite(x).all() and 0 < np.linalg.norm(x) < np.inf
            out.append((x + 0.0).tobytes() if good else None)
        return pa.array(out, pa.binary())

    rows = vectors.select("vec_id", "label", F.arrow_udf(run, "binary")("embedding").alias("vec"))
    node = F.when(F.col("label").isNotNull() & F.col("vec").isNotNull(), F.xxhash64("label", "vec"))
    rows = materialize(rows.withColumn("node", node), "vectors")
    distinct = rows.filter("node is not null").groupBy("node").agg(
        F.first("vec").alias("vec"), F.first(F.xxhash64("label", F.length("vec"))).alias("home"), F.count(F.lit(1)).alias("copies")
    )
    return rows.select("vec_id", "node"), materialize(distinct, "vector-nodes")


def _unit(vecs) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def shards(nodes: DataFrame, overlap: int) -> tuple[DataFrame, DataFrame]:
    """Two tables (shard, node, vec, main): every node in the shards of its nearest pivots, at most ``SHARD`` nodes each, and the
    larger shards that pivots do not divide. ``main`` marks one place of every node in the two tables together."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, node, vec, main = ([], [], [], [])
            rows = pd.DataFrame({k: b.column(k).to_pylist() for k in ("shard", "node", "vec", "main")})
            for name, group in rows.groupby("shard"):
                pivot = _unit(b.column("pivots")[int(group.index[0])].as_py())  # the same in all rows of a shard
                near = np.argsort(-(_unit(list(group["vec"])) @ pivot.T), axis=1, kind="stable")
                for j in range(min(overlap, near.shape[1])):
                    shard += [(name, int(r)) for r in near[:, j]]
                    node += list(group["node"])
                    vec += list(group["vec"])
                    main += [bool(m) and j == 0 for m in group["main"]]
            yield pa.record_batch(
                [pa.array([s for s, _ in shard], pa.int64()), pa.array([r for _, r in shard], pa.int64()), pa.array(node, pa.int64()), pa.array(vec, pa.binary()), pa.array(main, pa.bool_())],
                ["old", "pivot", "node", "vec", "main"],
            )

    done, whole = [], []
    rest = nodes.select(F.col("home").alias("shard"), "node", "vec", F.lit(True).alias("main"), F.lit(0).cast("long").alias("parent"))
    level = 0
    while True:  # ends, as a shard that is divided again has at most half of its parent's nodes
        size = rest.groupBy("shard").agg(F.count(F.lit(1)).alias("size"), F.max("parent").alias("parent"))
        large = size.filter(F.col("size") > SHARD)
        large = materialize(large.select("shard", "size", ((F.col("parent") > 0) & (F.col("size") > F.col("parent") * DIVIDED)).alias("stays")), "large-shards")
        n, stay = large.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("stays").cast("long")), F.lit(0))).first()
        rest = rest.drop("parent")
        done.append(rest.join(broadcast_checked(large.select("shard"), n), "shard", "left_anti"))
        if stay:
            whole.append(rest.join(broadcast_checked(large.filter("stays").select("shard"), stay), "shard", "left_semi"))
        if n == stay:
            break
        few = broadcast_checked(large.filter("not stays").select("shard", "size"), n - stay)
        inside = rest.join(few, "shard")
        chance = F.xxhash64("node", F.lit(level))
        wanted = F.least(F.lit(PIVOTS), F.ceil(F.col("size") * 2 / SHARD) + 1)
        # about as many pivots as wanted, drawn by hash and bounded exactly below
        drawn = inside.filter(F.pmod(chance, F.lit(1 << 30)) < (wanted * 4 + 16) / F.col("size") * (1 << 30))
        pivots = drawn.groupBy("shard").agg(
            F.sort_array(F.collect_list(F.struct(chance.alias("c"), F.col("vec").alias("v")))).alias("p"), F.first(wanted).alias("n")
        ).select("shard", F.transform(F.slice("p", 1, F.col("n").cast("int")), lambda x: x["v"]).alias("pivots"))
        pivots = materialize(pivots, "pivots")
        split = inside.select("shard", "node", "vec", "main").join(broadcast_checked(pivots, pivots.count(), 2000), "shard")
        split = split.mapInArrow(nearest, "old long, pivot long, node long, vec binary, main boolean")
        split = split.join(few.select(F.col("shard").alias("old"), F.col("size").alias("parent")), "old")
        rest = materialize(split.select(F.xxhash64("old", "pivot").alias("shard"), "node", "vec", "main", "parent"), "shards")
        level += 1
    return materialize(reduce(DataFrame.union, done), "shards"), materialize(reduce(DataFrame.union, whole or [done[0].limit(0)]), "whole-shards")


def pruned_lists(x: np.ndarray) -> np.ndarray:
    """Robust-pruned neighbours of each row of the unit vectors ``x``: (n, DEGREE) indices, the row's own where there are fewer."""
    n = len(x)
    x = x.astype(np.float32)
    sim = x @ x.T
    np.fill_diagonal(sim, -np.inf)
    pool = min(POOL, n - 1)
    out = np.repeat(np.arange(n)[:, None], DEGREE, axis=1)
    if pool < 1:
        return out
    cand = np.argpartition(-sim, pool - 1, axis=1)[:, :pool]
    near = np.take_along_axis(sim, cand, axis=1)
    alive = np.ones_like(near, bool)
    rows = np.arange(n)
    for r in range(DEGREE):
        best = np.argmax(np.where(alive, near, -np.inf), axis=1)
        some = alive.any(axis=1)
        if not some.any():
            break
        chosen = cand[rows, best]
        out[some, r] = chosen[some]
        alive[rows, best] = False
        between = np.maximum(2 - 2 * np.take_along_axis(sim[chosen], cand, axis=1), 0)
        alive &= ALPHA**2 * between > 2 - 2 * near
    return out


def range_search(x: np.ndarray, lists: list[np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of rows of the unit vectors ``x`` with a cosine of at least ``reach`` that the search finds.

    All rows search at once; a row's next step is its best node not yet expanded, as long as that is among its ``BEAM`` best or within
    range."""
    n = len(x)
    width = max(map(len, lists), default=0) + 1
    table = np.repeat(np.arange(n)[:, None], width, axis=1)
    for i, m in enumerate(lists):
        table[i, : len(m)] = m
    y = x.astype(np.float32)
    found = np.full((n, n), -np.inf, np.float32)
    todo = np.zeros((n, n), bool)
    centre = y.mean(0)
    starts = [int(np.argmax(y @ centre))]
    while len(starts) < min(MEDOIDS, n):  # then those farthest from all before
        starts.append(int(np.argmin((y @ y[starts].T).max(1))))
    for s in starts:
        found[:, s] = y @ y[s]
        todo[:, s] = True
    rows = np.arange(n)
    found[rows, rows] = 1.0
    todo[rows, rows] = True
    active = rows
    while len(active):
        score = np.where(todo[active], found[active], -np.inf)
        top = score.max(1)
        near = top >= reach - SLACK
        go, far = near.copy(), np.flatnonzero(~near & (top > -np.inf))
        if len(far):
            beam = min(BEAM, n) - 1
            go[far] = top[far] >= -np.partition(-found[active[far]], beam, axis=1)[:, beam]
        active, score, near = active[go], score[go], near[go]
        if not len(active):
            break
        few = min(STEP, n)
        best = np.argpartition(-score, few - 1, axis=1)[:, :few]
        value = np.take_along_axis(score, best, axis=1)
        # within range several nodes are expanded at once, on the way there only the best
        use = np.where(near[:, None], value >= reach - SLACK, (value == value.max(1, keepdims=True)) & (value > -np.inf))
        for k in range(few):
            r = np.flatnonzero(use[:, k])
            if len(r):
                row, at = active[r], best[r, k]
                todo[row, at] = False
                nbr = table[at]
                new = found[row[:, None], nbr] == -np.inf
                found[row[:, None], nbr] = np.einsum("ad,awd->aw", y[row], y[nbr], optimize=True)
                i, j = np.nonzero(new)
                todo[row[i], nbr[i, j]] = True
    i, j = np.nonzero(found >= reach - 1e-4)
    return i[i < j], j[i < j]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of ``n`` nodes under the links (i, j)."""
    at = np.arange(n)
    while True:
        new = at.copy()
        low = np.minimum(at[i], at[j])
        np.minimum.at(new, at[i], low)
        np.minimum.at(new, at[j], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == at).all():
            return at
        at = new


def in_blocks(members: DataFrame, cells: DataFrame) -> DataFrame:
    """(group, block, many, rows) from (group, node, copies, vec): a group of at most ``SHARD`` nodes is one block, the nodes of
    a larger one are dealt by their cell (node, cell) and, in cells of more than ``SHARD`` nodes, by hash."""
    big = members.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARD).select("group")
    big = materialize(big, "big-groups")
    few = broadcast_checked(big, big.count())
    small = members.join(few, "group", "left_anti").withColumn("block", F.lit(0).cast("long")).withColumn("many", F.lit(False))
    dealt = materialize(members.join(few, "group", "left_semi").join(cells, "node"), "dealt")
    full = dealt.groupBy("group", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARD)
    full = materialize(full, "full-cells")
    dealt = dealt.join(broadcast_checked(full, full.count()), ["group", "cell"], "left")
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.coalesce(F.ceil(F.col("n") / SHARD), F.lit(1)))
    dealt = dealt.withColumn("block", F.xxhash64("cell", part)).withColumn("many", F.lit(True))
    columns = ["group", "block", "many", "node", "copies", "vec"]
    both = small.select(*columns).union(dealt.select(*columns))
    packed = both.groupBy("group", "block", "many").agg(F.collect_list(F.struct("node", "copies", "vec")).alias("rows"))
    return materialize(packed.select("group", "block", "many", "rows.node", "rows.copies", "rows.vec"), "blocks")


def _linked(a: np.ndarray, b: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``a`` and ``b`` with a cosine of at least ``reach``, in double precision."""
    near = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    i, j = np.nonzero(near >= reach - 1e-9)
    edge = np.flatnonzero(near[i, j] < reach + 1e-9)
    good = np.ones(len(i), bool)
    good[edge] = cosines(a[i[edge]], b[j[edge]]) >= reach
    return i[good], j[good]


def compared(blocks: DataFrame, reach: float, count: bool) -> DataFrame:
    """All nodes of a group compared, block against block, exactly: (node, others), the number of rows that a node
    links with, or else (u, v) that join the linked nodes of a group to components."""
    schema = "node long, others long" if count else "u long, v long"
    names = ["node", "others"] if count else ["u", "v"]
    limit = float(np.arccos(min(1.0, reach)))

    def matrix(vecs) -> np.ndarray:
        return np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)

    def result(node: np.ndarray, copies: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if count:
            others = np.zeros(len(node), np.int64)
            np.add.at(others, i, copies[j])
            np.add.at(others, j, copies[i])
            return node[others > 0], others[others > 0]
        root = roots(len(node), i, j)
        away = root != np.arange(len(node))
        return node[away], node[root[away]]

    def batch(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        left, right = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        return pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for node, copies, vec in zip(*(b.column(k).to_pylist() for k in ("node", "copies", "vec")), strict=True):
                x = matrix(vec)
                i, j = _linked(x, x, reach)
                found.append(result(np.array(node), np.array(copies), i[i < j], j[i < j]))
            yield batch(found)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                node, copies, vec, node2, copies2, vec2 = (b.column(c)[k].as_py() for c in ("node", "copies", "vec", "node2", "copies2", "vec2"))
                i, j = _linked(matrix(vec), matrix(vec2), reach)
                yield batch([result(np.array(node + node2), np.array(copies + copies2), i, j + len(node))])

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            centre, radius = [], []
            for vec in b.column("vec").to_pylist():
                x = _unit(vec)
                c = x.mean(0)
                c = c / np.linalg.norm(c) if np.linalg.norm(c) > 1e-9 else x[0]
                centre.append(c.tobytes())
                radius.append(float(np.arccos(np.clip(x @ c, -1, 1)).max()))
            yield pa.record_batch([b.column("group"), b.column("block"), pa.array(centre, pa.binary()), pa.array(radius, pa.float64())], ["group", "block", "centre", "radius"])

    def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keep = []
            for c, c2, r, r2 in zip(*(b.column(k).to_pylist() for k in ("centre", "centre2", "radius", "radius2")), strict=True):
                angle = np.arccos(np.clip(np.frombuffer(c) @ np.frombuffer(c2), -1, 1))
                keep.append(bool(angle <= r + r2 + limit + 1e-6))
            yield b.select(["group", "block", "block2"]).filter(pa.array(keep, pa.bool_()))

    own = blocks.select("node", "copies", "vec").mapInArrow(within, schema)
    head = materialize(blocks.filter("many").select("group", "block", "vec").mapInArrow(heads, "group long, block long, centre binary, radius double"), "heads")
    other = head.select("group", F.col("block").alias("block2"), F.col("centre").alias("centre2"), F.col("radius").alias("radius2"))
    pairs = head.join(other, "group").filter("block < block2").mapInArrow(reachable, "group long, block long, block2 long")
    first = blocks.filter("many").select("group", "block", "node", "copies", "vec")
    second = first.toDF("group", "block2", "node2", "copies2", "vec2")
    cross = materialize(pairs, "block-pairs").join(first, ["group", "block"]).join(second, ["group", "block2"])
    out = own.union(cross.select("node", "copies", "vec", "node2", "copies2", "vec2").mapInArrow(between, schema))
    if count:
        return materialize(out.groupBy("node").agg(F.sum("others").alias("others")), "link-counts")
    return materialize(out.distinct(), "vector-links")


def joined_nodes(nodes: DataFrame, reach: float, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(u, v) that join nodes whose links the search found and verified to components, and (node, cell), a shard of every node."""
    placed, whole = shards(nodes, overlap)

    def lists(rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy()
        nbr = pruned_lists(_unit(list(rows["vec"])))
        i, _ = np.nonzero(nbr != np.arange(len(node))[:, None])
        return pd.DataFrame({"node": node[i], "nbr": node[nbr[nbr != np.arange(len(node))[:, None]]]})

    edges = placed.select("shard", "node", "vec").groupBy("shard").applyInPandas(lists, "node long, nbr long")
    united = edges.groupBy("node").agg(F.collect_set("nbr").alias("nbrs"))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")
        node = rows["node"].to_numpy()
        raw = np.frombuffer(b"".join(rows["vec"]), np.float64).reshape(len(node), -1)
        own = []
        for nbrs in rows["nbrs"]:
            m = np.sort(np.array(nbrs if nbrs is not None else [], np.int64))
            at = np.minimum(np.searchsorted(node, m), len(node) - 1)
            own.append(at[node[at] == m])
        i, j = range_search(raw / np.linalg.norm(raw, axis=1, keepdims=True), own, reach)
        good = np.concatenate([cosines(raw[i[k : k + 65536]], raw[j[k : k + 65536]]) >= reach for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
        root = roots(len(node), i[good], j[good])
        away = root != np.arange(len(node))
        return pd.DataFrame({"u": node[away], "v": node[root[away]]})

    full = placed.select("shard", "node", "vec").join(united, "node", "left")
    found = materialize(full.groupBy("shard").applyInPandas(search, "u long, v long").distinct(), "vector-links")
    cells = placed.filter("main").select("node", F.col("shard").alias("cell")).union(whole.filter("main").select("node", F.col("shard").alias("cell")))
    if not whole.isEmpty():
        members = whole.select(F.col("shard").alias("group"), "node", F.lit(1).cast("long").alias("copies"), "vec")
        found = found.union(compared(in_blocks(members, whole.select("node", F.col("shard").alias("cell")).distinct()), reach, count=False))
    return found, cells


def audit(nodes: DataFrame, group: DataFrame, reach: float, sample: int = AUDITED) -> float:
    """Share of the links of a bounded sample of nodes that is inside a component of ``group`` (node, component), by comparing the sample
    with all nodes of its label."""
    n = nodes.count()
    picked = nodes.filter(F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 30)) < min(1.0, sample / max(n, 1)) * (1 << 30))
    drawn = {home: rows for home, rows in picked.select("home", "node", "vec").limit(4 * sample).toPandas().groupby("home")}
    if not drawn:
        return 1.0
    drawn = {home: (rows["node"].to_numpy(), np.frombuffer(b"".join(rows["vec"]), np.float64).reshape(len(rows), -1)) for home, rows in drawn.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v = [], []
            for home, node, vec in zip(*(b.column(k).to_pylist() for k in ("home", "node", "vec")), strict=True):
                if home in drawn:
                    x = np.frombuffer(vec, np.float64)
                    ids, y = drawn[home]
                    near = ids[(y @ x / (np.linalg.norm(y, axis=1) * np.linalg.norm(x)) >= reach) & (ids != node)]
                    u += [min(node, i) for i in near.tolist()]
                    v += [max(node, i) for i in near.tolist()]
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    true = nodes.mapInArrow(run, "u long, v long").distinct()
    sides = [group.select(F.col("node").alias(k), F.col("component").alias(f"c{k}")) for k in ("u", "v")]
    row = true.join(sides[0], "u", "left").join(sides[1], "v", "left").agg(F.count(F.lit(1)), F.sum((F.col("cu") == F.col("cv")).cast("long"))).first()
    return (row[1] or 0) / row[0] if row[0] else 1.0


def embedding_components(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", reach: float = 0.93,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, recall (the audited one, the same in all rows).

    Vectors link only if their labels are equal and not null and their cosine, in double precision, is at least ``reach``. Null,
    empty and zero vectors and those with null or non-finite components link with nothing, nor do vectors of different length. Equal
    vectors link. Repeated ids are rows of their own. An empty table gives none.
    """
    rows, nodes = nodes_of(only_columns(small_batches(vectors), vec_id=id_col, embedding=vector_col, label=label_col).withColumn("vec_id", F.col("vec_id").cast("long")))
    for overlap in OVERLAPS:
        links, cells = joined_nodes(nodes, reach, overlap)
        group = materialize(connected_components(links), "vector-components")
        recall = audit(nodes, group, reach)
        if recall >= RECALL:
            break
    else:
        members = nodes.select(F.col("home").alias("group"), "node", "copies", "vec")
        group = materialize(connected_components(compared(in_blocks(members, cells), reach, count=False)), "vector-components")
        recall = 1.0
    members = nodes.join(group, "node").select(F.col("component").alias("group"), "node", "copies", "vec")
    partners = compared(in_blocks(materialize(members, "members"), cells), reach, count=True)
    known = nodes.select("node", "copies").join(partners, "node", "left").join(group, "node", "left")
    known = materialize(known.withColumn("component", F.coalesce("component", "node")), "vector-groups")
    placed = rows.join(known, "node", "left")
    least = placed.filter("component is not null").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    out = placed.join(least, "component", "left").select(
        "vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumn("recall", F.lit(recall))
