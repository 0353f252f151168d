"""N-gram Jaccard join over a count-vector R-tree.

The distinct word n-grams of a document are hashed tokens; a document is the point of its token counts per group.
Two sets of sizes a and b reach a Jaccard similarity of p percent only if they differ in at most
``(100 - p) (a + b) / (100 + p)`` tokens, and their overlap is at most the sum of the smaller counts per group.

* Root of the index: axis-aligned cells. Within a size class the fine groups are dealt into more blocks than tokens
  that two linked documents may differ in, so the spare blocks at least are equal in every coordinate. A cell is (class, block,
  coordinates in it). Cells have one order, more tokens first; each document goes to its first cells, one more than tokens may
  differ. Of the equal blocks one is then among the first of both: linked documents share a cell, always, and blocks
  that are empty in many documents gather nobody.
* Equal sets are one node from the start: copies never meet in a cell.
* In a cell, each node is first compared with the smallest node and with the one before it (a star and a chain, two pairs
  per member). Cells whose members are then still in different components are searched with packed trees: boxes of points
  bound the overlap by coordinate minima, box against box, then point against point.
* Every pair that passes the bound is verified on the whole token sets; only sets of such pairs are kept and shuffled.

The result does not depend on the order of rows or on their partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import broadcast_checked, connected_components, free_shuffles, only_columns, small_batches
from ringlens.plans.runtime import materialize

GROUPS = 256  # coordinates of a point, at least
FILL = 2  # tokens of a coordinate, about, where there are more than GROUPS * FILL tokens
LEAF = 16  # points in a box
KNOWN = 8  # smallest cells of a node that tell whether a pair has met in an earlier cell
BLOCK = 2048  # members of a cell that one task compares; larger cells are dealt out as pairs of blocks
CLASS_RATIO = 1.5
SPARE = 1.4  # blocks per token that may differ; so many that a set has fewer empty blocks than it may leave out

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x2545F4914F6CDD1D  # odd, so its powers can be inverted modulo 2**64
CHUNK = 1 << 18  # bytes of text hashed at once; a longer text is a chunk of its own


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    def of(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts, A-Z in lower case, and the number of words before each text.

    A word's hash is a polynomial in its bytes, read off prefix sums over the whole chunk.
    """
    raw = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1, append=1))
    start, end = edge[0::2][: len(edge) // 2], edge[1::2]
    size = max(CHUNK, 1 << int(len(raw) + 1).bit_length())
    power, inverse = _powers(size)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    ends = np.cumsum([len(t) + 1 for t in texts])
    return mix(h + (end - start).astype(np.uint64) * _MULTIPLIERS[2]), np.searchsorted(start, np.concatenate([[0], ends]))


def token_batches(texts: list[bytes | None], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word ``width``-grams; fewer words make one token, no words none."""
    weight = [_MULTIPLIERS[i % 4] + np.uint64(2 * (i // 4)) for i in range(width)]
    i = 0
    while i < len(texts):
        chunk, held = [], 0
        while i < len(texts) and (not chunk or held + len(texts[i] or b"") <= CHUNK):
            chunk.append(texts[i] or b"")
            held += len(chunk[-1]) + 1
            i += 1
        h, at = word_hashes(chunk)
        grams = np.zeros(max(0, len(h) - width + 1), np.uint64)
        for k in range(width):
            grams += h[k : k + len(grams)] * weight[k]
        grams = mix(grams)
        for low, high in zip(at[:-1], at[1:], strict=True):
            if high - low >= width:
                yield np.unique(grams[low : high - width + 1])
            elif high > low:
                few = (h[low:high] * np.array(weight[: high - low])).sum(dtype=np.uint64)
                yield mix(few + np.array([high - low], np.uint64) * _MULTIPLIERS[4])
            else:
                yield np.empty(0, np.uint64)


def node_of(tok: np.ndarray) -> int:
    """A 64-bit name of a token set that does not depend on order; as a signed long."""
    total = mix(tok ^ _MULTIPLIERS[1]).sum(dtype=np.uint64) + np.uint64(len(tok))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


class SizeClasses:
    """Size ranges, and for each the number of blocks and of tokens that a linked pair may differ in."""

    def __init__(self, percent: int):
        self.percent = percent
        # below this size two linked sets are equal
        self.first = next(a for a in range(1, 10_000) if 100 * a >= percent * (a + 1))
        self.low = [self.first]

    def _range(self, c: int) -> tuple[int, int]:
        while len(self.low) <= c + 1:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * CLASS_RATIO)))
        return self.low[c], self.low[c + 1] - 1

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(class, blocks, tokens that may differ) of each class in which a set of ``n`` tokens has to be."""
        if n < self.first:
            return []
        out, c = [], 0
        while True:
            low, high = self._range(c)
            if high * 100 >= n * self.percent:  # a smaller partner may be in this class, or n itself is
                differ = (100 - self.percent) * (high + high * 100 // self.percent) // (100 + self.percent)
                out.append((c, int(np.ceil(SPARE * differ)) + 3, differ))
            if high >= n:
                return out
            c += 1


def cells(tok: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """The cells in which the point of ``tok`` lies, as longs."""
    out = []
    where = tok >> np.uint64(32)  # tokens are sorted, and so are their blocks
    value = mix(tok ^ _MULTIPLIERS[2])
    for c, blocks, differ in classes.of(len(tok)):
        block = ((where * np.uint64(blocks)) >> np.uint64(32)).view(np.int64)
        count = np.bincount(block, minlength=blocks)
        content = np.zeros(blocks, np.uint64)
        some = np.flatnonzero(count)
        starts = np.concatenate([[0], np.cumsum(count[some])[:-1]])
        content[some] = np.add.reduceat(value, starts)
        name = mix(content * _MULTIPLIERS[0] + np.arange(blocks, dtype=np.uint64) * _MULTIPLIERS[3] + np.uint64(c + 1))
        # equal blocks have equal counts and names, so this order is the same for all sets
        out.append(name[np.lexsort((name, -count))[: differ + 1]])
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def point(tok: np.ndarray) -> bytes:
    """Counts of tokens per group, after a byte with their width: 0 for two counts under 16 in a byte, else the bytes of a count.

    Groups are the low bits of a token: ``GROUPS`` of them, or the power of two above a ``FILL``-th of the tokens if that is more, so that
    unrelated long sets do not look alike. Points of more groups are folded onto those of fewer by adding."""
    groups = max(GROUPS, 1 << (max(len(tok) // FILL, 1) - 1).bit_length())
    count = np.bincount((tok & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    most = count.max(initial=0)
    if most < 16:
        return b"\0" + (count[0::2] | count[1::2] << 4).astype(np.uint8).tobytes()
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + count.astype(f"<u{width}").tobytes()


def _texts(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that little of a batch is held as Python objects at once."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def shapes(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, node, point) of every row of (doc_id, text): number of tokens, the name of the token set and its point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            rows = [(len(s), node_of(s), point(s)) for s in token_batches(_texts(b.column(1)), width)]
            n, node, pts = zip(*rows, strict=True) if rows else ([], [], [])
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(pts, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "n", "node", "point"])

    return docs.mapInArrow(run, "doc_id long, n long, node long, point binary")


def members(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(cell, node) of every document's cells; a task names a node's cells once, however many copies it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen = SizeClasses(percent), set()
        for b in _slices(batches):
            keys, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for s in token_batches(_texts(b.column(0)), width):
                node = node_of(s)
                if node in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                keys.append(cells(s, classes))
                nodes.append(np.full(len(keys[-1]), node))
            yield pa.record_batch([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], ["cell", "node"])

    return docs.select("text").mapInArrow(run, "cell long, node long")


def shared_cells(member: DataFrame) -> DataFrame:
    """(cell, first, before, node) of the cells with more than one node: each further node beside the smallest one and the one
    before it, in the order of the nodes, which are hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by cell and node; only the open cell's name, first and last node are carried on
        cell = first = last = None
        for b in batches:
            if not b.num_rows:
                continue
            c, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            new = np.concatenate([[c[0] != cell or cell is None], c[1:] != c[:-1]])
            repeat = np.concatenate([[not new[0] and n[0] == last], (n[1:] == n[:-1]) & ~new[1:]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(c)), -1))
            head = np.where(start >= 0, n[start], 0 if first is None else first)
            # the row before is of the same cell where a row is kept; of equal nodes only the first is kept
            before = np.concatenate([[0 if last is None else last], n[:-1]])
            keep = ~new & ~repeat
            cell, first, last = c[-1], head[-1], n[-1]
            if keep.any():
                columns = [pa.array(x[keep]) for x in (c, head, before, n)]
                yield pa.record_batch(columns, ["cell", "first", "before", "node"])

    placed = member.repartition("cell").sortWithinPartitions("cell", "node")
    return placed.mapInArrow(run, "cell long, first long, before long, node long")


def token_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, tokens) of the wanted (doc_id, node); docs are (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            sets = zip(token_batches(_texts(b.column(0)), width), b.column(1).to_pylist(), strict=True)
            rows = [(node, s.tobytes()) for s, node in sets if node_of(s) == node]
            nodes, tokens = zip(*rows, strict=True) if rows else ([], [])
            yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(tokens, pa.binary())], ["node", "tokens"])

    w = wanted.select(F.col("doc_id").alias("w_id"), "node")
    picked = docs.join(w, docs["doc_id"].eqNullSafe(w["w_id"])).select("text", "node")
    return picked.mapInArrow(run, "node long, tokens binary").dropDuplicates(["node"])


def verified(docs: DataFrame, node: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) that link. Only the texts of nodes in a pair are read again; ``node`` has (node, doc_id)."""
    asked = materialize(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(node, "node"), "jaccard-asked")
    sets = materialize(token_sets(docs, broadcast_checked(asked, asked.count()), width), "jaccard-sets")
    return materialize(linked(pairs, sets, percent), "jaccard-links")


def _groups(p: bytes) -> int:
    return (len(p) - 1) // p[0] if p[0] else 2 * (len(p) - 1)


def _halves(packed: np.ndarray) -> np.ndarray:
    """Two counts of each byte, along the last axis."""
    return np.stack([packed & 15, packed >> 4], axis=-1).reshape(*packed.shape[:-1], -1)


def _points(column: list[bytes], groups: int | None = None) -> np.ndarray:
    """The points as rows, folded onto ``groups`` groups (as many as all of them have)."""
    groups = groups or min(map(_groups, column), default=GROUPS)
    if all(len(p) == groups // 2 + 1 and not p[0] for p in column):  # all packed in pairs
        return _halves(np.frombuffer(b"".join(column), np.uint8).reshape(-1, groups // 2 + 1)[:, 1:])
    out = np.empty((len(column), groups), np.uint32)
    for i, p in enumerate(column):
        count = np.frombuffer(p, f"<u{p[0]}", offset=1) if p[0] else _halves(np.frombuffer(p, np.uint8, offset=1))
        out[i] = count.reshape(-1, groups).sum(axis=0, dtype=np.uint32)
    most = out.max(initial=0)
    return out.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def needed(a, b, percent: int):
    """Least overlap of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def within_bound(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose summed coordinate minima reach the overlap that a link needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, 4096):
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            groups = np.array([min(_groups(p), _groups(q)) for p, q in zip(x, y, strict=True)], np.int64)
            keep = np.zeros(b.num_rows, bool)
            for g in np.unique(groups):
                at = np.flatnonzero(groups == g)
                u, v = _points([x[i] for i in at], int(g)), _points([y[i] for i in at], int(g))
                need = needed(u.sum(1, dtype=np.int64), v.sum(1, dtype=np.int64), percent)
                keep[at] = np.minimum(u, v).sum(1, dtype=np.int64) >= need
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep))

    s = sets.select("node", "n", "point")
    u, v = (s.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("point").alias(f"p_{k}")) for k in "uv")
    near = pairs.join(u, "u").join(v, "v").filter(F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent)
    return near.select("u", "v", "p_u", "p_v").mapInArrow(run, "u long, v long")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that link, judged on the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (len(both) - same))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    u, v = (sets.select(F.col("node").alias(k), F.col("tokens").alias(f"t_{k}")) for k in "uv")
    return pairs.join(v, "v").join(u, "u").select("u", "v", "t_u", "t_v").mapInArrow(run, "u long, v long")


def tree_pairs(pts: np.ndarray, component: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose overlap bound is met, that are in different components and, with two sides, on both.

    The points are packed into boxes of ``LEAF`` in the order of size and of the widest coordinates. A box pair is
    searched if the minima of the boxes' upper corners sum to the overlap that their smallest sizes need.
    """
    size = pts.sum(1, dtype=np.int64)
    if len(pts) <= LEAF:  # one box
        i, j = np.triu_indices(len(pts), 1)
        apart = (component[i] != component[j]) & (~side.any() | (side[i] != side[j]))
        i, j = i[apart], j[apart]
        near = np.minimum(size[i], size[j]) * 100 >= np.maximum(size[i], size[j]) * percent
        i, j = i[near], j[near]
        good = np.minimum(pts[i], pts[j]).sum(1, dtype=np.int64) >= needed(size[i], size[j], percent)
        return i[good], j[good]
    wide = np.argsort(-np.var(pts, axis=0, dtype=np.float32), kind="stable")[:2]
    order = np.lexsort((pts[:, wide[1]], pts[:, wide[0]], size))
    pts, size, component, side = pts[order], size[order], component[order], side[order]
    starts = np.arange(0, len(pts), LEAF)
    top, least = np.maximum.reduceat(pts, starts, axis=0), np.minimum.reduceat(size, starts)
    ends = np.append(starts[1:], len(pts))
    left, right = [], []
    for i, (low, high) in enumerate(zip(starts, ends, strict=True)):
        reach = np.minimum(top[i], top[i:]).sum(1, dtype=np.int64) >= needed(least[i], least[i:], percent)
        other = np.concatenate([np.arange(starts[j], ends[j]) for j in i + np.flatnonzero(reach)])
        overlap = np.minimum(pts[low:high, None, :], pts[None, other, :]).sum(2, dtype=np.int64)
        a, b = size[low:high, None], size[None, other]
        good = (overlap >= needed(a, b, percent)) & (component[low:high, None] != component[None, other])
        good &= np.arange(low, high)[:, None] < other[None, :]
        if side.any():
            good &= side[low:high, None] != side[None, other]
        x, y = np.nonzero(good)
        left.append(order[low + x])
        right.append(order[other[y]])
    return np.concatenate(left), np.concatenate(right)


def open_cells(cell: DataFrame, component: DataFrame) -> DataFrame:
    """(cell, blocks, node, component) of cells that hold three nodes or more of different components.

    Of cells with the same members one is kept."""
    both = cell.select("cell", "node").union(cell.select("cell", F.col("first").alias("node")).distinct())
    placed = both.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    found = (
        placed.groupBy("cell")
        .agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("size"),
             F.min("node").alias("least"), F.expr("bit_xor(xxhash64(node))").alias("name"))
        .filter("a != b and size > 2")
        .groupBy("size", "least", "name").agg(F.min("cell").alias("cell"))
        .select("cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    return placed.join(found, "cell")


def open_pairs(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) within the bound that meet in an open cell and are not in one component.

    A pair that meets in several cells is left to an earlier one if both nodes know of it: each carries its ``KNOWN``
    smallest cells. The smallest common cell always gives the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def search(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            col = {k: rows.column(k).to_numpy() for k in ("cell", "low", "high", "block", "node", "component")}
            packed = rows.column("point").to_pylist()
            known = np.frombuffer(b"".join(rows.column("known").to_pylist()), ">i8").astype(np.int64).reshape(-1, KNOWN)
            cuts = np.flatnonzero(np.concatenate([[True], np.any([col[k][1:] != col[k][:-1] for k in ("cell", "low", "high")], axis=0)]))
            for a, b in zip(cuts, np.append(cuts[1:], rows.num_rows), strict=True):
                side = (col["block"][a:b] == col["high"][a]) & (col["low"][a] != col["high"][a])
                x, y = tree_pairs(_points(packed[a:b]), col["component"][a:b], side, percent)
                met = np.zeros(len(x), bool)
                for k in range(0, len(x), 8192):
                    s, t = known[a + x[k : k + 8192], :, None], known[a + y[k : k + 8192], None, :]
                    met[k : k + 8192] = ((s == t) & (s < col["cell"][a])).any((1, 2))
                node, x, y = col["node"][a:b], x[~met], y[~met]
                if len(x):
                    u, v = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
                    yield pa.record_batch([pa.array(u), pa.array(v)], ["u", "v"])

        held = []  # the rows of the last group, which may go on in the next batch: two blocks of BLOCK rows at most
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows = pa.Table.from_batches(held)
            key = [rows.column(k).to_numpy() for k in ("cell", "low", "high")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))
            if len(change):
                cut = int(change[-1]) + 1
                yield from search(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield from search(pa.Table.from_batches(held))

    first = placed.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("cell")), 1, KNOWN).alias("cells"))
    carried = sets.join(first, "node").select(
        "node", "point",
        # a list of longs as bytes, filled up with the largest long
        F.unhex(F.array_join(F.transform(
            F.sequence(F.lit(0), F.lit(KNOWN - 1)),
            lambda i: F.lpad(F.hex(F.coalesce(F.get("cells", i), F.lit((1 << 63) - 1))), 16, "0")), "")).alias("known"),
    )
    dealt = (
        placed.withColumn("block", F.expr("cast(pmod(xxhash64(node, 7), blocks) as int)"))
        .withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("cell", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "component")
        .join(carried, "node")
    )
    found = dealt.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    return found.select("cell", "low", "high", "block", "node", "component", "point", "known").mapInArrow(run, "u long, v long").distinct()


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Null and empty texts have the empty set and link with nothing. Equal sets link. Repeated ids are rows of their
    own; ids that are null are never a component's smallest id unless it has no other. An empty table gives none.
    """
    docs = only_columns(small_batches(documents), doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    shape = materialize(shapes(docs, width), "jaccard-shapes")
    node = shape.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    cell = free_shuffles(materialize(shared_cells(members(docs, width, percent)), "jaccard-cells"))
    stars = cell.select(F.col("first").alias("u"), F.col("node").alias("v"))
    tried = materialize(stars.union(cell.select(F.col("before").alias("u"), F.col("node").alias("v"))).distinct(), "jaccard-tried")
    involved = cell.select("node").union(cell.select("first")).distinct()
    sets = materialize(shape.select("node", "n", "point").join(involved, "node", "left_semi").dropDuplicates(["node"]), "jaccard-points")
    near = free_shuffles(materialize(within_bound(tried, sets, percent), "jaccard-near"))
    links = verified(docs, node, near, width, percent)
    placed = free_shuffles(materialize(open_cells(cell, connected_components(links)), "jaccard-open"))
    rest = free_shuffles(materialize(open_pairs(placed, sets, percent).join(tried, ["u", "v"], "left_anti"), "jaccard-rest"))
    joined = connected_components(links.union(verified(docs, node, rest, width, percent)))
    group = node.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = group.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = group.join(smallest, "component").select("node", "component_id")
    return shape.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
