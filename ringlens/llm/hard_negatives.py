"""Hard negatives by inner product: anchors in clusters share lists of candidates that are walked until no later one can count.

An anchor's positives are its best other rows of the same label; the negatives of a positive are the best rows of other labels whose score
lies between two shares of the positive's score. Both searches are exact. All rows are put in the order of label and falling norm
and packed into blocks; the anchors, in the same order, into chunks. A task gets one chunk and a few blocks. It clusters the chunk's
anchors of a label by direction; for each cluster it sorts its candidates once by ``norm * cos(max(angle to the centre - widest angle of a
member, 0))``, which times an anchor's norm is at least its score with the candidate; every member walks that list, in
slabs, and ends when the bound of the next slab is below all that it still looks for. What the tasks find for an anchor is merged by
Spark. Positives first: their blocks are those of the label. Negatives then: all blocks but those that hold the chunk's only label.

Anchors are compared with all rows in blocks, the anchors being the stated query set: the work is their product less what the
bounds cut off, a task's memory is one chunk and ``PART`` blocks, and rows travel packed, once per chunk.

Defined results: rows with a null id or label, a null or empty vector, or a null or non-finite component take no part, nor those whose
integer vector's norm is about 2**31.5 or more, as their score with themselves fits no long. Rows are told apart by place, not id: another
row with the anchor's id is another row, and a repeated anchor row has rows of its own. Shorter vectors are filled with zeros. Equal scores
go by id. An anchor without positives, or a positive without negatives, gives no row, an empty table none at all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.llm.common import small_batches
from ringlens.operators.ranking import global_positions
from ringlens.plans.runtime import materialize

BLOCK = 2048  # rows of a block at most; fewer of long vectors, BLOCK_BYTES
BLOCK_BYTES = 1 << 20
CHUNK = 512  # anchors that share a task
PART = 16  # blocks of a task
CLUSTER = 64  # anchors of a cluster, about
SLAB = 512  # candidates that a walk takes at once
MAX_SQUARE = 9.0e18  # of an integer vector's norm
FOUND = "pos long, id long, rank int, cand_pos long, cand_id long, score long"


PACKED = "labels binary, poses binary, ids binary, vecs binary, low long, high long"


def packed(rows: DataFrame, key: str, order: str, width: int) -> DataFrame:
    """One row per value of ``key``, which holds a bounded number of rows (id, label, vec, pos): their columns as bytes in the order of
    ``order``, and the lowest and highest label."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order)
        full = np.zeros((len(group), width))
        for i, v in enumerate(group["vec"]):
            full[i, : len(v)] = v
        column = {name: [group[of].to_numpy(np.int64).tobytes()] for name, of in (("labels", "label"), ("poses", "pos"), ("ids", "id"))}
        ends = {"low": [group["label"].min()], "high": [group["label"].max()]}
        return pd.DataFrame({key: [group[key].iloc[0]], **column, "vecs": [full.tobytes()], **ends})

    return rows.groupBy(key).applyInPandas(pack, f"{key} long, {PACKED}")


class Rows:
    """Rows of one or more packed blocks as arrays."""

    def __init__(self, table: pd.DataFrame, width: int):
        def joined(name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(v, kind) for v in table[name]])

        self.pos, self.id, self.label = joined("poses", np.int64), joined("ids", np.int64), joined("labels", np.int64)
        self.vec = joined("vecs", np.float64).reshape(len(self.pos), width)
        self.norm = np.sqrt((self.vec * self.vec).sum(axis=1))


def directions(vec: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return vec / np.where(norm > 0, norm, 1.0)[:, None]


def anchor_clusters(unit: np.ndarray, size: int = CLUSTER, rounds: int = 5) -> list[np.ndarray]:
    """Row numbers of clusters of similar directions; the centres start at rows far from each other."""
    k = -(-len(unit) // size)
    far, centres = np.full(len(unit), np.inf), [0]
    while len(centres) < k:
        far = np.minimum(far, 1 - unit @ unit[centres[-1]])
        centres.append(int(np.argmax(far)))
    centre = unit[centres]
    for _ in range(rounds):
        home = np.argmax(unit @ centre.T, axis=1)
        for c in range(k):
            if (home == c).any():
                mean = unit[home == c].sum(axis=0)
                centre[c] = mean / max(np.linalg.norm(mean), 1e-300)
    home = np.argmax(unit @ centre.T, axis=1)
    return [np.flatnonzero(home == c) for c in range(k) if (home == c).any()]


def upper_bounds(unit: np.ndarray, cand: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """For each candidate a number that, times the norm of any row of ``unit``, is at least its inner product with that row."""
    centre = unit.sum(axis=0)
    centre = centre / max(np.linalg.norm(centre), 1e-300)
    widest = np.arccos(np.clip(unit @ centre, -1, 1)).max()
    away = np.arccos(np.clip((cand @ centre) / np.where(norm > 0, norm, 1.0), -1, 1))
    if not np.linalg.norm(centre) > 0.5 or (np.abs(unit).sum(axis=1) == 0).any():  # opposed or zero members have no common direction
        return norm * (1 + 1e-9)
    # arccos loses up to 1e-7 near 0: the slack covers it
    return norm * (np.cos(np.maximum(away - widest - 1e-6, 0)) + 1e-9)


class Best:
    """The ``n`` best (score, id, place) among the scores from ``low`` to ``high``."""

    def __init__(self, n: int, low: int, high: int):
        self.n, self.low, self.high = n, low, high
        self.held: list[tuple[int, int, int]] = []  # (-score, id, place), ascending

    @property
    def least(self) -> int:
        """Scores below it are of no use any more."""
        return -self.held[-1][0] if len(self.held) == self.n else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        good = np.flatnonzero((scores >= self.least) & (scores <= self.high))
        if len(good) > self.n:
            order = np.lexsort((places[good], ids[good], -scores[good]))[: self.n]
            good = good[order]
        if len(good):
            new = zip((-scores[good]).tolist(), ids[good].tolist(), places[good].tolist(), strict=True)
            self.held = sorted([*self.held, *new])[: self.n]


def products(a: np.ndarray, b: np.ndarray, exact_doubles: bool) -> np.ndarray:
    """Integer inner products as longs. Partial sums are at most the product of the norms."""
    if exact_doubles:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def walk(anchors: Rows, members: np.ndarray, cands: Rows, eligible: np.ndarray, wanted: list[list[Best]], slab: int = SLAB) -> int:
    """Fill ``wanted`` (per member its lists) from the eligible candidates; returns how many inner products it took."""
    norm = anchors.norm[members]
    vec = anchors.vec[members]
    bound = upper_bounds(directions(vec, norm), cands.vec[eligible], cands.norm[eligible])
    order = np.argsort(-bound, kind="stable")
    listed, bound = eligible[order], bound[order]
    exact = norm.max(initial=0) * cands.norm.max(initial=0) < 2.0**53
    alive, taken = np.arange(len(members)), 0
    for at in range(0, len(listed), slab):
        least = np.array([min(b.least for b in wanted[m]) for m in alive], np.float64)
        # a bound is a double: a share of its size more than covers its rounding
        top = norm[alive] * bound[at]
        alive = alive[top + 1e-9 * np.abs(top) + 1e-6 >= least]
        if not len(alive):
            break
        rows = listed[at : at + slab]
        scores = products(vec[alive], cands.vec[rows], exact)
        taken += scores.size
        ids, places = cands.id[rows], cands.pos[rows]
        for m, mine in zip(alive, scores, strict=True):
            own = places != anchors.pos[members[m]]
            for best in wanted[m]:
                best.offer(mine[own], ids[own], places[own])
    return taken


def searched(chunks: DataFrame, visits: DataFrame, blocks: DataFrame, width: int, same_label: bool, n: int, shares: tuple[int, int] | None) -> DataFrame:
    """What each chunk's anchors find in the blocks they visit, task by task: ``FOUND`` rows.

    ``chunks`` are packed anchors, with ``positives`` for the search of negatives; ``visits`` has (chunk, part, block).
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if not len(left) or not len(right):
            return pd.DataFrame(out, columns=["pos", "id", "rank", "cand_pos", "cand_id", "score"])
        anchors, cands = Rows(left, width), Rows(right, width)
        scores = np.frombuffer(left["positives"].iloc[0], np.int64) if shares else np.empty(0, np.int64)
        ranks = len(scores) // len(anchors.pos)
        known = scores.reshape(len(anchors.pos), ranks)  # smallest long: no such positive
        for label in np.unique(anchors.label):
            eligible = np.flatnonzero((cands.label == label) == same_label)
            mine = np.flatnonzero(anchors.label == label)
            for cluster in anchor_clusters(directions(anchors.vec[mine], anchors.norm[mine])):
                members = mine[cluster]
                lists = [_lists(known[m], n, shares) for m in members]
                asked = np.array([bool(x) for x in lists])
                if not asked.any() or not len(eligible):
                    continue
                members, lists = members[asked], [x for x in lists if x]
                walk(anchors, members, cands, eligible, [[b for _, b in x] for x in lists])
                for m, found in zip(members, lists, strict=True):
                    out += [
                        (anchors.pos[m], anchors.id[m], rank, place, i, -score) for rank, b in found for score, i, place in b.held
                    ]
        return pd.DataFrame(out, columns=["pos", "id", "rank", "cand_pos", "cand_id", "score"])

    parts = visits.select("chunk", "part").distinct()
    left = parts.join(chunks, "chunk")
    right = visits.join(blocks, "block").select(
        F.col("chunk").alias("for_chunk"), F.col("part").alias("for_part"), "labels", "poses", "ids", "vecs"
    )
    return left.groupBy("chunk", "part").cogroup(right.groupBy("for_chunk", "for_part")).applyInPandas(run, FOUND)


def _lists(scores: np.ndarray, n: int, shares: tuple[int, int] | None) -> list[tuple[int, Best]]:
    """The lists an anchor looks for: its positives, or for each positive (by rank) the negatives between two percentages of its score."""
    if shares is None:
        return [(0, Best(n, -(1 << 63), (1 << 63) - 1))]
    none = -(1 << 63)
    spans = [(rank, -(-shares[0] * s // 100), shares[1] * s // 100) for rank, s in enumerate(scores.tolist(), 1) if s != none]
    return [(rank, Best(n, low, high)) for rank, low, high in spans if low <= high]


def ranked(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` best of each key over all tasks, with ``place`` from 1: higher scores, then smaller ids."""
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "cand_id", "cand_pos")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n)


def integer_rows(df: DataFrame, scale: int, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(id, label, vec, norm) of the rows that take part; ``vec`` are the integers as doubles."""
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec")
    )
    rows = rows.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    ).withColumn("vec", F.transform("vec", lambda x: _floor(x, scale)))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    return rows.withColumn("norm", F.sqrt(square)).filter(F.col("norm") * F.col("norm") < MAX_SQUARE)


def _floor(x: Column, scale: int) -> Column:
    """``floor(scale * x)`` as a double; beyond 2**52 a double is whole already, and ``floor`` would not fit a long."""
    scaled = x * F.lit(float(scale))
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)


def hard_negatives(
    df: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None, scale: int = 256,
    n_positives: int = 5, n_negatives: int = 3, shares: tuple[int, int] = (50, 95),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``df`` that ``anchors``, a
    condition on the column ``id``, selects.

    ``rank`` counts a positive's negatives from 1. ``label`` is an expression on ``df`` (default: its column ``label``); ``shares`` are the
    percentages of the positive's score between which a negative's score lies.
    """
    small_batches(df)
    rows = integer_rows(df, scale, id_col, vec_col, F.col("label") if label is None else label)
    placed = global_positions(rows.withColumn("falling", -F.col("norm")), ["label", "falling", "id"], "pos").drop("falling")
    width = placed.agg(F.max(F.size("vec"))).first()[0]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if width is None:
        return df.sparkSession.createDataFrame([], schema)
    block = max(1, min(BLOCK, BLOCK_BYTES // (8 * width)))
    cut = placed.select("id", "label", "vec", "pos", F.expr(f"pos div {block}").alias("block"))
    blocks = materialize(packed(cut, "block", "pos", width), "negative-blocks")
    asked = global_positions(placed.filter(anchors).select("id", "label", "vec", "pos"), ["pos"], "nth")
    asked = materialize(asked.select("id", "label", "vec", "pos", "nth", F.expr(f"nth div {CHUNK}").alias("chunk")), "anchors")
    chunks = materialize(packed(asked, "chunk", "nth", width), "anchor-chunks")

    home = blocks.select("block", "low", "high")
    spans = chunks.select("chunk", F.col("low").alias("from_label"), F.col("high").alias("to_label"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(blocks.count() - 1).cast("long"))
    each = spans.withColumn("block", F.explode(every)).join(home, "block")
    part = F.expr(f"int(block div {PART})").alias("part")
    near = each.filter((F.col("low") <= F.col("to_label")) & (F.col("high") >= F.col("from_label"))).select("chunk", part, "block")
    other = each.filter(~((F.col("low") == F.col("high")) & (F.col("from_label") == F.col("to_label")) & (F.col("low") == F.col("from_label"))))

    positives = materialize(ranked(searched(chunks, near, blocks, width, True, n_positives, None), ["pos"], n_positives), "positives")
    listed = positives.groupBy("pos").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("best"))
    known = asked.join(listed, "pos", "left").select("chunk", "nth", F.transform("best", lambda b: b["score"]).alias("best"))
    with_scores = chunks.join(_packed_scores(known, n_positives), "chunk")
    found = searched(with_scores, other.select("chunk", part, "block"), blocks, width, False, n_negatives, shares)
    best = ranked(found, ["pos", "rank"], n_negatives).select(
        "pos", F.col("rank").alias("nth"), F.col("place").alias("rank"), F.col("cand_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    whose = positives.select(
        "pos", F.col("place").alias("nth"), F.col("id").alias("anchor_id"), F.col("cand_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return best.join(whose, ["pos", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _packed_scores(known: DataFrame, n: int) -> DataFrame:
    """Per chunk the ``n`` best positive scores of its anchors in order; the smallest long where there are fewer."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("nth")
        full = np.full((len(group), n), -(1 << 63), np.int64)
        for i, best in enumerate(group["best"]):
            if best is not None:
                full[i, : len(best)] = best
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "positives": [full.tobytes()]})

    return known.groupBy("chunk").applyInPandas(pack, "chunk long, positives binary")
