"""Clusters of two runs matched against brute force, identities carried over, one-dimensional k-means and the stop rule."""

import itertools
import random

import numpy as np
import pytest

from ringlens.operators import edges as E
from ringlens.operators import matching as M
from ringlens.operators import one_dim as O
from ringlens.operators import pic as P


def _assign(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), "id long, cluster int")


def _brute_match(before, after, least):
    olds, news = {}, {}
    for side, of in ((before, olds), (after, news)):
        for node, c in side.items():
            if c is not None:
                of.setdefault(c, set()).add(node)

    def jac(o, n):
        return len(olds[o] & news[n]) / len(olds[o] | news[n])

    best_new = {o: min((n for n in news if olds[o] & news[n]), key=lambda n: (-jac(o, n), n), default=None) for o in olds}
    best_old = {n: min((o for o in olds if olds[o] & news[n]), key=lambda o: (-jac(o, n), o), default=None) for n in news}
    kept = {(o, n) for o, n in best_new.items() if n is not None and best_old[n] == o and jac(o, n) >= least}
    out = [("kept", o, n, len(olds[o] & news[n]), len(olds[o]), len(news[n]), jac(o, n)) for o, n in kept]
    out += [("died", o, None, 0, len(olds[o]), 0, 0.0) for o in olds if o not in {k for k, _ in kept}]
    out += [("born", None, n, 0, 0, len(news[n]), 0.0) for n in news if n not in {k for _, k in kept}]
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0.0, 0.4])
def test_matches_equal_brute_force(spark, least):
    rnd = random.Random(int(least * 10))
    before = {i: rnd.choice([0, 1, 2, 3, 4, 4, 4, 4, None]) for i in range(120)}
    after = {i: (rnd.randrange(10, 18) if rnd.random() < 0.4 else c and c * 2) for i, c in before.items() if i % 7} | {i: 30 for i in range(200, 205)}
    got = M.match_clusters(_assign(spark, before), _assign(spark, after), least)
    assert got.columns == ["status", "old_cluster", "new_cluster", "common", "old_nodes", "new_nodes", "jaccard"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute_match(before, after, least)


def test_ties_and_empty_runs(spark):
    before, after = {1: 5, 2: 5, 3: 6, 4: 6}, {1: 8, 2: 7, 3: 8, 4: 7}
    got = {(r.status, r.old_cluster, r.new_cluster) for r in M.match_clusters(_assign(spark, before), _assign(spark, after)).collect()}
    assert got == {("kept", 5, 7), ("died", 6, None), ("born", None, 8)}
    none = spark.createDataFrame([], "id long, cluster int")
    assert {r.status for r in M.match_clusters(none, _assign(spark, after)).collect()} == {"born"}
    assert {r.status for r in M.match_clusters(_assign(spark, before), none).collect()} == {"died"}


def test_identity_is_carried(spark):
    matches = M.match_clusters(_assign(spark, {1: 0, 2: 0, 3: 1}), _assign(spark, {1: 4, 2: 4, 9: 2, 10: 7}))
    identity = spark.createDataFrame([(0, 40), (1, 41)], "old_cluster int, identity long")
    assert sorted(map(tuple, M.carry_identity(identity, matches).collect())) == [(2, 42), (4, 40), (7, 43)]


def _embedding(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, v double").repartition(3)


def _best_split(values, k):
    x = np.sort(np.array(values, float))
    best = (np.inf, None)
    for cut in itertools.combinations(range(1, len(x)), k - 1):
        parts = np.split(x, cut)
        if all(a[-1] < b[0] for a, b in itertools.pairwise(parts)):
            cost = sum(((p - p.mean()) ** 2).sum() for p in parts)
            best = min(best, (cost, cut), key=lambda b: b[0])
    return best, x


def test_clusters_are_the_best_of_200_points(spark):
    rnd = np.random.default_rng(8)
    values = np.concatenate([rnd.normal(0, 1, 120), rnd.normal(6, 0.5, 75), [40, 41, 41, 41, 60]])
    cuts = {c.k: c for c in O.embedding_cuts(_embedding(spark, values), (1, 2, 3))}
    for k in (1, 2, 3):
        (cost, at), x = _best_split(values, k)
        assert cuts[k].inertia == pytest.approx(cost, rel=1e-9)
        assert [float(x[i - 1]) for i in at] == list(cuts[k].uppers)
    got = {r.id: r.cluster for r in O.exact_clusters(_embedding(spark, values), 3).collect()}
    assert [got[i] for i in range(200)] == [int(sum(u < v for u in cuts[3].uppers)) for v in values]


def test_scores_equal_brute_force(spark):
    rnd = np.random.default_rng(9)
    values = np.concatenate([rnd.normal(c, 0.3, 40) for c in (0, 3, 7, 20, 21.5)])
    table, cuts = O.rate_k(_embedding(spark, values), (2, 3, 4, 5, 6))
    rows = {r.k: r for r in table.collect()}
    for c in cuts:
        own = np.array([sum(u < v for u in c.uppers) for v in values])
        means = np.array([values[own == i].mean() for i in range(c.k)])
        away = np.abs(values[:, None] - means[None])
        a = away[np.arange(200), own]
        away[np.arange(200), own] = np.inf
        b = away.min(axis=1)
        assert rows[c.k].score == pytest.approx(((b - a) / np.maximum(a, b)).mean(), rel=1e-9)
    assert [k for k, r in rows.items() if r.chosen] == [max(rows, key=lambda k: rows[k].score)] == [4]


def test_few_equal_and_no_values(spark):
    assert [c.k for c in O.embedding_cuts(_embedding(spark, [1, 1, 2, 2, 2, 5]), (1, 2, 3, 4, 9))] == [1, 2, 3]
    same = O.exact_clusters(_embedding(spark, [3, 3, 3]), 2).collect()
    assert {r.cluster for r in same} == {0} and O.rate_k(_embedding(spark, [3, 3, 3]))[0].collect() == []
    assert O.rate_k(_embedding(spark, []))[0].collect() == [] and O.exact_clusters(_embedding(spark, []), 2).collect() == []
    odd = _embedding(spark, [1, 2, float("nan"), float("inf"), 9])
    assert {r.id: r.cluster for r in O.exact_clusters(odd, 2).collect()} == {0: 0, 1: 0, 2: None, 3: None, 4: 1}


def test_far_nodes_have_bins_of_their_own(spark):
    # 3,000 nodes in 8 + 8 bins: the rank bins hide three far ones among 375, the value bins do not
    values = np.concatenate([np.random.default_rng(2).normal(0, 1, 2997), [500, 501, 502]])
    got = O.embedding_cuts(_embedding(spark, values), (2,), rank_bins=8, width_bins=8)[0]
    assert got.means[1] == pytest.approx(501.0) and got.uppers[0] == values[:2997].max()


def _matrix(rows):
    ids = sorted({r[0] for r in rows} | {r[1] for r in rows})
    at = {v: i for i, v in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for s, d, x in rows:
        w[at[s], at[d]] += x
        w[at[d], at[s]] += x
    return ids, w / w.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("epsilon", [3.0, 0.2, 0.0])
def test_stop_rule_equals_numpy(spark, epsilon):
    rng = np.random.default_rng(3)
    pairs = {(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, 30, (90, 2)) if a != b}
    rows = [(a, b, float(rng.uniform(0.1, 2))) for a, b in sorted(pairs)]
    edges = E.prepare_typed_edges(spark.createDataFrame([r + ("x",) for r in rows], "src long, dst long, weight double, true_label string"))
    ids, a = _matrix([(r.src, r.dst, r.weight_norm) for r in edges.collect()])
    x = np.array([((i * 7919) % 104729 + 1) / 104729 for i in ids])
    x /= np.abs(x).sum()
    history = []
    for step in range(1, 13):
        y = a @ x
        y /= np.abs(y).sum()
        change = np.abs(y - x).sum()
        history.append((step, change, abs(change - history[-1][1]) if history else None))
        x = y
        if history[-1][2] is not None and history[-1][2] <= epsilon / len(ids):
            break
    end = P.power_iteration_until(edges, epsilon, 12)
    assert end.steps == len(history) and end.converged == (epsilon > 0) and (end.steps < 12) == (epsilon > 0)
    for got, want in zip(end.history, history, strict=True):
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], rel=1e-6, abs=1e-14)
    got = {r.id: r.v for r in end.vector.collect()}
    assert np.allclose([got[i] for i in ids], x, rtol=1e-10)


def test_stop_rule_without_edges(spark):
    none = spark.createDataFrame([], "src long, dst long, weight_norm double")
    end = P.power_iteration_until(none)
    assert (end.steps, end.converged, end.vector.collect()) == (0, False, [])
