"""Vector codes, hard negatives and chat windows against brute force, with nulls, ties, repeated rows, odd columns and hot keys."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringlens.llm import chat_format, hard_negatives, vector_codes

VECTORS = "vec_id long, embedding array<double>, label int, id string, vec int, `to.pivots` int, score string"


def _vectors(spark, rows, schema=VECTORS):
    """Rows (vec_id, embedding, label), with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], schema)


# ---------------------------------------------------------------- op 11


def _brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    ints = []
    for i, v, lab in kept:
        whole = [math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale for x in v] + [0] * (parts * width - len(v))
        ints.append((i, [whole[p * width : p * width + width] for p in range(parts)], lab))
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[ints[e][1][p] for e in range(min(entries, len(ints)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        homes = [[nearest(p, x[p])[1] for _, x, _ in ints] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p] for (_, x, _), h in zip(ints, homes[p]) if h == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, total = [], {}
    for i, x, lab in ints:
        best = [nearest(p, x[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab))
        total[lab] = total.get(lab, 0) + out[-1][2]
    top = (1 << 63) - 1
    return sorted(((i, c, min(e, top), min(total[lab], top), sha) for i, c, e, lab in out), key=str)


def _some_vectors(n, dim, seed=1, labels=4, step=0.25):
    rnd = random.Random(seed)
    # a coarse grid, so that distances tie often
    return [(i, [rnd.randint(-6, 6) * step for _ in range(dim)], rnd.choice([*range(labels), None])) for i in range(n)]


@pytest.mark.parametrize("case", ["grid", "few", "odd", "huge", "hot"])
def test_codes_equal_brute_force(spark, case):
    rows = _some_vectors(120, 16)
    if case == "few":
        rows = rows[:5]
    if case == "odd":
        rows += [(None, [0.5] * 16, 1), (3, rows[3][1], 2), (3, [1.0] * 16, 2), (900, None, 1), (901, [None] * 16, 1), (902, [math.nan] * 16, 1)]
        rows += [(903, [math.inf] + [0.0] * 15, 1), (904, [], 1), (905, [1.0, -2.0], None), (906, [0.1] * 19, 3), (907, [-1e-320] * 16, 0)]
    if case == "huge":
        rows = rows[:40] + [(2000, [1e30] * 16, 1), (2001, [-1.7e308] * 16, 1), (2002, [1e9] * 16, 2)]
    if case == "hot":
        rows += [(5000 + i, [0.25] * 16, 1) for i in range(200)] + [(7, [0.25] * 16, 1)] * 50
    got = vector_codes.code_errors(_vectors(spark, rows).repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute_codes(rows)


def test_codes_of_nothing(spark):
    for rows in ([], [(1, None, 1), (2, [math.nan], None)]):
        assert vector_codes.code_errors(_vectors(spark, rows)).collect() == []


def test_pivots_spare_distances_and_change_nothing():
    rnd = np.random.default_rng(4)
    centres = rnd.integers(-3000, 3000, (16, 8))
    x = centres[rnd.integers(0, 16, 4000)] + rnd.integers(-60, 60, (4000, 8))
    pivots = vector_codes.choose_pivots(centres, 4)
    at, d, taken = vector_codes.nearest(x, vector_codes.pivot_distances(x, pivots), centres, vector_codes.pivot_distances(centres, pivots))
    full = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (at == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert taken < 0.25 * full.size


def test_sums_travel_in_limbs():
    for v in (0, -1, 1, -5, 1 << 200, -(1 << 200) + 7, (1 << 40) - 1, -(1 << 40)):
        limbs = list(vector_codes._limbs(v))
        assert sum(x << (vector_codes.LIMB * at) for at, x in limbs) == v and all(abs(x) <= 1 << 40 for _, x in limbs)


# ---------------------------------------------------------------- op 12


def _brute_negatives(rows, every=2, n_pos=5, n_neg=3, scale=256):
    ok = [(i, np.array([float(math.floor(x * scale)) for x in v]), lab) for i, v, lab in rows
          if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ok = [r for r in ok if (r[1] ** 2).sum() < 9e18]
    width = max((len(v) for _, v, _ in ok), default=0)
    ok = [(i, [int(x) for x in v] + [0] * (width - len(v)), lab) for i, v, lab in ok]
    out = []
    for a, (i, v, lab) in enumerate(ok):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for b, (j, w, other) in enumerate(ok) if b != a)
        for neg, j, other in [s for s in scored if s[2] == lab][:n_pos]:
            inside = [s for s in scored if s[2] != lab and 50 * -neg <= 100 * -s[0] <= 95 * -neg][:n_neg]
            out += [(i, j, r, k, -neg, -s) for r, (s, k, _) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "ties", "odd", "hot"])
def test_negatives_equal_brute_force(spark, monkeypatch, case):
    for name, value in (("BLOCK", 16), ("CHUNK", 10), ("PART", 3), ("CLUSTER", 4), ("SLAB", 8)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives.walk, "__defaults__", (8,))
    monkeypatch.setattr(hard_negatives.anchor_clusters, "__defaults__", (4, 5))
    rnd = random.Random(7)
    centre = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(150):
        lab = rnd.randrange(4)
        rows.append((i, [c + rnd.gauss(0.4, 0.7) for c in centre[lab]], lab))
    if case == "ties":
        rows = [(i, [float(round(x)) for x in v], lab) for i, v, lab in rows]
    if case == "odd":
        rows += [(None, [1.0] * 6, 1), (500, None, 1), (502, [None] * 6, 1), (504, [math.nan] * 6, 2), (506, [1.0] * 6, None), (508, [], 1)]
        rows += [(510, [1.0, 2.0], 1), (512, [1e300] * 6, 1), (514, [1e6] * 6, 1), (516, [-1e6] * 6, 2), (518, [0.0] * 6, 3), (520, [5.0] * 6, 77)]
        rows += [(510, [1.0, 2.0], 1), rows[4]]
    if case == "hot":
        rows += [(1000 + i, [2.0] * 6, 1) for i in range(150)]
    got = hard_negatives.hard_negatives(_vectors(spark, rows).repartition(4), F.col("id") % 2 == 0)
    want = _brute_negatives(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_negatives_of_nothing(spark):
    for rows in ([], [(0, None, 1)], [(0, [1.0], 1), (2, [1.0], 2)], [(1, [1.0], 1), (3, [2.0], 1)]):
        assert hard_negatives.hard_negatives(_vectors(spark, rows), F.col("id") % 2 == 0).collect() == []


def test_walk_ends_early():
    rnd = np.random.default_rng(3)
    vec = np.floor(rnd.normal(0, 30, (3000, 12)))
    vec[:300] += np.floor(rnd.normal(0, 1, 12) * 400)
    rows = hard_negatives.Rows.__new__(hard_negatives.Rows)
    rows.pos, rows.id, rows.label, rows.vec = np.arange(3000), np.arange(3000), np.zeros(3000, np.int64), vec
    rows.norm = np.sqrt((vec**2).sum(axis=1))
    members = np.arange(20)
    lists = [[hard_negatives.Best(5, -(1 << 63), (1 << 63) - 1)] for _ in members]
    taken = hard_negatives.walk(rows, members, rows, np.arange(3000), lists, 50)
    for m in members:
        scores = vec @ vec[m]
        scores[m] = -np.inf
        want = sorted(zip((-scores).tolist(), range(3000)))[:5]
        assert [(s, i) for s, i, _ in lists[m][0].held] == want
    assert taken < 0.3 * 20 * 3000


# ---------------------------------------------------------------- op 13

CHAT = "conv_id long, turn long, role string, text string, conv string, `key` int, size int"


def _chat(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2) for r in rows], CHAT)


def _words(text):
    return len([w for w in (text or "").replace("\x0b", " ").split(" ") if w.strip()])


def _check_windows(spark, rows, **settings):
    """Format, read back, and compare with the conversations; returns the windows by conversation."""
    budget, history = settings.get("budget", chat_format.BUDGET), settings.get("history", chat_format.HISTORY)
    wins = chat_format.read_chat(chat_format.format_chat(_chat(spark, rows).repartition(3), **settings)).collect()
    by = {}
    for w in sorted(wins, key=lambda w: w.window_at):
        by.setdefault(w.conv_id, []).append(w)
    assert set(by) == {r[0] for r in rows}
    for conv, ws in by.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))]
        told = [(t.role, t.text) for w in ws for t in w.turns]
        learned = [t for w in ws for t in w.learned]
        if len({r[1] for r in rows if r[0] == conv}) == len(turns):
            assert told == turns and learned == [t for role, t in turns if role == "assistant"]
        else:  # equal turns are ordered by hash
            assert sorted(told) == sorted(turns) and sorted(learned) == sorted(t for role, t in turns if role == "assistant")
            continue
        size = [len(chat_format_words(t)) + chat_format.OVERHEAD for _, t in turns]
        at = 0
        for n, w in enumerate(ws):
            assert w.window_at == sum(size[:at]) and w.n_turns == len(w.turns) and w.formatted.count(chat_format.END) == w.n_context + w.n_turns
            pieces = [p.split(chat_format.TEXT) for p in w.formatted.split(chat_format.END + "\n")[:-1]]
            repeated = [(r[len(chat_format.TURN):], t) for r, t in pieces[: w.n_context]]
            has_system = turns[0][0] == "system" and n > 0
            back = w.n_context - has_system
            assert not has_system or repeated[0] == (escape(turns[0][0]), escape(turns[0][1]))
            assert [(escape(r), escape(t)) for r, t in turns[at - back : at]] == repeated[has_system:]
            assert sum(size[at - back : at]) <= history
            kept = size[0] if turns[0][0] == "system" else 0
            cell = (budget - history - min(kept, budget // 4)) // 2
            if max(size[at : at + w.n_turns]) <= cell and kept <= budget // 4:
                assert w.n_tokens <= budget
            assert w.n_tokens == sum(size[at - back : at + w.n_turns]) + has_system * kept
            at += w.n_turns
        assert at == len(turns)
    return by


def chat_format_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


def escape(text):
    import re

    return re.sub(r"<(\\*)(turn>|text>|/turn>)", r"<\\\1\2", text)


def _talk(rnd, conv, n, system=False):
    roles = ["system"] * system + ["user", "assistant"] * n
    return [(conv, t, role, " ".join(rnd.choice(["a", "bé", "<turn>", "\\</turn>", "\n", "日本", "</turn"]) for _ in range(rnd.choice([0, 3, 9, 30]))))
            for t, role in enumerate(roles[: n])]


def test_windows_hold_every_conversation(spark):
    rnd = random.Random(5)
    rows = [r for c in range(30) for r in _talk(rnd, c, rnd.choice([1, 2, 7, 40]), c % 3 == 0)]
    rows += [(100, 0, None, None), (101, None, "assistant", "x"), (101, 0, "system", "late"), (102, 0, "assistant", ""), (None, 0, "user", "nobody")]
    rows += [(103, 5, "</turn>\n<text>", r"<\/turn> <\\turn> <text> \ <"), (103, 9, "assistant", "</turn>\n</turn><"), (104, 0, "system", "s " * 90)]
    rows += [(104, t, "assistant", f"t{t} " * 4) for t in range(1, 60)] + [(105, 0, "user", "w " * 5000), (105, 1, "assistant", "v " * 5000)]
    by = _check_windows(spark, rows, budget=64, history=12)
    assert len(by[104]) > 3 and max(w.n_context for w in by[104]) > 2


def test_windows_of_hot_and_repeated_turns(spark):
    rnd = random.Random(6)
    rows = _talk(rnd, 1, 400, True) + _talk(rnd, 2, 5) + [(3, 0, "assistant", "same")] * 150 + [(4, None, "assistant", f"n{i}") for i in range(90)]
    by = _check_windows(spark, rows, budget=64, history=12, run=32)
    assert len(by[1]) >= 400 // 32 and len(by[3]) > 3


def test_digests(spark):
    rows = [(1, 1, "assistant", "b é"), (1, 0, "user", "a"), (1, 2, "assistant", None), (2, 0, None, "q")]
    got = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_chat(_chat(spark, rows))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (3, sha("user\na\nassistant\nb é\nassistant\n\n"))
    assert (got[1].loss_chars, got[1].loss_sha256) == (3, sha("b é")) and (got[2].loss_chars, got[2].loss_sha256) == (0, sha(""))
    assert chat_format.format_chat(_chat(spark, [])).collect() == []


def test_chat_plan_is_native(spark):
    rows = _talk(random.Random(1), 1, 10)
    plan = chat_format.conversation_digests(chat_format.format_chat(_chat(spark, rows)))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_hard_negatives", "op13_chat_format"])
def test_query_equals_sql(spark, name):
    from ringlens.llm.oracle import ORACLE
    from ringlens.llm.queries import QUERIES
    from tools.oracle_check import compare, duck

    sf = "/root/testdata/sf0.001"
    info = compare(spark, duck(sf), name, QUERIES[name], ORACLE[name], sf)
    assert info["ok"], info
