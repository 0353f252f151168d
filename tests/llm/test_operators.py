"""Each operator against brute force on small tables, with nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringlens.llm import embedding_dedup, fingerprints, jaccard_join, language_id, license_scan, mixing, pii, url_filter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    full = [(*r, *[None] * (5 - len(r))) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---------------------------------------------------------------- op 10


def _shingles(text, width):
    w = _words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def _brute_components(rows, width, percent):
    sets = [_shingles(t, width) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= percent * len(sets[i] | sets[j]):
                at[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def _near_copies(rnd, n_groups=12):
    rows = []
    for g in range(n_groups):
        size = rnd.choice([1, 3, 4, 5, 8, 20, 60, 200, 900])
        base = [rnd.choice("abcdefghij") + str(rnd.randint(0, 400)) for _ in range(size)]
        for _ in range(rnd.randint(1, 9)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, size // 40))):
                w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 99)}"
            w += ["tail"] * rnd.randint(0, max(1, size // 30))
            rows.append(" ".join(w))
    rnd.shuffle(rows)
    return [(1000 - i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, width, percent):
    rows = _near_copies(random.Random(width))
    rows += [(None, rows[0][1]), (None, None), (2000, ""), (2001, None), (2002, " \n\t"), (7, rows[3][1]), (7, rows[3][1]), (2003, "One TWO"),
             (2004, "one two"), (2005, "é É"), (2006, "one\u00a0two"), (2007, "w " * 30_000)]
    got = jaccard_join.jaccard_components(_docs(spark, rows).withColumn("node", F.lit(1)), width=width, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == _brute_components(rows, width, percent)


def test_jaccard_empty(spark):
    assert jaccard_join.jaccard_components(_docs(spark, [(1, "a")]).limit(0)).collect() == []


def test_cells_are_shared_by_every_linked_pair():
    rnd = np.random.default_rng(3)
    classes = jaccard_join.SizeClasses(85)
    for n in [6, 7, 9, 13, 20, 33, 50, 77, 120, 260, 500, 1500]:
        for _ in range(30):
            a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
            most = 15 * 2 * n // 185
            cut = int(rnd.integers(0, most // 2 + 1))
            b = np.unique(np.concatenate([a[rnd.permutation(len(a))[cut:]], rnd.integers(0, 2**63, cut, dtype=np.uint64)]))
            same = len(np.intersect1d(a, b))
            if 100 * same >= 85 * (len(a) + len(b) - same) and cut:
                assert len(np.intersect1d(jaccard_join.cells(a, classes), jaccard_join.cells(b, classes))) > 0


@pytest.mark.parametrize("percent", [80, 85])
def test_unrelated_sets_share_hardly_a_cell(percent):
    """Blocks that are empty in many sets gather nobody, so the rows of cells grow with the sets and not with their pairs."""
    rng = np.random.default_rng(4)
    classes = jaccard_join.SizeClasses(percent)
    for n in (60, 211, 252, 315, 1000, 4000):
        found = [jaccard_join.cells(np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64)), classes) for _ in range(40)]
        names = np.concatenate(found)
        assert len(names) - len(np.unique(names)) <= len(names) // 50, n
        assert all(len(f) == sum(differ + 1 for _, _, differ in classes.of(n)) for f in found)



def test_tree_finds_what_the_bound_allows():
    rnd = np.random.default_rng(1)
    pts = rnd.integers(0, 5, (150, jaccard_join.GROUPS)).astype(np.int32)
    pts[75:] = pts[:75]
    for i in range(75, 150):  # points of some 500 tokens that differ in 20 of them
        pts[i, rnd.choice(jaccard_join.GROUPS, 20, replace=False)] += 1
    comp, side = np.arange(150), np.zeros(150, bool)
    x, y = jaccard_join.tree_pairs(pts, comp, side, 85)
    size = pts.sum(1)
    want = {(i, j) for i in range(150) for j in range(i) if np.minimum(pts[i], pts[j]).sum() >= jaccard_join.needed(size[i], size[j], 85)}
    assert {(max(a, b), min(a, b)) for a, b in zip(x.tolist(), y.tolist(), strict=True)} == want and want


# ---------------------------------------------------------------- op 2


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_id_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(90001, None, "en"), (90002, "", None), (90003, "123 !!", "de"), (None, "the and", "xx"), (90004, "der die das " * 9000, None)]
    got = {r.doc_id: r for r in language_id.language_id(docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("score", F.lit("x"))).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (90001, 90002, 90003))
    assert got[90004].lang_pred == "de" and got[None].held_out is False and "xx" not in {r.lang_pred for r in got.values()}
    bare = language_id.language_id(docs.withColumn("lang", F.lit(None).cast("string")).limit(3)).collect()
    assert {r.lang_pred for r in bare} == {"und"}
    assert language_id.language_id(docs.limit(0)).count() == 0


def test_centroids_hold_the_vectors_once():
    import tracemalloc

    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(400)]
    texts = [" ".join(rng.choice(words[100 * (i % 3) : 100 * (i % 3) + 200], 60)) for i in range(600)] + ["12", ""]
    idf = rng.uniform(1, 5, language_id.DIM).astype(np.float32)
    found = [(c[h], h) for c, h in language_id.features(texts)]
    v = language_id.vectors(np.concatenate([c for c, _ in found]), idf)
    del found

    def peak(run):
        tracemalloc.start()
        out = run()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    centres, most = peak(lambda: language_id._cluster(v, 3))
    assert most < 0.3 * v.nbytes
    again, most = peak(lambda: language_id.centroids(texts, idf, 3)[0])
    assert most < v.nbytes + (24 << 20)
    assert again.tobytes() == centres.tobytes()
    nearest = np.argmax(v @ centres.T, axis=1)
    for j in range(3):
        assert language_id._mean(v, nearest == j).tobytes() == v[nearest == j].mean(0).tobytes()
    assert not len(language_id.centroids(["", "12"], idf, 3)[0])


# ---------------------------------------------------------------- op 3


def _brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(2 * sizes[s] for s in stopped)
        target = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free} | {s: 2 * sizes[s] for s in stopped}
        over = {s for s in free if target[s] >= 2 * sizes[s]}
        if not over:
            return target
        stopped |= over
        if len(stopped) == len(names):
            return {s: min(2 * sizes[s], 2 * sizes[s]) for s in names}


def test_mixing(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randint(0, 60), None, rnd.choice(["a", "b", "é", "Z", None, "hot", "hot", "hot"])) for i in range(900)]
    rows += [(None, None, None, "none"), (5, "x y", None, "Z"), (5, "x y", None, "Z"), (6, "q " * 5000, None, "a")]
    docs = _docs(spark, rows).withColumn("target", F.lit("clash"))
    got = mixing.mixing_counts(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(_words(t))
    target, taken = _brute_targets(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert math.isclose(sum(target.values()), 1.5 * sum(sizes.values()), rel_tol=1e-9)
    for s in ("hot", "b", "é"):
        assert abs(taken[s] - target[s]) < 0.15 * target[s] + 60
    again = mixing.mixing_counts(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mixing_counts(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- op 4


def _brute_links(rows, reach):
    good = [(i, v, lab) for i, (_, v, lab) in enumerate(rows)
            if v and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    for a, (i, x, p) in enumerate(good):
        for j, y, q in good[:a]:
            if p == q and len(x) == len(y) and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= reach:
                out.add((j, i))
    return out


def test_embedding_components(spark):
    rnd = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(40):
            centre = rnd.normal(size=16)
            for _ in range(int(rnd.integers(1, 6))):
                rows.append((k, [float(np.float32(x)) for x in centre + rnd.normal(size=16) * 0.08], label))
                k += 1
    rows += [(500, rows[3][1], 0), (501, rows[3][1], 1), (501, rows[3][1], None), (502, None, 1), (503, [0.0] * 16, 1), (504, [None] + [1.0] * 15, 1),
             (505, [float("nan")] + [1.0] * 15, 1), (506, [float("inf")] + [1.0] * 15, 1), (507, [], 1), (508, [1.0, 2.0], 1), (509, [2.0, 4.0], 1),
             (None, rows[9][1], rows[9][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x"))
    got = embedding_dedup.embedding_components(df).collect()
    links = _brute_links(rows, 0.93)
    count = [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    want = sorted((r[0] if r[0] is not None else -1, c) for r, c in zip(rows, count, strict=True))
    have = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links) for r in got)
    assert sum(a == b for a, b in zip(want, have, strict=True)) >= 0.98 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert sum(c for _, c in have) >= 0.95 * 2 * len(links) and max(r.recall for r in got) >= 0.9
    assert embedding_dedup.embedding_components(df.limit(0)).count() == 0


def test_shards_split_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 64)
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=8)
    rows = [(i, [float(v) for v in x + rnd.normal(size=8) * 0.02], 1) for i in range(400)]
    rows += [(1000 + i, [float(v) for v in rnd.normal(size=8)], 1) for i in range(300)]
    got = embedding_dedup.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.component_id for r in got if r.vec_id < 1000} == {0}


def test_all_links_of_a_group_of_many_shards_are_counted(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 32)
    rnd = np.random.default_rng(11)
    x = rnd.normal(size=32)
    rows = [(i, [float(v) for v in x + rnd.normal(size=32) * 0.15], 1) for i in range(300)]
    rows += [(1000 + i, [float(v) for v in rnd.normal(size=32)], 1) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = [0] * len(rows)
    for i, j in _brute_links(rows, 0.93):
        want[i] += 1
        want[j] += 1
    assert sum(want) > 300 * 250
    for overlaps in ((2, 3, 4), ()):  # without the search everything is compared
        monkeypatch.setattr(embedding_dedup, "OVERLAPS", overlaps or (2,))
        monkeypatch.setattr(embedding_dedup, "RECALL", 0.95 if overlaps else 1.1)
        got = {r.vec_id: r for r in embedding_dedup.embedding_components(df).collect()}
        assert [got[r[0]].n_links for r in rows] == want


def test_no_shard_is_lost_and_equal_directions_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 32)
    rnd = np.random.default_rng(12)
    x = rnd.normal(size=8)
    rows = [(i, [float(v) for v in x * (i + 1)], 1) for i in range(200)]
    rows += [(1000 + i, [float(v) for v in rnd.normal(size=8)], 1) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    _, nodes = embedding_dedup.nodes_of(df)
    placed, whole = embedding_dedup.shards(nodes, 2)
    assert placed.groupBy("shard").count().agg(F.max("count")).first()[0] <= 32
    main = placed.filter("main").union(whole.filter("main"))
    assert main.count() == main.select("node").distinct().count() == nodes.count() == 500
    got = {r.vec_id: r for r in embedding_dedup.embedding_components(df).collect()}
    assert all(got[i].component_id == 0 and got[i].n_links >= 199 for i in range(200))


# ---------------------------------------------------------------- op 5


def test_licenses(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, gpl), (2, "Text.\n" + gpl.upper() + "\nMore."), (3, None), (4, ""), (5, "license license under the sea"),
            (6, "x\nReleased under the MIT License.\nAll rights reserved."), (6, "x\nReleased under the MIT License.\nAll rights reserved."),
            (7, "word " * 30_000 + "\n" + gpl), (8, "This work is\nlicensed under the GNU General Public\nLicense, version 3.\n\nnext")]
    got = sorted((r.doc_id, [m.license for m in r.licenses], r.best_license, r.n_licenses) for r in license_scan.license_scan(_docs(spark, rows).withColumn("whole", F.lit(1))).collect())
    gpl_row = [["GPL-3.0"], "GPL-3.0", 1]
    both = [["All-Rights-Reserved", "MIT"], "All-Rights-Reserved", 2]
    assert [list(r[1:]) for r in got] == [gpl_row, gpl_row, [[], None, 0], [[], None, 0], [[], None, 0], both, both, gpl_row, gpl_row]
    assert license_scan.license_scan(_docs(spark, rows).limit(0)).count() == 0


def test_licenses_inside_lines_and_wrapped_over_lines(spark):
    mpl = license_scan.TEMPLATES["MPL-2.0"].split()
    header = "/* mod.c - part of a tool\n" + "\n".join(" * " + " ".join(mpl[i : i + 9]) for i in range(0, len(mpl), 9)) + "\n */\nint main(void) {"
    rows = [(1, "A paper by the authors. Licensed under the Apache License, Version 2.0. See the file for the rest of it."), (2, header),
            (3, "x y z\nThis work is licensed under the GNU\nGeneral Public License,\nversion 3.\nmore words"), (4, "the license of the work is licensed under nothing")]
    got = sorted((r.doc_id, r.best_license, r.best_dice) for r in license_scan.license_scan(_docs(spark, rows)).collect())
    assert got == [(1, "Apache-2.0", 1.0), (2, "MPL-2.0", 1.0), (3, "GPL-3.0", 1.0), (4, None, 0.0)]


def _made_documents():
    texts = license_scan.TEXTS
    comment = lambda t, mark: "\n".join(f"{mark} {' '.join(t.split()[i : i + 8])}" for i in range(0, len(t.split()), 8))
    rows = [(i, f"tool.c\n{comment(t, '#')}\n#\n# more to read\ncode = 1") for i, t in enumerate(t for of in texts.values() for t in of)]
    rows += [(100 + i, f"Some words before. {t} And words after it, in one line.") for i, t in enumerate(t for of in texts.values() for t in of)]
    mit = texts["MIT"][0]
    rows += [
        (200, f"MIT License\n\nCopyright (c) 2020 A\n\n{mit}\n\nThe above copyright notice shall be kept.\n"), (201, mit.replace("free of charge", "gratis")),
        (202, "free software under a public license, without restriction, to any person"), (203, f"{texts['GPL-2.0'][0]}\n\n{texts['GPL-3.0'][0]}"),
        (204, texts["GPL-3.0"][0].replace("version 3 of the License", "any version")), (205, None), (206, ""),
        (207, f"{texts['BSD-2-Clause'][0]}\n1. x\n{texts['BSD-3-Clause'][0]}"),
    ]
    return rows


def test_whole_texts_and_headers_are_found_and_told_apart(spark):
    got = {r.doc_id: [m.license for m in r.licenses] for r in license_scan.license_scan(_docs(spark, _made_documents())).collect()}
    names = [name for name, of in license_scan.TEXTS.items() for _ in of]
    for i, name in enumerate(names):
        assert got[i] == [name] and got[100 + i] == [name], (name, got[i], got[100 + i])
    assert got[200] == ["MIT"] and got[201] == ["MIT"] and got[202] == [] and got[203] == ["GPL-2.0", "GPL-3.0"]
    assert got[204] == [] and got[205] == [] and got[206] == [] and got[207] == ["BSD-2-Clause", "BSD-3-Clause"]


def test_made_notices_equal_sql(spark, tmp_path):
    import duckdb

    from ringlens.llm.oracle import ORACLE
    from ringlens.llm.queries import QUERIES

    _docs(spark, _made_documents()).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_licenses, r.licenses, r.best_license, round(r.best_dice, 9)) for r in QUERIES["op5_license_scan"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    con.execute(f"CREATE TABLE found AS {ORACLE['op5_license_scan']}")
    want = {r[0]: (r[1], r[2], r[3], round(r[4], 9)) for r in con.execute("SELECT doc_id, n_licenses, licenses, best_license, best_dice FROM found").fetchall()}
    assert got == want and sum(n for n, *_ in got.values()) > 40


def test_signals_are_in_every_unit_that_matches():
    rnd = random.Random(1)
    for text in [t for of in license_scan.all_templates().values() for t in of]:
        words = license_scan._template_words(text)
        own = set(license_scan._template_bigrams(words))
        signs = set(license_scan.signals(sorted(own), 0.8))
        for _ in range(300):
            w = [x for x in words if rnd.random() > 0.12]
            for _ in range(rnd.randint(0, 3)):
                w.insert(rnd.randint(0, len(w)), "extra")
            have = set(zip(w, w[1:], strict=False))
            have = {" ".join(p) for p in have}
            if have and 2 * len(have & own) / (len(have) + len(own)) >= 0.8:
                assert have & signs


# ---------------------------------------------------------------- op 6


def _brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_filter(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.b", "", "block")]
    urls = [None, "", "nothing", "http://", "http://x.NET/", "http://x.net", "http://net/?q", "https://www.example.net/en/1#x", "http://example.net/e",
            "http://badexample.com/de/", "http://q.example.com/de/ü", "ftp://h.org/fr/x://y.net/", "http://a.b", "http://c.a.b?x", "http://.net/", "x://É.org/fr/"]
    urls += [f"http://h{i}.{t}/{p}/{i}" for i in range(200) for t in ("net", "example.net", "example.com", "org") for p in ("en", "de", "fr")]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, "http://x.net/"), (0, "http://x.net/"), (None, "http://x.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    frame = spark.createDataFrame(rules + [(None, "/", "block"), ("x", "/", None)], "host string, path string, verdict string")
    got = sorted(map(str, map(tuple, url_filter.url_filter(pages, frame).collect())))
    assert got == sorted(str((i, *_brute_rule(u, rules))) for i, u in rows)
    assert url_filter.url_filter(pages.limit(0), frame).count() == 0
    assert {r.verdict for r in url_filter.url_filter(pages, frame.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter("cast(substr(key, 2) as int) % 7 = 0").union(spark.createDataFrame([("outside",), (None,)], "key string"))
    cascade = url_filter.build_cascade(listed, keys.union(keys))
    rows = url_filter.hashed(keys).toPandas()
    said = cascade.listed(rows["h"].to_numpy(), rows["g"].to_numpy())
    assert (said == (rows["key"].str[1:].astype(int) % 7 == 0)).all() and len(cascade.levels) > 1


# ---------------------------------------------------------------- op 8


def _brute_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        check = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and check % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(6)
    parts = ["a", "b.c", "@", "@", ".", "-", "+", "1", "22", "255", "256", "4111 1111 1111 1111", "4111111111111111", " ", " ", "(", ")", "ü", "+1 (555) 123-4567", "1.2.3.4", "x@y.zz", "_%"]
    for _ in range(6000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert pii.base_spans(t) == _brute_base(t), t
    assert pii.base_spans("1" * 100_000 + "." * 100_000 + "a" * 100_000 + "@") == []


def test_personal_data(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [(90001, None), (90002, ""), (None, "mail me: a@b.co"), (90003, "x@y.zz 1.2.3.4 " * 3000), (90003, "x@y.zz 1.2.3.4 " * 3000)]
    rows = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("pii", F.lit("clash"))
    got = pii.personal_data(rows).collect()
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert len(got) == rows.count()
    for r in got:
        base = _brute_base(texts[r.doc_id])
        said = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(said) <= set(spans) and [sum(s.startswith(k + ":") for s in spans) for k in pii.KINDS] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
    assert pii.personal_data(rows.limit(0)).count() == 0


def test_trees_learn_the_format():
    from ringlens.llm.pii import Trees, _redact

    none = Trees([], [], [2.0] * 4)
    assert none.spans("call +1 555 123 4567 now") == ([(5, 3, 20)], [(5, 3, 20)])
    assert _redact("call +1 555 123 4567 now", [(5, 3, 20)]) == "call [PHONE] now"


def test_trees_add_forms_that_no_base_rule_lists(spark):
    rnd = random.Random(5)
    words = "the river runs along old walls and then some people went home".split()

    def some(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    def card():
        d = "4" + "".join(str(rnd.randint(0, 9)) for _ in range(14))
        return next(d + str(i) for i in range(10) if pii.luhn(d + str(i)))

    def phone():
        return f"({rnd.randint(200, 999)}) {rnd.randint(200, 999)}-{rnd.randint(1000, 9999)}"

    make = [lambda: f"{rnd.choice(words)}.{rnd.randint(1, 99)}@mail.example.com", card, lambda: f"+1 {phone()}"]
    rows = [(i, f"{some(6)} {make[i % 3]()} {some(5)}") for i in range(900)]
    wanted = {}
    for i in range(30):
        number = card()
        for k, (kind, form) in enumerate((("phone", phone()[1:].replace(") ", ".").replace("-", ".")), ("phone", phone()), ("card", ".".join(number[j : j + 4] for j in range(0, 16, 4))), ("email", f"{rnd.choice(words)}@exämple.com"))):
            before = some(4)
            rows.append((1000 + 10 * i + k, f"{before} {form} {some(4)}"))
            wanted[rows[-1][0]] = f"{kind}:{len(before) + 1}:{len(before) + 1 + len(form)}"
        for k, clean in enumerate((str(rnd.randint(10**9, 10**10)), f"2021-03-{10 + i % 20} 10:30", f"3.{rnd.randint(10**9, 10**10)}", "4111.1111.1111.1112", "user@localhost"), 4):
            rows.append((1000 + 10 * i + k, f"{some(4)} {clean} {some(4)}"))
            wanted[rows[-1][0]] = ""
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = [got[i] == w for i, w in wanted.items() if w]
    assert sum(hit) >= 0.9 * len(hit), [(got[i], w) for i, w in wanted.items() if w and got[i] != w][:9]
    wrong = [got[i] for i, w in wanted.items() if not w and got[i]]
    base = sum(bool(pii.base_spans(t)) for i, t in rows if wanted.get(i) == "")
    assert len(wrong) <= base + 1, [(t, got[i]) for i, t in rows if wanted.get(i) == "" and got[i]][:9]


def test_trees_add_addresses_in_other_forms(spark):
    rnd = random.Random(9)
    words = "the river runs along old walls and then some people went home".split()

    def some(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    def four():
        return [str(rnd.randint(1, 255)) for _ in range(4)]

    rows = [(i, f"{some(5)} {'.'.join(four())} {some(4)}") for i in range(900)]
    wanted = {}
    for i in range(30):
        hexes = [f"{rnd.randint(4096, 65535):x}" for _ in range(8)]
        forms = ["[.]".join(four()), " . ".join(four()), f"2001:db8:{hexes[0]}:{hexes[1]}::{hexes[2]}", ":".join(["2001", *hexes[1:]])]
        clean = [f"{rnd.randint(10, 23)}:{rnd.randint(10, 59)}:{rnd.randint(10, 59)}", ":".join(f"{rnd.randint(16, 255):x}" for _ in range(6)), "12[.]400[.]3[.]9"]
        for k, form in enumerate(forms + clean):
            before = some(4)
            rows.append((1000 + 10 * i + k, f"{before} {form} {some(4)}"))
            wanted[rows[-1][0]] = f"ip:{len(before) + 1}:{len(before) + 1 + len(form)}" if form in forms else ""
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows * 3, "doc_id long, text string")).collect()}
    hit = [got[i] == w for i, w in wanted.items() if w]
    assert sum(hit) >= 0.9 * len(hit), [(got[i], w) for i, w in wanted.items() if w and got[i] != w][:9]
    wrong = [(t, got[i]) for i, t in rows if wanted.get(i) == "" and got[i]]
    assert len(wrong) <= 1, wrong[:9]


def test_many_added_spans_in_one_text():
    import time

    all_in = pii.Trees([], [], [0.4] * 4)  # no tree: every score is one half
    text = "0123 456 7890 x " * 20_000
    began = time.perf_counter()
    base, spans = all_in.spans(text)
    assert base == [] and len(spans) == 20_000 and all(a[2] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert time.perf_counter() - began < 30


# ---------------------------------------------------------------- op 9


def test_edited_texts(spark):
    rows = [(3, "One. Two.\nThree four."), (1, "abcdefgh"), (2, "é" * 9), (9, None), (9, ""), (11, "x" * 50_000), (5, "a b. " * 40), (4, "a b. " * 40), (None, "last")]
    got = {(r.doc_id, r.n_chars): r for r in fingerprints.edited_fingerprints(_docs(spark, rows).withColumn("fingerprint", F.lit(0))).collect()}
    ordered = sorted(((d, t or "") for d, t in rows if d is not None), key=lambda r: r[0]) + [(None, "last")]
    for (d, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        if d != 9:
            assert got[d, len(t)].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[4, 200].fingerprint == got[5, 200].fingerprint and got[4, 200].near_next == 1.0 == got[4, 200].near_edited
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert fingerprints.edited_fingerprints(_docs(spark, rows).limit(0)).count() == 0


def test_buckets_do_not_change_the_order(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = sorted(map(tuple, fingerprints.edited_fingerprints(docs).collect()))
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 7)
    assert sorted(map(tuple, fingerprints.edited_fingerprints(docs).collect())) == whole


def test_fingerprint_is_a_multiset_hash(spark):
    df = spark.createDataFrame([("One. Two.\nThree.\n", "Three.\nOne. Two.\n", "Two.\n", "One. Three.\n")], "a string, b string, c string, d string")
    fp = {k: fingerprints.fingerprint(F.col(k)) for k in "abcd"}
    row = df.select(
        (fp["a"] == fp["b"]).alias("order"), (fingerprints.insert(fp["d"], fp["c"]) == fp["a"]).alias("insert"),
        (fingerprints.delete(fp["a"], fp["c"]) == fp["d"]).alias("delete"), (fp["a"] == fp["d"]).alias("other"), F.length(fp["a"]).alias("n"),
    ).first()
    assert (row.order, row.insert, row.delete, row.other, row.n) == (True, True, True, False, fingerprints.DIGITS)
