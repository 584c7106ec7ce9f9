import hashlib
import random

import brute
import numpy as np
import pandas as pd
import pytest

from tessera.llm.exact_dedup import drop_exact_copies, exact_dedup
from tessera.llm.near_dedup import SIZE, drop_near_copies, near_components, sketch
from tessera.llm.substring_dedup import FingerprintIndex, _entries, _per_text, _repeated, _windows_packed, anchors, remove_repeats
from tessera.llm.textkit import inner, windows, words_of

WORDS = [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(400)]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=5):
    rng = random.Random(seed)
    base = [text(rng, rng.choice([3, 8, 60, 120, 300])) for _ in range(40)]
    rows = list(base) + base[:8] + [base[4].upper(), base[5].replace(" ", "\t")]
    for k in range(60):  # a group of near copies with growing edits
        w = base[20].split() if len(base[20].split()) > 50 else text(rng, 150).split()
        for _ in range(k // 6):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append(" ".join(w))
    passage = text(rng, 60)
    rows += [f"{text(rng, 40)} {passage} {text(rng, 40)}" for _ in range(6)]
    rows += ["", None, "   \n", "one", "one", " ".join(["same"] * 200), "x" * 50_000, text(rng, 30_000)]
    return list(enumerate(rows))


def test_word_hashes_match_words():
    texts = ["a  bb\tccc\x0bd", "", None, "é ü  ", "a bb"]
    w = words_of(texts)
    assert w.counts().tolist() == [len(brute.words(t)) for t in texts]
    seen = {}
    for h, x in zip(w.hash.tolist(), [x for t in texts for x in brute.words(t)], strict=True):
        assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)
    assert inner(w.first, 2).tolist() == [True, True, True, False, True, False, True]
    assert len(windows(w.hash, 3)) == len(w.hash) - 2


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    b = np.concatenate([a[:450], rng.integers(0, 2**63, 50).astype(np.uint64)])
    s = sketch([a, b, a[:1], a[:0]])
    assert (s[:3] != np.uint64(2**64 - 1)).all() and (s[3] == np.uint64(2**64 - 1)).all()
    assert abs((s[0] == s[1]).mean() - 450 / 550) < 4 * 0.5 / SIZE**0.5


@pytest.mark.parametrize("percent", [80, 85])
def test_near_components_equal_brute_force(make, percent):
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_components(make(rows), percent=percent).collect()}
    want = brute.near_components(rows, percent)
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}
    kept = {r["doc_id"] for r in drop_near_copies(make(rows), percent).collect()}
    assert kept == {i for i, (_, c) in want.items() if c == i}


def test_near_without_ids_or_rows(make):
    t = "one two three four five six seven"
    got = near_components(make([(None, t), (7, t), (9, t), (None, "alone"), (7, t)])).collect()
    assert sorted((r["component_id"] or -1 for r in got)) == [-1, 7, 7, 7, 7]
    assert near_components(make([])).count() == 0


@pytest.mark.parametrize("many", [1, 10**9])
def test_components_on_either_route(spark, tmp_path, monkeypatch, many):
    import tessera.llm.common as C

    monkeypatch.setattr(C, "MANY_ROWS", many)
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, k) for k in range(2000, 2400)] + [(k, k + 1) for k in range(3000, 3040)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = C.connected_components(C.Stages(spark, "test"), spark.createDataFrame(edges, "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == {x: root(x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("many", [1, 10**9])
def test_near_with_repeated_ids(make, monkeypatch, many):
    monkeypatch.setattr("tessera.llm.common.MANY_ROWS", many)
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near_a, near_b = a.replace("a39", "z"), b.replace("b39", "z")
    rows = [(7, a), (7, b), (3, near_a), (9, near_b), (None, c), (None, c.replace("c39", "z")), (5, c.replace("c0 ", "y ")), (1, None), (1, "")]
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in near_components(make(rows)).collect())
    want = [(-1, 36, 5, False), (-1, 36, 5, False), (1, 0, 1, True), (1, 0, 1, True), (3, 36, 3, True), (5, 36, 5, True), (7, 36, 3, False), (7, 36, 7, True), (9, 36, 7, False)]
    assert got == want
    kept = sorted((r["doc_id"] or -1, (r["text"] or "")[:2]) for r in drop_near_copies(make(rows)).collect())
    assert kept == [(1, ""), (1, ""), (3, "a0"), (5, "y "), (7, "b0")]
    nameless = [(None, a), (None, near_a), (None, a), (None, b)]
    assert len({r["text"] for r in drop_near_copies(make(nameless)).collect()}) == 2


def test_texts_of_one_template_stay_linear(make):
    """Texts a little too far apart share every template shingle, and none is compared with all others."""
    rows = []
    for k in range(2000):
        w = [f"t{i}" for i in range(200)]
        for at in (20, 70, 120, 170):  # 176 of 216 shingles in common
            w[at] = f"own{k}x{at}"
        rows.append((k, " ".join(w)))
    import tessera.llm.near_dedup as N

    pairs = []
    keep = N.Stages.keep

    def counted(self, df, label="t"):
        out = keep(self, df, label)
        if label.endswith("pairs"):
            pairs.append(out.count())
        return out

    N.Stages.keep = counted
    try:
        got = near_components(make(rows), percent=85).filter("kept").count()
    finally:
        N.Stages.keep = keep
    assert got == 2000 and sum(pairs) < 100 * 2000


@pytest.mark.parametrize("window", [12, 35])
def test_remove_repeats_equals_brute_force(make, window):
    rows = corpus(7)
    got = {r["doc_id"]: r for r in remove_repeats(make(rows), window=window, with_text=True, batches=5, bucket_chars=20_000).collect()}
    for i, (n, gone, kept) in brute.remove_repeats(rows, window).items():
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, gone)
        assert got[i]["kept_text"] == kept and got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_remove_repeats_edges(make):
    t = " ".join(f"t{i}" for i in range(40))
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in remove_repeats(make([(1, t), (1, t), (None, "a b"), (2, None)])).collect())
    assert got == [(-1, 0), (1, 40), (1, 40), (2, 0)]
    assert remove_repeats(make([])).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(make([]), window=5)


def opposite_words(n):
    """Two words over a and b that a hash by powers modulo 2**64 cannot tell apart."""
    a = "a"
    while len(a) < n:
        a += a.translate({97: 98, 98: 97})
    return a, a.translate({97: 98, 98: 97})


def test_words_that_differ_in_regular_ways_stay_apart(make):
    assert all(len(set(words_of(list(opposite_words(n))).hash.tolist())) == 2 for n in (2, 64, 512, 4096))
    a, b = opposite_words(1024)
    rows = [(k, " ".join([*(f"q{i}" for i in range(20)), w, *(f"q{i}" for i in range(20, 39))])) for k, w in enumerate((a, b))]
    assert len(set(words_of([a, b]).hash.tolist())) == 2
    assert {r["n_removed"] for r in remove_repeats(make(rows)).collect()} == {0}
    assert {r["component_id"] for r in near_components(make(rows), percent=85).collect()} == {0, 1}


def test_index_is_compacted_reopened_and_complete(spark, tmp_path):
    rng = random.Random(11)
    passages = [text(rng, 30) for _ in range(6)]
    texts = [(k, k, " ".join([text(rng, 15), rng.choice(passages), text(rng, 15)])) for k in range(80)]
    table = spark.createDataFrame(texts, "k1 long, k2 long, text string")
    path, found = f"file://{tmp_path}/index", set()
    index = FingerprintIndex.create(spark, path, window=20, buckets=3, fan_in=3)
    for k in range(7):
        if k in (2, 5):  # once before and once after a compaction
            n = len(index.runs)
            index.close()
            assert sum(1 for x in (tmp_path / "index").iterdir() if x.name.startswith("run-")) == n  # what was merged is gone
            index = FingerprintIndex.open(spark, path)
            assert len(index.runs) == n and (index.window, index.buckets, index.fan_in) == (20, 3, 3)
        found |= {(r["k1"], at) for r in index.add(table.filter(f"k1 % 7 = {k}")).collect() for at in r["places"]}
        assert 1 <= len(index.runs) <= 2
        for name, run in index.runs:  # a run holds each hash once, and its files are one a bucket at most
            assert spark.table(run).count() == spark.table(run).select("h").distinct().count()
            assert sum(x.suffix == ".parquet" for x in (tmp_path / "index" / name).iterdir()) <= 3
    at = {}
    for k, _, t in texts:
        w = words_of([t])
        _, pos, core = anchors(w.hash, w.first, 20)
        for p in set(pos.tolist()):
            at.setdefault(int(core[p]), []).append((k, p))
    assert found == {x for places in at.values() if len(places) > 1 for x in places}
    index.close()
    with pytest.raises(FileNotFoundError):
        FingerprintIndex.open(spark, f"file://{tmp_path}")


def test_run_merge_joins_without_moving_history(spark, tmp_path):
    index = FingerprintIndex.create(spark, f"file://{tmp_path}/index", window=12)
    index.add(spark.createDataFrame([(1, 1, text(random.Random(1), 50))], "k1 long, k2 long, text string"))
    old = spark.table(index.runs[0][1])
    new = spark.range(9).selectExpr("id as h").groupBy("h").count()
    plan = new.hint("merge").join(old, "h")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange") == 1
    index.close()


def test_what_stands_everywhere_leaves_a_flush_once():
    n, zero = 1000, np.zeros(0, np.int64)
    frames = list(_entries(np.full(n, 5), np.arange(n), np.arange(n), np.zeros(n, np.int32)))
    assert len(frames[0]) == 1 and bool(frames[0]["many"][0]) and len(frames[1]) == n
    frames = list(_windows_packed(8, np.full(n, 5), np.full(n, 6), np.arange(n) << 16, np.arange(n), np.zeros(n, np.int32)))
    assert len(frames[0]) == 1 and len(frames[0]["d1"][0]) == 8 and len(frames[1]) == 8
    assert len(next(_entries(*[zero] * 4))) == len(next(_windows_packed(8, *[zero] * 5))) == 0


@pytest.mark.parametrize("groups", [1, 3, 64])
def test_repeats_are_found_across_flushes(groups):
    rng = random.Random(groups)
    flushes = [[(rng.randrange(-6, 6) << 60, rng.randrange(2), (30 * f + k) << 16, k, k % 5) for k in range(30)] for f in range(6)]
    rows = pd.concat([frame for f in flushes for frame in _windows_packed(groups, *(np.array(c) for c in zip(*[x[:4] for x in f], strict=True)), np.array([x[4] for x in f], np.int32))])
    assert rows["bucket"].between(0, groups - 1).all()
    found = pd.concat(_repeated(groups)([rows.sort_values("bucket", kind="stable")])).sort_values("bucket", kind="stable")
    got = {(k1, k2, int(at)) for f in _per_text([found]) for k1, k2, p in f.itertuples(index=False) for at in np.frombuffer(p, np.int32)}
    count = {}
    for x in (x for f in flushes for x in f):
        count[x[:2]] = count.get(x[:2], 0) + 1
    assert got == {x[2:] for f in flushes for x in f if count[x[:2]] > 1}


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup(make, keep):
    rows = corpus(3)
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(brute.LOWER), []).append(i)
    best = {k: (min if keep == "min" else max)(v) for k, v in groups.items()}
    for r in exact_dedup(make(rows), keep=keep).collect():
        norm = (rows[r["doc_id"]][1] or "").translate(brute.LOWER)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (best[norm], len(groups[norm]), best[norm] == r["doc_id"])
        assert r["text_sha256"] == hashlib.sha256(norm.encode()).hexdigest()
    kept = drop_exact_copies(make(rows), keep)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(best.values()) and kept.columns == make([]).columns


def test_exact_edges(make):
    got = sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["kept"]) for r in exact_dedup(make([(None, "A"), (3, "a"), (3, "a"), (None, "É"), (4, "é")]), keep="max").collect())
    assert got == [(-1, -1, 1, True), (-1, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (4, 4, 1, True)]
    assert exact_dedup(make([])).count() == 0 and drop_exact_copies(make([(None, "only")])).count() == 1


def test_a_large_group_stays_linear(make):
    rng = random.Random(2)
    t = text(rng, 80)
    rows = [(i, t if i % 3 else text(rng, 30)) for i in range(1500)]
    got = exact_dedup(make(rows), keep="min").filter("kept").count()
    assert got == 500 + 1 and near_components(make(rows)).filter("kept").count() == 501
