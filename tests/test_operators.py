"""Operators without a SQL twin, and odd inputs of the others."""

import gzip
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import numbers as N
from tessera.functions import seq as S
from tessera.operators import annotation, cells, demux, expression, matrix, molecules, raster, saturation, spatial
from tessera.operators.order import numbered
from tessera.plans import jobs
from tessera.sources import fastq, tables
from tessera.streaming import ingest

# The prosody data of Gale and Sampson (1995) and its published estimates.
PROSODY = [(1, 120), (2, 40), (3, 24), (4, 13), (5, 15), (6, 5), (7, 11), (8, 2), (9, 2), (10, 1), (12, 3), (14, 2), (15, 1), (16, 1), (17, 3), (19, 1), (20, 3), (21, 2), (23, 3), (24, 3), (25, 3), (26, 2), (27, 2), (28, 1), (31, 2), (32, 2), (33, 1), (34, 2), (36, 2), (41, 3), (43, 1), (45, 3), (46, 1), (47, 1), (50, 1), (71, 1), (84, 1), (101, 1), (105, 1), (121, 1), (124, 1), (146, 1), (162, 1), (193, 1), (199, 1), (224, 1), (226, 1), (254, 1), (257, 1), (339, 1), (421, 1), (456, 1), (481, 1), (483, 1), (1140, 1), (1256, 1), (1322, 1), (1530, 1), (2131, 1), (2395, 1), (6925, 1), (7846, 1)]
SMOOTHED = {1: 0.7628079, 2: 1.706448, 3: 2.679796, 4: 3.663988, 5: 4.653366, 6: 5.645628, 10: 9.627446, 50: 49.57351, 1140: 1138.636, 7846: 7838.899}


def test_good_turing_golden():
    r, n = np.array(PROSODY).T
    star, p0 = cells.good_turing(r, n)
    assert abs(p0 - 0.003883244) < 1e-9
    for k, want in SMOOTHED.items():
        assert abs(star[list(r).index(k)] - want) < 1e-3
    with pytest.raises(ValueError):
        cells.good_turing(np.arange(1, 12), np.arange(11, 22))


def test_ambient_profile_sums_to_one():
    rng = np.random.default_rng(0)
    totals = pd.DataFrame({"gene": range(200), "total": rng.zipf(1.7, 200) * (rng.random(200) < 0.9)})
    p = cells.ambient_profile(totals)["p"]
    assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def merged_by_hand(umis):
    counts, total = dict(umis), dict(umis)
    order = sorted(umis.items(), key=lambda kv: (kv[1], kv[0]), reverse=True)
    while len(order) > 1:
        low, n = order.pop()
        for high, m in order:
            if n / m > 0.1:
                break
            if sum(a != b for a, b in zip(low, high, strict=True)) == 1:
                total[high] += total.pop(low)
                break
    assert counts
    return total


def test_umi_merge_equals_the_sequential_rule(spark):
    rng = random.Random(3)
    groups = {(f"b{k}", "g"): {"".join(rng.choice("ACG") for _ in range(4)): rng.choice([1, 2, 10, 30, 100, 1000, 20_000]) for _ in range(15)} for k in range(40)}
    groups["deep", "g"] = {"AAAA": 10_000, "AAAC": 1000, "AACC": 100, "ACCC": 10, "CCCC": 1}
    rows = [(*k, u, n) for k, umis in groups.items() for u, n in umis.items()]
    got = molecules.merge_umis(spark.createDataFrame(rows, "barcode string, gene string, umi string, cnt long"), 4).collect()
    assert {(r["barcode"], r["gene"], r["umi"]): r["cnt"] for r in got} == {(*k, u): n for k, umis in groups.items() for u, n in merged_by_hand(umis).items()}


def corrected_by_hand(b, entries, d):
    if b in entries:
        return b
    if not d:
        return None
    if "N" in b:
        i = b.index("N")
        hits = {e for x in "ACGT" for e in [(b[:i] + x + b[i + 1 :]).replace("N", "T")] if e in entries}
    else:
        hits = {e for e in entries if sum(p != q for p, q in zip(b, e, strict=True)) <= d}
    return hits.pop() if len(hits) == 1 else None


@pytest.mark.parametrize("d", [0, 1, 2])
def test_barcode_correction_equals_brute_force(spark, d):
    rng = random.Random(d)
    entries = {"".join(rng.choice("ACGT") for _ in range(6)) for _ in range(40)}
    seen = {"".join(rng.choice("ACGTN" if rng.random() < 0.2 else "ACGT") for _ in range(6)) for _ in range(300)} | set(list(entries)[:5])
    got = demux.correct_barcodes(spark.createDataFrame([(x,) for x in seen], "barcode string"), spark.createDataFrame([(x,) for x in entries], "barcode string"), 6, d)
    assert {r["barcode"]: r["corrected"] for r in got.collect()} == {b: corrected_by_hand(b, entries, d) for b in seen}


@pytest.mark.parametrize(("width", "d"), [(5, 1), (7, 2), (7, 3), (2, 2)])
def test_barcode_correction_spreads_without_broadcasts(spark, width, d):
    rng = random.Random(width + d)
    entries = {"".join(rng.choice("ACGT") for _ in range(width)) for _ in range(30)} | {"A" * width}
    seen = {"".join(rng.choice("ACGTN" if rng.random() < 0.2 else "ACGT") for _ in range(width)) for _ in range(200)} | set(list(entries)[:5]) | {"N" * width}
    got = demux.correct_barcodes(spark.createDataFrame([(x,) for x in [*seen, None]], "barcode string"), spark.createDataFrame([(x,) for x in entries], "barcode string"), width, d)
    rows = got.collect()
    assert {r["barcode"]: r["corrected"] for r in rows} == {b: corrected_by_hand(b, entries, d) for b in seen} | {None: None} and len(rows) == len(seen) + 1
    # the spread whitelist is many times the size that Spark guesses for it
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ACGTN", "!!5I~", 7)], "s string, q string, n long")
    r = df.select(
        S.encode(F.col("s")).alias("e"), S.encode(F.col("s"), strict=True).alias("x"), S.decode(F.lit(27), 4).alias("d"), S.low_quality(F.col("q"), 10, 1).alias("lq"), S.low_quality(F.col("q"), 10, 2).alias("hq"),
        S.good_bases(F.col("q")).alias("q30"), S.poly_t(F.lit("TTATTTTTTTTTT"), 12).alias("t"), S.reverse_complement(F.lit("AACG")).alias("rc"), F.size(S.within(F.lit("ACGT"), 4, 1)).alias("w"),
        S.displaced_linker(F.lit("AAxxGATTACAyyyy".upper()), "GATTACA", 2).alias("dl"), N.parse_number(F.lit("1,234.5 %")).alias("num"), N.kit_label(F.lit("BBV2.4")).alias("kit"), N.percent_text(F.lit(104.0)).alias("p"),
    ).first()
    assert (r["e"], r["x"], r["d"], r["lq"], r["hq"], r["q30"], r["t"], r["rc"], r["w"], r["dl"], r["num"], r["kit"], r["p"]) == (111, None, "ACGT", True, False, 2, True, "CGTT", 17, 2, 1234.5, "BBV2.4 (kit V1)", "100.00%")
    assert S.neighbours(20, 2) == 60 + 9 * 190 and S.split_structure("C4L15U10") == {"C": [(0, 4)], "L": [(4, 19)], "U": [(19, 29)]}
    with pytest.raises(ValueError):
        S.split_structure("C4X2")
    assert (N.perplexity(1), N.perplexity(1000), N.pca_size(100, 30), N.index_size(10**6)) == (1, 30, (30, 25), 8)
    assert N.microns_per_pixel((0, 0), (3, 4), 10) == 2


def test_displaced_barcode(spark):
    linker = "CGACTCACTACACGT"
    for shift in range(4):
        read = "ACGT" + "G" * 15 + "TTAA" + "T" * shift + "CGACTCACTACACGA" + "CCGG" + "ACGTACGTAC"
        b, u = demux.displaced_segments(F.col("s"), (4, 4, 4), 10, linker)
        r = spark.createDataFrame([(read,)], "s string").select(b.alias("b"), u.alias("u")).first()
        assert (r["b"], r["u"]) == ("ACGTTTAACCGG", "ACGTACGTAC")


def test_thinning_is_stable_and_right_on_average(spark):
    rows = [(f"b{k % 5}", f"g{k % 7}", f"u{k}", 8) for k in range(600)]
    m = spark.createDataFrame(rows, "barcode string, gene string, umi string, cnt long")
    a = saturation.thin(m, [0.5], 2, seed=4)
    b = saturation.thin(m.repartition(7), [0.5], 2, seed=4)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    total = a.groupBy("replicate").agg(F.sum("cnt").alias("n")).collect()
    assert all(abs(r["n"] - 2400) < 5 * math.sqrt(1200) for r in total)
    agg = saturation.aggregate_replicates(saturation.thinned_metrics(m, m.select("barcode").distinct(), [0.5, 1.0], 1)).collect()
    assert {r["read_fraction"]: r["reads_sd"] for r in agg} == {0.5: 0.0, 1.0: 0.0}


def test_empty_drops_finds_what_differs(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet(np.ones(60) * 0.5)
    rows = []
    for k in range(160):
        n = 2000 if k < 4 else 300 if k < 8 else int(rng.integers(40, 120))
        genes = rng.choice(60, n, p=p if k >= 8 or k < 4 else np.roll(p, 23))
        rows += [(f"b{k:03d}", f"g{g}", f"u{i}", 1) for i, g in enumerate(genes)]
    m = spark.createDataFrame(pd.DataFrame(rows, columns=["barcode", "gene", "umi", "cnt"]))
    got = cells.empty_drops(m, recovered=100, ambient=(20, 160), least=30, candidates=20, sims=500).collect()
    assert {r["barcode"] for r in got if r["cell"] == "magnitude"} >= {f"b{k:03d}" for k in range(8)} or {r["barcode"] for r in got} >= {f"b{k:03d}" for k in range(8)}
    assert all(r["p"] is None or 0 < r["p"] <= 1 for r in got)


def test_rank_sum_equals_dense(spark):
    rng = np.random.default_rng(2)
    x = np.where(rng.random((30, 4)) < 0.4, 0, rng.integers(1, 5, (30, 4)))
    lab = rng.integers(0, 2, 30)
    long = [(int(c), int(g), float(x[c, g])) for c in range(30) for g in range(4) if x[c, g]]
    got = expression.rank_sums(spark.createDataFrame(long, "cell int, gene int, expr double"), spark.createDataFrame([(i, int(k)) for i, k in enumerate(lab)], "cell int, cluster int"), spark.createDataFrame([(g,) for g in range(4)], "gene int")).collect()
    for r in got:
        ranks = pd.Series(x[:, r["gene"]]).rank()
        assert abs(ranks[lab == r["cluster"]].sum() - r["rank_sum"]) < 1e-3


def test_components_and_holes(spark):
    art = ["##..#", "#.#.#", "####.", ".....", "#.#.."]
    mask = spark.createDataFrame([(r, c) for r, line in enumerate(art) for c, x in enumerate(line) if x == "#"], "row int, col int")
    sizes = sorted(r["n"] for r in raster.components(mask).groupBy("component").agg(F.count("*").alias("n")).collect())
    assert sizes == [1, 1, 2, 8]
    filled = {tuple(r) for r in raster.fill_holes(mask, (5, 5)).collect()} - {tuple(r) for r in mask.collect()}
    assert filled == {(1, 1)}
    assert raster.large_components(raster.components(mask), 8).count() == 8


def test_spaced_cells_and_knn(spark):
    c = spark.createDataFrame([(1, 9, 0.0, 0.0), (2, 8, 1.0, 0.0), (3, 7, 10.0, 0.0)], "cell_id int, umi int, x double, y double")
    assert spatial.greedy_spaced(c, 5, 2.0) == [1, 3]
    v = spark.createDataFrame([(i, [float(i * i), 0.0]) for i in range(6)], "id long, v array<double>")
    got = {(r["id"], r["rank"]): r["other"] for r in expression.nearest(v, 2, 3).collect()}
    for i in range(6):
        want = sorted((abs(i * i - j * j), j) for j in range(6) if j != i)[:2]
        assert [got[i, 1], got[i, 2]] == [j for _, j in want]


def test_matrix_round_trip(spark, tmp_path):
    t = spark.createDataFrame([(1, 1, 5), (2, 2, 3), (2, 1, 4)], "feature_idx int, barcode_idx int, value long")
    f = spark.createDataFrame([(1, "G1", "n1"), (2, "G2", None)], "feature_idx int, gene string, name string")
    b = spark.createDataFrame([(1, "AA"), (2, "CC")], "barcode_idx int, barcode string")
    tables.write_matrix(t, f, b, str(tmp_path))
    got = sorted(map(tuple, tables.read_matrix(spark, str(tmp_path)).collect()))
    assert got == [("G1", "n1", "AA", 5), ("G2", "G2", "AA", 4), ("G2", "G2", "CC", 3)]  # an entry that spells the dimensions survives


def test_fastq(spark, tmp_path):
    (tmp_path / "S_S1_L001_R1_001.fastq.gz").write_bytes(gzip.compress(b"@r1 x\nACGT\n+\n@@@@\n@r2/1\nAC\n+\nII\n"))
    rows = fastq.read_fastq(spark, f"{tmp_path}/*.gz").orderBy("read_no").collect()
    assert [(r["name"], r["seq"], r["qual"]) for r in rows] == [("r1 x", "ACGT", "@@@@"), ("r2/1", "AC", "II")]
    with pytest.raises(ValueError):
        list(fastq.records(b"@a\nAC\n+\n"))
    a = spark.createDataFrame([("r1 1", "A", "I"), ("r3/1", "C", "I")], "name string, seq string, qual string")
    b = spark.createDataFrame([("r1 2", "G", "I")], "name string, seq string, qual string")
    assert {r["key"]: (r["seq1"], r["seq2"]) for r in fastq.pair_reads(a, b).collect()} == {"r1": ("A", "G"), "r3": ("C", None)}
    got = fastq.synthetic_reads(spark, "demo", 3, 200).orderBy("read_id").collect()
    assert [r["seq"] for r in got] == [fastq.synthetic_sequence("demo", k, 1, 200) for k in range(3)]


def test_small_tables(spark):
    w = spark.createDataFrame([(1, "x,y,barcode"), (2, "1, 2 ,acgt"), (3, "5,6,ACGT"), (4, "7,8,"), (5, "9,9,TTTT")], "line_no int, value string")
    assert sorted(map(tuple, tables.read_whitelist(w).collect())) == [("ACGT", 1, 2), ("TTTT", 9, 9)]
    p = spark.createDataFrame([("barcode,in_tissue,r,c,y,x",), ("AA,1,0,0,5,6",), ("CC,0,0,0,z,6",), ("1,2,GG",)], "value string")
    assert sorted(map(tuple, tables.read_positions(p).collect()), key=str) == [("AA", 6.0, 5.0), ("CC", 6.0, None), ("GG", 1.0, 2.0)]
    assert tables.read_positions(p, in_tissue_only=True).count() == 2
    assert tables.parse_box("1, 2\t3 4") == (1, 2, 3, 4) and tables.count_columns("Barcode\tgeneID\tUMI\tcount")[1] and not tables.count_columns("AA\tG1\tCC\t3")[1]
    jobs_csv = "﻿workflow,chip-number,casno,chemistry,species,method,mode,enabled\nST,1,c,BBV2.4,hs,HE,auto,yes\n,,,,,,,\nST,2,c,BBV2.4,hs,HE,auto,no\n"
    assert [r["chip_number"] for r in tables.read_jobs(jobs_csv)] == ["1"]
    with pytest.raises(ValueError):
        tables.read_jobs("workflow\nST\n")
    assert tables.load_config("A=1\nexport B=${A}2 \n# C=3") == {"A": "1", "B": "12"} and tables.merge_configs({"a": {"x": 1}}, {"a": {"y": 2}}) == {"a": {"x": 1, "y": 2}}
    log = spark.createDataFrame([(1, "== Mapping =="), (2, "Reads: 1,234 (56.7%)"), (3, "Rate | 4.5%"), (4, "noise")], "line_no int, value string")
    assert sorted(map(tuple, tables.log_metrics(log).collect()), key=str) == [("Mapping", "Rate", 4.5, None), ("Mapping", "Reads", 1234.0, 56.7)]


def test_plans(spark):
    steps = jobs.plan({"workflow": "ST", "method": "HE"})
    assert [s.name for s in jobs.select_steps(steps, "count", "analysis", ["count", "analysis"])] == ["count", "analysis"]
    with pytest.raises(KeyError):
        jobs.select_steps(steps, "nothing")
    entries = lambda *e: spark.createDataFrame(list(enumerate(e)), "position int, entry string")
    old = entries("a", "b")
    assert [jobs.manifest_status(p, c) for p, c in ((None, old), (old, old), (old, entries("b", "a")), (old, entries("a", "b", "c")), (old, entries("a", "c")))] == ["new", "same", "reordered", "added", "changed"]
    boom = jobs.Step("b", lambda c: 1 / 0)
    assert [s for _, s in jobs.execute([jobs.Step("a"), boom, jobs.Step("c")], {}, lambda n, d: None)] == ["done", "failed: division by zero"]


def test_stream_equals_batch(spark, tmp_path):
    reads = spark.createDataFrame([(f"b{k % 3}", "g", f"u{k % 4}") for k in range(60)], "barcode string, gene string, umi string")
    for k, part in enumerate(reads.randomSplit([1.0, 1.0], 1)):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/p{k}")
    src = ingest.stream_tables(spark, f"{tmp_path}/in/*", reads.schema, 1)
    q = src.writeStream.foreachBatch(ingest.upsert_molecules(f"{tmp_path}/out")).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = sorted(map(tuple, reads.groupBy("barcode", "gene", "umi").count().collect()))
    assert sorted(map(tuple, ingest.read_molecules(spark, f"{tmp_path}/out").select("barcode", "gene", "umi", "cnt").collect())) == want


def test_empty_inputs(spark):
    m = spark.createDataFrame([], "barcode string, gene string, umi string, cnt long")
    s = molecules.barcode_summary(m)
    assert s.count() == 0 and molecules.merge_umis(m, 4).count() == 0 and molecules.resolve_genes(m).count() == 0
    assert cells.marked(s, cells.auto_threshold(s, 1000)).count() == 0 and cells.rank_curve(s).count() == 0
    curve = saturation.saturation_curve(m).collect()
    assert len(curve) == 11 and all(r["umi_saturation"] == 0 for r in curve)
    assert cells.segments(np.array([]), 3, 3) == []


def cuts_by_hand(counts, start, end, step, span):
    x, y = math.log(len(counts)), math.log(max(counts))
    out, total = [start], 0.0
    for i in range(start, end):
        before = max(start, i - 1)
        total += math.hypot((math.log(i) - math.log(before)) / x, (math.log(counts[i]) - math.log(counts[before])) / y)
        if total >= step and i > out[-1] + span:
            out.append(i + 1)
            total = 0.0
    return out if out[-1] == end else [*out, end]


def test_segments_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    for _ in range(60):
        counts = np.sort(rng.integers(1, 5000, int(rng.integers(30, 900))))[::-1]
        start, end = int(rng.integers(1, 20)), int(rng.integers(20, len(counts) + 1))
        for step, span in ((0.02, 20), (0.2, 3), (1e-9, 5)):
            assert cells.segments(counts, start, end, step, span) == cuts_by_hand(counts, start, end, step, span)
    with pytest.raises(ValueError):
        cells.segments(np.array([3, 2, 1]), 0, 3)


def test_knee_of_few_barcodes(spark):
    for n in (1, 9, 100):
        assert cells.knee(spark.createDataFrame([(f"b{k}", 1000 - k) for k in range(n)], "barcode string, umi long")).first()["knee"] == n // 10


def test_merging_follows_long_chains(spark):
    """With a ratio near one a chain has many hops, and all end at its top."""
    word = ["AAAA"]
    for at, base in [(a, b) for b in "CGT" for a in range(4)]:
        word.append(word[-1][:at] + base + word[-1][at + 1 :])
    rows = [("b", "g", w, int(100 * 1.2**k) + k) for k, w in enumerate(word)]
    got = molecules.merge_umis(spark.createDataFrame(rows, "barcode string, gene string, umi string, cnt long"), 4, ratio=0.9).collect()
    assert len(got) < len(rows) and sum(r["cnt"] for r in got) == sum(r[3] for r in rows)
    with pytest.raises(ValueError):
        molecules.merge_umis(spark.createDataFrame(rows, "barcode string, gene string, umi string, cnt long"), 4, ratio=1.0)


def test_long_shapes_are_one_component(spark):
    """A snake of 160 rows: more hops than any fixed number of plain rounds."""
    cells_ = [(r, c) for r in range(0, 160, 2) for c in range(20)] + [(r, 0 if r % 4 == 3 else 19) for r in range(1, 159, 2)]
    out = raster.components(spark.createDataFrame(cells_, "row int, col int"))
    assert out.select("component").distinct().count() == 1 and out.count() == len(cells_)


def test_numbers_are_dense_in_order(spark):
    rows = [(k * 7919 % 1009, "x" * (k % 3)) for k in range(500)]
    got = numbered(spark.createDataFrame(rows, "a int, b string").repartition(9), "n", "a").collect()
    assert [r["a"] for r in sorted(got, key=lambda r: r["n"])] == sorted(a for a, _ in rows) and sorted(r["n"] for r in got) == list(range(1, 501))
    assert numbered(spark.createDataFrame([], "a int"), "n", "a").count() == 0


def small_matrix(spark, genes, values, names=("x", "y", "z")):
    f = spark.createDataFrame([(k + 1, g, g) for k, g in enumerate(genes)], "feature_idx int, gene string, name string")
    b = spark.createDataFrame([(k + 1, n) for k, n in enumerate(names)], "barcode_idx int, barcode string")
    return matrix.Matrix(f, b, spark.createDataFrame(values, "feature_idx int, barcode_idx int, value long"))


def test_matrix_algebra(spark):
    a, b = small_matrix(spark, ["g1", "g2"], [(1, 1, 5), (2, 3, 7)]), small_matrix(spark, ["g3"], [(1, 2, 9)])
    both = matrix.concat_features(a, b)
    assert sorted(map(tuple, both.values.collect())) == [(1, 1, 5), (2, 3, 7), (3, 2, 9)] and both.features.count() == 3
    for other in (small_matrix(spark, ["g2"], [(1, 1, 1)]), small_matrix(spark, ["g9"], [(1, 1, 1)], ("x", "z", "y")), small_matrix(spark, ["g9"], [(1, 1, 1)], ("x", "y"))):
        with pytest.raises(ValueError):
            matrix.concat_features(a, other)
    cut = matrix.slice_barcodes(a, spark.createDataFrame([(0, 3), (1, 1), (2, 3)], "position int, barcode_idx int"))
    assert sorted(map(tuple, cut.values.collect())) == [(1, 2, 5), (2, 1, 7), (2, 3, 7)] and [r["barcode"] for r in cut.barcodes.orderBy("barcode_idx").collect()] == ["z", "x", "z"]
    with pytest.raises(IndexError):
        matrix.slice_barcodes(a, spark.createDataFrame([(0, 4)], "position int, barcode_idx int"))
    mask = spark.createDataFrame([(1, 1)], "row int, col int")
    at = [("x", 1.0, 1.0), ("y", 2.5, 2.5), ("z", 9.0, 9.0), ("w", 0.0, 0.0)]
    out, places, summary = matrix.filter_by_mask(a, spark.createDataFrame(at, "barcode string, x double, y double"), mask, 1)
    assert sorted(map(tuple, out.values.collect())) == [(2, 1, 7)] and [r["barcode"] for r in places.collect()] == ["z"]
    assert tuple(summary.first()) == (3, 1, 2, 2 / 3)
    with pytest.raises(ValueError, match="1 barcodes"):
        matrix.filter_by_mask(a, spark.createDataFrame(at[:2], "barcode string, x double, y double"), mask)


def test_matrix_files_are_single_files(spark, tmp_path):
    m = small_matrix(spark, ["g1", "g2"], [(1, 1, 5), (2, 3, 7), (1, 2, 3)])
    tables.write_matrix(m.values, m.features, m.barcodes, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir() if p.is_file() and not p.name.startswith(".")} == {"matrix.mtx.gz", "features.tsv.gz", "barcodes.tsv.gz"}
    with gzip.open(tmp_path / "matrix.mtx.gz", "rt") as f:
        assert f.read().split("\n") == ["%%MatrixMarket matrix coordinate integer general", "2 3 3", "1 1 5", "1 2 3", "2 3 7", ""]
    assert sorted(map(tuple, tables.read_matrix(spark, str(tmp_path)).collect())) == [("g1", "g1", "x", 5), ("g1", "g1", "y", 3), ("g2", "g2", "z", 7)]


def test_inputs_by_layout(spark, tmp_path):
    def put(*names, data=b"x"):
        for n in names:
            (tmp_path / n).write_bytes(data)

    with pytest.raises(fastq.FastqError):
        fastq.detect_inputs(spark, str(tmp_path), "s")
    put("s_1.fq.gz", "s_2.fq.gz")
    names = lambda found: (found[0], *([p.rsplit("/", 1)[1] for p in side] for side in found[1:]))
    assert names(fastq.detect_inputs(spark, str(tmp_path), "s")) == ("simple", ["s_1.fq.gz"], ["s_2.fq.gz"])
    put("s_fold2_1.fq.gz", "s_fold2_2.fq.gz", "s_fold3_1.fq.gz")
    assert names(fastq.detect_inputs(spark, str(tmp_path), "s")) == ("fold", ["s_fold2_1.fq.gz"], ["s_fold2_2.fq.gz"])
    put("s_S1_L002_R1_001.fastq.gz", "s_S1_L001_R1_001.fq.gz", "s_S1_L001_R2_001.fq.gz")
    with pytest.raises(fastq.FastqError, match="2 first and 1 second"):
        fastq.detect_inputs(spark, str(tmp_path), "s")
    put("s_S1_L002_R2_001.fastq.gz", data=b"")
    with pytest.raises(fastq.FastqError, match="empty"):
        fastq.detect_inputs(spark, str(tmp_path), "s")
    assert fastq.detect_inputs(spark, str(tmp_path), "s", validate=False)[0] == "multi_lane"
    with pytest.raises(fastq.FastqError, match="no folder"):
        fastq.detect_inputs(spark, str(tmp_path / "none"), "s")
    one, two = fastq.order_mates(spark, f"{tmp_path}/s_S1_L*_R1_*.gz", f" {tmp_path}/s_S1_L002_R2_001.fastq.gz,{tmp_path}/s_S1_L001_R2_001.fq.gz")
    assert [p[-20:-16] for p in one] and ["L001" in p for p in one] == [True, False] and ["L001" in p for p in two] == [True, False]
    assert fastq.expand_paths(spark, f"{tmp_path}/none*") == [f"{tmp_path}/none*"]


def test_sample_names_end_at_the_first_layout_part(spark):
    r = fastq.parse_names(spark.createDataFrame([("a_S1_L001_b_S2_L002_R1_001.fastq.gz",)], "file string")).first()
    assert r["sample"] in ("a", "a_S1_L001_b") and r["read"] == 1


def test_fastq_pieces(spark, tmp_path):
    text = "".join(f"@r{k} x\nACGT\n+\nIIII\n" for k in range(25))
    (tmp_path / "a.fastq.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "b.fastq").write_text(text + "\n\n")
    rows = fastq.read_fastq(spark, f"{tmp_path}/*", rows=4).collect()
    assert len(rows) == 50 and sorted(r["read_no"] for r in rows if r["file"].endswith("gz")) == list(range(25))
    for bad in ("@r\nACGT\n+\n", "@r\nACGT\n+\nIII\n", "r\nACGT\n+\nIIII\n"):
        with pytest.raises(ValueError):
            list(fastq.records(bad.encode()))
    assert list(fastq.records(b"")) == []
    fastq.write_fastq(spark.createDataFrame([("r1", "AC", "II")], "name string, seq string, qual string"), f"{tmp_path}/out")
    assert [tuple(r)[2:] for r in fastq.read_fastq(spark, f"{tmp_path}/out/part-*").collect()] == [("r1", "AC", "II")]


def test_gtf_lines_that_fail(spark):
    good = "c\ts\texon\t1\t9\t.\t+\t.\tgene_id \"g\";"
    def lines(*texts):
        return spark.createDataFrame(list(enumerate(texts, 1)), "line int, value string")

    assert annotation.read_gtf(lines("# head", "", good)).count() == 1
    for bad, why in ((good + "\tx", "nine"), (good.replace("+", "?"), "strand"), (good.replace("gene_id", "id"), "gene_id")):
        with pytest.raises(Exception, match=why):
            annotation.read_gtf(lines(good, bad)).collect()
    assert annotation.read_gff3(lines("# x", good)).first()["attrs"] == 'gene_id "g";'
    with pytest.raises(Exception, match="nine"):
        annotation.read_gff3(lines("a\tb")).collect()
    row = annotation.read_gtf(lines(good))
    assert row.select(annotation.gtf_text(row)).first()[0] == good


def test_manifests_commit_in_two_phases(spark, tmp_path):
    def files(*names):
        return spark.createDataFrame(list(enumerate(names)), "position int, entry string")

    store = jobs.ManifestStore(spark, str(tmp_path))
    assert not store.commit() and store.propose(files("a", "b")) == "new" and store.propose(files("a", "c")) == "new"
    assert store.commit() and not store.commit()
    assert [store.propose(files(*n)) for n in (("a", "c"), ("c", "a"), ("a", "c", "d"), ("a", "x"))] == ["same", "reordered", "added", "changed"]
    assert store.commit() and store.propose(files("a", "x")) == "same"


def test_connectivities_and_communities(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.3, (25, 2)) for c in (0, 5, 10)])
    near = expression.nearest(spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "id long, v array<double>"), 6, 20)
    rows = near.collect()
    for k in range(75):
        want = sorted((round(float(np.linalg.norm(points[k] - points[j])), 6), j) for j in range(75) if j != k)[:6]
        got = [(r["distance"], r["other"]) for r in sorted((r for r in rows if r["id"] == k), key=lambda r: r["rank"])]
        assert [j for _, j in got] == [j for _, j in want] and [d for d, _ in got] == pytest.approx([d for d, _ in want], abs=2e-6)
    graph = expression.connectivities(near)
    weights = graph.collect()
    assert all(0 < r["weight"] <= 1 and r["id"] < r["other"] for r in weights) and {x for r in weights for x in (r["id"], r["other"])} == set(range(75))
    labels = expression.merge_communities(graph)
    found = {r["id"]: r["label"] for r in labels.collect()}
    assert len(found) == 75 and all(found[k] != found[j] for k in range(25) for j in range(25, 75))
    alone = graph.select("id").union(graph.select("other")).distinct().withColumn("label", F.col("id"))
    by_cluster = alone.withColumn("label", F.floor(F.col("id") / 25))
    q = [expression.modularity(graph, x).first()[0] for x in (labels, alone, by_cluster)]
    assert q[0] > q[1] and q[0] >= 0.85 * q[2]


def test_empty_drops_is_registered_whole(monkeypatch):
    import inspect

    from tessera import queries

    taken = {}
    whole = inspect.signature(cells.empty_drops)

    class Table:
        def select(self, *columns):
            return self

    def record(*args, **kwargs):
        call = whole.bind(*args, **kwargs)
        call.apply_defaults()
        taken.update(call.arguments)
        return Table()

    monkeypatch.setattr(cells, "empty_drops", record)
    monkeypatch.setattr(queries, "mol", lambda *a: None)
    monkeypatch.setattr(queries.F, "round", lambda *a: queries.F)
    monkeypatch.setattr(queries.F, "alias", lambda *a: None, raising=False)
    queries.QUERIES["emptydrops_calls"](None, "")
    assert taken["candidates"] == 20_000 and taken["sims"] == 10_000


def test_thresholds_of_a_histogram(spark):
    def table(rows):
        return spark.createDataFrame(rows, "level int, n long")

    two = [(10 + k, 50 - 8 * abs(k - 2)) for k in range(5)] + [(60 + k, 20 - 3 * abs(k - 2)) for k in range(5)]
    for f in (raster.otsu, raster.yen, raster.isodata):
        assert 10 <= f(table(two)).first()["threshold"] < 60
    assert 14 < raster.cross_entropy(table(two)) < 60
    tail = [(k, 1000 - 150 * k) for k in range(6)] + [(k, 10) for k in range(6, 100)]
    assert 5 <= raster.triangle(table(tail)) <= 8
    assert raster.triangle(table([(99 - k, n) for k, n in tail])) == 99 - raster.triangle(table(tail))
    # cross-entropy is least at the fixed point, up to one level
    x = np.repeat(*np.array(two).T)

    def entropy(t):
        low, high = x[x <= t] - 10, x[x > t] - 10
        return -sum(v.sum() * math.log(v.mean()) for v in (low, high) if len(v) and v.mean() > 0)

    t = raster.cross_entropy(table(two))
    assert entropy(t) <= min(entropy(v) for v in range(11, 63)) + 1e-6
    for f in (raster.cross_entropy, raster.triangle):
        assert f(table([])) is None
    assert raster.yen(table([])).first()["threshold"] is None and raster.isodata(table([(5, 9)])).first()["threshold"] is None
