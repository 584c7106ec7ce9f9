"""Expression matrices in long form (cell, gene, value > 0): quality, normalisation, clusters, markers."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut
from .cells import adjust_bh


def gene_flags(name: Column) -> tuple[Column, Column, Column]:
    """Mitochondrial, ribosomal and haemoglobin genes, by name in either case."""
    up = F.upper(name)
    return up.startswith("MT-"), up.rlike("^RP[SL]"), up.rlike("^HB[^(P)]")


def qc_metrics(values: DataFrame, flags: DataFrame) -> DataFrame:
    """Per cell: genes, counts, and percent of counts in flagged genes(gene, mt)."""
    v = values.filter("value > 0").join(flags, "gene", "left")
    return v.groupBy("cell").agg(F.count("*").alias("genes"), F.sum("value").alias("counts"), F.round(F.sum(F.when(F.col("mt"), F.col("value")).otherwise(0)) / F.sum("value") * 100, 6).alias("pct_mt"))


def qc_filters(min_genes: int = 0, min_counts: int = 0, max_genes: int = 0, max_counts: int = 0, max_mt: float = 100) -> dict[str, str]:
    """Failing conditions by name; a threshold of 0 (100 for max_mt) is off."""
    every = {"min_genes": (min_genes, f"genes < {min_genes}"), "min_counts": (min_counts, f"counts < {min_counts}"), "max_genes": (max_genes, f"genes > {max_genes}"), "max_counts": (max_counts, f"counts > {max_counts}"), "max_mt": (max_mt < 100, f"pct_mt > {max_mt}")}
    return {k: cond for k, (on, cond) in every.items() if on}


def qc_report(metrics: DataFrame, filters: dict[str, str]) -> DataFrame:
    """One row: cells, how many fail each filter by itself, and how many pass all."""
    ok = F.expr(" and ".join(f"not ({c})" for c in filters.values()) or "true")
    return metrics.agg(F.count("*").alias("cells"), *[F.count_if(F.expr(c)).alias(f"fails_{k}") for k, c in filters.items()], F.count_if(ok).alias("kept"))


def mito_shares(metrics: DataFrame, limits: tuple[int, ...] = (5, 10, 15, 20, 50)) -> DataFrame:
    """Share of cells above each mitochondrial percentage."""
    each = metrics.withColumn("limit_pct", F.explode(F.array(*[F.lit(x) for x in limits])))
    return each.groupBy("limit_pct").agg(F.round(F.count_if(F.col("pct_mt") > F.col("limit_pct")) / F.count("*"), 6).alias("share"))


def normalise(values: DataFrame, target: float = 1e4) -> DataFrame:
    """log1p of counts scaled to the same total per cell."""
    total = values.groupBy("cell").agg(F.sum("value").alias("total"))
    return values.filter("value > 0").join(total, "cell").withColumn("expr", F.log1p(F.col("value") / F.col("total") * target)).drop("total")


def dispersion(normal: DataFrame, cells: int, bins: int = 20) -> DataFrame:
    """Per gene: mean and dispersion of expm1(expr) over all cells, zeros included, and the dispersion scaled within bins of the mean.

    A bin of one gene takes its own dispersion as deviation, so the gene gets 1.
    """
    x = F.expm1("expr")
    g = normal.groupBy("gene").agg(F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    mean = F.col("s") / cells
    var = (F.col("q") - F.col("s") * F.col("s") / cells) / (cells - 1)
    d = g.select("gene", mean.alias("m"), F.log(F.when(var > 0, var / mean)).alias("dispersion"), F.log1p(mean).alias("mean"))
    t = Window.partitionBy(F.lit(1))
    lo, hi = F.min("mean").over(t), F.max("mean").over(t)
    binned = d.withColumn("bin", F.least(F.lit(bins - 1), F.floor(F.try_divide(F.round(F.col("mean") - lo, 9) * bins, F.round(hi - lo, 9)))).cast("int"))
    w = Window.partitionBy("bin")
    n, mu, sd = F.count("dispersion").over(w), F.avg("dispersion").over(w), F.stddev_samp("dispersion").over(w)
    score = F.when(n == 1, F.lit(1.0)).otherwise(F.try_divide(F.col("dispersion") - mu, sd))
    return binned.select("gene", F.round("mean", 6).alias("mean"), F.round("dispersion", 6).alias("dispersion"), "bin", F.round(score, 6).alias("scaled"))


def variable_genes(scored: DataFrame, low: float = 0.0125, high: float = 3.0, least: float = 0.5, top: int | None = None) -> DataFrame:
    """Genes by mean and scaled dispersion, or the ``top`` by scaled dispersion."""
    if top:
        return scored.orderBy(F.desc_nulls_last("scaled"), "gene").limit(top)
    return scored.filter((F.col("mean") > low) & (F.col("mean") < high) & (F.col("scaled") > least))


def scale(normal: DataFrame, cells: int, clip: float = 10.0) -> DataFrame:
    """z-scores per gene (zeros counted in mean and deviation), clipped; rows only where a value stands."""
    g = normal.groupBy("gene").agg(F.sum("expr").alias("s"), F.sum(F.col("expr") * F.col("expr")).alias("q"))
    stats = g.select("gene", (F.col("s") / cells).alias("mu"), F.sqrt((F.col("q") - F.col("s") * F.col("s") / cells) / (cells - 1)).alias("sd"))
    z = F.try_divide(F.col("expr") - F.col("mu"), F.col("sd"))
    return normal.join(stats, "gene").select("cell", "gene", F.round(F.greatest(F.lit(-clip), F.least(F.lit(clip), z)), 6).alias("z"))


def top_expressed(values: DataFrame, cells: int, n: int = 20) -> DataFrame:
    """The genes with the highest mean share of a cell's counts."""
    total = values.groupBy("cell").agg(F.sum("value").alias("total")).filter("total > 0")
    shares = values.join(total, "cell").groupBy("gene").agg(F.round(F.sum(F.col("value") / F.col("total")) / cells * 100, 6).alias("pct"))
    return shares.orderBy(F.desc("pct"), "gene").limit(n)


def rank_sums(normal: DataFrame, clusters: DataFrame, genes: DataFrame) -> DataFrame:
    """One-against-rest Wilcoxon per cluster and gene: rank sum, z without tie correction, shares and log fold change.

    Only values above zero are ranked; the zeros form one tied block whose average
    rank is known in closed form, so nothing is densified.
    """
    n = clusters.agg(F.count("*").alias("n_all"))
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("n1"))
    v = normal.join(clusters, "cell")
    w = Window.partitionBy("gene")
    r = v.withColumn("nnz", F.count("*").over(w)).withColumn("r", F.rank().over(w.orderBy("expr")) + (F.count("*").over(Window.partitionBy("gene", "expr")) - 1) / 2)
    per = r.groupBy("gene", "cluster").agg(F.sum("r").alias("rs"), F.count("*").alias("k"), F.first("nnz").alias("nnz"), F.sum(F.expm1("expr")).alias("x"))
    whole = v.groupBy("gene").agg(F.sum(F.expm1("expr")).alias("x_all"), F.count("*").alias("all_nnz"))
    grid = genes.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(n)).join(whole, "gene", "left").join(per, ["gene", "cluster"], "left").fillna(0, ["rs", "k", "x", "x_all", "all_nnz"])
    zeros = F.col("n_all") - F.col("all_nnz")
    total = F.col("rs") + F.col("k") * zeros + (F.col("n1") - F.col("k")) * (zeros + 1) / 2
    n2 = F.col("n_all") - F.col("n1")
    z = (total - F.col("n1") * (F.col("n_all") + 1) / 2) / F.sqrt(F.col("n1") * n2 * (F.col("n_all") + 1) / 12)
    inside, outside = F.col("x") / F.col("n1"), (F.col("x_all") - F.col("x")) / n2
    return grid.select(
        "cluster", "gene", F.round(total, 3).alias("rank_sum"), F.round(z, 6).alias("z"), F.round(F.col("k") / F.col("n1"), 6).alias("pct_1"), F.round((F.col("all_nnz") - F.col("k")) / n2, 6).alias("pct_2"),
        F.round(F.log2((inside + 1e-9) / (outside + 1e-9)), 6).alias("avg_log2fc"),
    )


def marker_table(ranked: DataFrame) -> DataFrame:
    """Rank sums with two-sided p (Arrow UDF for the normal tail) and q per cluster."""
    tail = F.pandas_udf(lambda s: s.map(lambda v: math.erfc(abs(v) / math.sqrt(2)) if v == v else 1.0), "double")
    return adjust_bh(ranked.withColumn("p", tail(F.col("z"))), "p", ["cluster"])


def top_markers(markers: DataFrame, n: int = 10, least_fold: float = 0.25, by: str = "q") -> DataFrame:
    """The best n genes of each cluster above a fold change."""
    w = Window.partitionBy("cluster").orderBy(F.asc(by), F.desc("avg_log2fc"), "gene")
    return markers.filter(F.col("avg_log2fc") > least_fold).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def marker_frame(raw: DataFrame) -> DataFrame:
    """Marker rows under common names: null fold changes and clusters that are no numbers dropped, q below 0.05."""
    names = {"group": "cluster", "names": "gene", "logfoldchanges": "avg_log2fc", "pvals": "p_val", "pvals_adj": "p_val_adj"}
    df = raw.withColumnsRenamed({k: v for k, v in names.items() if k in raw.columns})
    for c in ("p_val", "p_val_adj", "avg_log2fc"):
        df = df if c in df.columns else df.withColumn(c, F.lit(None).cast("double"))
    return df.withColumn("cluster", F.col("cluster").try_cast("int")).filter("cluster is not null and avg_log2fc is not null and p_val_adj < 0.05")


def nearest(vectors: DataFrame, k: int = 15, group_rows: int = 8192) -> DataFrame:
    """Exact k nearest neighbours of every vector, euclidean, ties by id: (id, other, rank, distance).

    Vectors are dealt to groups of about group_rows by a hash of the id; each task
    gets two groups and keeps the best k of the second for each of the first, and
    the tasks' bests are ranked.  Nothing passes through the driver.
    """
    groups = max(1, -(-vectors.count() // group_rows))
    base = vectors.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(groups)).alias("_g"))
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_o")
    asked = base.select("id", "v", "_g", each).select("id", "v", (F.col("_g") * groups + F.col("_o")).alias("cell"), F.lit(True).alias("asks"))
    given = base.select("id", "v", "_g", each).select("id", "v", (F.col("_o") * groups + F.col("_g")).alias("cell"), F.lit(False).alias("asks"))

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        ask, give = frame[frame["asks"]], frame[~frame["asks"]]
        parts = []
        if len(ask) and len(give):
            other, x = give["id"].to_numpy(), np.stack(give["v"].to_numpy()).astype(np.float64)
            square = (x**2).sum(1)
            for at in range(0, len(ask), 512):
                ids, m = ask["id"].to_numpy()[at : at + 512], np.stack(ask["v"].to_numpy()[at : at + 512]).astype(np.float64)
                d = np.round(np.sqrt(np.maximum((m**2).sum(1)[:, None] + square[None, :] - 2 * m @ x.T, 0)), 6)
                d[ids[:, None] == other[None, :]] = np.inf
                take = np.argsort(d, axis=1, kind="stable")[:, :k]
                dist = np.take_along_axis(d, take, 1)
                rows = pd.DataFrame({"id": np.repeat(ids, take.shape[1]), "other": other[take].reshape(-1), "distance": dist.reshape(-1)})
                parts.append(rows[np.isfinite(rows["distance"])])
        return pd.concat(parts) if parts else pd.DataFrame({"id": np.zeros(0, np.int64), "other": np.zeros(0, np.int64), "distance": np.zeros(0)})

    found = asked.unionByName(given).groupBy("cell").applyInPandas(best, "id long, other long, distance double")
    w = Window.partitionBy("id").orderBy("distance", "other")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("id", "other", "rank", "distance")


def connectivities(neighbours: DataFrame, rounds: int = 64, tolerance: float = 1e-5) -> DataFrame:
    """Symmetric weights of a graph of nearest neighbours(id, other, rank, distance): (id, other, weight), either direction once.

    Each vector's distances beyond its nearest positive one decay at the rate at
    which its weights sum to log2 of the number of its neighbours, counting itself; the
    two directions join as a + b - ab.  The rate is found by bisection over the
    array of a vector's distances, which k bounds.
    """
    @F.pandas_udf("array<double>")
    def weigh(column: pd.Series) -> pd.Series:
        def one(values) -> np.ndarray:
            d = np.asarray(values, float)
            positive = d[d > 0]
            rho = positive.min() if len(positive) else 0.0
            beyond, target = np.maximum(d - rho, 0.0), np.log2(len(d) + 1)
            low, high, sigma = 0.0, np.inf, 1.0
            for _ in range(rounds):
                total = np.exp(-beyond / sigma).sum()
                if abs(total - target) < tolerance:
                    break
                if total > target:
                    high = sigma
                    sigma = (low + high) / 2
                else:
                    low = sigma
                    sigma = sigma * 2 if np.isinf(high) else (low + high) / 2
            return np.exp(-beyond / max(sigma, 1e-3 * (d.mean() if len(d) else 0.0), 1e-12))

        return column.map(one)

    lists = neighbours.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "other", "distance"))).alias("n"))
    directed = lists.select("id", F.explode(F.arrays_zip(F.col("n")["other"].alias("other"), weigh(F.col("n")["distance"]).alias("w"))).alias("e")).select("id", F.col("e.other").alias("other"), F.col("e.w").alias("w"))
    pairs = directed.groupBy(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).agg(F.max("w").alias("a"), F.when(F.count("*") > 1, F.min("w")).otherwise(0.0).alias("b"))
    return pairs.select("id", "other", F.round(F.col("a") + F.col("b") - F.col("a") * F.col("b"), 9).alias("weight"))


def merge_communities(edges: DataFrame, levels: int = 10, rounds: int = 8) -> DataFrame:
    """Communities of an undirected graph(id, other, weight) by greedy modularity: (id, label).

    Each round every node, half of them at a time by a hash, moves to the
    neighbouring community with the largest gain in modularity (the lower label
    on ties) if that is positive; when moves end or no longer help, communities become
    nodes and the next level starts.  It stops at the level that gains nothing.
    """
    graph = cut(edges.groupBy(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).agg(F.sum("weight").alias("weight")))
    names = cut(graph.select("id").unionByName(graph.select(F.col("other").alias("id"))).distinct().withColumn("label", F.col("id")))
    m = graph.agg(F.sum("weight")).first()[0]
    if not m:
        return names
    best = None
    for _ in range(levels):
        both = cut(graph.unionByName(graph.filter("id <> other").select(F.col("other").alias("id"), F.col("id").alias("other"), "weight")))
        degree = cut(both.groupBy("id").agg(F.sum(F.when(F.col("id") == F.col("other"), 2 * F.col("weight")).otherwise(F.col("weight"))).alias("k")))
        place = cut(degree.select("id", F.col("id").alias("c")))
        quality = modularity(graph, place.withColumnRenamed("c", "label")).first()[0]
        for r in range(rounds):
            total = place.join(degree, "id").groupBy("c").agg(F.sum("k").alias("t"))
            toward = both.filter("id <> other").join(place.withColumnRenamed("id", "other"), "other").groupBy("id", "c").agg(F.sum("weight").alias("w"))
            own = place.withColumnRenamed("c", "mine").join(degree, "id")
            # what a node gains by standing in c, itself taken out of its own community first
            options = toward.join(own, "id").unionByName(own.select("id", F.col("mine").alias("c"), F.lit(0.0).alias("w"), "mine", "k")).groupBy("id", "c", "mine", "k").agg(F.sum("w").alias("w")).join(total, "c")
            gain = F.round(F.col("w") - F.col("k") * (F.col("t") - F.when(F.col("c") == F.col("mine"), F.col("k")).otherwise(0.0)) / (2 * m), 9)
            pick = options.withColumn("gain", gain).groupBy("id", "mine").agg(F.min(F.struct(-F.col("gain"), F.col("c") != F.col("mine"), "c")).alias("p"))
            moved = cut(pick.select("id", F.when(F.pmod(F.xxhash64("id"), F.lit(2)) == r % 2, F.col("p.c")).otherwise(F.col("mine")).alias("c"), "mine"))
            after = modularity(graph, moved.select("id", F.col("c").alias("label"))).first()[0]
            if after <= quality + 1e-9 and r % 2:
                break
            if after > quality + 1e-9:
                place, quality = cut(moved.select("id", "c")), after
        if best is not None and quality <= best + 1e-9:
            break
        best = quality
        names = cut(names.join(place.withColumnRenamed("id", "label"), "label").select("id", F.col("c").alias("label")))
        a, b = place.withColumnRenamed("c", "ca"), place.withColumnRenamed("id", "other").withColumnRenamed("c", "cb")
        graph = cut(graph.join(a, "id").join(b, "other").groupBy(F.least("ca", "cb").alias("id"), F.greatest("ca", "cb").alias("other")).agg(F.sum("weight").alias("weight")))
    return names


def propagate_labels(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """Communities of a graph(id, other, weight) by label propagation: each node takes its neighbours' heaviest label, the lower on ties.

    This stands in for modularity clustering and is not equal to it.
    """
    both = cut(edges.select("id", "other", "weight").unionByName(edges.select(F.col("other").alias("id"), F.col("id").alias("other"), "weight")))
    labels = both.select("id").distinct().withColumn("label", F.col("id"))
    for _ in range(rounds):
        votes = both.join(labels.withColumnRenamed("id", "other"), "other").groupBy("id", "label").agg(F.sum("weight").alias("w"))
        labels = votes.groupBy("id").agg(F.min_by("label", F.struct(-F.col("w"), "label")).alias("label"))
    return labels


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: the modularity of labels on an undirected weighted graph."""
    a, b = labels.withColumnsRenamed({"label": "la"}), labels.withColumnsRenamed({"id": "other", "label": "lb"})
    e = edges.join(a, "id").join(b, "other")
    m = e.agg(F.sum("weight").alias("m"), F.sum(F.when(F.col("la") == F.col("lb"), F.col("weight")).otherwise(0)).alias("inside"))
    degree = e.select(F.col("la").alias("l"), "weight").unionByName(e.select(F.col("lb").alias("l"), "weight")).groupBy("l").agg(F.sum("weight").alias("d"))
    return m.crossJoin(degree.agg(F.sum(F.col("d") * F.col("d")).alias("dd"))).select((F.col("inside") / F.col("m") - F.col("dd") / (4 * F.col("m") * F.col("m"))).alias("modularity"))


def principal_components(wide: DataFrame, k: int) -> DataFrame:
    """PCA scores of (id, v array) by pyspark.ml; signs are arbitrary."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = wide.select("id", array_to_vector("v").alias("raw"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="raw", outputCol="x").fit(v).transform(v)
    return PCA(k=k, inputCol="x", outputCol="pc").fit(centred).transform(centred).select("id", vector_to_array("pc").alias("pc"))


def k_means(scores: DataFrame, k: int | None = None, seed: int = 0) -> DataFrame:
    """Clusters of (id, pc) by pyspark.ml; k defaults to one per thousand cells, within 2..10."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    k = k or min(10, max(2, scores.count() // 1000))
    v = scores.select("id", array_to_vector("pc").alias("features"))
    return KMeans(k=k, seed=seed).fit(v).transform(v).select("id", F.col("prediction").alias("cluster"))
