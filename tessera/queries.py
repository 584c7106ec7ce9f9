"""One query per operator over the fixture relations, and the same in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from .functions import numbers as N
from .functions import seq as S
from .operators import annotation, cells, demux, expression, matrix, molecules, raster, reports, saturation, spatial
from .plans import jobs
from .sources import fastq, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Molecules per barcode are few in the fixtures, so thresholds use these numbers of expected cells.
EXPECTED_CELLS, FORCED_CELLS = 1000, 40
BOX, SHAPE = (0, 0, 400, 300), (300, 400)

_WITH = {
    "cd": X.sql(X.MOLECULES), "pos": X.sql(X.POSITIONS), "reads": X.sql(X.READS), "ex": X.sql(X.EXPRESSION), "lab": X.sql(X.LABELS), "mask": X.sql(X.MASK), "ann": X.sql(X.ANNOTATION), "files": X.sql(X.FILES), "seen20": X.sql(X.LONG_SEEN), "entries20": X.sql(X.LONG_ENTRIES), "wide": X.sql(X.WIDE), "gtf": X.sql(X.GTF),
    "bs": "SELECT barcode, cast(sum(cnt) as bigint) AS readcount, cast(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) as bigint) AS umi2, count(*) AS umi, count(DISTINCT gene) AS genes FROM cd GROUP BY barcode",
    "auto": f"SELECT cast(greatest(1, floor(0.1 * (SELECT umi FROM bs ORDER BY umi DESC LIMIT 1 OFFSET (SELECT least(count(*), {EXPECTED_CELLS // 100}) - 1 FROM bs)))) as bigint) AS threshold",
    "loc": "SELECT cd.*, x, y FROM cd JOIN pos USING (barcode)",
}
_USES = {"bs": ["cd"], "auto": ["bs"], "loc": ["cd", "pos"]}


def _sql(text: str, *needs: str) -> str:
    """The text after the relations that it names, in order of use."""
    order: list[str] = []

    def add(n: str) -> None:
        for m in _USES.get(n, []):
            add(m)
        if n not in order:
            order.append(n)

    for n in needs:
        add(n)
    ctes = ", ".join(f"{n} AS ({_WITH[n]})" for n in order)
    body = text.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def query(name: str, sql: str | None = None, *needs: str):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = _sql(sql, *needs)
        return f

    return add


def mol(spark, d):
    return X.frame(spark, d, X.MOLECULES)


def located(spark, d):
    return spatial.with_positions(mol(spark, d), X.frame(spark, d, X.POSITIONS))


def summary(spark, d):
    return molecules.barcode_summary(mol(spark, d))


# Molecules and cells


@query("barcode_summary", "SELECT * FROM bs", "bs")
def barcode_summary(spark, d):
    return summary(spark, d)


@query("distinct_umi_summary", "SELECT barcode, count(DISTINCT umi) AS umis, cast(sum(cnt) as bigint) AS readcount FROM cd GROUP BY 1", "cd")
def distinct_umi_summary(spark, d):
    return molecules.distinct_umi_summary(mol(spark, d))


@query("cell_calling_auto", "SELECT bs.*, threshold, CASE WHEN umi >= threshold THEN 'CB' ELSE 'UB' END AS mark FROM bs, auto", "auto")
def cell_calling_auto(spark, d):
    s = summary(spark, d)
    return cells.marked(s, cells.auto_threshold(s, EXPECTED_CELLS))


@query(
    "cell_calling_force",
    f"WITH h AS (SELECT umi, count(*) AS n FROM bs GROUP BY 1), c AS (SELECT umi, sum(n) OVER (ORDER BY umi DESC) AS upto FROM h), t AS (SELECT umi AS threshold FROM c ORDER BY abs(upto - {FORCED_CELLS}), umi DESC LIMIT 1) SELECT bs.*, threshold, CASE WHEN umi >= threshold THEN 'CB' ELSE 'UB' END AS mark FROM bs, t",
    "bs",
)
def cell_calling_force(spark, d):
    s = summary(spark, d)
    return cells.marked(s, cells.forced_threshold(s, FORCED_CELLS))


@query(
    "cell_calling_magnitude",
    "WITH r AS (SELECT umi, row_number() OVER (ORDER BY umi DESC) AS k, count(*) OVER () AS n FROM bs), t AS (SELECT cast(greatest(1, round_even(0.1 * umi, 0)) as bigint) AS threshold FROM r WHERE k = greatest(1, least(10, n - 1))) SELECT bs.*, threshold, CASE WHEN umi >= threshold THEN 'CB' ELSE 'UB' END AS mark FROM bs, t",
    "bs",
)
def cell_calling_magnitude(spark, d):
    s = summary(spark, d)
    return cells.marked(s, cells.within_magnitude(s, EXPECTED_CELLS))


@query("top_barcodes", "SELECT * FROM bs WHERE umi > 0 ORDER BY umi DESC, barcode LIMIT 25", "bs")
def top_barcodes(spark, d):
    return cells.top_barcodes(summary(spark, d), 25)


@query(
    "cell_metrics",
    "WITH m AS (SELECT bs.*, umi >= threshold AS cb FROM bs, auto) SELECT count(*) FILTER (WHERE cb) AS cells, cast(sum(readcount) FILTER (WHERE cb) as bigint) AS reads_in_cells, cast(floor(median(umi) FILTER (WHERE cb)) as int) AS median_umi, cast(floor(median(genes) FILTER (WHERE cb)) as int) AS median_genes, cast(floor(avg(umi) FILTER (WHERE cb)) as int) AS mean_umi, cast(sum(umi) FILTER (WHERE cb) as bigint) AS umi_in_cells, (SELECT count(DISTINCT gene) FROM cd WHERE barcode IN (SELECT barcode FROM m WHERE cb)) AS total_genes, cast(sum(readcount) as bigint) AS reads, round_even((sum(readcount) FILTER (WHERE cb))::double / sum(readcount)::double * 100, 2) AS pct_reads_in_cells, cast(floor(sum(readcount) / count(*) FILTER (WHERE cb)) as bigint) AS mean_reads FROM m",
    "auto",
)
def cell_metrics(spark, d):
    m = mol(spark, d)
    s = molecules.barcode_summary(m)
    return cells.cell_metrics(m, cells.marked(s, cells.auto_threshold(s, EXPECTED_CELLS)))


@query(
    "umi_directional_merge",
    """WITH RECURSIVE near AS (SELECT a.barcode, a.gene, a.umi, b.umi AS v, b.cnt AS vcnt FROM cd a JOIN cd b ON a.barcode = b.barcode AND a.gene = b.gene AND a.cnt::double / b.cnt <= 0.1 AND hamming(a.umi, b.umi) = 1),
par AS (SELECT barcode, gene, umi, arg_max(v, (vcnt, v)) AS parent FROM near GROUP BY 1, 2, 3),
walk AS (SELECT barcode, gene, umi, cnt, umi AS root FROM cd UNION ALL SELECT w.barcode, w.gene, w.umi, w.cnt, p.parent FROM walk w JOIN par p ON w.barcode = p.barcode AND w.gene = p.gene AND w.root = p.umi),
ends AS (SELECT w.* FROM walk w ANTI JOIN par p ON w.barcode = p.barcode AND w.gene = p.gene AND w.root = p.umi)
SELECT barcode, gene, root AS umi, cast(sum(cnt) as bigint) AS cnt, count(*) FILTER (WHERE umi <> root) AS merged_umis, cast(coalesce(sum(cnt) FILTER (WHERE umi <> root), 0) as bigint) AS merged_reads FROM ends GROUP BY 1, 2, 3""",
    "cd",
)
def umi_directional_merge(spark, d):
    return molecules.merge_umis(mol(spark, d), 4)


@query("multigene_resolution", "WITH r AS (SELECT *, max(cnt) OVER w AS t FROM cd WINDOW w AS (PARTITION BY barcode, umi)), k AS (SELECT *, count(*) FILTER (WHERE cnt = t) OVER (PARTITION BY barcode, umi) AS n FROM r) SELECT barcode, gene, umi, cnt FROM k WHERE cnt = t AND n = 1", "cd")
def multigene_resolution(spark, d):
    return molecules.resolve_genes(mol(spark, d))


@query("bam_count_table", "SELECT barcode, gene, umi, count(*) AS cnt FROM cd, range(cnt) AS r(i) GROUP BY 1, 2, 3", "cd")
def bam_count_table(spark, d):
    a = mol(spark, d).select(F.concat_ws("_", "barcode", "umi", F.lit("1")).alias("query_name"), "gene", F.explode(F.sequence(F.lit(1), F.col("cnt"))).alias("i"))
    return molecules.count_molecules(a)


@query(
    "gene_barcode_matrix",
    "WITH b AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS barcode_idx FROM (SELECT DISTINCT barcode FROM cd)) SELECT cast(substr(gene, 2) as int) + 1 AS feature_idx, cast(barcode_idx as int) AS barcode_idx, count(*) AS value FROM cd JOIN b USING (barcode) GROUP BY 1, 2",
    "cd",
)
def gene_barcode_matrix(spark, d):
    features = spark.range(50).select(F.concat(F.lit("G"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("gene"), (F.col("id") + 1).cast("int").alias("feature_idx"))
    return molecules.gene_matrix(mol(spark, d), features)


@query("barcode_rank_curve", "WITH h AS (SELECT umi, count(*) AS n FROM bs GROUP BY 1) SELECT umi, cast(sum(n) OVER (ORDER BY umi DESC) - n + 1 as bigint) AS first_rank, cast(sum(n) OVER (ORDER BY umi DESC) as bigint) AS last_rank FROM h", "bs")
def barcode_rank_curve(spark, d):
    return cells.rank_curve(summary(spark, d))


@query(
    "knee_point",
    """WITH r AS (SELECT umi, row_number() OVER (ORDER BY umi DESC, barcode) AS k, count(*) OVER () AS n, log10(umi + 1.0::double) AS y FROM bs),
g AS (SELECT *, CASE WHEN lag(y) OVER w IS NULL THEN lead(y) OVER w - y WHEN lead(y) OVER w IS NULL THEN y - lag(y) OVER w ELSE (lead(y) OVER w - lag(y) OVER w) / 2 END AS g FROM r WINDOW w AS (ORDER BY k)),
h AS (SELECT *, round(CASE WHEN lag(g) OVER w IS NULL THEN lead(g) OVER w - g WHEN lead(g) OVER w IS NULL THEN g - lag(g) OVER w ELSE (lead(g) OVER w - lag(g) OVER w) / 2 END, 9) AS h FROM g WINDOW w AS (ORDER BY k))
SELECT cast(CASE WHEN (SELECT count(*) FROM bs) <= 100 THEN floor((SELECT count(*) FROM bs) * 0.1::double) ELSE greatest((SELECT k FROM h WHERE k <= n // 2 ORDER BY h, k LIMIT 1) - 1, 10) END as int) AS knee""",
    "bs",
)
def knee_point(spark, d):
    return cells.knee(summary(spark, d))


@query("emptydrops_calls")
def emptydrops_calls(spark, d):
    # the fixtures have about a hundred barcodes, so the ambient ranks and the least count are theirs; all else is the operator's default
    return cells.empty_drops(mol(spark, d), recovered=1000, ambient=(20, 100), least=20).select("barcode", "umi", "cell", F.round("p", 3).alias("p"), F.round("q", 3).alias("q"))


@query("bh_adjust", "WITH t AS (SELECT barcode, (row_number() OVER (ORDER BY umi, barcode))::double / (2.0::double * count(*) OVER ()) AS p FROM bs), r AS (SELECT *, count(*) OVER () AS n, count(*) OVER (ORDER BY p) AS k FROM t) SELECT barcode, round(p, 9) AS p, round(least(1.0, min(p * n / k) OVER (ORDER BY p DESC)), 9) AS q FROM r", "bs")
def bh_adjust(spark, d):
    from pyspark.sql import Window

    t = summary(spark, d).select("barcode", (F.row_number().over(Window.orderBy("umi", "barcode")) / (2.0 * F.count("*").over(Window.partitionBy(F.lit(1))))).alias("p"))
    return cells.adjust_bh(t).select("barcode", F.round("p", 9).alias("p"), F.round("q", 9).alias("q"))


# Saturation and amplification


@query(
    "saturation_curve",
    """WITH f AS (SELECT i / 10.0::double AS f FROM range(11) AS t(i)), h AS (SELECT cnt::double AS c, count(*) AS n FROM cd GROUP BY 1),
p AS (SELECT f, sum(n * CASE WHEN f <= 0 THEN 0 WHEN f >= 1 THEN 1 ELSE 1 - pow(1 - f, c) END) AS seen, sum(n * c) AS reads FROM f, h GROUP BY f),
g AS (SELECT barcode, gene, sum(cnt)::double AS c FROM cd GROUP BY 1, 2),
e AS (SELECT f, barcode, sum(CASE WHEN f <= 0 THEN 0 WHEN f >= 1 THEN 1 ELSE 1 - pow(1 - f, c) END) AS g FROM f, g GROUP BY 1, 2), m AS (SELECT f, median(g) AS m FROM e GROUP BY f)
SELECT round_even(f, 4) AS read_fraction, round_even(m, 2) AS median_gene_number, round_even(CASE WHEN f <= 0 THEN 0 ELSE greatest(0, least(100, (1 - seen / (f * reads)) * 100)) END, 2) AS umi_saturation,
round_even(CASE WHEN f <= 0 THEN 0 ELSE greatest(0, least(100, (1 - seen / (f * reads)) * 100)) END, 2) AS read_saturation FROM p JOIN m USING (f)""",
    "cd",
)
def saturation_curve(spark, d):
    return saturation.saturation_curve(mol(spark, d))


@query("saturation_marginal_gain", "WITH c AS (%s) SELECT read_fraction, round(umi_saturation - lag(umi_saturation) OVER w, 6) AS saturation_gain, round(median_gene_number - lag(median_gene_number) OVER w, 6) AS gene_gain, round((median_gene_number - lag(median_gene_number) OVER w) / nullif(lag(median_gene_number) OVER w, 0), 6) AS gene_gain_ratio FROM c WINDOW w AS (ORDER BY read_fraction)" % SQL["saturation_curve"])
def saturation_marginal_gain(spark, d):
    return saturation.marginal_gain(saturation.saturation_curve(mol(spark, d)))


@query("amplification_distribution", "WITH h AS (SELECT cnt AS reads_per_umi, count(*) AS molecules FROM cd GROUP BY 1) SELECT reads_per_umi, molecules, molecules * reads_per_umi AS reads, round(molecules / sum(molecules) OVER (), 9) AS molecule_share, round(molecules * reads_per_umi / sum(molecules * reads_per_umi) OVER (), 9) AS read_share, round(molecules * (reads_per_umi - 1) / sum(molecules * (reads_per_umi - 1)) OVER (), 9) AS duplicate_share FROM h", "cd")
def amplification_distribution(spark, d):
    return saturation.amplification_distribution(mol(spark, d))


@query("amplification_thresholds", "SELECT cast(t as int) AS threshold, count(*) FILTER (WHERE cnt >= t) AS molecules, cast(coalesce(sum(cnt) FILTER (WHERE cnt >= t), 0) as bigint) AS reads FROM cd, unnest([1, 2, 3, 5, 10, 20, 50, 100, 200, 500, 1000]) AS u(t) GROUP BY 1", "cd")
def amplification_thresholds(spark, d):
    return saturation.tail_thresholds(mol(spark, d))


@query("amplification_quantiles", "WITH v AS (SELECT [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0] AS q, (SELECT quantile_cont(cnt, [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]) FROM cd) AS r) SELECT unnest(q)::double AS q, unnest(r)::double AS reads FROM v", "cd")
def amplification_quantiles(spark, d):
    return saturation.read_quantiles(mol(spark, d))


@query("amplification_genes", "SELECT gene, count(*) AS molecules, cast(sum(cnt) as bigint) AS reads, median(cnt) AS median_reads, max(cnt) AS max_reads, round(1 - count(*) / sum(cnt), 9) AS duplicate_share FROM cd GROUP BY 1", "cd")
def amplification_genes(spark, d):
    return saturation.gene_amplification(mol(spark, d))


@query("amplification_top_n", "WITH r AS (SELECT cnt, row_number() OVER (ORDER BY cnt DESC) AS k FROM cd) SELECT cast(t as int) AS top_n, cast(sum(cnt) FILTER (WHERE k <= t) as bigint) AS reads, round(sum(cnt) FILTER (WHERE k <= t) / sum(cnt), 9) AS read_share FROM r, unnest([1, 10, 100, 1000]) AS u(t) GROUP BY 1", "cd")
def amplification_top_n(spark, d):
    return saturation.top_contribution(mol(spark, d))


@query(
    "thinning_replicates",
    """WITH r AS (SELECT barcode, gene, umi, k, unnest(range(1, cnt + 1)) AS i FROM cd, unnest([0, 1, 2]) AS t(k)), u AS (SELECT *, ('0x' || substr(md5(concat_ws('|', '0', k, barcode, gene, umi, i)), 1, 8))::bigint / 4294967296.0::double AS u FROM r),
k AS (SELECT f, k, barcode, gene, umi, count(*) AS cnt FROM u, unnest([0.1, 0.25, 0.5, 0.75]) AS t(f) WHERE u < f::double GROUP BY ALL), b AS (SELECT f, k, barcode, sum(cnt) AS reads, count(*) AS umi, count(DISTINCT gene) AS genes FROM k GROUP BY 1, 2, 3),
m AS (SELECT f, k, sum(reads)::double AS reads, sum(umi)::double AS umi, sum(genes)::double / (SELECT count(DISTINCT barcode) FROM cd) AS g FROM b GROUP BY 1, 2)
SELECT f::double AS read_fraction, round(avg(reads), 6) AS reads_mean, round(stddev_samp(reads), 6) AS reads_sd, round(avg(umi), 6) AS umi_mean, round(stddev_samp(umi), 6) AS umi_sd, round(avg(g), 6) AS mean_genes_mean, round(stddev_samp(g), 6) AS mean_genes_sd FROM m GROUP BY 1""",
    "cd",
)
def thinning_replicates(spark, d):
    m = mol(spark, d)
    out = saturation.aggregate_replicates(saturation.thinned_metrics(m, m.select("barcode").distinct(), [0.1, 0.25, 0.5, 0.75], 3))
    return out.select("read_fraction", *[F.round(c, 6).alias(c) for c in out.columns if c != "read_fraction"])


# Sequences and demultiplexing


@query("dna_encode", "SELECT barcode, list_sum(list_transform(range(1, 9), lambda i: (CASE substr(barcode, i, 1) WHEN 'A' THEN 0 WHEN 'C' THEN 1 WHEN 'G' THEN 2 ELSE 3 END) * (4 ** (8 - i))::bigint))::bigint AS code FROM pos", "pos")
def dna_encode(spark, d):
    return X.frame(spark, d, X.POSITIONS).select("barcode", S.encode(F.col("barcode")).alias("code"))


@query("dna_decode", f"SELECT s_suppkey, {X.dna('(s_suppkey * 7919) % 65536', 8)} AS seq FROM supplier")
def dna_decode(spark, d):
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", S.decode(F.col("s_suppkey") * 7919 % 65536, 8).alias("seq"))


@query("dna_onehot", "SELECT barcode, barcode AS back, cast(length(barcode) as int) AS width FROM pos", "pos")
def dna_onehot(spark, d):
    return X.frame(spark, d, X.POSITIONS).select("barcode", S.decode_onehot(S.encode_onehot(F.col("barcode")), 8).alias("back"), F.length("barcode").alias("width"))


@query("dna_hamming", "SELECT a.barcode AS a, b.barcode AS b, cast(hamming(a.barcode, b.barcode) as int) AS bases, cast(hamming(a.barcode, b.barcode) as int) AS letters FROM pos a JOIN pos b ON a.x = b.x", "pos")
def dna_hamming(spark, d):
    p = X.frame(spark, d, X.POSITIONS)
    a, b = p.select(F.col("barcode").alias("a"), "x"), p.select(F.col("barcode").alias("b"), "x")
    return a.join(b, "x").select("a", "b", S.hamming_codes(S.encode(F.col("a")), S.encode(F.col("b"))).alias("bases"), S.hamming(F.col("a"), F.col("b")).alias("letters"))


@query("bit_hamming", "SELECT s_suppkey, cast(bit_count(xor(s_suppkey, s_suppkey * 7)) as int) AS bits FROM supplier")
def bit_hamming(spark, d):
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", S.hamming_bits(F.col("s_suppkey"), F.col("s_suppkey") * 7).alias("bits"))


@query("reverse_complement", "SELECT barcode, reverse(translate(barcode, 'ACGT', 'TGCA')) AS rc FROM pos", "pos")
def reverse_complement(spark, d):
    return X.frame(spark, d, X.POSITIONS).select("barcode", S.reverse_complement(F.col("barcode")).alias("rc"))


def parsed(spark, d):
    return demux.parse_reads(X.frame(spark, d, X.READS), demux.CHEMISTRIES["demo"], [X.LINKER], most_low=0)


_STATUS = """SELECT l_orderkey, l_linenumber, l_partkey, substr(seq, 1, 8) AS barcode, substr(seq, 24, 4) AS umi,
CASE WHEN length(regexp_replace(substr(qual, 1, 8) || substr(qual, 24, 4), '[^!-*]', '', 'g')) > 0 THEN 'low_quality' WHEN hamming(substr(seq, 9, 15), 'CTCGTGTGAAGACAG') > 2 THEN 'no_linker' ELSE 'ok' END AS status FROM reads"""


@query("demux_reads", _STATUS, "reads")
def demux_reads(spark, d):
    return parsed(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "barcode", "umi", "status")


@query("demux_status_counts", f"WITH s AS ({_STATUS}) SELECT status, count(*) AS reads, round_even(count(*)::double / sum(count(*)) OVER () * 100, 2) AS pct FROM s GROUP BY 1", "reads")
def demux_status_counts(spark, d):
    return demux.status_counts(parsed(spark, d))


_CORRECT = """WITH obs AS (SELECT DISTINCT substr(seq, 1, 8) AS barcode FROM reads), e AS (SELECT DISTINCT barcode AS entry FROM pos),
n AS (SELECT barcode, count(*) AS k, min(entry) AS e1, max(CASE WHEN entry = barcode THEN 1 ELSE 0 END) AS exact FROM obs JOIN e ON hamming(barcode, entry) <= 1 GROUP BY 1)
SELECT barcode, CASE WHEN exact = 1 THEN barcode WHEN k = 1 THEN e1 END AS corrected FROM obs LEFT JOIN n USING (barcode)"""


@query("whitelist_correct", _CORRECT, "reads", "pos")
def whitelist_correct(spark, d):
    return demux.correct_barcodes(parsed(spark, d), X.frame(spark, d, X.POSITIONS), 8, 1)


@query("demux_corrected_counts", f"WITH s AS ({_STATUS}), c AS ({_CORRECT}) SELECT CASE WHEN status = 'ok' AND corrected IS NULL THEN 'no_barcode' ELSE status END AS status, count(*) AS reads, round_even(count(*)::double / sum(count(*)) OVER () * 100, 2) AS pct FROM s JOIN c USING (barcode) GROUP BY 1", "reads", "pos")
def demux_corrected_counts(spark, d):
    return demux.status_counts(demux.demultiplex(parsed(spark, d), X.frame(spark, d, X.POSITIONS), 8, 1))


@query("whitelist_mismatch_dict", "WITH w AS (SELECT s_suppkey AS p, substr(barcode, 1, 4) AS e FROM (SELECT s_suppkey, %s AS barcode FROM supplier)), n AS (SELECT p, e, e AS seq FROM w UNION ALL SELECT p, e, substr(e, 1, i - 1) || b || substr(e, i + 1) FROM w, unnest([1, 2, 3, 4]) AS t(i), unnest(['A', 'C', 'G', 'T', 'N']) AS u(b)) SELECT seq, arg_max(e, p) AS entry FROM n GROUP BY 1" % X.dna("(s_suppkey * 7919) % 65536", 8))
def whitelist_mismatch_dict(spark, d):
    w = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("pos"), F.substring(S.decode(F.col("s_suppkey") * 7919 % 65536, 8), 1, 4).alias("value"))
    return demux.mismatch_table(w, 4, 1)


@query("base_quality", "SELECT cast(sum(length(qual)) as bigint) AS bases, round_even(sum(length(regexp_replace(qual, '[^?-~]', '', 'g')))::double / sum(length(qual)) * 100, 2) AS q30 FROM reads", "reads")
def base_quality(spark, d):
    return demux.base_quality(X.frame(spark, d, X.READS))


@query("chemistry_detect", "SELECT 'demo' AS chemistry, 1.0::double AS share, 'ok' AS verdict")
def chemistry_detect(spark, d):
    reads = X.frame(spark, d, X.READS).withColumn("read_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return demux.detect_chemistry(reads, [("other", "^.{4}CTCGTGTGAAGACAG"), ("demo", "^.{8}CTCGTGTGAAGACAG")])


@query("combinatorial_whitelist", "WITH v AS (SELECT r_name[1:3] AS v FROM region) SELECT a.v || b.v || c.v AS barcode FROM v a, v b, v c")
def combinatorial_whitelist(spark, d):
    return demux.combinations(spark.read.parquet(f"{d}/region.parquet").select(F.substring("r_name", 1, 3).alias("value")), 3)


# Space


@query("square_bins", "SELECT cast(m as int) AS bin_um, cast(y // p as int) AS bin_row, cast(x // p as int) AS bin_col, cast(sum(cnt) as bigint) AS readcount, count(*) FILTER (WHERE cnt > 1) AS umi2, count(*) AS umi, count(DISTINCT gene) AS genes FROM loc, (VALUES (10, 20), (20, 40), (50, 100), (100, 200)) AS s(m, p) GROUP BY 1, 2, 3", "loc")
def square_bins(spark, d):
    return spatial.bin_summary(spatial.square_bins(located(spark, d), 400, 300))


@query(
    "bin_stats",
    f"WITH b AS (SELECT cast(m as int) AS bin_um, y // p AS r, x // p AS c, sum(cnt) AS readcount, count(*) AS umi, count(DISTINCT gene) AS genes FROM loc, (VALUES (10, 20), (20, 40), (50, 100), (100, 200)) AS s(m, p) GROUP BY 1, 2, 3) SELECT bin_um, count(*) AS bins, cast(floor(sum(readcount) / count(*)) as int) AS mean_reads, cast(floor(avg(umi)) as int) AS mean_umi, cast(floor(median(umi)) as int) AS median_umi, cast(floor(avg(genes)) as int) AS mean_genes, cast(floor(median(genes)) as int) AS median_genes, (SELECT count(DISTINCT gene) FROM loc) AS total_genes FROM b GROUP BY 1",
    "loc",
)
def bin_stats(spark, d):
    return spatial.bin_stats(spatial.square_bins(located(spark, d), 400, 300))


@query("bin_positions", "WITH b AS (SELECT DISTINCT m AS bin_um, y // p AS bin_row, x // p AS bin_col, cast(least(299, trunc((y // p + 0.5) * p)) as int) AS r, cast(least(399, trunc((x // p + 0.5) * p)) as int) AS c FROM pos, (VALUES (10, 20), (20, 40), (50, 100), (100, 200)) AS s(m, p)) SELECT bin_um, bin_row, bin_col, r AS pxl_row, c AS pxl_col, CASE WHEN mask.row IS NULL THEN 0 ELSE 1 END AS in_tissue FROM b LEFT JOIN mask ON r = mask.row AND c = mask.col", "pos", "mask")
def bin_positions(spark, d):
    return spatial.bin_in_tissue(spatial.square_bins(X.frame(spark, d, X.POSITIONS), 400, 300), X.frame(spark, d, X.MASK), 400, 300)


@query("mask_filter_drop_oob", "SELECT pos.* FROM pos SEMI JOIN mask ON y = mask.row AND x = mask.col", "pos", "mask")
def mask_filter_drop_oob(spark, d):
    return spatial.keep_in_mask(X.frame(spark, d, X.POSITIONS), X.frame(spark, d, X.MASK), BOX, SHAPE)


@query("mask_filter_keep_oob", "WITH m AS (SELECT DISTINCT row + a AS row, col + b AS col FROM mask, range(-1, 2) AS t(a), range(-1, 2) AS u(b)) SELECT pos.* FROM pos ANTI JOIN m ON y = m.row AND x = m.col", "pos", "mask")
def mask_filter_keep_oob(spark, d):
    return spatial.remove_in_mask(X.frame(spark, d, X.POSITIONS), X.frame(spark, d, X.MASK), 1)


@query("grid_heatmap_noise_floor", "WITH g AS (SELECT cast(y // 50 as int) AS row_bin, cast(x // 50 as int) AS col_bin, count(*) AS umi FROM loc GROUP BY 1, 2), f AS (SELECT quantile_cont(umi, 0.05) AS floor FROM g) SELECT g.*, floor, umi > floor AS above FROM g, f", "loc")
def grid_heatmap_noise_floor(spark, d):
    return spatial.heatmap(located(spark, d), 50)


_ASSIGN = "SELECT pos.barcode, x, y, cast(y as int) AS row, cast(x as int) AS col, true AS in_bounds, coalesce(label, 0) AS cell_id FROM pos LEFT JOIN lab ON y = lab.row AND x = lab.col"


def assigned(spark, d):
    return spatial.assign_labels(X.frame(spark, d, X.POSITIONS), X.frame(spark, d, X.LABELS), BOX, SHAPE)


@query("label_assignment", _ASSIGN, "pos", "lab")
def label_assignment(spark, d):
    return assigned(spark, d)


@query("barcodes_per_cell", f"WITH a AS ({_ASSIGN}) SELECT cell_id, count(*) AS assigned_barcodes FROM a WHERE cell_id <> 0 GROUP BY 1", "pos", "lab")
def barcodes_per_cell(spark, d):
    return spatial.per_cell_barcodes(assigned(spark, d))


@query("assignment_summary", f"WITH a AS ({_ASSIGN}), n AS (SELECT count(*) AS k FROM a WHERE cell_id <> 0 GROUP BY cell_id), q AS (SELECT quantile_cont(k, 0.1) AS q10, quantile_cont(k, 0.25) AS q25, quantile_cont(k, 0.5) AS q50, quantile_cont(k, 0.75) AS q75, quantile_cont(k, 0.9) AS q90 FROM n) SELECT count(*) AS barcodes, 1.0::double AS in_bounds_rate, round_even(count(*) FILTER (WHERE cell_id <> 0)::double / count(*), 6) AS assigned_rate, any_value(q10) AS q10, any_value(q25) AS q25, any_value(q50) AS q50, any_value(q75) AS q75, any_value(q90) AS q90 FROM a, q", "pos", "lab")
def assignment_summary(spark, d):
    return spatial.assignment_summary(assigned(spark, d))


@query("cell_geometry", "SELECT label, count(*) AS area_px, round(avg(row), 6) AS centroid_row_px, round(avg(col), 6) AS centroid_col_px, round(avg(row) + 0.5, 6) AS pxl_row_in_fullres, round(avg(col) + 0.5, 6) AS pxl_col_in_fullres FROM lab WHERE label <> 0 GROUP BY 1", "lab")
def cell_geometry(spark, d):
    return spatial.label_geometry(X.frame(spark, d, X.LABELS), BOX, SHAPE)


@query("cell_qc", f"WITH a AS ({_ASSIGN}), c AS (SELECT cell_id, count(*) AS umi, cast(sum(cnt) as bigint) AS reads, count(DISTINCT gene) AS genes FROM cd JOIN a USING (barcode) WHERE cell_id <> 0 GROUP BY 1) SELECT *, cast(row_number() OVER (ORDER BY cell_id) as int) AS new_cell_id FROM c WHERE umi >= 100 AND genes >= 10", "cd", "pos", "lab")
def cell_qc(spark, d):
    return spatial.retained_cells(spatial.cell_counts(mol(spark, d), assigned(spark, d)), 100, 10)


@query("label_runs", "WITH r AS (SELECT *, sum(CASE WHEN label = p THEN 0 ELSE 1 END) OVER (PARTITION BY row ORDER BY col) AS g FROM (SELECT *, lag(label) OVER (PARTITION BY row ORDER BY col) AS p FROM lab)) SELECT row, label, min(col) AS col_start, max(col) AS col_end FROM r WHERE label <> 0 GROUP BY row, g, label", "lab")
def label_runs(spark, d):
    return spatial.label_runs(X.frame(spark, d, X.LABELS))


@query("canvas_shape", "SELECT greatest(300, max(y) + 1)::bigint AS height, greatest(350, max(x) + 1)::bigint AS width FROM pos", "pos")
def canvas_shape(spark, d):
    return spatial.canvas(X.frame(spark, d, X.POSITIONS), (300, 350))


@query("bin_labels", "SELECT barcode, 'bin10_' || (x // 20)::varchar || '_' || (y // 20)::varchar AS label FROM pos", "pos")
def bin_labels(spark, d):
    return X.frame(spark, d, X.POSITIONS).select("barcode", spatial.bin_label(F.col("x"), F.col("y")).alias("label"))


@query("hd_bin_join", "SELECT 'bin10_' || (x // 20)::varchar || '_' || (y // 20)::varchar AS label, gene, count(*) AS umi, cast(sum(cnt) as bigint) AS reads FROM loc GROUP BY 1, 2", "loc")
def hd_bin_join(spark, d):
    return located(spark, d).groupBy(spatial.bin_label(F.col("x"), F.col("y")).alias("label"), "gene").agg(F.count("*").alias("umi"), F.sum("cnt").alias("reads"))


@query("rotate_points", "SELECT barcode, round((x - 200) * cos(radians(30)) - (y - 150) * sin(radians(30)) + 200, 6) AS rx, round((x - 200) * sin(radians(30)) + (y - 150) * cos(radians(30)) + 150, 6) AS ry FROM pos", "pos")
def rotate_points(spark, d):
    rx, ry = N.rotated(F.col("x"), F.col("y"), 30, 200, 150)
    return X.frame(spark, d, X.POSITIONS).select("barcode", F.round(rx, 6).alias("rx"), F.round(ry, 6).alias("ry"))


@query("registration_affine", "SELECT barcode, round(2 * x * 0.5 + 3 * y * 0.25 + 10, 6)::double AS rx, round(3 * y * 0.5 - 4, 6)::double AS ry FROM pos", "pos")
def registration_affine(spark, d):
    m = N.compose([[0.5, 0.25, 10], [0, 0.5, -4]], [[2, 0, 0], [0, 3, 0]])
    rx, ry = N.affine(F.col("x"), F.col("y"), m)
    return X.frame(spark, d, X.POSITIONS).select("barcode", F.round(rx, 6).alias("rx"), F.round(ry, 6).alias("ry"))


# Rasters


@query("tile_grid", "SELECT cast(y as int) AS core_y0, cast(x as int) AS core_x0, cast(least(300, y + 128) as int) AS core_y1, cast(least(400, x + 128) as int) AS core_x1, cast(greatest(0, y - 16) as int) AS y0, cast(greatest(0, x - 16) as int) AS x0, cast(least(300, least(300, y + 128) + 16) as int) AS y1, cast(least(400, least(400, x + 128) + 16) as int) AS x1 FROM range(0, 300, 128) AS a(y), range(0, 400, 128) AS b(x)")
def tile_grid(spark, d):
    return raster.tiles(400, 300, 128, 16, spark)


@query("core_owned_labels", "WITH c AS (SELECT label, avg(row) AS cy, avg(col) AS cx FROM lab WHERE label <> 0 GROUP BY 1) SELECT label, cast(floor(cy / 128) * 128 as int) AS core_y0, cast(floor(cx / 128) * 128 as int) AS core_x0 FROM c", "lab")
def core_owned_labels(spark, d):
    c = X.frame(spark, d, X.LABELS).filter("label <> 0").groupBy("label").agg(F.avg("row").alias("cy"), F.avg("col").alias("cx"))
    return raster.owned_by_core(c, raster.tiles(400, 300, 128, 16, spark))


@query("exclude_labels", "WITH t AS (SELECT DISTINCT label FROM lab WHERE col >= 50 AND col < 120 AND row >= 40 AND row < 90), k AS (SELECT label, row_number() OVER (ORDER BY label) AS n FROM (SELECT DISTINCT label FROM lab WHERE label <> 0 AND label NOT IN (SELECT label FROM t))) SELECT row, col, cast(n as int) AS label FROM lab JOIN k USING (label)", "lab")
def exclude_labels(spark, d):
    return raster.exclude_labels(X.frame(spark, d, X.LABELS), [(50, 40, 120, 90)])


@query("label_stitch_best", "WITH s AS (SELECT row + 5 AS row, col + 3 AS col, label FROM lab WHERE label <> 0), a AS (SELECT label, count(*) AS area FROM s GROUP BY 1), o AS (SELECT s.label, lab.label AS other, count(*) AS n FROM s JOIN lab ON s.row = lab.row AND s.col = lab.col AND lab.label <> 0 GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, other) AS k FROM o) SELECT a.label, area, other, coalesce(n, 0) AS overlap, coalesce(n, 0)::double / area >= 0.5 AS merged FROM a LEFT JOIN b ON a.label = b.label AND k = 1", "lab")
def label_stitch_best(spark, d):
    lab = X.frame(spark, d, X.LABELS)
    return raster.stitch(lab.select((F.col("row") + 5).alias("row"), (F.col("col") + 3).alias("col"), "label"), lab)


@query("label_expand", "WITH g AS (SELECT row + a AS row, col + b AS col, a * a + b * b AS d, label FROM lab, range(-2, 3) AS t(a), range(-2, 3) AS u(b) WHERE label <> 0 AND a * a + b * b <= 4) SELECT cast(row as int) AS row, cast(col as int) AS col, arg_min(label, d * 100000 + label) AS label FROM g WHERE row >= 0 AND row < 300 AND col >= 0 AND col < 400 GROUP BY 1, 2", "lab")
def label_expand(spark, d):
    return raster.expand(X.frame(spark, d, X.LABELS), 2, SHAPE)


@query("mask_iou", "WITH b AS (SELECT row, col FROM lab WHERE label <> 0) SELECT (SELECT count(*) FROM mask JOIN b USING (row, col)) AS both, (SELECT count(*) FROM (SELECT row, col FROM mask UNION SELECT row, col FROM b)) AS either, round((SELECT count(*) FROM mask JOIN b USING (row, col))::double / (SELECT count(*) FROM (SELECT row, col FROM mask UNION SELECT row, col FROM b)), 9) AS iou", "mask", "lab")
def mask_iou(spark, d):
    return raster.intersection_over_union(X.frame(spark, d, X.MASK), X.frame(spark, d, X.LABELS).filter("label <> 0").select("row", "col"))


@query("mask_dilate", "SELECT DISTINCT cast(row + a as int) AS row, cast(col + b as int) AS col FROM mask, range(-2, 3) AS t(a), range(-2, 3) AS u(b) WHERE row + a BETWEEN 0 AND 299 AND col + b BETWEEN 0 AND 399", "mask")
def mask_dilate(spark, d):
    return raster.dilate(X.frame(spark, d, X.MASK), 2, SHAPE)


@query("mask_runs", "SELECT row, min(col) AS col_start, max(col) AS col_end FROM mask GROUP BY 1", "mask")
def mask_runs(spark, d):
    return raster.runs(X.frame(spark, d, X.MASK))


_LEVELS = "SELECT cast(v as int) AS level, count(*) AS n FROM (SELECT cast(floor(o_totalprice) as bigint) % 256 AS v FROM orders) GROUP BY 1"


def levels(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").groupBy((F.floor("o_totalprice").cast("bigint") % 256).cast("int").alias("level")).agg(F.count("*").alias("n"))


@query("threshold_otsu", f"WITH h AS ({_LEVELS}), c AS (SELECT level, sum(n) OVER (ORDER BY level)::double AS w0, sum(n * level) OVER (ORDER BY level)::double AS s0, (sum(n) OVER ())::double AS w, (sum(n * level) OVER ())::double AS s FROM h) SELECT level AS threshold FROM c WHERE w0 < w ORDER BY round(w0 * (w - w0) * pow(s0 / w0 - (s - s0) / (w - w0), 2), 3) DESC, level LIMIT 1")
def threshold_otsu(spark, d):
    return raster.otsu(levels(spark, d))


@query("threshold_yen", f"WITH h AS ({_LEVELS}), p AS (SELECT level, n::double / sum(n) OVER () AS p FROM h), c AS (SELECT level, sum(p) OVER (ORDER BY level) AS c, sum(p * p) OVER (ORDER BY level) AS s, sum(p * p) OVER () AS t FROM p) SELECT level AS threshold FROM c WHERE 1 - c > 1e-12 ORDER BY round(ln(pow(c * (1 - c), 2) / (s * (t - s))), 9) DESC, level LIMIT 1")
def threshold_yen(spark, d):
    return raster.yen(levels(spark, d))


@query("threshold_isodata", f"WITH h AS ({_LEVELS}), e AS (SELECT cast(unnest(range((SELECT min(level) FROM h), (SELECT max(level) + 1 FROM h))) as int) AS level), a AS (SELECT level, coalesce(n, 0) AS n FROM e LEFT JOIN h USING (level)), c AS (SELECT level, (sum(n) OVER w)::double AS k, (sum(n * level) OVER w)::double AS s, (sum(n) OVER ())::double AS kk, (sum(n * level) OVER ())::double AS ss FROM a WINDOW w AS (ORDER BY level)), g AS (SELECT level, (s / k + (ss - s) / nullif(kk - k, 0)) / 2 - level AS gap FROM c) SELECT min(level) AS threshold FROM g WHERE gap >= 0 AND gap < 1")
def threshold_isodata(spark, d):
    return raster.isodata(levels(spark, d))


@query("threshold_mean", f"WITH h AS ({_LEVELS}) SELECT sum(level * n)::double / sum(n) AS threshold FROM h")
def threshold_mean(spark, d):
    return raster.mean_threshold(levels(spark, d))


@query("contrast_stretch", "WITH q AS (SELECT quantile_cont(o_totalprice, 0.02) AS lo, quantile_cont(o_totalprice, 0.98) AS hi FROM orders) SELECT o_orderkey, cast(round_even(greatest(0.0, least(1.0, (o_totalprice - lo) / (hi - lo))) * 255, 0) as int) AS stretched FROM orders, q")
def contrast_stretch(spark, d):
    return raster.stretch(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_totalprice"), "o_totalprice").select("o_orderkey", "stretched")


# Annotation and files


@query("gtf_attributes", "SELECT line, regexp_extract(attrs, 'gene_id \"([^\"]*)\"', 1) AS gene_id, regexp_extract(attrs, 'gene_name \"([^\"]*)\"', 1) AS gene_name FROM ann WHERE feature = 'gene'", "ann")
def gtf_attributes(spark, d):
    m = annotation.gtf_attributes(F.col("attrs"))
    return X.frame(spark, d, X.ANNOTATION).filter("feature = 'gene'").select("line", m["gene_id"].alias("gene_id"), m["gene_name"].alias("gene_name"))


@query("gff_hierarchy", "WITH t AS (SELECT regexp_extract(attrs, 'ID=rna:([^;]*)', 1) AS tr, regexp_extract(attrs, 'Parent=gene:(.*)', 1) AS g FROM ann WHERE feature = 'mRNA'), e AS (SELECT line, regexp_replace(unnest(string_split(regexp_extract(attrs, 'Parent=(.*)', 1), ',')), '^(gene|rna):', '') AS p FROM ann WHERE feature = 'exon') SELECT line, coalesce(tr, '') AS transcript, coalesce(g, p) AS gene FROM e LEFT JOIN t ON p = tr", "ann")
def gff_hierarchy(spark, d):
    return annotation.hierarchy(X.frame(spark, d, X.ANNOTATION))


_GENES = "SELECT line, regexp_extract(attrs, 'gene_id \"([^\"]*)\"', 1) AS gene, regexp_extract(attrs, 'gene_name \"([^\"]*)\"', 1) AS name FROM ann WHERE feature = 'gene'"


def genes(spark, d):
    m = annotation.gtf_attributes(F.col("attrs"))
    return X.frame(spark, d, X.ANNOTATION).filter("feature = 'gene'").select("line", m["gene_id"].alias("gene"), m["gene_name"].alias("name"))


@query("gene_names_dedup", f"WITH g AS ({_GENES}), l AS (SELECT gene, arg_max(name, line) AS name, min(line) AS line FROM g GROUP BY 1), n AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY line) AS k FROM l) SELECT gene, CASE WHEN k > 1 THEN name || '_' || k ELSE name END AS name FROM n", "ann")
def gene_names_dedup(spark, d):
    return annotation.gene_names(genes(spark, d), distinct_names=True)


@query("gene_name_conflicts", f"WITH g AS ({_GENES}) SELECT gene, count(DISTINCT name) AS names FROM g GROUP BY 1 HAVING count(DISTINCT name) > 1", "ann")
def gene_name_conflicts(spark, d):
    return annotation.conflicting_names(genes(spark, d))


@query("annotation_checks", "SELECT count(*) FILTER (WHERE feature = 'exon') AS exons, count(*) FILTER (WHERE feature = 'gene') AS genes, count(*) FILTER (WHERE feature = 'exon') AS exons_without_id, 0::bigint AS genes_without_id FROM ann", "ann")
def annotation_checks(spark, d):
    return annotation.annotation_checks(X.frame(spark, d, X.ANNOTATION))


@query("missing_genes", f"WITH e AS (SELECT line, start_pos, end_pos, strand, 'X' || (line % 40)::varchar AS gene FROM ann WHERE feature = 'exon'), l AS (SELECT * FROM e WHERE gene NOT IN ('X1', 'X2')), f AS (SELECT gene, arg_min(strand, line) AS strand FROM l GROUP BY 1) SELECT gene, strand, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM l JOIN f USING (gene, strand) GROUP BY 1, 2", "ann")
def missing_genes(spark, d):
    e = X.frame(spark, d, X.ANNOTATION).filter("feature = 'exon'").select("line", "start_pos", "end_pos", "strand", F.concat(F.lit("X"), (F.col("line") % 40).cast("string")).alias("gene"))
    return annotation.missing_genes(e, spark.createDataFrame([("X1",), ("X2",)], "gene string"))


@query("feature_overlap", "WITH f AS (SELECT 'E' || line::varchar AS gene, start_pos, end_pos FROM ann WHERE feature = 'exon'), r AS (SELECT l_orderkey * 10 + l_linenumber AS read_id, (l_partkey * 9) % 20000 AS s, (l_partkey * 9) % 20000 + 50 AS e FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)), o AS (SELECT read_id, gene, max(least(e, end_pos) - greatest(s, start_pos) + 1) AS n FROM r JOIN f ON s <= end_pos AND e >= start_pos GROUP BY 1, 2) SELECT read_id, arg_min(gene, (-n, gene)) AS gene, max(n) AS overlap FROM o GROUP BY 1", "ann")
def feature_overlap(spark, d):
    f = X.frame(spark, d, X.ANNOTATION).filter("feature = 'exon'").select(F.concat(F.lit("E"), F.col("line").cast("string")).alias("gene"), "start_pos", "end_pos")
    s = F.col("l_partkey") * 9 % 20000
    r = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey").distinct().select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("read_id"), s.alias("start_pos"), (s + 50).alias("end_pos"))
    return annotation.overlap_features(r, f)


_NAMES = """SELECT file, coalesce(nullif(regexp_extract(file, '^(.+)_S\\d+_L\\d+_R[12]_', 1), ''), nullif(regexp_extract(file, '^(.+)_fold\\d+_', 1), ''), regexp_extract(file, '^(.+)_R?[12]\\.', 1)) AS sample,
cast(coalesce(nullif(regexp_extract(file, '_S(\\d+)_L', 1), ''), '1') as int) AS sample_no, cast(coalesce(nullif(regexp_extract(file, '_L(\\d+)_', 1), ''), nullif(regexp_extract(file, '_fold(\\d+)_', 1), ''), '1') as int) AS lane,
cast(coalesce(nullif(regexp_extract(file, '_R?([12])(_\\d+)?\\.f', 1), ''), '1') as int) AS read, cast(coalesce(nullif(regexp_extract(file, '_R[12]_(\\d+)\\.', 1), ''), '1') as int) AS chunk FROM files"""


@query("fastq_name_parse", _NAMES, "files")
def fastq_name_parse(spark, d):
    return fastq.parse_names(X.frame(spark, d, X.FILES))


@query("fastq_pairs", f"WITH p AS ({_NAMES}), a AS (SELECT * FROM p WHERE read = 1), b AS (SELECT * FROM p WHERE read = 2) SELECT sample, lane, chunk, a.file AS file1, b.file AS file2, a.file IS NOT NULL AND b.file IS NOT NULL AS paired FROM a FULL JOIN b USING (sample, lane, chunk)", "files")
def fastq_pairs(spark, d):
    return fastq.pair_files(fastq.parse_names(X.frame(spark, d, X.FILES)))


@query("manifest_changes", "WITH a AS (SELECT s_suppkey AS p, s_name AS entry FROM supplier WHERE s_suppkey <> 3), b AS (SELECT CASE s_suppkey WHEN 5 THEN 6 WHEN 6 THEN 5 ELSE s_suppkey END AS q, s_name AS entry FROM supplier WHERE s_suppkey <> 4) SELECT entry, CASE WHEN p IS NULL THEN 'added' WHEN q IS NULL THEN 'removed' WHEN p = q THEN 'same' ELSE 'moved' END AS change FROM a FULL JOIN b USING (entry)")
def manifest_changes(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("position"), F.col("s_name").alias("entry"))
    moved = F.when(F.col("position") == 5, 6).when(F.col("position") == 6, 5).otherwise(F.col("position"))
    return jobs.manifest_changes(s.filter("position <> 3"), s.filter("position <> 4").select(moved.alias("position"), "entry"))


@query("step_status", "WITH o AS (SELECT UNNEST(['sample', 'barcode', 'count', 'report']) AS step, UNNEST([4, 2, 0, 1]) AS k) SELECT step, CASE k WHEN 4 THEN 'complete' WHEN 0 THEN 'missing' ELSE 'partial' END AS status, CASE WHEN step IN ('sample') THEN 'skip' ELSE 'run' END AS decision FROM o")
def step_status(spark, d):
    rows = [(s, f"{s}/{i}", i < k) for s, k in (("sample", 4), ("barcode", 2), ("count", 0), ("report", 1)) for i in range(4)]
    return jobs.resume(jobs.output_status(spark.createDataFrame(rows, "step string, path string, found boolean")), "same")


@query("gene_tags", "SELECT c_name || '_' || 'U' || c_custkey::varchar || '_1' AS query_name, 'G' || (c_custkey % 5)::varchar || ',G' || (c_custkey % 9)::varchar AS genes, c_name AS cb, 'U' || c_custkey::varchar AS ub, CASE WHEN c_custkey % 5 < 3 THEN 'N' ELSE 'G' END || (c_custkey % 5)::varchar || ',' || CASE WHEN c_custkey % 9 < 3 THEN 'N' ELSE 'G' END || (c_custkey % 9)::varchar AS gn FROM customer")
def gene_tags(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    k = F.col("c_custkey")
    a = c.select(F.concat("c_name", F.lit("_U"), k.cast("string"), F.lit("_1")).alias("query_name"), F.concat(F.lit("G"), (k % 5).cast("string"), F.lit(",G"), (k % 9).cast("string")).alias("genes"))
    return tables.tag_names(a, spark.createDataFrame([(f"G{i}", f"N{i}") for i in range(3)], "gene string, name string"))


@query("parse_numbers", "SELECT o_orderkey, round(o_totalprice, 2) AS back FROM orders")
def parse_numbers(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", N.parse_number(F.concat(F.format_number("o_totalprice", 2), F.lit(" %"))).alias("back"))


@query("percent_metrics", "SELECT l_returnflag, count(*) AS n, round_even(count(*)::double / (SELECT count(*) FROM lineitem) * 100, 2) AS fraction FROM lineitem GROUP BY 1")
def percent_metrics(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    total = li.agg(F.count("*").alias("t"))
    return li.groupBy("l_returnflag").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("l_returnflag", "n", N.fraction_of(F.col("n"), F.col("t")).alias("fraction"))


# Expression


def normal(spark, d):
    return expression.normalise(X.frame(spark, d, X.EXPRESSION))


def n_cells(spark, d):
    return spark.read.parquet(f"{d}/embeddings.parquet").count()


_NORM = "SELECT cell, cluster, gene, value, ln(1 + value::double / sum(value) OVER (PARTITION BY cell) * 10000) AS expr FROM ex WHERE value > 0"
_N = "(SELECT count(*) FROM embeddings)"


@query("qc_metrics", "SELECT cell, count(*) AS genes, cast(sum(value) as bigint) AS counts, round(coalesce(sum(value) FILTER (WHERE gene < 5), 0)::double / sum(value) * 100, 6) AS pct_mt FROM ex WHERE value > 0 GROUP BY 1", "ex")
def qc_metrics(spark, d):
    flags = spark.range(64).select(F.col("id").cast("int").alias("gene"), (F.col("id") < 5).alias("mt"))
    return expression.qc_metrics(X.frame(spark, d, X.EXPRESSION), flags)


@query("qc_filter_counts", f"WITH m AS (SELECT cell, count(*) AS genes, sum(value) AS counts, round(coalesce(sum(value) FILTER (WHERE gene < 5), 0)::double / sum(value) * 100, 6) AS pct_mt FROM ex WHERE value > 0 GROUP BY 1) SELECT count(*) AS cells, count(*) FILTER (WHERE genes < 30) AS fails_min_genes, count(*) FILTER (WHERE counts < 300) AS fails_min_counts, count(*) FILTER (WHERE pct_mt > 15) AS fails_max_mt, count(*) FILTER (WHERE NOT (genes < 30) AND NOT (counts < 300) AND NOT (pct_mt > 15)) AS kept FROM m", "ex")
def qc_filter_counts(spark, d):
    return expression.qc_report(qc_metrics(spark, d), expression.qc_filters(30, 300, max_mt=15))


@query("mito_stats", "WITH m AS (SELECT cell, round(coalesce(sum(value) FILTER (WHERE gene < 5), 0)::double / sum(value) * 100, 6) AS p FROM ex WHERE value > 0 GROUP BY 1) SELECT cast(t as int) AS limit_pct, round(count(*) FILTER (WHERE p > t)::double / count(*), 6) AS share FROM m, unnest([5, 10, 15, 20, 50]) AS u(t) GROUP BY 1", "ex")
def mito_stats(spark, d):
    return expression.mito_shares(qc_metrics(spark, d))


@query("normalize_log1p", f"WITH n AS ({_NORM}) SELECT cell, cluster, gene, value, round(expr, 6) AS expr FROM n", "ex")
def normalize_log1p(spark, d):
    return normal(spark, d).select("cell", "cluster", "gene", "value", F.round("expr", 6).alias("expr"))


@query(
    "hvg_dispersion",
    f"""WITH n AS ({_NORM}), g AS (SELECT gene, sum(exp(expr) - 1) AS s, sum(pow(exp(expr) - 1, 2)) AS q, {_N} AS k FROM n GROUP BY 1),
d AS (SELECT gene, ln((q - s * s / k) / (k - 1) / (s / k)) AS dispersion, ln(1 + s / k) AS mean FROM g),
b AS (SELECT *, cast(least(19, floor(round(mean - min(mean) OVER (), 9) * 20 / round(max(mean) OVER () - min(mean) OVER (), 9))) as int) AS bin FROM d)
SELECT gene, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, bin, round(CASE WHEN count(*) OVER (PARTITION BY bin) = 1 THEN 1 ELSE (dispersion - avg(dispersion) OVER (PARTITION BY bin)) / stddev_samp(dispersion) OVER (PARTITION BY bin) END, 6) AS scaled FROM b""",
    "ex",
)
def hvg_dispersion(spark, d):
    return expression.dispersion(normal(spark, d), n_cells(spark, d))


@query("scale_clip", f"WITH n AS ({_NORM}), s AS (SELECT gene, sum(expr) / {_N} AS mu, sqrt((sum(expr * expr) - sum(expr) * sum(expr) / {_N}) / ({_N} - 1)) AS sd FROM n GROUP BY 1) SELECT cell, gene, round(greatest(-10, least(10, (expr - mu) / sd)), 6) AS z FROM n JOIN s USING (gene)", "ex")
def scale_clip(spark, d):
    return expression.scale(normal(spark, d), n_cells(spark, d))


@query("highest_expressed", f"WITH t AS (SELECT gene, value::double / sum(value) OVER (PARTITION BY cell) AS s FROM ex WHERE value > 0) SELECT gene, round(sum(s) / {_N} * 100, 6) AS pct FROM t GROUP BY 1 ORDER BY pct DESC, gene LIMIT 20", "ex")
def highest_expressed(spark, d):
    return expression.top_expressed(X.frame(spark, d, X.EXPRESSION), n_cells(spark, d))


_RANKS = f"""n AS ({_NORM}), cl AS (SELECT vec_id AS cell, label AS cluster FROM embeddings), sz AS (SELECT cluster, count(*) AS n1 FROM cl GROUP BY 1),
a AS (SELECT cl.cell, cl.cluster, g AS gene, coalesce(expr, 0) AS v FROM cl CROSS JOIN range(64) AS t(g) LEFT JOIN n ON n.cell = cl.cell AND n.gene = g),
r AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY v) + (count(*) OVER (PARTITION BY gene, v) - 1) / 2.0::double AS r FROM a),
s AS (SELECT cluster, gene, sum(r) AS rs, count(*) FILTER (WHERE v > 0) AS k, sum(exp(v) - 1) AS x FROM r GROUP BY 1, 2), w AS (SELECT gene, sum(k) AS kk, sum(x) AS xx FROM s GROUP BY 1),
m AS (SELECT cluster, cast(gene as int) AS gene, round(rs, 3) AS rank_sum, round((rs - n1 * ({_N} + 1) / 2.0::double) / sqrt(n1 * ({_N} - n1) * ({_N} + 1) / 12.0::double), 6) AS z, round(k::double / n1, 6) AS pct_1, round((kk - k)::double / ({_N} - n1), 6) AS pct_2, round(log2((x / n1 + 1e-9) / ((xx - x) / ({_N} - n1) + 1e-9)), 6) AS avg_log2fc FROM s JOIN w USING (gene) JOIN sz USING (cluster))"""


def ranked(spark, d):
    clusters = spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("cell"), F.col("label").alias("cluster"))
    return expression.rank_sums(normal(spark, d).drop("cluster"), clusters, spark.range(64).select(F.col("id").cast("int").alias("gene")))


@query("marker_rank_sum", f"WITH {_RANKS} SELECT * FROM m", "ex")
def marker_rank_sum(spark, d):
    return ranked(spark, d)


@query("top_markers", f"WITH {_RANKS}, t AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY -z, avg_log2fc DESC, gene) AS k FROM m WHERE avg_log2fc > 0.05) SELECT cluster, gene, z, avg_log2fc, cast(k as int) AS rank FROM t WHERE k <= 5", "ex")
def top_markers(spark, d):
    return expression.top_markers(ranked(spark, d).withColumn("order_by", -F.col("z")), 5, 0.05, "order_by").select("cluster", "gene", "z", "avg_log2fc", "rank")


@query("marker_table")
def marker_table(spark, d):
    return expression.marker_table(ranked(spark, d)).select("cluster", "gene", "z", F.round("p", 9).alias("p"), F.round("q", 9).alias("q"))


def vectors(spark, d):
    return spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


@query("knn_exact", "WITH e AS (SELECT vec_id AS id, embedding::double[] AS v FROM embeddings), p AS (SELECT a.id, b.id AS other, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda t: pow(t[1] - t[2], 2)))) AS d FROM e a JOIN e b ON a.id <> b.id), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(d, 6), other) AS k FROM p) SELECT id, other, cast(k as int) AS rank, round(d, 6) AS distance FROM r WHERE k <= 5")
def knn_exact(spark, d):
    return expression.nearest(vectors(spark, d), 5)


@query("pca_scores")
def pca_scores(spark, d):
    return expression.principal_components(vectors(spark, d), 5).select("id", F.round(F.abs(F.col("pc")[0]), 3).alias("pc1"))


@query("kmeans_clusters")
def kmeans_clusters(spark, d):
    return expression.k_means(expression.principal_components(vectors(spark, d), 5), 4).groupBy("cluster").agg(F.count("*").alias("n"))


@query("graph_communities")
def graph_communities(spark, d):
    e = expression.nearest(vectors(spark, d), 5).select("id", "other", (1 / (1 + F.col("distance"))).alias("weight"))
    return expression.propagate_labels(e, 3)


@query("cluster_sizes", "SELECT label AS cluster, count(*) AS n, round_even(count(*)::double / sum(count(*)) OVER () * 100, 2) AS pct FROM embeddings GROUP BY 1")
def cluster_sizes(spark, d):
    from pyspark.sql import Window

    c = spark.read.parquet(f"{d}/embeddings.parquet").groupBy(F.col("label").alias("cluster")).agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.bround(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))) * 100, 2))


# Reports


@query("curve_normalised", "WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS line, l_quantity * 2 AS f, l_discount AS s FROM lineitem), m AS (SELECT max(f) AS mf, max(s) AS ms FROM r), c AS (SELECT line, greatest(0, least(1, CASE WHEN mf > 1.5 THEN f / 100 ELSE f END)) AS read_fraction, greatest(0, least(100, CASE WHEN ms <= 1 THEN s * 100 ELSE s END)) AS saturation FROM r, m), k AS (SELECT *, row_number() OVER (PARTITION BY read_fraction ORDER BY line DESC, saturation DESC) AS k FROM c) SELECT read_fraction, round(saturation, 6) AS saturation FROM k WHERE k = 1")
def curve_normalised(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), (F.col("l_quantity") * 2).cast("string").alias("read_fraction")).agg(F.max("l_discount").cast("string").alias("saturation"))
    return reports.normalise_curve(li).withColumn("saturation", F.round("saturation", 6))


@query("metrics_pivot", "WITH w AS (SELECT l_returnflag || l_linestatus AS bin, max(l_quantity) FILTER (WHERE l_shipdate IS NOT NULL) AS most, min(l_quantity) AS least FROM lineitem GROUP BY 1) SELECT bin, most, least, cast(row_number() OVER (ORDER BY bin) as int) AS place FROM w")
def metrics_pivot(spark, d):
    g = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(F.concat("l_returnflag", "l_linestatus").alias("bin")).agg(F.max("l_quantity").alias("most"), F.min("l_quantity").alias("least"))
    return reports.pivot_metrics(g.select("bin", F.expr("stack(2, 'most', most, 'least', least) as (key, value)")), ["most", "least"])


@query("matrix_stats", "WITH p AS (SELECT barcode, sum(cnt) AS u, count(*) AS g FROM (SELECT barcode, gene, count(*) AS cnt FROM cd GROUP BY 1, 2) GROUP BY 1) SELECT count(*) AS bins, round(avg(u), 6) AS mean_umi, median(u)::double AS median_umi, round(avg(g), 6) AS mean_genes, median(g) AS median_genes, (SELECT count(DISTINCT gene) FROM cd) AS genes, cast(sum(g) as bigint) AS entries FROM p", "cd")
def matrix_stats(spark, d):
    return reports.matrix_stats(mol(spark, d).groupBy(F.col("barcode").alias("bin"), "gene").agg(F.count("*").alias("value")))


@query("metadata_join", "SELECT barcode, readcount, CASE WHEN x % 3 > 0 THEN x::double WHEN y % 2 > 0 THEN y::double ELSE 0 END AS x, CASE WHEN x % 3 > 0 THEN y::double WHEN y % 2 > 0 THEN x::double ELSE 0 END AS y, x % 3 > 0 OR y % 2 > 0 AS has_spatial FROM bs JOIN pos USING (barcode)", "bs", "pos")
def metadata_join(spark, d):
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    m = X.frame(spark, d, X.POSITIONS).select("barcode", F.lit(1).alias("line"), F.when(F.col("x") % 3 > 0, x).alias("x1"), y.alias("y1"), F.when(F.col("y") % 2 > 0, y).alias("x2"), x.alias("y2"))
    return reports.attach_metadata(summary(spark, d).select("barcode", "readcount"), m)


@query("bin_step", "WITH g AS (SELECT lead(x) OVER (ORDER BY x) - x AS g FROM (SELECT DISTINCT x FROM pos)) SELECT quantile_cont(g, 0.1) AS step FROM g", "pos")
def bin_step(spark, d):
    return reports.coordinate_step(X.frame(spark, d, X.POSITIONS), "x")


@query("robust_levels", "WITH v AS (SELECT barcode, umi, ln(1 + umi) AS v FROM bs), q AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.995) AS hi FROM v) SELECT barcode, umi, cast(round_even(round(greatest(0, least(1, coalesce((v - lo) / nullif(hi - lo, 0), 0))) * 255, 6), 0) as int) AS level FROM v, q", "bs")
def robust_levels(spark, d):
    return reports.robust_levels(summary(spark, d).select("barcode", "umi"), "umi")


@query("cell_depths", "SELECT pos.barcode, coalesce(readcount, 0) AS reads, coalesce(umi, 0) AS umi, coalesce(genes, 0) AS genes FROM (SELECT DISTINCT barcode FROM pos) AS pos LEFT JOIN bs USING (barcode)", "bs", "pos")
def cell_depths(spark, d):
    return reports.cell_depths(mol(spark, d), X.frame(spark, d, X.POSITIONS))


@query("exonic_split", "SELECT count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS exonic, count(*) FILTER (WHERE l_returnflag = 'A') AS intergenic, 0::bigint AS ambiguous, count(*) FILTER (WHERE l_returnflag NOT IN ('R', 'A')) AS intronic FROM lineitem")
def exonic_split(spark, d):
    status = F.when(F.col("l_returnflag") == "R", "Assigned").when(F.col("l_returnflag") == "A", "Unassigned_NoFeatures").otherwise("Unassigned_Other")
    return reports.exonic_split(spark.read.parquet(f"{d}/lineitem.parquet").groupBy(status.alias("status")).agg(F.count("*").alias("n")))


_BIN_SATURATION = """WITH f AS (SELECT i / 10.0::double AS f FROM range(11) AS t(i)), b AS (SELECT 'bin10_' || (x // 20)::varchar || '_' || (y // 20)::varchar AS bin, barcode, gene, umi, cnt FROM loc),
h AS (SELECT cnt::double AS c, count(*) AS n FROM b GROUP BY 1), p AS (SELECT f, sum(n * CASE WHEN f <= 0 THEN 0 WHEN f >= 1 THEN 1 ELSE 1 - pow(1 - f, c) END) AS seen, sum(n * c) AS reads FROM f, h GROUP BY f),
g AS (SELECT bin, gene, sum(cnt)::double AS c FROM b GROUP BY 1, 2), e AS (SELECT f, bin, sum(CASE WHEN f <= 0 THEN 0 WHEN f >= 1 THEN 1 ELSE 1 - pow(1 - f, c) END) AS g FROM f, g GROUP BY 1, 2), m AS (SELECT f, median(g) AS m FROM e GROUP BY f)
SELECT round_even(f, 4) AS read_fraction, round_even(m, 2) AS median_gene_number, round_even(CASE WHEN f <= 0 THEN 0 ELSE greatest(0, least(100, (1 - seen / (f * reads)) * 100)) END, 2) AS umi_saturation,
round_even(CASE WHEN f <= 0 THEN 0 ELSE greatest(0, least(100, (1 - seen / (f * reads)) * 100)) END, 2) AS read_saturation FROM p JOIN m USING (f)"""


@query("bin_saturation", _BIN_SATURATION, "loc")
def bin_saturation(spark, d):
    b = located(spark, d).withColumn("origin", F.col("barcode")).withColumn("barcode", spatial.bin_label(F.col("x"), F.col("y")))
    return saturation.saturation_curve(b, origin="origin")


@query("segment_match", "WITH w AS (SELECT s_suppkey AS p, substr(barcode, 1, 4) AS e FROM (SELECT s_suppkey, %s AS barcode FROM supplier)), n AS (SELECT p, e, e AS seq FROM w UNION ALL SELECT p, e, substr(e, 1, i - 1) || b || substr(e, i + 1) FROM w, unnest([1, 2, 3, 4]) AS t(i), unnest(['A', 'C', 'G', 'T', 'N']) AS u(b)), t AS (SELECT seq, arg_max(e, p) AS entry FROM n GROUP BY 1) SELECT a.entry || b.entry AS barcode, count(*) AS reads FROM reads JOIN t a ON substr(reads.seq, 1, 4) = a.seq JOIN t b ON substr(reads.seq, 5, 4) = b.seq GROUP BY 1" % X.dna("(s_suppkey * 7919) % 65536", 8), "reads")
def segment_match(spark, d):
    r = X.frame(spark, d, X.READS).select(F.substring("seq", 1, 4).alias("s1"), F.substring("seq", 5, 4).alias("s2"))
    return demux.match_segments(r, whitelist_mismatch_dict(spark, d), ["s1", "s2"]).groupBy("barcode").agg(F.count("*").alias("reads"))


@query("threshold_max_entropy", f"WITH h AS ({_LEVELS}), p AS (SELECT level, n::double / sum(n) OVER () AS p FROM h), c AS (SELECT level, sum(p) OVER (ORDER BY level) AS c, sum(p * ln(p)) OVER (ORDER BY level) AS e, sum(p * ln(p)) OVER () AS a FROM p) SELECT level AS threshold FROM c WHERE 1 - c > 1e-12 ORDER BY round(ln(c) - e / c + ln(1 - c) - (a - e) / (1 - c), 9) DESC, level LIMIT 1")
def threshold_max_entropy(spark, d):
    return raster.max_entropy(levels(spark, d))


@query("label_remap", "SELECT row, col, CASE WHEN label % 2 = 0 AND label > 0 THEN label // 2 ELSE 0 END AS label FROM lab", "lab")
def label_remap(spark, d):
    ids = spark.range(1, 300).select((F.col("id") * 2).cast("int").alias("label"), F.col("id").cast("int").alias("new_label"))
    return raster.remap(X.frame(spark, d, X.LABELS), ids)


@query("feature_names", "SELECT gene, name FROM (SELECT regexp_extract(attrs, 'gene_id \"([^\"]*)\"', 1) AS gene, arg_max(regexp_extract(attrs, 'gene_name \"([^\"]*)\"', 1), line) AS name FROM ann WHERE feature = 'gene' GROUP BY 1)", "ann")
def feature_names(spark, d):
    return annotation.gene_names(genes(spark, d))


@query("depth_windows", "SELECT event_type, count(*) AS n FROM events GROUP BY date_trunc('hour', ts), event_type")
def depth_windows(spark, d):
    from .streaming.ingest import windowed_counts

    return windowed_counts(spark.read.parquet(f"{d}/events.parquet"), "ts", "1 hour", "2 hours", ["event_type"]).select("event_type", "n")


# Cases that reach the edges of the features above

_KNEE_ALL = """r AS (SELECT s_acctbal AS v, s_suppkey AS barcode, cast(floor(abs(s_acctbal)) as bigint) + 1 AS umi FROM supplier UNION ALL SELECT c_acctbal, c_custkey + 1000000, cast(floor(abs(c_acctbal)) as bigint) + 1 FROM customer),
y AS (SELECT umi, row_number() OVER (ORDER BY umi DESC, barcode) AS k, count(*) OVER () AS n, log10(umi + 1.0::double) AS y FROM r)"""


def balances(spark, d):
    """More than a hundred counts: those of suppliers and customers."""
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("barcode"), "s_acctbal")
    c = spark.read.parquet(f"{d}/customer.parquet").select((F.col("c_custkey") + 1000000).alias("barcode"), "c_acctbal")
    return s.union(c).select("barcode", (F.floor(F.abs("s_acctbal")) + 1).cast("long").alias("umi"))


@query(
    "knee_point_large",
    f"""WITH {_KNEE_ALL},
g AS (SELECT *, CASE WHEN lag(y) OVER w IS NULL THEN lead(y) OVER w - y WHEN lead(y) OVER w IS NULL THEN y - lag(y) OVER w ELSE (lead(y) OVER w - lag(y) OVER w) / 2 END AS g FROM y WINDOW w AS (ORDER BY k)),
h AS (SELECT *, round(CASE WHEN lag(g) OVER w IS NULL THEN lead(g) OVER w - g WHEN lead(g) OVER w IS NULL THEN g - lag(g) OVER w ELSE (lead(g) OVER w - lag(g) OVER w) / 2 END, 9) AS h FROM g WINDOW w AS (ORDER BY k))
SELECT cast(greatest((SELECT k FROM h WHERE k <= n // 2 ORDER BY h, k LIMIT 1) - 1, 10) as int) AS knee""",
)
def knee_point_large(spark, d):
    return cells.knee(balances(spark, d))


@query(
    "curve_segments",
    f"""WITH RECURSIVE {_KNEE_ALL}, a AS (SELECT k - 1 AS i, n, CASE WHEN k - 1 = 1 THEN 0 ELSE sqrt(pow((ln((k - 1)::double) - ln((k - 2)::double)) / ln(n::double), 2) + pow((ln(umi::double) - lag(ln(umi::double)) OVER (ORDER BY k)) / ln((max(umi) OVER ())::double), 2)) END AS arc FROM y WHERE k >= 1),
s AS (SELECT i, n, sum(CASE WHEN i >= 1 THEN arc ELSE 0 END) OVER (ORDER BY i) AS s FROM a WHERE i >= 1),
c AS (SELECT 1::bigint AS cut, 0::double AS base, 1::bigint AS nexti UNION ALL SELECT x.i + 1, x.s, x.i + 1 FROM c, LATERAL (SELECT min(s.i) AS i, min(s.s) AS s FROM s WHERE s.i >= c.nexti AND s.i > c.cut + 20 AND s.s - c.base >= 0.02) x WHERE x.i IS NOT NULL),
e AS (SELECT cut FROM c UNION SELECT max(n) FROM s)
SELECT cut AS first, lead(cut) OVER (ORDER BY cut) AS last FROM e QUALIFY last IS NOT NULL""",
)
def curve_segments(spark, d):
    return cells.curve_segments(balances(spark, d), 1)


@query(
    "cell_calling_dispatch",
    f"WITH h AS (SELECT umi, count(*) AS n FROM bs GROUP BY 1), c AS (SELECT umi, sum(n) OVER (ORDER BY umi DESC) AS upto FROM h), t AS (SELECT umi AS threshold FROM c ORDER BY abs(upto - {FORCED_CELLS}), umi DESC LIMIT 1) SELECT 'forced' AS method, barcode, CASE WHEN umi >= threshold THEN 'CB' ELSE 'UB' END AS mark FROM bs, t UNION ALL SELECT 'auto', barcode, CASE WHEN umi >= threshold THEN 'CB' ELSE 'UB' END FROM bs, auto",
    "auto",
)
def cell_calling_dispatch(spark, d):
    forced, auto = cells.call_cells(mol(spark, d), forced=FORCED_CELLS), cells.call_cells(mol(spark, d), "auto", expected=EXPECTED_CELLS)
    return forced.select(F.lit("forced").alias("method"), "barcode", "mark").unionByName(auto.select(F.lit("auto").alias("method"), "barcode", "mark"))


@query(
    "whitelist_correct_20",
    """WITH o AS (SELECT DISTINCT barcode FROM seen20), e AS (SELECT DISTINCT barcode AS entry FROM entries20),
n AS (SELECT barcode, entry FROM o JOIN e ON instr(barcode, 'N') = 0 AND hamming(barcode, entry) <= 2
UNION SELECT barcode, entry FROM (SELECT barcode, replace(substr(barcode, 1, instr(barcode, 'N') - 1) || b || substr(barcode, instr(barcode, 'N') + 1), 'N', 'T') AS t FROM o, unnest(['A', 'C', 'G', 'T']) AS u(b) WHERE instr(barcode, 'N') > 0) JOIN e ON t = entry),
k AS (SELECT barcode, count(*) AS n, min(entry) AS e, bool_or(entry = barcode) AS exact FROM n GROUP BY 1)
SELECT barcode, CASE WHEN exact THEN barcode WHEN n = 1 THEN e END AS corrected FROM o LEFT JOIN k USING (barcode)""",
    "seen20", "entries20",
)
def whitelist_correct_20(spark, d):
    return demux.correct_barcodes(X.frame(spark, d, X.LONG_SEEN), X.frame(spark, d, X.LONG_ENTRIES), 20, 2)


#: A box that is not the raster: another origin, and scales of 400 / 430 and 300 / 320.
SCALED_BOX = (5.0, -10.0, 430.0, 320.0)
_GRID = {
    "floor": "SELECT wide.*, cast(floor((y + 10) * (300 / 320e0)) as int) AS row, cast(floor((x - 5) * (400 / 430e0)) as int) AS col FROM wide",
    "round": "SELECT wide.*, cast(round_even((y + 10) * (300 / 320e0), 0) as int) AS row, cast(round_even((x - 5) * (400 / 430e0), 0) as int) AS col FROM wide",
}


def wide(spark, d):
    return X.frame(spark, d, X.WIDE)


for _how in ("floor", "round"):

    @query(f"label_assignment_scaled_{_how}", f"WITH g AS ({_GRID[_how]}) SELECT barcode, x, y, g.row, g.col, g.row BETWEEN 0 AND 299 AND g.col BETWEEN 0 AND 399 AS in_bounds, coalesce(label, 0) AS cell_id FROM g LEFT JOIN lab ON g.row = lab.row AND g.col = lab.col AND label <> 0", "wide", "lab")
    def label_assignment_scaled(spark, d, how=_how):
        return spatial.assign_labels(wide(spark, d), X.frame(spark, d, X.LABELS), SCALED_BOX, SHAPE, how)


@query("mask_filter_scaled_keep", f"WITH g AS ({_GRID['floor']}) SELECT barcode, x, y FROM g SEMI JOIN mask ON g.row = mask.row AND g.col = mask.col", "wide", "mask")
def mask_filter_scaled_keep(spark, d):
    return spatial.keep_in_mask(wide(spark, d), X.frame(spark, d, X.MASK), SCALED_BOX, SHAPE)


@query("mask_filter_scaled_invert", f"WITH g AS ({_GRID['floor']}) SELECT barcode, x, y FROM g ANTI JOIN mask ON g.row = mask.row AND g.col = mask.col WHERE g.row BETWEEN 0 AND 299 AND g.col BETWEEN 0 AND 399", "wide", "mask")
def mask_filter_scaled_invert(spark, d):
    return spatial.keep_in_mask(wide(spark, d), X.frame(spark, d, X.MASK), SCALED_BOX, SHAPE, invert=True)


@query("mask_filter_half_pixels", "WITH m AS (SELECT DISTINCT row + a AS row, col + b AS col FROM mask, range(-1, 2) AS t(a), range(-1, 2) AS u(b)) SELECT wide.* FROM wide ANTI JOIN m ON cast(round_even(y, 0) as int) = m.row AND cast(round_even(x, 0) as int) = m.col", "wide", "mask")
def mask_filter_half_pixels(spark, d):
    return spatial.remove_in_mask(wide(spark, d), X.frame(spark, d, X.MASK), 1)


@query("cell_geometry_scaled", "SELECT label, count(*) AS area_px, round(avg(row), 6) AS centroid_row_px, round(avg(col), 6) AS centroid_col_px, round((avg(row) + 0.5e0) * (320e0 / 300) - 10, 6) AS pxl_row_in_fullres, round((avg(col) + 0.5e0) * (430e0 / 400) + 5, 6) AS pxl_col_in_fullres FROM lab WHERE label <> 0 GROUP BY 1", "lab")
def cell_geometry_scaled(spark, d):
    return spatial.label_geometry(X.frame(spark, d, X.LABELS), SCALED_BOX, SHAPE)


def _bin_word(m: int, p: int) -> str:
    rows, cols = -(-300 // p), -(-400 // p)
    return X.dna(f"((y // {p}) * {cols} + x // {p})", ((rows * cols - 1).bit_length() + 1) // 2)


@query("bin_barcodes", f"SELECT DISTINCT cast(m as int) AS bin_um, cast(y // p as int) AS bin_row, cast(x // p as int) AS bin_col, CASE m {' '.join(f'WHEN {m} THEN {_bin_word(m, p)}' for m, p in ((10, 20), (20, 40), (50, 100), (100, 200)))} END AS bin FROM pos, (VALUES (10, 20), (20, 40), (50, 100), (100, 200)) AS s(m, p)", "pos")
def bin_barcodes(spark, d):
    return spatial.square_bins(X.frame(spark, d, X.POSITIONS), 400, 300).select("bin_um", "bin_row", "bin_col", "bin").distinct()


# Matrices


def matrix_of(spark, d, first: int = 0, last: int = 50):
    """The count matrix of some genes, barcodes numbered by name."""
    m = mol(spark, d)
    barcodes = m.select("barcode").distinct()
    names = matrix.numbered(barcodes, "barcode_idx", "barcode").select("barcode_idx", "barcode")
    gene = F.concat(F.lit("G"), F.lpad(F.col("id").cast("string"), 3, "0"))
    features = spark.range(first, last).select((F.col("id") - first + 1).cast("int").alias("feature_idx"), gene.alias("gene"), gene.alias("name"))
    values = m.join(features, "gene").join(names, "barcode").groupBy("feature_idx", "barcode_idx").agg(F.count("*").alias("value"))
    return matrix.Matrix(features, names, values)


@query("matrix_concat", "WITH b AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS i FROM (SELECT DISTINCT barcode FROM cd)) SELECT cast(substr(gene, 2) as int) + 1 AS feature_idx, cast(i as int) AS barcode_idx, count(*) AS value FROM cd JOIN b USING (barcode) GROUP BY 1, 2", "cd")
def matrix_concat(spark, d):
    return matrix.concat_features(matrix_of(spark, d, 0, 20), matrix_of(spark, d, 20, 50)).values


@query("matrix_slice", "WITH b AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS i FROM (SELECT DISTINCT barcode FROM cd)), w AS (SELECT i, row_number() OVER (ORDER BY i DESC) AS j FROM b WHERE i % 3 = 1) SELECT cast(substr(gene, 2) as int) + 1 AS feature_idx, cast(j as int) AS barcode_idx, count(*) AS value FROM cd JOIN b USING (barcode) JOIN w USING (i) GROUP BY 1, 2", "cd")
def matrix_slice(spark, d):
    m = matrix_of(spark, d)
    wanted = m.barcodes.filter("barcode_idx % 3 = 1").select((-F.col("barcode_idx")).alias("position"), "barcode_idx")
    return matrix.slice_barcodes(m, wanted).values


@query("matrix_common_barcodes", "WITH a AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS i FROM (SELECT DISTINCT barcode FROM cd)), b AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS j FROM pos WHERE x > 100) SELECT barcode, cast(i as int) AS a_idx, cast(j as int) AS b_idx FROM a JOIN b USING (barcode)", "cd", "pos")
def matrix_common_barcodes(spark, d):
    b = matrix.numbered(X.frame(spark, d, X.POSITIONS).filter("x > 100").select("barcode"), "barcode_idx", "barcode")
    return matrix.common_barcodes(matrix_of(spark, d).barcodes, b)


_STAY = "m AS (SELECT DISTINCT row + a AS row, col + b AS col FROM mask, range(-1, 2) AS t(a), range(-1, 2) AS u(b)), k AS (SELECT barcode FROM wide ANTI JOIN m ON cast(round_even(y, 0) as int) = m.row AND cast(round_even(x, 0) as int) = m.col)"


@query("bin_folder_filter", f"WITH {_STAY}, b AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS i FROM (SELECT DISTINCT barcode FROM cd) WHERE barcode IN (SELECT barcode FROM k)) SELECT cast(substr(gene, 2) as int) + 1 AS feature_idx, cast(i as int) AS barcode_idx, count(*) AS value FROM cd JOIN b USING (barcode) GROUP BY 1, 2", "cd", "wide", "mask")
def bin_folder_filter(spark, d):
    return matrix.filter_by_mask(matrix_of(spark, d), wide(spark, d), X.frame(spark, d, X.MASK), 1)[0].values


@query("bin_folder_summary", f"WITH {_STAY}, n AS (SELECT count(DISTINCT barcode) AS total_barcodes, count(DISTINCT barcode) FILTER (WHERE barcode IN (SELECT barcode FROM k)) AS kept_barcodes FROM cd) SELECT *, total_barcodes - kept_barcodes AS removed_barcodes, (total_barcodes - kept_barcodes)::double / total_barcodes AS removed_fraction FROM n", "cd", "wide", "mask")
def bin_folder_summary(spark, d):
    return matrix.filter_by_mask(matrix_of(spark, d), wide(spark, d), X.frame(spark, d, X.MASK), 1)[2]


# Annotation files

_GTF_ROWS = "r AS (SELECT line, string_split(value, chr(9)) AS p, regexp_extract(value, 'gene_id \"([^\"]*)\"', 1) AS gene, regexp_extract(value, 'gene_biotype \"([^\"]*)\"', 1) AS kind FROM gtf), g AS (SELECT line, p[1] AS seqid, p[2] AS source, p[3] AS feature, p[4]::bigint AS start_pos, p[5]::bigint AS end_pos, p[6] AS score, p[7] AS strand, p[8] AS frame, p[9] AS attrs, gene, kind FROM r)"


def gtf_rows(spark, d):
    return annotation.read_gtf(X.frame(spark, d, X.GTF))


@query("gtf_rows", f"WITH {_GTF_ROWS} SELECT line, seqid, source, feature, start_pos, end_pos, score, strand, frame, attrs FROM g", "gtf")
def read_gtf_rows(spark, d):
    return gtf_rows(spark, d)


@query(
    "gtf_built",
    f"""WITH {_GTF_ROWS}, q AS (SELECT gene, min(line) AS gene_line FROM g WHERE feature = 'gene' GROUP BY 1), l AS (SELECT g.*, gene_line FROM g LEFT JOIN q USING (gene) WHERE feature = 'exon' AND (gene_line IS NULL OR gene_line > line)),
f AS (SELECT gene, min(line) AS line, arg_min(strand, line) AS strand, arg_min(seqid, line) AS seqid, arg_min(attrs, line) AS attrs FROM l GROUP BY 1),
d AS (SELECT l.line FROM l JOIN f USING (gene) WHERE l.strand <> f.strand),
a AS (SELECT f.seqid, 'added' AS source, 'gene' AS feature, min(l.start_pos) AS start_pos, max(l.end_pos) AS end_pos, f.strand, f.attrs FROM l JOIN f USING (gene) WHERE gene_line IS NULL AND l.strand = f.strand GROUP BY gene, f.seqid, f.strand, f.attrs)
SELECT seqid, source, feature, start_pos, end_pos, strand, attrs FROM g WHERE kind = 'coding' AND line NOT IN (SELECT line FROM d) UNION ALL SELECT * FROM a""",
    "gtf",
)
def gtf_built(spark, d):
    return annotation.build_gtf(gtf_rows(spark, d), {"gene_biotype": ["coding"]}).select("seqid", "source", "feature", "start_pos", "end_pos", "strand", "attrs")


# Reports, jobs


@query("retained_summary", "SELECT avg(o_totalprice) FILTER (WHERE o_orderkey % 3 > 0) AS mean_reads_per_cell, median(o_custkey::double) FILTER (WHERE o_orderkey % 3 > 0) AS median_cell_area_px2, median((o_orderkey % 17)::double) FILTER (WHERE o_orderkey % 3 > 0) AS median_barcodes_per_cell FROM (SELECT o_orderkey, o_custkey, floor(o_totalprice) AS o_totalprice FROM orders)")
def retained_summary(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    text = [F.col("o_orderkey") % 3, F.floor("o_totalprice"), F.col("o_custkey"), F.col("o_orderkey") % 17]
    return reports.retained_summary(o.select(*[c.cast("string").alias(n) for c, n in zip(text, ("retained", "reads", "area_px", "assigned_barcodes"), strict=True)]))


@query("bin_tissue", "SELECT 'b' || (x // 20)::varchar || '_' || (y // 20)::varchar AS bin, bool_or(mask.row IS NOT NULL) AS in_tissue FROM pos LEFT JOIN mask ON y = mask.row AND x = mask.col GROUP BY 1", "pos", "mask")
def bin_tissue(spark, d):
    at = X.frame(spark, d, X.POSITIONS).join(X.frame(spark, d, X.MASK).select(F.col("row").alias("y"), F.col("col").alias("x"), F.lit(1).alias("in_tissue")), ["y", "x"], "left")
    return reports.bin_tissue(at.select(F.concat(F.lit("b"), F.floor(F.col("x") / 20).cast("string"), F.lit("_"), F.floor(F.col("y") / 20).cast("string")).alias("bin"), "in_tissue"))


@query(
    "bin_report",
    "WITH p AS (SELECT * FROM pos WHERE x % 4 <> 0), l AS (SELECT cd.*, x // 20 AS bcol, y // 20 AS brow FROM cd LEFT JOIN p USING (barcode)), b AS (SELECT bcol, brow, sum(cnt) AS readcount, count(*) AS umi, count(DISTINCT gene) AS genes FROM l WHERE bcol IS NOT NULL GROUP BY 1, 2), n AS (SELECT count(*) FILTER (WHERE bcol IS NULL) AS unmatched_rows, cast(sum(cnt) as bigint) AS all_reads FROM l) SELECT count(*) AS bins, cast(sum(readcount) as bigint) AS reads_in_bins, median(umi) AS median_umi, median(genes) AS median_genes, round(avg(umi), 6) AS mean_umi, any_value(unmatched_rows) AS unmatched_rows, any_value(all_reads) AS all_reads, round(sum(readcount)::double / 1000000, 6) AS exonic_share FROM b, n",
    "cd", "pos",
)
def bin_report(spark, d):
    p = X.frame(spark, d, X.POSITIONS).filter("x % 4 <> 0")
    return reports.bin_report(mol(spark, d).join(p, "barcode", "left"), F.when(F.col("x").isNotNull(), spatial.bin_label(F.col("x"), F.col("y"))), 1_000_000)


@query(
    "run_preflight",
    """WITH j AS (SELECT cast(n_regionkey as bigint) AS job, n_nationkey AS ord, 'd/' || n_regionkey::varchar || '/' || n_nationkey::varchar AS out, CASE WHEN n_nationkey % 3 = 0 THEN 'raw/' || n_nationkey::varchar ELSE 'd/' || n_regionkey::varchar || '/' || (n_nationkey - n_nationkey % 4)::varchar || '/part' END AS inp FROM nation),
there AS (SELECT 'raw/' || n_nationkey::varchar AS path FROM nation WHERE n_nationkey % 2 = 0 UNION SELECT out FROM j WHERE ord % 5 = 1)
SELECT job, 's' || ord::varchar AS step, 'missing input' AS problem, inp AS path FROM j WHERE ord % 7 <> 0 AND inp NOT IN (SELECT path FROM there) AND NOT EXISTS (SELECT 1 FROM j k WHERE k.job = j.job AND k.ord < j.ord AND starts_with(j.inp || '/', k.out || '/'))
UNION ALL SELECT job, 's' || ord::varchar, 'existing output', out FROM j WHERE ord % 7 <> 0 AND out IN (SELECT path FROM there)""",
)
def run_preflight(spark, d):
    n, r = F.col("n_nationkey"), F.col("n_regionkey").cast("string")
    base = spark.read.parquet(f"{d}/nation.parquet").select(
        F.col("n_regionkey").cast("long").alias("job"), n.alias("position"), F.concat(F.lit("s"), n.cast("string")).alias("step"), (n % 7 == 0).alias("skipped"), F.concat(F.lit("d/"), r, F.lit("/"), n.cast("string")).alias("out"),
        F.when(n % 3 == 0, F.concat(F.lit("raw/"), n.cast("string"))).otherwise(F.concat(F.lit("d/"), r, F.lit("/"), (n - n % 4).cast("string"), F.lit("/part"))).alias("inp"),
    )
    rows = base.select("job", "position", "step", "skipped", F.lit("output").alias("role"), F.col("out").alias("path")).unionByName(base.select("job", "position", "step", "skipped", F.lit("input").alias("role"), F.col("inp").alias("path")))
    there = base.filter("position % 2 = 0").select(F.concat(F.lit("raw/"), F.col("position").cast("string")).alias("path")).unionByName(base.filter("position % 5 = 1").select(F.col("out").alias("path")))
    return jobs.preflight(rows, there)


# Sequences


@query("neighbour_counts", "SELECT s_suppkey, cast(3 * w + 9 * w * (w - 1) / 2 as bigint) AS within_two FROM (SELECT s_suppkey, s_suppkey % 20 + 1 AS w FROM supplier)")
def neighbour_counts(spark, d):
    made = spark.createDataFrame([(w, S.neighbours(w, 2)) for w in range(1, 21)], "w long, within_two long")
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", (F.col("s_suppkey") % 20 + 1).alias("w")).join(made, "w").select("s_suppkey", "within_two")


@query("poly_t_reads", "SELECT l_orderkey, l_linenumber, length(regexp_replace(t, '[^T]', '', 'g')) >= 10 AS poly_t FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, repeat('T', cast(l_partkey % 19 as int)) || repeat('A', cast(18 - l_partkey % 19 as int)) AS t FROM lineitem)")
def poly_t_reads(spark, d):
    n = (F.col("l_partkey") % 19).cast("int")
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    return rows.select("l_orderkey", "l_linenumber", S.poly_t(F.concat(F.repeat(F.lit("T"), n), F.repeat(F.lit("A"), F.lit(18) - n))).alias("poly_t"))


@query("displaced_linkers", "SELECT s_suppkey, cast(s_suppkey % 4 as int) AS shift FROM supplier")
def displaced_linkers(spark, d):
    k = F.col("s_suppkey")
    word = F.concat(F.lit("GATTACAGATTACAG"[:11]), F.repeat(F.lit("T"), (k % 4).cast("int")), F.overlay(F.lit(X.LINKER), F.when(k % 3 == 0, F.lit("A")).otherwise(F.lit("C")), F.lit(1), F.lit(1)), F.lit("ACGTACGT"))
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", S.displaced_linker(word, X.LINKER, 11).alias("shift"))


@query("gene_flags", "SELECT p_partkey, starts_with(upper(g), 'MT-') AS mt, regexp_matches(upper(g), '^RP[SL]') AS ribo, regexp_matches(upper(g), '^HB[^(P)]') AS hb FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'mt-Nd' WHEN 1 THEN 'Rps' WHEN 2 THEN 'HBA' WHEN 3 THEN 'HBP' WHEN 4 THEN 'RPL' ELSE 'MTOR' END || p_partkey::varchar AS g FROM part)")
def gene_flags(spark, d):
    names = F.element_at(F.array(*[F.lit(x) for x in ("mt-Nd", "Rps", "HBA", "HBP", "RPL", "MTOR")]), (F.col("p_partkey") % 6 + 1).cast("int"))
    mt, ribo, hb = expression.gene_flags(F.concat(names, F.col("p_partkey").cast("string")))
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", mt.alias("mt"), ribo.alias("ribo"), hb.alias("hb"))


@query("graph_connectivities")
def graph_connectivities(spark, d):
    return expression.connectivities(knn_exact(spark, d))


@query("modularity_communities")
def modularity_communities(spark, d):
    return expression.merge_communities(graph_connectivities(spark, d))
