"""Readers and writers of the small text formats around the matrices."""

from __future__ import annotations

import csv
import io
import json
import os
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a text file, 1-based, in file order; for the small side tables of a matrix."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    return lines.select(F.row_number().over(Window.orderBy("at")).alias("line_no"), "value")


def read_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """(gene, name, barcode, value) of a Matrix Market folder with features and barcodes."""
    lines = spark.read.text(f"{folder}/matrix.mtx*").filter(~F.col("value").startswith("%"))
    size = lines.first()["value"]  # the first line that is no comment holds the dimensions
    p = F.split(F.trim("value"), r"\s+")
    cells = lines.select("value", p[0].cast("int").alias("i"), p[1].cast("int").alias("j"), p[2].cast("long").alias("value_"))
    n, m, total = (int(x) for x in size.split())
    # an entry can spell the same as that line; of equal lines at that place one is dropped
    same = cells.filter(F.col("value") == size).count()
    rest = cells.filter(F.col("value") != size)
    if same > 1:
        rest = rest.unionByName(spark.createDataFrame([(size, n, m, total)], rest.schema))
    features = numbered_lines(spark, f"{folder}/features.tsv*").select(F.col("line_no").alias("i"), F.split("value", "\t")[0].alias("gene"), F.split("value", "\t")[1].alias("name"))
    barcodes = numbered_lines(spark, f"{folder}/barcodes.tsv*").select(F.col("line_no").alias("j"), F.trim("value").alias("barcode"))
    return rest.join(features, "i").join(barcodes, "j").select("gene", "name", "barcode", F.col("value_").alias("value"))


def _one_file(rows: DataFrame, path: str) -> None:
    """rows(value), already in one sorted partition, as the gzip text file of exactly this path."""
    spark, folder = rows.sparkSession, path + ".parts"
    rows.write.mode("overwrite").option("compression", "gzip").text(folder)
    context = spark.sparkContext
    made = context._jvm.org.apache.hadoop.fs.Path(folder)
    fs = made.getFileSystem(context._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(made) if f.getPath().getName().startswith("part-"))
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(made, True)


def write_matrix(triplets: DataFrame, features: DataFrame, barcodes: DataFrame, folder: str) -> None:
    """matrix.mtx.gz, features.tsv.gz and barcodes.tsv.gz: triplets(feature_idx, barcode_idx, value), features(feature_idx, gene, name), barcodes(barcode_idx, barcode).

    The format is one file each, so one task writes each of them from a sorted
    stream; nothing is held in memory.
    """
    n, f, b = triplets.count(), features.count(), barcodes.count()
    spark = triplets.sparkSession
    head = spark.createDataFrame([(0, 0, "%%MatrixMarket matrix coordinate integer general"), (0, 1, f"{f} {b} {n}")], "a long, b long, value string")
    body = triplets.select(F.col("barcode_idx").cast("long").alias("a"), F.col("feature_idx").cast("long").alias("b"), F.concat_ws(" ", "feature_idx", "barcode_idx", "value").alias("value"))
    _one_file(head.unionByName(body).repartition(1).sortWithinPartitions("a", "b").select("value"), f"{folder}/matrix.mtx.gz")
    kind = F.lit("Gene Expression")
    _one_file(features.repartition(1).sortWithinPartitions("feature_idx").select(F.concat_ws("\t", "gene", F.coalesce("name", "gene"), kind).alias("value")), f"{folder}/features.tsv.gz")
    _one_file(barcodes.repartition(1).sortWithinPartitions("barcode_idx").select(F.col("barcode").alias("value")), f"{folder}/barcodes.tsv.gz")


def read_whitelist(lines: DataFrame) -> DataFrame:
    """(barcode, x, y) of headerless x,y,barcode lines(line_no, value): trimmed, upper case, the first of repeated barcodes.

    A header line and empty barcodes are dropped; a coordinate that is no number
    is an error.
    """
    p = F.split("value", ",")
    rows = lines.select("line_no", F.trim(p[0]).alias("x"), F.trim(p[1]).alias("y"), F.upper(F.trim(F.get(p, F.lit(2)))).alias("barcode"))
    rows = rows.filter("barcode is not null and barcode <> '' and not (line_no = 1 and lower(x) = 'x')")
    first = rows.groupBy("barcode").agg(F.min_by(F.struct("x", "y"), "line_no").alias("p"))
    return first.select("barcode", F.col("p.x").cast("double").cast("int").alias("x"), F.col("p.y").cast("double").cast("int").alias("y"))


def parse_box(text: str) -> tuple[float, float, float, float]:
    """Four numbers of a comma, tab or blank separated text."""
    values = [float(x) for x in re.split(r"[,\s]+", text.strip()) if x]
    if len(values) != 4:
        raise ValueError(f"a box has four numbers: {text!r}")
    return tuple(values)


def read_positions(lines: DataFrame, in_tissue_only: bool = False) -> DataFrame:
    """(barcode, x, y) of position lines(value): x,y,barcode or barcode with tissue flag and pixels at columns 5 and 6; header lines drop out."""
    p = F.split("value", "[,\t]")
    wide = F.size(p) >= 6
    barcode = F.trim(F.when(wide, p[0]).otherwise(F.get(p, F.lit(2))))
    y, x = F.when(wide, F.get(p, F.lit(4))).otherwise(F.get(p, F.lit(1))), F.when(wide, F.get(p, F.lit(5))).otherwise(p[0])
    out = lines.select(barcode.alias("barcode"), F.trim(x).try_cast("double").alias("x"), F.trim(y).try_cast("double").alias("y"), F.when(wide, F.get(p, F.lit(1))).try_cast("int").alias("in_tissue"), F.lower(F.trim(p[0])).alias("_h"))
    out = out.filter("_h not in ('x', 'barcode')").drop("_h")
    return (out.filter("coalesce(in_tissue, 1) = 1") if in_tissue_only else out).drop("in_tissue")


def allowlist(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Distinct first fields of several files; None without paths."""
    return spark.read.text(paths).select(F.split(F.trim("value"), r"[,\s]")[0].alias("barcode")).filter("barcode <> ''").distinct() if paths else None


def count_columns(first_line: str) -> tuple[dict[str, int], bool]:
    """Places of barcode, gene, umi and cnt in a count table, and whether the line is a header."""
    cells = [c.strip().lower() for c in first_line.rstrip("\n").split("\t")]
    names = {"barcode": ("barcode",), "gene": ("geneid", "gene_id", "gene"), "umi": ("umi",), "cnt": ("count", "read_count")}
    found = {k: next((cells.index(a) for a in aliases if a in cells), None) for k, aliases in names.items()}
    if all(v is not None for v in found.values()):
        return found, True
    return {k: i for i, k in enumerate(names)}, False


def read_counts(spark: SparkSession, path: str, missing: int = 0) -> DataFrame:
    """Molecules of a count table; a count that is no number becomes ``missing``, and counts of 0 are dropped."""
    first = spark.read.text(path).first()
    where, header = count_columns(first["value"] if first else "")
    p = F.split("value", "\t")
    rows = spark.read.text(path).filter(F.col("value") != (first["value"] if header else "\x00"))
    out = rows.select(*[F.get(p, F.lit(where[k])).alias(k) for k in ("barcode", "gene", "umi")], F.coalesce(F.get(p, F.lit(where["cnt"])).try_cast("long"), F.lit(missing)).alias("cnt"))
    return out.filter("cnt > 0")


def clean_key(key: str) -> str:
    return key.lstrip("﻿").strip().replace("-", "_").lower()


#: The columns that a job table must have.
REQUIRED = ("workflow", "chip_number", "casno", "chemistry", "species", "method", "mode")


def read_jobs(text: str) -> list[dict[str, str]]:
    """Enabled rows of a job table; blank rows are skipped, missing columns are an error."""
    rows = [{clean_key(k or ""): (v or "").strip() for k, v in r.items()} for r in csv.DictReader(io.StringIO(text))]
    rows = [r for r in rows if any(r.values())]
    for r in rows[:1]:
        lost = [k for k in REQUIRED if k not in r]
        if lost:
            raise ValueError(f"columns are missing: {', '.join(lost)}")
    return [r for r in rows if enabled(r)]


def enabled(row: dict[str, str]) -> bool:
    return row.get("enabled", "1").strip().lower() in ("", "1", "true", "yes", "y", "on")


def load_config(text: str) -> dict:
    """A JSON object or KEY=VALUE lines with ${KEY} references to earlier lines or the environment."""
    if text.lstrip().startswith("{"):
        return json.loads(text)
    out: dict[str, str] = {}
    for line in text.splitlines():
        m = re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)=(.*)$", line)
        if m and not line.lstrip().startswith("#"):
            value = m[2].strip().strip("\"'")
            out[m[1]] = re.sub(r"\$\{?(\w+)\}?", lambda k: out.get(k[1], os.environ.get(k[1], "")), value)
    return out


def merge_configs(*configs: dict) -> dict:
    """Later values win; nested sections are merged."""
    out: dict = {}
    for c in configs:
        for k, v in c.items():
            out[k] = merge_configs(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def map_file(lines: DataFrame) -> DataFrame:
    """(sample, files) of lines "library path sample": paths of a sample joined by commas, in order."""
    p = F.split(F.trim("value"), r"\s+")
    rows = lines.filter("trim(value) <> '' and not startswith(trim(value), '#')").select("line_no", p[1].alias("path"), F.get(p, F.lit(2)).alias("sample"))
    return rows.groupBy("sample").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "path"))), lambda s: s["path"]), ",").alias("files"))


def log_metrics(lines: DataFrame) -> DataFrame:
    """(section, key, value, pct) of log lines(line_no, value) with "key: value" or "key | value" and "== section ==" headings."""
    heading = F.regexp_extract("value", r"^=+\s*(.*?)\s*=+$", 1)
    w = Window.orderBy("line_no")
    rows = lines.withColumn("section", F.last(F.nullif(heading, F.lit("")), ignorenulls=True).over(w))
    m = r"^\s*([^:|]+?)\s*[:|]\s*([\d.,]+)%?\s*(?:\(([\d.]+)%\))?\s*$"
    found = rows.filter(F.col("value").rlike(m))
    return found.select("section", F.regexp_extract("value", m, 1).alias("key"), F.regexp_replace(F.regexp_extract("value", m, 2), ",", "").try_cast("double").alias("value"), F.regexp_extract("value", m, 3).try_cast("double").alias("pct"))


def decoded_canvas(cells: DataFrame, width: int) -> DataFrame:
    """(x, y, barcode) of canvas cells(row, col, code); code 0 is empty."""
    from ..functions.seq import decode

    return cells.filter("code <> 0").select(F.col("col").alias("x"), F.col("row").alias("y"), decode(F.col("code"), width).alias("barcode"))


def tag_names(alignments: DataFrame, names: DataFrame) -> DataFrame:
    """Alignments with barcode, UMI and gene-name tags; several genes are mapped one by one and joined again."""
    p = F.split("query_name", "_")
    parts = alignments.select("*", p[0].alias("cb"), p[1].alias("ub"), F.posexplode_outer(F.split("genes", ",")).alias("i", "g"))
    named = parts.join(names, parts["g"] == names["gene"], "left").withColumn("n", F.coalesce("name", "g"))
    return named.groupBy("query_name", "genes", "cb", "ub").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "n"))), lambda s: s["n"]), ",").alias("gn"))
