"""Projections of the benchmark tables onto the relations the operators read.

Each is one SELECT that Spark and any ANSI engine run alike; names in braces are
the source tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def bases(n: str, width: int) -> list[str]:
    """SQL for each base of the DNA word of a number, two bits a base."""
    return [f"substr('ACGT', cast(floor(({n}) / {4**k}e0) as int) % 4 + 1, 1)" for k in reversed(range(width))]


def dna(n: str, width: int) -> str:
    """SQL for the whole word."""
    return " || ".join(bases(n, width))


_BARCODE = dna("({}suppkey * 7919) % 65536", 8)
LINKER = "CTCGTGTGAAGACAG"

#: barcode, gene, umi, cnt: reads per molecule.
MOLECULES = f"""SELECT {_BARCODE.format(*["l_"] * 8)} AS barcode, 'G' || lpad(cast(l_partkey % 50 as string), 3, '0') AS gene,
{dna("l_orderkey % 256", 4)} AS umi, cast(sum(l_quantity) as bigint) AS cnt FROM {{lineitem}} GROUP BY 1, 2, 3"""

#: barcode, x, y on a canvas of 400 columns and 300 rows.
POSITIONS = f"SELECT {_BARCODE.format(*['s_'] * 8)} AS barcode, cast((s_suppkey * 37) % 400 as int) AS x, cast((s_suppkey * 91) % 300 as int) AS y FROM {{supplier}}"

#: One sequenced read per line: 8 bases of barcode, linker, 4 bases of UMI, T's; every third has a wrong base.
_B = bases("(l_suppkey * 7919) % 65536", 8)
READS = f"""SELECT l_orderkey, l_linenumber, l_partkey,
{" || ".join(_B[:2])} || CASE WHEN l_linenumber <> 3 THEN {_B[2]} WHEN {_B[2]} = 'A' THEN 'C' ELSE 'A' END || {" || ".join(_B[3:])}
|| '{LINKER}' || {dna("l_orderkey % 256", 4)} || 'TTTTTTTTTTTTTTTTTT' AS seq,
repeat('I', cast(l_partkey % 45 as int)) || '#' || repeat('I', cast(44 - l_partkey % 45 as int)) AS qual
FROM {{lineitem}}"""

_LONG = f"{dna('({}suppkey * 7919) % 65536', 8)} || {dna('({}suppkey * 1047) % 65536', 8)} || {dna('{}suppkey % 256', 4)}"


def _long(prefix: str) -> str:
    return _LONG.replace("{}", prefix)


def flipped(word: str, *places: int) -> str:
    """SQL for a word with other bases at these places."""
    for p in places:
        word = f"substr({word}, 1, {p - 1}) || CASE WHEN substr({word}, {p}, 1) = 'A' THEN 'C' ELSE 'A' END || substr({word}, {p + 1})"
    return word


#: Words of 20 bases: most suppliers, some with a second entry one or two bases away, and the word of A's.
LONG_ENTRIES = f"""SELECT w AS barcode FROM (SELECT s_suppkey AS k, {_long('s_')} AS w FROM {{supplier}}) AS e WHERE k % 4 <> 0
UNION SELECT {flipped('w', 20)} FROM (SELECT s_suppkey AS k, {_long('s_')} AS w FROM {{supplier}}) AS e WHERE k % 5 = 1
UNION SELECT {flipped('w', 3, 11)} FROM (SELECT s_suppkey AS k, {_long('s_')} AS w FROM {{supplier}}) AS e WHERE k % 5 = 2 UNION SELECT 'AAAAAAAAAAAAAAAAAAAA'"""

#: Observed words by line number: as they are, one to three other bases, one N or two, and near the word of A's.
LONG_SEEN = f"""SELECT CASE n WHEN 1 THEN w WHEN 2 THEN {flipped('w', 7)} WHEN 3 THEN {flipped('w', 7, 15)} WHEN 4 THEN substr(w, 1, 4) || 'N' || substr(w, 6) WHEN 5 THEN substr(w, 1, 4) || 'N' || substr(w, 6, 5) || 'N' || substr(w, 12)
WHEN 6 THEN {flipped('w', 2, 7, 15)} ELSE CASE WHEN k % 3 = 0 THEN 'AAAAAAAAAAAAAAAAAAAA' ELSE 'AAAAACAAAAAAAAAAAAA' || substr(w, 20) END END AS barcode
FROM (SELECT DISTINCT l_suppkey AS k, l_linenumber AS n, {_long('l_')} AS w FROM {{lineitem}}) AS r"""

#: barcode, x, y around a scaled box: some outside of it, some on half pixels.
WIDE = f"SELECT {_BARCODE.format(*['s_'] * 8)} AS barcode, cast((s_suppkey * 37) % 460 - 20 as double) + CASE WHEN s_suppkey % 2 = 0 THEN 0.5e0 ELSE 0e0 END AS x, cast((s_suppkey * 91) % 360 - 30 as double) + CASE WHEN s_suppkey % 3 = 0 THEN 0.5e0 ELSE 0e0 END AS y FROM {{supplier}}"

#: Lines of a GTF: genes that come before, after or without their exons, exons on both strands, biotypes.
GTF = """SELECT p_partkey * 4 + k AS line, 'chr' || cast(p_partkey % 3 as string) || chr(9) || 'src' || chr(9) || CASE WHEN k = CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 3 END THEN 'gene' ELSE 'exon' END
|| chr(9) || cast(p_partkey * 10 + k as string) || chr(9) || cast(p_partkey * 10 + k + 50 as string) || chr(9) || '.' || chr(9) || CASE WHEN (p_partkey + k) % 7 = 0 THEN '-' ELSE '+' END || chr(9) || '.' || chr(9)
|| 'gene_id "G' || cast(p_partkey as string) || '"; gene_biotype "' || CASE WHEN p_partkey % 11 = 0 THEN 'other' ELSE 'coding' END || '";' AS value
FROM {part}, (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) AS kinds WHERE NOT (k = 3 AND p_partkey % 3 = 2)"""

#: cell, gene, value: a small expression matrix in long form, with its cluster.
EXPRESSION = {
    "spark": "SELECT vec_id AS cell, label AS cluster, cast(pos as int) AS gene, cast(floor(greatest(cast(0 as double), cast(v as double)) * 100) as int) AS value FROM {embeddings} LATERAL VIEW posexplode(embedding) AS pos, v",
    "sql": "SELECT vec_id AS cell, label AS cluster, cast(g - 1 as int) AS gene, cast(floor(greatest(0::double, embedding[g]::double) * 100) as int) AS value FROM embeddings, unnest(range(1, 65)) AS t(g)",
}

#: Lines of an annotation: genes, and one transcript and exon under each.
ANNOTATION = """SELECT p_partkey * 3 + k AS line, CASE k WHEN 0 THEN 'gene' WHEN 1 THEN 'mRNA' ELSE 'exon' END AS feature,
cast(p_partkey * 10 + k as bigint) AS start_pos, cast(p_partkey * 10 + k + 100 as bigint) AS end_pos, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END AS strand,
CASE k WHEN 0 THEN 'gene_id "G' || cast(p_partkey % 50 as string) || '"; gene_name "' || p_brand || '";'
WHEN 1 THEN 'ID=rna:T' || cast(p_partkey as string) || ';Parent=gene:G' || cast(p_partkey % 50 as string)
ELSE 'ID=E' || cast(p_partkey as string) || ';Parent=rna:T' || cast(p_partkey as string) || CASE WHEN p_partkey % 7 = 0 THEN ',gene:G1' ELSE '' END END AS attrs
FROM {part}, (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) AS kinds"""

#: A label raster of 300 rows and 400 columns in tiles of 16 with gaps.
LABELS = {
    "spark": "SELECT cast(r.id as int) AS row, cast(c.id as int) AS col, cast(CASE WHEN (r.id + c.id) % 16 < 3 THEN 0 ELSE (r.id div 16) * 25 + (c.id div 16) + 1 END as int) AS label FROM range(300) AS r CROSS JOIN range(400) AS c",
    "sql": "SELECT cast(r as int) AS row, cast(c as int) AS col, cast(CASE WHEN (r + c) % 16 < 3 THEN 0 ELSE (r // 16) * 25 + (c // 16) + 1 END as int) AS label FROM range(300) AS a(r), range(400) AS b(c)",
}

#: Foreground pixels of a disc.
MASK = {
    "spark": "SELECT cast(r.id as int) AS row, cast(c.id as int) AS col FROM range(300) AS r CROSS JOIN range(400) AS c WHERE (c.id - 200) * (c.id - 200) + (r.id - 150) * (r.id - 150) <= 19600",
    "sql": "SELECT cast(r as int) AS row, cast(c as int) AS col FROM range(300) AS a(r), range(400) AS b(c) WHERE (c - 200) * (c - 200) + (r - 150) * (r - 150) <= 19600",
}

#: File names in three layouts.
FILES = """SELECT 'S' || cast(s_suppkey as string) || CASE s_suppkey % 3 WHEN 0 THEN '_S1_L00' || cast(s_suppkey % 4 + 1 as string) || '_R' || cast(k as string) || '_001.fastq.gz'
WHEN 1 THEN '_fold' || cast(s_suppkey % 5 + 1 as string) || '_' || cast(k as string) || '.fastq.gz' ELSE '_R' || cast(k as string) || '.fq.gz' END AS file
FROM {supplier}, (SELECT 1 AS k UNION ALL SELECT 2) AS mates WHERE NOT (s_suppkey % 10 = 7 AND k = 2)"""


def sql(text: str | dict) -> str:
    """The relation for an ANSI engine, over tables of their own names."""
    return text["sql"] if isinstance(text, dict) else re.sub(r"\{(\w+)\}", r"\1", text)


def frame(spark: SparkSession, sf_dir: str, text: str | dict) -> DataFrame:
    """The relation as a DataFrame over the Parquet tables of a folder."""
    text = text["spark"] if isinstance(text, dict) else text
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", text))})
