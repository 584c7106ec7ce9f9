"""FASTQ: file names, pairs, a distributed reader, generated reads."""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The three layouts of file names, tried in this order.
STANDARD = r"^(.+?)_S(\d+)_L(\d+)_R([12])_(\d+)\.(?:fastq|fq)(?:\.gz)?$"
FOLD = r"^(.+)_fold(\d+)_([12])\.(?:fastq|fq)(?:\.gz)?$"
SIMPLE = r"^(.+)_R?([12])\.(?:fastq|fq)(?:\.gz)?$"


def parse_names(files: DataFrame, column: str = "file") -> DataFrame:
    """sample, sample_no, lane, read and chunk of file names; null where no layout fits."""
    name = F.substring_index(F.col(column), "/", -1)

    def pick(*options: tuple[str, int | str]) -> Column:
        out = F.lit(None).cast("string")
        for pattern, group in reversed(options):
            value = F.regexp_extract(name, pattern, group) if isinstance(group, int) else F.lit(group)
            out = F.when(name.rlike(pattern), value).otherwise(out)
        return out

    return files.select(
        column, pick((STANDARD, 1), (FOLD, 1), (SIMPLE, 1)).alias("sample"), pick((STANDARD, 2), (FOLD, "1"), (SIMPLE, "1")).cast("int").alias("sample_no"),
        pick((STANDARD, 3), (FOLD, 2), (SIMPLE, "1")).cast("int").alias("lane"), pick((STANDARD, 4), (FOLD, 3), (SIMPLE, 2)).cast("int").alias("read"), pick((STANDARD, 5), (FOLD, "1"), (SIMPLE, "1")).cast("int").alias("chunk"),
    )


def pair_files(parsed: DataFrame) -> DataFrame:
    """First and second mates side by side; a missing one is null."""
    keys = ["sample", "lane", "chunk"]
    r1 = parsed.filter("read = 1").select(*keys, F.col("file").alias("file1"))
    r2 = parsed.filter("read = 2").select(*keys, F.col("file").alias("file2"))
    return r1.join(r2, keys, "full").withColumn("paired", F.col("file1").isNotNull() & F.col("file2").isNotNull())


def _listed(spark: SparkSession, pattern: str) -> list[tuple[str, int, bool]]:
    """(path, bytes, is a file) of what a path or glob names, by path, in any store."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    return sorted((f.getPath().toString(), f.getLen(), f.isFile()) for f in found or [])


def expand_paths(spark: SparkSession, text: str) -> list[str]:
    """Paths of a glob (with * or ?), sorted, or itself if none fits; otherwise of a comma-separated list."""
    if "*" in text or "?" in text:
        return [p for p, _, _ in _listed(spark, text)] or [text]
    return [p.strip() for p in text.split(",")]


def order_mates(spark: SparkSession, first: str, second: str) -> tuple[list[str], list[str]]:
    """The files of both mates, expanded and sorted by sample and lane; names that fit no layout come first."""
    out = []
    for text in (first, second):
        files = spark.createDataFrame([(k, p) for k, p in enumerate(expand_paths(spark, text))], "k int, file string")
        rows = parse_names(files.select("file")).join(files, "file").orderBy(F.coalesce("sample", F.lit("")), F.coalesce("lane", F.lit(0)), "k")
        out.append([r["file"] for r in rows.select("file").collect()])
    return out[0], out[1]


class FastqError(ValueError):
    pass


# Layouts by priority, as globs of the first and second mates.
LAYOUTS = {
    "multi_lane": [("{name}_S*_L*_R1_*.{end}", "{name}_S*_L*_R2_*.{end}")],
    "fold": [(f"{{name}}_fold{k}_1.fq.gz", f"{{name}}_fold{k}_2.fq.gz") for k in range(1, 6)],
    "simple": [("{name}_1.fq.gz", "{name}_2.fq.gz")],
}


def detect_inputs(spark: SparkSession, folder: str, name: str, validate: bool = True) -> tuple[str, list[str], list[str]]:
    """(layout, first mates, second mates) of a sample's files, by the first layout that is there.

    Several lanes count if both mates have any, and must then be as many; folds
    and the simple layout count pair by pair.  An error if nothing is found or, if
    asked for, if a path is no file or an empty one.
    """
    if not _listed(spark, folder):
        raise FastqError(f"no folder {folder}")
    for layout, patterns in LAYOUTS.items():
        mates: tuple[list, list] = ([], [])
        for pair in patterns:
            ends = ("fastq.gz", "fq.gz") if layout == "multi_lane" else ("",)
            found = [sorted(x for end in ends for x in _listed(spark, f"{folder.rstrip('/')}/{p.format(name=name, end=end)}")) for p in pair]
            if layout == "multi_lane" or all(found):
                for side, files in zip(mates, found, strict=True):
                    side.extend(files)
        if not all(mates):
            continue
        if len(mates[0]) != len(mates[1]):
            raise FastqError(f"{name} has {len(mates[0])} first and {len(mates[1])} second files")
        for path, size, is_file in mates[0] + mates[1] if validate else []:
            if not is_file or size <= 0:
                raise FastqError(f"{path} is empty or no file")
        return layout, [p for p, _, _ in mates[0]], [p for p, _, _ in mates[1]]
    raise FastqError(f"no FASTQ files of {name!r} in {folder}; tried {', '.join(LAYOUTS)}")


def records(data: bytes) -> Iterator[tuple[str, str, str]]:
    """(name, sequence, quality) of FASTQ bytes, gzip or plain, unpacked piece by piece; an error if a record is cut off."""
    stream = io.BytesIO(data)
    lines = io.TextIOWrapper(gzip.GzipFile(fileobj=stream) if data[:2] == b"\x1f\x8b" else stream, "ascii", "replace")
    at = 0
    while True:
        four = [line.rstrip("\r\n") for line in itertools.islice(lines, 4)]
        if not any(four):
            if any(line.strip() for line in lines):
                raise ValueError(f"no FASTQ record at line {at + 1}")
            return
        if len(four) < 4 or (not four[3] and four[1]):
            raise ValueError("the number of lines is no multiple of four")
        if not four[0].startswith("@") or len(four[1]) != len(four[3]):
            raise ValueError(f"no FASTQ record at line {at + 1}")
        yield four[0][1:], four[1], four[3]
        at += 4


def read_fastq(spark: SparkSession, path: str, rows: int = 50_000) -> DataFrame:
    """(file, read_no, name, seq, qual) of all files of a path or glob; one file per task, as gzip cannot be split, handed over in pieces."""

    def run(frames):
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                found, at = records(bytes(content)), 0
                while part := list(itertools.islice(found, rows)):
                    yield pd.DataFrame({"file": file, "read_no": range(at, at + len(part)), "name": [r[0] for r in part], "seq": [r[1] for r in part], "qual": [r[2] for r in part]})
                    at += len(part)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, read_no long, name string, seq string, qual string")


def write_fastq(reads: DataFrame, path: str) -> None:
    """reads(name, seq, qual) as gzip FASTQ parts under path, in the order of the partitions."""
    reads.select(F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.option("compression", "gzip").text(path)


def pair_key(name: Column) -> Column:
    """A read's name without comment and mate number."""
    return F.regexp_replace(F.substring_index(name, " ", 1), r"/[12]$", "")


def pair_reads(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates by pair key."""
    a = first.select(pair_key(F.col("name")).alias("key"), F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    b = second.select(pair_key(F.col("name")).alias("key"), F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    return a.join(b, "key", "full")


def synthetic_sequence(sample: str, number: int, mate: int, length: int) -> str:
    """Bases from SHA-256 of sample:number:mate:block, two bits each, highest first."""
    out: list[str] = []
    block = 0
    while len(out) < length:
        for byte in hashlib.sha256(f"{sample}:{number}:{mate}:{block}".encode()).digest():
            out += ["ACGT"[byte >> s & 3] for s in (6, 4, 2, 0)]
        block += 1
    return "".join(out[:length])


def synthetic_reads(spark: SparkSession, sample: str, n: int, length: int, mate: int = 1) -> DataFrame:
    """The same for n reads without Python: hashes of blocks, spelled as bases."""
    blocks = -(-length // 128)
    word = F.concat(*[F.sha2(F.concat_ws(":", F.lit(sample), F.col("id").cast("string"), F.lit(str(mate)), F.lit(str(b))), 256) for b in range(blocks)])
    spelled = F.array_join(F.transform(F.split(word, ""), lambda h: F.element_at(F.array(*[F.lit("ACGT"[v >> 2] + "ACGT"[v & 3]) for v in range(16)]), (F.conv(h, 16, 10).cast("int") + 1))), "")
    return spark.range(n).select(F.col("id").alias("read_id"), F.substring(spelled, 1, length).alias("seq"))
