"""Demultiplexing: read structures, filters in order, error-tolerant matching against a whitelist."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S

#: Read structures of the registered chemistries.
CHEMISTRIES = {"BBV2.4": "C4L15C4L15C4U10T18", "demo": "C8L15U4T18"}


def parse_reads(reads: DataFrame, pattern: str, linkers: list[str], least_quality: int = 10, most_low: int = 2, linker_mismatches: int = 2, tail_umi: int = 0, check_poly_t: bool = False) -> DataFrame:
    """reads(seq, qual) with barcode, umi and a status: the first rule that rejects the read, or "ok".

    Order: short, low_quality, no_linker, no_poly_t (only if asked for).
    tail_umi takes the UMI from the end of the read instead of its segment.
    """
    parts = S.split_structure(pattern)
    need = max(b for spans in parts.values() for _, b in spans if spans is not parts.get("T"))
    umi = F.expr(f"right(seq, {tail_umi})") if tail_umi else S.segment(F.col("seq"), parts, "U")
    quality = F.concat(*[F.substring("qual", a + 1, b - a) for letter in "CU" for a, b in parts.get(letter, [])])
    status = F.when(F.length("seq") < need, "short").when(S.low_quality(quality, least_quality, most_low), "low_quality")
    if "L" in parts and linkers:
        whole = S.segment(F.col("seq"), parts, "L")
        near = F.lit(False)
        for linker in linkers:
            width = len(linker)
            off = F.size(F.filter(F.zip_with(F.split(whole, ""), F.split(F.lit(linker), ""), lambda p, q: p != q), lambda x: x)) if width > 31 else S.hamming_codes(S.encode(whole), S.encode(F.lit(linker)))
            near = near | ((F.length(whole) == width) & (off <= linker_mismatches))
        status = status.when(~near, "no_linker")
    if check_poly_t and "T" in parts:
        status = status.when(~S.poly_t(S.segment(F.col("seq"), parts, "T", strict=False)), "no_poly_t")
    return reads.withColumn("barcode", S.segment(F.col("seq"), parts, "C")).withColumn("umi", umi).withColumn("status", status.otherwise("ok"))


def displaced_segments(seq: Column, widths: tuple[int, int, int], umi: int, linker: str, base: int = 15, shifts: int = 4) -> tuple[Column, Column]:
    """(barcode, UMI) where the second linker may stand 0..3 bases later, found within one mismatch."""
    a, b, c = widths
    first = a + base + b
    at = S.displaced_linker(seq, linker, first, shifts)
    after = F.lit(first + base + 1) + at
    return F.concat(F.substring(seq, 1, a), F.substring(seq, a + base + 1, b), F.substring(seq, after, F.lit(c))), F.substring(seq, after + c, F.lit(umi))


def correct_barcodes(observed: DataFrame, whitelist: DataFrame, width: int, mismatches: int = 1) -> DataFrame:
    """(barcode, corrected) for the distinct barcodes of observed; corrected is null where none or several match.

    Entries of the whitelist stay.  Others need exactly one entry within the
    mismatches.  With an N, only the first is tried with each base, and exactly
    one must be an entry; further N's count as T.  Without mismatches only entries
    stay.  A word of A's is an entry like any other.  Both sides meet on their codes
    with each choice of ``mismatches`` pairs of neighbouring bases cleared: at most
    16 entries share such a code for every pair cleared, and the bases are compared
    then.  The spread sides are never broadcast, as their sizes are guessed from
    the tables before they are spread; only pairs that match are grouped.
    The observed side is read once; a word of up to 31 bases fits a code.
    """
    if not 1 <= width <= 31:
        raise ValueError("a code holds 1 to 31 bases")
    every = (1 << 2 * width) - 1
    pairs = [every & (15 << 4 * p) for p in range((width + 1) // 2)]
    masks = F.array(*[F.lit(every ^ sum(places)).cast("long") for places in itertools.combinations(pairs, min(mismatches, len(pairs)))])
    entries = whitelist.select(S.encode(F.col("barcode")).alias("entry")).distinct()
    seen = observed.select("barcode").distinct().withColumn("code", S.encode(F.col("barcode"))).withColumn("first_n", F.instr("barcode", "N"))
    known = seen.join(entries.hint("merge"), (F.col("code") == F.col("entry")) & (F.col("first_n") == 0), "left").select("barcode", "code", "first_n", F.col("entry").alias("exact"))
    # what to look up: (number of the choice, cleared code); -1 is the whole word, -2 meets nothing and keeps the barcode
    tried = F.array(*[F.struct(F.lit(-1).alias("k"), S.encode(F.overlay("barcode", F.lit(b), F.col("first_n"), F.lit(1))).alias("word")) for b in "ACGT"])
    cleared = F.transform(masks, lambda m, k: F.struct(k.alias("k"), F.col("code").bitwiseAND(m).alias("word")))
    nothing = F.array().cast("array<struct<k: int, word: bigint>>")
    itself = F.array(F.struct(F.lit(-2).alias("k"), F.col("code").alias("word")))
    look = F.when(F.col("exact").isNotNull() | F.lit(not mismatches), nothing).when(F.col("first_n") > 0, tried).otherwise(cleared)
    probes = known.select("barcode", "code", "exact", F.explode(F.concat(itself, look)).alias("s")).select("barcode", "code", "exact", "s.k", "s.word")
    spread = entries.select("entry", F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("k"), F.col("entry").alias("word"))), F.transform(masks, lambda m, k: F.struct(k.alias("k"), F.col("entry").bitwiseAND(m).alias("word"))))).alias("s")).select("entry", "s.k", "s.word")
    near = (F.col("k") == -1) | (S.hamming_codes(F.col("code").bitwiseAND(F.lit(every)), F.col("entry").bitwiseAND(F.lit(every))) <= mismatches)
    met = probes.join(spread.hint("merge"), ["k", "word"], "left").filter((F.col("k") == -2) | (F.col("entry").isNotNull() & near))
    found = met.groupBy("barcode").agg(F.max("exact").alias("exact"), F.min("entry").alias("low"), F.max("entry").alias("high"))
    return found.select("barcode", S.decode(F.coalesce("exact", F.when(F.col("low") == F.col("high"), F.col("low"))), width).alias("corrected"))


def demultiplex(parsed: DataFrame, whitelist: DataFrame, width: int, mismatches: int = 1) -> DataFrame:
    """Parsed reads with the corrected barcode; reads without one get the status no_barcode."""
    fixed = correct_barcodes(parsed.filter("status = 'ok'"), whitelist, width, mismatches)
    out = parsed.join(fixed, "barcode", "left")
    return out.withColumn("status", F.when((F.col("status") == "ok") & F.col("corrected").isNull(), "no_barcode").otherwise(F.col("status")))


def mismatch_table(whitelist: DataFrame, width: int, mismatches: int = 1) -> DataFrame:
    """Every string near an entry with its entry; the later entry wins where several are near."""
    near = whitelist.select("pos", F.col("value").alias("entry"), F.explode(S.within(F.col("value"), width, mismatches)).alias("seq"))
    return near.groupBy("seq").agg(F.max_by("entry", "pos").alias("entry"))


def match_segments(reads: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Reads whose segments all appear in a mismatch table, with the corrected segments joined."""
    out = reads
    for c in columns:
        out = out.join(table.select(F.col("seq").alias(c), F.col("entry").alias(f"{c}_fixed")), c)
    return out.withColumn("barcode", F.concat(*[f"{c}_fixed" for c in columns]))


def combinations(fragments: DataFrame, n: int = 3) -> DataFrame:
    """All joins of n fragments: the whitelist that a segmented barcode spans."""
    out = fragments.select(F.col("value").alias("barcode"))
    for _ in range(n - 1):
        out = out.crossJoin(fragments).select(F.concat("barcode", "value").alias("barcode"))
    return out


def base_quality(parsed: DataFrame, qual: str = "qual") -> DataFrame:
    """One row: bases, and the percent that reach quality 30."""
    return parsed.agg(F.sum(F.length(qual)).alias("bases"), F.bround(F.sum(S.good_bases(F.col(qual))) / F.sum(F.length(qual)) * 100, 2).alias("q30"))


def detect_chemistry(reads: DataFrame, probes: list[tuple[str, str]], sample: int = 10_000) -> DataFrame:
    """One row: the commonest chemistry among the first reads, its share and a verdict.

    probes are (chemistry, regular expression), the first that matches counts;
    the sample is the detector's feature.
    """
    label = F.lit(None).cast("string")
    for name, pattern in reversed(probes):
        label = F.when(F.col("seq").rlike(pattern), F.lit(name)).otherwise(label)
    n = reads.orderBy("read_id").limit(sample).groupBy(label.alias("chemistry")).agg(F.count("*").alias("n"))
    best = n.agg(F.sum("n").alias("total"), F.max_by(F.struct("chemistry", "n"), F.when(F.col("chemistry").isNotNull(), F.struct("n", "chemistry"))).alias("b"))
    share = F.coalesce(F.col("b.n"), F.lit(0)) / F.col("total")
    return best.select("b.chemistry", F.round(share, 6).alias("share"), F.when(share < 0.1, "fail").when(share < 0.5, "warn").otherwise("ok").alias("verdict"))


def status_counts(parsed: DataFrame) -> DataFrame:
    n = parsed.groupBy("status").agg(F.count("*").alias("reads"))
    return n.withColumn("pct", F.bround(F.col("reads") / F.sum("reads").over(Window.partitionBy(F.lit(1))) * 100, 2))
