"""Column functions on DNA strings, codes and qualities.  All stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every second bit: marks one bit per base of a 2-bit code.
_LOW_BITS = 0x5555555555555555


def encode(seq: Column, strict: bool = False) -> Column:
    """DNA as an integer, two bits a base, first base highest.

    Other characters count as T, as in matching; strict gives null for them.
    """
    code = F.conv(F.translate(F.regexp_replace(F.upper(seq), "[^ACGT]", "T"), "ACGT", "0123"), 4, 10).cast("bigint")
    return F.when(F.upper(seq).rlike("^[ACGT]+$"), code) if strict else code


def decode(code: Column, width: int) -> Column:
    """DNA of a fixed width from its code."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), width, "0"), "0123", "ACGT")


def encode_onehot(seq: Column) -> Column:
    """Four bits a base: N 0, A 1, G 2, C 4, T 8."""
    return F.conv(F.translate(seq, "NAGCT", "01248"), 16, 10).cast("bigint")


def decode_onehot(code: Column, width: int) -> Column:
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 16), width, "0"), "01248", "NAGCT")


def hamming_codes(a: Column, b: Column) -> Column:
    """Differing bases of two 2-bit codes of equal width."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LOW_BITS)))


def hamming_bits(a: Column, b: Column) -> Column:
    """Differing bits of two codes, which is not the number of differing bases."""
    return F.bit_count(a.bitwiseXOR(b))


def hamming(a: Column, b: Column) -> Column:
    """Differing characters; an error for strings of different lengths."""
    same = F.length(a) == F.length(b)
    n = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda p, q: p != q), lambda x: x))
    return F.when(same, n).otherwise(F.raise_error(F.lit("hamming: lengths differ")).cast("int"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def neighbours(width: int, mismatches: int) -> int:
    """Number of strings within 1..mismatches substitutions over four bases."""
    out, choose = 0, 1
    for k in range(1, mismatches + 1):
        choose = choose * (width - k + 1) // k
        out += choose * 3**k
    return out


def one_off(seq: Column, width: int, bases: str = "ACGTN") -> Column:
    """All strings within one substitution, the string itself included."""
    return F.array_distinct(F.array(*[F.overlay(seq, F.lit(b), F.lit(i + 1), F.lit(1)) for i in range(width) for b in bases]))


def within(seq: Column, width: int, mismatches: int, bases: str = "ACGTN") -> Column:
    """All strings within the given number of substitutions."""
    out = F.array(seq)
    for _ in range(mismatches):
        out = F.array_distinct(F.flatten(F.transform(out, lambda s: one_off(s, width, bases))))
    return out


def low_quality(qual: Column, least: int, most: int, offset: int = 33) -> Column:
    """Whether more than ``most`` characters stand for a quality below ``least``."""
    return F.length(F.regexp_replace(qual, f"[^\\x{offset:02x}-\\x{offset + least - 1:02x}]", "")) > most


def good_bases(qual: Column, least: int = 30, offset: int = 33) -> Column:
    """How many characters reach the quality, compared as characters."""
    return F.length(F.regexp_replace(qual, f"[\\x00-\\x{offset + least - 1:02x}]", ""))


def poly_t(segment: Column, least: int = 10) -> Column:
    return F.length(segment) - F.length(F.replace(segment, F.lit("T"), F.lit(""))) >= least


def grid_barcode(row: Column, col: Column, columns: int, rows: int) -> Column:
    """A DNA word for a grid cell, as wide as the grid needs (an even number of bits)."""
    bits = max(1, (rows * columns - 1).bit_length())
    return decode(row.cast("bigint") * columns + col.cast("bigint"), (bits + 1) // 2)


def split_structure(pattern: str) -> dict[str, list[tuple[int, int]]]:
    """Intervals per letter of a read structure such as C8L15U4T18."""
    import re

    if not re.fullmatch(r"(?:[CLUNT]\d+)+", pattern):
        raise ValueError(f"not a read structure: {pattern!r}")
    out: dict[str, list[tuple[int, int]]] = {}
    at = 0
    for letter, n in re.findall(r"([CLUNT])(\d+)", pattern):
        out.setdefault(letter, []).append((at, at + int(n)))
        at += int(n)
    return out


def segment(seq: Column, structure: dict[str, list[tuple[int, int]]], letter: str, strict: bool = True) -> Column:
    """The joined slices of a letter; null if the read is too short and strict."""
    parts = structure[letter]
    joined = F.concat(*[F.substring(seq, a + 1, b - a) for a, b in parts])
    return F.when(F.length(seq) >= max(b for _, b in parts), joined) if strict else joined


def displaced_linker(seq: Column, linker: str, first: int, shifts: int = 4, mismatches: int = 1) -> Column:
    """The least shift 0..shifts-1 at which the linker stands within the mismatches; 0 if at none."""
    width = len(linker)
    fits = [F.when((F.length(seq) >= first + s + width) & (hamming_codes(encode(F.substring(seq, first + s + 1, width)), encode(F.lit(linker))) <= mismatches), F.lit(s)) for s in range(shifts)]
    return F.coalesce(*fits, F.lit(0))
