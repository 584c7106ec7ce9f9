"""Column functions on numbers and on text that holds numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column) -> Column:
    """A number out of "1,234", "45.2%" or " 7 "; null for anything else."""
    return F.regexp_replace(text, r"[,%\s]", "").try_cast("double")


def percent_text(value: Column) -> Column:
    """A share of 0..100, clamped, with two decimals."""
    return F.format_string("%.2f%%", F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), value)), 2))


def fraction_of(part: Column, total: Column) -> Column:
    """Percent of a total to two decimals, half to even; null for a total of 0."""
    return F.bround(F.try_divide(part.cast("double"), total) * 100, 2)


def seen_probability(reads: Column, fraction: Column) -> Column:
    """Chance that a molecule of so many reads is seen at a fraction of the reads."""
    return F.when(fraction <= 0, F.lit(0.0)).when(fraction >= 1, F.lit(1.0)).otherwise(-F.expm1(reads * F.log1p(-fraction)))


def rotated(x: Column, y: Column, degrees: float, cx: float, cy: float) -> tuple[Column, Column]:
    """A point turned around a centre."""
    a = F.radians(F.lit(float(degrees)))
    dx, dy = x - cx, y - cy
    return dx * F.cos(a) - dy * F.sin(a) + cx, dx * F.sin(a) + dy * F.cos(a) + cy


def affine(x: Column, y: Column, matrix: list[list[float]]) -> tuple[Column, Column]:
    """A point under a 2 x 3 matrix."""
    (a, b, c), (d, e, f) = matrix
    return x * a + y * b + c, x * d + y * e + f


def compose(outer: list[list[float]], inner: list[list[float]]) -> list[list[float]]:
    """The 2 x 3 matrix that applies inner, then outer."""
    out = []
    for r in outer:
        out.append([r[0] * inner[0][k] + r[1] * inner[1][k] + (r[2] if k == 2 else 0) for k in range(3)])
    return out


def microns_per_pixel(p: tuple[float, float], q: tuple[float, float], length_um: float) -> float:
    """Scale from two points a known length apart."""
    distance = ((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5
    if distance <= 0:
        raise ValueError("the points coincide")
    return length_um / distance


#: What the first version digit of a chemistry stands for.
KITS = {"0": "testing version", "1": "no longer in use", "2": "kit V1", "3": "kit V2"}


def kit_label(chemistry: Column) -> Column:
    """The chemistry with its kit in brackets, where its prefix and version digit are known."""
    digit = F.regexp_extract(chemistry, r"^(?:strnaV|BBV)(\d)", 1)
    out = chemistry
    for k, name in KITS.items():
        out = F.when(digit == k, F.concat(chemistry, F.lit(f" ({name})"))).otherwise(out)
    return out


def index_size(fasta_bytes: int) -> int:
    """Suffix-array index size of an aligner for a genome of so many bytes."""
    return min((max(1, fasta_bytes).bit_length() - 1) // 2 - 1, 14)


def perplexity(cells: int) -> int:
    return min(30, max(1, (cells - 1) // 3))


def pca_size(cells: int, genes: int) -> tuple[int, int]:
    """(components computed, components used); an error below two."""
    n = min(50, cells, genes)
    if n < 2:
        raise ValueError("PCA needs two cells and two genes")
    return n, min(25, n)
