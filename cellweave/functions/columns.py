"""Column expressions used by the operators. Everything here stays inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_version(gene: Column | str) -> Column:
    """``ENSG00000000003.14`` -> ``ENSG00000000003``."""
    return F.regexp_replace(gene, r"\..*", "")


# How each kind of file name carries the run id. A "file" may also be a folder of
# part files that bears the name.
RUN_PATTERNS = {
    "htseq": r"htseq_([^/]*)_results\.txt(?:/part-[^/]*)?$",
    "dge": r"([^/]*)_dge\.txt(?:\.gz)?(?:/part-[^/]*)?$",
    "fastq": r"([^/]*?)(?:_[12])?\.(?:fastq|fq)(?:\.gz)?(?:/part-[^/]*)?$",
    "sam": r"([^/]*?)\.sam(?:\.gz)?(?:/part-[^/]*)?$",
}


def run_from_path(path: Column | str, kind: str) -> Column:
    """Run id carried by the last part of a path or URL; ``any`` keeps the name without ``.gz``."""
    if kind == "any":
        return F.regexp_replace(F.substring_index(path, "/", -1), r"\.gz$", "")
    return F.regexp_extract(path, RUN_PATTERNS[kind], 1)


def mate_from_path(path: Column | str) -> Column:
    """2 for ``<run>_2.fastq``, otherwise 1."""
    path = F.col(path) if isinstance(path, str) else path
    return F.when(path.rlike(r"_2\.(fastq|fq)(\.gz)?(/part-[^/]*)?$"), 2).otherwise(1)


def log2p1(value: Column | str) -> Column:
    return F.log2(F.lit(1.0) + (F.col(value) if isinstance(value, str) else value))


def phred(qual: Column | str, offset: int = 33) -> Column:
    """Quality text to an array of integers."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - F.lit(offset))


def lgamma(x: Column) -> Column:
    """log Gamma(x) for x > 0: shift the argument up by 8, then the Stirling series."""
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal for z >= 0 (relative error below 1.2e-7).

    Chebyshev fit of erfc with exponent form, the usual one for built-in arithmetic only.
    """
    # Coefficients of the published erfc fit.
    coefficients = [
        -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
        0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
    ]
    x = z / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        poly = poly * t + c
    return 0.5 * t * F.exp(poly - x * x)
