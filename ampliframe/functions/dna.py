"""Column expressions over DNA text; everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampliframe.contracts import integer_argument, text_argument

# The IUPAC nucleotide codes and the bases each one stands for.
IUPAC_BASES = {
    "A": "A",
    "C": "C",
    "G": "G",
    "T": "T",
    "M": "AC",
    "R": "AG",
    "W": "AT",
    "S": "CG",
    "Y": "CT",
    "K": "GT",
    "V": "ACG",
    "H": "ACT",
    "D": "AGT",
    "B": "CGT",
    "N": "ACGT",
}
# Each code above this line's complement, position by position.
COMPLEMENT_FROM = "ACGTMRWSYKVHDBN"
COMPLEMENT_TO = "TGCAKYWSRMBDHVN"

_BIT = {"A": 1, "C": 2, "G": 4, "T": 8}
#: four-bit set of bases per IUPAC code
BASE_MASK = {code: sum(_BIT[b] for b in bases) for code, bases in IUPAC_BASES.items()}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def complement_text(seq: str) -> str:
    """Reverse complement of a driver-side constant such as a primer."""
    return seq.translate(str.maketrans(COMPLEMENT_FROM, COMPLEMENT_TO))[::-1]


def reverse_complement(seq: Column | str) -> Column:
    """Reverse complement of upper-case IUPAC DNA; gaps and other characters are kept."""
    return F.reverse(F.translate(_col(seq), COMPLEMENT_FROM, COMPLEMENT_TO))


def clean_sequence(seq: Column | str) -> Column:
    """Sequence without any whitespace, upper-cased."""
    return F.upper(F.regexp_replace(_col(seq), r"\s+", ""))


def checked_primer(primer: str, name: str = "primer") -> str:
    primer = text_argument(primer, name).upper()
    unknown = sorted(set(primer) - set(BASE_MASK))
    if unknown:
        raise ValueError(f"{name} has characters outside the IUPAC DNA codes: {''.join(unknown)}")
    return primer


def primer_regex(primer: str) -> str:
    """Regex for an exact placement in which codes agree when their base sets overlap."""
    parts = []
    for base in checked_primer(primer):
        codes = "".join(c for c, m in BASE_MASK.items() if m & BASE_MASK[base])
        parts.append(f"[{codes}]")
    return "".join(parts)


def first_exact_hit(seq: Column | str, primer: str) -> Column:
    """1-based start of the first placement without mismatches, NULL if there is none."""
    return F.nullif(
        F.regexp_instr(F.upper(_col(seq)), F.lit(primer_regex(primer))), F.lit(0)
    )


def _char_mask(char: Column) -> Column:
    """Base set of one sequence character; 0 for anything outside the codes."""
    codes = "".join(BASE_MASK)
    where = F.instr(F.lit(codes), char)
    masks = F.array(F.lit(0), *[F.lit(BASE_MASK[c]) for c in codes])
    return F.get(masks, where)


def first_hit_declarative(seq: Column | str, primer: str, max_mismatch: int) -> Column:
    """1-based start of the first placement with at most `max_mismatch` substitutions.

    Pure expressions, kept as the readable definition of the search. Higher-order functions are
    interpreted, so `primers.primer_hits` uses the Arrow version of the same rule.
    """
    primer = checked_primer(primer)
    max_mismatch = integer_argument(max_mismatch, "max_mismatch")
    width = len(primer)
    seq = F.upper(_col(seq))
    masks = F.transform(F.split(seq, ""), _char_mask)
    starts = F.when(
        F.length(seq) >= width, F.sequence(F.lit(1), F.length(seq) - (width - 1))
    ).otherwise(F.array().cast("array<int>"))

    def mismatches(bound: Column, start: Column) -> Column:
        total = F.lit(0)
        for offset, base in enumerate(primer):
            overlap = F.get(bound, start + (offset - 1)).bitwiseAND(F.lit(BASE_MASK[base]))
            total = total + F.when(overlap == 0, 1).otherwise(0)
        return total

    # the one-element transform binds the base sets once instead of once per placement
    first = F.transform(
        F.array(masks),
        lambda bound: F.get(
            F.filter(starts, lambda s: mismatches(bound, s) <= max_mismatch), F.lit(0)
        ),
    )
    return F.get(first, F.lit(0))
