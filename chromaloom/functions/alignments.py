"""Column functions of alignment records: flags, CIGAR strings, positions and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-letter class codes with their names.
READ_CLASSES = {
    "UP": "unpaired", "UM": "unmapped", "SE": "secondary", "QC": "qc fail", "DP": "duplicate", "SP": "supplementary",
    "IR": "invalid reference name", "MQ": "below minimum mapping quality", "RS": "too far from restriction site",
}
INVALID_PAIRS = {"SC": "self circle", "DE": "dangling end", "SS": "same fragment and strand", "RL": "re-ligated"}
VALID_PAIRS = {"FF": "FF", "FR": "FR", "RF": "RF", "RR": "RR"}
DUMPED = "DM"

# Flag bits that make a read bad, in the order in which a later one prevails.
BAD_FLAGS = [("UM", 0x4), ("SE", 0x100), ("QC", 0x200), ("DP", 0x400), ("SP", 0x800)]

# Names of groups of classes.
ALIASES = {
    "valid_pairs": ["FF", "FR", "RF", "RR"],
    "invalid_pairs": ["SC", "DE", "SS", "RL"],
    "invalid_reads": ["SC", "DE", "SS", "RL", "DM"],
    "good_reads": ["FF", "FR", "RF", "RR", "SC", "DE", "SS", "RL", "DM"],
    "bad_reads": list(READ_CLASSES),
    "all_reads": ["FF", "FR", "RF", "RR", "SC", "DE", "SS", "RL", "DM", *READ_CLASSES],
}

# Names of outputs, with the classes they hold.
OUTPUTS = {
    **{name.replace("_", "-"): codes for name, codes in ALIASES.items()},
    **{f"valid-{code.lower()}": [code] for code in VALID_PAIRS},
    "re-ligated": ["RL"], "same-frag-and-strand": ["SS"], "dangling-end": ["DE"], "self-circle": ["SC"], "dumped": ["DM"],
    "too-far-from-restriction-site": ["RS"], "low-mapq": ["MQ"], "bad-reference": ["IR"], "supplementary": ["SP"], "duplicate": ["DP"],
    "qc-fail": ["QC"], "secondary": ["SE"], "unmapped": ["UM"], "unpaired": ["UP"],
}


def has(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(bit) != 0


def bad_flags(flag: Column) -> dict[str, Column]:
    """A condition per class; several can hold for one read."""
    return {"UP": ~has(flag, 1), **{code: has(flag, bit) for code, bit in BAD_FLAGS}}


def flag_class(flag: Column) -> Column:
    """The class that prevails, or null."""
    out = F.lit(None).cast("string")
    for code, holds in bad_flags(flag).items():
        out = F.when(holds, F.lit(code)).otherwise(out)
    return out


def _consumed(cigar: Column, operations: str) -> Column:
    """Sum of the lengths of some operations; a missing length is 1."""
    lengths = F.regexp_extract_all(cigar, F.lit(f"([0-9]*)[{operations}]"), F.lit(1))
    number = lambda x: F.when(x == "", F.lit(1)).otherwise(x.cast("long"))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + number(x))


def reference_length(cigar: Column) -> Column:
    return F.coalesce(_consumed(cigar, "MDN=X"), F.lit(0).cast("long"))


def query_length(cigar: Column) -> Column:
    return F.coalesce(_consumed(cigar, "MIS=X"), F.lit(0).cast("long"))


def five_prime(pos: Column, flag: Column, ref_len: Column) -> Column:
    """0-based coordinate of the 5' end of a read that begins at 1-based ``pos``."""
    return F.when(has(flag, 0x10), pos + ref_len - 2).otherwise(pos - 1)


def unclipped_five_prime(pos: Column, flag: Column, cigar: Column) -> Column:
    """The same with the clipped bases at the 5' end counted as aligned."""
    clip = lambda pattern: F.coalesce(F.regexp_extract(cigar, pattern, 1).try_cast("long"), F.lit(0).cast("long"))
    aligned = five_prime(pos, flag, reference_length(cigar))
    return F.when(has(flag, 0x10), aligned + clip("([0-9]+)[SH]$")).otherwise(aligned - clip("^([0-9]+)[SH]"))
