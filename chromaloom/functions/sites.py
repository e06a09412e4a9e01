"""Compiler of restriction-site specifications: enzymes, kits and IUPAC sites to patterns.

A specification is a comma-separated list of sites such as ``G^ANT_C`` (``^`` marks the forward
cut, ``_`` the reverse one), enzyme names (case matters), kit names (case does not) or ``DNASE``
for a digest without sites.  Everything here is a handful of values on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC codes with the bases they stand for, and their complements.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T",
    "W": "AT", "S": "CG", "M": "AC", "K": "GT", "R": "AG", "Y": "CT",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}
COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A", "W": "W", "S": "S", "M": "K", "K": "M", "R": "Y", "Y": "R", "B": "V", "V": "B", "D": "H", "H": "D", "N": "N", "^": "_", "_": "^"}

# Kits and their enzymes (vendors' documentation).
KITS = {
    "OMNI-C": ("DNASE",),
    "ARIMA_V2": ("Arima", "DdeI", "MseI"),
    "ARIMA": ("HinfI", "DpnII"),
    "DOVETAIL": ("DpnII",),
    "PHASE": ("Sau3AI",),
    "QIAGEN": ("DpnII",),
}

# Recognition sites of common enzymes (public REBASE data), with both cuts; enzymes
# that cut on both sides of their site have two.
ENZYMES = {
    "AatII": "G_ACGT^C", "AccI": "GT^MK_AC", "AciI": "C^CG_C", "AclI": "AA^CG_TT", "AcuI": "CTGAAGNNNNNNNNNNNNNN_NN^N",
    "AfeI": "AGC^_GCT", "AflII": "C^TTAA_G", "AgeI": "A^CCGG_T", "AluI": "AG^_CT", "ApaI": "G_GGCC^C",
    "ApaLI": "G^TGCA_C", "ApoI": "R^AATT_Y", "AscI": "GG^CGCG_CC", "AseI": "AT^TA_AT", "AvaI": "C^YCGR_G",
    "AvaII": "G^GWC_C", "AvrII": "C^CTAG_G", "BamHI": "G^GATC_C", "BbvCI": "CC^TCA_GC", "BclI": "T^GATC_A",
    "BcgI": "_NN^NNNNNNNNNNCGANNNNNNTGC,CGANNNNNNTGCNNNNNNNNNN_NN^",
    "BfaI": "C^TA_G", "BglII": "A^GATC_T", "BsaJI": "C^CNNG_G", "BsiWI": "C^GTAC_G", "BspHI": "T^CATG_A",
    "BsrGI": "T^GTAC_A", "BssHII": "G^CGCG_C", "BstBI": "TT^CG_AA", "BstEII": "G^GTNAC_C", "BstNI": "CC^W_GG",
    "BstUI": "CG^_CG", "ClaI": "AT^CG_AT", "Csp6I": "G^TA_C", "CviAII": "C^AT_G", "CviQI": "G^TA_C",
    "DdeI": "C^TNA_G", "DpnI": "GA^_TC", "DpnII": "^GATC_", "DraI": "TTT^_AAA", "EagI": "C^GGCC_G",
    "EcoRI": "G^AATT_C", "EcoRV": "GAT^_ATC", "FatI": "^CATG_", "Fnu4HI": "GC^N_GC", "FseI": "GG_CCGG^CC",
    "HaeII": "R_GCGC^Y", "HaeIII": "GG^_CC", "HhaI": "G_CG^C", "HincII": "GTY^_RAC", "HindIII": "A^AGCT_T",
    "HinfI": "G^ANT_C", "HinP1I": "G^CG_C", "HpaI": "GTT^_AAC", "HpaII": "C^CG_G", "HpyCH4IV": "A^CG_T",
    "HpyCH4V": "TG^_CA", "KasI": "G^GCGC_C", "KpnI": "G_GTAC^C", "MboI": "^GATC_", "MfeI": "C^AATT_G",
    "MluCI": "^AATT_", "MluI": "A^CGCG_T", "MscI": "TGG^_CCA", "MseI": "T^TA_A", "MspI": "C^CG_G",
    "NarI": "GG^CG_CC", "NcoI": "C^CATG_G", "NdeI": "CA^TA_TG", "NheI": "G^CTAG_C", "NlaIII": "_CATG^",
    "NotI": "GC^GGCC_GC", "NruI": "TCG^_CGA", "NsiI": "A_TGCA^T", "PacI": "TTA_AT^TAA", "PciI": "A^CATG_T",
    "PmeI": "GTTT^_AAAC", "PstI": "C_TGCA^G", "PvuI": "CG_AT^CG", "PvuII": "CAG^_CTG", "RsaI": "GT^_AC",
    "SacI": "G_AGCT^C", "SacII": "CC_GC^GG", "SalI": "G^TCGA_C", "Sau3AI": "^GATC_", "Sau96I": "G^GNC_C",
    "SbfI": "CC_TGCA^GG", "ScaI": "AGT^_ACT", "SmaI": "CCC^_GGG", "SnaBI": "TAC^_GTA", "SpeI": "A^CTAG_T",
    "SphI": "G_CATG^C", "SspI": "AAT^_ATT", "StuI": "AGG^_CCT", "StyI": "C^CWWG_G", "SwaI": "ATTT^_AAAT",
    "TaqI": "T^CG_A", "Tsp509I": "^AATT_", "XbaI": "T^CTAG_A", "XhoI": "C^TCGA_G", "XmaI": "C^CCGG_G",
}

# Kinds of base that a run of unknown bases may touch; cut between the two.
BOUNDARIES = ("[ATGC]N", "N[ATGC]")


class SiteError(ValueError):
    """A specification that has no meaning."""


@dataclass(frozen=True)
class RestrictionSite:
    """A pattern of bases and bracketed sets; equal if pattern and forward cut are."""

    pattern: str
    loc: int
    rev_loc: int = field(compare=False)

    @property
    def width(self) -> int:
        return len(re.sub(r"\[[^\]]*\]", ".", self.pattern))

    def __post_init__(self) -> None:
        if self.width < self.loc:
            raise SiteError(f"the cut {self.loc} of {self.pattern} lies outside of it")


def reverse_complement(site: str) -> str:
    """Of a site with IUPAC codes and cut marks; a mark that is reversed changes its kind."""
    return "".join(COMPLEMENT.get(x, x) for x in reversed(site))


def without_marks(site: str) -> str:
    return site.replace("^", "").replace("_", "")


def expand(site: str) -> str:
    """Bracketed sets in place of the codes that stand for several bases."""
    return "".join(b if len(b := IUPAC.get(x, x)) == 1 else f"[{b}]" for x in without_marks(site))


def reverse_complement_of(site: Column) -> Column:
    """``reverse_complement`` of a column of sites."""
    return F.translate(F.reverse(site), "".join(COMPLEMENT), "".join(COMPLEMENT.values()))


def pattern_of(site: Column) -> Column:
    """``expand`` of a column of sites."""
    shown = {k: v if len(v) == 1 else f"[{v}]" for k, v in IUPAC.items()}
    table = F.create_map(*[F.lit(x) for pair in shown.items() for x in pair])
    letters = F.filter(F.split(F.translate(site, "^_", ""), ""), lambda x: x != "")
    return F.array_join(F.transform(letters, lambda x: F.coalesce(table[x], x)), "")


def is_palindrome(site: str) -> bool:
    return site == reverse_complement(site)


def _site(marked: str) -> RestrictionSite:
    forward, reverse = marked.index("^"), marked.index("_")
    return RestrictionSite(expand(marked), forward - (forward > reverse), reverse - (reverse > forward))


def _with_reverse_cut(site: str, compat: bool) -> str:
    """Put the reverse cut of a palindrome where the complement of its forward cut lies."""
    if not is_palindrome(without_marks(site)):
        raise SiteError(f"{site} has no reverse cut '_' and is no palindrome")
    forward = site.index("^")
    place = len(without_marks(site)) - forward
    if place >= forward:
        place += 1  # the forward mark stands before it
    if compat and place < forward:
        place += 1  # an off-by-one for cuts right of the middle, kept on request
    return site[:place] + "_" + site[place:]


def read_catalogue(lines: Iterable[str]) -> dict[str, str]:
    """Enzymes and their sites from lines of a REBASE table in EMBOSS form (``emboss_e``).

    Fields: name, site, length, number of cuts, blunt, and up to four cuts: forward and reverse before,
    forward and reverse behind.  Cuts count the bases up to the cut; those before the site count from -1
    for its edge, without a zero.  Enzymes whose cuts are unknown are left out.
    """
    found = {}
    for fields in (line.split() for line in lines if line.strip() and not line.startswith("#")):
        name, site, cuts = fields[0], fields[1].upper(), [int(x) for x in fields[5:9]]
        places = [x + (x < 0) for x in cuts[: int(fields[3])]]
        sites = [_marked(site, *places[k : k + 2]) for k in range(0, len(places) - 1, 2)]
        if sites and set(site) <= set(IUPAC):
            found[name] = ",".join(sites)
    return found


def _marked(site: str, forward: int, reverse: int) -> str:
    """The site with both marks, padded with N where a cut lies outside of it."""
    ahead = max(0, -min(forward, reverse))
    behind = max(0, max(forward, reverse) - len(site))
    bases, forward, reverse = "N" * ahead + site + "N" * behind, forward + ahead, reverse + ahead
    low, high = sorted((forward, reverse))
    first, second = ("^", "_") if forward <= reverse else ("_", "^")
    return bases[:low] + first + bases[low:high] + second + bases[high:]


def compile_sites(spec: str, compat: bool = False, catalogue: Mapping[str, str] | None = None) -> frozenset[RestrictionSite]:
    """All sites of a specification.

    compat: cuts right of the centre without '_' are off by one.  catalogue: enzymes beside ENZYMES, by name.
    """
    enzymes = ENZYMES | dict(catalogue or {})
    found: set[RestrictionSite] = set()
    for item in (x.strip() for x in spec.split(",")):
        upper = item.upper()
        if re.fullmatch(f"[{''.join(IUPAC)}]+", without_marks(upper)):
            if "^" not in upper:
                raise SiteError(f"{item} has no forward cut '^'")
            site = upper if "_" in upper else _with_reverse_cut(upper, compat)
            found.add(_site(site))
            if not is_palindrome(site):
                found.add(_site(reverse_complement(site)))
        elif item in enzymes:
            found |= compile_sites(enzymes[item], compat)
        elif upper in KITS:
            found |= compile_sites(",".join(KITS[upper]), compat)
        elif upper not in ("DNASE", "<NA>"):
            raise SiteError(f"{item} is no site, enzyme or kit")
    return frozenset(found)


def scan_patterns(sites: frozenset[RestrictionSite]) -> list[RestrictionSite]:
    """The sites in a stable order, with the boundaries of unknown bases; none without sites."""
    if not sites:
        return []
    return sorted(sites, key=lambda s: (s.pattern, s.loc)) + [RestrictionSite(p, 1, 1) for p in BOUNDARIES]
