"""SAM headers: the graph of @PG records, and the header of an output.  A header is a few lines on the driver.

The SAM specification makes @PG records a graph: PP names the program that ran before.  A program
that works on the file runs after every program that nothing has run after yet, so it gets one
record for each of these, under an ID of its own.
"""

from __future__ import annotations

import itertools


class HeaderError(ValueError):
    """A header whose programs all precede one another."""


def _fields(line: str) -> dict[str, str]:
    """Tags of a header line; of a tag that is given twice the first counts."""
    found: dict[str, str] = {}
    for field in line.rstrip("\n").split("\t")[1:]:
        found.setdefault(field[:2], field[3:])
    return found


def _line(record: dict[str, str]) -> str:
    return "\t".join(["@PG", *(f"{tag}:{value}" for tag, value in record.items())])


class ProgramGraph:
    """The @PG records of a header: IDs, and which of them precede others."""

    def __init__(self, lines: list[str]):
        records = [_fields(line) for line in lines]
        self.ids = {r["ID"] for r in records if "ID" in r}
        preceding = {r.get("PP") for r in records}
        self.tips = [i for i in dict.fromkeys(r.get("ID") for r in records) if i is not None and i not in preceding]
        if self.ids and not self.tips:
            raise HeaderError("every program of the header precedes another: the @PG records form a cycle")

    def _allot(self, wanted: str) -> str:
        """The ID itself, or the first with a number that no record has."""
        numbered = (f"{wanted}.{n}" for n in itertools.count(1))
        free = next(i for i in itertools.chain([wanted], numbered) if i not in self.ids)
        self.ids.add(free)
        return free

    def run(self, program: dict[str, str]) -> list[dict[str, str]]:
        """Records of a program that runs after all others; they are the tips from now on."""
        new = [program | {"ID": self._allot(program["ID"])} | ({"PP": tip} if tip else {}) for tip in self.tips or [""]]
        self.tips = [r["ID"] for r in new]
        return new


def output_header(header: list[str], program: str, classes: list[str], min_mapq: int, sites) -> list[str]:
    """Header lines of one output: the program's own records tell its parameters and classes.

    Parameters may repeat a tag (one ``rs`` for each site), so they follow the record as text.  Programs
    come after all other lines.
    """
    told = [f"mq:{min_mapq}", *(f"rs:{s.pattern},{s.loc}" for s in sorted(sites, key=lambda s: (s.pattern, s.loc))), *(f"hc:{c}" for c in classes)]
    programs = [x for x in header if x.startswith("@PG\t")]
    own = ["\t".join([_line(r), *told]) for r in ProgramGraph(programs).run(_fields(program))]
    return [x for x in header if x not in programs] + programs + own
