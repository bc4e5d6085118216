"""Evidence codes, their categories, and policies for what counts as an improvement."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The categories and the codes in each of them.
CATEGORIES = ("experimental", "phylogenetic", "computational", "author_statement", "curator_statement", "electronic", "unknown")
CODES = {
    "experimental": ("EXP", "IDA", "IPI", "IMP", "IGI", "IEP", "HTP", "HDA", "HMP", "HGI", "HEP"),
    "phylogenetic": ("IBA", "IBD", "IKR", "IRD"),
    "computational": ("ISS", "ISO", "ISA", "ISM", "IGC", "RCA"),
    "author_statement": ("TAS", "NAS"),
    "curator_statement": ("IC", "ND"),
    "electronic": ("IEA",),
}


def category(code: Column) -> Column:
    """The category of a code, unknown for any other."""
    out = None
    for name, codes in CODES.items():
        out = F.when(code.isin(*codes), name) if out is None else out.when(code.isin(*codes), name)
    return out.otherwise("unknown")


@dataclass(frozen=True)
class EvidencePolicy:
    """The categories that a policy accepts, and the (old, new) category pairs that it calls upgrades."""

    name: str
    accepted: frozenset[str]
    upgrades: frozenset[tuple[str, str]]

    @classmethod
    def experimental(cls) -> EvidencePolicy:
        """Experimental evidence is accepted; to come to it from any other category is an upgrade."""
        target = "experimental"
        return cls(target, frozenset({target}), frozenset((c, target) for c in CATEGORIES if c != target))

    def category(self, code: Column) -> Column:
        return category(code)

    def accepts(self, codes: Column) -> Column:
        """Whether any code of an array has an accepted category."""
        if not self.accepted:
            return F.lit(False)
        return F.exists(codes, lambda c: category(c).isin(*sorted(self.accepted)))

    def is_upgrade(self, old: Column, new: Column) -> Column:
        """Whether both arrays have codes, the old ones aren't accepted, and some pair is an upgrade."""
        by_old: dict[str, list[str]] = {}
        for a, b in sorted(self.upgrades):
            by_old.setdefault(a, []).append(b)
        if not by_old:
            return F.lit(False)
        some = lambda codes, names: F.exists(codes, lambda c: category(c).isin(*names))
        pairs = [some(old, [a]) & some(new, b) for a, b in by_old.items()]
        found = pairs[0]
        for p in pairs[1:]:
            found = found | p
        return (F.size(old) > 0) & (F.size(new) > 0) & ~self.accepts(old) & found
