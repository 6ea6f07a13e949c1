"""Ready workloads: which queries every level asks and how a budget is shared among levels and queries."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from .dims import Schema

LEVELS = ("US", "State", "County", "Tract", "Block_Group", "Block")


@dataclass(frozen=True)
class Strategy:
    """levels: share of the budget by level; queries: shares of a level's budget by query."""

    levels: dict[str, Fraction]
    queries: dict[str, dict[str, Fraction]]

    def check(self, schema: Schema, hier: list[str]) -> None:
        """Every level has a share and queries that exist in the schema; all shares are positive and sum to 1."""
        if set(hier) != set(self.levels) or set(hier) != set(self.queries):
            raise ValueError(f"the strategy is for levels {sorted(self.levels)}")
        for name, shares in (("levels", self.levels), *self.queries.items()):
            if sum(shares.values()) != 1 or min(shares.values()) <= 0:
                raise ValueError(f"shares of {name} are not positive or do not sum to 1")
        for query in {q for shares in self.queries.values() for q in shares}:
            try:
                schema.parse(query)
            except KeyError as e:
                raise ValueError(f"no query {query!r} in the schema") from e

    def rows(self) -> list[tuple]:
        """(geolevel, query, geo_num, geo_den, q_num, q_den)"""
        return [(level, q, g.numerator, g.denominator, s.numerator, s.denominator) for level, g in self.levels.items() for q, s in self.queries[level].items()]


# Queries in order, and shares as numerators over a level's denominator.
_QUERIES = ("total", "cenrace", "hispanic", "votingage", "hhinstlevels", "hhgq", "hispanic * cenrace", "votingage * cenrace", "votingage * hispanic", "votingage * hispanic * cenrace", "detailed")
_FEWER = ("total", "hispanic * cenrace11cats", "votingage", "hhinstlevels", "hhgq", "hispanic * cenrace11cats * votingage", "detailed")
_PRODUCTION = {
    "US": (4097, (52, 26, 26, 26, 26, 130, 130, 26, 442, 3213)),
    "State": (4097, (3773, 6, 6, 6, 6, 6, 12, 12, 6, 34, 230)),
    "County": (4097, (3126, 10, 10, 10, 10, 10, 28, 28, 10, 101, 754)),
    "Tract": (4102, (1567, 8, 5, 5, 5, 5, 1933, 20, 5, 67, 482)),
    "Block_Group": (4099, (1705, 3, 3, 3, 3, 3, 1055, 9, 3, 24, 1288)),
    "Block": (4097, (5, 9, 5, 5, 5, 5, 21, 21, 5, 71, 3945)),
}
_LEVEL_SHARES = (104, 1440, 447, 687, 1256, 165)  # of 4099, from the root down


def _shared(names: tuple[str, ...], den: int, shares: tuple[int, ...]) -> dict[str, Fraction]:
    """The last names belong to the shares: a root without a total has one fewer."""
    return {q: Fraction(n, den) for q, n in zip(names[len(names) - len(shares) :], shares, strict=True)}


def _levels() -> dict[str, Fraction]:
    return {level: Fraction(n, 4099) for level, n in zip(LEVELS, _LEVEL_SHARES, strict=True)}


def production() -> Strategy:
    return Strategy(_levels(), {level: _shared(_QUERIES, *_PRODUCTION[level]) for level in LEVELS})


def equal() -> Strategy:
    """Every query of every level alike."""
    return Strategy(_levels(), {level: _shared(_QUERIES, 11, (1,) * 11) for level in LEVELS})


def detailed_first() -> Strategy:
    return Strategy(_levels(), {level: _shared(_QUERIES, 1024, (1, 2, 1, 1, 1, 1, 5, 5, 1, 17, 989)) for level in LEVELS})


def fewer_races() -> Strategy:
    return Strategy(_levels(), {level: _shared(_FEWER, 7, (1,) * 7) for level in LEVELS})
