"""Published table sets: name -> queries. Fixed values; tables that repeat others by race or ethnicity follow from these."""

from __future__ import annotations

from dataclasses import replace

from . import attributes as A
from .dims import Dim, Schema
from .households import short_tenure

HOUSEHOLDS = {
    "P15": ["total", "hisp", "hisp * hhrace"],
    "P18": ["total", "family", "nonfamily", "marriedfamily", "otherfamily", "otherfamily * hhsex", "alone", "notalone"],
    "P19": ["total", "size1", "size2plus", "hhsex * size1", "family", "nonfamily", "marriedfamily", "married_with_children_indicator", "otherfamily", "hhsex * otherfamily", "hhsex * other_with_children_indicator", "nonfamily * hhsex", "notalone", "hhsex * notalone"],
    "P20": ["total", "marriedfamily", "married_with_children_indicator", "cohabiting", "cohabiting_with_children_indicator", "hhsex * no_spouse_or_partner", "hhsex * no_spouse_or_partner_levels"],
    "P22": ["total", "family", "hhage * family", "nonfamily", "hhage * nonfamily"],
    "P23": ["total", "presence60", "family * presence60", "marriedfamily * presence60", "otherfamily * presence60", "hhsex * otherfamily * presence60", "nonfamily * presence60"],
    "P24": ["total", "presence60", "size1 * presence60", "size2plus * presence60", "notalone * presence60", "family * presence60"],
    "P25": ["total", "presence65", "presence65 * size1", "presence65 * size2plus", "presence65 * notalone", "presence65 * family"],
    "P26": ["total", "presence75", "presence75 * size1", "presence75 * size2plus", "presence75 * notalone", "presence75 * family"],
    "P28": ["total", "family", "nonfamily", "family * sizex01", "nonfamily * sizex0"],
    "P38": ["total", "marriedfamily", "married_with_children_indicator", "married_with_children_levels", "otherfamily", "hhsex * otherfamily", "hhsex * other_with_children_indicator", "hhsex * other_with_children_levels"],
    "PCT14": ["total", "multi"],
    "PCT15": ["total", "couplelevels", "oppositelevels", "samelevels", "hhsex * samelevels"],
    "PCT18": ["total", "hhsex * nonfamily", "hhsex * alone", "hhsex * alone * hhover65", "hhsex * notalone", "hhsex * notalone * hhover65"],
    "H6": ["total", "hhrace"], "H7": ["total", "hisp * hhrace"], "H13": ["total", "sizex0"], "H14": ["total", "rent", "rent * hhrace"], "H15": ["total", "rent", "rent * hisp"], "H16": ["total", "rent", "rent * sizex0"], "H17": ["total", "rent", "rent * hhage"],
    "H18": [
        "total", "rent", "rent * family", "rent * marriedfamily", "rent * marriedfamily * hhageH18", "rent * otherfamily", "rent * otherfamily * hhsex", "rent * otherfamily * hhsex * hhageH18", "rent * nonfamily", "rent * nonfamily * hhsex",
        "rent * alone * hhsex * hhageH18", "rent * notalone * hhsex * hhageH18",
    ],
    "HCT1": ["total", "rent", "rent * hisp", "rent * hisp * hhrace"],
}
#: By race (A to G), ethnicity (H), and both (I).
BY_RACE = {"A-G": "hhrace", "H": "hisp", "I": "whiteonly * hisp"}
_REPEATED = {
    "P18": HOUSEHOLDS["P18"][1:], "P28": ["family", "family * sizex01", "nonfamily", "nonfamily * sizex0"],
    "P38": ["marriedfamily", "married_with_children_indicator", "married_with_children_levels", "otherfamily", "hhsex * otherfamily", "hhsex * other_with_children_indicator", "hhsex * other_with_children_levels"],
}
HOUSEHOLDS |= {f"{t}{suffix}": [who, *[f"{who} * {q}" for q in queries]] for t, queries in _REPEATED.items() for suffix, who in BY_RACE.items()}
HOUSEHOLDS |= {f"{t}A-I": [*BY_RACE.values(), *[f"{who} * {q}" for q in queries for who in BY_RACE.values()]] for t, queries in {"PCT14": ["multi"], "H16": ["rent", "rent * sizex0"], "H17": ["rent", "rent * hhage"]}.items()}

#: Persons by facility, sex, age, ethnicity and race.
PERSONS = {
    "P1": ["total"], "P3": ["total", "majorRaces"], "P4": ["total", "hispanic"], "P5": ["total", "hispanic", "hispanic * majorRaces"], "P6": ["racecomb"], "P7": ["racecomb", "hispanic * racecomb"], "P12": ["total", "sex", "sex * agecat"],
    "P16": ["hhTotal", "hhTotal * votingLevels"], "P43": ["gqTotal", "gqTotal * sex", "gqTotal * sex * agecat43", "sex * agecat43 * institutionalized"], "PCT13": ["hhTotal", "hhTotal * sex", "hhTotal * sex * agecat"],
    "binarysplitquery": ["binarysplit_agecats", "age"], "PCO3": ["gqCorrectionalTotal", "gqCorrectionalTotal * sex", "gqCorrectionalTotal * sex * agecatPCO3"], "PCO4": ["gqJuvenileTotal", "gqJuvenileTotal * sex", "gqJuvenileTotal * sex * agecatPCO4"],
    "PCT22": ["votingTotal * gqTotal", "votingTotal * gqTotal * sex", "votingTotal * sex * institutionalized"],
}
#: Tables of one kind of facility by sex; their ages are grouped in the two above only.
PERSONS |= {
    f"PCO{k}": [q, f"{q} * sex"]
    for k, q in {1: "gqTotal", 2: "instTotal", 5: "gqNursingTotal", 6: "gqOtherInstTotal", 7: "noninstTotal", 8: "gqCollegeTotal", 9: "gqMilitaryTotal", 10: "gqOtherNoninstTotal"}.items()
}
_WHO = {**{s: f"{r}Alone" for s, r in zip("ABCDEF", A.RACES, strict=True)}, "G": "tomr", "H": "hispTotal", "I": "whiteAlone * notHispTotal"}
for _s, _w in _WHO.items():
    PERSONS[f"P12{_s}"] = [_w, f"{_w} * sex", f"{_w} * sex * agecat"]
    PERSONS[f"PCT13{_s}"] = [f"{_w} * hhTotal", f"{_w} * hhTotal * sex", f"{_w} * hhTotal * sex * agecat"]
    PERSONS[f"PCO43{_s}"] = [f"{_w} * gqTotal", f"{_w} * gqTotal * sex", f"{_w} * gqTotal * sex * agecat43", f"{_w} * institutionalized * sex * agecat43"]


def _named(dim: Dim, name: str, **recodes) -> Dim:
    return replace(dim, name=name, recodes=dim.recodes | recodes)


def households() -> Schema:
    """The 2010 household schema under the names that its tables use."""
    return Schema((
        _named(A.sex(), "hhsex"), A.household_age(), _named(A.hispanic(), "hisp"), _named(A.householder_race(), "hhrace", whiteonly={"White alone": (0,)}), A.household_size(), A.household_type(), A.household_elderly(), A.multigenerational(), _named(short_tenure(), "rent"),
    ))


#: Five-year and finer groups of ages: first ages of the categories of A.AGE_CATEGORIES.
_FIRST = (0, 5, 10, 15, 18, 20, 22, 25, 30, 35, 40, 45, 50, 55, 60, 62, 65, 66, 67, 70, 75, 80, 85)


#: Kinds of facilities in the order of their levels.
_KINDS = {
    "Correctional": "Correctional Facilities for Adults", "Juvenile": "Juvenile Facilities", "Nursing": "Nursing Facilities", "OtherInst": "Other Institutional Facilities",
    "College": "College/University Student Housing", "Military": "Military Quarters Housing", "OtherNoninst": "Other Noninstitutional Facilities",
}


def persons() -> Schema:
    age = A.age()
    cats = {label: tuple(range(a, b)) for label, a, b in zip(A.AGE_CATEGORIES, _FIRST, (*_FIRST[1:], age.size), strict=True)}
    fives = lambda a, b: {f"{k} to {k + 4} years": tuple(range(k, k + 5)) for k in range(a, b, 5)}
    from20 = {"Under 20 years": tuple(range(20)), **fives(20, 85), "85 years and over": tuple(range(85, age.size))}
    to25 = {"Under 5 years": tuple(range(5)), **fives(5, 25), "25 years and over": tuple(range(25, age.size))}
    split = {}
    for width in (116, 58, 29, 15, 7, 4, 2, 1):  # groups of a width side by side, the last cut off
        for a in range(0, age.size - 1, width):
            b = min(a + width, age.size) - 1
            split[f"split{width}: age {a}" if a == b else f"split{width}: age {a}-{b}"] = tuple(range(a, b + 1))
    kinds = {f"gq{name}Total": {f"{label} Population Total": (k,)} for k, (name, label) in enumerate(_KINDS.items(), 1)} | {"instTotal": {"Institutional Population Total": (1, 2, 3, 4)}, "noninstTotal": {"Noninstitutionalized Population Total": (5, 6, 7)}}
    race = A.cenrace()
    combos = A.race_combinations()
    names = ("White", "Black or African American", "American Indian and Alaska Native", "Asian", "Native Hawaiian and Other Pacific Islander", "Some Other Race")
    comb = {f"{n} alone or in combination with one or more other races": tuple(k for k, c in enumerate(combos) if i in c) for i, n in enumerate(names)}
    return Schema((_named(A.facility(), "hhgq", hhTotal={"Household": (0,)}, **kinds), A.sex(), _named(age, "age", agecat=cats, agecatPCO3=from20, agecatPCO4=to25, binarysplit_agecats=split), A.hispanic(), _named(race, "cenrace", racecomb=comb)))
