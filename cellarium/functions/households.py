"""Household types generated from what a household is made of, and their recodes as predicates.

A type is a couple (or none), relatives, own children, other children, generations and a size. `least` tells how many persons
such a household needs; a type exists for every size from there to seven or more. So the table of all types, the
24 older types without sizes, and which types fit a size all follow from one rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame, SparkSession

from .dims import Dim, Schema

COUPLES = (("married", "opposite-sex"), ("married", "same-sex"), ("cohabiting", "opposite-sex"), ("cohabiting", "same-sex"), ("", ""))
AGES = ("under6", "6to17", "both", "")  # of children; the last: none
MOST = 7


@dataclass(frozen=True)
class Household:
    """own: ages of the householder's children; child: of all children but householder, spouse and partner; minor: is anyone under 18?"""

    couple: str
    sexes: str
    relatives: bool
    own: str
    child: str
    minor: bool
    multi: bool
    size: int = 0
    alone: bool = False

    @property
    def family(self) -> bool:
        return self.couple == "married" or bool(self.own) or self.relatives


def least(h: Household) -> int | None:
    """Fewest persons of such a household; None if there can be none."""
    if h.alone:
        return None if h.couple or h.relatives or h.own or h.child or h.multi else 1
    kin = h.couple == "married"  # the spouse is a relative
    if (kin or h.own) and not h.relatives or h.own and h.child not in (h.own, "both") or h.child and not h.minor:
        return None
    couple, children = 1 + bool(h.couple), {"": 0, "both": 2}.get(h.child, 1)
    if not h.multi:
        n = couple + children + (h.relatives and not children and not kin)
        return max(n, 2)
    if not h.relatives or not h.couple and h.minor and not h.child:
        return None
    two = h.own in ("under6", "6to17") and h.child == "both"  # own children and grandchildren are two generations already
    return couple + children + (2 if not children else 0 if two else 1)


def _types() -> list[Household]:
    out = []
    for couple, sexes in COUPLES:
        if not couple:
            out += [Household("", "", False, "", "", minor, False, 1, True) for minor in (False, True)]
        for relatives, own, child, minor, multi in product((True, False), AGES, AGES, (False, True), (False, True)):
            n = least(Household(couple, sexes, relatives, own, child, minor, multi))
            if n is not None:
                out += [Household(couple, sexes, relatives, own, child, minor, multi, size) for size in range(n, MOST + 1)]
    return out


TYPES = _types()


def _old_types() -> list[Household]:
    """Without sizes, generations and other children: couples by own children, then by relatives; single householders alone first."""
    out = []
    for couple, sexes in COUPLES:
        if not couple:
            out.append(Household("", "", False, "", "", False, False, 1, True))
        out += [Household(couple, sexes, True, own, own, True, False) for own in AGES[:3]]
        out += [Household(couple, sexes, relatives, "", "", False, False) for relatives in ((True,) if couple == "married" else (True, False))]
    return out


OLD_TYPES = _old_types()

# The words of the types' labels.
_OWN = {"under6": "with oc u6 only", "6to17": "with oc 6to17 only", "both": "with oc both"}
_BESIDE = {("under6", "under6"): ", no cxhhsup 6to17", ("under6", "both"): ", cxhhsup both", ("6to17", "6to17"): ", no cxhhsup u6", ("6to17", "both"): ", cxhhsup both", ("both", "both"): ""}
_OTHER = {"under6": "u6 only", "6to17": "6to17", "both": "both"}


def label(h: Household) -> str:
    if h.alone:
        return f"Size 1, not multig, no spouse or partner, living alone, {'c' if h.minor else 'no c'}"
    married = h.couple == "married"
    who = f"{h.couple} {h.sexes}" if h.couple else "no spouse or partner"
    if h.own:
        text = f"{who}{'' if h.couple else ','} {_OWN[h.own]}{_BESIDE[h.own, h.child]}"
    else:
        other = f", but has cxhhsup {_OTHER[h.child]}{' only' if married and h.child == '6to17' else ''}" if h.child else f", no cxhhsup, {'but has c' if h.minor else 'no c'}"
        text = f"{who} with no oc{other}" if married else f"{who} with {'' if h.relatives else 'no '}relatives, no oc{other}"
    return f"Size {h.size}{'+' * (h.size == MOST)}, {'multig' if h.multi else 'not multig'}, {text}"


def _recodes(types: list[Household], rules: dict[str, dict[str, Callable[[Household], bool]]]) -> dict[str, dict[str, tuple[int, ...]]]:
    return {name: {group: tuple(i for i, h in enumerate(types) if test(h)) for group, test in groups.items()} for name, groups in rules.items()}


def _both(h: Household) -> bool:
    return h.own == "both"


def _shared(other: str, both: str) -> dict[str, dict[str, Callable[[Household], bool]]]:
    """Recodes that old and new types have in common. Names and labels of recodes, here and below."""
    married, single = (lambda h: h.couple == "married"), (lambda h: h.couple != "married")
    return {
        "family": {"Family": lambda h: h.family}, "nonfamily": {"Non-Family": lambda h: not h.family}, "marriedfamily": {"Married Family": married},
        "married_with_children_indicator": {"Married with own children under 18": lambda h: married(h) and bool(h.own), "Married without own children under 18": lambda h: married(h) and not h.own},
        "married_with_children_levels": {"Married with children under 6 only": lambda h: married(h) and h.own == "under6", "Married with children 6 to 17 years only": lambda h: married(h) and h.own == "6to17", "Married with children under 6 years and 6 to 17 years": lambda h: married(h) and _both(h)},
        "otherfamily": {"Other Family": lambda h: single(h) and h.family},
        "other_with_children_levels": {f"{both} with children under 6 only": lambda h: single(h) and h.own == "under6", f"{both} with children 6 to 17 years only": lambda h: single(h) and h.own == "6to17", f"{both} with children under 6 years and 6 to 17 years": lambda h: single(h) and _both(h)},
        "alone": {"Alone": lambda h: h.alone}, "invert_alone": {"Not alone": lambda h: not h.alone}, "notalone": {other: lambda h: not h.alone and not h.family},
        "ownchild_under6": {"Householder has own child under 6": lambda h: h.own in ("under6", "both")}, "ownchild_under18": {"Householder has own child under 18": lambda h: bool(h.own)},
    }


def household_type_full() -> Dim:
    """All types of the largest household schema, with sizes, generations and other children."""
    couple2 = lambda h: h.size == 2 and bool(h.couple)
    rules = _shared("Non-Family not alone", "Other") | {
        "size1": {"1-person household": lambda h: h.size == 1}, "size2": {"2-person household": lambda h: h.size == 2}, "non2type": {"Not size two": lambda h: h.size != 2},
        "other_with_children_indicator": {"Other with own children under 18": lambda h: h.couple != "married" and bool(h.own), "Other without own children under 18": lambda h: h.couple != "married" and not h.own},
        "child_alone": {"Child alone": lambda h: h.alone and h.minor}, "type2_onechild": {"Size two with child": lambda h: h.size == 2 and h.minor}, "type2_onechildxhh": {"Size two with child": lambda h: h.size == 2 and bool(h.child)},
        "type2_couple": {"Size 2, householder with spouse/unmarried partner": couple2}, "type3_twochild": {"Size 3, two children": lambda h: h.size == 3 and _both(h)},
        "type3_couple_with_child": {"Size 3, couple with one child": lambda h: h.size == 3 and bool(h.couple) and bool(h.own)}, "type4_couple_with_twochildren": {"Size 4, couple with two children": lambda h: h.size == 4 and _both(h) and bool(h.couple)},
    }
    return Dim("hhtype_dhch", tuple(label(h) for h in TYPES), _recodes(TYPES, rules))


def _fewest(h: Household, multi: bool = False) -> int:
    """Fewest persons of an old type, which leaves open how many generations there are; beyond any size if there can be none."""
    n = least(Household(h.couple, h.sexes, h.relatives, h.own, h.child, h.minor, multi, h.size, h.alone))
    return 99 if n is None else n


def old_type_recodes() -> dict[str, dict[str, tuple[int, ...]]]:
    """Recodes of the 24 types, those for sizes they cannot have or cannot have with three generations included."""
    cohabiting = lambda h: h.couple == "cohabiting"
    alike = lambda couple, sexes: lambda h: (h.couple, h.sexes) == (couple, sexes)
    return _recodes(OLD_TYPES, _shared("Nonfamily, Not alone", "Other family") | {
        "other_with_children_indicator": {"Other family without own children under 18": lambda h: cohabiting(h) and h.family and not h.own, "Other family with own children under 18": lambda h: cohabiting(h) and bool(h.own)},
        "cohabiting": {"Cohabiting": cohabiting}, "cohabiting_with_children_indicator": {"Cohabiting without own children under 18": lambda h: cohabiting(h) and not h.own, "Cohabiting with own children under 18": lambda h: cohabiting(h) and bool(h.own)},
        "no_spouse_or_partner": {"No spouse or partner": lambda h: not h.couple},
        "no_spouse_or_partner_levels": {"Alone": lambda h: h.alone, "With own children": lambda h: not h.couple and bool(h.own), "With relatives, no own children": lambda h: not h.couple and h.relatives and not h.own, "No relatives, not alone": lambda h: not h.couple and not h.family and not h.alone},
        "couplelevels": {"Married": lambda h: h.couple == "married", "Unmarried Partner": cohabiting, "All others": lambda h: not h.couple},
        "oppositelevels": {"Married Opposite": alike("married", "opposite-sex"), "Partner Opposite": alike("cohabiting", "opposite-sex")}, "samelevels": {"Married Same": alike("married", "same-sex"), "Partner Same": alike("cohabiting", "same-sex")},
        "non2type": {"Types inconsistent with size 2": lambda h: h.alone or _fewest(h) > 2}, "non3type": {"Type not consistent with size 3": lambda h: h.alone or _fewest(h) > 3},
        "type2_onechild": {"Size 2, householder with child": lambda h: _fewest(h) == 2 and bool(h.own)}, "type2_couple": {"Size 2, householder with spouse/unmarried partner": lambda h: _fewest(h) == 2 and bool(h.couple)},
        "type3_twochild": {"Size 3, two children": lambda h: _fewest(h) == 3 and _both(h)}, "type3_couple_with_child": {"Size 3, couple with one child": lambda h: bool(h.couple) and h.own in ("under6", "6to17")},
        "type3_notmulti": {"Size 3, can't be multi": lambda h: not h.alone and _fewest(h) <= 3 < _fewest(h, True)}, "type4_notmulti": {"Size 4, can't be multigen": lambda h: not h.alone and _fewest(h) <= 4 < _fewest(h, True)},
        "type4_couple_with_twochildren": {"Size 4, couple with two children": lambda h: bool(h.couple) and _both(h)}, "never_multi": {"Can never be multigen regardless of size": lambda h: _fewest(h, True) == 99},
    })


def type_table(spark: SparkSession, types: list[Household] = TYPES) -> DataFrame:
    """(hhtype, what the type says): a fixed table of all types."""
    rows = [(i, h.couple, h.sexes, h.relatives, h.own, h.child, h.minor, h.multi, h.size, h.alone, h.family) for i, h in enumerate(types)]
    return spark.createDataFrame(rows, "hhtype int, couple string, sexes string, relatives boolean, own string, child string, minor boolean, multi boolean, size int, alone boolean, family boolean")


def short_tenure() -> Dim:
    return Dim("hhtenshort", ("Owned", "Not owned"), {"owned": {"Owned": (0,)}, "tenure_2lev": {"Owned": (0,), "Not owned": (1,)}})


def largest() -> Schema:
    """Householder's sex, age, ethnicity and race, elderly, tenure and household type: 2 x 9 x 2 x 7 x 4 x 2 x 522 cells."""
    from . import attributes as A  # it takes the old types' recodes from here

    return Schema((A.sex(), A.household_age(), A.hispanic(), A.householder_race(), A.household_elderly(), short_tenure(), household_type_full()))


def largest_units() -> Schema:
    from . import attributes as A

    return Schema((A.unit_kinds(),))


def households_2010() -> Schema:
    """The older household schema: size, generations and one of 24 types instead of the generated one."""
    from . import attributes as A

    return Schema((A.sex(), A.household_age(), A.hispanic(), A.householder_race(), A.household_size(), A.household_type(), A.household_elderly(), A.multigenerational(), short_tenure()))
