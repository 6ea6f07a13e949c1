"""Rule sets of schemas as data: what every geounit's counts must satisfy.

A rule is a query (terms of a schema, crossed) of one or several universes with factors, a sign and a right-hand side: a number, or the
name of an invariant. Rules with right-hand side 0 and sign ``=`` are structural zeros. Fixed values: the rules of each schema.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """terms: {universe: (query, factor)}; rhs: a number for every level, or an invariant's name."""

    name: str
    terms: dict[str, tuple[str, int]]
    sign: str = "="
    rhs: int | str = 0


def zero(name: str, *terms: str) -> Rule:
    return Rule(name, {"main": (" * ".join(terms), 1)})


#: What the householder's age says about the elderly: age, presence that it rules out.
_ELDERLY = {"eld0": ("age_under60", "invert_elderly0"), "eld1": ("age_60to64", "invert_elderly1"), "eld2": ("age_65to74", "invert_elderly2"), "eld3": ("age_75plus", "invert_elderly3")}
_YOUNG = ("age_15to24", "elderly3")

#: Rules that both household schemas share.
_COMMON = [
    Rule("total", {"main": ("total", 1)}, "le", "tot_hu"),
    Rule("tot_hh", {"main": ("total", 1), "unit": ("householdTotal", -1)}),
    Rule("gq_vect", {"unit": ("hhgq_vector", 1)}, "=", "gqhh_vect"),
    Rule("owned", {"main": ("tenure_2lev", 1), "unit": ("tenure_2lev", -1)}),
    zero("age_child_1", "male", "age_75plus", "ownchild_under6"), zero("age_child_2", "female", "age_75plus", "ownchild_under18"), zero("age_child_3", "female", "age_60plus", "ownchild_under6"),
    zero("hh_elderly_eld3", "age_75plus", "invert_elderly3"), zero("hh_elderly_2", "age_65to74", "pres_under65"), zero("hh_elderly_3", "age_60to64", "pres_under60"),
]

LARGEST = [
    *_COMMON,
    *[zero(f"living_alone_{k}", "size1", *t) for k, t in _ELDERLY.items()], zero("living_alone_childalone", "child_alone", "hhover24"),
    *[zero(f"size2_{k}", "type2_onechildxhh" if k == "eld0" else "type2_onechild", *t) for k, t in _ELDERLY.items()], zero("size2_le25_eld3", "type2_couple", *_YOUNG),
    *[zero(f"size3_{k}", "type3_twochild", *t) for k, t in _ELDERLY.items()], zero("size3_le25_eld3", "type3_couple_with_child", *_YOUNG),
    zero("size4_le25_eld3", "type4_couple_with_twochildren", *_YOUNG),
]

HOUSEHOLDS_2010 = [
    *_COMMON, zero("no_vacant", "vacant"),
    zero("living_alone_gt1", "size1", "invert_alone"), zero("living_alone_multi", "size1", "yes_multi"), *[zero(f"living_alone_{k}", "size1", "alone", "no_multi", *t) for k, t in _ELDERLY.items()],
    zero("size2_gt2", "size2", "non2type"), zero("size2_multi", "size2", "yes_multi"), *[zero(f"size2_{k}", "size2", "type2_onechild", *t) for k, t in _ELDERLY.items()], zero("size2_le25_eld3", "size2", "type2_couple", *_YOUNG),
    zero("size3_gt3", "size3", "non3type"), zero("size3_multi", "size3", "yes_multi", "type3_notmulti"), *[zero(f"size3_{k}", "size3", "type3_twochild", *t) for k, t in _ELDERLY.items()], zero("size3_le25_eld3", "size3", "type3_couple_with_child", *_YOUNG),
    zero("size4_gt4", "size4", "alone"), zero("size4_multi", "size4", "type4_notmulti", "yes_multi"), zero("size4_le25_eld3", "size4", "type4_couple_with_twochildren", *_YOUNG),
    zero("size2plus_notalone_gt2plus", "size2plus", "alone"), zero("not_multigen_1", "yes_multi", "never_multi"),
]

#: Persons by relationship, age and facility.
PERSONS = [
    Rule("total", {"main": ("total", 1)}, "=", "tot"),
    zero("no_parents_under_30", "rel_parents", "age_lessthan30"), zero("no_kids_over_89", "rel_children", "age_greaterthan89"), zero("no_refhh_under_15", "rel_cantbekids", "age_lessthan15"),
    Rule("hhgq_total_lb", {"main": ("gqlevels", 1)}, "ge", "gq_lower"), Rule("hhgq_total_ub", {"main": ("gqlevels", 1)}, "le", "gq_upper"),
]
