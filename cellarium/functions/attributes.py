"""Person, household and unit dimensions with their named groupings.

Long level lists come from rules (single years of age, combinations of races); short ones are stated.
"""

from __future__ import annotations

from itertools import combinations

from .dims import Dim, Schema
from .households import old_type_recodes

# The codes' meanings.
RACES = ("white", "black", "aian", "asian", "nhopi", "sor")
FACILITIES = ("Housing Unit", "Correctional", "Juvenile", "Nursing", "Other Institutional", "College", "Military", "Other Noninstitutional")
SPINE_TYPES = (
    "GQ 101-106 Correctional facilities for adults", "GQ 201-203 Juvenile facilities", "GQ 301 Nursing facilities/Skilled-nursing facilities", "GQ 401-405 Other institutional facilities", "GQ 501 College/University student housing",
    "GQ 601-602 Military quarters", "GQ 701-702, 704, 706, 801-802, 900-901, 903-904 Other noninstitutional facilities",
)
#: Facility classes of the relationship dimension, by how many kinds of group quarters each has (ships count with the others).
CLASSES_OF_QUARTERS = {"Correctional facilities for adults": 6, "Juvenile facilities": 3, "Nursing facilities/Skilled-nursing facilities": 1, "Other institutional facilities": 5, "College/University student housing": 1, "Military quarters": 1, "Other noninstitutional facilities": 7}
VACANCY = ("For rent", "Rented, not occupied", "For sale only", "Sold, not occupied", "For seasonal use", "For migrant workers", "Other vacant")
TENURE = ("Owned with a mortgage", "Owned free and clear", "Rented", "Occupied without payment of rent")
HOUSEHOLD_SIZE = ("Vacant", "1 person", "2 persons", "3 persons", "4 persons", "5 persons", "6 persons", "7 or more persons")


#: Relationships.
RELATIONSHIPS = (
    "Householder living alone", "Householder not living alone", "Opposite-sex spouse", "Opposite-sex unmarried partner", "Same-sex spouse (Use allocation flag to determine)", "Same-sex unmarried partner", "Biological son or daughter",
    "Adopted son or daughter", "Stepson or stepdaughter", "Brother or sister", "Father or mother", "Grandchild", "Parent-in-law", "Son-in-law or daughter-in-law", "Other relative", "Roommate or housemate",
    "Foster child (If roomer/boarder and age<21)", "Other nonrelative (also include if roomer/boarder and age>=21)",
)
#: Kinds of group quarters.
GROUP_QUARTERS = (
    "GQ 101 Federal detention centers", "GQ 102 Federal prisons", "GQ 103 State prisons", "GQ 104 Local jails and other municipal confinements", "GQ 105 Correctional residential facilities", "GQ 106 Military disciplinary barracks",
    "GQ 201 Group homes for juveniles", "GQ 202 Residential treatment centers for juveniles", "GQ 203 Correctional facilities intended for juveniles", "GQ 301 Nursing facilities", "GQ 401 Mental hospitals",
    "GQ 402 Hospitals with patients who have no usual home elsewhere", "GQ 403 In-patient hospice facilities", "GQ 404 Military treatment facilities", "GQ 405 Residential schools for people with disabilities",
    "GQ 501 College/university student housing", "GQ 601 Military quarters", "GQ 602 Military ships", "GQ 701 Emergency and transitional shelters", "GQ 801 Group homes intended for adults", "GQ 802 Residential treatment centers for adults",
    "GQ 900 Maritime/merchant vessels", "GQ 901 Workers' group living quarters and job corps centers", "GQ 997 Other noninstitutional (GQ types 702, 704, 706, 903, 904)",
)
HOUSEHOLD_TYPES = (
    "Married opposite-sex with own children under 18, under 6 yrs only", "Married opposite-sex with own children under 18, between 6 and 17 only", "Married opposite-sex with own children under 18, both ranges", "Married opposite-sex no own children under 18",
    "Married same-sex with own children only under 6 yrs", "Married same-sex with own children between 6 and 17", "Married same-sex with own children in both ranges", "Married same-sex no own children under 18",
    "Cohabiting opposite-sex with own children only under 6 yrs", "Cohabiting opposite-sex with own children between 6 and 17", "Cohabiting opposite-sex with own children in both ranges", "Cohabiting opposite-sex with relatives, no own children under 18",
    "Cohabiting opposite-sex without relatives, no own children under 18", "Cohabiting same-sex with own children only under 6 yrs", "Cohabiting same-sex with own children between 6 and 17", "Cohabiting same-sex with own children in both ranges",
    "Cohabiting same-sex with relatives, no own children under 18", "Cohabiting same-sex without relatives, no own children under 18", "No spouse or partner, alone", "No spouse or partner with own children under 6", "No spouse or partner with own children between 6 and 17.",
    "No spouse or partner with own children in both ranges", "No spouse or partner living with relatives but no own children", "No spouse or partner and no relatives, not alone.",
)
#: Facility codes of the last kind of group quarters, beside its own.
OTHER_FACILITIES = ("702", "704", "706", "903", "904")
#: Races of citizens.
CITIZEN_RACES = (
    "Hispanic or Latino", "White alone", "Black or African American alone", "American Indian and Alaska Native alone", "Asian alone", "Native Hawaiian and Other Pacific Islander alone", "Some Other Race alone", "Black or African American and White",
    "American Indian and Alaska Native and White", "Asian and White", "American Indian and Alaska Native and Black or African American", "Remainder of Two or More Race Responses",
)
#: The levels of 1940's races, of the demonstration product's units and of the older relationships.
RACES_1940 = ("White", "Black/African American", "American Indian or Alaska Native", "Chinese", "Japanese", "Other Asian or Pacific Islander")
UNIT_FACILITIES = (
    "Occupied", "Vacant", "Federal detention centers", "Federal prisons", "State prisons", "Local jails and other municipal confinement facilities", "Correctional residential facilities", "Military disciplinary barracks and jails",
    "Group homes for juveniles (non-correctional)", "Residential treatment centers for juveniles (non-correctional)", "Correctional facilities intended for juveniles", "Nursing facilities/skilled-nursing facilities",
    "Mental (psychiatric) hospitals and psychiatric units in other hospitals", "Hospitals with patients who have no usual home elsewhere", "In-patient hospice facilities", "Military treatment facilities with assigned patients",
    "Residential schools for people with disabilities", "College/university student housing", "Military quarters", "Military ships", "Emergency and transitional shelters (with sleeping facilities) for people experiencing homelessness", "Soup kitchens",
    "Regularly scheduled mobile food vans", "Targeted non-sheltered outdoor locations", "Group homes intended for adults", "Residential treatment centers for adults", "Maritime/merchant vessels", "Workers’ group living quarters and job corps centers",
    "Living quarters for victims of natural disasters", "Religious group quarters and domestic violence shelters",
)
RELATIVES = (
    "Householder", "Husband/Wife", "Biological Son/Daughter", "Adopted Son/Daughter", "Stepson/Stepdaughter", "Brother/Sister", "Father/Mother", "Grandchild", "Parent-in-law", "Son/Daughter-in-law", "Other relative", "Roomer, Boarder", "Housemate, Roommate",
    "Unmarried Partner", "Other Non-relative",
)
RELATIVE_FACILITIES = (
    "Federal Detention Centers (101)", "Federal Prisons (102)", "State Prisons (103)", "Local Jails and Other Municipal Confinement Facilities (104)", "Correctional Residential Facilities (105)", "Military Disciplinary Barracks and Jails (106)",
    "Group Homes for Juveniles (Non-Correctional) (201)", "Residential Treatment Centers (Non-Correctional) (202)", "Correctional Facilities Intended for Juveniles (203)", "Nursing Facilities/Skilled-Nursing Facilities (301)",
    "Mental (Psychiatric) Hospitals and Psychiatric Units in Other Hospitals (401)", "Hospitals with Patients Who Have No Usual Home Elsewhere (402)", "In-Patient Hospice Facilities (403)", "Military Treatment Facilities with Assigned Patients (404)",
    "Residential Schools for People with Disabilities (405)", "College/University Student Housing (501)", "Military Quarters (601)", "Military Ships (602)", "Emergency and Transitional Shelters (with Sleeping Facilities) for People Experiencing Homelessness (701)",
    "Soup Kitchens (702)", "Regularly Scheduled Mobile Food Vans (704)", "Targeted Non-Sheltered Outdoor Locations (706)", "Group Homes Intended for Adults (801)", "Residential Treatment Centers for Adults (802)", "Maritime/Merchant Vessels (900)",
    "Workers' Group Living Quarters and Job Corps Centers (901)", "Living Quarters for Victims of Natural Disasters (903)", "Religious Group Quarters and Domestic Violence Shelters (904)",
)
#: Facilities of 1940.
FACILITIES_1940 = ("Household", "Correctional Institutions", "Mental Institutions", "Institutions for the Elderly, Handicapped, and Poor", "Military", "College Dormitory", "Rooming House", "Other Non-Institutional GQ and Unknown")
#: Age categories.
AGE_CATEGORIES = (
    "Under 5 years", "5 to 9 years", "10 to 14 years", "15 to 17 years", "18 to 19 years", "20 to 21 years", "22 to 24 years", "25 to 29 years", "30 to 34 years", "35 to 39 years", "40 to 44 years", "45 to 49 years", "50 to 54 years", "55 to 59 years",
    "60 to 61 years", "62 to 64 years", "65 years", "66 years", "67 to 69 years", "70 to 74 years", "75 to 79 years", "80 to 84 years", "85 years and over",
)


def ranges(bounds: list[tuple[int, int]], size: int, one: str = "Aged {}", many: str = "Aged {} to {}") -> dict[str, tuple[int, ...]]:
    """Groups of consecutive ages."""
    return {one.format(a) if a == b else many.format(a, b): tuple(range(a, min(b, size - 1) + 1)) for a, b in bounds}


def race_combinations(names: tuple[str, ...] = RACES) -> list[tuple[int, ...]]:
    """The non-empty sets of races, by number of races and then in order: the index of a combination is its place."""
    return [c for k in range(1, len(names) + 1) for c in combinations(range(len(names)), k)]


def sex() -> Dim:
    return Dim("sex", ("Male", "Female"), {"male": {"Male": (0,)}, "female": {"Female": (1,)}})


def hispanic() -> Dim:
    return Dim("hispanic", ("Not Hispanic or Latino", "Hispanic or Latino"), {"hispTotal": {"Hispanic or Latino": (1,)}, "notHispTotal": {"Not Hispanic or Latino": (0,)}})


def voting_age() -> Dim:
    return Dim("votingage", ("17 years and under", "18 years and over"), {"voting": {"18 years and over": (1,)}, "nonvoting": {"17 years and under": (0,)}})


def citizen() -> Dim:
    return Dim("citizen", ("Non-citizen", "Citizen"))


def age(top: int = 115) -> Dim:
    n = top + 1
    labels = tuple("Under 1 year" if a == 0 else "1 year" if a == 1 else f"{a} years" for a in range(n))
    step = lambda w: ranges([(a, min(a + w - 1, top)) for a in range(0, n, w)], n)
    return Dim("age", labels, {
        "votingLevels": {"Nonvoting": tuple(range(18)), "Voting": tuple(range(18, n))},
        "nonvotingTotal": {"Nonvoting": tuple(range(18))}, "votingTotal": {"Voting": tuple(range(18, n))},
        "agroup4": step(4), "agroup8": step(8), "agroup16": step(16), "agroup32": step(32), "agroup64": step(64),
        "age_lessthan15": {"Age < 15": tuple(range(15))}, "age_lessthan30": {"Age < 30": tuple(range(30))}, "age_greaterthan89": {"Age > 89": tuple(range(90, n))},
        "under4": {"Aged 3 and under": tuple(range(4))}, "under8": {"Aged 7 and under": tuple(range(8))}, "under16": {"Aged 15 and under": tuple(range(16))},
        "agecat43": ranges([*[(a, a) for a in range(22)], (22, 24), (25, 29), (30, 34), (35, 39), (40, 44), (45, 49), (50, 54), (55, 59), (60, 61), (62, 64), (65, 66), (67, 69), (70, 74), (75, 79), (80, 84), (85, 89), (90, 94), (95, 99), (100, 104), (105, 109), (110, top)], n),
        "agePopEst18": ranges([(0, 4), *[(a, a + 4) for a in range(5, 85, 5)], (85, top)], n),
    })


def cenrace() -> Dim:
    combos = race_combinations()
    labels = tuple("-".join(RACES[r] for r in c) for c in combos)
    by = lambda test: tuple(i for i, c in enumerate(combos) if test(c))
    recodes = {
        "numraces": {f"{k} race{'s' * (k > 1)}": by(lambda c, k=k: len(c) == k) for k in range(1, len(RACES) + 1)},
        "majorRaces": {**{f"{r} alone": by(lambda c, i=i: c == (i,)) for i, r in enumerate(RACES)}, "two or more races": by(lambda c: len(c) > 1)},
    }
    # Names and labels of race groups; pairs of the priority list, by places of the races; every other combination is the remainder
    pairs = {(0, 1): "Black or African American and White", (0, 2): "American Indian and Alaska Native and White", (0, 3): "Asian and White", (1, 2): "American Indian and Alaska Native and Black or African American"}
    names = ("White", "Black or African American", "American Indian and Alaska Native", "Asian", "Native Hawaiian and Other Pacific Islander", "Some Other Race")
    alone = {f"{name} alone": by(lambda c, i=i: c == (i,)) for i, name in enumerate(names)}
    recodes["cenrace11cats"] = alone | {x: by(lambda c, p=p: c == p) for p, x in pairs.items()} | {"Balance/remainder": by(lambda c: len(c) > 1 and c not in pairs)}
    recodes["race7lev"] = {r: by(lambda c, i=i: c == (i,)) for i, r in enumerate(RACES)} | {"Two or more races": by(lambda c: len(c) > 1)}
    recodes["allraces"] = {r: by(lambda c, i=i: c == (i,)) for i, r in enumerate(RACES)}
    recodes["tomr"] = {"Two or more races": by(lambda c: len(c) > 1)}
    recodes["cenrace_7lev_two_comb"] = {r: by(lambda c, i=i: c in ((i,), (0, i))) for i, r in enumerate(RACES)} | {"Two or more races": by(lambda c: len(c) > 2 or len(c) == 2 and c[0])}
    for i, r in enumerate(RACES):
        recodes[f"{r}Alone"] = {f"{r} alone": by(lambda c, i=i: c == (i,))}
        recodes[f"{r}Combo"] = {f"{r} alone or in combination": by(lambda c, i=i: i in c)}
    return Dim("cenrace", labels, recodes)


def facility(name: str = "hhgq") -> Dim:
    return Dim(name, FACILITIES, {
        "household": {"Household": (0,)}, "gqTotal": {"Group Quarters": tuple(range(1, 8))}, "hhgqVector": {f: (i,) for i, f in enumerate(FACILITIES)},
        "hhgq2level": {"Household": (0,), "Group Quarters": tuple(range(1, 8))}, "institutionalized": {"Institutional": (1, 2, 3, 4), "Noninstitutional": (5, 6, 7)},
        "gqlevels": {f: (i,) for i, f in enumerate(FACILITIES) if i}, "housing_units": {"Housing Units": (0,)}, "total_gq": {"GQ": tuple(range(1, 8))}, "hhgqSpineTypes": {x: (i,) for i, x in enumerate(SPINE_TYPES, 1)},
        "instlevels": {"Institutional Facility": (1, 2, 3, 4), "Non-Institutional Facility": (5, 6, 7)}, "hhinstlevels": {"Household": (0,), "Institutional Facility": (1, 2, 3, 4), "Non-Institutional Facility": (5, 6, 7)},
    })


def tenure() -> Dim:
    return Dim("tenure", TENURE, {"tenure2": {"Owned": (0, 1), "Not owned": (2, 3)}})


def vacancy() -> Dim:
    return Dim("vacs", ("Occupied", *VACANCY), {"vacant": {"Vacant": tuple(range(1, 8))}})


def tenure_vacancy_gq() -> Dim:
    """One unit variable: tenure, then vacancy, then facility types."""
    labels = (*TENURE, *VACANCY, *FACILITIES[1:])
    return Dim("tenvacgq", labels, {
        "households": {"Occupied": (0, 1, 2, 3)}, "vacant": {"Vacant": tuple(range(4, 11))}, "owned": {"Owned": (0, 1)}, "tenureLevels": {t: (i,) for i, t in enumerate(TENURE)},
        "tenure2Levels": {"Owned": (0, 1), "Not owned": (2, 3)}, "vacancyLevels": {v: (4 + i,) for i, v in enumerate(VACANCY)},
        "spineTypes": {"Housing Unit": tuple(range(11)), **{f: (10 + i,) for i, f in enumerate(FACILITIES) if i}}, "occupiedVacant": {"Occupied": (0, 1, 2, 3), "Vacant": tuple(range(4, 11))},
    })


def unit_kinds() -> Dim:
    """One unit variable of the largest household schema: tenure, vacancy, then every kind of group quarters."""
    labels = (*TENURE, *VACANCY, *GROUP_QUARTERS)
    kinds = {x: (11 + i,) for i, x in enumerate(GROUP_QUARTERS)}
    return Dim("tenvacgq", labels, {"householdTotal": {"Household": (0, 1, 2, 3)}, "hhgq_vector": {"Housing Units": tuple(range(11)), **kinds}, "tenure_2lev": {"Owned": (0, 1), "Not owned": (2, 3)}, "vacant": {"Vacant": tuple(range(4, 11))}, "gqlevels": kinds})


# Names and labels of the recodes of households that follow.


def household_size() -> Dim:
    return Dim("hhsize", HOUSEHOLD_SIZE, {
        "onePerson": {"1 person": (1,)}, "sizeVacant": {"Vacant": (0,)}, "twoPersonsPlus": {"2 or more persons": tuple(range(2, 8))}, "notVacant": {"Occupied": tuple(range(1, 8))}, "sizeVector": {s: (i,) for i, s in enumerate(HOUSEHOLD_SIZE)},
        **{f"size{k}": {f"{k}-person household": (k,)} for k in (1, 2, 3, 4)}, "size2plus": {"2-or-more-person household": tuple(range(2, 8))}, "vacant": {"vacant household": (0,)},
        "sizex0": {HOUSEHOLD_SIZE[k]: (k,) for k in range(1, 8)}, "sizex01": {HOUSEHOLD_SIZE[k]: (k,) for k in range(2, 8)}, "solo": {"Alone": (1,), "Not alone": tuple(range(2, 8))},
    })


def household_age() -> Dim:
    labels = ("15 to 24", "25 to 34", "35 to 44", "45 to 54", "55 to 59", "60 to 64", "65 to 74", "75 to 84", "85 and over")
    return Dim("hhage", labels, {
        "under60": {"Under 60": (0, 1, 2, 3, 4)}, "60plus": {"60 and over": (5, 6, 7, 8)}, "60to64": {"60 to 64": (5,)}, "65to74": {"65 to 74": (6,)}, "75plus": {"75 and over": (7, 8)}, "over24": {"25 and over": tuple(range(1, 9))},
        "age_15to24": {"Householder age is 15 to 24": (0,)}, "hhover24": {"Householder age is over 24": tuple(range(1, 9))}, "age_60plus": {"Householder age is 60 or more": (5, 6, 7, 8)}, "age_under60": {"Householder age is under 60": (0, 1, 2, 3, 4)},
        "age_60to64": {"Householder age is 60 to 64": (5,)}, "age_65to74": {"Householder age is 65 to 74": (6,)}, "age_75plus": {"Householder age is 75 or older": (7, 8)}, "hhover65": {"15 to 64 years": tuple(range(6)), "65 years and over": (6, 7, 8)},
        "hhageH18": {"Householder 15 to 34 years": (0, 1), "Householder 35 to 64 years": (2, 3, 4, 5), "Householder 65 years and over": (6, 7, 8)},
    })


def household_elderly() -> Dim:
    labels = ("None 60 or over", "60 to 64 only", "65 to 74 at most", "75 or over")
    return Dim("elderly", labels, {
        "presence60Plus": {"60 or over": (1, 2, 3)}, "presence65Plus": {"65 or over": (2, 3)}, "presence75Plus": {"75 or over": (3,)},
        "pres_under60": {"No one 60 or older": (0,)}, "pres_under65": {"No one 65+ present": (0, 1)}, "elderly3": {"Someone 75+ present": (3,)}, "invert_elderly0": {"At least one person over 60 present": (1, 2, 3)},
        "invert_elderly1": {"No one below 60 present or someone over 64 present": (0, 2, 3)}, "invert_elderly2": {"No one below 65 present or someone over 74 present": (0, 1, 3)}, "invert_elderly3": {"No one 75+ present": (0, 1, 2)},
        "presence60": {"No one over 60": (0,), "At least one over 60": (1, 2, 3)}, "presence65": {"No one over 65 years": (0, 1), "At least one person over 65 years": (2, 3)}, "presence75": {"No one over 75 years": (0, 1, 2), "At least one person over 75 years": (3,)},
    })


def multigenerational() -> Dim:
    return Dim("multi", ("Not multigenerational", "Multigenerational"), {"multiTrue": {"Multigenerational": (1,)}, "multiFalse": {"Not multigenerational": (0,)}, "yes_multi": {"Multigenerational": (1,)}, "no_multi": {"Not multigenerational": (0,)}})


def householder_race() -> Dim:
    return Dim("hhrace", (*[f"{r} alone" for r in RACES], "two or more races"), {"whiteAlone": {"white alone": (0,)}})


def h1() -> Dim:
    return Dim("h1", ("Vacant", "Occupied"), {"vacantCount": {"Vacant": (0,)}})


def relationship_gq() -> Dim:
    """Relationship in a household, or the kind of group quarters."""
    labels = (*RELATIONSHIPS, *GROUP_QUARTERS)
    n = len(RELATIONSHIPS)
    classes = {c: tuple(n + i for i, g in enumerate(GROUP_QUARTERS) if g[3] == c) for c in sorted({g[3] for g in GROUP_QUARTERS})}
    eight, at = {"HOUSEHOLD": tuple(range(n))}, n
    for label, kinds in CLASSES_OF_QUARTERS.items():
        eight[label] = tuple(range(at, at + kinds))
        at += kinds
    return Dim("relgq", labels, {
        "hhgq8lev": eight, "spouses_unmarried_partners": {"Spouses & Unmarried Partners": (2, 3, 4, 5)}, "people_in_households": {"People in Households": tuple(range(n))}, "gqlevels": {"Household": tuple(range(n)), **{x: (n + i,) for i, x in enumerate(GROUP_QUARTERS)}},
        "gqhh": {"Household": tuple(range(n)), "Group Quarters": tuple(range(n, len(labels)))}, "householders": {"Householder": (0, 1)}, "spousesUnmarriedPartners": {"Spouse or unmarried partner": (2, 3, 4, 5)},
        "children": {"Child of householder": (6, 7, 8)}, "peopleInHouseholds": {"In households": tuple(range(n))}, "gqClasses": {f"GQ {c}00s": ix for c, ix in classes.items()}, **{f"relgq{i}": {x: (i,)} for i, x in enumerate(labels)},
    })


def household_type() -> Dim:
    """24 types by couple, relatives and own children; recodes are predicates over what a type says (see `households`)."""
    return Dim("hhtype", HOUSEHOLD_TYPES, old_type_recodes())


def citizen_race() -> Dim:
    return Dim("cvaprace", CITIZEN_RACES)


def facility_1940() -> Dim:
    return Dim("hhgq1940", FACILITIES_1940, {
        "householdTotal": {"Household": (0,)}, "hhgq2level": {"Household": (0,), "Group Quarters": tuple(range(1, 8))}, "gqTotal": {"Group Quarters": tuple(range(1, 8))}, "gqlevels": {f: (i,) for i, f in enumerate(FACILITIES_1940) if i},
        "instTotal": {"Institutional": (1, 2, 3)}, "instLevels": {f: (i,) for i, f in enumerate(FACILITIES_1940) if i in (1, 2, 3)}, "noninstTotal": {"Noninstitutional": (4, 5, 6, 7)},
    })


def age_category() -> Dim:
    return Dim("agecat", AGE_CATEGORIES, {"votingage": {"Under 18": (0, 1, 2, 3), "18 and over": tuple(range(4, 23))}, "voting": {"18 and over": tuple(range(4, 23))}, "nonvoting": {"Under 18": (0, 1, 2, 3)}})


def age_1940() -> Dim:
    step = lambda w: {f"Under {w} years" if a == 0 else f"{a} to {min(a + w - 1, 115)} years": tuple(range(a, min(a + w, 116))) for a in range(0, 116, w)}
    return Dim("age1940", age().labels, age().recodes | {f"ageGroups{w}": step(w) for w in (4, 16, 64)})


def sex_1940() -> Dim:
    return Dim("sex1940", sex().labels, sex().recodes)


def hispanic_1940() -> Dim:
    return Dim("hispanic1940", hispanic().labels, {"hispTotal": {"Hispanic": (1,)}, "notHispTotal": {"Not Hispanic": (0,)}})


def citizen_1940() -> Dim:
    return Dim("citizen1940", ("Not a Citizen", "Citizen"))


def race_1940() -> Dim:
    return Dim("cenrace1940", RACES_1940)


def unit_facility_demo() -> Dim:
    """Occupied, vacant, or a kind of group quarters."""
    n = len(UNIT_FACILITIES)
    each = {x: (i,) for i, x in enumerate(UNIT_FACILITIES) if i > 1}
    return Dim("hhgq_unit", UNIT_FACILITIES, {"housing_units": {"Housing Units": (0, 1)}, "hhgq_vector": {"Housing Units": (0, 1), **each}, "total_gq": {"Group Quarters": tuple(range(2, n))}, "gqlevels": each, "vacant": {"Vacant": (1,)}})


def relationship() -> Dim:
    """Relationship to the householder, or the kind of group quarters, in the older list."""
    labels = (*RELATIVES, *RELATIVE_FACILITIES)
    n = len(RELATIVES)
    return Dim("rel", labels, {
        "gqlevels": {"Household": tuple(range(n)), **{x: (n + i,) for i, x in enumerate(RELATIVE_FACILITIES)}}, "rel_cantbekids": {"Cannot be younger than 15": (0, 1, 6, 8, 9, 12, 13)},
        "rel_parents": {"Parent": (6, 8)}, "rel_children": {"Child": (2, 3, 4, 9)},
    })


def pl94() -> Schema:
    """Facility x voting age x ethnicity x race: 8 x 2 x 2 x 63 cells."""
    return Schema((facility(), voting_age(), hispanic(), cenrace()))


def persons() -> Schema:
    return Schema((facility(), sex(), age(), hispanic(), cenrace()))


def households() -> Schema:
    return Schema((sex(), household_age(), hispanic(), householder_race(), household_elderly(), tenure()))


def pl94_citizens() -> Schema:
    return Schema((facility(), voting_age(), hispanic(), cenrace(), citizen()))


#: Published tables, name -> queries.
TABLES = {
    "P1": ["total", "numraces", "cenrace"],
    "P2": ["total", "hispanic", "numraces", "cenrace", "hispanic * numraces", "hispanic * cenrace"],
    "P3": ["votingage", "votingage * numraces", "votingage * cenrace"],
    "P4": ["votingage", "votingage * hispanic", "votingage * numraces", "votingage * cenrace", "votingage * hispanic * numraces", "votingage * hispanic * cenrace"],
    "P42": ["household", "institutionalized", "gqlevels"],
    "P5": ["household", "gqTotal", "institutionalized", "gqlevels"],
}
#: The first four by citizenship too: every query also with citizens and others apart.
TABLES |= {f"{t}_CVAP": [*TABLES[t], *["citizen" if q == "total" else f"{q} * citizen" for q in TABLES[t]]] for t in ("P1", "P2", "P3", "P4")}

#: Least and greatest legal age by level of the relationship dimension; other levels have none.
LEGAL_AGES = {
    0: (15, 115), 1: (15, 115), 2: (15, 115), 3: (15, 115), 4: (15, 115), 5: (15, 115), 6: (0, 89), 7: (0, 89), 8: (0, 89), 10: (30, 115), 11: (0, 74), 12: (30, 115), 13: (15, 89), 16: (0, 20),
    18: (15, 115), 19: (15, 115), 20: (15, 115), 21: (15, 115), 22: (15, 115), 23: (17, 65), 24: (0, 25), 25: (0, 25), 26: (0, 25), 27: (20, 115), 31: (17, 65), 32: (3, 30), 33: (16, 65), 34: (17, 65), 35: (17, 65),
    37: (16, 115), 38: (16, 115), 39: (16, 75), 40: (16, 75),
}


def age_rules() -> list[str]:
    """Predicates that no cell of relationship and age may meet, for constraint_structural_zeros."""
    return [f"relgq = {k} and not age between {lo} and {hi}" for k, (lo, hi) in LEGAL_AGES.items()]
