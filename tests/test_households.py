"""Household types made by rule, and their recodes."""

import pytest
from pyspark.errors import PySparkException

from cellarium.functions import attributes as A
from cellarium.functions import households as H
from cellarium.functions import rules as R
from cellarium.operators import recode


def test_types_and_labels():
    assert len(H.TYPES) == 522 == len({H.label(h) for h in H.TYPES}) and len(H.OLD_TYPES) == 24 == len(A.HOUSEHOLD_TYPES)
    for i, text in {0: "Size 3, not multig, married opposite-sex with oc u6 only, no cxhhsup 6to17", 392: "Size 1, not multig, no spouse or partner, living alone, no c", 436: "Size 3, not multig, no spouse or partner, with oc both", 516: "Size 2, not multig, no spouse or partner with no relatives, no oc, no cxhhsup, but has c"}.items():
        assert H.label(H.TYPES[i]) == text


def test_every_household_of_up_to_seven_that_can_be_has_a_type():
    """All combinations against the rules for what a household must hold."""
    for h in H.TYPES:
        assert h.alone == (h.size == 1) and (h.relatives or not h.multi) and (h.relatives or not h.own) and (h.minor or not h.child)
        assert h.size >= 1 + bool(h.couple) + {"": 0, "both": 2}.get(h.child, 1)
        assert not h.multi or h.size >= 3
    grown = {(h.couple, h.sexes, h.relatives, h.own, h.child, h.minor, h.multi): h.size for h in H.TYPES if not h.alone}
    assert set(grown.values()) == {7}  # a type that exists for one size exists for all larger ones


def test_old_types_agree_with_their_names():
    dim = A.household_type()
    for name, word in (("married_with_children_indicator", "Married"), ("cohabiting", "Cohabiting"), ("no_spouse_or_partner", "No spouse")):
        assert {i for ix in dim.recodes[name].values() for i in ix} == {i for i, x in enumerate(A.HOUSEHOLD_TYPES) if x.startswith(word)}
    assert dim.recodes["ownchild_under18"]["Householder has own child under 18"] == tuple(i for i, x in enumerate(A.HOUSEHOLD_TYPES) if "with own children" in x)
    assert dim.recodes["alone"]["Alone"] == (18,) and dim.recodes["never_multi"].popitem()[1] == (12, 17, 18, 23)


def test_partitions_of_the_largest_schema():
    rec = H.household_type_full().recodes
    both = [rec["family"]["Family"], rec["nonfamily"]["Non-Family"]]
    assert sorted(i for ix in both for i in ix) == list(range(522))
    assert sorted(rec["marriedfamily"]["Married Family"] + rec["otherfamily"]["Other Family"]) == list(rec["family"]["Family"])
    assert rec["type3_twochild"]["Size 3, two children"] == (436,) and len(rec["type3_couple_with_child"].popitem()[1]) == 8 and rec["type4_couple_with_twochildren"].popitem()[1] == (34, 120, 206, 316)


@pytest.mark.parametrize(("rules", "schema"), [(R.LARGEST, H.largest()), (R.HOUSEHOLDS_2010, H.households_2010())])
def test_every_rule_is_a_query_of_its_schema(rules, schema):
    assert len({r.name for r in rules}) == len(rules)
    for r in rules:
        if "main" in r.terms:
            assert schema.levels(r.terms["main"][0])


def test_recodes_with_defaults_and_unknown_types(spark):
    df = spark.createDataFrame([(0,), (18,), (99,)], "t int")
    got = recode.recode_household_type(df, "t", {"own": [0], "couple": A.household_type().recodes["couplelevels"]}, "unknown").collect()
    assert [(r.own, r.couple) for r in got] == [(1, "Married"), (0, "All others"), (0, "unknown")]
    bad = spark.createDataFrame([(600, 0, 0, 0, 0, 0, 0, "1")], "hhtype_dhch int, sex int, hhage int, hispanic int, hhrace int, elderly int, hhtenshort int, geocode string")
    with pytest.raises(PySparkException, match="no such household type"):
        recode.recode_output_largest(bad).collect()
