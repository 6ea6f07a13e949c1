"""Invariants, constraints and the top-down fit.

The fit makes children agree with their parent cell by cell: a variance-weighted adjustment, the nearest
non-negative point with the same sum, and largest-remainder rounding. Each is a window over one family's
cell. With the parent's sums as the only constraint this is the optimum of the weighted least squares with
equal weights. With further queries and side constraints `topdown_fit` solves a family as a whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dims import Schema, recode_column
from ..functions.rules import Rule
from ..sources.files import written
from . import family
from .geo import Hier


def invariant_vectors(person_hist: DataFrame, unit_hist: DataFrame, adult: str, types: dict[str, str], count: str = "cnt") -> DataFrame:
    """(geocode, invariant, level, value): totals, adults, units and units by type. types: label -> predicate on units."""
    p = person_hist.groupBy("geocode").agg(F.sum(count).alias("tot"), F.sum(F.when(F.expr(adult), F.col(count)).otherwise(0)).alias("va"))
    u = unit_hist.groupBy("geocode").agg(F.sum(count).alias("units"), *[F.sum(F.when(F.expr(e), F.col(count)).otherwise(0)).alias(f"t{i}") for i, e in enumerate(types.values())])
    row = lambda name, level, c: F.struct(F.lit(name).alias("invariant"), F.lit(level).alias("level"), F.col(c).alias("value"))
    a = p.select("geocode", F.explode(F.array(row("tot", "total", "tot"), row("va", "adults", "va"))).alias("x"))
    b = u.select("geocode", F.explode(F.array(row("gqhh_tot", "total", "units"), *[row("gqhh_vect", t, f"t{i}") for i, t in enumerate(types)])).alias("x"))
    return a.unionByName(b).select("geocode", "x.*")


def invariant_rollup(inv: DataFrame, length: int) -> DataFrame:
    return inv.groupBy(F.substring("geocode", 1, length).alias("geocode"), "invariant", "level").agg(F.sum("value").alias("value"))


def constraint_rollup(cons: DataFrame, own: DataFrame | None, length: int) -> DataFrame:
    """Right-hand sides summed to the parent; the tighter of summed and own bound by name."""
    s = cons.groupBy("name", F.substring("geocode", 1, length).alias("geocode"), "query", "level", "sign").agg(F.sum("rhs").alias("rhs"))
    if own is None:
        return s
    j = s.join(own.withColumnRenamed("rhs", "own_rhs"), ["name", "geocode", "query", "level", "sign"], "full_outer")
    return j.withColumn("rhs", F.when(F.col("sign") == "le", F.least("rhs", "own_rhs")).when(F.col("sign") == "ge", F.greatest("rhs", "own_rhs")).otherwise(F.coalesce("own_rhs", "rhs"))).drop("own_rhs")


def _cons(df: DataFrame, name: str, query: str, level, sign: str, rhs) -> DataFrame:
    return df.select(F.lit(name).alias("name"), "geocode", F.lit(query).alias("query"), (F.lit(level) if isinstance(level, str) else level).alias("level"), F.lit(sign).alias("sign"), rhs.cast("long").alias("rhs"))


def constraint_gq_bounds(units: DataFrame, totals: DataFrame, cap: int = 99_999, kind: str = "type", n: str = "units") -> DataFrame:
    """Persons per facility type: at least one a facility; at most the total less one for every facility of other types, and cap a facility.

    units: (geocode, type, units); totals: (geocode, total).
    """
    w = Window.partitionBy("geocode")
    j = units.join(totals, "geocode").withColumn("others", F.sum(n).over(w) - F.col(n))
    upper = F.when(F.col(n) == 0, 0).otherwise(F.least(F.col("total") - F.col("others"), F.col(n) * cap))
    return _cons(j, "gq_lower", kind, F.col(kind).cast("string"), "ge", F.col(n)).unionByName(_cons(j, "gq_upper", kind, F.col(kind).cast("string"), "le", upper))


def constraint_gq_voting_bounds(units: DataFrame, ages: DataFrame, cap: int = 99_999, kind: str = "type", n: str = "units") -> DataFrame:
    """Minors and adults per facility type: none without a facility, otherwise no more than there are and cap a facility. ages: (geocode, minors, adults)."""
    j = units.join(ages, "geocode")
    bound = lambda c: F.when(F.col(n) == 0, 0).otherwise(F.least(F.col(c), F.col(n) * cap))
    level = lambda c: F.concat(F.col(kind).cast("string"), F.lit(f" BY {c}"))
    least = F.greatest(F.lit(0), F.col(n) - F.col("minors"))
    return reduce(DataFrame.unionByName, [_cons(j, "gq_va_upper", f"{kind} * votingage", level("minors"), "le", bound("minors")), _cons(j, "gq_va_upper", f"{kind} * votingage", level("adults"), "le", bound("adults")), _cons(j, "gq_va_lower", f"{kind} * votingage", level("adults"), "ge", least)])


def constraint_total(inv: DataFrame) -> DataFrame:
    return _cons(inv.filter("invariant = 'tot'"), "total", "total", "total", "=", F.col("value"))


def constraint_voting_age(inv: DataFrame) -> DataFrame:
    return _cons(inv.filter("invariant = 'va'"), "voting_age", "votingage", "adults", "=", F.col("value"))


def constraint_nursing_minors(inv: DataFrame) -> DataFrame:
    return _cons(inv.select("geocode").distinct(), "nurse_nva_0", "nursing * nonvoting", "Nursing BY minors", "=", F.lit(0))


def constraint_structural_zeros(hist: DataFrame, rules: list[str], count: str = "cnt") -> DataFrame:
    """Non-zero cells that a rule (predicate) forbids, with the rule."""
    hit = F.array_compact(F.array(*[F.when(F.expr(r), F.lit(r)) for r in rules]))
    return hist.filter(F.col(count) > 0).withColumn("rule", F.explode(hit))


def constraint_household_bounds(hist: DataFrame, rules: list[tuple[str, str, float]], count: str = "cnt") -> DataFrame:
    """rules: (counted predicate, bounding predicate, factor): count(a) <= factor * count(b) in every geounit; lists failures."""
    s = hist.groupBy("geocode").agg(*[F.sum(F.when(F.expr(e), F.col(count)).otherwise(0)).alias(f"{k}{i}") for i, r in enumerate(rules) for k, e in (("a", r[0]), ("b", r[1]))])
    row = [F.when(F.col(f"a{i}") > r[2] * F.col(f"b{i}"), F.struct(F.lit(r[0]).alias("rule"), F.col(f"a{i}").alias("lhs"), (r[2] * F.col(f"b{i}")).cast("double").alias("bound"))) for i, r in enumerate(rules)]
    return s.select("geocode", F.explode(F.array_compact(F.array(*row))).alias("x")).select("geocode", "x.*")


def constraint_household_size(hist: DataFrame, forbidden: DataFrame, dims: list[str], count: str = "cnt") -> DataFrame:
    """Non-zero cells of a table of forbidden cells."""
    return hist.filter(F.col(count) > 0).join(forbidden.select(*dims), dims, "left_semi")


def constraint_cross_universe(a: DataFrame, b: DataFrame, sign: str = "=", count: str = "cnt") -> DataFrame:
    """Geounits in which the totals of two universes break ``a sign b``."""
    t = lambda df, n: df.groupBy("geocode").agg(F.sum(count).alias(n))
    j = t(a, "x").join(t(b, "y"), "geocode", "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("x", "y")})
    return j.filter({"=": F.col("x") != F.col("y"), "le": F.col("x") > F.col("y"), "ge": F.col("x") < F.col("y")}[sign])


def constraint_check(answers: DataFrame, cons: DataFrame, tol: float = 0.001) -> DataFrame:
    """Every constraint with its left-hand side (absent: 0) and whether it holds."""
    j = cons.join(answers.select("geocode", "query", "level", F.col("value").alias("lhs")), ["geocode", "query", "level"], "left").withColumn("lhs", F.coalesce("lhs", F.lit(0)))
    d = F.col("lhs") - F.col("rhs")
    return j.withColumn("ok", F.when(F.col("sign") == "=", F.abs(d) <= tol).when(F.col("sign") == "le", d <= tol).otherwise(d >= -tol))


def constraint_rules(hists: dict[str, DataFrame], schemas: dict[str, Schema], rules: list[Rule], invariants: DataFrame | None = None, count: str = "cnt") -> DataFrame:
    """(rule, geocode, level, sign, lhs, rhs, ok) of a schema's whole rule set, in one spread and one sum.

    hists: universe -> (geocode, dims, count); schemas: their dimensions; invariants: (geocode, invariant, level, value). Every cell
    goes to the (rule, level) pairs whose query holds it, with the factor of its universe; all left-hand sides are then one
    aggregation, whatever the number of rules. A geounit without such cells has 0 on the left where an invariant asks
    for something; structural zeros without cells hold and give no row.
    """

    def level(rule: Rule, universe: str) -> Column:
        """The level's name in the rule's first universe: the universes' levels belong together in order."""
        first = next(iter(rule.terms))
        names, own = schemas[first].levels(rule.terms[first][0]), schemas[universe].levels(rule.terms[universe][0])
        if len(names) != len(own):
            raise ValueError(f"{rule.name}: queries of different numbers of levels")
        at = schemas[universe].level(rule.terms[universe][0])
        return at if names == own else F.when(at.isNotNull(), recode_column(at, dict(zip(own, names, strict=True))))

    parts = []
    for universe in schemas:
        held = [(r, level(r, universe), r.terms[universe][1]) for r in rules if universe in r.terms]
        if not held:
            continue
        each = [F.when(at.isNotNull(), F.struct(F.lit(r.name).alias("rule"), at.alias("level"), F.lit(factor).cast("long").alias("factor"))) for r, at, factor in held]
        spread = hists[universe].select("geocode", F.col(count).alias("_n"), F.explode(F.array_compact(F.array(*each))).alias("_x"))
        parts.append(spread.select("geocode", "_x.rule", "_x.level", (F.col("_x.factor") * F.col("_n")).alias("lhs"), F.lit(None).cast("long").alias("rhs")))
    named = {}
    for r in rules:
        if isinstance(r.rhs, str):
            named.setdefault(r.rhs, []).append(r.name)
    if named and invariants is not None:
        of = F.create_map(*[x for k, v in named.items() for x in (F.lit(k), F.lit(v))])
        known = invariants.withColumn("rule", F.explode(F.try_element_at(of, F.col("invariant"))))
        parts.append(known.select("geocode", "rule", "level", F.lit(None).cast("long").alias("lhs"), F.col("value").cast("long").alias("rhs")))
    sums = reduce(DataFrame.unionByName, parts).groupBy("rule", "geocode", "level").agg(F.coalesce(F.sum("lhs"), F.lit(0)).alias("lhs"), F.sum("rhs").alias("rhs"))
    sign = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.sign))])[F.col("rule")]
    fixed = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.rhs if isinstance(r.rhs, int) else 0))])[F.col("rule")]
    out = sums.withColumns({"sign": sign, "rhs": F.coalesce("rhs", fixed.cast("long"))})
    d = F.col("lhs") - F.col("rhs")
    return out.select("rule", "geocode", "level", "sign", "lhs", "rhs", F.when(F.col("sign") == "=", d == 0).when(F.col("sign") == "le", d <= 0).otherwise(d >= 0).alias("ok"))


# the fit: child (geocode, parent_geocode, cell..., x[, variance]); parent (geocode, cell..., total)


def _family(parent: DataFrame, child: DataFrame, cell: list[str]) -> DataFrame:
    up = parent.select(F.col("geocode").alias("parent_geocode"), *cell, F.col("total").alias("_total"))
    return child.join(up, ["parent_geocode", *cell], "left").withColumn("_total", F.coalesce("_total", F.lit(0)))


def topdown_consistent(parent: DataFrame, child: DataFrame, cell: list[str], var: str | None = None) -> DataFrame:
    """x + (P - sum x) v / sum v: children that add up to the parent, moved most where they are least certain."""
    w = Window.partitionBy("parent_geocode", *cell)
    v = F.lit(1.0) if var is None else F.col(var)
    return _family(parent, child, cell).withColumn("x", F.col("x") + (F.col("_total") - F.sum("x").over(w)) * v / F.sum(v).over(w)).drop("_total")


def topdown_nonnegative(parent: DataFrame, child: DataFrame, cell: list[str]) -> DataFrame:
    """Projection on {x >= 0, sum x = P}: theta = max over k of (sum of the k largest - P) / k."""
    w = Window.partitionBy("parent_geocode", *cell)
    order = w.orderBy(F.col("x").desc(), "geocode")
    f = _family(parent, child, cell).withColumns({"_s": F.sum("x").over(order.rowsBetween(Window.unboundedPreceding, 0)), "_k": F.row_number().over(order)})
    theta = F.max((F.col("_s") - F.col("_total")) / F.col("_k")).over(w)
    return f.withColumn("x", F.greatest(F.col("x") - theta, F.lit(0.0))).drop("_s", "_k", "_total")


def topdown_round(parent: DataFrame, child: DataFrame, cell: list[str]) -> DataFrame:
    """Floors, and one more for the largest fractions until the sum is the parent's (ties: smallest geocode)."""
    w = Window.partitionBy("parent_geocode", *cell)
    near = F.round(F.col("x"), 9)
    f = _family(parent, child, cell).withColumns({"_f": F.floor(near).cast("long"), "_r": near - F.floor(near)})
    k = F.row_number().over(w.orderBy(F.col("_r").desc(), "geocode"))
    more = F.round(F.col("_total") - F.sum("_f").over(w)).cast("long")
    return f.withColumn("x", F.col("_f") + (k <= more).cast("long")).drop("_f", "_r", "_total")


def topdown_shortcuts(parent: DataFrame, child: DataFrame, cell: list[str]) -> DataFrame:
    """An only child takes its parent's value, children of an empty cell are 0; ``settled`` marks both."""
    f = _family(parent, child, cell)
    only, empty = F.count(F.lit(1)).over(Window.partitionBy("parent_geocode", *cell)) == 1, F.col("_total") == 0
    return f.withColumn("settled", only | empty).withColumn("x", F.when(F.col("settled"), F.col("_total").cast("double")).otherwise(F.col("x"))).drop("_total")


def fit_level(parent: DataFrame, child: DataFrame, cell: list[str], var: str | None = "variance") -> DataFrame:
    even = topdown_consistent(parent, child, cell, var)
    return topdown_round(parent, topdown_nonnegative(parent, even, cell), cell)


def topdown_queries(parent: DataFrame, child: DataFrame, cell: list[str], answers: DataFrame, level_of: dict[str, str], rounds: int = 8) -> DataFrame:
    """Children fitted to the noisy answers of further queries too, and to the parent's cells.

    answers: (geocode, query, level, noisy, variance); level_of: query -> expression over cell columns that gives a cell's
    level. The least-squares fit, weighted by 1 / variance, is the projection of cells and answers onto the planes "a level's
    cells add up to its answer" and "children add up to the parent"; projecting on one after the other converges to
    it, and the last one leaves sums exact. Every step is a window inside a parent's family, so after one shuffle nothing
    moves. Levels without an answer bind nothing.
    """
    f = _family(parent, child, cell)
    for i, (query, level) in enumerate(level_of.items()):
        a = answers.filter(F.col("query") == query).select("geocode", F.col("level").alias(f"_l{i}"), F.col("noisy").cast("double").alias(f"_y{i}"), F.col("variance").cast("double").alias(f"_v{i}"))
        f = f.withColumn(f"_l{i}", F.expr(level)).join(a, ["geocode", f"_l{i}"], "left")
    f = f.repartition("parent_geocode")
    for _ in range(rounds):
        for i in range(len(level_of)):
            w = Window.partitionBy("parent_geocode", "geocode", f"_l{i}")
            share = (F.sum("x").over(w) - F.col(f"_y{i}")) / (F.sum("variance").over(w) + F.col(f"_v{i}"))
            f = f.withColumn("_share", F.coalesce(share, F.lit(0.0))).withColumns({"x": F.col("x") - F.col("variance") * F.col("_share"), f"_y{i}": F.col(f"_y{i}") + F.col(f"_v{i}") * F.col("_share")})
        w = Window.partitionBy("parent_geocode", *cell)
        f = f.withColumn("x", F.col("x") + (F.col("_total") - F.sum("x").over(w)) * F.col("variance") / F.sum("variance").over(w))
    return f.select(*child.columns)


def _beside(child: DataFrame, level_of: dict[str, str], answers: DataFrame | None, bounds: DataFrame | None) -> DataFrame:
    """child with, for every query i, its cell's level _l{i}, the noisy answer _y{i} with variance _v{i}, and bounds _lo{i} and _hi{i}."""
    f = child
    for i, (query, level) in enumerate(level_of.items()):
        f = f.withColumn(f"_l{i}", F.expr(level).cast("string"))
        none = F.lit(None).cast("double")
        if answers is None:
            f = f.withColumns({f"_y{i}": none, f"_v{i}": none})
        else:
            a = answers.filter(F.col("query") == query).select("geocode", F.col("level").alias(f"_l{i}"), F.col("noisy").cast("double").alias(f"_y{i}"), F.col("variance").cast("double").alias(f"_v{i}"))
            f = f.join(a, ["geocode", f"_l{i}"], "left")
        if bounds is None:
            f = f.withColumns({f"_lo{i}": none, f"_hi{i}": none})
        else:
            side = lambda agg, sign: agg(F.when(F.col("sign").isin("=", sign), F.col("rhs").cast("double")))
            b = bounds.filter(F.col("query") == query).groupBy("geocode", F.col("level").alias(f"_l{i}")).agg(side(F.max, "ge").alias(f"_lo{i}"), side(F.min, "le").alias(f"_hi{i}"))
            f = f.join(b, ["geocode", f"_l{i}"], "left")
    return f


def _family_fit(cell: list[str], n: int, nested: list[int], real: bool):
    """A task's helper: fits and rounds the rows of one family (see `family`)."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        column, first = family.numbered(*[f[c] for c in cell])
        total = f["_total"].to_numpy(float)[first]
        column[np.isnan(total)[column]] = -1
        sums, groups, soft, hard = family.Hard(column, total, total), [], [], []
        for i in range(n):
            group, heads = family.numbered(f["geocode"], f[f"_l{i}"])
            groups.append(group)
            y, v, low, high = (f[f"{c}{i}"].to_numpy(float)[heads] for c in ("_y", "_v", "_lo", "_hi"))
            of = lambda has, group=group: np.where((group >= 0) & has[np.maximum(group, 0)], group, -1) if len(has) else group
            if (has := ~np.isnan(y)).any():
                soft.append(family.Soft(of(has), np.where(has, y, 0), np.where(has, v, 1)))
            if (has := ~np.isnan(low) | ~np.isnan(high)).any():
                hard.append(family.Hard(of(has), np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)))
        x, residual = f["x"].to_numpy(float), 0.0
        if real:
            x, residual = family.fit(x, f["variance"].to_numpy(float), sums, soft, hard)
        whole = family.controlled_round(x, column, np.nan_to_num(total), [groups[i] for i in sorted(nested, key=lambda i: groups[i].max(initial=0))])
        return f[["geocode", "parent_geocode", *cell]].assign(x=whole, fitted=x, residual=residual)

    return run


def _by_family(f: DataFrame, cell: list[str], level_of: dict[str, str], nested: list[str] | None, real: bool) -> DataFrame:
    kinds = dict(f.dtypes)
    names = list(level_of)
    keep = [names.index(q) for q in (names if nested is None else nested)]
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in ("geocode", "parent_geocode", *cell)) + ", x long, fitted double, residual double"
    return f.groupBy("parent_geocode").applyInPandas(_family_fit(cell, len(names), keep, real), shape)


def topdown_round_queries(parent: DataFrame, child: DataFrame, cell: list[str], level_of: dict[str, str]) -> DataFrame:
    """Controlled rounding: integers next to x whose sums are the parent's cells and stay within one of the real sum of every
    query level of every child. The queries' levels must be nested (each level of one lies in one level of the coarser).

    Of all such roundings it is one with the least sum of |x - integer|. x must add up to the parent. A family is one task's
    work: it is bounded by the hierarchy's children and the schema's cells.
    """
    f = _beside(_family(parent, child, cell), level_of, None, None)
    return _by_family(f.withColumn("variance", F.lit(1.0)), cell, level_of, None, False).select("geocode", "parent_geocode", *cell, "x", "fitted")


def topdown_fit(parent: DataFrame | None, child: DataFrame, cell: list[str], level_of: dict[str, str], answers: DataFrame | None = None, bounds: DataFrame | None = None, nested: list[str] | None = None) -> DataFrame:
    """(geocode, parent_geocode, cell, x, fitted, residual): the whole fit of every family in one pass.

    fitted: the least-squares fit of cells (variance) and answers (geocode, query, level, noisy, variance) at once, under the parent's
    cells, bounds (geocode, query, level, sign, rhs) and x >= 0. x: its controlled rounding, which keeps whole bounds,
    for the queries in nested (all by default). Without a parent (the root) cells have no sums to keep. ``residual`` is over 1e-8
    where the bounds of a family contradict each other; its sums hold all the same.
    """
    f = child.withColumn("_total", F.lit(None).cast("double")) if parent is None else _family(parent, child, cell)
    return _by_family(_beside(f, level_of, answers, bounds), cell, level_of, nested, True)


def topdown_levels(
    meas: DataFrame, hier: Hier, cell: list[str], checkpoint=None, level_of: dict[str, str] | None = None, answers: DataFrame | None = None, bounds: DataFrame | None = None, nested: list[str] | None = None
) -> DataFrame:
    """(geolevel, geocode, cell, x): from the root down, one plan a level. meas: (geolevel, geocode, cell, noisy, variance).

    Without queries the root is its own measurement, rounded and not negative, and the levels below are windows. With level_of
    (query -> expression that gives a cell's level), answers (geolevel, geocode, query, level, noisy, variance) and bounds (geolevel, geocode,
    query, level, sign, rhs) enter every level's fit, the root's too, as in `topdown_fit`. ``checkpoint`` (a function of a DataFrame)
    cuts lineage between levels: each is written and read by the next, so no plan holds those above it.
    """
    checkpoint = checkpoint or written
    level, n = hier[0]
    at = lambda df, level: None if df is None else df.filter(F.col("geolevel") == level)
    rows = lambda level, up: at(meas, level).select("geocode", up.alias("parent_geocode"), *cell, F.col("noisy").cast("double").alias("x"), F.col("variance").cast("double").alias("variance"))
    if level_of is None:
        now = at(meas, level).select("geocode", *cell, F.greatest(F.round("noisy").cast("long"), F.lit(0)).cast("long").alias("x"))
    else:
        now = checkpoint(topdown_fit(None, rows(level, F.lit("")), cell, level_of, at(answers, level), at(bounds, level), nested).select("geocode", *cell, "x"))
    out = [now.withColumn("geolevel", F.lit(level))]
    for level, _ in hier[1:]:
        child, parent = rows(level, F.substring("geocode", 1, n)), now.withColumnRenamed("x", "total")
        fitted = fit_level(parent, child, cell) if level_of is None else topdown_fit(parent, child, cell, level_of, at(answers, level), at(bounds, level), nested)
        now = checkpoint(fitted.select("geocode", *cell, "x"))
        out.append(now.withColumn("geolevel", F.lit(level)))
        n = dict(hier)[level]
    return reduce(DataFrame.unionByName, out).select("geolevel", "geocode", *cell, "x")


def topdown_state_groups(parent: DataFrame, child: DataFrame, cell: list[str], group: str) -> DataFrame:
    """Consistency with a group's total: the parts of a state that differ in the code's first digit only.

    group: expression over a child's geocode; parent: (geocode = group, cell, total).
    """
    grouped = child.drop("parent_geocode").withColumn("parent_geocode", F.expr(group))
    return topdown_consistent(parent, grouped, cell)


def topdown_bounds_clip(child: DataFrame, cell: list[str], rounds: int = 4) -> DataFrame:
    """x within [lo, hi]; what a clip takes or adds goes to the siblings that have room, in fixed rounds.

    In each round a family's residual is shared in proportion to the room left; the last shares are whole.
    """
    w = Window.partitionBy("parent_geocode", *cell)
    f = child.withColumn("_goal", F.sum("x").over(w)).withColumn("x", F.least(F.greatest("x", "lo"), "hi"))
    for _ in range(rounds):
        f = f.withColumn("_miss", F.col("_goal") - F.sum("x").over(w))
        room = F.when(F.col("_miss") > 0, F.col("hi") - F.col("x")).when(F.col("_miss") < 0, F.col("x") - F.col("lo")).otherwise(0)
        f = f.withColumn("_room", room)
        upto = F.sum("_room").over(w.orderBy("geocode").rowsBetween(Window.unboundedPreceding, 0))
        take = F.greatest(F.lit(0), F.least(F.col("_room"), F.abs("_miss") - (upto - F.col("_room"))))
        f = f.withColumn("_take", take).withColumn("x", F.col("x") + F.signum("_miss").cast("long") * F.col("_take")).drop("_take")
    return f.drop("_goal", "_miss", "_room")


def topdown_infeasible_count(fit: DataFrame) -> DataFrame:
    """Families by level that keep a residual or break a bound. fit: (geolevel, parent_geocode, cell sums as total and x)."""
    bad = fit.groupBy("geolevel", "parent_geocode").agg(F.max((F.col("total") != F.col("x")).cast("int")).alias("bad"))
    return bad.groupBy("geolevel").agg(F.sum("bad").cast("long").alias("infeasible"))


def cap_by_reference(df: DataFrame, ref: DataFrame, keys: list[str], col: str = "priv") -> DataFrame:
    """Counts no larger than the public ones; positive rows only."""
    cap = ref.select(*keys, F.col("cnt").alias("_cap"))
    return df.join(cap, keys).withColumn(col, F.least(col, "_cap")).drop("_cap").filter(F.col(col) > 0)
