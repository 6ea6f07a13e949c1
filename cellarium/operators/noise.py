"""Budget tables, measurements and integer noise as column expressions.

Noise is drawn from seeded column generators, or from a uniform column that the caller gives (``u``), so
that a run replays; it is not meant for the publication of confidential data.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dims import Schema
from ..functions.strategies import Strategy
from .geo import Hier
from .hist import geo_rollup
from .query import query_answer_many, table_full_workload


def uniform(key: Column) -> Column:
    """A uniform number in (0, 1) from an integer key, the same in every engine."""
    return (F.pmod(key * F.lit(1103515245) + 12345, F.lit(2147483648)) + 0.5) / 2147483648.0


def budget_attach(meas: DataFrame, alloc: DataFrame, scale: tuple[int, int], framework: str = "zcdp") -> DataFrame:
    """Measurements with their inverse scale: q g / s^2 for zCDP, q g / s for pure privacy; s = scale.

    alloc: (geolevel, query, geo_num, geo_den, q_num, q_den), a fixed table of levels times queries that passes the driver, so that all
    sums are exact fractions whatever the denominators. ``budget_error`` where a level's query proportions do not sum to 1 or one is not positive.
    A scale whose terms exceed 64 bits is reduced, and one that still does stops the job.
    """
    num, den = scale
    power = 2 if framework == "zcdp" else 1
    rows, by_level = alloc.collect(), {}
    for r in rows:
        by_level.setdefault(r["geolevel"], []).append(Fraction(r["q_num"], r["q_den"]))
    bad = {level: sum(shares) != 1 or min(shares) <= 0 for level, shares in by_level.items()}
    scaled = [(r["geolevel"], r["query"], *_terms(r["q_num"] * r["geo_num"] * den**power, r["q_den"] * r["geo_den"] * num**power), bad[r["geolevel"]]) for r in rows]
    a = meas.sparkSession.createDataFrame(scaled, "geolevel string, query string, inv_scale_num long, inv_scale_den long, budget_error boolean")
    return meas.join(F.broadcast(a), ["geolevel", "query"], "left")  # levels x queries


def _terms(num: int, den: int) -> tuple[int, int]:
    """A fraction's terms as they are, or reduced where they are too long for 64 bits."""
    if max(abs(num), den) < 1 << 63:
        return num, den
    f = Fraction(num, den)
    if max(abs(f.numerator), f.denominator) >= 1 << 63:
        raise OverflowError(f"inverse scale {f} exceeds 64 bits")
    return f.numerator, f.denominator


def budget_rollup(meas: DataFrame, order: list[str]) -> DataFrame:
    """Spent by (level, query), by level, by query and in all, and cumulative from the lowest level up.

    A budget is spent once a level: all geounits of a level share it.
    """
    spent = meas.groupBy("geolevel", "query").agg(F.max(F.col("inv_scale_num") / F.col("inv_scale_den")).alias("spent"))
    sets = spent.groupingSets([["geolevel", "query"], ["geolevel"], ["query"], []], "geolevel", "query").agg(F.sum("spent").alias("spent"), F.grouping("geolevel").alias("g1"), F.grouping("query").alias("g2"))
    place = F.array_position(F.lit(order), F.col("geolevel"))
    run = F.sum("spent").over(Window.partitionBy("g1", "g2").orderBy(place.desc()))
    return sets.select("geolevel", "query", "spent", F.when((F.col("g1") == 0) & (F.col("g2") == 1), run).alias("cumulative"))


def budget_node_spent(meas: DataFrame) -> DataFrame:
    """Budget of a geounit by level; ``uneven`` where geounits of a level differ."""
    node = meas.groupBy("geolevel", "geocode").agg(F.sum(F.col("inv_scale_num") / F.col("inv_scale_den")).alias("spent"))
    return node.groupBy("geolevel").agg(F.min("spent").alias("least"), F.max("spent").alias("most"), (F.max("spent") - F.min("spent") > 1e-12).alias("uneven"))


def budget_cell_impact(meas: DataFrame, recode_map: DataFrame, sens: float = 2.0) -> DataFrame:
    """By level: least and most of a cell's sum of 2 eps / sens over the queries that cover it. recode_map: (query, cell)."""
    eps = meas.groupBy("geolevel", "query").agg(F.max(F.col("inv_scale_num") / F.col("inv_scale_den")).alias("eps"))
    cell = eps.join(recode_map, "query").groupBy("geolevel", "cell").agg(F.sum(2 * F.col("eps") / sens).alias("x"))
    return cell.groupBy("geolevel").agg(F.min("x").alias("least"), F.max("x").alias("most"))


def budget_impact_gaps(recode_map: DataFrame, cells: DataFrame) -> DataFrame:
    """(query, cell, times) of cells that a query covers other than once. recode_map: (query, cell, coef); cells: (cell)."""
    names = sorted(r["query"] for r in recode_map.select("query").distinct().collect())  # a workload's queries
    got = recode_map.groupBy("query", "cell").agg(F.sum(F.abs("coef")).alias("times"))
    by_cell = got.groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("query", "times"))).alias("m"))
    rows = cells.join(by_cell, "cell", "left").select("cell", F.explode(F.lit(names)).alias("query"), "m")
    return rows.select("query", "cell", F.coalesce(F.try_element_at("m", F.col("query")), F.lit(0)).alias("times")).filter("times <> 1")


def measure_query_answers(hist: DataFrame, hier: Hier, names: list[str], schema: Schema, count: str = "cnt") -> DataFrame:
    """True answers of all queries at all geounits, zeros included: (geolevel, geocode, query, level, truth)."""
    rolled = geo_rollup(hist, hier, schema.names, (count,))
    answers = query_answer_many(rolled, names, schema, ["geolevel", "geocode"], (count,))
    return table_full_workload(answers, names, schema, ["geolevel", "geocode"], (count,)).select("geolevel", "geocode", "query", "level", F.col(count).alias("truth"))


def measure_strategy(hist: DataFrame, hier: Hier, schema: Schema, strategy: Strategy, scale: tuple[int, int], count: str = "cnt") -> DataFrame:
    """(geolevel, geocode, query, level, truth, inv_scale_num, inv_scale_den) of a whole strategy: every level's own queries, in one rollup and one spread.

    The strategy is checked first (see `Strategy.check`). Answers that are 0 have no row; `table_full_workload` adds them where noise is drawn for them too.
    """
    strategy.check(schema, [level for level, _ in hier])
    rolled = geo_rollup(hist, hier, schema.names, (count,))
    names = list(dict.fromkeys(q for queries in strategy.queries.values() for q in queries))
    pairs = F.array(*[F.struct(F.lit(q).alias("query"), schema.level(q).alias("level")) for q in names])
    asked = F.create_map(*[x for level, queries in strategy.queries.items() for x in (F.lit(level), F.lit(list(queries)))])[F.col("geolevel")]
    spread = rolled.withColumn("_q", F.explode(F.filter(pairs, lambda x: x["level"].isNotNull() & F.array_contains(asked, x["query"]))))
    answers = spread.groupBy("geolevel", "geocode", "_q.query", "_q.level").agg(F.sum(count).alias("truth"))
    alloc = hist.sparkSession.createDataFrame(strategy.rows(), "geolevel string, query string, geo_num long, geo_den long, q_num long, q_den long")
    return budget_attach(answers, alloc, scale).drop("budget_error")


def noise_geometric(df: DataFrame, col: str, eps: Column, sens: int = 1, bounded: bool = True, u: tuple[Column, Column] | None = None, seed: int = 0) -> DataFrame:
    """Two-sided geometric noise: p = 1 - exp(-eps / sensitivity), variance 2 (1 - p) / p^2."""
    s = sens * (2 if bounded else 1)
    p = 1 - F.exp(-eps / s)
    u1, u2 = u or (1 - F.rand(seed), 1 - F.rand(seed + 1))
    g = lambda x: F.floor(F.log(x) / F.log(1 - p))
    return df.withColumns({"noisy": (F.col(col) + g(u1) - g(u2)).cast("long"), "variance": 2 * (1 - p) / (p * p)})


def gaussian_table(sigma_sq: float) -> list[tuple[int, float]]:
    """(value, cumulative probability) of the integer Gaussian, out to 12 standard deviations."""
    reach = math.ceil(12 * math.sqrt(sigma_sq)) + 1
    p = [math.exp(-x * x / (2 * sigma_sq)) for x in range(-reach, reach + 1)]
    total, cum, out = sum(p), 0.0, []
    for x, q in zip(range(-reach, reach + 1), p, strict=True):
        cum += q / total
        out.append((x, cum))
    return out


def noise_discrete_gaussian(df: DataFrame, col: str, sigma_sq: float, u: Column | None = None, seed: int = 0) -> DataFrame:
    """Integer Gaussian noise by its cumulative table, and its variance (sigma^2 above 100)."""
    table = gaussian_table(sigma_sq)
    var = sigma_sq if sigma_sq > 100 else sum(x * x * (c - b) for (x, c), (_, b) in zip(table, [(0, 0.0), *table], strict=False))
    df = df.withColumn("_u", F.rand(seed) if u is None else u)  # one draw a row, however often it is compared
    cum = F.lit([c for _, c in table])
    steps = F.lit([1 << k for k in reversed(range(len(table).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(F.coalesce(F.get(cum, lo + step - 1) < F.col("_u"), F.lit(False)), lo + step).otherwise(lo))
    return df.withColumns({"noisy": (F.col(col) + table[0][0] + F.least(at, F.lit(len(table) - 1))).cast("long"), "variance": F.lit(float(var))}).drop("_u")


#: Bits of the integers that exact draws compare.
BITS = 62


def gaussian_integers(sigma_sq: Fraction, bits: int = BITS) -> list[tuple[int, int]]:
    """(value, cumulative probability times 2^bits, rounded down) of the integer Gaussian; the last is 2^bits.

    Values go out to where what is beyond weighs less than 2^-bits. The weights are summed as decimals of 80 digits, so each integer
    is the exact one but where the true number lies within 10^-60 of the next.
    """
    with localcontext() as c:
        c.prec = 80
        s2 = Decimal(sigma_sq.numerator) / Decimal(sigma_sq.denominator)
        reach = int((2 * s2 * Decimal(bits + 8) * Decimal(2).ln()).sqrt()) + 2
        weight = [(-Decimal(x * x) / (2 * s2)).exp() for x in range(-reach, reach + 1)]
        total, run, out = sum(weight), Decimal(0), []
        for x, w in zip(range(-reach, reach + 1), weight, strict=True):
            run += w
            out.append((x, int(run / total * (1 << bits))))
        out[-1] = (reach, 1 << bits)
    return [(x, c) for (x, c), (_, before) in zip(out, [(0, 0), *out], strict=False) if c > before]


def random_bits(seed: int) -> Column:
    """A random integer of BITS bits a row, from two seeded generators of 31 bits each."""
    half = lambda k: F.floor(F.rand(seed + k) * (1 << 31)).cast("long")
    return half(0) * (1 << 31) + half(1)


def noise_discrete_gaussian_exact(df: DataFrame, col: str, sigma_sq: Fraction, r: Column | None = None, seed: int = 0) -> DataFrame:
    """Integer Gaussian noise by comparing a random integer of 62 bits with an integer cumulative table: no double takes part.

    The noise is the first value whose cumulative integer exceeds r (0 to 2^62 - 1), found by halving.
    """
    table = gaussian_integers(sigma_sq)
    cum, values = F.lit([c for _, c in table]), F.lit([x for x, _ in table])
    df = df.withColumn("_r", random_bits(seed) if r is None else r)  # one draw a row, however often it is compared
    steps = F.lit([1 << k for k in reversed(range(len(table).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(F.coalesce(F.get(cum, lo + step - 1) <= F.col("_r"), F.lit(False)), lo + step).otherwise(lo))
    p = [Fraction(c - b, 1 << BITS) for (_, c), (_, b) in zip(table, [(0, 0), *table], strict=False)]
    var = float(sum(x * x * q for (x, _), q in zip(table, p, strict=True)))
    return df.withColumns({"noisy": (F.col(col) + F.get(values, at)).cast("long"), "variance": F.lit(var)}).drop("_r")


def noise_rounded_gaussian(df: DataFrame, col: str, sigma_sq: float, z: Column | None = None, seed: int = 0) -> DataFrame:
    z = F.randn(seed) if z is None else z
    return df.withColumns({"noisy": F.round(F.col(col) + math.sqrt(sigma_sq) * z).cast("long"), "variance": F.lit(float(sigma_sq))})


def noise_none(df: DataFrame, col: str) -> DataFrame:
    return df.withColumns({"noisy": F.col(col).cast("long"), "variance": F.lit(1.0)})


def noise_unmeasured(df: DataFrame, col: str) -> DataFrame:
    return df.withColumns({"noisy": F.lit(None).cast("long"), "variance": F.lit(float("inf"))})


def noise_interval(df: DataFrame, q: float, eps: Column, sens: int = 1, bounded: bool = True) -> DataFrame:
    """Central interval of probability q at least: noisy -/+ the two-sided geometric's upper quantile.

    P(|X| > k) = 2 a^(k + 1) / (1 + a) with a = exp(-eps / sensitivity).
    """
    a = F.exp(-eps / (sens * (2 if bounded else 1)))
    k = F.greatest(F.lit(0), F.ceil(F.log((1 - q) * (1 + a) / 2) / F.log(a)) - 1)
    return df.withColumns({"lower": (F.col("noisy") - k).cast("long"), "upper": (F.col("noisy") + k).cast("long")})


def measure_sum_children(meas: DataFrame, parent: str = "parent_geocode") -> DataFrame:
    """Children's answers and variances added; children's inverse scales must agree (``mixed`` tells)."""
    s = F.col("inv_scale_num") / F.col("inv_scale_den")
    return meas.groupBy(F.col(parent).alias("geocode"), "query", "level").agg(F.sum("noisy").alias("noisy"), F.sum("variance").alias("variance"), (F.max(s) - F.min(s) > 1e-12).alias("mixed"))


def measure_pool(upper: DataFrame, children: DataFrame) -> DataFrame:
    """Minimum-variance average of a geounit's own answer and its children's sum."""
    j = upper.join(children.select("geocode", "query", "level", F.col("noisy").alias("cn"), F.col("variance").alias("cv")), ["geocode", "query", "level"])
    a = F.col("cv") / (F.col("variance") + F.col("cv"))
    return j.select(*[c for c in upper.columns if c not in ("noisy", "variance")], (a * F.col("noisy") + (1 - a) * F.col("cn")).alias("noisy"), (F.col("variance") * F.col("cv") / (F.col("variance") + F.col("cv"))).alias("variance"))


def measure_rescale_variance(meas: DataFrame, parent: str = "parent_geocode") -> DataFrame:
    """Variances by the least of the siblings'."""
    return meas.withColumn("variance", F.col("variance") / F.min("variance").over(Window.partitionBy(parent)))
