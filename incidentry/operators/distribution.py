"""Exact distribution summaries and density curves: what a violin chart draws."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import real_value
from ..sources.workspace import stage

_ACCURACY = 10_000  # rank error of a sketch is at most n / _ACCURACY
_STEPS = 1_000  # steps of the sketch that narrows an interval
_BOUNDED = 1_000_000  # values between two cuts that are ranked one by one
_QUARTILES = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
_OF = ("_key", "_measure", "_quantile")


def distribution(
    df: DataFrame,
    key: str,
    measures: Sequence[str],
    quantiles: Mapping[float, str] | None = None,
) -> DataFrame:
    """Count, minimum, exact quantiles, maximum, mean and deviation of each
    measure per key, as ``(key, measure, n, min, p25, p50, p75, max, mean, stddev)``.

    Quantiles lie linearly between two ranks. A measure without a value in a
    group has no row; infinite values are values, NaN is missing. Every scan
    has one row per input row, for all measures together:

    1. Moments, and a sketch that places two cuts around every quantile.
    2. How many values lie below and at each cut. A rank among the values equal
       to a cut is found; any other lies strictly between two cuts.
    3. Only if some rank is still open: the values between its cuts, counted
       and ranked. Where more than a million lie there, sketches narrow the
       interval first, so no part of a group that grows with the table is ever
       ranked in one task.

    The cuts only steer the work: poor ones cost another narrowing, never the result.
    """
    quantiles = dict(quantiles or _QUARTILES)
    values = df.select(
        F.col(key).alias("_key"), *[real_value(df, m).cast("double").alias(f"_v{j}") for j, m in enumerate(measures)]
    )
    margin = 2.0 / _ACCURACY
    probs = sorted({min(1.0, max(0.0, q + d)) for q in quantiles for d in (-margin, margin)})
    moments = {"n": F.count, "min": F.min, "max": F.max, "mean": F.avg, "stddev": F.stddev}
    base = stage(
        values.groupBy("_key").agg(*[
            column
            for j in range(len(measures))
            for column in (
                *[function(f"_v{j}").alias(f"_{name}{j}") for name, function in moments.items()],
                F.percentile_approx(f"_v{j}", probs, _ACCURACY).alias(f"_cuts{j}"),
            )
        ]),
        "moments",
    )
    ranks = stage(_cut_ranks(values, base, len(measures), list(quantiles), len(probs)), "ranks")
    while (most := _open(ranks).agg(F.max("_inside")).first()[0] or 0) > _BOUNDED:
        ranks = stage(_narrowed(values, ranks, len(measures), len(quantiles)), "ranks")
    if most:
        ranks = _ranked(values, ranks, len(measures), len(quantiles))
    between = (F.lit(1.0) - F.col("_part")) * F.col("_low") + F.col("_part") * F.col("_high")
    exact = F.when((F.col("_part") == 0) | (F.col("_low") == F.col("_high")), F.col("_low")).otherwise(between)
    found = ranks.groupBy("_key", "_measure").agg(*[
        F.max(F.when(F.col("_quantile") == i, exact)).alias(name) for i, name in enumerate(quantiles.values())
    ])
    rows = base.select("_key", F.inline(F.array(*[
        F.struct(F.lit(j).alias("_measure"), F.lit(m).alias("measure"), *[F.col(f"_{name}{j}").alias(name) for name in moments])
        for j, m in enumerate(measures)
    ])))
    joined = rows.alias("b").join(found.alias("f"), _same("b", "f", "_key", "_measure"))
    return joined.select(
        F.col("b._key").alias(key), "measure", "n", "min", *quantiles.values(), "max", "mean", "stddev"
    )


def _same(left: str, right: str, *names: str) -> Column:
    """Equality of columns of two aliased frames; a null key is a key."""
    return reduce(and_, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def _open(ranks: DataFrame) -> DataFrame:
    return ranks.filter(F.col("_low").isNull() | F.col("_high").isNull())


def _cut_ranks(values: DataFrame, base: DataFrame, measures: int, quantiles: list[float], cuts: int) -> DataFrame:
    """The two neighbouring ranks of each quantile, found at a cut or lying between two."""
    # as SQL text: an expression built call by call takes longer than the small jobs it describes
    places = [(j, i) for j in range(measures) for i in range(cuts)]
    edges = base.selectExpr("_key AS _of", *[f"get(_cuts{j}, {i}) AS _c{j}_{i}" for j, i in places])
    counts = [
        F.expr(f"count_if(_v{j} {test} _c{j}_{i}) AS _{name}{j}_{i}")
        for j, i in places
        for name, test in (("lt", "<"), ("le", "<="))
    ]
    counted = values.join(edges, F.col("_key").eqNullSafe(F.col("_of"))).groupBy("_key").agg(*counts)
    whole = base.alias("b").join(counted.alias("n"), _same("b", "n", "_key")).drop(F.col("n._key"))

    def wanted(j: int, q: int) -> str:
        at = ", ".join(
            f"named_struct('c', get(_cuts{j}, {i}), 'lt', _lt{j}_{i}, 'le', _le{j}_{i})" for i in range(cuts)
        )
        position = f"{float(quantiles[q])!r}D * (_n{j} - 1)"
        return (
            f"named_struct('_measure', {j}, '_quantile', {q}, '_upto', _n{j}, '_position', {position}, '_cuts', array({at}))"
        )

    every = ", ".join(wanted(j, q) for j in range(measures) for q in range(len(quantiles)))
    rows = whole.selectExpr("_key", f"inline(array({every}))").filter("_upto > 0")
    none = F.lit(None).cast("double")
    return _settled(rows.select(
        *_OF, F.floor("_position").alias("_first"), F.ceil("_position").alias("_second"),
        (F.col("_position") - F.floor("_position")).alias("_part"), none.alias("_low"), none.alias("_high"),
        none.alias("_above"), none.alias("_under"), F.lit(0).cast("bigint").alias("_before"), "_upto", "_cuts",
    ))


def _settled(rows: DataFrame) -> DataFrame:
    """Use what was counted at the cuts, an array of (c, lt, le): values below and up to each.

    An open rank lies strictly between ``_above`` and ``_under`` (null: no limit), after ``_before`` values and
    within the first ``_upto``. As every cut is a value that occurs, both ranks of a quantile lie between the same two.
    """

    def at(rank: str) -> Column:
        hits = F.filter("_cuts", lambda x: (x["lt"] <= F.col(rank)) & (F.col(rank) < x["le"]))
        return F.get(F.transform(hits, lambda x: x["c"]), F.lit(0))

    known = rows.withColumns(
        {"_low": F.coalesce("_low", at("_first")), "_high": F.coalesce("_high", at("_second"))}
    ).withColumn("_rank", F.when(F.col("_low").isNull(), F.col("_first")).otherwise(F.col("_second")))
    below = F.filter("_cuts", lambda x: x["le"] <= F.col("_rank"))
    beyond = F.filter("_cuts", lambda x: x["lt"] > F.col("_rank"))
    narrowed = known.select(
        *_OF, "_first", "_second", "_part", "_low", "_high",
        F.coalesce(F.array_max(F.transform(below, lambda x: x["c"])), "_above").alias("_above"),
        F.coalesce(F.array_min(F.transform(beyond, lambda x: x["c"])), "_under").alias("_under"),
        F.coalesce(F.array_max(F.transform(below, lambda x: x["le"])), "_before").alias("_before"),
        F.coalesce(F.array_min(F.transform(beyond, lambda x: x["lt"])), "_upto").alias("_upto"),
    )
    return narrowed.withColumn("_inside", F.col("_upto") - F.col("_before"))


def _between(values: DataFrame, ranks: DataFrame, measures: int, quantiles: int) -> DataFrame:
    """``(_key, _measure, _quantile, _value)`` of the values strictly between the cuts of these ranks."""
    places = [(j, i) for j in range(measures) for i in range(quantiles)]
    of_place = "_measure = {} AND _quantile = {}"
    limits = stage(
        ranks.groupBy(F.col("_key").alias("_of")).agg(*[
            F.expr(f"max(CASE WHEN {of_place.format(j, i)} THEN {limit} END) AS {name}{j}_{i}")
            for j, i in places
            for limit, name in (("true", "_on"), ("_above", "_above"), ("_under", "_under"))
        ]),
        "limits",
    )
    inside = {
        (j, i): f"coalesce(_on{j}_{i} AND _v{j} IS NOT NULL AND (_above{j}_{i} IS NULL OR _v{j} > _above{j}_{i}) "
        f"AND (_under{j}_{i} IS NULL OR _v{j} < _under{j}_{i}), false)"
        for j, i in places
    }
    some = values.join(limits, F.col("_key").eqNullSafe(F.col("_of"))).filter(" OR ".join(inside.values()))
    marked = ", ".join(
        f"named_struct('_measure', {j}, '_quantile', {i}, '_value', _v{j}, '_in', {test})" for (j, i), test in inside.items()
    )
    return some.selectExpr("_key", f"inline(filter(array({marked}), x -> x._in))").drop("_in")


def _narrowed(values: DataFrame, ranks: DataFrame, measures: int, quantiles: int) -> DataFrame:
    """Two closer cuts around each open rank that still has too many values beside it."""
    wide = _open(ranks).filter(F.col("_inside") > _BOUNDED)
    values = stage(_between(values, wide, measures, quantiles), "between")
    steps = [i / _STEPS for i in range(1, _STEPS)]
    sketches = values.groupBy(*_OF).agg(F.percentile_approx("_value", steps, _ACCURACY).alias("_steps"))
    rank = F.when(F.col("_low").isNull(), F.col("_first")).otherwise(F.col("_second"))
    step = F.floor(F.lit(_STEPS) * (rank - F.col("_before")) / F.col("_inside")).cast("int")
    placed = stage(
        wide.alias("r").join(sketches.alias("s"), _same("r", "s", *_OF))
        .select("r.*", F.get("_steps", step - 2).alias("_c0"), F.get("_steps", step + 1).alias("_c1")),
        "cuts",
    )
    counted = (
        values.alias("v").join(placed.alias("p"), _same("v", "p", *_OF))
        .groupBy(*[F.col(f"v.{c}").alias(c) for c in _OF])
        .agg(*[
            count.alias(f"_{name}{i}")
            for i in (0, 1)
            for name, count in (
                ("lt", F.count_if(F.col("_value") < F.col(f"_c{i}"))), ("le", F.count_if(F.col("_value") <= F.col(f"_c{i}"))),
            )
        ])
    )
    cuts = F.filter(
        F.array(*[
            F.struct(
                F.col(f"_c{i}").alias("c"), (F.col("_before") + F.col(f"_lt{i}")).alias("lt"),
                (F.col("_before") + F.col(f"_le{i}")).alias("le"),
            )
            for i in (0, 1)
        ]),
        lambda x: x["c"].isNotNull(),
    )
    closer = _settled(
        placed.alias("p").join(counted.alias("n"), _same("p", "n", *_OF))
        .select("p.*", *[f"n._{name}{i}" for i in (0, 1) for name in ("lt", "le")]).withColumn("_cuts", cuts)
    )
    others = ranks.filter(F.col("_low").isNotNull() & F.col("_high").isNotNull() | (F.col("_inside") <= _BOUNDED))
    return others.unionByName(closer)


def _ranked(values: DataFrame, ranks: DataFrame, measures: int, quantiles: int) -> DataFrame:
    """Find the open ranks among the values between their cuts, a bounded number each."""
    times = _between(values, _open(ranks), measures, quantiles).groupBy(*_OF, "_value").agg(F.count("*").alias("_times"))
    upto = times.withColumn("_upto", F.sum("_times").over(Window.partitionBy(*_OF).orderBy("_value")))

    def here(rank: str) -> Column:
        offset = F.col(rank) - F.col("_before")
        return F.when((offset < F.col("v._upto")) & (offset >= F.col("v._upto") - F.col("_times")), F.col("_value"))

    return (
        ranks.alias("r").join(upto.alias("v"), _same("r", "v", *_OF), "left")
        .groupBy(*[F.col(f"r.{c}").alias(c) for c in _OF], "_part")
        .agg(
            F.coalesce(F.max("_low"), F.max(here("_first"))).alias("_low"),
            F.coalesce(F.max("_high"), F.max(here("_second"))).alias("_high"),
        )
    )


# --- density curves -------------------------------------------------------

# The usual rule for the width of a Gaussian kernel.
_SPREAD, _QUARTILE_RANGE = 1.059, 1.349
_BINS = 2  # bins per bandwidth
_ORDER = 12  # powers kept of a value's distance from the middle of its bin
_REACH = 8.0  # bandwidths; a kernel is below 1e-13 of its top beyond


def density_curve(
    df: DataFrame, key: str, measures: Sequence[str], points: int = 100, beyond: float = 2.0
) -> DataFrame:
    """Gaussian kernel density of each measure per key, the outline of a violin:
    ``(key, measure, point, value, density, bandwidth)``.

    The bandwidth is 1.059 min(deviation, quartile range / 1.349) n^-1/5, at
    least a hundredth of the range. Each curve has ``points`` evenly spaced
    values from ``beyond`` bandwidths below the minimum to as many above the
    maximum. Null, NaN and infinite values are left out; a group whose values
    are all the same gets that value alone, with null density and bandwidth 0.

    Values are summed into bins of half a bandwidth, as powers of their
    distance from its middle. A bin's part of the curve is then a series in
    those sums, which is the sum of its kernels to twelve digits. The table is shuffled as bins only,
    whose number grows with the fifth root of the rows.
    """
    far = F.lit(float("inf"))
    known = df.select(F.col(key).alias("_key"), *[
        F.when(F.abs(value) < far, value).alias(m)
        for m in measures
        for value in [real_value(df, m).cast("double")]
    ])
    width = F.lit(_SPREAD) * F.least(
        F.coalesce("stddev", F.lit(0.0)), (F.col("p75") - F.col("p25")) / F.lit(_QUARTILE_RANGE)
    ) * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    bandwidth = F.greatest(width, (F.col("max") - F.col("min")) / F.lit(100.0))
    groups = stage(
        distribution(known, "_key", measures).select(
            F.col("_key").alias("_of"), F.col("measure").alias("_named"), "n", "min", "max", bandwidth.alias("bandwidth")
        ),
        "bandwidths",
    )
    long = known.select("_key", F.inline(F.array(*[
        F.struct(F.lit(m).alias("_measure"), F.col(f"`{m}`").alias("_value")) for m in measures
    ]))).filter(F.col("_value").isNotNull())
    of_group = F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_measure") == F.col("_named"))
    size = F.col("bandwidth") / F.lit(_BINS)
    binned = long.join(groups.filter("bandwidth > 0"), of_group).select(
        "_of", "_named", "min", "bandwidth", F.floor((F.col("_value") - F.col("min")) / size).alias("_bin"), "_value"
    )
    middle = F.col("min") + (F.col("_bin") + F.lit(0.5)) * size
    away = binned.select("_of", "_named", "_bin", ((F.col("_value") - middle) / F.col("bandwidth")).alias("_t"))
    powers = [reduce(lambda a, b: a * b, [F.col("_t")] * k) if k else F.lit(1.0) for k in range(_ORDER)]
    bins = away.groupBy("_of", "_named", "_bin").agg(*[F.sum(p).alias(f"_s{k}") for k, p in enumerate(powers)])

    first = F.col("g.min") - F.lit(float(beyond)) * F.col("g.bandwidth")
    step = (F.col("g.max") - F.col("g.min") + F.lit(2.0 * beyond) * F.col("g.bandwidth")) / F.lit(float(points - 1))
    middle = F.col("g.min") + (F.col("_bin") + F.lit(0.5)) * F.col("g.bandwidth") / F.lit(_BINS)
    near = F.lit(_REACH) * F.col("g.bandwidth")
    low = F.greatest(F.ceil((middle - near - first) / step), F.lit(0)).cast("int")
    high = F.least(F.floor((middle + near - first) / step), F.lit(points - 1)).cast("int")
    spread = bins.alias("b").join(groups.alias("g"), _same("b", "g", "_of", "_named")).select(
        "b.*", "g.bandwidth", first.alias("_first"), step.alias("_step"), middle.alias("_middle"),
        F.explode(F.when(low <= high, F.sequence(low, high))).alias("_point"),
    )
    place = (F.col("_first") + F.col("_point") * F.col("_step") - F.col("_middle")) / F.col("bandwidth")
    series = reduce(add, [
        F.col(f"_s{k}") * F.lit(1.0 / math.factorial(k)) * _polynomial(F.col("_u"), c) for k, c in enumerate(_hermite(_ORDER))
    ])
    summed = (
        spread.withColumn("_u", place)
        .groupBy("_of", "_named", "_point")
        .agg(F.sum(F.exp(F.lit(-0.5) * F.col("_u") * F.col("_u")) * series).alias("_kernels"))
    )
    count = F.when(F.col("g.bandwidth") > 0, F.lit(points - 1)).otherwise(F.lit(0))
    curve = groups.alias("g").select(
        "g.*", first.alias("_first"), step.alias("_step"), F.explode(F.sequence(F.lit(0), count)).alias("_point")
    )
    scale = F.lit(math.sqrt(2 * math.pi)) * F.col("n") * F.col("bandwidth")
    return curve.alias("c").join(summed.alias("s"), _same("c", "s", "_of", "_named", "_point"), "left").select(
        F.col("c._of").alias(key), F.col("c._named").alias("measure"), F.col("c._point").alias("point"),
        (F.col("_first") + F.col("c._point") * F.col("_step")).alias("value"),
        F.when(F.col("bandwidth") > 0, F.coalesce("_kernels", F.lit(0.0)) / scale).alias("density"), "bandwidth",
    )


def _hermite(count: int) -> list[list[int]]:
    """Coefficients, from the constant upwards, of the first polynomials He with He(k+1) = x He(k) - k He(k-1)."""
    found = [[1], [0, 1]]
    while len(found) < count:
        k = len(found) - 1
        found.append([a - k * b for a, b in zip([0, *found[k]], [*found[k - 1], 0, 0], strict=True)])
    return found[:count]


def _polynomial(x: Column, coefficients: list[int]) -> Column:
    return reduce(lambda total, c: total * x + F.lit(float(c)), coefficients[-2::-1], F.lit(float(coefficients[-1])))
