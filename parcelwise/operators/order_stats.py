"""Exact order statistics (quantiles, k-th values) at any size.

Spark's exact ``percentile`` keeps one value-to-count map per group in one
task. That is the fast way while a group is small, so it is used for such groups.
For the others the source is read twice:

1. one aggregation counts each group and sketches its values (fixed-size buffers, combined map-side);
2. around each wanted rank two sketch points make a bracket. One more pass turns the source into a narrow table of
   ``(group, value, count)``: values inside a bracket are kept, all others fall together to one row for each side they are on.
   That collapses in the tasks, before anything is shuffled.

From then on only the narrow table is read. It holds each value once, however often it occurs, so a value that fills a
third of the table is one row. Where a bracket still has more values than a task should sort, it is cut at sketch points again and
only the part with the wanted rank is kept. Counts decide at each step, so the answer is exact whatever the sketch's error; a bracket
that missed its rank is widened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import c, long_numbers, per_column, quote
from ..session import reliable

DIRECT_LIMIT = 250_000        # values per group that one task may hold
RESIDUAL_LIMIT = 50_000       # values per bracket that are sorted at the end
SKETCH_POINTS = 500
BROADCAST_STATE_BYTES = 128 << 20
SALTS = 32                    # copies of a bracket table that is too large to broadcast

_GROUP = "__group"
_VALUE = "__value"
_COUNT = "__count"


@dataclass(frozen=True)
class RankTarget:
    """A wanted zero-based rank, as SQL text over the group size ``n``."""

    name: str
    rank: str


def _with_state(facts: DataFrame, state: DataFrame, state_rows: int, targets: int) -> DataFrame:
    """Attach each group's row of ``state``.

    It is broadcast while its rows are known to be few enough. Beyond that the facts of a group are dealt to SALTS tasks, each with a
    copy of the group's row, so no group's facts meet in one task.
    """
    if state_rows * (64 + 32 * targets) <= BROADCAST_STATE_BYTES:
        return facts.join(F.broadcast(state), _GROUP)
    salted = facts.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = state.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, [_GROUP, "__salt"]).drop("__salt")


def _grid(points: int) -> str:
    return "array(" + ", ".join(f"{i / points!r}D" for i in range(points + 1)) + ")"


def sketch_expression(value: str, points: int = SKETCH_POINTS) -> Column:
    """Approximate quantiles at ``points + 1`` even probabilities."""
    return F.expr(f"percentile_approx({value}, {_grid(points)}, {points * 4})")


def _brackets(sketched: DataFrame, targets: list[RankTarget], points: int, margin: int) -> DataFrame:
    """``__group, n, <t>_rank, <t>_a, <t>_b``: sketch points around each rank, NULL where the bracket is open."""
    cuts = []
    for t in targets:
        at = f"(CAST({t.rank} AS double) / greatest(n, 1) * {points})"
        low, high = f"CAST(floor({at}) AS int) - {margin}", f"CAST(ceil({at}) AS int) + {margin + 1}"
        cuts += [f"CAST({t.rank} AS bigint) AS {t.name}_rank", f"CASE WHEN {low} > 0 THEN get(grid, {low}) END AS {t.name}_a",
                 f"CASE WHEN {high} < {points} THEN get(grid, {high}) END AS {t.name}_b"]
    return sketched.selectExpr(_GROUP, "n", *cuts)


def _inside(t: str) -> str:
    return f"({t}_rank >= 0 AND ({t}_a IS NULL OR {_VALUE} >= {t}_a) AND ({t}_b IS NULL OR {_VALUE} <= {t}_b))"


def _narrow(facts: DataFrame, state: DataFrame, state_rows: int, names: list[str]) -> DataFrame:
    """``__group, t, __value, __count, rank``: the values inside each target's bracket, and the wanted rank among them.

    One pass over the facts. ``side`` tells, for values outside all brackets, below which targets' brackets they are.
    """
    joined = _with_state(facts, state, state_rows, len(names))
    any_inside = " OR ".join(_inside(t) for t in names)
    side = " + ".join(f"CASE WHEN {_VALUE} < {t}_a THEN {1 << i}L ELSE 0L END" for i, t in enumerate(names))
    kept = joined.selectExpr(
        _GROUP, f"CASE WHEN {any_inside} THEN {_VALUE} END AS {_VALUE}", f"CASE WHEN {any_inside} THEN -1L ELSE {side} END AS side")
    narrow = reliable(kept.groupBy(_GROUP, _VALUE, "side").agg(F.count(F.lit(1)).alias(_COUNT)))
    below = [
        F.sum(F.expr(f"CASE WHEN (side >= 0 AND (side & {1 << i}L) > 0) OR (side < 0 AND {_VALUE} < {t}_a) THEN {_COUNT} ELSE 0 END")).alias(f"{t}_below")
        for i, t in enumerate(names)]
    counted = _with_state(narrow, state, state_rows, len(names)).groupBy(_GROUP).agg(*below)
    placed = reliable(state.join(counted, _GROUP))
    inside = ", ".join(f"CASE WHEN {_inside(t)} THEN named_struct('t', {i}, 'rank', {t}_rank - {t}_below) END" for i, t in enumerate(names))
    values = _with_state(narrow.where("side < 0").drop("side"), placed, state_rows, 2 * len(names))
    return values.selectExpr(_GROUP, _VALUE, _COUNT, f"inline(array_compact(array({inside})))")


def _cut(values: DataFrame, open_: DataFrame, n_open: int, points: int) -> DataFrame:
    """Of the open brackets the part with the wanted rank, between two neighbouring sketch points of its values; others as they are."""
    keys = [_GROUP, "t"]

    def sent(side: DataFrame, row_bytes: int) -> DataFrame:
        return F.broadcast(side) if n_open * row_bytes <= BROADCAST_STATE_BYTES else side

    wide = values.join(sent(open_, 64), keys, "left_semi")
    grids = wide.groupBy(*keys).agg(sketch_expression(_VALUE, points).alias("grid"))
    part = reliable(wide.join(sent(grids, 16 * points), keys).withColumn("part", F.expr(f"size(filter(grid, g -> g < {_VALUE}))")).drop("grid"))
    counts = part.groupBy(*keys, "part").agg(F.sum(_COUNT).alias("n"), F.first("rank").alias("rank"))
    ordered = counts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts"), F.first("rank").alias("rank"))
    start = "named_struct('part', CAST(NULL AS int), 'left', rank)"
    step = ("CASE WHEN acc.part IS NOT NULL THEN acc WHEN acc.left < p.n THEN named_struct('part', p.part, 'left', acc.left) "
            "ELSE named_struct('part', CAST(NULL AS int), 'left', acc.left - p.n) END")
    wanted = ordered.selectExpr(*keys, f"aggregate(parts, {start}, (acc, p) -> {step}) AS w").selectExpr(*keys, "w.part AS part", "w.left AS left")
    kept = part.join(sent(wanted, 64), [*keys, "part"]).selectExpr(*keys, _VALUE, _COUNT, "left AS rank")
    return reliable(values.join(sent(open_, 64), keys, "left_anti").select(*keys, _VALUE, _COUNT, "rank").unionByName(kept))


def _pick(values: DataFrame) -> DataFrame:
    """``__group, t, found``: walk the few values of each bracket up to the wanted rank."""
    kind = values.schema[_VALUE].dataType.simpleString()
    listed = values.groupBy(_GROUP, "t").agg(F.sort_array(F.collect_list(F.struct(_VALUE, _COUNT))).alias("v"), F.first("rank").alias("rank"))
    start = f"named_struct('at', CAST(NULL AS {kind}), 'left', rank)"
    step = (f"CASE WHEN acc.left < 0 THEN acc ELSE named_struct('at', x.{_VALUE}, 'left', acc.left - x.{_COUNT}) END")
    return listed.selectExpr(_GROUP, "t", f"aggregate(v, {start}, (acc, x) -> {step}) AS w").selectExpr(
        _GROUP, "t", "CASE WHEN w.left < 0 THEN w.at END AS found")


def kth_values(
    df: DataFrame,
    group: Column,
    value: Column,
    targets: list[RankTarget],
    residual_limit: int = RESIDUAL_LIMIT,
    points: int = SKETCH_POINTS,
    sketched: DataFrame | None = None,
) -> DataFrame:
    """Exact value at each wanted rank per group: columns ``__group, n, <target names>``.

    A rank below 0 gives NULL. Runs jobs; the result holds one row per group. ``sketched`` (``__group, n, grid`` of the present values, with
    the same ``points``) saves the first pass.
    """
    if points < 16:
        raise ValueError("points must be at least 16, or brackets hardly shrink")
    facts = df.select(group.alias(_GROUP), value.alias(_VALUE)).where(f"{_VALUE} IS NOT NULL AND {_GROUP} IS NOT NULL")
    names = [t.name for t in targets]
    if sketched is None:
        sketched = reliable(facts.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("n"), sketch_expression(_VALUE, points).alias("grid")))
    groups = sketched.count()
    margin = 1
    while True:
        state = reliable(_brackets(sketched, targets, points, margin))
        values = reliable(_narrow(facts, state, groups, names))
        sizes = values.groupBy(_GROUP, "t").agg(F.count(F.lit(1)).alias("m"), F.sum(_COUNT).alias("n"), F.first("rank").alias("rank"))
        wanted = state.selectExpr("sum(" + " + ".join(f"CASE WHEN {t}_rank BETWEEN 0 AND n - 1 THEN 1 ELSE 0 END" for t in names) + ")").head()[0] or 0
        met, most = sizes.where("rank >= 0 AND rank < n").selectExpr("count(*)", "max(m)").head()
        if met >= wanted or margin > points:
            break
        margin *= 8
    while (most or 0) > residual_limit:
        open_ = reliable(values.groupBy(_GROUP, "t").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > residual_limit).select(_GROUP, "t"))
        values = _cut(values, open_, open_.count(), points)
        most = values.groupBy(_GROUP, "t").count().agg(F.max("count")).head()[0]
    found = _pick(values).groupBy(_GROUP).agg(*[F.max(F.when(F.col("t") == i, F.col("found"))).alias(t) for i, t in enumerate(names)])
    return sketched.select(_GROUP, "n").join(found, _GROUP, "left")


def _targets(probabilities: list[float]) -> list[RankTarget]:
    out = []
    for i, p in enumerate(probabilities):
        at = f"(n - 1) * {float(p)!r}D"
        out += [RankTarget(f"f{i}", f"floor({at})"), RankTarget(f"g{i}", f"ceil({at})")]
    return out


def _interpolated(i: int, p: float) -> str:
    at = f"((n - 1) * {float(p)!r}D)"
    return f"f{i} + (g{i} - f{i}) * ({at} - floor({at}))"


def column_quantiles(
    df: DataFrame,
    wanted: dict[str, list[float]],
    counts: dict[str, int] | None = None,
    direct_limit: int = DIRECT_LIMIT,
    relative_error: float | None = None,
    sketches: dict[str, list] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, all columns in the same pass.

    ``counts`` (non-null values per column) skips the size check when it is known; ``sketches`` (``sketch_expression`` per column) the
    sketch pass. ``relative_error`` switches to the approximate sketch.
    """
    names = [n for n, ps in wanted.items() if ps]
    if not names:
        return {}
    probabilities = sorted({p for n in names for p in wanted[n]})
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    x = F.col("x")
    rows: dict[str, list] = {}
    if relative_error is not None:
        sketch = F.percentile_approx(x, [float(p) for p in probabilities], max(1, round(1 / relative_error)))
        rows = {n: r["q"] for n, r in per_column(df, names, q=sketch).items()}
    else:
        if counts is None or any(n not in counts for n in names):
            n_rows = df.count()  # bounds every column, and is the cheaper question
            counts = dict.fromkeys(names, n_rows) if n_rows <= direct_limit else {
                n: r["n"] for n, r in per_column(df, names, n=F.count(x)).items()}
        small = [n for n in names if counts.get(n, 0) <= direct_limit]
        large = [n for n in names if counts.get(n, 0) > direct_limit]
        if small:
            rows = {n: r["q"] for n, r in per_column(df, small, q=F.percentile(x, points)).items()}
        if large:
            known = None
            if sketches and all(sketches.get(n) for n in large):
                known = df.sparkSession.createDataFrame([(n, counts[n], list(sketches[n])) for n in large], f"{_GROUP} string, n long, grid array<double>")
            picked = kth_values(long_numbers(df, large), F.col("column"), x, _targets(probabilities), sketched=known)
            quantiles = ", ".join(_interpolated(i, p) for i, p in enumerate(probabilities))
            rows |= {r[0]: r[1] for r in picked.selectExpr(_GROUP, f"array({quantiles})").collect()}
    found: dict[str, list[float | None]] = {}
    for n in names:
        by_p = dict(zip(probabilities, rows.get(n) or [None] * len(probabilities)))
        found[n] = [by_p[p] for p in wanted[n]]
    return found


def grouped_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    probabilities: list[float],
    names: list[str],
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """Interpolated quantiles per group: ``key, n, <names>``.

    Groups are sized first. Those beyond ``direct_limit`` (at most rows / limit of them, so their keys can be sent to the tasks) go
    through the bracket search; all others are small enough for one task each.
    """
    x = c(value).cast("double")
    facts = df.select(c(key).alias(_GROUP), F.when(~F.isnan(x), x).alias(_VALUE)).where(F.col(_GROUP).isNotNull())
    sizes = facts.groupBy(_GROUP).agg(F.count(_VALUE).alias("n"))
    heavy = reliable(sizes.where(F.col("n") > direct_limit).select(_GROUP))
    n_heavy = heavy.count()
    qs = F.percentile(F.col(_VALUE), F.array(*[F.lit(float(p)) for p in probabilities]))

    def direct(rows: DataFrame) -> DataFrame:
        return rows.groupBy(_GROUP).agg(F.count(_VALUE).alias("n"), qs.alias("q")).select(
            F.col(_GROUP).alias(key), "n", *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(names)])

    if not n_heavy:
        return direct(facts)
    few = F.broadcast(heavy) if n_heavy * 64 <= BROADCAST_STATE_BYTES else heavy
    picked = kth_values(facts.join(few, _GROUP, "left_semi"), F.col(_GROUP), F.col(_VALUE), _targets(probabilities)).selectExpr(
        f"{_GROUP} AS {quote(key)}", "n", *[f"{_interpolated(i, p)} AS {quote(n)}" for i, (p, n) in enumerate(zip(probabilities, names))])
    return direct(facts.join(few, _GROUP, "left_anti")).unionByName(picked)
