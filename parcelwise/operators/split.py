"""Reproducible splits: membership depends on the row's key and a seed, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.hashing import key_fold, key_fraction, key_hash, row_hash
from ..functions.names import c
from ..session import reliable
from .order_stats import RankTarget, column_quantiles, kth_values


LITERAL_STRATA = 200  # strata whose cuts become literals; the cuts of more are joined
COPIES = 10_000       # equal rows that are laid out by one task at a time


def quantile_edges(
    df: DataFrame, column: str, bins: int = 5, relative_error: float | None = None, at_most: int | None = None,
) -> list[float]:
    """Distinct interpolated quantile edges, lowest to highest; ``at_most`` is a known bound on the rows and saves a count."""
    counts = {column: at_most} if at_most is not None else None
    q = column_quantiles(df, {column: [i / bins for i in range(bins + 1)]}, counts, relative_error=relative_error)[column]
    return sorted({x for x in q if x is not None})


def quantile_bin(x: Column, edges: list[float]) -> Column:
    """Zero-based right-closed bin; the lowest value belongs to the first. NULL for a missing value or one outside the edges."""
    if not edges:  # an empty table
        return F.lit(None).cast("int")
    inner = sum((F.when(x > e, 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return F.when(x.between(edges[0], edges[-1]), inner)


def with_fold(df: DataFrame, key: str, folds: int = fixed.CV_FOLDS, seed: int = fixed.SEED, name: str = "fold") -> DataFrame:
    return df.withColumn(name, key_fold(c(key), seed, folds))


def random_split(df: DataFrame, key: str, held_out: float = 0.30, seed: int = fixed.SEED) -> DataFrame:
    """Add ``split``: train, then the held-out part halved into val and test. Map-only, sizes binomial."""
    u = key_fraction(c(key), seed)
    return df.withColumn("split", F.when(u < held_out / 2, "val").when(u < held_out, "test").otherwise("train"))


def _split_at(df: DataFrame, stratum: Column, h: Column, cuts: DataFrame) -> DataFrame:
    """Rows up to a stratum's first cut are test, up to its second val."""
    if cuts.count() > LITERAL_STRATA:
        side = cuts.select(F.col("__group").alias("__stratum"), "last_test", "last_val")
        name = F.when(h <= F.col("last_test"), "test").when(h <= F.col("last_val"), "val").otherwise("train")
        return df.join(side, stratum == F.col("__stratum"), "left").select(*[c(n) for n in df.columns], name.alias("split"))
    out = F.lit("train")
    for row in cuts.collect():
        here = stratum == F.lit(row["__group"])
        out = F.when(here & F.coalesce(h <= F.lit(row["last_test"]), F.lit(False)), "test").when(
            here & F.coalesce(h <= F.lit(row["last_val"]), F.lit(False)), "val").otherwise(out)
    return df.withColumn("split", out)


def _shared_keys(df: DataFrame, stratum: Column, h: Column, cuts: DataFrame) -> DataFrame:
    """``__s, __cut, to_test, to_held``: hashes at a cut that more rows share than may pass it; none where keys are unique.

    ``to_test`` of their rows are test, all up to ``to_held`` held out.
    """
    side = cuts.select(F.col("__group").alias("__s"), "last_test", "last_val", "n_test", "n_held")
    rows = df.select(stratum.alias("__s"), h.alias("__h")).join(F.broadcast(side) if cuts.count() <= LITERAL_STRATA else side, "__s")
    at = rows.select("*", F.explode(F.array_distinct(F.array("last_test", "last_val"))).alias("__cut")).where("__cut IS NOT NULL")
    counts = at.groupBy("__s", "__cut", "n_test", "n_held").agg(F.count_if(F.col("__h") < F.col("__cut")).alias("below"), F.count_if(F.col("__h") == F.col("__cut")).alias("here"))

    def share(n: str) -> Column:
        return F.least(F.greatest(F.col(n) - F.col("below"), F.lit(0)), F.col("here"))

    found = counts.select("__s", "__cut", "here", share("n_test").alias("to_test"), share("n_held").alias("to_held"))
    return reliable(found.where("(to_test > 0 AND to_test < here) OR (to_held > 0 AND to_held < here)").select("__s", "__cut", "to_test", "to_held"))


def _split_shared(df: DataFrame, stratum: Column, h: Column, shared: DataFrame, seed: int) -> DataFrame:
    """``split`` of the rows under shared keys, by count.

    Equal rows are counted first, so any number of them is one row. Those are ordered by a hash of all columns, and the same search that
    found the cut among the keys finds it among these. The equal rows on the cut itself are told apart by number.
    """
    names = df.columns
    limits = F.broadcast(shared) if shared.count() <= LITERAL_STRATA else shared
    rows = df.withColumn("__s", stratum).withColumn("__cut", h).join(limits, ["__s", "__cut"])
    place = F.concat_ws("#", F.col("__cut").cast("string"), F.col("__s"))
    rows = rows.withColumn("__place", place).withColumn("__row", row_hash([c(n) for n in names] + [F.lit(str(seed))]))
    keys = shared.select(place.alias("__group"), "to_test", "to_held").collect() if shared.count() <= LITERAL_STRATA else None
    if keys is not None:
        def limit(name: str) -> str:
            return "CASE __group " + " ".join(f"WHEN '{r['__group']}' THEN {r[name]}" for r in keys) + " END - 1"
    else:
        raise ValueError(f"more than {LITERAL_STRATA} shared keys lie on a cut; split by a key that tells rows apart")
    cuts = reliable(kth_values(rows, F.col("__place"), F.col("__row"), [RankTarget("row_test", limit("to_test")), RankTarget("row_held", limit("to_held"))]))
    at = F.broadcast(cuts.select(F.col("__group").alias("__place"), "row_test", "row_held"))
    rows = rows.join(at, "__place")
    before = [F.coalesce(F.col("__row") < F.col(x), F.lit(False)) for x in ("row_test", "row_held")]
    on_cut = F.coalesce(F.col("__row") == F.col("row_test"), F.lit(False)) | F.coalesce(F.col("__row") == F.col("row_held"), F.lit(False))
    plain = rows.where(~on_cut).select(*[c(n) for n in names], F.when(before[0], "test").when(before[1], "val").otherwise("train").alias("split"))
    # the equal rows on a cut: how many come before them, then numbered copies in runs of bounded length
    counted = rows.groupBy("__place").agg(*[F.count_if(F.col("__row") < F.col(x)).alias(f"before_{x}") for x in ("row_test", "row_held")])
    same = rows.where(on_cut).groupBy("__place", "__row", "row_test", "row_held", "to_test", "to_held", *[c(n) for n in names]).agg(F.count(F.lit(1)).alias("__n"))
    same = same.join(F.broadcast(counted), "__place")
    first = F.when(F.col("__row") == F.col("row_test"), F.col("before_row_test")).otherwise(F.col("before_row_held"))
    runs = same.withColumn("__first", first).withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / COPIES))))
    runs = runs.repartition(F.col("__place"), F.col("__row"), F.col("__run"))
    number = F.sequence(F.col("__run") * COPIES, F.least(F.col("__n"), (F.col("__run") + 1) * COPIES) - 1)
    each = runs.withColumn("__number", F.explode(number)).withColumn("__number", F.col("__first") + F.col("__number"))
    dealt = F.when(F.col("__number") < F.col("to_test"), "test").when(F.col("__number") < F.col("to_held"), "val").otherwise("train")
    return plain.unionByName(each.select(*[c(n) for n in names], dealt.alias("split")))


def stratified_split(
    df: DataFrame,
    key: str,
    stratum: Column,
    test_size: float = fixed.TEST_SIZE,
    val_size: float = fixed.VAL_SIZE,
    seed: int = fixed.SEED,
    exact: bool = True,
) -> DataFrame:
    """Add ``split`` with the same shares in every stratum.

    Within a stratum rows are ordered by their key hash. ``exact`` finds the
    two cut hashes per stratum with counting passes, so the sizes are exact
    and no stratum is ever ordered in one task. Rows that share a key stay together, but for those on a cut, which
    are ordered by all their columns and, where even these are equal, counted off. ``exact=False`` cuts at the expected
    fractions instead: no job at all, sizes binomial.
    """
    if not exact:
        u = key_fraction(c(key), seed)
        return df.withColumn("split", F.when(u < test_size, "test").when(u < test_size + val_size, "val").otherwise("train"))
    stratum = F.coalesce(stratum.cast("string"), F.lit(""))
    h = F.coalesce(key_hash(c(key), seed), F.lit(-1).cast("long"))  # rows without a key share one
    n_test = f"round(n * {test_size!r}D)"
    n_val = f"round((n - {n_test}) * {val_size / (1 - test_size)!r}D)"
    cuts = reliable(kth_values(df, stratum, h, [RankTarget("last_test", f"{n_test} - 1"), RankTarget("last_val", f"{n_test} + {n_val} - 1")]).selectExpr(
        "*", f"CAST({n_test} AS bigint) AS n_test", f"CAST({n_test} + {n_val} AS bigint) AS n_held"))
    shared = _shared_keys(df, stratum, h, cuts)
    if shared.isEmpty():
        return _split_at(df, stratum, h, cuts)
    few = F.broadcast(shared) if shared.count() <= LITERAL_STRATA else shared
    marked = df.withColumn("__s", stratum).withColumn("__cut", h).join(few.select("__s", "__cut"), ["__s", "__cut"], "left_anti").select(*[c(n) for n in df.columns])
    return _split_at(marked, stratum, h, cuts).unionByName(_split_shared(df, stratum, h, shared, seed))


def split_by_target(
    df: DataFrame, key: str, target: str = fixed.TARGET, bins: int = 5, at_most: int | None = None, **options,
) -> DataFrame:
    """Stratified split on the target's quantile bins."""
    edges = quantile_edges(df, target, bins, at_most=at_most)
    return stratified_split(df, key, quantile_bin(c(target), edges), **options)
