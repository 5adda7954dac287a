"""Exact order statistics without a global sort, a value map in one task, or a shuffle of rows.

Quantiles are found by selection: a sketch brackets each wanted rank between two values of the data, then the rows below and
above are counted, and those of each distinct value in the bracket, which holds few. A bracket of many rows is counted only,
and what lies strictly inside is bracketed again. Rows stay in their tasks; only sketches, counts and the values of
brackets leave them. A value held by a third of all rows is met by its bracket and costs one count.

Running totals split the values of a key at quantiles of its own distinct values, so the pieces are of equal size
wherever the values lie. Equal values are counted before any shuffle.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.staging import staged

# rank error of the sketches: one part of so many
_ACCURACY = 20_000
# pieces of a key's values for running totals: a power of two
_PIECES = 512
# most rows that one window ranks for a wanted quantile
_RANKED = 20_000
# most groups whose brackets are broadcast; more are joined by the groups' columns
_BROADCAST_GROUPS = 100_000
# quantiles that one aggregate counts for: with more Spark would not compile it
_WIDE = 12
# columns that one scan turns to rows
_TURNED = 24
# rank error of the sketches of named expressions: coarser ones cost a fifth, and the values of a wider bracket are counted
_SKETCH = 2_000
# most values of a bracket that one window ranks
_HELD = 500_000


def long_values(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One ``(key, value)`` row per named expression."""
    return df.select(*[e.cast("double").alias(name) for name, e in values.items()]).unpivot(
        [], list(values), "key", "value")


# --- quantiles of named expressions -----------------------------------------
@dataclass
class _Hunt:
    """A wanted quantile: the ranks not found yet lie in the open interval (low, high), behind ``before`` rows."""

    name: str
    probability: float
    column: str
    low: float | None = None
    high: float | None = None
    before: int = 0
    inside: int = 0
    ranks: list[int] = field(default_factory=list)
    found: dict[int, float] = field(default_factory=dict)

    def holds(self) -> Column:
        x = F.col(self.column)
        inside = x.isNotNull()
        if self.low is not None:
            inside = inside & (x > F.lit(self.low))
        if self.high is not None:
            inside = inside & (x < F.lit(self.high))
        return inside

    def bounds(self) -> list[float]:
        """Shares of the rows inside between which the ranks lie, whatever the sketch's error."""
        edge = 2.0 / _SKETCH
        low, high = (min(self.ranks) - self.before) / self.inside, (max(self.ranks) - self.before + 1) / self.inside
        return [min(max(low - edge, 0.0), 1.0), min(max(high + edge, 0.0), 1.0)]

    def narrow(self, lo: float, hi: float, below: int, at_lo: int, between: int, at_hi: int) -> None:
        """Settle ranks that are a bracket's end; the others are all on one side of it."""
        a = self.before + below
        b = a + at_lo
        c = b + between
        d = c + at_hi
        for r in self.ranks:
            if a <= r < b or c <= r < d:
                self.found[r] = lo if r < b else hi
        self.ranks = [r for r in self.ranks if r not in self.found]
        if not self.ranks:
            return
        r = self.ranks[0]
        if r < a:
            self.high, self.inside = lo, below
        elif r < c:
            self.low, self.high, self.before, self.inside = lo, hi, b, between
        else:
            self.low, self.before, self.inside = hi, d, self.before + self.inside - d

    def settle(self, lo: float, hi: float, found: dict[int, float], below: int, above: int) -> None:
        """Take the ranks found in a bracket; the others are all on one side of it."""
        self.found |= found
        self.ranks = [r for r in self.ranks if r not in self.found]
        if self.ranks and self.ranks[0] < self.before + below:
            self.high, self.inside = lo, below
        elif self.ranks:
            self.low, self.before, self.inside = hi, self.before + self.inside - above, above

    def quantile(self, total: int) -> float:
        position = (total - 1) * self.probability
        lo, hi = self.found[int(position)], self.found[_ceil(position)]
        part = position - int(position)
        # equal ends stay equal
        return lo if lo == hi else lo * (1 - part) + hi * part


def _ceil(x: float) -> int:
    return int(x) + (x > int(x))


def _aggregated(source: DataFrame, columns: list[Column]) -> list:
    """One value per expression, all of one type: a few aggregates side by side, each of which reads its own columns."""
    parts = [source.agg(*[e.alias(f"x{i}") for i, e in enumerate(columns[at:at + _WIDE])]).select(
        F.lit(at).alias("at"), F.array(*[f"x{i}" for i in range(len(columns[at:at + _WIDE]))]).alias("x"))
        for at in range(0, len(columns), _WIDE)]
    rows = reduce(DataFrame.unionByName, parts).collect()
    return [x for r in sorted(rows, key=lambda r: r["at"]) for x in r["x"]]


def quantile_map(df: DataFrame, values: dict[str, Column], probabilities=(0.5,)) -> dict:
    """``{(name, probability): quantile}`` by linear interpolation, on the driver: one float per name and rank.

    Names without values have no entry. A round reads the columns twice, for the brackets and for the values in them. Another one
    is for ranks that a bracket missed, and for brackets in so many rows that they may hold more than ``_HELD``.
    """
    names = list(values)
    if not names:
        return {}
    # -0.0 and 0.0 are one value
    source = df.select(*[(e.cast("double") + F.lit(0.0)).alias(f"v{i}") for i, e in enumerate(values.values())])
    edge = 2.0 / _SKETCH
    first = [min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-edge, edge)]
    totals, hunts, brackets = {}, [], []
    for i, total, sketch in sorted(_turned(source, [f"v{i}" for i in range(len(names))]).groupBy("i").agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx("x", first, _SKETCH).alias("q")).collect()):
        totals[names[i]] = total
        for j, p in enumerate(probabilities):
            position = (total - 1) * float(p)
            hunts.append(_Hunt(names[i], float(p), f"v{i}", inside=total, ranks=sorted({int(position), _ceil(position)})))
            brackets.append(sketch[2 * j:2 * j + 2])
    while any(h.ranks for h in hunts):
        open_ = [(h, q) for h, q in zip(hunts, brackets) if h.ranks]
        few = [h.inside <= _HELD * _SKETCH // 8 for h, _ in open_]
        _count_brackets(source, [x for x, y in zip(open_, few) if not y])
        _rank_brackets(source, [x for x, y in zip(open_, few) if y])
        again = [h for h in hunts if h.ranks]
        if again:
            found = dict(zip(map(id, again), _aggregated(source, [
                F.percentile_approx(F.when(h.holds(), F.col(h.column)), h.bounds(), _SKETCH) for h in again])))
            brackets = [found.get(id(h)) for h in hunts]
    return {(h.name, h.probability): h.quantile(totals[h.name]) for h in hunts}


def _turned(source: DataFrame, columns: list[str]) -> DataFrame:
    """A row ``(i, x)`` for each value of the i-th column that is not null: a few columns a scan, all by the same code."""
    named = [F.col(c).alias(f"x{i}") for i, c in enumerate(columns)]
    parts = [source.select(*named[at:at + _TURNED]).unpivot([], [f"x{i}" for i in range(at, min(at + _TURNED, len(named)))], "_c", "x")
             for at in range(0, len(named), _TURNED)]
    return reduce(DataFrame.unionByName, parts).filter("x IS NOT NULL").select(F.substring("_c", 2, 9).cast("int").alias("i"), "x")


def _count_brackets(source: DataFrame, wide: list[tuple[_Hunt, list[float]]]) -> None:
    if not wide:
        return
    counts = []
    for h, (lo, hi) in wide:
        x, inside = F.col(h.column), h.holds()
        counts += [F.count_if(inside & (x < F.lit(lo))), F.count_if(x == F.lit(lo)),
                   F.count_if((x > F.lit(lo)) & (x < F.lit(hi))), F.count_if(x == F.lit(hi)) if hi != lo else F.count_if(F.lit(False))]
    found = _aggregated(source, counts)
    for i, (h, (lo, hi)) in enumerate(wide):
        h.narrow(lo, hi, *found[4 * i:4 * i + 4])


def _rank_brackets(source: DataFrame, few: list[tuple[_Hunt, list[float]]]) -> None:
    """Ranks among the values of each bracket; rows below and above it are one count each."""
    if not few:
        return

    def of_hunt(values):
        return F.element_at(F.array(*values), F.col("i") + 1)

    def number(values):
        return of_hunt([F.lit(v).cast("double") for v in values])

    x, low, high = F.col("x"), number([h.low for h, _ in few]), number([h.high for h, _ in few])
    side = F.when(x < number([lo for _, (lo, _) in few]), -1).when(x > number([hi for _, (_, hi) in few]), 1).otherwise(0)
    rows = _turned(source, [h.column for h, _ in few]).filter((low.isNull() | (x > low)) & (high.isNull() | (x < high)))
    counted = rows.select("i", side.alias("side"), F.when(side == 0, x).alias("x")).groupBy("i", "side", "x").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("side", "x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = of_hunt([F.array(*[F.lit(r - h.before) for r in h.ranks]) for h, _ in few])
    ranked = counted.withColumn("upto", upto).withColumn("ranks", F.filter(
        wanted, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto"))))
    sides, found = [{-1: 0, 1: 0} for _ in few], [{} for _ in few]
    for row in ranked.filter((F.col("side") != 0) | (F.size("ranks") > 0)).collect():
        if row["side"]:
            sides[row["i"]][row["side"]] = row["n"]
        else:
            found[row["i"]] |= {r + few[row["i"]][0].before: row["x"] for r in row["ranks"]}
    for (h, (lo, hi)), at, got in zip(few, sides, found):
        h.settle(lo, hi, got, at[-1], at[1])


# --- quantiles of groups ----------------------------------------------------
def exact_quantiles(
    df: DataFrame,
    probabilities: Sequence[float],
    keys: Sequence[str] = ("key",),
    value: str = "value",
) -> DataFrame:
    """Linear-interpolated quantiles per group: ``(*keys, probability, quantile)``. Null keys are a group.

    The brackets, one row per group, are broadcast to the rows if the groups are few enough; else both are joined by the groups'
    columns. Distinct values inside a bracket are counted in their tasks, written, and narrowed by
    pieces until a window ranks at most ``_RANKED`` of them.
    """
    keys, probabilities = list(keys), [float(p) for p in probabilities]
    # -0.0 and 0.0 are one value
    source = df.select(*keys, (F.col(value).cast("double") + F.lit(0.0)).alias("_v")).filter("_v IS NOT NULL")
    edge = 2.0 / _ACCURACY
    bounds = [min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-edge, edge)]
    sketch = source.groupBy(*keys).agg(
        F.percentile_approx("_v", bounds, _ACCURACY).alias("_q"), F.count(F.lit(1)).alias("_total"))
    wanted = [F.struct(F.lit(p).alias("probability"), F.get("_q", F.lit(2 * i)).alias("_from"),
                       F.get("_q", F.lit(2 * i + 1)).alias("_to")) for i, p in enumerate(probabilities)]
    sketch = staged(sketch.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_total", F.array(*wanted).alias("_wanted")), "brackets")
    each = source.join(_small(sketch), _same(keys)).drop(*[f"_k_{k}" for k in keys])
    below, above = {}, {}
    for i in range(len(probabilities)):
        bracket = F.get("_wanted", F.lit(i))
        under, over = F.col("_v") < bracket["_from"], F.col("_v") > bracket["_to"]
        below[i] = [F.count_if(under).alias(f"_n{i}"), F.max(F.when(under, F.col("_v"))).alias(f"_most{i}")]
        above[i] = [F.min(F.when(over, F.col("_v"))).alias(f"_least{i}")]
    # a rank may fall one place beside its bracket: on the nearest value there
    beside = each.groupBy(*keys, "_total").agg(*[e for i in below for e in below[i] + above[i]]).select(*keys, F.inline(F.array(*[
        F.struct(F.lit(p).alias("probability"), ((F.col("_total") - 1) * F.lit(p)).alias("_position"), F.col(f"_n{i}").alias("_before"),
                 F.col(f"_most{i}").alias("_most"), F.col(f"_least{i}").alias("_least")) for i, p in enumerate(probabilities)])))
    inside = each.select(*keys, "_v", F.inline(F.filter("_wanted", lambda w: F.col("_v").between(w["_from"], w["_to"])))).groupBy(
        *keys, "probability", "_v").agg(F.count(F.lit(1)).alias("_n"))
    beside, inside = staged(beside, "beside"), staged(inside, "inside")
    by = [*keys, "probability"]
    counted = inside.join(_small(beside.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_position", "_before", "_most", "_least")), _same(by)).drop(
        *[f"_k_{c}" for c in by])
    while True:
        large = staged(counted.groupBy(*by).count().filter(F.col("count") > _RANKED).select(*[F.col(c).alias(f"_k_{c}") for c in by]), "large")
        if large.isEmpty():
            break
        rest = counted.join(_small(large), _same(by), "left_anti")
        counted = staged(_narrowed(counted.join(_small(large), _same(by), "left_semi"), by).unionByName(rest), "inside")
    order = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_upto", F.col("_before") + F.sum("_n").over(order)).withColumn("_start", F.col("_upto") - F.col("_n"))
    found = ranked.groupBy(*by, "_position").agg(
        F.coalesce(F.max(F.when(_holds(F.floor("_position")), F.col("_v"))), _beside(F.floor("_position"))).alias("_lo"),
        F.coalesce(F.max(F.when(_holds(F.ceil("_position")), F.col("_v"))), _beside(F.ceil("_position"))).alias("_hi"))
    part = F.col("_position") - F.floor("_position")
    # equal ends stay equal
    between = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") * (1 - part) + F.col("_hi") * part)
    return found.select(*keys, "probability", between.alias("quantile"))


def _small(groups: DataFrame) -> DataFrame:
    """A written table of groups, broadcast if it is of few rows."""
    return F.broadcast(groups) if groups.count() <= _BROADCAST_GROUPS else groups


def _same(keys: Sequence[str]) -> Column:
    """Rows and groups of equal keys, nulls too."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))


def _beside(rank: Column) -> Column:
    return F.max(F.when(rank < F.col("_before"), F.col("_most")).otherwise(F.col("_least")))


def _narrowed(counted: DataFrame, by: Sequence[str]) -> DataFrame:
    """The pieces of each group's values that hold its ranks, with the rows before them."""
    rows = in_pieces(counted, by, "_v")
    totals = rows.groupBy(*by, "_b", "_position", "_before").agg(F.sum("_n").alias("_s"))
    upto = F.col("_before") + F.sum("_s").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = totals.withColumn("_upto", upto).withColumn("_start", F.col("_upto") - F.col("_s")).filter(
        _holds(F.floor("_position")) | _holds(F.ceil("_position")) | ((F.floor("_position") < F.col("_start")) & (F.ceil("_position") >= F.col("_upto"))))
    start = held.withColumn("_before", F.min("_start").over(Window.partitionBy(*by))).select(
        *[F.col(c).alias(f"_k_{c}") for c in [*by, "_b"]], F.col("_before").alias("_later"))
    return rows.join(start, _same([*by, "_b"])).withColumn("_before", F.col("_later")).select(*counted.columns)


def _holds(rank: Column) -> Column:
    return (rank >= F.col("_start")) & (rank < F.col("_upto"))


def group_medians(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact median per group: ``(*by, median_<column>...)``."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(by), list(columns), "_c", "_x")
    medians = exact_quantiles(long, [0.5], [*by, "_c"], "_x")
    return medians.groupBy(*by).agg(*[
        F.max(F.when(F.col("_c") == c, F.col("quantile"))).alias(f"median_{c}") for c in columns
    ])


def in_pieces(counted: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``_b``: the piece of its key's values that each distinct value falls in.

    Pieces are cut at quantiles of the key's distinct values. The piece of a value is
    found by a binary search in the array of cuts, one step a projection.
    """
    cuts = counted.groupBy(*keys).agg(F.percentile_approx(
        F.col(value).cast("double"), [i / _PIECES for i in range(1, _PIECES)], 20 * _PIECES).alias("_cuts"))
    # a key that is one constant would leave no join key: both sides carry a zero
    same = F.pmod(F.hash(value), F.lit(1)) == F.col("_zero")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    # one row per key: the columns, models or classes that are compared
    cuts = F.broadcast(cuts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_cuts", F.pmod(F.hash("_cuts"), F.lit(1)).alias("_zero")))
    rows = counted.join(cuts, same).withColumn("_b", F.lit(0))
    step = _PIECES // 2
    while step:
        below = F.coalesce(F.get("_cuts", F.col("_b") + (step - 1)) <= F.col(value), F.lit(False))
        rows = rows.withColumn("_b", F.col("_b") + below.cast("int") * step)
        step //= 2
    return rows.drop("_cuts", "_zero", *[f"_k_{k}" for k in keys])


def running_counts(
    counted: DataFrame, keys: Sequence[str], value: str, counts: Sequence[str]
) -> DataFrame:
    """Running totals over the distinct values of each key, in ascending order.

    ``counted`` has one row per (key, value). Adds ``<c>_upto`` (inclusive),
    ``<c>_total`` per count column and ``next_value``.
    """
    keys = list(keys)
    rows = in_pieces(counted, keys, value)
    by_key = Window.partitionBy(*keys).orderBy("_b")
    totals = rows.groupBy(*keys, "_b").agg(
        *[F.sum(c).alias(f"_s_{c}") for c in counts], F.min(value).alias("_first"))
    offsets = totals.select(
        *keys, "_b",
        *[(F.sum(f"_s_{c}").over(by_key) - F.col(f"_s_{c}")).alias(f"_before_{c}") for c in counts],
        *[F.sum(f"_s_{c}").over(Window.partitionBy(*keys)).alias(f"{c}_total") for c in counts],
        F.lead("_first").over(by_key).alias("_next_first"),
    )
    inside = Window.partitionBy(*keys, "_b").orderBy(value)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.join(offsets, [*keys, "_b"])
        .withColumns({f"{c}_upto": F.col(f"_before_{c}") + F.sum(c).over(upto) for c in counts}
                     | {"next_value": F.coalesce(F.lead(value).over(inside), F.col("_next_first"))})
        .drop("_b", "_next_first", *[f"_before_{c}" for c in counts])
    )


def seeded_order(key: Column, seed: int) -> Column:
    """Reproducible random order: SHA-256 of key and seed, as hex text."""
    return F.sha2(F.concat_ws(":", key.cast("string"), F.lit(str(seed))), 256)


_PREFIX = 4


def global_rank(df: DataFrame, order: str, name: str) -> DataFrame:
    """Rank 1..n by a hex-text column, spread over its 65536 prefixes.

    Its first 60 bits are shuffled as a number, an eighth of the text.
    """
    rows = df.withColumn("_key", F.conv(F.substring(order, 1, 15), 16, 10).cast("long")).withColumn(
        "_p", F.shiftright("_key", 60 - 4 * _PREFIX).cast("int"))
    counts = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_p").orderBy("_key")
    # a row per prefix
    return (rows.join(F.broadcast(before), "_p")
            .withColumn(name, F.col("_before") + F.row_number().over(inside))
            .drop("_p", "_key", "_before"))


def quota_cuts(df: DataFrame, by: str, order: str, quotas: dict) -> dict:
    """Order value at which each class reaches its quota; ``None`` takes no row.

    Counts prefixes first, then ranks the one prefix per class in which the quota is
    reached. Driver state: one text per class.
    """
    rows = df.select(F.col(by).alias("_k"), F.col(order).alias("_o"),
                     F.substring(order, 1, _PREFIX).alias("_p"))
    by_class = Window.partitionBy("_k").orderBy("_p")
    quota = F.lit(None).cast("long")
    for k, n in quotas.items():
        quota = F.when(F.col("_k") == F.lit(k), F.lit(int(n))).otherwise(quota)
    cut = (
        rows.groupBy("_k", "_p").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(by_class))
        .withColumn("_quota", quota)
        .filter((F.col("_quota") > F.col("_upto") - F.col("_n")) & (F.col("_quota") <= F.col("_upto")))
        .select("_k", "_p", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_take"))
        .collect()
    )
    if not cut:
        return {k: (None if int(n) <= 0 else "g") for k, n in quotas.items()}
    # one literal per class; class counts are those of ``quotas``
    here = None
    for r in cut:
        same = (F.col("_k") == F.lit(r["_k"])) & (F.col("_p") == F.lit(r["_p"]))
        here = same if here is None else here | same
    take = F.lit(None).cast("long")
    for r in cut:
        take = F.when(F.col("_k") == F.lit(r["_k"]), F.lit(int(r["_take"]))).otherwise(take)
    ends = (
        rows.filter(here)
        .withColumn("_r", F.row_number().over(Window.partitionBy("_k").orderBy("_o")))
        .filter(F.col("_r") == take).select("_k", "_o").collect()
    )
    found = {r["_k"]: r["_o"] for r in ends}
    # a class smaller than its quota is taken whole: "g" sorts after every hex digit
    return {k: found.get(k, None if int(n) <= 0 else "g") for k, n in quotas.items()}


def within_quota(by: str, order: str, cuts: dict) -> Column:
    """True for the rows inside their class quota."""
    inside = F.lit(False)
    for k, end in cuts.items():
        hit = F.lit(False) if end is None else F.col(order) <= F.lit(end)
        inside = F.when(F.col(by) == F.lit(k), hit).otherwise(inside)
    return inside
