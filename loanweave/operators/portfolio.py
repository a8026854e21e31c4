"""Choosing the most valuable loans under a risk budget.

Every loan has a value (what it is expected to earn) and a weight (the risk it uses up).
The choice maximises the value while the weights stay within the budget: a 0/1 knapsack.

Loans are ranked by value per unit of weight and taken in that order; a loan that no
longer fits is skipped and the next ones are tried. What is lost against the best
possible choice is about one loan's value at most, and ``portfolio_bound`` states an
upper bound for it. It is not a proof of optimality as a mixed-integer solver would give.

No window runs over all loans and no loan table reaches the driver. The place where the
budget runs out is found by summing the weights of a few thousand slices of the ranking
and looking closer at one slice, until one loan is left. What comes back is a rule, a
position in the ranking, that every task applies to its own rows without a join.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import ROUND_FLOOR, Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import BUDGET_FRACTION
from ..session import stage
from .cutoff import AMOUNT, SUM, Cut, find_cut
from .knapsack_core import solve_core
from .running_totals import running_totals

SHARE = "decimal(9,6)"
TOTAL = "decimal(28,6)"
# A rank is the decimal exponent of a density and this many of its digits behind the first.
RANK_DIGITS = 11
FILL_ROWS = 2_000
# Loans that prices may leave open, and rounds of deciding and solving.
CORE_ROWS = 2_000
CORE_ROUNDS = 3
PRICE = "decimal(19,12)"
MILLIONTH = Decimal("1e-6")


def _exact(name: str) -> Column:
    """Money below a million millions, to the millionth; sums of it are exact."""
    return F.col(name).cast(AMOUNT)


def _checked(df: DataFrame, name: str) -> Column:
    """``_exact`` that refuses numbers it cannot hold: a million millions or more, or not 0 but rounded to 0."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)) or (
        isinstance(kind, T.DecimalType) and kind.scale <= 6 and kind.precision - kind.scale <= 12
    ):
        return _exact(name)
    amount, kept = F.col(name), F.col(name).try_cast(AMOUNT)
    lost = amount.isNotNull() & (kept.isNull() | ((kept == 0) & (amount != 0)))
    message = F.concat(F.lit(f"{name} cannot be kept to the millionth: "), amount.cast("string"))
    return F.when(lost, F.raise_error(message)).otherwise(kept)


def _rank(value: Column, weight: Column) -> Column:
    """Ascending rank: value per weight, best first, for positive values and weights.

    A density counts with its leading digits whatever its size. Rounding makes loans of the same rates one class,
    whatever the last digit of the division; within a class the id decides.
    """
    density = F.when((value > 0) & (weight > 0), value.cast("double") / weight.cast("double"))
    exponent = F.floor(F.log10(density))
    digits = F.round(density / F.pow(F.lit(10.0), exponent.cast("double")) * 10.0**RANK_DIGITS).cast("bigint")
    return -(exponent * 10 ** (RANK_DIGITS + 2) + digits)


@dataclass(frozen=True)
class Stretch:
    """All loans of a part of the ranking, up to a largest weight."""

    after: Cut
    until: Cut | None
    largest: Decimal

    def covers(self, rank: Column, key: Column, weight: Column) -> Column:
        inside = self.after.behind(rank, key) & (weight <= F.lit(self.largest).cast(SUM))
        return inside if self.until is None else inside & self.until.before(rank, key)


@dataclass(frozen=True)
class Core:
    """Loans decided by their surplus at a price, except for those whose choice is listed."""

    price: Decimal
    above: Decimal
    ids: tuple[int, ...]
    left_out: tuple[int, ...] = ()

    def surplus(self, value: Column, weight: Column) -> Column:
        """Exact; NULL where the price of the weight has 19 digits or more, so is far above any value."""
        cost = (F.lit(self.price).cast(PRICE) * weight).try_cast("decimal(36,18)")
        return value.cast("decimal(30,18)") - cost

    def covers(self, value: Column, weight: Column, key: Column) -> Column:
        decided = self.surplus(value, weight) >= F.lit(self.above).cast("decimal(38,18)")
        decided = F.coalesce(decided, F.lit(False))
        if self.left_out:
            decided = decided & ~key.isin(list(self.left_out))
        return decided | key.isin(list(self.ids)) if self.ids else decided


@dataclass(frozen=True)
class Selection:
    """Which loans are chosen, as a rule that can be applied to any table with these columns.

    ``optimal`` tells that no choice within the budget is worth more; False only says that this is not known.
    """

    value: str
    weight: str
    id: str
    budget: Decimal
    used: Decimal
    blocked: Cut | None = None
    filled: tuple[int, ...] = ()
    stretches: tuple[Stretch, ...] = ()
    core: Core | None = None
    optimal: bool = False

    def chosen(self) -> Column:
        """True for a chosen loan."""
        earns, weight = _exact(self.value) > 0, _exact(self.weight)
        if self.blocked is None:
            takes = weight >= 0
        elif self.core is not None:
            takes = (weight == 0) | ((weight > 0) & self.core.covers(_exact(self.value), weight, F.col(self.id).cast("bigint")))
        else:
            key = F.col(self.id).cast("bigint")
            rank = _rank(_exact(self.value), weight)
            fits = self.blocked.before(rank, key)
            for stretch in self.stretches:
                fits = fits | stretch.covers(rank, key, weight)
            if self.filled:
                fits = fits | key.isin(list(self.filled))
            takes = (weight == 0) | ((weight > 0) & fits)
        return F.coalesce(earns & takes, F.lit(False))


def _fill(rows: DataFrame, blocked: Cut, last_rank: int, left: Decimal):
    """Go on behind the blocked loan and take what still fits, in ranking order.

    Returns the ids taken one by one, the stretches taken as a whole, and what is left.
    The next ``FILL_ROWS`` loans that could fit are found by counting slices and looked at one by one; usually
    they use up nearly all that is left. If they leave more than half of it, the place where half of it is gone
    is searched for as the budget's end was. So every round halves what is left at least: the number of
    jobs follows its logarithm, not the number of loans, and none is left out.
    """
    taken: list[int] = []
    stretches: list[Stretch] = []
    place: Cut | None = blocked
    rank, key = F.col("rank"), F.col("id")
    while place is not None and left > 0:
        start = left
        candidates = rows.filter(place.behind(rank, key) & (F.col("weight") <= F.lit(left).cast(SUM)))
        counted = candidates.withColumn("weight", F.lit(1).cast(AMOUNT))
        until, _ = find_cut(counted, place.rank, last_rank, Decimal(FILL_ROWS))
        near = candidates if until is None else candidates.filter(until.before(rank, key))
        portion = sorted(near.select("rank", "id", "value", "weight").collect())
        for row in portion:
            if row["weight"] <= left:
                taken.append(row["id"])
                left -= row["weight"]
        if until is None:
            break
        place = Cut(**portion[-1].asDict())
        if 2 * left > start:
            place, left = _use_half(rows, place, last_rank, left, taken, stretches)
    return taken, stretches, left


def _use_half(rows: DataFrame, place: Cut, last_rank: int, left: Decimal, taken: list[int], stretches: list[Stretch]):
    """Take what fits until half of ``left`` is used; returns the place reached, None for the end, and what is left.

    Of the loans above half of what is left only one can be taken: the first that fits beside the
    smaller ones before it. Otherwise the smaller ones alone are taken up to the one that passes the half.
    """
    rank, key, weight = F.col("rank"), F.col("id"), F.col("weight")
    half = (left / 2).quantize(Decimal("1e-6"), rounding=ROUND_FLOOR)
    behind = rows.filter(place.behind(rank, key))
    small = behind.filter(weight <= F.lit(half).cast(SUM))
    large = behind.filter((weight > F.lit(half).cast(SUM)) & (weight <= F.lit(left).cast(SUM)))
    until, rest = find_cut(small, place.rank, last_rank, half)
    if until is not None:
        small, large = (part.filter(until.before(rank, key)) for part in (small, large))
    both = small.withColumn("small", weight).unionByName(large.withColumn("small", F.lit(0).cast(AMOUNT)))
    running = running_totals(both, [rank, key], ["small"])
    fits = (weight > F.lit(half).cast(SUM)) & (F.col("cum_small") + weight <= F.lit(left).cast(SUM))
    first = running.filter(fits).agg(F.min(F.struct("rank", "id", "value", "weight", "cum_small")).alias("x")).first()["x"]
    if first is not None:
        cut = Cut(first["rank"], first["id"], first["value"], first["weight"])
        stretches.append(Stretch(place, cut, half))
        taken.append(cut.id)
        return cut, left - first["cum_small"] - cut.weight
    stretches.append(Stretch(place, until, half))
    if until is None:
        return None, left - (small.agg(F.sum("weight")).first()[0] or Decimal(0))
    taken.append(until.id)
    return until, left - (half - rest) - until.weight


def plan_portfolio(
    df: DataFrame,
    value: str = "expected_value",
    weight: str = "exposure_at_risk",
    budget_fraction: str | float = BUDGET_FRACTION,
    id: str = "id",
    fill: bool = True,
    exact: bool = False,
) -> Selection:
    """Find the selection rule. ``budget_fraction`` is the share of all weights that may be used.

    With ``exact`` it goes on from there to the best choice; ``optimal`` of the result tells if it is proven.

    The id must be a unique BIGINT. Runs a handful of aggregations over four columns, which are written
    once, so that the source plan is not run again for each. Within each file they are sorted by
    rank, so that a pass over a part of the ranking skips the rest.
    """
    narrow = df.select(
        F.col(id).cast("bigint").alias("id"),
        _checked(df, value).alias("value"),
        _checked(df, weight).alias("weight"),
    ).withColumn("rank", _rank(F.col("value"), F.col("weight")))
    narrow = stage(narrow.sortWithinPartitions("rank", "id"), "ranking")
    wanted = (F.col("value") > 0) & (F.col("weight") > 0)
    totals = narrow.agg(
        F.sum("weight").alias("weight"),
        F.sum(F.when(wanted, F.col("weight"))).alias("wanted"),
        F.min(F.when(wanted, F.col("rank"))).alias("low"),
        F.max(F.when(wanted, F.col("rank"))).alias("high"),
    ).first()
    with localcontext() as context:
        context.prec = 60
        total, demand = (totals[name] or Decimal(0) for name in ("weight", "wanted"))
        # Weights have six decimals, so what lies below the sixth cannot be spent.
        budget = (total * Decimal(str(budget_fraction))).quantize(Decimal("1e-6"), rounding=ROUND_FLOOR)
        if demand <= budget:
            return Selection(value, weight, id, budget, demand, optimal=True)
        rows = narrow.filter(wanted)
        blocked, left = find_cut(rows, totals["low"], totals["high"], budget)
        filled, stretches = [], []
        if fill:
            filled, stretches, left = _fill(rows, blocked, totals["high"], left)
        found = Selection(value, weight, id, budget, budget - left, blocked, tuple(filled), tuple(stretches))
        return improve(rows, found) if exact else found


def improve(rows: DataFrame, found: Selection) -> Selection:
    """The best choice from a good one, for the ranking ``rows`` (value and weight above 0).

    Each round is two aggregations over the stored ranking and brings at most ``CORE_ROWS`` loans to the driver: those nearest
    to the price that a bound against the choice at hand leaves open. If there are more, the rest is decided by price, and a
    better choice narrows the bound for the next round. Without a proof in the end the best choice so far stays.
    """
    price = (found.blocked.value / found.blocked.weight).quantize(Decimal("1e-12"), rounding=ROUND_FLOOR)
    if price >= 10**7:
        return found
    by_price = Core(price, Decimal(0), ())
    value, weight = F.col("value"), F.col("weight")
    surplus = by_price.surplus(value, weight)
    chosen = Selection("value", "weight", "id", found.budget, found.used, found.blocked, found.filled, found.stretches).chosen()
    sums = rows.agg(
        F.sum(F.greatest(surplus, F.lit(0).cast("decimal(38,18)"))).alias("surplus"),
        F.sum(F.when(chosen, value)).alias("value"),
    ).first()
    bound = price * found.budget + (sums["surplus"] or 0)
    reached = sums["value"] or Decimal(0)
    for _ in range(CORE_ROUNDS):
        gap = bound - reached
        # Values have six decimals: no choice is between.
        if gap < MILLIONTH:
            return replace(found, optimal=True)
        limit = F.lit(gap).cast("decimal(38,18)")
        decided = surplus >= limit
        inside = F.abs(surplus) < limit
        counts = rows.agg(
            F.count_if(inside).alias("n"), F.sum(F.when(decided, weight)).alias("weight"), F.sum(F.when(decided, value)).alias("value")
        ).first()
        whole = counts["n"] <= CORE_ROWS
        if whole:
            core = rows.where(inside).select("id", "value", "weight").collect()
            above, fixed_weight, fixed_value = gap, counts["weight"] or Decimal(0), counts["value"] or Decimal(0)
        else:
            nearest = rows.where(inside).withColumn("away", F.abs(surplus)).orderBy("away", "id").limit(CORE_ROWS)
            core = nearest.select("id", "value", "weight").collect()
            ids = [row["id"] for row in core]
            rest = rows.where((surplus > 0) & ~F.col("id").isin(ids)).agg(F.sum("weight"), F.sum("value")).first()
            # Behind the nearest ones the sign decides. Rows as near as these that were cut off must not be taken twice.
            above, fixed_weight, fixed_value = None, rest[0] or Decimal(0), rest[1] or Decimal(0)
        units = lambda amount: int(amount / MILLIONTH)
        choice = solve_core(
            [units(row["value"]) for row in core],
            [units(row["weight"]) for row in core],
            float(price),
            units(found.budget - fixed_weight),
            units(reached - fixed_value),
        )
        if choice is None:
            return found
        proven = whole and choice.proven
        better = fixed_value + choice.value * MILLIONTH
        if better > reached:
            picked = tuple(core[k]["id"] for k in choice.chosen)
            used = fixed_weight + sum((core[k]["weight"] for k in choice.chosen), Decimal(0))
            left_out = () if above is not None else tuple(sorted({row["id"] for row in core} - set(picked)))
            above = Decimal("1e-18") if above is None else above
            found = replace(found, used=used, core=Core(price, above, picked, left_out))
            reached = better
        elif not proven:
            return found
        if proven:
            return replace(found, optimal=True)
    return found


def select_portfolio(
    df: DataFrame,
    value: str = "expected_value",
    weight: str = "exposure_at_risk",
    budget_fraction: str | float = BUDGET_FRACTION,
    id: str = "id",
    fill: bool = True,
    exact: bool = False,
) -> DataFrame:
    """Add ``optim_choice`` 1/0 to every loan; with ``exact`` the best choice where it can be found.

    The rule is a projection of the table's own columns: no join, and no copy of the table. The id must be the same
    when the plan of ``df`` runs again.
    """
    selection = plan_portfolio(df, value, weight, budget_fraction, id, fill, exact)
    return df.withColumn("optim_choice", optim_choice(selection.chosen()))


def optim_choice(chosen: Column) -> Column:
    return F.when(chosen, 1).otherwise(0)


def selected_semi(df: DataFrame, selected: DataFrame, id: str = "id") -> DataFrame:
    """Loans whose id is in ``selected``."""
    return df.join(selected.select(id), id, "left_semi")


def removed_anti(df: DataFrame, selected: DataFrame, id: str = "id") -> DataFrame:
    """Loans whose id is not in ``selected``."""
    return df.join(selected.select(id), id, "left_anti")


def filter_selected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("optim_choice") == 1)


def attach_optim_choice(df: DataFrame, choices: DataFrame, id: str = "id") -> DataFrame:
    """Join flags of a selection made elsewhere; loans without a flag get 0."""
    joined = df.join(choices.select(id, "optim_choice"), id, "left")
    return joined.withColumn("optim_choice", F.coalesce(F.col("optim_choice"), F.lit(0)))


def select_optim_inputs(df: DataFrame, id: str = "id") -> DataFrame:
    """The nine columns a selection works with."""
    money = ["credit_amount", "expected_profit", "expected_loss", "expected_value", "exposure_at_risk"]
    return df.select(id, *money, "PD", "LGD", "profit_margin")


def risk_budget(df: DataFrame, fraction: str | float = BUDGET_FRACTION, weight: str = "exposure_at_risk") -> DataFrame:
    """Allowed weight: a share of the weight of all loans."""
    share = F.lit(str(fraction)).cast(SHARE)
    return df.agg((F.sum(_checked(df, weight)).cast(TOTAL) * share).cast("double").alias("risk_budget"))


def check_budget(
    df: DataFrame, fraction: str | float = BUDGET_FRACTION, weight: str = "exposure_at_risk"
) -> DataFrame:
    """Used against allowed weight of a table with ``optim_choice``."""
    share = F.lit(str(fraction)).cast(SHARE)
    amount = _checked(df, weight)
    used = F.coalesce(F.sum(F.when(F.col("optim_choice") == 1, amount)), F.lit(0))
    allowed = F.sum(amount).cast(TOTAL) * share
    return df.agg(
        used.cast("double").alias("used"),
        allowed.cast("double").alias("allowed"),
        F.coalesce(used <= allowed, F.lit(True)).alias("within_budget"),
    )


def portfolio_bound(df: DataFrame, selection: Selection) -> DataFrame:
    """Value of the selection, an upper bound for any selection, and the gap between both.

    For any price p of risk, budget x p + sum(max(0, value - p x weight)) bounds every
    feasible choice from above. At the density of the blocked loan the bound is that of
    the relaxed problem in which loans may be split.
    """
    blocked = selection.blocked
    price = float(blocked.value) / float(blocked.weight) if blocked else 0.0
    value, weight = _exact(selection.value), _exact(selection.weight)
    surplus = F.greatest(value.cast("double") - F.lit(price) * weight.cast("double"), F.lit(0.0))
    reached = F.coalesce(F.sum(F.when(selection.chosen(), value)), F.lit(0)).cast("double")
    return df.agg(
        reached.alias("selected_value"),
        (F.coalesce(F.sum(surplus), F.lit(0.0)) + float(selection.budget) * price).alias("upper_bound"),
    ).withColumn("gap", F.try_divide(F.col("upper_bound") - F.col("selected_value"), F.col("upper_bound")))


def portfolio_totals(df: DataFrame) -> DataFrame:
    """Value, exposure and amount of the selected loans."""
    return filter_selected(df).agg(
        F.sum(_checked(df, "expected_value")).cast("double").alias("total_expected_value"),
        F.sum(_checked(df, "exposure_at_risk")).cast("double").alias("total_risk"),
        F.sum("credit_amount").alias("total_amount"),
    )


def _mean(df: DataFrame, name: str, where: Column | None = None) -> Column:
    """Mean of an exactly summed column."""
    value = _checked(df, name)
    if where is not None:
        value = F.when(where, value)
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def portfolio_means(df: DataFrame) -> DataFrame:
    """Mean PD, LGD and expected value of the selected loans."""
    return filter_selected(df).agg(
        _mean(df, "PD").alias("pd_mean"), _mean(df, "LGD").alias("lgd_mean"), _mean(df, "expected_value").alias("ev_mean")
    )


def portfolio_comparison(df: DataFrame) -> DataFrame:
    """Means before and after the selection: six rows of (metric, value)."""
    selected = F.col("optim_choice") == 1
    means = df.agg(
        *[
            column
            for short, name in (("PD", "PD"), ("LGD", "LGD"), ("EV", "expected_value"))
            for column in (_mean(df, name).alias(f"{short}_initial"), _mean(df, name, selected).alias(f"{short}_optim"))
        ]
    )
    return means.unpivot([], means.columns, "metric", "value")
