"""Evaluation of measures in a filter context, as one plan.

Aggregates of the same fact share one pass.  Their results are small; they are
brought together by a union and one more grouping, which keeps groups that only
one fact has and needs no join.  Arithmetic follows on the combined rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio
from tradewind.operators.ranking import ranked
from tradewind.plans import measures as M
from tradewind.plans.context import ATTRIBUTES, Context, Star, reach, reachable, rows
from tradewind.session import staged

Part = tuple[list[str], DataFrame, list[str]]


def evaluate(
    star: Star,
    names: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Sequence] | None = None,
    windows: Mapping[str, tuple[dt.date, dt.date]] | None = None,
    roles: Mapping[str, str] | None = None,
    anchor: dt.date | None = None,
) -> DataFrame:
    """Measures by attributes.

    `where` filters attributes by value lists, `windows` labels date ranges in
    the column `_win`, `roles` picks a date role per fact, and `anchor` is the
    last day of to-date figures (default: the last purchase).
    """
    ctx = Context(tuple(by), dict(where or {}), dict(windows or {}), dict(roles or {}), anchor)
    return _evaluate(star, list(names), ctx)


def _anchor(star: Star, ctx: Context) -> dt.date:
    if ctx.anchor is not None:
        return ctx.anchor
    if len(ctx.windows) == 1:
        return next(iter(ctx.windows.values()))[1]
    return star.last_purchase


def _ends(star: Star, ctx: Context) -> dict[str | None, dt.date]:
    """Last day of to-date figures: a figure with its own date range follows the end of each outer window."""
    if len(ctx.windows) > 1:
        return {label: last for label, (_, last) in ctx.windows.items()}
    return {(ctx.labels[0] if ctx.windows else None): _anchor(star, ctx)}


def _groups(ctx: Context) -> list[str]:
    return [*ctx.by, *(["_win"] if ctx.windows else [])]


def _evaluate(star: Star, names: list[str], ctx: Context) -> DataFrame:
    plan, same = _planned(names, ctx)
    frame = _combine(star, _parts(star, plan, same, ctx), ctx)
    for level in _levels(plan, same):
        ranks = [n for n in level if n not in same and isinstance(M.MEASURES[n], M.Rank)]
        frame = frame.withColumns({n: F.col(same[n]) if n in same else _derived(n) for n in level if n not in ranks})
        for n in ranks:
            frame = _with_rank(frame, n, M.MEASURES[n], ctx)
    return frame.select(*_groups(ctx), *names)


def _planned(names: list[str], ctx: Context) -> tuple[list[str], dict[str, str]]:
    """Measures to compute, and those that are their base here, because nothing has to be removed from the context."""
    same: dict[str, str] = {}
    while True:
        plan = M.ordered([*same.values(), *names])
        more = {n: M.MEASURES[n].base for n in plan if n not in same and _leaves_context(M.MEASURES[n], ctx)}
        if not more:
            # a base goes before what is the same as it
            return plan, same
        same |= more


def _leaves_context(m, ctx: Context) -> bool:
    if isinstance(m, M.Without):
        return ctx.without(m.attributes) == ctx
    return isinstance(m, M.KeepOnly) and not ctx.windows and {*ctx.by, *ctx.where} <= set(m.attributes)


def _levels(plan: Sequence[str], same: Mapping[str, str]) -> list[list[str]]:
    """Computed measures, grouped so that each level needs only the earlier ones."""
    depth: dict[str, int] = {}
    computed = [n for n in plan if n in same or isinstance(M.MEASURES[n], (M.Calc, M.Trend, M.Rank))]
    levels: list[list[str]] = []
    while len(depth) < len(computed):
        ready = []
        for n in computed:
            if n not in depth:
                needs = [same[n]] if n in same else M.dependencies(M.MEASURES[n])
                if all(d not in computed or depth.get(d, len(levels)) < len(levels) for d in needs):
                    ready.append(n)
        depth |= {n: len(levels) for n in ready}
        levels.append(ready)
    return levels


# --- leaves -----------------------------------------------------------------


def _parts(star: Star, plan: Sequence[str], same: Mapping[str, str], ctx: Context) -> list[Part]:
    """Results that need their own rows; measures that need the same rows share one evaluation."""
    parts: list[Part] = []
    shared: dict[tuple, list[str]] = {}
    for n in plan:
        m = M.MEASURES[n]
        if n in same:
            continue
        if isinstance(m, M.Agg):
            kind = ("aggregate", m.fact, m.key, m.undated)
        elif isinstance(m, M.Period):
            kind = ("compared", *m.roles.items())
        elif isinstance(m, M.Windowed):
            kind = ("windowed", *((label, m.first_day(last)) for label, last in _ends(star, ctx).items()))
        elif isinstance(m, M.Shift):
            kind = ("shifted", m.grain)
        elif isinstance(m, (M.Without, M.KeepOnly)):
            kind = (type(m).__name__, m.attributes)
        elif isinstance(m, M.Over):
            # facts are kept apart: groups that only one has must not show in the other's figures
            kind = ("over", m.attribute, *sorted(_facts(m.deps)))
        elif isinstance(m, M.Standing):
            parts.append(_standing(star, n, m, ctx))
            continue
        elif isinstance(m, M.RankChange):
            parts.append(_rank_change(star, n, m, ctx))
            continue
        else:
            continue
        shared.setdefault(kind, []).append(n)
    for (kind, *what), group in shared.items():
        first = M.MEASURES[group[0]]
        if kind == "aggregate":
            parts.append(_aggregate(star, *what, group, ctx))
        elif kind == "compared":
            parts.append(_compared(star, dict(what), group, ctx))
        elif kind == "windowed":
            parts.append(_windowed(star, dict(what), group, ctx))
        elif kind == "shifted":
            parts.append(_shifted(star, first.grain, group, ctx))
        elif kind == "over":
            parts.append(_over(star, first.attribute, group, ctx))
        elif kind == "Without":
            parts.append(_reduced(star, group, ctx.without(first.attributes)))
        else:
            others = [a for a in {*ctx.by, *ctx.where} if a not in first.attributes]
            parts.append(_reduced(star, group, ctx.without(others).but(windows={})))
    return parts


def _facts(names: Sequence[str]) -> set[str]:
    """Facts that measures come from, through all they are made of."""
    found, seen, todo = set(), set(), list(names)
    while todo:
        n = todo.pop()
        if n in seen:
            continue
        seen.add(n)
        m = M.MEASURES[n]
        if isinstance(m, M.Agg):
            found.add(m.fact)
        todo += [*M.dependencies(m), *getattr(m, "deps", ()), *([m.base] if hasattr(m, "base") else [])]
    return found


def _aggregate(star: Star, fact: str, key: str | None, undated: bool, group: list[str], ctx: Context) -> Part:
    found = [M.MEASURES[n] for n in group]
    if undated:
        dates = [a for a in {*ctx.by, *ctx.where} if ATTRIBUTES[a] == "date"]
        ctx = ctx.without(dates).but(windows={})
    groups = reachable(fact, ctx.by)
    win = ["_win"] if ctx.windows and "date" in reach(fact) else []
    needs = [a for m in found for a in m.needs]
    df = rows(star, fact, list(dict.fromkeys([*groups, *needs])), ctx)
    exprs = [m.expr(star).alias(n) for n, m in zip(group, found)]
    if key is not None:
        inner = {name: build for m in found for name, build in m.inner.items()}
        keyed = dict.fromkeys([*groups, *win, key])
        if inner:
            df = df.groupBy(*keyed).agg(*[build().alias(name) for name, build in inner.items()])
        else:
            df = df.select(*keyed).distinct()
        if key in ATTRIBUTES and ATTRIBUTES[key] != "own":
            df = df.where(F.col(key).isNotNull())
    return groups + win, df.groupBy(*groups, *win).agg(*exprs), group


def _bases(group: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(M.MEASURES[n].base for n in group))


def _reduced(star: Star, group: list[str], ctx: Context) -> Part:
    frame = _evaluate(star, _bases(group), ctx)
    return _groups(ctx), frame.select(*_groups(ctx), *[F.col(M.MEASURES[n].base).alias(n) for n in group]), group


def _over(star: Star, attribute: str, group: list[str], ctx: Context) -> Part:
    found = [M.MEASURES[n] for n in group]
    deps = list(dict.fromkeys(d for m in found for d in m.deps))
    inner = _evaluate(star, deps, ctx.but(by=tuple(dict.fromkeys([*ctx.by, attribute]))))
    if attribute not in ctx.by:
        inner = inner.where(F.col(attribute).isNotNull())
    groups = _groups(ctx)
    return groups, inner.groupBy(*groups).agg(*[m.expr(F.col).alias(n) for n, m in zip(group, found)]), group


def _labelled(frame: DataFrame, ctx: Context) -> DataFrame:
    """Carry the label of the single outer window, if there is one."""
    return frame.withColumn("_win", F.lit(ctx.labels[0])) if ctx.windows else frame


def _windowed(star: Star, first_days: Mapping[str | None, dt.date], group: list[str], ctx: Context) -> Part:
    windows = {label or "w": (first_days[label], last) for label, last in _ends(star, ctx).items()}
    frame = _evaluate(star, _bases(group), ctx.but(windows=windows, anchor=None))
    return _groups(ctx), frame.select(*_groups(ctx), *[F.col(M.MEASURES[n].base).alias(n) for n in group]), group


# --- to-date comparison -------------------------------------------------------


def to_date_windows(anchor: dt.date, grain: str) -> dict[str, tuple[dt.date, dt.date]]:
    """The period to the anchor, and the same days of the period before."""
    months = {"month": 1, "quarter": 3, "year": 12}[grain]
    first_month = {"month": anchor.month, "quarter": (anchor.month - 1) // 3 * 3 + 1, "year": 1}[grain]
    first = anchor.replace(month=first_month, day=1)
    return {"curr": (first, anchor), "prior": (M.add_months(first, -months), M.add_months(anchor, -months))}


def change(curr: Column, prior: Column) -> Column:
    """Relative change; blank when the prior value is blank or 0, blank now counts as 0."""
    p = prior.cast("double")
    return F.when(p != 0, (M.zero(curr) - p) / p)


def to_date_compare(
    star: Star, wanted: Mapping[str, Sequence[str]], ctx: Context | None = None
) -> DataFrame:
    """`<name>__<grain>__curr` and `…__prior` of the bases wanted per grain, one row per group and outer window.

    The ranges of several grains and outer windows overlap; a row is then counted in each range
    it lies in, and all ranges of a fact are read in one pass.
    """
    ctx = ctx or Context()
    ends = _ends(star, ctx)
    ranges = {
        (outer, f"{g}__{w}"): r for outer, last in ends.items() for g in wanted for w, r in to_date_windows(last, g).items()
    }
    labels = {k: f"{k[0] or ''}|{k[1]}" for k in ranges}
    bases = list(dict.fromkeys(n for names in wanted.values() for n in names))
    both = _evaluate(star, bases, ctx.but(windows={labels[k]: r for k, r in ranges.items()}, anchor=None))

    def part(i: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for k, label in labels.items() for x in (label, k[i])]), F.col("_win"))

    own = part(1)
    picked = [
        F.max(F.when(F.col("_own") == f"{g}__{w}", F.col(n))).alias(f"{n}__{g}__{w}")
        for g, names in wanted.items()
        for n in names
        for w in ("curr", "prior")
    ]
    both = both.withColumn("_own", own)
    if len(ends) == 1:
        # one outer window has a row even where no day of it has any
        return _labelled(both.groupBy(*ctx.by).agg(*picked), ctx)
    return both.withColumn("_win", part(0)).groupBy(*_groups(ctx)).agg(*picked)


def _compared(star: Star, roles: Mapping[str, str], group: list[str], ctx: Context) -> Part:
    found = {n: M.MEASURES[n] for n in group}
    wanted: dict[str, list[str]] = {}
    for m in found.values():
        bases = wanted.setdefault(m.grain, [])
        if m.base not in bases:
            bases.append(m.base)
    frame = to_date_compare(star, wanted, ctx.but(roles={**ctx.roles, **roles}))
    shown = []
    for n, m in found.items():
        curr, prior = (F.col(f"{m.base}__{m.grain}__{w}") for w in ("curr", "prior"))
        value = {
            "curr": curr,
            "prior": prior,
            "pct": change(curr, prior),
            "delta": F.when(curr.isNotNull() | prior.isNotNull(), M.zero(curr) - M.zero(prior)),
        }[m.part]
        shown.append(value.alias(n))
    return _groups(ctx), frame.select(*_groups(ctx), *shown), group


# --- whole-period shift -----------------------------------------------------------

PERIOD_NUMBER = {"month": "month_index", "quarter": "quarter_index", "year": "year"}


def shift_compare(star: Star, names: Sequence[str], grain: str, ctx: Context | None = None) -> DataFrame:
    """Every base per month, quarter or year beside its value one period before.

    Periods are numbered without gaps, so the earlier value sits at number - 1
    and one grouping pairs the two.
    """
    ctx = ctx or Context()
    number = PERIOD_NUMBER[grain]
    groups = [*ctx.by, number]
    values = _evaluate(star, list(names), ctx.but(by=tuple(groups)))
    now = values.select(*groups, *names, *[F.lit(None).cast(values.schema[n].dataType).alias(f"{n}__prior") for n in names])
    then = values.select(
        *ctx.by,
        (F.col(number) + 1).alias(number),
        *[F.lit(None).cast(values.schema[n].dataType).alias(n) for n in names],
        *[F.col(n).alias(f"{n}__prior") for n in names],
    )
    last = star.bounds[1]
    top = {"month": last.year * 12 + last.month, "quarter": last.year * 4 + (last.month + 2) // 3, "year": last.year}
    pairs = [F.max(c).alias(c) for n in names for c in (n, f"{n}__prior")]
    both = now.unionByName(then).where(F.col(number) <= top[grain]).groupBy(*groups).agg(*pairs)
    for n in names:
        both = both.withColumn(f"{n}__pct", ratio(M.zero(F.col(n)) - F.col(f"{n}__prior").cast("double"), F.col(f"{n}__prior")))
    return both


def _shifted(star: Star, grain: str, group: list[str], ctx: Context) -> Part:
    """A shift inside a context is that of the period the anchor lies in."""
    a = _anchor(star, ctx)
    number = {"month": a.year * 12 + a.month, "quarter": a.year * 4 + (a.month + 2) // 3, "year": a.year}[grain]
    column, bases = PERIOD_NUMBER[grain], _bases(group)
    if column in ctx.by:
        rest = tuple(x for x in ctx.by if x != column)
        frame = shift_compare(star, bases, grain, ctx.but(by=rest, windows={}))
    else:
        inner = ctx.but(windows={}, where={**ctx.where, column: [number - 1, number]})
        frame = shift_compare(star, bases, grain, inner).where(F.col(column) == number)
    values = [F.col(f"{M.MEASURES[n].base}__{M.MEASURES[n].part}").alias(n) for n in group]
    return _groups(ctx), _labelled(frame.select(*ctx.by, *values), ctx), group


def _rank_change(star: Star, name: str, m: M.RankChange, ctx: Context) -> Part:
    """Rank one year before minus rank now (default: all visible days)."""
    lo, hi = next(iter(ctx.windows.values())) if ctx.windows else star.bounds
    now = {"now": (lo, hi)}
    before = {"before": (M.add_months(lo, -12), M.add_months(hi, -12))}
    # both ranges are read in one pass
    values = _evaluate(star, [m.base], ctx.but(windows=now | before))
    others = [a for a in ctx.by if a != m.attribute]
    both = ranked(values.select(*ctx.by, "_win", m.base), m.base, [*others, "_win"], dense="_place")
    place = {w: F.max(F.when(F.col("_win") == w, F.col("_place"))) for w in ("now", "before")}
    frame = both.groupBy(*ctx.by).agg((place["before"] - place["now"]).alias(name))
    return _groups(ctx), _labelled(frame, ctx), [name]


# --- bringing results together -------------------------------------------------------


def _combine(star: Star, parts: list[Part], ctx: Context) -> DataFrame:
    groups = _groups(ctx)
    full, partial = [], []
    for columns, frame, names in parts:
        if ctx.windows and "_win" not in columns and set(columns) == set(ctx.by):
            # a figure without a date has the same value in every window
            frame = frame.withColumn("_win", F.explode(F.array(*[F.lit(w) for w in ctx.labels])))
            columns = groups
        (full if set(columns) == set(groups) else partial).append((columns, frame, names))

    if full:
        frame = full[0][1]
        if len(full) > 1:
            stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f for _, f, _ in full])
            names = [n for _, _, ns in full for n in ns]
            frame = stacked.groupBy(*groups).agg(*[F.max(n).alias(n) for n in names])
    elif not groups:
        frame = star.tables["dim_date"].sparkSession.range(1).select()
    else:
        raise ValueError(f"no requested measure can be grouped by {groups}")

    for columns, part, names in partial:
        if columns:
            right = part.select(*[F.col(c).alias(f"_r_{c}") for c in columns], *names)
            same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns])
            frame = frame.join(right, same, "left").drop(*[f"_r_{c}" for c in columns])
        else:
            one = part.select(F.struct(*names)).scalar()
            frame = frame.select("*", *[one.getField(n).alias(n) for n in names])
    return frame


def _derived(name: str) -> Column:
    m = M.MEASURES[name]
    if isinstance(m, M.Calc):
        return m.expr(F.col)
    return trend_arrow(F.col(m.base), m) if m.kind == "arrow" else trend_color(F.col(m.base), m)


def _with_rank(frame: DataFrame, name: str, m: M.Rank, ctx: Context) -> DataFrame:
    """Dense rank by falling base among the rows that differ in the attribute only; blank where the base is."""
    if m.attribute not in ctx.by:
        raise ValueError(f"{name} needs the attribute {m.attribute}")
    others = [c for c in _groups(ctx) if c != m.attribute]
    frame = staged(frame)
    blank = frame.where(F.col(m.base).isNull()).withColumn(name, F.lit(None).cast("long"))
    return ranked(frame, m.base, others, dense=name).withColumn(name, F.col(name).cast("long")).unionByName(blank)


def _standing(star: Star, name: str, m: M.Standing, ctx: Context) -> Part:
    if _groups(ctx) != [m.attribute]:
        raise ValueError(f"{name} is defined over {m.attribute} alone")
    base = _evaluate(star, [m.base], ctx)
    placed = ranked(base, m.base, **{m.part: name})
    return _groups(ctx), placed.select(m.attribute, name), [name]


def trend_arrow(pct: Column, m: M.Trend) -> Column:
    up = pct > 0 if m.higher_is_better else pct < 0
    down = pct < 0 if m.higher_is_better else pct > 0
    return F.when(up, "up").when(down, "down").otherwise("flat")


def trend_color(pct: Column, m: M.Trend) -> Column:
    good = pct > 0 if m.higher_is_better else pct < 0
    bad = pct < 0 if m.higher_is_better else pct > 0
    return F.when(good, "good").when(bad, "bad").otherwise("neutral")
