"""Exact quantiles of large tables by selection: no sort, no window, one scan for each pass.

The first pass counts the values and sketches them. A pass then takes two edges around each wanted
rank from the sketch, counts the values below, at and between the edges exactly, and sketches what
lies between. That narrows the bracket of every quantile of every column and group at once, by a
factor of about a hundred; a bracket of a few thousand values is listed. Edges are values of the
column, so a value that fills half of it is found by its counts and never listed.
"""

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 10_000
POINTS = 256  # places at which a sketch is read
LISTED = 1 << 14  # values of a bracket that are listed
FRACTIONS = [i / POINTS for i in range(POINTS + 1)]


@dataclass
class Target:
    """One quantile of one column and group, and the open bracket that still holds its ranks."""

    group: object
    column: str
    share: float
    count: int
    points: list  # of the sketch of the bracket
    ranks: dict = field(default_factory=dict)  # rank to value, None until it is known
    before: int = 0  # values up to the bracket
    inside: int = 0  # values in the bracket
    low: float | None = None
    high: float | None = None
    final: bool = False  # the next pass lists the bracket

    def __post_init__(self):
        at = self.share * (self.count - 1)
        self.ranks = {math.floor(at): None, math.ceil(at): None}
        self.inside = self.count

    @property
    def open(self):
        return [r for r, v in self.ranks.items() if v is None]

    def value(self):
        at = self.share * (self.count - 1)
        a, b = self.ranks[math.floor(at)], self.ranks[math.ceil(at)]
        return a if a == b else a + (b - a) * (at - math.floor(at))

    def edges(self):
        """Edges on both sides of the open ranks by the sketch; None where the bracket's end serves."""
        if self.inside <= LISTED:
            self.final = True
            return None, None
        slack = 2 + math.ceil(2 * POINTS / ACCURACY)
        first, last = min(self.open) - self.before, max(self.open) - self.before
        low = math.floor(first * POINTS / self.inside) - slack
        high = math.ceil((last + 1) * POINTS / self.inside) + slack
        self.final = self.inside * (high - low + 2) / POINTS <= LISTED
        return (self.points[low] if low > 0 else None), (self.points[high] if high < POINTS else None)

    def narrow(self, low, high, found):
        """Take the exact counts around the edges, and the list or the sketch between them."""
        before, upto = (found["below_low"], found["upto_low"]) if low is not None else (self.before, self.before)
        under, through = (found["below_high"], found["upto_high"]) if high is not None else (math.inf, math.inf)
        values = sorted(found["between"] or []) if self.final else None
        for r in self.open:
            if low is not None and before <= r < upto:
                self.ranks[r] = low
            elif high is not None and under <= r < through:
                self.ranks[r] = high
            elif values is not None:
                self.ranks[r] = values[r - upto]
        self.low = self.low if low is None else low
        self.high = self.high if high is None else high
        self.inside = (self.before + self.inside if high is None else under) - upto
        self.before = upto
        self.points = [] if self.final else found["between"]


def _limits(target, edges):
    """Both edges, the ends of what is listed or sketched, and which of the two it is."""
    low, high = edges
    # Where an edge is missing, the bracket's own end limits what is listed or sketched.
    return low, high, target.low if low is None else low, target.high if high is None else high, target.final


LIMITS = "low double, high double, from double, to double, final boolean"


def _summary(v, limits, some):
    """Counts around the edges, and the list or the sketch between; ``some`` says what targets need."""
    low, high, start, end, final = limits
    inside = v.isNotNull()
    if "from" in some:
        inside = inside & (start.isNull() | (v > start))
    if "to" in some:
        inside = inside & (end.isNull() | (v < end))
    none = F.lit(None)
    counts = F.struct(
        *[x.alias(f"{n}_low") for n, x in (("below", F.count_if(v < low)), ("upto", F.count_if(v <= low))) if "low" in some],
        *[x.alias(f"{n}_high") for n, x in (("below", F.count_if(v < high)), ("upto", F.count_if(v <= high))) if "high" in some],
        F.count(v).alias("count"),
    )
    listed = F.collect_list(F.when(final & inside, v)) if "final" in some else F.max(none)
    sketch = F.percentile_approx(F.when(~final & inside, v), FRACTIONS, ACCURACY) if "sketch" in some else F.max(none)
    return counts, listed, sketch


def _pass(rows, targets, grouped):
    """One scan that narrows all targets, each by its own edges within its own bracket."""
    limits = {(t.group, t.column, t.share): _limits(t, t.edges()) for t in targets}
    by_key = {(t.group, t.column, t.share): t for t in targets}
    groups = list(dict.fromkeys(t.group for t in targets))
    kinds = list(dict.fromkeys((t.column, t.share) for t in targets))
    if grouped:
        fields = [T.StructField(f"_e{i}", T.StructType.fromDDL(LIMITS)) for i in range(len(kinds))]
        schema = T.StructType([rows.schema["_g"], *fields])
        table = [(g, *[limits.get((g, *k)) for k in kinds]) for g in groups]
        table = rows.sparkSession.createDataFrame(table, schema)
        rows = rows.join(F.broadcast(table), "_g")  # one row for each group
    aggregates = []
    for i, kind in enumerate(kinds):
        known = [limits[(g, *kind)] for g in groups if (g, *kind) in limits]
        if grouped:
            e = [F.col(f"_e{i}")[n] for n in ("low", "high", "from", "to", "final")]
        else:
            e = [F.lit(x).cast("boolean" if n == 4 else "double") for n, x in enumerate(known[0])]
        some = {n for n, place in (("low", 0), ("high", 1), ("from", 2), ("to", 3)) if any(x[place] is not None for x in known)}
        some |= {"final" if x[4] else "sketch" for x in known}
        aggregates += [x.alias(f"{n}{i}") for n, x in zip("cls", _summary(F.col(kind[0]), e, some))]
    for row in rows.groupBy("_g").agg(*aggregates).collect():
        for i, kind in enumerate(kinds):
            if target := by_key.get((row["_g"], *kind)):
                between = row[f"l{i}"] if target.final else row[f"s{i}"]
                low, high, *_ = limits[(row["_g"], *kind)]
                target.narrow(low, high, {**row[f"c{i}"].asDict(), "between": between})


def selected_quantiles(df: DataFrame, columns, shares, group: str | None = None, also=()):
    """The quantiles by (group, column, share), and a row of the aggregates ``also`` for each group.

    Linearly interpolated. ``group`` is for a flag or a small set of classes; without it the group
    is 0. Null values and null groups are left out, and so are columns without a value. ``df`` is
    scanned twice or, beyond some hundred thousand rows, once more for each factor of a hundred:
    give it stored.
    """
    g = F.col(group) if group else F.lit(0)
    names = {c: f"_v{i}" for i, c in enumerate(columns)}
    rows = df.select(g.alias("_g"), *[F.col(c).cast("double").alias(n) for c, n in names.items()], *[c for c in columns])
    rows = rows.filter("_g is not null")
    first = rows.groupBy("_g").agg(
        *[F.count(n).alias(f"n{n}") for n in names.values()],
        *[F.percentile_approx(n, FRACTIONS, ACCURACY).alias(f"s{n}") for n in names.values()],
        *also,
    )
    first = first.collect()
    rows = rows.select("_g", *names.values())
    targets = [
        Target(r["_g"], n, float(s), r[f"n{n}"], r[f"s{n}"])
        for r in first
        for n in names.values()
        if r[f"n{n}"]
        for s in shares
    ]
    while left := [t for t in targets if t.open]:
        _pass(rows, left, group is not None)
    back = {n: c for c, n in names.items()}
    return {(t.group, back[t.column], t.share): t.value() for t in targets}, first


def exact_quantiles(df: DataFrame, value: str, shares, group: str | None = None) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group: columns group, share, quantile.

    See ``selected_quantiles``; the result has one row for each share and group.
    """
    found, _ = selected_quantiles(df, (value,), shares, group)
    kind = [T.StructField(group, df.schema[group].dataType)] if group else []
    schema = T.StructType([*kind, T.StructField("share", T.DoubleType()), T.StructField("quantile", T.DoubleType())])
    rows = [((g,) if group else ()) + (share, q) for (g, _, share), q in found.items()]
    return df.sparkSession.createDataFrame(rows, schema)
