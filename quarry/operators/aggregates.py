"""Aggregates of the dialect as Columns: by another column's extreme, distinct counts, quantiles, conditions, states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def arg_min(value: Column, key: Column) -> Column:
    """value where key is least; null keys are skipped."""
    return F.min_by(value, key)


def arg_max(value: Column, key: Column) -> Column:
    return F.max_by(value, key)


def _one(cols: tuple[Column, ...]) -> Column:
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def _known(cols: tuple[Column, ...]) -> Column:
    """A 64-bit hash of the columns; null where a single column is."""
    return F.when(cols[0].isNotNull(), F.xxhash64(cols[0])) if len(cols) == 1 else F.xxhash64(*cols)


def uniq_exact(*cols: Column) -> Column:
    """Number of distinct values; of several columns of distinct tuples, those with nulls included."""
    return F.count_distinct(_one(cols))


def uniq_exact_if(condition: Column, *cols: Column) -> Column:
    return F.count_distinct(F.when(condition, _one(cols)))


def uniq(*cols: Column, rsd: float = 0.01) -> Column:
    """Approximate number of distinct values."""
    return F.approx_count_distinct(_known(cols), rsd)


def uniq_combined(*cols: Column, lg_k: int = 14) -> Column:
    return F.hll_sketch_estimate(F.hll_sketch_agg(_known(cols), F.lit(lg_k)))


def uniq_combined64(*cols: Column, lg_k: int = 17) -> Column:
    return F.hll_sketch_estimate(F.hll_sketch_agg(_known(cols), F.lit(lg_k)))


def uniq_hll12(*cols: Column) -> Column:
    return F.hll_sketch_estimate(F.hll_sketch_agg(_known(cols), F.lit(12)))


def uniq_theta(*cols: Column) -> Column:
    return F.theta_sketch_estimate(F.theta_sketch_agg(_known(cols)))


def quantile(x: Column, p: float = 0.5) -> Column:
    """Interpolated quantile. Exact: an executor holds the distinct values of a group; see quantile_approx()."""
    return F.percentile(x, F.lit(p))


def quantile_exact(column: str, p: float = 0.5, condition: str = "true") -> Column:
    """The least value of a named column that a share p of the values does not exceed, over the rows where an SQL condition holds."""
    return F.expr(f"percentile_disc({float(p)}) within group (order by `{column}`) filter (where {condition})")


def quantile_approx(x: Column, p: float = 0.5, accuracy: int = 10_000) -> Column:
    """Quantile of bounded memory, off by at most a share 1 / accuracy of the ranks."""
    return F.percentile_approx(x, F.lit(p), accuracy)


def percentile_cont(x: Column, p: float, descending: bool = False, allow_descending: bool = False) -> Column:
    """The ordered-set aggregate; descending order is refused unless allowed."""
    if descending and not allow_descending:
        raise ValueError("percentile_cont takes ascending order only")
    return F.percentile(x, F.lit(1 - p if descending else p))


def when_true(aggregate, condition: Column, *cols: Column) -> Column:
    """The -If form: aggregate over the rows where the condition holds."""
    return aggregate(*[F.when(condition, c) for c in cols])


# mergeable states: a dictionary of columns to aggregate by, and the expression that merges them

_STATES = {
    "sum": (lambda x: {"sum": F.sum(x)}, lambda s: F.sum(s["sum"])),
    "count": (lambda x: {"count": F.count(x)}, lambda s: F.sum(s["count"])),
    "min": (lambda x: {"min": F.min(x)}, lambda s: F.min(s["min"])),
    "max": (lambda x: {"max": F.max(x)}, lambda s: F.max(s["max"])),
    "avg": (lambda x: {"sum": F.sum(x), "count": F.count(x)}, lambda s: F.sum(s["sum"]) / F.nullif(F.sum(s["count"]), F.lit(0).cast("bigint"))),
    "uniq": (lambda x: {"theta": F.theta_sketch_agg(_known((x,)))}, lambda s: F.theta_sketch_estimate(F.theta_union_agg(s["theta"]))),
    "uniqHLL12": (lambda x: {"hll": F.hll_sketch_agg(_known((x,)), F.lit(12))}, lambda s: F.hll_sketch_estimate(F.hll_union_agg(s["hll"]))),
    "quantile": (lambda x: {"kll": F.kll_sketch_agg_double(x.cast("double"))}, lambda s: s["kll"]),
}


def state(kind: str, name: str, x: Column) -> list[Column]:
    """Columns of a mergeable state of aggregate `kind`, named name__part."""
    if kind not in _STATES:
        raise ValueError(f"no mergeable state for {kind!r}; there are {', '.join(_STATES)}")
    return [c.alias(f"{name}__{part}") for part, c in _STATES[kind][0](x).items()]


def merge(kind: str, name: str, p: float = 0.5) -> Column:
    """The aggregate's value over all states of a group."""
    if kind not in _STATES:
        raise ValueError(f"no mergeable state for {kind!r}; there are {', '.join(_STATES)}")
    if kind == "quantile":
        return F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(f"{name}__kll"), F.lit(p))
    parts = _STATES[kind][0](F.lit(0))
    return _STATES[kind][1]({part: F.col(f"{name}__{part}") for part in parts})
