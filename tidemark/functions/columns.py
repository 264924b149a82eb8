"""Native column expressions (JVM-side, codegen-friendly).

Every per-row rule of the analysed pipeline (channel grouping, segment
names, CLV levels, mismatch labels, elapsed days) is a plain Column
expression here - no Python UDFs.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

MICROS_PER_DAY = 86_400_000_000


def col_(c: "str | Column") -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A naive (timezone-free) timestamp literal; never session-zone based."""
    s = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(s).cast("timestamp_ntz")


def floor_days(start: "str | Column", end: "str | Column") -> Column:
    """Whole days elapsed from start to end, floored (negative spans floor
    towards minus infinity, like a timedelta's ``.days``). Exact integer
    arithmetic on microseconds; the result is BIGINT."""
    us = F.timestamp_diff("MICROSECOND", col_(start), col_(end))
    d = F.lit(MICROS_PER_DAY)
    return ((us - F.pmod(us, d)) / d).cast("long")


def day_diff(start: "str | Column", end: "str | Column") -> Column:
    """Calendar-day difference (both truncated to the day first)."""
    return F.datediff(F.to_date(col_(end)), F.to_date(col_(start))).cast("long")


def _q(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def channel_group(channel: "str | Column", mapping: dict | None = None) -> Column:
    """Channel code -> group via a literal map; unknown codes and null give
    'Unknown'. Case-sensitive, as in the analysed pipeline."""
    mapping = C.CHANNEL_GROUPS if mapping is None else mapping
    if isinstance(channel, str):
        pairs = ", ".join(f"{_q(k)}, {_q(v)}" for k, v in mapping.items())
        return F.expr(f"coalesce(element_at(map({pairs}), `{channel}`), {_q(C.UNKNOWN_GROUP)})")
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.element_at(m, col_(channel)), F.lit(C.UNKNOWN_GROUP))


def dummy_name(group: str) -> str:
    return "channel_" + group.lower().replace("/", "_")


def channel_dummies(group_col: "str | Column" = "channel_group") -> list[Column]:
    """Fixed six boolean one-hot columns (constant output schema)."""
    if isinstance(group_col, str):
        return [F.expr(f"`{group_col}` = {_q(name)}").alias(dummy_name(name)) for name in C.CHANNEL_GROUP_NAMES]
    g = col_(group_col)
    return [(g == F.lit(name)).alias(dummy_name(name)) for name in C.CHANNEL_GROUP_NAMES]


DUMMY_COLUMNS: tuple[str, ...] = tuple(dummy_name(g) for g in C.CHANNEL_GROUP_NAMES)


def segment_name(score: "str | Column") -> Column:
    if isinstance(score, str):
        whens = " ".join(f"WHEN `{score}` >= {b} THEN {_q(n)}" for b, n in C.RFM_SEGMENT_BOUNDS)
        return F.expr(f"CASE {whens} ELSE {_q(C.RFM_SEGMENT_FLOOR)} END")
    s = col_(score)
    out = None
    for bound, name in C.RFM_SEGMENT_BOUNDS:
        out = F.when(s >= bound, F.lit(name)) if out is None else out.when(s >= bound, F.lit(name))
    return out.otherwise(F.lit(C.RFM_SEGMENT_FLOOR))


def rfm_code(r: "str | Column", f: "str | Column", m: "str | Column") -> Column:
    return F.concat(col_(r).cast("string"), col_(f).cast("string"), col_(m).cast("string"))


def clv_level_abs(clv: "str | Column", is_onetimer: "str | Column | bool") -> Column:
    """Absolute-threshold CLV level (scoring rule)."""
    if isinstance(clv, str) and isinstance(is_onetimer, str):
        def ladder_sql(bounds):
            lo, mid, hi = bounds
            return (f"CASE WHEN `{clv}` < {lo!r}D THEN 'Low' WHEN `{clv}` < {mid!r}D THEN 'Mid' "
                    f"WHEN `{clv}` < {hi!r}D THEN 'High' ELSE 'Top' END")
        return F.expr(f"CASE WHEN `{is_onetimer}` THEN {ladder_sql(C.CLV_LEVEL_BOUNDS_ONETIMER)} "
                      f"ELSE {ladder_sql(C.CLV_LEVEL_BOUNDS_REPEATER)} END")
    v = col_(clv)
    one = F.lit(is_onetimer) if isinstance(is_onetimer, bool) else col_(is_onetimer)

    def ladder(bounds):
        lo, mid, hi = bounds
        return (F.when(v < lo, "Low").when(v < mid, "Mid").when(v < hi, "High")
                .otherwise("Top"))

    return F.when(one, ladder(C.CLV_LEVEL_BOUNDS_ONETIMER)).otherwise(
        ladder(C.CLV_LEVEL_BOUNDS_REPEATER))


def mismatch(segment: "str | Column", level: "str | Column") -> Column:
    if isinstance(segment, str) and isinstance(level, str):
        hi = ", ".join(_q(x) for x in C.HIGH_RFM_SEGMENTS)
        lo = ", ".join(_q(x) for x in C.LOW_RFM_SEGMENTS)
        return F.expr(f"CASE WHEN `{segment}` IN ({hi}) AND `{level}` = 'Low' THEN {_q(C.MISMATCH_OVERRATED)} "
                      f"WHEN `{segment}` IN ({lo}) AND `{level}` IN ('High', 'Top') THEN {_q(C.MISMATCH_UNDERRATED)} "
                      f"ELSE {_q(C.MISMATCH_ALIGNED)} END")
    seg, lvl = col_(segment), col_(level)
    return (F.when(seg.isin(*C.HIGH_RFM_SEGMENTS) & (lvl == "Low"), F.lit(C.MISMATCH_OVERRATED))
            .when(seg.isin(*C.LOW_RFM_SEGMENTS) & lvl.isin("High", "Top"),
                  F.lit(C.MISMATCH_UNDERRATED))
            .otherwise(F.lit(C.MISMATCH_ALIGNED)))


def money(c: "str | Column", precision: int = 28, scale: int = 6) -> Column:
    """Money as an exact decimal so sums do not depend on row order."""
    return col_(c).cast(f"decimal({precision},{scale})")


def r6(c: "str | Column") -> Column:
    """Round a double to 6 dp (report hygiene for cross-engine checks)."""
    return F.round(col_(c).cast("double"), 6)
