"""Skew-safe ordered scans: lag / lead / running max / running sum per key.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task; if one key holds a third of 100 TB that task never finishes. Here
each key is cut into *buckets* that are contiguous ranges of the sort order
(e.g. ``floor(ts / width)`` when the order starts with ``ts``):

1. row pass   -- window over ``(key, bucket)``: the in-bucket lag / lead /
                 running aggregate (one hash exchange of the rows);
2. summary    -- ``groupBy(key, bucket)`` with map-side partial aggregation:
                 last / first value and total per bucket (one row per bucket);
3. carry      -- window over the summary only, partitioned by key and
                 ordered by bucket: what earlier (or later) buckets contribute;
4. join back  -- on ``(key, bucket)``: the big side is already partitioned
                 by exactly these columns, so only the small summary moves.

With ``bucket=None`` the scan is a plain window over ``keys`` (used for small
inputs and as the reference in tests). ``auto_bucket`` picks a bucket width
from the data so that the densest key gets about ``target_rows`` rows per
bucket, and returns ``None`` when no key is that large.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_TARGET_ROWS = 4_000_000
TARGET_ROWS_CONF = "spark.chronokey.bucketTargetRows"

_B = "__ck_bucket"
_K = "__ck_key"
_FIRST = "__ck_first"
_LAST = "__ck_last"
_LOWEST = -(2**63)  # bucket of rows whose order is null: nulls sort first

# kind -> frame of the in-bucket running aggregate
_RUNNING = {"max": "run", "max_before": "before", "sum": "run", "sum_before": "before"}
KINDS = ("prev", "next", *_RUNNING)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _key_window(keys: list[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy()


def target_rows_for(df: DataFrame, target_rows: int | None) -> int:
    """Explicit value, else the session setting ``spark.chronokey.bucketTargetRows``,
    else 4M rows per bucket."""
    if target_rows is not None:
        return target_rows
    conf = df.sparkSession.conf.get(TARGET_ROWS_CONF, None)
    return int(conf) if conf else DEFAULT_TARGET_ROWS


def key_stats(df: DataFrame, keys: list[str], value, min_rows: int = 0) -> dict | None:
    """Rows of the largest key, the widest key span of ``value`` and the
    highest rows-per-unit density among keys with more than ``min_rows``
    rows (only those need splitting; a tiny key's burst must not shrink
    everyone's buckets). One aggregation job, partially aggregated map-side;
    the result is a single row."""
    v = _as_col(value)
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), (F.max(v) - F.min(v) + F.lit(1)).alias("span")
    )
    top = per_key.agg(
        F.max("n").alias("n"),
        F.max(F.when(F.col("n") > F.lit(min_rows), F.col("n") / F.col("span"))).alias("density"),
        F.max("span").alias("span"),
    ).first()
    return None if top is None or top["n"] is None else top.asDict()


def _refine_width(df: DataFrame, keys: list[str], value, width: float, target_rows: int) -> int:
    """Shrink ``width`` while the densest ``(key, bucket)`` exceeds twice the
    target: the first width assumes rows spread evenly over a key's span, a
    burst does not. Each pass is one aggregation (run only when buckets are
    needed) and shrinks by four times the overshoot, so the loop ends below
    the target or at width 1. Rows sharing one timestamp cannot be split by
    time; pass an explicit ``bucket`` width for data beyond that."""
    w = max(1, math.floor(width))
    v = _as_col(value)
    while True:
        densest = (
            df.groupBy(*keys, F.floor(v / F.lit(w)).alias("__b"))
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max("n"))
            .first()[0]
        )
        if not densest or densest <= 2 * target_rows or w == 1:
            return w
        w = max(1, math.floor(w * target_rows / (4 * densest)))


def auto_bucket(
    df: DataFrame,
    keys: list[str],
    value,
    target_rows: int | None = None,
    min_buckets: int = 1,
    stats: dict | None = None,
) -> Column | None:
    """Bucket expression ``floor(value / width)`` sized from the data, or None.

    ``value`` must be numeric and non-decreasing along the scan order (epoch
    micros of the leading time column, or a dense sequence number). ``width``
    is chosen so that the densest key gets ``target_rows`` rows per bucket on
    average; None when no key has more than ``target_rows`` rows.
    ``min_buckets > 1`` forces at least that many buckets over the widest key
    (used for keyless scans, which must never become one un-partitioned
    window).
    """
    target_rows = target_rows_for(df, target_rows)
    top = stats if stats is not None else key_stats(df, keys, value, 0 if min_buckets > 1 else target_rows)
    if top is None:
        return None
    if min_buckets <= 1 and top["n"] <= target_rows:
        return None
    width = target_rows / top["density"]
    if min_buckets > 1:
        width = min(width, top["span"] / min_buckets)
    if top["n"] > target_rows:
        width = _refine_width(df, keys, value, width, target_rows)
    return F.floor(_as_col(value) / F.lit(max(1, math.floor(width)))).cast("long")


def auto_width(
    df: DataFrame, keys: list[str], value, target_rows: int | None = None, stats: dict | None = None
) -> int | None:
    """Bucket width (in units of ``value``) giving the densest key about
    ``target_rows`` rows per bucket; None when no key has that many rows."""
    target_rows = target_rows_for(df, target_rows)
    top = stats if stats is not None else key_stats(df, keys, value, target_rows)
    if top is None or top["n"] <= target_rows:
        return None
    return _refine_width(df, keys, value, target_rows / top["density"], target_rows)


def resolve_width(
    df: DataFrame, keys: list[str], value, bucket, target_rows: int | None = None, stats: dict | None = None
) -> int | None:
    """Like :func:`resolve_bucket` but returns the width: None, "auto" or an int."""
    if bucket is None or isinstance(bucket, int):
        return bucket
    if bucket == "auto":
        return auto_width(df, keys, value, target_rows, stats)
    raise ValueError(f"bucket must be None, 'auto' or an int width here, not {bucket!r}")


def resolve_bucket(
    df: DataFrame,
    keys: list[str],
    value,
    bucket,
    target_rows: int | None = None,
    min_buckets: int = 1,
    stats: dict | None = None,
):
    """``bucket`` may be None, "auto", an int width in units of ``value``, or a Column."""
    if bucket is None or isinstance(bucket, Column):
        return bucket
    if bucket == "auto":
        return auto_bucket(df, keys, value, target_rows, min_buckets, stats)
    if isinstance(bucket, int):
        return F.floor(_as_col(value) / F.lit(bucket)).cast("long")
    raise ValueError(f"bucket must be None, 'auto', an int width or a Column, not {bucket!r}")


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list,
    specs: dict[str, tuple[str, object]],
    bucket: Column | None = None,
) -> DataFrame:
    """Add one column per ``specs`` entry ``name -> (kind, column)``.

    kinds: ``prev`` / ``next`` (value of the previous / next row of the key),
    ``max`` / ``sum`` (running, including the row), ``max_before`` /
    ``sum_before`` (over strictly earlier rows). ``order`` must be a total
    order within a key; ``bucket`` must be non-decreasing along it (rows with
    a null order come first, in a bucket of their own).

    The bucketed form also returns its helper columns ``__ck_key`` (the keys
    as one struct, so null keys join exactly with a plain equi-join) and
    ``__ck_bucket``; a following scan over the same keys and buckets reuses
    them and with them the hash partitioning, so it adds no exchange.
    """
    order = [_as_col(o) for o in order]
    for name, (kind, _) in specs.items():
        if kind not in KINDS:
            raise ValueError(f"{name}: unknown scan kind {kind!r}")

    if bucket is None:
        w = _key_window(keys).orderBy(*order)
        return df.select(
            "*",
            *[
                (F.coalesce(e, F.lit(0)) if kind.startswith("sum") else e).alias(n)
                for n, (kind, c) in specs.items()
                for e in [_in_partition(kind, _as_col(c), w)]
            ],
        )

    d = _with_bucket(df, keys, bucket)
    pk = [_K, _B] if keys else [_B]
    w = Window.partitionBy(*pk).orderBy(*order)
    kinds = {k for k, _ in specs.values()}
    extra = []
    if "prev" in kinds:
        extra.append((F.row_number().over(w) == 1).alias(_FIRST))
    if "next" in kinds:
        extra.append(F.lead(F.lit(1)).over(w).isNull().alias(_LAST))
    rows = d.select(
        "*", *extra, *[_in_partition(kind, _as_col(c), w).alias(f"__in_{n}") for n, (kind, c) in specs.items()]
    )

    # Per-bucket summary, partially aggregated before its (small) exchange.
    # Fixed-width buffers keep it a hash aggregate (no sort of the input).
    def summarise(kind: str, c) -> Column:
        col = _as_col(c)
        if kind in ("prev", "next"):
            if isinstance(c, str) and order and str(order[0]) == str(F.col(c)):
                return (F.max if kind == "prev" else F.min)(col)  # value is the leading order column
            return (F.max_by if kind == "prev" else F.min_by)(col, F.struct(*order))
        return (F.max if kind.startswith("max") else F.sum)(col)

    summary = d.groupBy(*pk).agg(*[summarise(kind, c).alias(f"__s_{n}") for n, (kind, c) in specs.items()])
    ws = (Window.partitionBy(_K) if keys else Window.partitionBy()).orderBy(_B)
    earlier = ws.rowsBetween(Window.unboundedPreceding, -1)
    carry_expr = {
        "prev": lambda s: F.lag(s).over(ws),
        "next": lambda s: F.lead(s).over(ws),
        "max": lambda s: F.max(s).over(earlier),
        "max_before": lambda s: F.max(s).over(earlier),
        "sum": lambda s: F.sum(s).over(earlier),
        "sum_before": lambda s: F.sum(s).over(earlier),
    }
    carry = summary.select(*pk, *[carry_expr[kind](F.col(f"__s_{n}")).alias(f"__c_{n}") for n, (kind, _) in specs.items()])
    # Equi-join on exactly the window's partition columns: the row side is
    # already hash-partitioned by them, only the summary side moves.
    joined = rows.join(carry, pk, "inner")

    def combine(n: str, kind: str) -> Column:
        inner, outer = F.col(f"__in_{n}"), F.col(f"__c_{n}")
        if kind == "prev":
            return F.when(F.col(_FIRST), outer).otherwise(inner)
        if kind == "next":
            return F.when(F.col(_LAST), outer).otherwise(inner)
        if kind.startswith("max"):
            return F.greatest(inner, outer)
        return F.coalesce(inner, F.lit(0)) + F.coalesce(outer, F.lit(0))

    keep = [c for c in d.columns]
    return joined.select(*keep, *[combine(n, kind).alias(n) for n, (kind, _) in specs.items()])


def _in_partition(kind: str, c: Column, w) -> Column:
    if kind == "prev":
        return F.lag(c).over(w)
    if kind == "next":
        return F.lead(c).over(w)
    frame = (
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if _RUNNING[kind] == "run"
        else w.rowsBetween(Window.unboundedPreceding, -1)
    )
    return (F.max if kind.startswith("max") else F.sum)(c).over(frame)


def _with_bucket(df: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    d = df if _B in df.columns else df.withColumn(_B, F.coalesce(bucket, F.lit(_LOWEST)))
    return d if not keys or _K in d.columns else d.withColumn(_K, F.struct(*keys))


def session_summary(
    df: DataFrame,
    keys: list[str],
    ts_us: str,
    gap_us: int,
    inclusive_break: bool,
    width_us: int,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Gap sessions at bucket level, from a map-side partial aggregate.

    With buckets ``floor(ts / width)`` and ``width <= gap``, consecutive rows
    inside a bucket are less than ``gap`` apart, so a session can only start
    at a bucket's first row: it does when the previous non-empty bucket of
    the key ended more than ``gap`` earlier (``>=`` if ``inclusive_break``).
    Returns one row per ``(__ck_key, __ck_bucket)`` with ``__first``,
    ``__last``, ``__n`` and ``session_start_us``, and per entry of ``sums``
    the sum of that (non-negative) column over the key's rows before the
    session. The window over buckets holds at most ``span / width`` rows per
    key, however hot the key.
    """
    if width_us > gap_us:
        raise ValueError("session buckets must not be wider than the gap")
    d = _with_bucket(df, keys, F.floor(F.col(ts_us) / F.lit(width_us)).cast("long"))
    pk = [_K, _B] if keys else [_B]
    sums = sums or {}
    s = d.groupBy(*pk).agg(
        F.min(ts_us).alias("__first"), F.max(ts_us).alias("__last"), F.count(F.lit(1)).alias("__n"),
        *[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()],
    )
    w = (Window.partitionBy(_K) if keys else Window.partitionBy()).orderBy(_B)
    diff = F.col("__first") - F.lag("__last").over(w)
    brk = diff >= F.lit(gap_us) if inclusive_break else diff > F.lit(gap_us)
    s = s.withColumn("__starts", F.coalesce(brk, F.lit(True)))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    for n in sums:
        s = s.withColumn(f"__s_{n}", F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0)))
    # Starts and prefix sums never fall along a key, so the latest one is the largest.
    at_start = {"session_start_us": F.col("__first"), **{n: F.col(f"__s_{n}") for n in sums}}
    s = s.select("*", *[F.max(F.when(F.col("__starts"), c)).over(upto).alias(n) for n, c in at_start.items()])
    return s.drop("__starts", *[f"__s_{n}" for n in sums])


def sessionize(
    df: DataFrame,
    keys: list[str],
    ts_us: str,
    seq: str,
    gap_us: int,
    inclusive_break: bool,
    width_us: int | None = None,
    extra: dict[str, tuple[str, object]] | None = None,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Gap sessions per key in ``(ts, seq)`` order.

    Adds ``session_start_us`` and ``is_start`` (the row's time is its
    session's start). A row starts a session when it is the key's first row
    or when ``ts - prev > gap`` (``>=`` if ``inclusive_break``). ``extra``
    are further :func:`ordered_scan` specs over the same order. ``sums`` adds,
    per entry, the sum of a non-negative column over the key's rows before the
    row's session.

    ``width_us=None``: plain windows over the key. Otherwise buckets of
    ``min(width_us, gap)``: sessions come from :func:`session_summary` and
    are joined back on ``(key, bucket)``; the only pass over the rows is the
    one the ``extra`` specs need (same partitioning, no second exchange).
    """
    order = [ts_us, seq]
    if width_us is None:
        before = {f"__before_{n}": ("sum_before", c) for n, c in (sums or {}).items()}
        d = ordered_scan(df, keys, order, {"__prev": ("prev", ts_us), **(extra or {}), **before})
        diff = F.col(ts_us) - F.col("__prev")
        brk = diff >= F.lit(gap_us) if inclusive_break else diff > F.lit(gap_us)
        starts = F.col("__prev").isNull() | brk
        at_start = {"session_start_us": F.col(ts_us), **{n: F.col(f"__before_{n}") for n in sums or {}}}
        d = ordered_scan(d, keys, order, {n: ("max", F.when(starts, c)) for n, c in at_start.items()}).drop("__prev", *before)
    else:
        width = min(width_us, gap_us)
        bucket = F.floor(F.col(ts_us) / F.lit(width)).cast("long")
        d = ordered_scan(df, keys, order, extra, bucket) if extra else _with_bucket(df, keys, bucket)
        summary = session_summary(df, keys, ts_us, gap_us, inclusive_break, width, sums)
        pk = [_K, _B] if keys else [_B]
        d = d.join(summary.select(*pk, "session_start_us", *(sums or {})), pk, "inner")
    return d.withColumn("is_start", F.col(ts_us) == F.col("session_start_us"))
