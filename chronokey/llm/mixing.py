"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight. Its target is its share of the wanted words, at most
``max_epochs`` times what it holds; what is above goes to the others by weight.
Documents are taken in the order of a hash of their id: whole passes first, then
the documents whose middle lies below what is left. Each source's weight follows
a schedule over training time (multipliers at knots, linear between them). The
schedule is integrated to the source's cumulative token demand, and the demand is
inverted at each taken copy's offset; this gives its training position in [0, 1].

Cases: a null text has size 0, and so does a blank one; documents of size 0 are
never taken. A null source is a source of its own, sorted last. Null ids and
repeated rows each count as documents (ties in the order are broken by the stored
row number). An empty table gives an empty result. Other columns are ignored
(``curriculum`` returns them unchanged).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, saved, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
#: (time, multiplier) knots by place in WEIGHTS: the heaviest sources fade, the lightest grow.
SCHEDULES = (((0.0, 1.4), (0.5, 1.0), (1.0, 0.6)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.4), (0.6, 1.0), (1.0, 1.9)))
#: Hex digits of the hash that cut a source's order into buckets (16 ** BUCKET_DIGITS of them).
BUCKET_DIGITS = 3


def size_of(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def demand(knots: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float, float]]:
    """Segments (t0, w0, slope, share before, share of the segment) of a schedule, normalised to 1."""
    area = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    total, done, out = sum(area), 0.0, []
    for (a, b), s in zip(zip(knots, knots[1:]), area, strict=True):
        slope = (b[1] - a[1]) / (b[0] - a[0])
        out.append((a[0], a[1] / total, slope / total, done, s / total))
        done += s / total
    return out


def position_of(u: Column, place: Column, schedules) -> Column:
    """Time at which the integrated schedule of ``place`` reaches the share ``u``."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        segs = demand(knots)
        for j, (t0, w0, slope, before, _) in reversed(list(enumerate(segs))):
            d = u - F.lit(before)
            # d = w0 x + slope x^2 / 2, solved for x in the form that also holds for slope 0
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * d, F.lit(0.0)))
            x = F.lit(t0) + F.lit(2.0) * d / (F.lit(w0) + root)
            at = (place == k) & ((u >= before) if j else F.lit(True))
            out = F.when(at & ((u < segs[j + 1][3]) if j + 1 < len(segs) else F.lit(True)), x).otherwise(out)
    return F.least(out, F.lit(1.0))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, place, target): the capped shares, one row per source.

    ``sizes`` has a row per source. Sources are capped in the order of cap / weight;
    the level is that of the first source whose cap is not below it.
    """
    by_rank = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("ratio", "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    t = (sizes.withColumn("rank", F.row_number().over(by_rank) - 1)
         .withColumn("place", F.col("rank") % len(weights))
         .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
         .withColumn("ratio", F.col("cap") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("weight_sum", F.sum("weight").over(everything))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.col("weight_sum") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
         .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level")))
                     .over(everything)["level"]))
    return t.select("source", "source_size", "place",
                    F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, schedules=SCHEDULES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, positions."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       size_of(F.col(text_col)).alias("size"), F.monotonically_increasing_id().alias("rid"))
    rows = saved(rows.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
                 .withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS)), "sizes")
    # Prefix sums in two levels: buckets of a source (few rows each), then rows inside a bucket.
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    carry = (buckets.withColumn("before", F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket"))
                                - F.col("bucket_size")).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before"))
    per_source = targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, max_epochs)
    per_source = per_source.select(F.col("source").alias("s"), "source_size", "place", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "rid")
    r = rows.withColumn("inner", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    r = r.join(carry, r.source.eqNullSafe(carry.s) & (r.bucket == carry.b)).drop("s", "b")
    r = r.join(per_source, r.source.eqNullSafe(per_source.s)).drop("s")
    full = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    r = (r.withColumn("at", F.col("before") + F.col("inner")).withColumn("full", full)
         .withColumn("left", F.col("target") - F.col("full") * F.col("source_size"))
         .withColumn("more", ((2 * F.col("at") + F.col("size")) <= 2 * F.col("left")) & (F.col("left") > 0))
         .withColumn("copies", F.when(F.col("size") == 0, 0).otherwise(F.col("full") + F.col("more").cast("long")))
         .withColumn("taken", (F.col("copies") * F.col("size")).cast("long")))
    middle = F.col("at") + F.col("size") / 2
    copy = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)
    positions = F.when(F.col("copies") > 0, F.transform(copy, lambda j: position_of(
        (j * F.col("source_size") + middle) / F.greatest(F.col("target"), F.col("taken")), F.col("place"), schedules))
    ).otherwise(F.array().cast("array<double>"))
    return r.select("doc_id", "source", "size", "source_size", "target",
                    F.col("copies").cast("long").alias("copies"), "taken", positions.alias("positions"))


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """The training order: each taken copy of a document as a row of ``docs``, range-sorted by position.

    Decisions meet the documents by id, source and size. Rows that share all three
    deal out the copies of the whole lot among themselves in turn.
    """
    plan = mix(docs, id_col, text_col, source_col, **options)
    plan = saved(plan.groupBy(F.col("doc_id").alias("id"), F.col("source").alias("src"), F.col("size").alias("n")).agg(
        F.flatten(F.sort_array(F.collect_list("positions"))).alias("positions"), F.count("*").alias("same"))
        .filter(F.size("positions") > 0), "plan")
    rows = packed(docs)
    rows = rows.withColumn("n", size_of(F.col(f"row.{text_col}")))
    out = rows.join(plan.withColumnRenamed("n", "plan_n"), rows.row[id_col].eqNullSafe(plan.id)
                    & rows.row[source_col].eqNullSafe(plan.src) & (rows.n == F.col("plan_n")))
    if not plan.filter("same > 1").isEmpty():
        turn = F.row_number().over(Window.partitionBy("id", "src", "plan_n").orderBy("n")) - 1
        out = out.withColumn("turn", turn)
        out = out.withColumn("positions", F.filter("positions", lambda p, i: i % F.col("same") == F.col("turn")))
    return out.select("row", F.explode("positions").alias("position")).orderBy("position").select("row.*")
