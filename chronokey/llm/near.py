"""Near-duplicate links between documents: MinHash bands, pruning, exact Jaccard, classes.

Texts with the same shingle set are one class from the start. Bands of the classes'
signatures are joined in Spark:

1. In each bucket every class is paired with the bucket's hub (the member with the
   largest buckets over all bands), so pairs grow with the rows, not their squares.
2. Pairs that survive ``prune`` (signatures only) are verified on the exact sets.
3. Links found give components. Buckets that still hold several components are
   compared by blocks of members inside tasks, so that a link between members that
   both differ from the hub isn't lost. Pairs across components that survive the
   signatures are verified there; the links that join components leave the task.
4. Two classes that are alike are in one component. All pairs inside a component are
   counted on the exact sets, by blocks of members inside tasks; what leaves a task is
   a number of links per member.

A block meets every other block of its bucket or component, so a member's compressed text
is moved once for each of them: what moves in 3 and 4 grows with the square of a very large
group, by a factor of its members / 1,024 and members / 256.

What is lost is what no band or the pruning finds; see the callers for figures.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import saved, small, text_or_empty
from .components import components

#: Members of a block of the comparison inside buckets, and of the count of links inside components.
BLOCK = 1024
COUNT_BLOCK = 256


def shingle_keys(texts: DataFrame) -> DataFrame:
    """(doc_id, th, skey): the 128-bit key of each text's shingle set; ``th`` is the MD5 of the text."""
    kind = dict(texts.dtypes)["doc_id"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            sets = shingles.shingle_sets(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(map(shingles.set_key, sets), pa.binary())], ["doc_id", "th", "skey"])

    return texts.select("doc_id", F.md5(F.col("t").cast("binary")).alias("th"), "t").mapInArrow(run, f"doc_id {kind}, th string, skey binary")


def signed(texts: DataFrame, n: int) -> DataFrame:
    """(skey, n_sh, sig): shingle key, number of shingles and signature of each text that has shingles."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 256):
                sets = [s for s in shingles.shingle_sets(b.column(0).slice(at, 256).to_pylist()) if len(s)]
                sig = shingles.signatures(sets, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(shingles.set_key, sets), pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([x.tobytes() for x in sig], pa.binary())], ["skey", "n_sh", "sig"])

    return texts.select("t").mapInArrow(run, "skey binary, n_sh int, sig binary")


def packed_texts(texts: DataFrame) -> DataFrame:
    """(skey, z): compressed texts under their shingle key."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            part = b.column(0).to_pylist()
            keys = [shingles.set_key(s) for s in shingles.shingle_sets(part)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([press.compress(t.encode()) for t in part], pa.binary())], ["skey", "z"])

    return texts.select("t").mapInArrow(run, "skey binary, z binary")


def verified(pairs: DataFrame, bodies: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(a, b, jaccard) of the pairs whose shingle sets are alike. ``bodies``: (cid, z)."""
    left = bodies.select(F.col("cid").alias("a"), F.col("z").alias("za"))
    right = bodies.select(F.col("cid").alias("b"), F.col("z").alias("zb"))
    rows = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "za", "zb")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        held: dict = {}

        def sets(keys: list, blobs: list) -> list:
            new = {k: z for k, z in zip(keys, blobs, strict=True) if k not in held}
            held.update(zip(new, shingles.shingle_sets([unpack(z).decode() for z in new.values()]), strict=True))
            return [held[k] for k in keys]

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                a, b, za, zb = (c.to_pylist() for c in batch.slice(at, 256).columns)
                out = [(x, y, *shingles.alike(s, t, numerator, denominator))
                       for x, y, s, t in zip(a, b, sets(a, za), sets(b, zb), strict=True)]
                if len(held) > 2000:
                    held.clear()
                out = [(x, y, c / u) for x, y, c, u, ok in out if ok]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                                  pa.array([r[2] for r in out], pa.float64())], ["a", "b", "jaccard"])

    return rows.mapInArrow(run, "a long, b long, jaccard double")


def block_links(members: DataFrame, n: int, rows_per_band: int, keep: Callable, numerator: int, denominator: int) -> DataFrame:
    """(a, b, jaccard): verified links between members (bh, size, cid, comp, n_sh, sig, z) of a bucket that have
    no component in common, as many as it takes to join them (fewer than there are members).

    A pair is looked at once, in the first band that it shares.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = (members.withColumn("nb", blocks).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select(F.xxhash64("bh", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
                    (F.col("own") > F.col("other")).alias("second"), (F.col("own") == F.col("other")).alias("same"),
                    "cid", "comp", "n_sh", "sig", "z"))
    rows = rows.repartition(F.col("cell")).sortWithinPartitions("cell")

    def links_of(table) -> list[tuple[int, int, float]]:
        import numpy as np
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        cid, comp, size, second, same = (table.column(c).to_numpy() for c in ("cid", "comp", "n_sh", "second", "same"))
        inside, z = bool(same.all()), table.column("z")
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(cid), n)
        bands = sig.reshape(len(cid), -1, rows_per_band)
        # The bucket's band is the first that all members share.
        band = int(np.argmax((bands == bands[:1]).all(axis=(0, 2))))
        root: dict[int, int] = {}
        sets: dict[int, np.ndarray] = {}

        def top(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        def shingle_set(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles.shingle_sets([unpack(z[i].as_py()).decode()])[0]
            return sets[i]

        out = []
        later = np.flatnonzero(second)
        for i in (range(len(cid)) if inside else np.flatnonzero(~second).tolist()):
            js = np.arange(i + 1, len(cid)) if inside else later
            js = js[(comp[js] != comp[i]) & (np.minimum(size[js], size[i]) * denominator >= numerator * np.maximum(size[js], size[i]))]
            js = js[keep(sig[i][None, :], sig[js])] if len(js) else js
            if len(js):
                js = js[np.argmax((bands[js] == bands[i]).all(axis=2), axis=1) == band]
            for j in js.tolist():
                a, b = top(int(comp[i])), top(int(comp[j]))
                if a != b:
                    common, union, ok = shingles.alike(shingle_set(i), shingle_set(j), numerator, denominator)
                    if ok:
                        root[max(a, b)] = min(a, b)
                        out.append((int(min(cid[i], cid[j])), int(max(cid[i], cid[j])), common / union))
        return out

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from .common import runs

        for _, table in runs(batches, "cell"):
            out = links_of(table)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                                  pa.array([r[2] for r in out], pa.float64())], ["a", "b", "jaccard"])

    return rows.mapInArrow(run, "a long, b long, jaccard double")


def link_counts(groups: DataFrame, bodies: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(cid, n_links): to how many other classes of its component each class of ``groups`` (cid, component) is alike."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    rows = (groups.join(sizes, "component").join(bodies, "cid")
            .withColumn("nb", F.ceil(F.col("size") / COUNT_BLOCK).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                    (F.col("own") > F.col("other")).alias("second"), "cid", "z"))
    cell = F.xxhash64("component", "lo", "hi")
    rows = rows.withColumn("cell", cell).repartition(F.col("cell")).sortWithinPartitions("cell", "component", "lo", "hi")

    def counts(table) -> tuple:
        import numpy as np
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        second = table.column("second").to_numpy()
        sets = shingles.shingle_sets([unpack(z).decode() for z in table.column("z").to_pylist()])
        inside = table.column("lo")[0] == table.column("hi")[0]
        here = np.arange(len(sets)) if inside else np.flatnonzero(~second)
        there = here if inside else np.flatnonzero(second)
        found = np.zeros(len(sets), np.int64)
        if len(here) and len(there):
            size = np.array([len(s) for s in sets])
            known, flat = np.unique(np.concatenate([sets[j] for j in there]), return_inverse=True)
            first = np.cumsum(size[there]) - size[there]
            mark = np.zeros(len(known), np.int32)
            for n, i in enumerate(here.tolist()):
                at = np.searchsorted(known, sets[i])
                at = at[at < len(known)] if inside else at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == sets[i])]
                mark[at] = 1
                common = np.add.reduceat(mark[flat], first)
                mark[at] = 0
                alike = common * denominator >= numerator * (size[i] + size[there] - common)
                if inside:
                    alike[n] = False
                    found[i] = alike.sum()
                else:
                    found[i] += alike.sum()
                    found[there] += alike
        return table.column("cid").to_numpy(), found

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .common import runs

        for _, table in runs(batches, "cell"):
            component, lo, hi = (table.column(c).to_numpy() for c in ("component", "lo", "hi"))
            cuts = np.flatnonzero((component[1:] != component[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            for s, e in zip([0, *cuts], [*cuts, len(lo)], strict=True):
                cid, n = counts(table.slice(s, e - s))
                yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(n)], ["cid", "n"])

    return rows.mapInArrow(run, "cid long, n long").groupBy("cid").agg(F.sum("n").alias("n_links"))


def near_links(texts: DataFrame, rows_per_band: int, bands: int, keep: Callable, numerator: int = 4,
               denominator: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, links, groups): classes (skey, cid, copies), links (a, b, jaccard) of class ids that join the
    components, and the component (cid, component) of each class that has links.
    """
    return joined_classes(texts, rows_per_band, bands, keep, numerator, denominator)[:3]


def joined_classes(texts: DataFrame, rows_per_band: int, bands: int, keep: Callable, numerator: int,
                   denominator: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``near_links``, and the bodies (cid, z) of the classes in shared buckets.

    ``keep(left, right)`` gets signatures (one row, or as many as right) and returns the
    mask of pairs that may reach the threshold.
    """
    n, ratio = rows_per_band * bands, numerator / denominator
    classes = saved(signed(texts, n).groupBy("skey").agg(
        F.first("n_sh").alias("n_sh"), F.first("sig").alias("sig"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    width = 2 * rows_per_band
    hashes = F.array(*[F.xxhash64(F.substring("sig", 1 + width * i, width), F.lit(i)) for i in range(bands)])
    buckets = classes.select("cid", F.explode(hashes).alias("bh"))
    sizes = buckets.groupBy("bh").agg(F.count("*").alias("size")).filter("size > 1")
    members = saved(buckets.join(sizes, "bh"), "members")
    involved = classes.join(small(members.select("cid").distinct()), "cid", "left_semi").select("cid", "skey", "n_sh", "sig")
    involved = saved(involved, "involved")
    # Texts of the classes in shared buckets, one each.
    keys = small(involved.select("skey", "cid"))
    bodies = saved(packed_texts(texts).join(keys, "skey").groupBy("cid").agg(F.first("z").alias("z")), "bodies")

    central = members.groupBy("cid").agg(F.sum("size").alias("weight"))
    ranked = members.join(central, "cid")
    hubs = ranked.groupBy("bh").agg(F.max(F.struct("weight", (-F.col("cid")).alias("c"))).alias("top"))
    hubs = hubs.select("bh", (-F.col("top.c")).alias("hub"))
    stars = (members.join(hubs, "bh").filter("cid != hub")
             .select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct())
    left = involved.select(F.col("cid").alias("a"), F.col("n_sh").alias("na"), F.col("sig").alias("sa"))
    right = involved.select(F.col("cid").alias("b"), F.col("n_sh").alias("nb"), F.col("sig").alias("sb"))
    alike_size = F.least("na", "nb") >= ratio * F.greatest("na", "nb")
    compared = stars.join(right, "b").join(left, "a").filter(alike_size).select("a", "b", "sa", "sb")

    def prune(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, n) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep(x, y))) for c in b.columns[:2]], ["a", "b"])

    links = saved(verified(compared.mapInArrow(prune, "a long, b long"), bodies, numerator, denominator), "links")
    found = components(links).withColumnRenamed("id", "cid")
    placed = (members.filter("size > 2").join(found, "cid", "left")
              .withColumn("comp", F.coalesce("component", "cid")).select("bh", "size", "cid", "comp"))
    mixed = placed.groupBy("bh").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("bh")
    rest = placed.join(mixed, "bh").join(involved.select("cid", "n_sh", "sig"), "cid").join(bodies, "cid")
    more = saved(block_links(rest, n, rows_per_band, keep, numerator, denominator).dropDuplicates(["a", "b"]), "more")
    classes = classes.select("skey", "cid", "copies")
    if more.isEmpty():
        return classes, links, found, bodies
    # The new links join components: only their contracted graph is walked.
    at = lambda c: found.select(F.col("cid").alias(c), F.col("component").alias(f"{c}_comp"))
    joined = more.join(at("a"), "a", "left").join(at("b"), "b", "left").select(
        F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b"))
    merged = saved(components(joined).select(F.col("id").alias("component"), F.col("component").alias("top")), "merged")
    alone = merged.select(F.col("component").alias("cid"), "component").join(found, "cid", "left_anti")
    groups = found.unionByName(alone).join(merged, "component", "left").select("cid", F.coalesce("top", "component").alias("component"))
    return classes, links.unionByName(more).dropDuplicates(["a", "b"]), groups, bodies


def near_classes(docs: DataFrame, rows_per_band: int, bands: int, keep: Callable, id_col: str = "doc_id",
                 text_col: str = "text", numerator: int = 4, denominator: int = 5) -> DataFrame:
    """One row per document: doc_id, th, class_id, class_size, n_copies, n_links, first.

    ``n_links`` is the number of other shingle sets of the class that are alike to the document's own.
    ``class_id`` is the smallest id of the class (nulls last), ``first`` marks its row (with
    several of that id, the smallest text hash; repeated rows are marked together).
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    keys = saved(shingle_keys(texts), "keys")
    classes, _, found, bodies = joined_classes(texts, rows_per_band, bands, keep, numerator, denominator)
    found = saved(found, "components")
    ends = link_counts(found, bodies, numerator, denominator)
    plan = (classes.join(found, "cid", "left").join(ends, "cid", "left")
            .select("skey", F.coalesce("component", "cid").alias("component"), "copies", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    # Texts without shingles have no class row: all of them are copies of each other.
    rows = keys.join(plan, "skey", "left").select(
        "doc_id", "th", F.coalesce("component", F.lit(-1)).alias("component"), "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("best")
    rows = saved(rows, "rows")
    # A written table, so that the join has two plain exchanges and the rows of a very large class can be split.
    groups = saved(rows.groupBy("component").agg(best, F.count("*").alias("class_size")), "groups")
    return rows.join(groups, "component").select(
        "doc_id", "th", F.col("best.doc_id").alias("class_id"), "class_size",
        F.coalesce("copies", "class_size").alias("n_copies"), "n_links",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))).alias("first"))
