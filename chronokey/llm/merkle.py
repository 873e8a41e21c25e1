"""A Merkle manifest of a table: a leaf for each row, a tree for each source, a tree over the sources.

Trees are rolled up by nested structs. A row's rank in its source, written in digits of the
fan-out, is its way through the tree: grouping the last digit away makes the node above
from at most ``FAN`` children, which it keeps nested in it, and so on digit by digit.

* Ranks come from a range sort with counts per sorted run, so a source that holds most of
  the rows is spread over many tasks.
* Digits are grouped away within *blocks* of ``FAN ** DEPTH`` consecutive nodes. Rows are
  dealt by (group, block) once; every grouping of the digits keeps that partitioning, so it
  moves nothing. A block's nested struct holds at most that many leaves, of about 100 bytes.
* The tops of the blocks are the leaves of the next round, with ``DEPTH`` digits less, until
  each group has one node. Tables get smaller by ``FAN ** DEPTH`` each round.
* Proofs go down the same way: a block's nested struct and the path above its top meet in
  one grouping by (group, block), and a transform through the nested children with a final
  explode gives each child its siblings on the way. No join is needed.

Texts are read once and only hashed; what moves is 32-byte digests. Every round is written to
the shared folder.

Rules: a null field is hashed as ``-``. Leaves of one source ascend by doc_id (null first);
rows that repeat an id ascend by leaf. A null source is a source of its own. A row without
an id is not tampered with. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small

# ---- fixed values: the format of the manifest ----
FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# ---- end of fixed values ----

#: Digits that are grouped away in one round: blocks of 3 ** 6 = 729 nodes.
DEPTH = 6

#: Rows of digests in a task of the range sort.
SORT_ROWS = 200_000

_PATH = "array<struct<left:array<binary>,right:array<binary>>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _h(text: Column) -> Column:
    """Digest of a string, as bytes."""
    return F.unhex(F.sha2(text, 256))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: per field ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    return _h(F.concat(*[
        F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
        for c in fields.values()]))


def leaves(docs: DataFrame, tamper: bool = True) -> DataFrame:
    """g (struct of source), doc_id, h (leaf), t (leaf of the tampered row; null where the row is not tampered with)."""
    fields = {c: F.col(c) for c in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = leaf({**fields, "text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})
    return docs.select(F.struct("source").alias("g"), "doc_id", leaf(fields).alias("h"),
                       F.when(hit, changed).alias("t") if tamper else F.lit(None).cast("binary").alias("t"))


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with r, the rank in the group ``g`` by ``order``, and n, the rows of the group.

    Rows are range-sorted; a row's rank is its place in its sorted run plus the rows that
    the group has in earlier partitions.
    """
    rows = nodes.count()
    placed = nodes.repartitionByRange(max(1, -(-rows // SORT_ROWS)), "g", *order).sortWithinPartitions("g", *order)
    # This id is the partition's number and the place in it; it stands once it is written.
    placed = saved(placed.withColumn("id", F.monotonically_increasing_id()), "sorted")
    place = (F.col("id") % F.lit(1 << 33)).alias("at")
    part = F.shiftright("id", 33).alias("part")
    placed = placed.select("*", place, part).drop("id")
    runs = placed.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    group = Window.partitionBy("g")
    before = F.sum("held").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(group).alias("n"))
    return placed.join(small(runs), ["g", "part"]).withColumn("r", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _rolled(nodes: DataFrame, depth: int) -> DataFrame:
    """One row for each block of ``nodes`` (g, n, r, leaf): g, n, block, top (nested), left nodes of the group in m.

    A group of fewer nodes than a block is complete after fewer levels; the levels above pass its node on.
    """
    digit = lambda k: F.floor(F.col("r") / F.lit(FAN**k)) % F.lit(FAN)
    now = nodes.select("g", "n", F.floor(F.col("r") / F.lit(FAN**depth)).alias("block"),
                       *[digit(k).alias(f"d{k}") for k in range(depth)], F.col("leaf").alias("node")).repartition("g", "n", "block")
    for k in range(depth):
        keys = ["g", "n", "block", *[f"d{j}" for j in range(k + 1, depth)]]
        children = F.transform(F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("d"), "node"))), lambda c: c["node"])
        now = now.groupBy(*keys).agg(children.alias("kids"))
        alone = F.col("n") <= FAN**k  # the group has one node here
        h = F.when(alone, F.col("kids")[0]["h"]).otherwise(_h(_joined(F.transform("kids", lambda c: c["h"]))))
        now = now.select(*keys, F.struct(h.alias("h"), F.col("kids")).alias("node"))
    return now.select("g", "n", "block", F.col("node").alias("top"))


def _down(blocks: DataFrame, paths: DataFrame, depth: int) -> DataFrame:
    """g, r, leaf, path, top, root of each leaf of ``blocks``; ``paths`` (g, r, path, top, root) has the way above each block."""
    both = blocks.select("g", "block", "n", F.col("top").alias("node"), F.lit(None).cast(_PATH).alias("path"),
                         F.lit(None).cast("binary").alias("top"), F.lit(None).cast("binary").alias("root")).unionByName(
        paths.select("g", F.col("r").alias("block"), F.lit(None).cast("long").alias("n"), F.lit(None).cast(blocks.schema["top"].dataType).alias("node"),
                     "path", "top", "root"))
    met = both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "top", "root")])

    def walk(node: Column, level: int, path: Column, at: Column) -> Column:
        """The leaves below a node of this level (depth: the block's top), each with its path from the leaf up."""
        def child(c: Column, i: Column) -> Column:
            hashes = F.transform(node["kids"], lambda x: x["h"])
            step = F.array(F.struct(F.slice(hashes, F.lit(1), i).alias("left"), F.slice(hashes, i + 2, F.lit(FAN)).alias("right")))
            # A group with one node here has no level here.
            way = F.concat(F.when(F.col("n") > FAN ** (level - 1), step).otherwise(F.array().cast(_PATH)), path)
            place = at * FAN + i
            return F.array(F.struct(place.alias("r"), c.alias("leaf"), way.alias("path"))) if level == 1 else walk(c, level - 1, way, place)

        return F.flatten(F.transform(node["kids"], child))

    found = met.select("g", "top", "root", F.explode(walk(F.col("node"), depth, F.col("path"), F.col("block").cast("long"))).alias("x"))
    return found.select("g", "top", "root", "x.*")


def forest(nodes: DataFrame, tops, depth: int = DEPTH) -> DataFrame:
    """Proofs of the trees of ``nodes`` (g, n, r, leaf: a struct with digest h), one tree for each g.

    ``tops`` takes the trees' last nodes (g, h) and gives (g, r = 0, path, top, root): the way
    above them. Returns g, r, leaf, path (from the leaf up), top and root.
    """
    rounds = []
    while True:
        blocks = saved(_rolled(nodes, depth), "blocks")
        rounds.append(blocks)
        left = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / F.lit(FAN**depth)).cast("long"))
        nodes = blocks.select("g", left.alias("n"), F.col("block").alias("r"), F.struct(F.col("top.h").alias("h")).alias("leaf"))
        if nodes.filter("n > 1").isEmpty():
            break
    paths = tops(nodes.select("g", F.col("leaf.h").alias("h")))
    for blocks in reversed(rounds):
        paths = _down(blocks, paths, depth)
    return paths


def _over_sources(subroots: DataFrame) -> DataFrame:
    """The tree over the sources' roots; its proofs are the ways above them."""
    nodes = ranked(subroots.select(F.struct(F.lit(0).alias("all")).alias("g"), F.col("g").alias("source"), "h"), ["source"])
    nodes = nodes.select("g", "n", "r", F.struct("h", "source").alias("leaf"))
    empty = F.array().cast(_PATH)
    proofs = forest(nodes, lambda t: t.select("g", F.lit(0).cast("long").alias("r"), empty.alias("path"), F.col("h").alias("top"), F.col("h").alias("root")))
    return proofs.select(F.col("leaf.source").alias("g"), F.lit(0).cast("long").alias("r"), "path", F.col("leaf.h").alias("top"), "root")


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, tampered (leaf of the tampered row or null), path, subroot, root (digests as bytes) for each row.

    ``path`` lists the levels from the leaf to the root; of each, the digests left and right of the node in its run.
    """
    rows = ranked(saved(leaves(docs), "leaves"), ["doc_id", "h"])
    nodes = rows.select("g", "n", "r", F.struct("h", "t", "doc_id").alias("leaf"))
    return forest(nodes, _over_sources).select(
        F.col("leaf.doc_id").alias("doc_id"), F.col("leaf.h").alias("leaf"), F.col("leaf.t").alias("tampered"), "path",
        F.col("top").alias("subroot"), "root")


def folded(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf_digest, lambda h, p: _h(_joined(F.concat(p["left"], F.array(h), p["right"]))))


def manifest(docs: DataFrame) -> DataFrame:
    """The proofs, each digested, and checked against the tampered rows."""
    p = proofs(docs).withColumn("again", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    siblings = F.flatten(F.transform("path", lambda x: F.concat(x["left"], x["right"])))
    return p.select("doc_id", *[_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                    F.sha2(_joined(siblings), 256).alias("proof_sha256"), _hex(F.col("again")).alias("folded_root"),
                    (F.col("again") == F.col("root")).alias("verified"))
