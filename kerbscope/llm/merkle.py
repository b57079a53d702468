"""Merkle fixity audit of archives that are kept in several copies.

Records of a file have positions.  A leaf is the hash of one position; the node
``n`` of level ``k`` stands for the positions ``n * fanout**k`` up to the next
node and hashes its children in order, so every hash stands for an ordered range
of the file.  Nodes also carry how many bytes they hold.  Two copies are compared
at the roots; only the children of nodes that differ are looked at next, down to
the positions that are damaged, missing or extra.  Byte offsets come from the
sizes of the earlier children along that way, so no file is ever put in order
as a whole and a file with a third of all records is spread like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbscope.staging import stage

#: Children of a node, as a power of two.
FANOUT_BITS = 6


def warc_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows ``file``, ``position``, ``payload``: one WARC response record per page.

    A file holds the pages of one host (empty without a url), in order of the id.
    A null html is a null payload.
    """
    html = F.col("html")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
    )
    host = F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-z]+://([^/]*)", 1)
    plain = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return plain.select(host.alias("file"), F.col("id").cast("long").alias("position"), F.concat(head, html, F.lit("\r\n\r\n")).alias("payload"))


def leaves(records: DataFrame, file_col: str = "file", position_col: str = "position", payload_col: str = "payload") -> DataFrame:
    """Rows ``file``, ``node``, ``hash``, ``bytes``, ``records``: one leaf per file and position.

    The hash is SHA-256 of the payload; a null payload has a hash of its own and no
    bytes.  Several records at one position make one leaf whose hash does not
    depend on their order.  A null file counts as ``""``; records with a null
    position share leaf -1, so damage among them shows but not where.  Positions
    must not be negative.
    """
    payload = F.col("payload")
    rows = records.select(
        F.coalesce(records[file_col].cast("string"), F.lit("")).alias("file"),
        F.coalesce(records[position_col].cast("long"), F.lit(-1)).alias("node"),
        records[payload_col].cast("binary").alias("payload"),
    ).select(
        "file",
        "node",
        F.coalesce(F.sha2(payload, 256), F.sha2(F.lit("no payload").cast("binary"), 256)).alias("hash"),
        F.coalesce(F.octet_length(payload), F.lit(0)).cast("long").alias("bytes"),
    )

    def lane(start: int):
        return F.sum(F.conv(F.substring("hash", start, 15), 16, 10).cast("decimal(20,0)"))

    grouped = rows.groupBy("file", "node").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("hash").alias("least"),
        F.max("hash").alias("most"),
        lane(1).alias("x"),
        lane(16).alias("y"),
        F.sum("bytes").alias("bytes"),
    )
    several = F.sha2(F.concat_ws(":", "records", "least", "most", "x", "y").cast("binary"), 256)
    return grouped.select("file", "node", F.when(F.col("records") == 1, F.col("least")).otherwise(several).alias("hash"), "bytes", "records")


@dataclass(frozen=True)
class Tree:
    """Levels of one copy, leaves first; each a written table."""

    levels: tuple[DataFrame, ...]

    @property
    def roots(self) -> DataFrame:
        return self.levels[-1]


def _parents(level: DataFrame) -> DataFrame:
    """At most ``fanout`` children meet in a row."""
    child = F.struct("node", "hash")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(":", c["node"], c["hash"])), "|")
    return level.groupBy("file", F.shiftright("node", FANOUT_BITS).alias("node")).agg(
        F.sha2(joined.cast("binary"), 256).alias("hash"),
        F.sum("bytes").alias("bytes"),
        F.sum("records").alias("records"),
    )


def build(records: DataFrame, depth: int, **columns: str) -> Tree:
    """Tree of ``depth`` levels above the leaves; no records, an empty tree."""
    levels = [stage(leaves(records, **columns), "leaves")]
    for _ in range(depth):
        levels.append(stage(_parents(levels[-1]), "nodes"))
    return Tree(tuple(levels))


def depth_for(*copies: DataFrame, position_col: str = "position") -> int:
    """Levels that join every position of all copies under one root a file."""
    top = 0
    for copy in copies:
        top = max(top, copy.agg(F.max(copy[position_col].cast("long"))).first()[0] or 0)
    depth = 1
    while top >> (FANOUT_BITS * depth):
        depth += 1
    return depth


def roots(tree: Tree) -> DataFrame:
    """Rows ``file``, ``hash``, ``bytes``, ``records``; a file with unplaced records has two roots."""
    return tree.roots.select("file", "hash", "bytes", "records")


def audit(first: Tree, second: Tree) -> DataFrame:
    """Where two copies differ: ``file``, ``position``, ``kind``, ``offset``, ``bytes``, ``other_bytes``.

    ``kind`` is ``changed``, ``missing`` (not in the second copy) or ``extra`` (only
    there); ``offset`` is where the record starts, or would start, in the first
    copy.  Equal copies, or two empty ones, give no rows.
    """
    spark: SparkSession = first.roots.sparkSession
    apart = spark.createDataFrame([], "file string, node long, offset long")
    for k in range(len(first.levels) - 1, -1, -1):
        left, right = (
            tree.levels[k].select("file", "node", F.col("hash").alias(f"hash_{side}"), F.col("bytes").alias(f"bytes_{side}"))
            for tree, side in ((first, "a"), (second, "b"))
        )
        if k < len(first.levels) - 1:
            up = apart.select("file", F.col("node").alias("up"), F.col("offset").alias("base"))
            left, right = (
                side.withColumn("up", F.shiftright("node", FANOUT_BITS)).join(up, ["file", "up"], "left_semi") for side in (left, right)
            )
            both = left.join(right, ["file", "up", "node"], "full").join(up, ["file", "up"])
            # At most 2 ** FANOUT_BITS children of one node meet in a window.
            before = Window.partitionBy("file", "up").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
            offset = F.col("base") + F.coalesce(F.sum(F.coalesce("bytes_a", F.lit(0))).over(before), F.lit(0))
        else:
            both = left.join(right, ["file", "node"], "full")
            offset = F.lit(0).cast("long")
        both = both.withColumn("offset", offset).where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
        columns = ["file", "node", "offset"] + (["hash_a", "hash_b", "bytes_a", "bytes_b"] if k == 0 else [])
        apart = stage(both.select(*columns), "apart")
    kind = F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra").otherwise("changed")
    return apart.select(
        "file",
        F.col("node").alias("position"),
        kind.alias("kind"),
        "offset",
        F.col("bytes_a").alias("bytes"),
        F.col("bytes_b").alias("other_bytes"),
    )
