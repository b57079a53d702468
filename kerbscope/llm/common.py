"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbscope.llm.arrays import release
from kerbscope.staging import scratch, stage

#: ASCII white space, the only separators of words here.
WORD_BREAKS = "\\x20\\x09-\\x0D"
#: Rows of a value that are looked at beyond twice the wanted ones.
SPARE = 1000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def crc_fold(id_column: str, folds: int):
    """crc32 of the id written as text, modulo ``folds``; null ids give null."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % F.lit(folds)


def map_text(
    docs: DataFrame,
    text_col: str,
    keep: list[str],
    fields: str,
    function: Callable[[list[str | None]], list[pa.Array]],
) -> DataFrame:
    """Columns ``keep`` of ``docs``, then the ``fields`` that ``function`` makes of the texts.

    Only the texts go to Python and only the fields come back; no shuffle, and rows
    go through one for one.  A kept column named like a new field is replaced by it.
    """
    made = [field.split()[0] for field in fields.split(", ")]

    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for k in range(0, len(texts), 512):
            arrays = function(texts.slice(k, 512).to_pylist())
            parts.append(pa.StructArray.from_arrays(arrays, names=made))
        whole = pa.concat_arrays(parts)
        del parts
        release()
        return whole

    kind = ", ".join("{}: {}".format(*field.split()) for field in fields.split(", "))
    # Declared not deterministic so that no plan evaluates it twice for a row.
    column = F.arrow_udf(run, f"struct<{kind}>").asNondeterministic()(docs[text_col])
    source = docs.select(*[docs[name] for name in keep if name not in made], column.alias("_made"))
    return source.select(*[name for name in keep if name not in made], *[F.col("_made").getField(name).alias(name) for name in made])


def sample_ids(rows: DataFrame, id_col: str, by: str, per_value: int) -> DataFrame:
    """At most ``per_value`` ids of each non-null value of ``by``: rows ``id``, ``value``.

    They are the first by a hash of the id, so the choice does not depend on the
    order of the rows.  Of a value with many rows only the part of the hashes goes on
    that holds about twice as many as are wanted, and ``SPARE`` more; so few rows of
    any value are brought together.
    """
    known = rows.select(rows[id_col].alias("id"), rows[by].alias("value")).where("id is not null and value is not null")
    sizes = stage(known.groupBy("value").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    known = known.withColumn("hash", F.xxhash64("id")).join(sizes, "value")
    place = F.col("hash").cast("double") / F.lit(2.0**64) + 0.5
    early = known.where(place * F.col("rows") <= 2 * per_value + SPARE)
    order = Window.partitionBy("value").orderBy("hash", "id")
    return early.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_value).select("id", "value")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``a``, ``b`` (long): rows ``node``, ``component``.

    ``component`` is the smallest node of its component.  Each round maps every
    node to its neighbour of least random priority (or itself) and contracts the
    links, which leaves a constant fraction of the nodes whatever the shape; no
    list of neighbours is ever gathered.  Rounds are written to the shared folder.
    Null ends and links to itself are dropped.  No links: an empty table.
    """
    with scratch(edges.sparkSession):
        links = stage(
            edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a is not null and b is not null and a < b")
            .distinct(),
            "links",
        )
        whole = None
        step = 0
        while whole is None or not links.isEmpty():
            step += 1
            both = links.select("a", "b").union(links.select("b", "a"))
            best = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", F.lit(step)).alias("p"), "b")).alias("m"))
            own = F.xxhash64("a", F.lit(step))
            to = stage(
                best.select(F.col("a").alias("node"), F.when(own <= F.col("m.p"), F.col("a")).otherwise(F.col("m.b")).alias("to")),
                "merges",
            )
            if whole is None:
                whole = to
            else:
                moved = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
                whole = whole.join(moved, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
            left = to.select(F.col("node").alias("a"), F.col("to").alias("ra"))
            right = to.select(F.col("node").alias("b"), F.col("to").alias("rb"))
            links = stage(
                links.join(left, "a")
                .join(right, "b")
                .where("ra <> rb")
                .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                .distinct(),
                "links",
            )
        whole = stage(whole, "members", result=True)
        least = stage(whole.groupBy("to").agg(F.min("node").alias("component")), "least", result=True)
    return whole.join(least, "to").select("node", "component")
