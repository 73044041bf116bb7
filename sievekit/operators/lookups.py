"""Lookup joins and walks over a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import shared_dir, stored

#: Rows up to which the side of a lookup is broadcast.
BROADCAST_ROWS = 200_000


def lookup_side(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it is small enough."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def with_settings(rows: DataFrame, settings: DataFrame, by: str) -> DataFrame:
    """rows with the settings of their class (one row a class); rows of a class without
    settings go."""
    return rows.join(lookup_side(settings), by)


def index_credits(credits: DataFrame, extensions: tuple[str, ...] = (".jpg", ".jpeg", ".png")) -> DataFrame:
    """(key, fields): a credits table's rows by each image file that a cell names, under its
    base name and its stem; the row with the smallest ord wins.

    credits: ord and text columns in their order.
    """
    names = [c for c in credits.columns if c != "ord"]
    fields = F.create_map(*[x for c in names for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("")))])
    cells = credits.select("ord", fields.alias("fields")).select("ord", "fields", F.explode(F.map_values("fields")).alias("cell"))
    base = F.lower(F.substring_index(F.replace(F.btrim("cell"), F.lit("\\"), F.lit("/")), "/", -1))
    fits = F.lit(False)
    for e in extensions:
        fits = fits | F.endswith(F.col("base"), F.lit(e))
    keyed = cells.withColumn("base", base).filter(fits).select("ord", "fields", F.explode(F.array("base", F.regexp_replace("base", r"\.[^.]*$", ""))).alias("key"))
    return keyed.groupBy("key").agg(F.min_by("fields", "ord").alias("fields"))


def credit_lookup(files: DataFrame, index: DataFrame, name: Column) -> DataFrame:
    """files with fields: of the row under the base name, else under the stem, else null."""
    base = F.lower(F.substring_index(name, "/", -1))
    rows = files.withColumns({"__base": base, "__stem": F.regexp_replace(base, r"\.[^.]*$", "")})
    side = lookup_side(index)
    by_name = side.select(F.col("key").alias("__base"), F.col("fields").alias("__f1"))
    by_stem = side.select(F.col("key").alias("__stem"), F.col("fields").alias("__f2"))
    return rows.join(by_name, "__base", "left").join(by_stem, "__stem", "left").withColumn("fields", F.coalesce("__f1", "__f2")).select(*files.columns, "fields")


def best_match(rows: DataFrame, name: str, wanted: Column, ord_col: str = "ord") -> DataFrame:
    """One row: whose name equals wanted without case, else the first."""
    exact = (F.lower(F.btrim(F.col(name))) == F.lower(F.btrim(wanted))).cast("int")
    return rows.orderBy(F.desc(exact), F.asc(ord_col)).limit(1)


def walk(edges: DataFrame, roots: DataFrame, max_depth: int = 2) -> DataFrame:
    """(node, depth): nodes reached from roots along edges (src, dst), each at its least
    depth; cycles are no harm. A round joins the new nodes alone."""
    work = shared_dir(edges.sparkSession)
    seen = stored(roots.select(F.col("node"), F.lit(0).alias("depth")).distinct(), f"{work}/0")
    front = seen
    for depth in range(1, max_depth + 1):
        ahead = front.select(F.col("node").alias("src")).join(edges, "src").select(F.col("dst").alias("node")).distinct()
        front = stored(ahead.join(seen.select("node"), "node", "left_anti").select("node", F.lit(depth).alias("depth")), f"{work}/{depth}")
        if front.isEmpty():
            break
        seen = seen.union(front)
    return seen
