"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

A source's target is its weight's share of the budget, stopped at ``max_repeat``
times its size; the excess goes to the other sources by weight.  Within a source
each document expects ``target / source size`` copies; the running sum of those
expectations plus one random offset is cut at the integers, and a document is
emitted once for each integer it crosses.

The running sum is made in three levels: inside hash buckets of about ``bucket_rows``
documents, ordered by size so that every size is drawn at the same rate, over the
buckets of a stretch, and over stretches.  No task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import written

#: Words are runs outside the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def _unit(text: Column) -> Column:
    """A number in [0, 1) from the text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def _comparable(kind: T.DataType) -> bool:
    """Whether values of a type can be hashed; maps and variants can't."""
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _row_digest(docs: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of all columns, so that only rows equal in all of them tie."""
    parts = [F.col(f"`{f.name}`") if _comparable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in docs.schema]
    parts += [F.isnull(p) for p in parts]  # a null leaves a hash as it is
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def _running(rows: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``rows`` in ranges of one order, with exclusive running sums over all of them.

    Ranges are written, so that one cut holds for the sums inside a range and over the
    ranges; no window holds more than a range or a row per range.
    """
    ranged = rows.repartitionByRange(*order).withColumns({**{f"_{n}": c for n, c in sums.items()}, "_part": F.spark_partition_id()})
    ranged = written(ranged, name)
    totals = ranged.groupBy("_part").agg(*[F.sum(f"_{n}").alias(f"_all_{n}") for n in sums])
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", *[F.coalesce(F.sum(f"_all_{n}").over(over), F.lit(0)).alias(f"_base_{n}") for n in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.join(totals, "_part")
    found = found.withColumns({n: F.col(f"_base_{n}") + F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)) for n in sums})
    return found.drop("_part", *[f"_{n}" for n in sums], *[f"_base_{n}" for n in sums])


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """(source, n_docs, source_size, target) from rows of (source, size).

    Sources stand by code point, null last, and take ``weights`` in turn.  Ordered
    by limit over weight, those that stop at their limit come first, so one pass of
    running sums finds the level that the others share.  Running sums go over ranges
    of sources, so sources may be as many as hosts.  No rows give no rows.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = _running(per, [F.col("source").asc_nulls_last()], {"place": F.lit(1)}, "sources")
    per = per.withColumn("weight", F.element_at(listed, (F.col("place") % len(weights) + 1).cast("int"))).drop("place")
    per = per.withColumn("most", F.col("source_size") * F.lit(float(max_repeat)))
    order = [(F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    # sums of words are exact as decimals, so they don't depend on how sources are dealt
    exact = "decimal(38,6)"
    per = _running(per, order, {"place": F.lit(1), "before": F.col("most").cast(exact), "lighter": F.col("weight").cast(exact)}, "levels")
    whole = per.agg(F.sum("source_size").alias("size"), F.sum(F.col("weight").cast(exact)).alias("weight")).first()
    level = (F.lit(whole["size"]) * F.lit(float(budget)) - F.col("before").cast("double")) / (F.lit(whole["weight"]) - F.col("lighter")).cast("double")
    per = per.withColumn("level", level).withColumn("free", F.col("most") > F.col("level") * F.col("weight"))
    shared = per.filter("free").agg(F.min(F.struct("place", "level"))["level"].alias("level")).first()["level"]
    target = F.when(F.col("free"), F.lit(shared) * F.col("weight")).otherwise(F.col("most"))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def with_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    budget: float = 1.5,
    max_repeat: float = 2.0,
    bucket_rows: int = 2000,
    seed: int = 7,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Size counts words; a null or empty text has 0 and is drawn at its source's rate
    like any other.  A null source is a source of its own.  Repeated rows and equal
    keys are drawn each; rows of equal size and key stand by a digest of all their
    columns, so it can only be open which of wholly equal rows is taken.  An empty
    table gives an empty table.  Columns of ``docs`` that clash with a result column
    are replaced.  The same rows give the same result for any partitioning.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    docs = docs.drop(*added)
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    # the columns of docs are packed, so none of their names can clash
    # buckets go by key and text, so that rows without a key, or of one key, are spread
    drawn = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    drawn = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long").alias("drawn")
    slim = written(docs.select(F.col(source).alias("source"), words, drawn), "sizes")
    one, two = _row_digest(docs)
    full = docs.select(F.col(key).alias("k"), F.col(source).alias("source"), words, drawn, one.alias("d1"), two.alias("d2"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    per = source_targets(slim.select("source", "size"), weights, budget, max_repeat)
    per = per.select(
        F.col("source").alias("of"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        F.ceil(F.col("n_docs") / F.lit(bucket_rows)).alias("buckets"),
        _unit(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit("")))).alias("shift"),
    )
    per = written(per, "targets")

    def bucketed(rows: DataFrame) -> DataFrame:
        return rows.join(per, rows["source"].eqNullSafe(per["of"])).withColumn("bucket", F.col("drawn") % F.col("buckets"))

    # rows before a bucket: a third level of stretches of 1,000 buckets, as one source may have a third of all rows
    totals = bucketed(slim).groupBy("of", "bucket").agg(F.count("*").alias("n")).withColumn("stretch", F.floor(F.col("bucket") / 1000))
    totals = written(totals, "buckets")
    earlier = Window.partitionBy("of").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.groupBy("of", "stretch").agg(F.sum("n").alias("n")).select(F.col("of").alias("o"), F.col("stretch").alias("t"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("of", "stretch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("of", "bucket", "stretch", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inside"))
    starts = starts.join(bases, starts["of"].eqNullSafe(bases["o"]) & (starts["stretch"] == bases["t"]))
    starts = starts.select(F.col("of").alias("s"), F.col("bucket").alias("b"), (F.col("base") + F.col("inside")).alias("start"))
    ranked = bucketed(full).withColumn("rank", F.row_number().over(Window.partitionBy("of", "bucket").orderBy("size", "k", "d1", "d2")))
    ranked = ranked.join(starts, ranked["of"].eqNullSafe(starts["s"]) & (ranked["bucket"] == starts["b"]))
    through = F.col("start") + F.col("rank")
    crossed = F.floor(through * F.col("rate") + F.col("shift")) - F.floor((through - 1) * F.col("rate") + F.col("shift"))
    copies = F.least(crossed, F.ceil(F.col("rate"))).cast("long")
    return ranked.select("doc.*", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is drawn, with the columns of ``docs``."""
    kept = docs.select("*", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__metriclab_doc"))
    drawn = with_copies(kept, **settings).filter("copies > 0")
    return drawn.select("__metriclab_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("__metriclab_doc.*")


#: The same draw in DuckDB, with the settings of the query.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))) AS drawn, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, count(*) AS n_docs, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS most FROM s),
l AS (SELECT *, row_number() OVER o AS place,
        (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
        / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
t AS (SELECT source, n_docs, source_size,
        CASE WHEN most > level * weight THEN (SELECT arg_min(level, place) FROM l WHERE most > level * weight) * weight ELSE most END AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate, CAST(ceil(n_docs / 2000.0) AS BIGINT) AS buckets,
        CAST('0x' || substr(md5('7/' || coalesce(source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS shift FROM t),
b AS (SELECT d.doc_id, d.size, p.*, CAST('0x' || substr(d.drawn, 1, 8) AS BIGINT) % p.buckets AS bucket
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket, size, doc_id) AS through FROM b)
SELECT doc_id, size, source_size, target,
  CAST(least(floor(through * rate + shift) - floor((through - 1) * rate + shift), ceil(rate)) AS BIGINT) AS copies,
  CAST(least(floor(through * rate + shift) - floor((through - 1) * rate + shift), ceil(rate)) AS BIGINT) * size AS taken
FROM r
"""
