"""Mixing sources to target weights by Poisson replication, in Spark SQL functions only.

A source's rate is the mean number of copies that brings it to its share of the mixture: target weight times wanted size, divided by
the source's own size (sizes in characters). A document's number of copies is a Poisson variate with that mean. It is found by
inverting the distribution at a uniform number hashed from seed and doc_id, so it needs no state, and a retried task draws the same.
A mean above ``_MOST_MEAN`` is the sum of several draws of equal mean, each with its own hash; the sum is again Poisson. Every
document is exploded by its count, and the copies are dealt out and sorted by a hash of their own: a global shuffle.

The rates are one small row per source, written before use: Spark joins them by their measured size, and splits a hot source where
the table should be too large to broadcast.

Defined results: NULL is a source of its own. NULL text has size 0. A source without any text keeps rate 1. Sources without a given
weight get none. Rows that repeat an id get the same number of copies each. Rows without an id are drawn by a
hash of their text. An empty table gives an empty result.
Extra columns are kept; the operator's own come after them, in place of columns with the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.llm.shared import checkpointed

_MOST_MEAN = 64.0
_UNIT = float(1 << 52)
ADDED = ("rate", "copies", "copy", "shuffle_key")


def rates(docs: DataFrame, exponent: float = 0.5, epochs: float = 1.0, weights: DataFrame | None = None) -> DataFrame:
    """(source, size, weight, rate) per source.

    Without ``weights`` (source, weight) the target share follows size ** exponent: 1 keeps the mixture as it is, 0 makes all
    sources equal. The mixture is ``epochs`` times as large as ``docs``.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("size"))
    if weights is None:
        raw = sizes.withColumn("raw", F.pow(F.col("size").cast("double"), F.lit(float(exponent))))
        raw = raw.withColumn("raw", F.when(F.col("size") > 0, F.col("raw")).otherwise(0.0))
    else:
        wanted = weights.select(F.col("source").alias("__source"), F.col("weight").cast("double").alias("raw"))
        raw = sizes.join(wanted, F.col("source").eqNullSafe(F.col("__source")), "left").select("source", "size", F.coalesce("raw", F.lit(0.0)).alias("raw"))
    raw = checkpointed(raw, "sizes")
    # One row. Decimals add up alike in any order.
    total = raw.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.coalesce(F.sum(F.col("raw").cast("decimal(38,9)")).cast("double"), F.lit(0.0)).alias("raw")).first()
    share = F.col("raw") / F.lit(total["raw"]) if total["raw"] > 0 else F.lit(0.0)
    return raw.select(
        "source",
        "size",
        share.alias("weight"),
        F.when(F.col("size") > 0, F.lit(float(epochs)) * share * F.lit(float(total["size"])) / F.col("size")).otherwise(1.0).alias("rate"),
    )


def thresholds(mean: Column) -> Column:
    """The values of the distribution function of a Poisson variate with this mean, up to where it is 1 for any double."""
    last = (F.ceil(mean) + F.ceil(F.sqrt(mean) * 10) + 20).cast("int")
    first = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k.cast("double")
        return F.struct(p.alias("p"), (state["sum"] + p).alias("sum"), F.concat(state["all"], F.array(state["sum"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), first, step, lambda state: state["all"])


def drawn_by() -> Column:
    """What a row's draws are hashed from: its id, or its text where there is none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))


def uniform(key: Column, seed: int, draw: Column) -> Column:
    """A number in [0, 1) from a hash."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key, draw.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(_UNIT)


def poisson_mix(docs: DataFrame, exponent: float = 0.5, epochs: float = 1.0, seed: int = 17, weights: DataFrame | None = None) -> DataFrame:
    """Every copy of every document: the columns of ``docs``, then rate, copies, copy (from 0) and shuffle_key.

    Rows are in the order of ``shuffle_key`` inside each partition, and partitions hold random parts of the keys.
    """
    draws = F.greatest(F.ceil(F.col("rate") / _MOST_MEAN), F.lit(1)).cast("int")
    per_source = checkpointed(
        rates(docs, exponent, epochs, weights)
        .withColumn("__draws", draws)
        .select(F.col("source").alias("__source"), F.col("rate").alias("__rate"), "__draws", thresholds(F.col("rate") / F.col("__draws")).alias("__steps")),
        "rates",
    )
    kept = [c for c in docs.columns if c not in ADDED]
    drawn = F.aggregate(
        F.sequence(F.lit(0), F.col("__draws") - 1),
        F.lit(0),
        # A one-element array makes the number a value of its own, hashed once and not once a step.
        lambda total, draw: total + F.transform(F.array(uniform(drawn_by(), seed, draw)), lambda u: F.size(F.filter("__steps", lambda step: step <= u)))[0],
    )
    placed = docs.join(per_source, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__copies", drawn).where("__copies > 0")
    copies = placed.select(*[f"`{c}`" for c in kept], F.col("__rate").alias("rate"), F.col("__copies").alias("copies"), F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("copy"))
    key = F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), drawn_by(), F.col("copy").cast("string")).cast("binary")), 1, 16)
    return copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mixing_sql(exponent: float = 0.5, epochs: float = 1.0, seed: int = 17) -> str:
    """The same in DuckDB's SQL, without the order of rows, for rates up to the mean of one draw."""
    return f"""
        WITH RECURSIVE sizes AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS size FROM documents GROUP BY source),
        raws AS (SELECT *, CASE WHEN size > 0 THEN pow(CAST(size AS DOUBLE), {float(exponent)}) ELSE 0 END AS raw FROM sizes),
        totals AS (SELECT CAST(sum(size) AS DOUBLE) AS all_size, CAST(sum(CAST(raw AS DECIMAL(38,9))) AS DOUBLE) AS all_raw FROM raws),
        rates AS (SELECT source, CASE WHEN size > 0 THEN CAST({float(epochs)} AS DOUBLE) * (raw / all_raw) * all_size / size ELSE 1 END AS rate FROM raws, totals),
        steps AS (
            SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS total FROM rates
            UNION ALL
            SELECT source, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1) FROM steps
            WHERE k < ceil(rate) + ceil(sqrt(rate) * 10) + 20),
        inverse AS (SELECT source, any_value(rate) AS rate, list(total ORDER BY k) AS totals FROM steps GROUP BY source),
        drawn AS (
            SELECT d.*, r.rate,
                   CAST(len(list_filter(r.totals, lambda s: s <= CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null:' || md5(coalesce(d.text, ''))) || ':0'), 1, 13) AS BIGINT) / {_UNIT})) AS INTEGER) AS copies
            FROM documents d JOIN inverse r ON d.source IS NOT DISTINCT FROM r.source),
        exploded AS (SELECT *, unnest(range(copies)) AS copy64 FROM drawn WHERE copies > 0)
        SELECT * EXCLUDE (copy64), CAST(copy64 AS INTEGER) AS copy,
               substr(md5('{seed}:order:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) || ':' || copy64), 1, 16) AS shuffle_key
        FROM exploded"""
