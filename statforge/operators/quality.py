"""Data-quality rules whose outcome is a table of findings.

All row rules of a table are counted in one pass: one global aggregate, partial sums per task. Keys
and references are checked by aggregation or anti join. Findings have the columns ``table_name, rule,
severity, bad_rows, total_rows``; a rule with no bad rows is reported too.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statforge.functions import expr as E

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
FINDING = "table_name string, rule string, severity string, bad_rows bigint, total_rows bigint"


@dataclass(frozen=True)
class Rule:
    """``bad`` is true for offending rows; NULL counts as good, as in an SQL CHECK.

    With ``over_share`` the rule counts only if more than that share of the rows is bad.
    """

    name: str
    bad: Column | str
    severity: str = ERROR
    over_share: float | None = None

    def condition(self) -> Column:
        return F.expr(self.bad) if isinstance(self.bad, str) else self.bad


def holds(name: str, check: str, severity: str = ERROR) -> Rule:
    """A CHECK constraint, written as what must hold."""
    return Rule(name, f"NOT ({check})", severity)


def not_null(*columns: str, severity: str = ERROR) -> list[Rule]:
    return [Rule(f"{c}_not_null", F.col(c).isNull(), severity) for c in columns]


def check_rows(df: DataFrame, table: str, rules: Iterable[Rule]) -> DataFrame:
    """Findings of all row rules of a table, in one pass."""
    rules = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *(F.count_if(F.coalesce(r.condition(), F.lit(False))).alias(f"__r{i}") for i, r in enumerate(rules)),
    )
    total = F.col("__total")
    rows = []
    for i, rule in enumerate(rules):
        bad = F.col(f"__r{i}")
        if rule.over_share is not None:
            bad = F.when(bad > total * rule.over_share, bad).otherwise(F.lit(0))
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule.name).alias("rule"),
                F.lit(rule.severity).alias("severity"),
                bad.cast("bigint").alias("bad_rows"),
                total.cast("bigint").alias("total_rows"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def duplicate_keys(df: DataFrame, table: str, keys: Sequence[str], severity: str = ERROR) -> DataFrame:
    """Rows whose key occurs more than once (all of them are counted)."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("bad_rows"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(f"unique({','.join(keys)})").alias("rule"),
        F.lit(severity).alias("severity"),
        "bad_rows",
        "total_rows",
    )


def repeated_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count > 1")


def orphans(df: DataFrame, reference: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Rows without a partner in ``reference`` (``keys``: own column to referenced column)."""
    parents = reference.select(*(F.col(r).alias(f"__p_{r}") for r in dict.fromkeys(keys.values()))).distinct()
    on = reduce(Column.__and__, (F.col(c) == F.col(f"__p_{r}") for c, r in keys.items()))
    return df.join(parents, on, "left_anti")


def check_references(
    df: DataFrame, table: str, reference: DataFrame, keys: Mapping[str, str], severity: str = ERROR
) -> DataFrame:
    """Rows per key are counted before the join, so a hot key crosses the shuffle once."""
    names = list(keys)
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    lost = orphans(groups, reference, keys).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("bad"))
    return _with_total(
        lost.select("bad"), df, table, f"references({','.join(names)})", severity
    )


def _with_total(bad: DataFrame, df: DataFrame, table: str, rule: str, severity: str) -> DataFrame:
    """Put a one-row count beside the table's size by adding up two one-row results."""
    size = df.agg(F.lit(0).cast("bigint").alias("bad"), F.count(F.lit(1)).alias("total"))
    both = bad.select(F.col("bad").cast("bigint"), F.lit(0).cast("bigint").alias("total")).unionByName(size)
    return both.agg(F.sum("bad").alias("bad_rows"), F.sum("total").alias("total_rows")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "bad_rows", "total_rows"
    )


def check_size(df: DataFrame, table: str, low: int, high: int | None, severity: str = WARNING) -> DataFrame:
    """One finding with ``bad_rows`` = 1 when the row count is outside the range."""
    n = F.col("total_rows")
    outside = (n < low) if high is None else (n < low) | (n > high)
    rule = f"rows_between({low},{'' if high is None else high})"
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        outside.cast("bigint").alias("bad_rows"),
        "total_rows",
    )


def not_empty(df: DataFrame, table: str, severity: str = WARNING) -> DataFrame:
    return check_size(df, table, 1, None, severity)


# ---- schema rules: decided on the driver from the schema alone ------------------------------------


def _schema_findings(spark: SparkSession, table: str, outcome: Iterable[tuple[str, bool]], severity: str) -> DataFrame:
    rows = [(table, rule, severity, 0 if good else 1, 1) for rule, good in outcome]
    return spark.createDataFrame(rows, FINDING)


def required_columns(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    have = set(df.columns)
    return _schema_findings(df.sparkSession, table, ((f"has({c})", c in have) for c in columns), ERROR)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FAMILIES: dict[str, tuple[type, ...]] = {
    "int": _INTEGRAL,
    "float": (*_INTEGRAL, T.FloatType, T.DoubleType, T.DecimalType),
    "date": (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType),
}


def expected_families(df: DataFrame, table: str, expected: Mapping[str, str]) -> DataFrame:
    """Columns exist and belong to the ``int``, ``float`` or ``date`` family."""
    types = {f.name: f.dataType for f in df.schema.fields}
    outcome = ((f"{c} is {fam}", c in types and isinstance(types[c], _FAMILIES[fam])) for c, fam in expected.items())
    return _schema_findings(df.sparkSession, table, outcome, WARNING)


def expected_types(df: DataFrame, table: str, expected: Mapping[str, str]) -> DataFrame:
    """Columns have exactly the stated type, precision and scale included."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return _schema_findings(df.sparkSession, table, ((f"{c} {t}", types.get(c) == t) for c, t in expected.items()), ERROR)


# ---- what the values of a column read as, whatever its type -----------------------------------------

_WHOLE = r"^\s*[+-]?\d+(\.0*)?\s*$"
INT, FLOAT, DATE = "int", "float", "date"


def reads_as(column: str, family: str, kind: T.DataType | None = None) -> Column:
    """Whether a value reads as a whole number, a number or a ``yyyy-MM-dd`` date; NULL for NULL. Typed columns go by their type."""
    col = F.col(f"`{column}`")
    if family not in (INT, FLOAT, DATE):
        raise ValueError(f"unknown family {family!r}")
    if family == DATE:
        return F.when(col.isNotNull(), E.lenient_date(col, kind).isNotNull())
    if isinstance(kind, T.NumericType):
        return F.when(col.isNotNull(), F.lit(True) if family == FLOAT else col == F.floor(col))
    shown = col.cast("string")
    return F.when(col.isNotNull(), shown.rlike(_WHOLE) if family == INT else E.lenient_double(col).isNotNull())


def missing_share(*columns: str, over: float = 0.5, severity: str = WARNING) -> list[Rule]:
    """Columns of which more than a share is NULL."""
    return [Rule(f"missing({c})", F.col(f"`{c}`").isNull(), severity, over) for c in columns]


def family_rules(df: DataFrame, families: Mapping[str, str], severity: str = WARNING) -> list[Rule]:
    """Values that don't read as their column's declared family; columns that aren't there have no rule."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [Rule(f"{c} reads as {fam}", ~reads_as(c, fam, types[c]), severity) for c, fam in families.items() if c in types]


# ---- profiles ----------------------------------------------------------------------------------


def column_profile(df: DataFrame, table: str, high_missing: float = 50.0) -> DataFrame:
    """Type, NULL count and NULL share of every column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *(F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"__c{i}") for i, f in enumerate(df.schema.fields)),
    )
    total = F.col("__total")
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"__c{i}").cast("bigint").alias("null_rows"),
            E.ratio(F.col(f"__c{i}"), total, 2, scale=100.0).alias("null_pct"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    profile = counts.select(F.inline(F.array(*rows)))
    return profile.withColumn("high_missing", F.coalesce(F.col("null_pct") > high_missing, F.lit(False)))


def value_profile(df: DataFrame, table: str, families: Mapping[str, str] | None = None, high_missing: float = 50.0) -> DataFrame:
    """One row per column: missing share, what its values read as, and the range of its numbers; one aggregate over the table.

    ``misfit_rows`` are values that don't read as the declared family. Minimum, maximum and mean (two digits) are of the values that read
    as numbers, in columns declared ``int`` or ``float``; columns without a family have NULL there. An empty table has NULL shares.
    """
    declared = dict(families or {})
    fields = df.schema.fields
    measures = [F.count(F.lit(1)).alias("__total")]
    for i, f in enumerate(fields):
        family, number = declared.get(f.name), E.lenient_double(F.col(f"`{f.name}`"))
        measures.append(F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"__null{i}"))
        if family:
            measures.append(F.count_if(~reads_as(f.name, family, f.dataType)).alias(f"__bad{i}"))
        if family in (INT, FLOAT):
            value = F.col(f"`{f.name}`").cast("double") if isinstance(f.dataType, T.NumericType) else number
            measures += [F.min(value).alias(f"__min{i}"), F.max(value).alias(f"__max{i}"), F.sum(value).alias(f"__sum{i}"), F.count(value).alias(f"__n{i}")]
    counts, unknown = df.agg(*measures), F.lit(None).cast("double")
    rows = []
    for i, f in enumerate(fields):
        family = declared.get(f.name)
        numeric = family in (INT, FLOAT)
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(family).cast("string").alias("family"),
                F.col("__total").cast("bigint").alias("total_rows"),
                F.col(f"__null{i}").cast("bigint").alias("null_rows"),
                E.ratio(F.col(f"__null{i}"), F.col("__total"), 2, scale=100.0).alias("null_pct"),
                (F.col(f"__bad{i}") if family else F.lit(None)).cast("bigint").alias("misfit_rows"),
                (F.col(f"__min{i}") if numeric else unknown).alias("min_value"),
                (F.col(f"__max{i}") if numeric else unknown).alias("max_value"),
                (E.ratio(F.col(f"__sum{i}"), F.col(f"__n{i}"), 2) if numeric else unknown).alias("mean_value"),
            )
        )
    profile = counts.select(F.inline(F.array(*rows)))
    return profile.withColumn("high_missing", F.coalesce(F.col("null_pct") > high_missing, F.lit(False)))


def layer_profile(tables: Mapping[str, DataFrame], families: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """``value_profile`` of every table of a layer, one scan each."""
    return combine(value_profile(df, name, (families or {}).get(name)) for name, df in tables.items())


def value_counts(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """The most frequent values with their counts."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(column).asc()).limit(top)


def number_profile(df: DataFrame, column: str) -> DataFrame:
    """Size, zeros and their share, negatives, and range of a numeric column, in one pass."""
    col = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(col == 0).alias("zero_rows"),
        F.count_if(col < 0).alias("negative_rows"),
        F.min(col).cast("double").alias("min_value"),
        F.max(col).cast("double").alias("max_value"),
        F.avg(col).alias("mean_value"),
    ).withColumn("zero_pct", E.ratio("zero_rows", "total_rows", 1, scale=100.0))


# ---- results -----------------------------------------------------------------------------------


def combine(findings: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def verdict(findings: DataFrame) -> DataFrame:
    """One row: failed rules by severity and whether the data passes (warnings do not fail it)."""
    broken = F.col("bad_rows") > 0
    return findings.agg(
        F.count_if(broken & (F.col("severity") == ERROR)).alias("errors"),
        F.count_if(broken & (F.col("severity") == WARNING)).alias("warnings"),
        F.count(F.lit(1)).alias("rules"),
    ).withColumn("passed", F.col("errors") == 0)
