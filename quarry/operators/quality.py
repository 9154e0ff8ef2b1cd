"""Data-quality checks, validation, lenient parsing and incremental ledgers.

Checks are whole-table aggregates (never samples) that produce a checks
DataFrame ``(check, expected, actual, status)``; a run can then fail with
``raise_error`` instead of collecting anything to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_rows(actuals: DataFrame, expected: Mapping[str, int | float], warn: Sequence[str] = ()) -> DataFrame:
    """``actuals`` is a one-row frame with one column per check. Returns
    (check, expected, actual, status) with status pass / fail / warn (warn:
    a listed check that does not hold)."""
    names = list(expected)
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
    long = actuals.selectExpr(f"stack({len(names)}, {pairs}) AS (check, actual)")
    exp = actuals.sparkSession.createDataFrame([(n, float(v)) for n, v in expected.items()], "check string, expected double")
    j = long.join(F.broadcast(exp), "check")
    ok = F.col("actual") == F.col("expected")
    warn_set = F.array(*[F.lit(w) for w in warn]) if warn else F.array().cast("array<string>")
    status = F.when(ok, F.lit("pass")).when(F.array_contains(warn_set, F.col("check")), F.lit("warn")).otherwise(F.lit("fail"))
    return j.select("check", "expected", "actual", status.alias("status"))


def enforce(checks: DataFrame) -> DataFrame:
    """Strict mode: the job fails on the first failing check."""
    return checks.withColumn(
        "status",
        F.when(F.col("status") == "fail", F.raise_error(F.concat(F.lit("check failed: "), F.col("check"))))
        .otherwise(F.col("status")),
    )


def violations(rules: Mapping[str, Column]) -> Column:
    """ND7: names of the violated constraints of a row (array<string>);
    each rule is a predicate that is true when the row is VALID (a null
    result counts as a violation)."""
    flags = [F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules.items()]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def lenient_json(raw: Column, key: str) -> tuple[Column, Column]:
    """SC5: (status, value) of a JSON-lines record: 'blank', 'malformed',
    'non_object', 'missing_key' or 'ok'. Uses the VARIANT parser; nothing is
    thrown for bad records."""
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    val = F.try_variant_get(v, f"$.{key}", "double")
    has_key = F.try_variant_get(v, f"$.{key}", "variant").isNotNull()
    status = (
        F.when(raw.isNull() | (F.trim(raw) == ""), F.lit("blank"))
        .when(v.isNull(), F.lit("malformed"))
        .when(~kind.startswith("OBJECT"), F.lit("non_object"))
        .when(~has_key, F.lit("missing_key"))
        .otherwise(F.lit("ok"))
    )
    return status, val


def ledger(attempts: DataFrame, key: str, ts: Sequence[str], status: Column) -> DataFrame:
    """IN2: one row per id: the latest attempt's status (last wins, as a
    max-struct aggregate), the number of attempts and the time range."""
    packed = F.struct(*[F.col(c) for c in ts], status.alias("status"))
    return attempts.groupBy(key).agg(
        F.max(packed).alias("_last"), F.count(F.lit(1)).alias("attempts"),
        F.min(ts[0]).alias("first_ts"), F.max(ts[0]).alias("last_ts"),
    ).select(key, F.col("_last.status").alias("status"), "attempts", "first_ts", "last_ts")


def todo(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """IN1 / IN3: candidates not yet processed (left anti join with the
    previous output)."""
    return candidates.join(done.select(key).distinct(), key, "left_anti")


def display_only(df: DataFrame, field: str, value: str) -> DataFrame:
    """DQ5: (check, status, found) for a field that is shown and looked up by
    exact value but is not searchable text: the value is found (a warning if
    not), its other case and its plural are not."""
    other = value.lower() if value != value.lower() else value.upper()
    plural = value + ("S" if value.isupper() else "s")
    n = df.agg(*(F.count_if(F.col(field) == v).alias(c) for c, v in (("e", value), ("o", other), ("p", plural))))
    row = lambda check, ok, bad, found: F.struct(F.lit(check).alias("check"), F.when(ok, "pass").otherwise(bad).alias("status"), F.col(found).alias("found"))
    return n.select(F.inline(F.array(row("exact value found", F.col("e") > 0, "warn", "e"), row("case-sensitive", (F.col("e") == 0) | (F.col("o") == 0), "fail", "o"),
                                     row("no stemming", F.col("p") == 0, "fail", "p"))))
