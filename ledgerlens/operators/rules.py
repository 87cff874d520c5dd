"""Classification of rows by a list of rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID, SUSPICIOUS, INVALID = "VALID", "SUSPICIOUS", "INVALID"
NO_ISSUES = "No issues detected"
REASON_SEPARATOR = "; "


@dataclass(frozen=True)
class Rule:
    """A condition on a row, how bad it is when it holds, and the reason to write down.

    ``marked`` tells that the condition reads a mark, which depends on other rows."""

    condition: Column
    severity: str
    reason: str
    marked: bool = False


def invalid(condition: Column, reason: str, marked: bool = False) -> Rule:
    return Rule(condition, INVALID, reason, marked)


def suspicious(condition: Column, reason: str, marked: bool = False) -> Rule:
    return Rule(condition, SUSPICIOUS, reason, marked)


def decided(df: DataFrame, rules: Sequence[Rule], into: str) -> tuple[DataFrame, list[Rule]]:
    """Add the conditions that read no mark as the bits of one column, and return the rules that read these.

    The joins that set the marks then carry one column for all that the conditions read."""
    bits = {r.reason: 1 << i for i, r in enumerate(rules) if not r.marked}
    held = [F.when(r.condition, bits[r.reason]).otherwise(0) for r in rules if not r.marked]
    rules = [r if r.marked else replace(r, condition=F.col(into).bitwiseAND(F.lit(bits[r.reason])) != 0) for r in rules]
    return df.withColumn(into, reduce(lambda a, b: a + b, held, F.lit(0))), rules


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``record_status``, the worst severity of all rules that hold, and ``status_reason``,

    their reasons in the order of ``rules``. A condition that is null does not hold. No row is
    dropped and all is computed in one projection."""

    def any_with(severity: str) -> Column:
        held = [F.coalesce(r.condition, F.lit(False)) for r in rules if r.severity == severity]
        return reduce(lambda a, b: a | b, held, F.lit(False))

    # Nested, so that Spark takes the filter of trusted rows apart and drops rows before the joins that set later marks.
    sound = F.when(any_with(SUSPICIOUS), SUSPICIOUS).otherwise(VALID)
    status = F.when(any_with(INVALID), INVALID).otherwise(sound)
    reasons = F.concat_ws(REASON_SEPARATOR, *[F.when(r.condition, r.reason) for r in rules])
    return df.withColumns(
        {
            "record_status": status,
            "status_reason": F.when(reasons == "", NO_ISSUES).otherwise(reasons),
        }
    )


def status_counts(classified: DataFrame) -> DataFrame:
    """Rows per ``record_status``."""
    return classified.groupBy("record_status").agg(F.count(F.lit(1)).alias("row_count"))


def rule_counts(classified: DataFrame) -> DataFrame:
    """Rows per reason; a row with several reasons counts for each."""
    reasons = F.explode(F.split("status_reason", REASON_SEPARATOR, -1))
    return classified.select(reasons.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def trusted(classified: DataFrame) -> DataFrame:
    """The rows that are not INVALID; SUSPICIOUS ones stay."""
    return classified.where(F.col("record_status") != INVALID)
