"""The whole flow over a bounded log: from records to the commit frontier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.conform import check
from ..operators.envelope import is_valid, to_envelope, to_raw_rows
from ..operators.frontier import commit_frontier
from ..operators.handled import gap_ranges_handled, handled_ranges, merge_handled
from ..operators.ordering import at_or_above, latest_per_offset
from ..operators.ranges import gaps_in
from ..operators.schema_defs import RAW_MESSAGE_FIELDS, struct_type
from ..schemas import INVALID_KEYWORD


@dataclass(frozen=True)
class Accounting:
    """What became of every offset (lazy)."""

    gaps: DataFrame
    handled: DataFrame
    frontier: DataFrame


def classify(envelopes: DataFrame, rules: dict[str, Column] | None = None, keyword: str = INVALID_KEYWORD) -> DataFrame:
    """Envelopes tagged with what becomes of them: dropped, rejected or written.

    One projection decides all paths, so the log is read once for them.
    ``rules`` are conditions over envelope columns that a row must not meet.
    """
    rejected = F.lit(False)
    for broken in (rules or {}).values():
        rejected = rejected | F.coalesce(broken, F.lit(False))
    return envelopes.withColumn(
        "reason", F.when(~is_valid(keyword), "dropped").when(rejected, "rejected").otherwise("written")
    )


def sink_rows(
    envelopes: DataFrame, version_ms: int, rules: dict[str, Column] | None = None, keyword: str = INVALID_KEYWORD
) -> DataFrame:
    """Raw-table rows of the valid envelopes with ``error`` (NULL for those that fit).

    ``rules`` are the same conditions as in ``classify``.
    """
    tagged = envelopes.where(is_valid(keyword)).select(
        "*", *[cond.alias(f"_rule_{i}") for i, cond in enumerate((rules or {}).values())]
    )
    carried = [f"_rule_{i}" for i in range(len(rules or {}))]
    rows = to_raw_rows(tagged, version_ms, keep=tuple(carried))
    named = {name: F.col(c) for name, c in zip(rules or {}, carried)}
    return check(rows, struct_type(RAW_MESSAGE_FIELDS), named).drop(*carried)


def replay_rows(
    log: DataFrame,
    checkpoint: DataFrame | None = None,
    version_ms: int = 0,
    rules: dict[str, Column] | None = None,
    keyword: str = INVALID_KEYWORD,
) -> tuple[DataFrame, DataFrame]:
    """(rows for the raw table, rows for quarantine) of everything above the checkpoint."""
    envelopes = to_envelope(log, keep=("timestamp",))
    fresh = latest_per_offset(at_or_above(envelopes, checkpoint))
    checked = sink_rows(fresh, version_ms, rules, keyword)
    return checked.where("error is null").drop("error"), checked.where("error is not null")


def account(
    log: DataFrame,
    checkpoint: DataFrame | None = None,
    rules: dict[str, Column] | None = None,
    keyword: str = INVALID_KEYWORD,
    declare_gaps: bool = True,
) -> Accounting:
    """Gaps, handled ranges and frontier of a log.

    Works on offsets alone: one scan, one shuffle of packed offsets, and no
    payload moves. ``declare_gaps=False`` shows the frontier as it stands while
    every gap still waits for its timeout.
    """
    ranges = handled_ranges(classify(to_envelope(log), rules, keyword))
    # Disjoint per reason, so a start repeats at most once per reason.
    gaps = gaps_in(ranges, checkpoint, disjoint=True)
    handled = merge_handled(ranges, gap_ranges_handled(gaps)) if declare_gaps else ranges
    return Accounting(gaps, handled, commit_frontier(handled, checkpoint, disjoint=True))
