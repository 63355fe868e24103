"""Status counts and the choice of the next stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGES = ("select", "sections", "generate", "guard", "judge", "export")


def count_where(condition: str) -> Column:
    return F.count_if(F.expr(condition))


def pair_status(pairs: DataFrame) -> DataFrame:
    """One row: pairs, kept, percent kept, supported, unjudged; the percentage is null without pairs."""
    n, kept = F.count(F.lit(1)), count_where("kept = 1")
    return pairs.agg(
        n.alias("pairs"),
        kept.alias("kept"),
        (F.lit(100.0) * kept / F.nullif(n, F.lit(0))).alias("kept_percent"),
        count_where("judged = 1").alias("supported"),
        count_where("kept = 1 and judged = -1").alias("unjudged"),
    )


def tolerance(total: Column | int) -> Column | int:
    """Stragglers that a finished stage may leave: half a percent, at least 200."""
    return max(200, total // 200) if isinstance(total, int) else F.greatest(F.lit(200), F.floor(total / 200))


def next_stage(selected: int, contexts: int, generated: int, kept: int, judged: int, marks: set[str]) -> str | None:
    """The stage to run next from the state's counts and the marks of finished stages; None when all is done."""
    if selected == 0:
        return "select"
    if "sections" not in marks:
        return "sections"
    if "generate" not in marks and contexts - generated > tolerance(contexts):
        return "generate"
    if "guard" not in marks:
        return "guard"
    if "judge" not in marks and kept - judged > tolerance(kept):
        return "judge"
    return None if "export" in marks else "export"


def duration(seconds: float) -> str:
    """Seconds as s, m or h."""
    if seconds < 60:
        return f"{seconds:.0f}s"
    return f"{seconds / 60:.1f}m" if seconds < 3600 else f"{seconds / 3600:.1f}h"
