"""Which evidence counts, and in which order.

The tables below are the selection policy; the operators read them and hold no origin
names of their own. Fixed values: grades per mode, origin names and priorities, markers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

MODES = {"strict": ("A", "B"), "loose": ("A", "B", "C"), "observed": ("A", "B", "C", "D")}
SCOPES = ("CN", "US", "GLB", "ALL")

VENDOR_REVISION = "wind_revision_snapshot_"
WEB_REVISION = "official_web_revision_first_seen"
THIRD_PARTY = "third_party_current_history_first_seen_only"
CURRENT_HISTORY = "imf_current_history_snapshot_"
SIDECAR_MARKER = "estimated_availability_sidecar"


def marker_starts(prefix: str) -> str:
    # a prefix test, not LIKE: the markers contain "_", which LIKE reads as a wildcard
    return f"startswith(coalesce(release_date_source, ''), '{prefix}')"


@dataclass(frozen=True)
class Origin:
    name: str
    priority: int
    role: str            # BASE_PRIORITY competes by priority, DATED_REVISION is an event
    predicate: str       # over one vintage row
    # origins whose first visible moment ends this one's
    yields_to: tuple[str, ...] = ()


# Origins read straight from the fact table. At most one predicate holds per row.
FACT_ORIGINS = (
    Origin("PIT_A", 3, "BASE_PRIORITY", "pit_grade = 'A'"),
    Origin("PIT_B", 2, "BASE_PRIORITY", "pit_grade = 'B'", ("PIT_A",)),
    Origin(
        "EASTMONEY_D", 0, "BASE_PRIORITY",
        f"country = 'CN' AND pit_grade = 'D' AND source = 'EASTMONEY_MACRO' AND release_date_source = '{THIRD_PARTY}'",
        ("PIT_A", "PIT_B", "WIND", "SAFE_ESTIMATED_D"),
    ),
    Origin(
        "SINA_D", -1, "BASE_PRIORITY",
        f"country = 'CN' AND pit_grade = 'D' AND source = 'SINA_MACRO' AND release_date_source = '{THIRD_PARTY}'",
        ("PIT_A", "PIT_B", "WIND", "SAFE_ESTIMATED_D", "EASTMONEY_D"),
    ),
    Origin(
        "WIND_REVISION", 1, "DATED_REVISION",
        f"country = 'CN' AND pit_grade = 'D' AND source = 'WIND' AND {marker_starts(VENDOR_REVISION)}",
    ),
    Origin(
        "OBSERVED_WEB_REVISION", 1, "DATED_REVISION",
        f"pit_grade = 'D' AND release_date_source = '{WEB_REVISION}' "
        "AND (country = 'CN' OR (country = 'GLB' AND source = 'IMF'))",
    ),
)
# Origins whose availability is estimated rather than recorded.
SIDECAR_ORIGINS = (
    Origin("WIND", 1, "BASE_PRIORITY", "source <> 'SAFE'", ("PIT_A", "PIT_B")),
    Origin("SAFE_ESTIMATED_D", 1, "BASE_PRIORITY", "source = 'SAFE'", ("PIT_A", "PIT_B")),
)
RULE_ORIGIN = Origin(
    "ESTIMATED_D", 1, "BASE_PRIORITY",
    f"country = 'GLB' AND source = 'IMF' AND pit_grade = 'D' AND {marker_starts(CURRENT_HISTORY)}",
    ("PIT_A", "PIT_B"),
)
ALL_ORIGINS = (*FACT_ORIGINS, *SIDECAR_ORIGINS, RULE_ORIGIN)


@dataclass(frozen=True)
class Policy:
    """Origins plus the one series the SAFE sidecar rows are admitted for."""

    safe_series: str = "CN_FX_RESERVE_USD"
    facts: tuple[Origin, ...] = field(default=FACT_ORIGINS)

    def sidecar_filter(self) -> Column:
        series = F.col("canonical_series_id")
        return ((F.col("source") == "WIND") & (series != self.safe_series)) | (
            (F.col("source") == "SAFE") & (series == self.safe_series)
        )


def fact_origin(facts: tuple[Origin, ...] = FACT_ORIGINS) -> Column:
    """Origin name of a vintage row, null when it takes no part in selection."""
    return F.expr("CASE " + " ".join(f"WHEN {o.predicate} THEN '{o.name}'" for o in facts) + " END")


def sidecar_origin() -> Column:
    return F.expr("CASE " + " ".join(f"WHEN {o.predicate} THEN '{o.name}'" for o in SIDECAR_ORIGINS) + " END")


def of_origin(column: str, attribute: str) -> Column:
    """Look an attribute of the origin named in ``column`` up in the policy."""
    def text(value):
        return f"'{value}'" if isinstance(value, str) else str(value)
    return F.expr("CASE " + column + " " + " ".join(
        f"WHEN '{o.name}' THEN {text(getattr(o, attribute))}" for o in ALL_ORIGINS) + " END")


def scope_filter(scope: str) -> Column:
    scope = scope.upper()
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of: {', '.join(SCOPES)}")
    if scope == "ALL":
        return F.lit(True)
    if scope == "GLB":
        return ~F.col("country").isin("CN", "US")
    return F.col("country") == scope


def without_inactive(frame, inactive):
    """Drop retired series; ``inactive`` holds their ids (None keeps everything)."""
    if inactive is None:
        return frame
    return frame.join(inactive.select("canonical_series_id"), "canonical_series_id", "left_anti").select(*frame.columns)
