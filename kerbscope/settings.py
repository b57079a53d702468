"""Scoring parameters.  Every weight is a finite decimal with two digits, held
here as text and turned into integer hundredths for the arithmetic."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from kerbscope.functions.timeformats import ISO

# ---------------------------------------------------------------- fixed values
# Results depend on these exact values; they are data, not tuning knobs.

SEVERITY = {
    "NO PARKING": "1.00",
    "WRONG PARKING": "1.05",
    "PARKING IN A MAIN ROAD": "1.40",
    "DOUBLE PARKING": "1.55",
    "PARKING NEAR ROAD CROSSING": "1.60",
    "PARKING NEAR TRAFFIC LIGHT OR ZEBRA CROSS": "1.65",
    "PARKING OPPOSITE TO ANOTHER PARKED VEHICLE": "1.45",
    "PARKING NEAR BUSTOP/SCHOOL/HOSPITAL ETC": "1.35",
    "PARKING OTHER THAN BUS STOP": "1.25",
    "PARKING ON FOOTPATH": "1.10",
}
OTHER_SEVERITY = "0.75"

VEHICLE_FOOTPRINT = {
    "MOPED": "0.35",
    "SCOOTER": "0.40",
    "MOTOR CYCLE": "0.40",
    "PASSENGER AUTO": "0.75",
    "GOODS AUTO": "0.85",
    "CAR": "1.00",
    "JEEP": "1.00",
    "VAN": "1.10",
    "MAXI-CAB": "1.20",
    "LGV": "1.35",
    "TEMPO": "1.45",
    "MINI LORRY": "1.60",
    "LORRY/GOODS VEHICLE": "1.90",
    "HGV": "2.10",
    "TANKER": "2.20",
    "BUS (BMTC/KSRTC)": "2.50",
    "PRIVATE BUS": "2.50",
    "TOURIST BUS": "2.50",
    "SCHOOL VEHICLE": "2.25",
    "FACTORY BUS": "2.40",
}
OTHER_FOOTPRINT = "1.00"

JUNCTION_WEIGHT = "1.25"
PEAK_WEIGHT = "1.20"
PEAK_HOURS = (8, 9, 10, 17, 18, 19, 20)
LOCAL_ZONE = "Asia/Kolkata"
NO_JUNCTION = "NO JUNCTION"
KEPT_WORD = "PARKING"

# band, lowest score, field action
BANDS = (
    ("Critical", 80, "Tow-away patrol + barricade edge + peak-hour officer"),
    ("High", 60, "Focused patrol during top 2 peak hours"),
    ("Medium", 40, "Warning drive + repeat-offender monitoring"),
    ("Watch", None, "Observe through weekly dashboard"),
)

SCORE_FORMULA = (
    "0.40*ViolationFrequency + 0.25*RepeatHotspotDensity "
    "+ 0.15*JunctionProximity + 0.10*PeakHourFactor "
    "+ 0.10*VehicleBlockageWeight"
)

FEATURES = ("history", "last_month", "trend", "station", "peak_junction")

# Blend candidates, one weight per feature; earlier rows win ties.
CANDIDATES = (
    (1.00, 0.00, 0.00, 0.00, 0.00),
    (0.70, 0.30, 0.00, 0.00, 0.00),
    (0.55, 0.35, 0.10, 0.00, 0.00),
    (0.50, 0.30, 0.10, 0.10, 0.00),
    (0.45, 0.35, 0.10, 0.05, 0.05),
    (0.40, 0.35, 0.10, 0.10, 0.05),
    (0.35, 0.45, 0.10, 0.05, 0.05),
    (0.35, 0.35, 0.15, 0.10, 0.05),
    (0.30, 0.45, 0.15, 0.05, 0.05),
    (0.30, 0.40, 0.10, 0.10, 0.10),
    (0.25, 0.50, 0.10, 0.10, 0.05),
    (0.25, 0.45, 0.15, 0.10, 0.05),
)

KS = (20, 50, 100)

# What the evaluation record says of its metrics.
INTERPRETATION = {
    "precision_at_k": "Share of predicted top-k enforcement hotspots that also appeared in the actual top-k next month.",
    "ndcg_at_k": "Ranking quality where higher-ranked actual high-impact hotspots are rewarded more.",
    "spearman_score_correlation": "Rank correlation between historical hotspot score and next-month hotspot score for repeated grid cells.",
}
# ------------------------------------------------------------ end fixed values


def hundredths(text: str) -> int:
    """``"1.05"`` -> 105; refuses weights with more than two decimals."""
    scaled = Decimal(text) * 100
    if scaled != int(scaled):
        raise ValueError(f"weight {text!r} has more than two decimals")
    return int(scaled)


@dataclass(frozen=True)
class CleanSettings:
    """Parameters of the cleaning stage; defaults are the fixed values above."""

    severity: dict[str, str] = field(default_factory=lambda: dict(SEVERITY))
    other_severity: str = OTHER_SEVERITY
    footprint: dict[str, str] = field(default_factory=lambda: dict(VEHICLE_FOOTPRINT))
    other_footprint: str = OTHER_FOOTPRINT
    junction_weight: str = JUNCTION_WEIGHT
    peak_weight: str = PEAK_WEIGHT
    peak_hours: tuple[int, ...] = PEAK_HOURS
    zone: str = LOCAL_ZONE
    time_formats: tuple[str, ...] = (ISO,)
