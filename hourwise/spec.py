"""Rule and reading specifications.

All thresholds of a rule live in one frozen dataclass so a rule version is a
value, not code.  ``PRESSURE_V1`` carries the reference rule's fixed values;
``DEMO_V1`` is the variant tuned for the driver's ``events`` table (see
``hourwise.sources.readings``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, asdict


@dataclass(frozen=True)
class RuleSpec:
    version: str
    # operating-state thresholds on motor current
    loaded_current: float
    unloaded_current: float
    # low pressure: panel pressure below this while loaded
    low_pressure: float
    # rule minima and thresholds
    min_current_loaded: int
    min_prior_loaded: int
    share_floor: float
    prior_multiple: float
    lookback_days: int = 7
    grain_seconds: int = 3600
    incident_prefix: str = "INC-"
    # unit label used in operating-state names
    current_unit: str = "A"

    @property
    def lookback_seconds(self) -> int:
        return self.lookback_days * 86400

    @property
    def window_hours(self) -> int:
        return self.lookback_seconds // self.grain_seconds

    # Fixed label formats of the output contract (filled with this rule's thresholds):
    #   "Loaded (current >= {hi} {unit})", "Unloaded ({lo} <= current < {hi} {unit})", "Idle (current < {lo} {unit})"
    #   "Both: current <{c} and prior <{p}", "Current only: loaded observations <{c}",
    #   "Baseline only: prior loaded observations <{p}", "Missing rate despite sufficient counts", "None: evaluated"
    def state_labels(self) -> dict[str, str]:
        lo, hi, u = _num(self.unloaded_current), _num(self.loaded_current), self.current_unit
        return {
            "loaded": f"Loaded (current >= {hi} {u})",
            "unloaded": f"Unloaded ({lo} <= current < {hi} {u})",
            "idle": f"Idle (current < {lo} {u})",
        }

    def exclusion_labels(self) -> dict[str, str]:
        c, p = self.min_current_loaded, self.min_prior_loaded
        return {
            "both": f"Both: current <{c} and prior <{p}",
            "current": f"Current only: loaded observations <{c}",
            "baseline": f"Baseline only: prior loaded observations <{p}",
            "missing": "Missing rate despite sufficient counts",
            "none": "None: evaluated",
        }

    def as_dict(self) -> dict:
        return asdict(self)


def _num(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


# Fixed values of the reference rule (must match for identical results):
# loaded current >= 6 A, unloaded 1 <= current < 6 A, idle < 1 A,
# low pressure tp3 < 7 bar while loaded, at least 30 loaded readings in the
# hour and 300 in the prior 7 days, share floor 0.15, twice the prior share.
PRESSURE_V1 = RuleSpec(
    version="pressure-v1",
    loaded_current=6.0,
    unloaded_current=1.0,
    low_pressure=7.0,
    min_current_loaded=30,
    min_prior_loaded=300,
    share_floor=0.15,
    prior_multiple=2.0,
)

# Variant for the driver's synthetic events (about 14 readings/hour at sf0.01).
DEMO_V1 = RuleSpec(
    version="demo-v1",
    loaded_current=30.0,
    unloaded_current=10.0,
    low_pressure=20.0,
    min_current_loaded=5,
    min_prior_loaded=50,
    share_floor=0.15,
    prior_multiple=1.5,
)


# Status labels (fixed values shared with the reference's output contract).
INSUFFICIENT_HISTORY = "INSUFFICIENT_HISTORY"
REVIEW_PRESSURE = "REVIEW_PRESSURE"
NO_CANDIDATE = "NO_CANDIDATE"
NOT_EVALUATED = "Not evaluated"
EVALUATED_BREACH = "Evaluated: breach"
EVALUATED_NO_BREACH = "Evaluated: no breach"


@dataclass(frozen=True)
class ReadingSchema:
    """Canonical raw reading columns (reference CSV contract)."""

    analog: tuple = ("tp2", "tp3", "h1", "dv_pressure", "reservoirs", "oil_temperature", "motor_current")
    digital: tuple = ("comp", "dv_electric", "towers", "mpg", "lps", "pressure_switch", "oil_level")
    impulse: str = "caudal_impulse"
    time: str = "timestamp"
    # fixed values: accepted header spellings beyond the canonical names (after lower-casing and
    # removing non-alphanumerics)
    aliases: dict = field(default_factory=lambda: {"dveletric": "dv_electric", "dvelectric": "dv_electric",
                                                   "caudalimpulses": "caudal_impulse"})

    @property
    def fields(self) -> tuple:
        return (self.time, *self.analog, *self.digital, self.impulse)


READING_SCHEMA = ReadingSchema()
