"""tripforge — a Spark-native trip data-quality and feature engine.

Raw trip records are checked against a declarative column contract, bad rows
are quarantined with every violated rule, types are coerced, model features
are derived, implausible rows are dropped with counted reasons, and the result
is written as a day-partitioned feature table.  Every step is a DataFrame ->
DataFrame function built from built-in Spark column expressions, so Catalyst
fuses the chain into one scan and generated code per stage.

Entry points::

    from tripforge import build_session, read_trips, read_landed, run_files, run_months, run_range
    from tripforge import split, build_features, profile
"""

from tripforge.config import DEFAULT_THRESHOLDS, Thresholds
from tripforge.functions.contract import TRIP_CONTRACT, Contract
from tripforge.operators.profile import profile
from tripforge.operators.quarantine import split
from tripforge.operators.transform import build_features
from tripforge.plans.pipeline import run_files, run_months, run_range
from tripforge.session import build_session
from tripforge.sources.trips import read_landed, read_trips

__all__ = [
    "Thresholds", "DEFAULT_THRESHOLDS", "TRIP_CONTRACT", "Contract", "build_session",
    "read_trips", "read_landed", "run_files", "run_months", "run_range",
    "split", "build_features", "profile",
]
