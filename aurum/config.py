"""Pipeline configuration: business time zone, validity bounds, thresholds.

Every transform takes a ``Config`` so that bounds and the zone are parameters,
not constants spread over the code.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # Zone used for day partitions, hour buckets and naive input times.
    tz: str = "UTC"
    # --- fixed values (the gate bounds and thresholds of the original rules) ---
    # Validity gate, all bounds inclusive; wind has only a lower bound.
    temp_min: float = -60.0
    temp_max: float = 60.0
    humidity_min: float = 0.0
    humidity_max: float = 100.0
    wind_min: float = 0.0
    # Daily flag: max temperature strictly above this value.
    heatwave_threshold: float = 40.0
    # Alert list: latest temperature strictly above this value.
    alert_threshold: float = 40.0
    # --- end of fixed values ---
    # Decimal digits kept by the exact-sum mean (inputs with more are rounded).
    # Six are beyond any sensor, and sums stay exact as doubles far past the
    # bucket sizes here; the mean is then stored with ``round_digits``.
    mean_scale: int = 6
    # Digits of the rounded mean stored in gold.
    round_digits: int = 2
    # Hash buckets of the latest-per-key table (dynamic overwrite unit).
    latest_buckets: int = 16
    # Warn when one micro-batch touches more day partitions than this.
    max_touched_days_warn: int = 31
    # A batch of more days than this is worked off in ranges (``operators.backfill``).
    max_touched_days: int = 366
    # Batch folders of bronze's current day; beyond these they are merged.
    bronze_open_batches: int = 500
    # Broadcast a batch's keys (touched pairs, update keys) when the bound
    # derived from the batch row count is at most this many rows (about 50 MB
    # of keys); larger batches use shuffled joins planned by AQE.
    broadcast_touched_rows: int = 1_000_000


DEFAULT = Config()
