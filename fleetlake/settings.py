"""Typed settings of the lakehouse, with YAML loaders for user overrides."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W

# --- Fixed values: the names, ranges and feature specification of the data set ---

KEY_COLUMNS = ("unit_id", "cycle")
SETTING_COLUMNS = tuple(f"operational_setting_{i}" for i in range(1, 4))
SENSOR_COLUMNS = tuple(f"sensor_{i:02d}" for i in range(1, 22))
READING_COLUMNS = KEY_COLUMNS + SETTING_COLUMNS + SENSOR_COLUMNS
METADATA_COLUMNS = ("source_file", "dataset_id", "ingested_at", "pipeline_run_id", "source_row_number")
SILVER_COLUMNS = (
    "has_cycle_gap",
    "has_sensor_range_violation",
    "has_sensor_spike",
    "record_quality_status",
    "silver_processed_at",
)
EQUIPMENT_TYPE = "turbofan_engine"

SENSOR_RANGES = {
    "sensor_01": (-0.01, 0.01, "Fan inlet temperature (HPC outlet temperature deviation)"),
    "sensor_02": (630.0, 650.0, "LPC outlet temperature"),
    "sensor_03": (1560.0, 1620.0, "HPC outlet temperature"),
    "sensor_04": (1380.0, 1420.0, "LPT outlet temperature"),
    "sensor_05": (0.0, 25.0, "Fan inlet pressure deviation"),
    "sensor_06": (0.0, 100.0, "Bypass-duct pressure"),
    "sensor_07": (540.0, 560.0, "HPC outlet pressure"),
    "sensor_08": (2370.0, 2400.0, "Physical fan speed"),
    "sensor_09": (9000.0, 9150.0, "Physical core speed"),
    "sensor_10": (1.2, 1.4, "Engine pressure ratio"),
    "sensor_11": (45.0, 50.0, "HPC outlet static pressure"),
    "sensor_12": (510.0, 530.0, "Ratio of fuel flow to Ps30"),
    "sensor_13": (2380.0, 2400.0, "Corrected fan speed"),
    "sensor_14": (8100.0, 8200.0, "Corrected core speed"),
    "sensor_15": (8.0, 9.5, "Bypass ratio"),
    "sensor_16": (0.01, 0.04, "Burner fuel-air ratio"),
    "sensor_17": (380.0, 420.0, "Bleed enthalpy"),
    "sensor_18": (2380.0, 2400.0, "Demanded fan speed"),
    "sensor_19": (100.0, 100.0, "Demanded corrected fan speed"),
    "sensor_20": (14.5, 15.5, "HPT coolant bleed"),
    "sensor_21": (20.0, 24.0, "LPT coolant bleed"),
}

# column: (rolling windows, statistics, rate of change)
FEATURE_SPEC = {
    "sensor_02": ((5, 10, 20), ("mean", "std"), True),
    "sensor_03": ((5, 10, 20), ("mean", "std"), True),
    "sensor_04": ((5, 10, 20), ("mean", "std"), True),
    "sensor_07": ((5, 10, 20), ("mean", "std"), True),
    "sensor_08": ((5, 20), ("mean", "std"), True),
    "sensor_09": ((5, 20), ("mean", "std"), True),
    "sensor_11": ((5, 10, 20), ("mean", "std"), True),
    "sensor_12": ((5, 10, 20), ("mean", "std"), True),
    "sensor_13": ((5, 20), ("mean", "std"), True),
    "sensor_14": ((5, 20), ("mean", "std"), False),
    "sensor_15": ((5, 20), ("mean", "std"), True),
    "sensor_17": ((5, 20), ("mean", "std"), False),
    "sensor_20": ((5, 20), ("mean", "std"), True),
    "sensor_21": ((5, 20), ("mean", "std"), True),
    "operational_setting_1": ((10,), ("mean",), False),
}

# --- end of fixed values ---


@dataclass(frozen=True)
class SeriesWindow:
    """The window over one series, as a specification and as SQL text.

    Stages with hundreds of columns hand Spark text: it is parsed in one call.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]

    @property
    def spec(self) -> WindowSpec:
        return W.partitionBy(*self.keys).orderBy(*self.order)

    @property
    def sql(self) -> str:
        return f"PARTITION BY {', '.join(self.keys)} ORDER BY {', '.join(self.order)}"


@dataclass(frozen=True)
class Series:
    """What makes one time series: its keys, its clock, and the tie-breakers."""

    keys: tuple[str, ...] = ("dataset_id", "unit_id")
    order: tuple[str, ...] = ("cycle",)
    ties: tuple[str, ...] = ("source_file", "source_row_number")

    def on(self, df: DataFrame) -> Series:
        """The same series restricted to the columns that ``df`` has."""
        have = set(df.columns)
        keys = tuple(k for k in self.keys if k in have)
        if not keys or any(c not in have for c in self.order):
            raise ValueError(f"need a key of {self.keys} and {self.order}, got {df.columns}")
        return Series(keys, self.order, tuple(c for c in self.ties if c in have))

    @property
    def clock(self) -> str:
        return self.order[0]

    def window(self) -> SeriesWindow:
        return SeriesWindow(self.keys, (*self.order, *self.ties))


UNIQUE_SERIES = Series(ties=())
"""For deduplicated layers: the clock alone orders a unit."""


@dataclass(frozen=True)
class SkewLimits:
    """Sizes that decide when a group is split and when a side is broadcast."""

    hot_rows: int = 4_000_000
    chunk_rows: int = 1_000_000
    broadcast_groups: int = 500_000


@dataclass(frozen=True)
class Freshness:
    bronze_max_age_hours: int = 24
    silver_max_age_hours: int = 24
    gold_max_age_hours: int = 48

    def hours(self, layer: str) -> int:
        return getattr(self, f"{layer}_max_age_hours", 24)


@dataclass(frozen=True)
class RiskThresholds:
    critical: float = 25
    high: float = 50
    medium: float = 75


@dataclass(frozen=True)
class HealthWeights:
    sensor_deviation_weight: float = 0.4
    spike_penalty_weight: float = 0.2
    degradation_penalty_weight: float = 0.3
    quality_penalty_weight: float = 0.1
    risk_thresholds: RiskThresholds = RiskThresholds()


@dataclass(frozen=True)
class SpikeRule:
    """``exclude_current`` tests a point against the rows before it only.

    A value on the limit is no spike: one has to lie beyond it by more than
    ``tolerance`` of the larger of value and mean, which is far above what
    rounding can add and far below what a sensor can tell apart.
    """

    window: int = 10
    sigma: float = 3.0
    exclude_current: bool = False
    tolerance: float = 1e-9


@dataclass(frozen=True)
class SensorRange:
    min: float
    max: float
    description: str = ""


@dataclass(frozen=True)
class Feature:
    rolling_windows: tuple[int, ...] = ()
    statistics: tuple[str, ...] = ()
    rate_of_change: bool = False


@dataclass(frozen=True)
class Paths:
    source_dir: str = "data/source"
    bronze_dir: str = "data/bronze"
    silver_dir: str = "data/silver"
    gold_dir: str = "data/gold"
    quarantine_dir: str = "data/quarantine"
    metadata_dir: str = "data/metadata"

    @staticmethod
    def below(base: str) -> Paths:
        return Paths(*(f"{base.rstrip('/')}/{f.default}" for f in fields(Paths)))


def default_ranges() -> dict[str, SensorRange]:
    return {sensor: SensorRange(*entry) for sensor, entry in SENSOR_RANGES.items()}


def default_features() -> dict[str, Feature]:
    return {column: Feature(*entry) for column, entry in FEATURE_SPEC.items()}


@dataclass(frozen=True)
class Settings:
    paths: Paths = Paths()
    dataset_ids: tuple[str, ...] = ("FD001", "FD002", "FD003", "FD004")
    default_dataset_id: str = "FD001"
    column_names: tuple[str, ...] = READING_COLUMNS
    freshness: Freshness = Freshness()
    spikes: SpikeRule = SpikeRule()
    health: HealthWeights = HealthWeights()
    ranges: Mapping[str, SensorRange] = field(default_factory=default_ranges)
    features: Mapping[str, Feature] = field(default_factory=default_features)
    series: Series = Series()
    limits: SkewLimits = SkewLimits()

    def __post_init__(self) -> None:
        if len(self.column_names) != len(READING_COLUMNS):
            raise ValueError(f"expected {len(READING_COLUMNS)} column names, got {len(self.column_names)}")

    @staticmethod
    def from_yaml(
        path: str | None = None, ranges_path: str | None = None, features_path: str | None = None
    ) -> Settings:
        """Defaults overlaid with YAML files; any of the three may be left out."""
        raw = _load(path) if path else {}
        overrides: dict[str, Any] = {}
        if "data_paths" in raw:
            overrides["paths"] = _overlay(Paths(), raw["data_paths"])
        if "dataset" in raw:
            overrides["default_dataset_id"] = raw["dataset"].get("default_id", "FD001")
            overrides["dataset_ids"] = tuple(raw["dataset"].get("supported_ids", Settings.dataset_ids))
        if "column_names" in raw:
            overrides["column_names"] = tuple(raw["column_names"])
        if "freshness" in raw:
            overrides["freshness"] = _overlay(Freshness(), raw["freshness"])
        if "health_score" in raw:
            overrides["health"] = _overlay(HealthWeights(), raw["health_score"])
        if "pipeline" in raw:
            rule = SpikeRule()
            overrides["spikes"] = SpikeRule(
                raw["pipeline"].get("spike_detection_window", rule.window),
                float(raw["pipeline"].get("spike_threshold_sigma", rule.sigma)),
            )
        if ranges_path:
            overrides["ranges"] = load_sensor_ranges(ranges_path)
        if features_path:
            overrides["features"] = load_features(features_path)
        return Settings(**overrides)


def load_sensor_ranges(path: str) -> dict[str, SensorRange]:
    """``sensor -> min, max, description``."""
    return {
        sensor: SensorRange(float(entry["min"]), float(entry["max"]), entry.get("description", ""))
        for sensor, entry in _load(path).items()
    }


def load_features(path: str) -> dict[str, Feature]:
    """``features -> column -> rolling_windows, statistics, rate_of_change``."""
    return {
        column: Feature(
            tuple(entry.get("rolling_windows", ())),
            tuple(entry.get("statistics", ())),
            bool(entry.get("rate_of_change", False)),
        )
        for column, entry in _load(path).get("features", {}).items()
    }


def _load(path: str) -> dict[str, Any]:
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML settings needs PyYAML") from error
    with open(path) as handle:
        return yaml.safe_load(handle) or {}


def _overlay(base, raw: Mapping[str, Any]):
    known = {}
    for f in fields(base):
        if f.name in raw:
            current = getattr(base, f.name)
            known[f.name] = _overlay(current, raw[f.name]) if is_dataclass(current) else raw[f.name]
    return type(base)(**{**{f.name: getattr(base, f.name) for f in fields(base)}, **known})
