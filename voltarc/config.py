"""Thresholds, parameters and their validation; built once on the driver, immutable from then on.

Merging follows one rule: the manual settings win over the thresholds, and what the profile step found is kept apart in
``found``, so that a found chemistry name never meets the table of chemistry parameters.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import lru_cache
from pathlib import Path
from typing import Any

#: The thresholds that results depend on.
DEFAULTS: dict[str, Any] = {
    "chemistry": {
        "LFP": {"v_full": 91.25, "v_cutoff": 65.0, "alpha": 0.005, "t_ref": 25.0, "cell_v_full": 3.65, "cell_v_cutoff": 2.6},
        "NMC": {"v_full": 88.2, "v_cutoff": 63.0, "alpha": 0.0025, "t_ref": 25.0, "cell_v_full": 4.2, "cell_v_cutoff": 3.0},
    },
    "filter": {"temp_range": [5.0, 45.0], "temp_normal_range": [15.0, 35.0], "cap_range_ratio": [0.65, 1.10], "cap_anomaly_ratio": [0.50, 1.20], "cap_normal_ratio": [0.75, 1.00]},
    "anchor": {
        "soc_full": 0.95, "soc_swap_full": 0.98, "soc_empty": 0.10, "v_full_ratio": 0.99, "v_cutoff_ratio": 1.05, "full_current_max_a": 5.0, "rest_c_rate": 0.02,
        "duration_hours": 2.0, "gap_hours": 6.0, "deadband_a": 0.2, "sensor_drift_a": 2.0, "current_zero_frac_limit": 0.90, "current_near_zero_a": 1.0,
    },
    "quality": {
        "score": {"SWAP_FULL": 20.0, "EMPTY_END": 20.0, "FULL_END": 15.0, "OCV": 10.0, "temp_normal": 5.0, "temp_out": -10.0, "cap_normal": 10.0, "cap_anomaly": -20.0, "v_normal": 10.0, "v_anomaly": -15.0, "contradiction": -15.0, "sensor_drift": -10.0},
        "tier1_min": 30.0, "tier2_min": 10.0, "severe_flags": ["out_of_range", "voltage_inconsistent", "anchor_conflict", "contradiction"], "weight": {"SWAP_FULL": 1.0, "EMPTY_END": 1.0, "FULL_END": 0.8, "OCV": 0.5}, "tier2_weight": 0.3, "contradiction_ratio": 0.30, "closure_days": 7,
    },
    "soh": {"mad_window": 7, "mad_threshold": 3.0, "monthly_drop_alert": 0.05, "min_anchors_per_month": 3, "anchor_mad_k": 3.0},
    "exclude": {"soh_low_ratio": 0.90},
    "retirement": {"soh_retire": 0.80, "health_levels": [0.85, 0.75, 0.65], "min_months": 3, "r2_min": 0.6, "ci_z": 1.96},
    "monitoring": {"device_anchor_rate_min": 0.20, "channel_anchor_rate_min": 0.30, "channel_anchor_rate_drop_mom": 0.30},
    "selfcheck": {"r_cv_dynamic": 0.02, "r_slope_eps": 0.0005, "neg_loopnum_frac": 0.01, "min_anchor_per_month": 3},
    "c_nom_spec": 37.0,
    "channels": [],
    "source_path": None, "data_path": None, "device_filter": None, "model_params_path": None,
}


#: Tables whose keys are names that a user may add to.
OPEN = ("chemistry",)


def merged(base: Mapping[str, Any], over: Mapping[str, Any], at: str = "") -> dict[str, Any]:
    """``over`` laid on ``base``, table by table; a key that ``base`` doesn't know is an error, since nothing would read it."""
    out = dict(base)
    for k, v in over.items():
        if k not in base and at not in OPEN:
            raise ValueError(f"unknown setting: {at}{'.' if at else ''}{k}")
        out[k] = merged(out[k], v, f"{at}{'.' if at else ''}{k}") if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


@dataclass(frozen=True)
class ModelParams:
    """Parameters of one model, as its data sheet gives them."""

    model: str
    chemistry: str
    series: int
    c_nom_spec: float
    v_full: float
    v_cutoff: float
    cell_v_full: float


@dataclass(frozen=True)
class Found:
    """What the profile step decided."""

    chemistry: str | None = None
    series: int | None = None
    r_mode: str = "DYNAMIC"
    route: str = "ABSOLUTE"
    v_full: float | None = None
    v_cutoff: float | None = None
    reversed_devices: tuple[int, ...] = ()
    current_effectively_missing: bool = False
    use_time_window: bool = False
    #: conclusions that rest on too few rows, so that a default or a guess stands in their place
    unsure: tuple[str, ...] = ()

    def settings(self) -> dict[str, Any]:
        """What a settings file would say, for ``read_settings`` and for a user to correct."""
        return {k: v for k, v in (("chemistry", self.chemistry), ("series", self.series)) if v is not None}


def found_of(told: Mapping[str, Any]) -> Found:
    """What ``asdict`` of a Found has written as JSON."""
    lists = {k: tuple(told[k]) for k in ("reversed_devices", "unsure") if k in told}
    return Found(**{**told, **lists})


@dataclass(frozen=True)
class Config:
    values: Mapping[str, Any] = field(default_factory=lambda: DEFAULTS)
    found: Found = Found()
    models: Mapping[str, ModelParams] = field(default_factory=dict)
    ocv_dir: str | None = None

    def ocv_curve(self, chemistry: str | None = None, series: int | None = None) -> Curve:
        """(SOC, cell voltage) of a chemistry, of the user's folder of tables if there is one."""
        return ocv_curve(chemistry or self.chemistry, series or self.series, self.ocv_dir)

    def get(self, path: str, default: Any = None) -> Any:
        """The value at a dotted path."""
        at: Any = self.values
        for part in path.split("."):
            if not isinstance(at, Mapping) or part not in at:
                return default
            at = at[part]
        return at

    @property
    def chemistry(self) -> str:
        return self.found.chemistry or "LFP"

    @property
    def series(self) -> int:
        return self.found.series or 24

    def chem_params(self, name: str | None = None) -> Mapping[str, float]:
        return self.values["chemistry"][name or self.chemistry]

    def v_full(self) -> float:
        return self.found.v_full or self.chem_params()["v_full"]

    def v_cutoff(self) -> float:
        return self.found.v_cutoff or self.chem_params()["v_cutoff"]

    def rest_current(self, c_nom: float | None = None) -> float:
        """Amperes below which a device rests."""
        return self.get("anchor.rest_c_rate") * (c_nom or 40.0)

    def anchor_score(self, kind: str) -> float:
        return self.get(f"quality.score.{kind}", 0.0)

    def anchor_weight(self, kind: str) -> float:
        return self.get(f"quality.weight.{kind}", 0.0)


def validate(values: Mapping[str, Any]) -> None:
    """Fail early on settings that contradict each other."""

    def need(good: bool, why: str) -> None:
        if not good:
            raise ValueError(why)

    for name, p in values["chemistry"].items():
        need(p["v_full"] > p["v_cutoff"], f"{name}: v_full must be above v_cutoff")
        need(p["alpha"] > 0, f"{name}: alpha must be positive")
    a = values["anchor"]
    need(0 < a["soc_empty"] < a["soc_full"] <= a["soc_swap_full"] <= 1, "anchor: 0 < soc_empty < soc_full <= soc_swap_full <= 1")
    need(a["duration_hours"] > 0 and a["gap_hours"] > 0, "anchor: durations must be positive")
    q = values["quality"]
    need(q["tier1_min"] > q["tier2_min"], "quality: tier1_min must be above tier2_min")
    need(set(q["severe_flags"]) <= {"out_of_range", "voltage_inconsistent", "temp_out", "anchor_conflict", "sensor_drift", "contradiction"}, "quality: severe_flags must be flags")
    need({"SWAP_FULL", "EMPTY_END", "FULL_END", "OCV"} <= set(q["score"]), "quality: a score of each anchor type")


def load_config(manual: Mapping[str, Any] | None = None, thresholds: Mapping[str, Any] | None = None, found: Found | None = None, models: Mapping[str, ModelParams] | None = None, ocv_dir: str | None = None) -> Config:
    """Defaults, then the thresholds, then the manual settings, which may also name the chemistry and the number of cells."""
    manual = dict(manual or {})
    own = {k: manual.pop(k) for k, kind in (("chemistry", str), ("series", int)) if isinstance(manual.get(k), kind)}
    manual = {k: v for k, v in manual.items() if v is not None}
    values = merged(merged(DEFAULTS, thresholds or {}), manual)
    validate(values)
    if own.get("chemistry", "LFP") not in values["chemistry"]:
        raise ValueError(f"unknown chemistry: {own['chemistry']}")
    return Config(values, replace(found or Found(), **own), models or {}, ocv_dir)


def read_settings(path: str | Path) -> dict[str, Any]:
    """Settings of a JSON or (if the library is there) YAML file; a missing file is empty."""
    path = Path(path)
    if not path.exists():
        return {}
    if path.suffix == ".json":
        return json.loads(path.read_text(encoding="utf-8"))
    import yaml

    return yaml.safe_load(path.read_text(encoding="utf-8")) or {}


#: Names of the columns and of the chemistries in a model parameter file.
MODEL_COLUMNS = {"model": "电池型号", "chemistry": "电池类型", "series": "电芯数量", "c_nom": "标称容量", "cell_v_full": "单电芯满称电压", "v_full": "电池合计满充电压"}
CHEMISTRY_NAMES = {"铁锂": "LFP", "三元": "NMC", "LFP": "LFP", "NMC": "NMC"}


def ampere_hours(text: str) -> float:
    """'37Ah' -> 37.0"""
    return float(str(text).strip().lower().replace("ah", "").strip())


def read_model_params(path: str | Path, values: Mapping[str, Any] = DEFAULTS) -> dict[str, ModelParams]:
    out = {}
    with open(path, encoding="utf-8-sig", newline="") as f:
        for row in csv.DictReader(f):
            chemistry = CHEMISTRY_NAMES[row[MODEL_COLUMNS["chemistry"]].strip()]
            series = int(row[MODEL_COLUMNS["series"]])
            cutoff = round(series * values["chemistry"][chemistry]["cell_v_cutoff"], 2)
            name = row[MODEL_COLUMNS["model"]].strip()
            out[name] = ModelParams(name, chemistry, series, ampere_hours(row[MODEL_COLUMNS["c_nom"]]), float(row[MODEL_COLUMNS["v_full"]]), cutoff, float(row[MODEL_COLUMNS["cell_v_full"]]))
    return out


#: SOC and cell voltage, point by point.
Curve = tuple[tuple[float, ...], tuple[float, ...]]
#: Tables of open-circuit voltage: fixed values, one row a point of SOC.
OCV_DIR = Path(__file__).resolve().parent / "ocv_tables"


def read_curve(path: str | Path) -> Curve:
    """A table with the columns soc and ocv_v (volts of a cell), sorted by soc and checked."""
    with open(path, encoding="utf-8-sig", newline="") as f:
        rows = csv.DictReader(f)
        if not {"soc", "ocv_v"} <= set(rows.fieldnames or ()):
            raise ValueError(f"{path}: an OCV table needs the columns soc and ocv_v")
        points = sorted((float(r["soc"]), float(r["ocv_v"])) for r in rows)
    soc, volts = tuple(p[0] for p in points), tuple(p[1] for p in points)
    validate_curve(soc, volts)
    return soc, volts


@lru_cache(maxsize=64)
def ocv_curve(chemistry: str, series: int | None = None, folder: str | None = None) -> Curve:
    """The curve of a chemistry: of ``folder`` the table of that number of cells, else that of the chemistry, else our own."""
    name = chemistry.lower()
    tried = [Path(folder) / f"{name}_{series}s.csv", Path(folder) / f"{name}.csv"] if folder else []
    for path in [*tried, OCV_DIR / f"{name}.csv"]:
        if path.exists():
            return read_curve(path)
    raise FileNotFoundError(f"no OCV table for {chemistry}: {', '.join(map(str, tried)) or OCV_DIR}")


def validate_curve(soc: Sequence[float], volts: Sequence[float]) -> None:
    """A curve that can be inverted: five points or more over [0.02, 0.98], SOC rising, voltage not falling."""
    if len(soc) < 5 or len(soc) != len(volts):
        raise ValueError("an OCV curve needs five points or more")
    if min(soc) > 0.02 or max(soc) < 0.98:
        raise ValueError("an OCV curve must cover 0.02 to 0.98")
    if any(b <= a for a, b in zip(soc, soc[1:], strict=False)):
        raise ValueError("SOC must rise strictly")
    if any(b < a for a, b in zip(volts, volts[1:], strict=False)):
        raise ValueError("voltage must not fall")
