"""Configuration: a flat set of keys, from YAML or a dict, with overrides."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields, replace
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    pass


def _yaml():
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("YAML files need PyYAML") from e
    return yaml


@dataclass(frozen=True)
class Config:
    """Keys that this engine acts on; those that only set up external tools are kept so that existing files load.

    Fixed values: the keys' names, their defaults and the columns to drop are those of existing files; rescoring_seed is this engine's own."""

    run_rescoring: bool = True
    run_psa: bool = True
    run_iforest: bool = True
    run_postprocess: bool = True
    run_plotting: bool = True
    outdir: str = "results"
    database_search_path: str | None = None
    denovo_search_path: str | None = None
    rawdata_path: str | None = None
    database_search_type: str = "Msfragger"
    denovo_search_type: str = "Casanovo"
    spectra_type: str = "mzML"
    database_oktoberfest_dir: str | None = None
    denovo_oktoberfest_dir: str | None = None
    denovo_only: bool = False
    irt_model: str = "Prosit_2019_irt"
    intensity_model: str = "Prosit_2020_intensity_HCD"
    prediction_server: str | None = None
    fdr_estimation_method: str = "percolator"
    all_features: bool = False
    regression_method: str = "spline"
    ssl: bool = True
    thermo_exe: str | None = None
    mass_tolerance: float = 20
    p_window: float = 1.2
    unit_mass_tolerance: str = "ppm"
    fragmentation_method: str = "HCD"
    num_threads: int | None = None
    drop_columns_database: str = "lda_scores annotated_ions delta_mass_ppm log10_evalue next_score collision_energy_aligned"
    drop_columns_denovo: str = "lda_scores collision_energy_aligned"
    percolator_exe: str = "percolator"
    percolator_module: str = ""
    percolator_threads: int = 3
    percolator_subset_max_train: int = 100000
    percolator_test_fdr: float = 0.01
    percolator_train_fdr: float = 0.01
    percolator_verbose: int = 3
    rescoring_seed: int = 1
    psa_max_raw_files: int | None = None
    overwrite_outputs: bool = False
    psa_max_workers: int | None = None
    iforest_features: list[str] = field(default_factory=list)
    iforest_training_source: str = "percolator_percentile"
    iforest_denovo_score_threshold: float = 0.9
    iforest_seed: int = 0
    grove_forest_dir: str | None = None
    iforest_output_dir: str | None = None

    @classmethod
    def from_dict(cls, values: dict[str, Any] | None) -> Config:
        unknown = sorted(set(values or {}) - {f.name for f in fields(cls)})
        if unknown:
            raise ConfigError(f"unknown configuration keys: {', '.join(unknown)}")
        return cls(**(values or {}))

    @classmethod
    def from_yaml(cls, path: str | Path) -> Config:
        return cls.from_dict(_yaml().safe_load(Path(path).read_text()))

    def with_overrides(self, pairs: list[str]) -> Config:
        """key=value texts, split at the first sign, values typed as YAML."""
        found = {}
        for p in pairs:
            key, sign, value = p.partition("=")
            if not sign:
                raise ConfigError(f"{p!r} is not key=value")
            if key not in {f.name for f in fields(self)}:
                raise ConfigError(f"unknown configuration key: {key}")
            found[key] = _yaml().safe_load(value)
        return replace(self, **found)

    def to_yaml(self, path: str | Path) -> None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(_yaml().safe_dump(asdict(self), sort_keys=False))

    def require(self, *keys: str) -> None:
        missing = [k for k in keys if not getattr(self, k)]
        if missing:
            raise ConfigError(f"these keys need a value: {', '.join(missing)}")

    def check(self) -> None:
        if self.run_psa and not self.run_rescoring:
            raise ConfigError("run_psa needs run_rescoring: the scan table is made from its merged branches")
        if self.iforest_training_source not in ("percolator_percentile", "denovo_score"):
            raise ConfigError(f"unknown iforest_training_source {self.iforest_training_source!r}")
        if self.denovo_only and (self.run_iforest or self.run_postprocess) and self.iforest_training_source != "denovo_score":
            raise ConfigError("denovo_only has no database scores: set iforest_training_source to denovo_score")
