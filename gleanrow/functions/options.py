"""All tunable values in one place."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Options:
    """Fixed default values of the record-linkage and fusion rules; every one may be overridden."""

    relaxed_distance_m: float = 250.0
    relaxed_name: float = 70.0
    strict_distance_m: float = 100.0
    strict_name: float = 80.0
    amenity_jaccard: float = 0.6
    match_name: float = 72.0
    batch_distance_m: float = 50.0
    batch_name: float = 70.0
    sigma_geocoded: float = 25.0
    sigma_address: float = 50.0
    sigma_vague: float = 150.0
    sigma_fuzzed: float = 100.0
    sigma_exact: float = 15.0
    history_sigma_a: float = 60.0
    history_sigma_b: float = 100.0
    stack_min: int = 3
    outlier_m: float = 1000.0
    min_sigma: float = 10.0
    exact_max_sigma: float = 40.0
    disagreement_m: float = 1000.0
    max_drift_m: float = 2000.0
    calibration_low: float = 0.6
    calibration_high: float = 1.4
    calibration_min_n: int = 30
    max_retries: int = 5
    ron_per_eur: float = 4.97
    refine_threshold: float = 0.9
    max_resolution: int = 10
    cap_a: int = 250
    cap_b: int = 280
    namespaced_keys: bool = False
    exact_radius: bool = False
    #: Pairs that one cell may compare before names part its rows; candidate pairs of a component that one task clusters;
    #: equal rows for which one stands while groups are formed; pairs of points of a key that are compared one by one.
    #: None of them changes a result.
    crowd: int = 1 << 22
    component_pairs: int = 100_000
    equal_rows: int = 32
    key_pairs: int = 1 << 20

    @classmethod
    def load(cls, *paths: str) -> Options:
        """From YAML files, later ones first in rank; what none of them names keeps its default.

        A file may hold option names at its top level, or the sections of SECTIONS; other sections and
        names in them (of data collection, say) are left alone, unknown names at the top level are errors.
        """
        import yaml

        given: dict[str, object] = {}
        names = {x.name for x in fields(cls)}
        for path in paths:
            with open(path, encoding="utf-8") as f:
                content = yaml.safe_load(f) or {}
            for key, value in content.items():
                if isinstance(value, dict):
                    of = SECTIONS.get(key, {})
                    given |= {of[k][0]: v * of[k][1] if of[k][1] != 1 else v for k, v in value.items() if k in of}
                elif key in names:
                    given[key] = value
                elif key not in PLAIN:
                    raise ValueError(f"unknown option: {key}")
        return cls(**given)


#: Names of a configuration file's sections, the option that each sets, and its unit in ours.
SECTIONS: dict[str, dict[str, tuple[str, float]]] = {
    "grid": {"refine_threshold": ("refine_threshold", 1), "max_refine_resolution": ("max_resolution", 1)},
    "booking": {"results_cap": ("cap_a", 1)},
    "airbnb": {"results_cap": ("cap_b", 1)},
    "currency": {"ron_to_eur_rate": ("ron_per_eur", 1)},
    "geocoding": {"max_retries": ("max_retries", 1), "max_geocode_drift_km": ("max_drift_m", 1000)},
    "dedup": {
        "operator_relaxed_distance_m": ("relaxed_distance_m", 1), "strict_distance_m": ("strict_distance_m", 1),
        "strict_name_threshold": ("strict_name", 1),
    },
    "fusion": {
        "sigma_geocoded_m": ("sigma_geocoded", 1), "sigma_booking_address_m": ("sigma_address", 1), "sigma_vague_m": ("sigma_vague", 1),
        "sigma_airbnb_m": ("sigma_fuzzed", 1), "disagreement_km": ("disagreement_m", 1000), "exact_max_sigma_m": ("exact_max_sigma", 1),
    },
}
#: Names at the top level that say what a file is about.
PLAIN = ("city", "country")
