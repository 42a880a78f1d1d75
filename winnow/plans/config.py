"""Settings, environments and presets."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

STRATEGIES = ("mean", "median", "most_frequent")


@dataclass(frozen=True)
class Config:
    """How to clean a table. Column lists left at None are found from the data."""

    numerical: tuple[str, ...] | None = None
    categorical: tuple[str, ...] | None = None
    dates: tuple[str, ...] | None = None
    date_formats: tuple[tuple[str, str], ...] = ()
    exact_dates: bool = False
    single_floats: bool = False
    max_categories: int = 1000
    drop_threshold: float = 0.7
    impute_strategy: str = "median"
    categorical_impute: str = "mode"
    compat: bool = False
    outlier_factor: float = 1.5
    clip_method: str = "iqr"
    exact: bool = True    # False: medians and quartiles by sketch, two scans fewer
    preview_rows: int = 10
    order_by: str | None = None

    def __post_init__(self):
        if self.impute_strategy not in STRATEGIES:
            raise ValueError(f"impute_strategy must be one of {STRATEGIES}")
        if not 0 <= self.drop_threshold <= 1:
            raise ValueError("drop_threshold is a share between 0 and 1")
        if self.clip_method not in ("iqr", "remove", "winsorize"):
            raise ValueError("clip_method must be iqr, remove or winsorize")

    def with_(self, **changes) -> "Config":
        return replace(self, **changes)

    def to_dict(self) -> dict:
        return asdict(self)


# Environments and presets.
ENVIRONMENTS = {
    "development": Config(drop_threshold=0.5, preview_rows=5),
    "production": Config(drop_threshold=0.8),
    "test": Config(preview_rows=3),
}
PRESETS = {
    "balanced": Config(outlier_factor=1.5, drop_threshold=0.5, impute_strategy="median", preview_rows=10),
    "aggressive": Config(outlier_factor=2.0, drop_threshold=0.3, impute_strategy="most_frequent", preview_rows=5),
    "conservative": Config(outlier_factor=1.2, drop_threshold=0.7, impute_strategy="mean", preview_rows=20),
}
ALIASES = {"dev": "development", "prod": "production"}


def environment(name: str = "development") -> Config:
    """Settings of an environment by its name or short name; unknown names raise."""
    key = ALIASES.get(name.lower(), name.lower())
    if key not in ENVIRONMENTS:
        raise ValueError(f"unknown environment {name!r}; known are {', '.join(ENVIRONMENTS)}")
    return ENVIRONMENTS[key]


def preset(name: str) -> Config:
    return PRESETS[name]
