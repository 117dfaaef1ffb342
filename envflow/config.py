"""Domain constants and small specs.

Fixed values: these must stay equal to the reference pipeline's for results
to agree (feature names and order, label bands, class names, metric names,
city coordinates, excluded columns).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must equal the reference) --------------------------------
FEATURES = [
    "pm2_5",
    "pm10",
    "carbon_monoxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
    "us_aqi",
    "european_aqi",
]
TARGET = "air_quality_label"
EXCLUDE_COLUMNS = ["city", "latitude", "longitude", "timezone", "timestamp", "parameter"]
PARAMETER_CONSTANT = "pm2_5"
UNKNOWN_LABEL = "unknown"
# AQI series are integral (bigint) in the curated table
INTEGRAL_FEATURES = ["us_aqi", "european_aqi"]

# three-band label on pm2_5: < 12 good, < 35.4 moderate, else unhealthy
THREE_BAND = ((12.0, "good"), (35.4, "moderate"), (None, "unhealthy"))
# documented five-band ladder: < 12, < 35, < 55, < 150, else hazardous
FIVE_BAND = (
    (12.0, "good"),
    (35.0, "moderate"),
    (55.0, "unhealthy"),
    (150.0, "very_unhealthy"),
    (None, "hazardous"),
)


# city dimension: name -> (latitude, longitude)
CITIES = {
    "Buenos_Aires": (-34.6037, -58.3816),
    "Santiago": (-33.4489, -70.6693),
    "Lima": (-12.0464, -77.0428),
    "Bogota": (4.7110, -74.0721),
    "Mexico_City": (19.4326, -99.1332),
    "Sao_Paulo": (-23.5505, -46.6333),
}


# scoring request rules: six required non-negative, two optional in [0, 500]
REQUIRED_NON_NEGATIVE = FEATURES[:6]
OPTIONAL_AQI = FEATURES[6:]
AQI_MIN, AQI_MAX = 0, 500
BATCH_MIN, BATCH_MAX = 1, 1000
FEED_LIMIT_MAX = 10000

# defaults
FEATURE_TTL_DAYS = 7
SPLIT_SEED = 42
TRAIN_FRACTION_PCT = 70
N_SELECT = 5
TUNE_TRIALS = 20
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DriftSpec:
    """What a drift run compares and how it decides.

    ``numeric_test`` is ``wasserstein``, ``ks`` or ``psi``, ``categorical_test``
    ``jensenshannon`` or ``chisquare``; ``tests`` holds (column, test) pairs for
    columns with a test of their own.
    """

    numerical: tuple = tuple(FEATURES)
    categorical: tuple = ()
    numeric_test: str = "wasserstein"
    categorical_test: str = "jensenshannon"
    tests: tuple = ()
    ks_pvalue: float = 0.05
    wasserstein_threshold: float = 0.1
    js_threshold: float = 0.1
    chi2_pvalue: float = 0.05
    psi_threshold: float = 0.2
    psi_bins: int = 10
    dataset_share: float = 0.5
    # quantile buckets for the distributed running sums
    prefix_buckets: int = 64

    def __post_init__(self):
        numeric, categorical = {"wasserstein", "ks", "psi"}, {"jensenshannon", "chisquare"}
        if self.numeric_test not in numeric or self.categorical_test not in categorical:
            raise ValueError(f"unknown test: {self.numeric_test}, {self.categorical_test}")
        for column, test in self.tests:
            allowed = categorical if column in self.categorical else numeric if column in self.numerical else numeric | categorical
            if test not in allowed:
                raise ValueError(f"{test!r} is no test for {column!r}")


@dataclass(frozen=True)
class FeatureView:
    """A named set of typed feature columns keyed by an entity, with TTL."""

    name: str
    entity: str
    timestamp_field: str
    ttl_seconds: int
    schema: tuple  # ((column, spark type string), ...)
    tiebreak: tuple = ()

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in self.schema]


@dataclass(frozen=True)
class FeatureService:
    name: str
    view: FeatureView
    columns: tuple = field(default=())

    def selected(self) -> list[str]:
        return list(self.columns) if self.columns else self.view.columns


def air_quality_view(entity: str = "city", ts: str = "timestamp", tiebreak=("fetch_timestamp",)) -> FeatureView:
    """The hourly air-quality view: pollutants float, AQI bigint, coords double, label string."""
    schema = tuple(
        [(c, "float") for c in FEATURES[:6]]
        + [(c, "bigint") for c in FEATURES[6:]]
        + [("latitude", "double"), ("longitude", "double"), (TARGET, "string")]
    )
    return FeatureView(
        name="air_quality_hourly",
        entity=entity,
        timestamp_field=ts,
        ttl_seconds=FEATURE_TTL_DAYS * 86400,
        schema=schema,
        tiebreak=tuple(tiebreak),
    )


def training_service(view: FeatureView) -> FeatureService:
    return FeatureService("air_quality_training", view)


def inference_service(view: FeatureView) -> FeatureService:
    return FeatureService("air_quality_inference", view, tuple(FEATURES))
