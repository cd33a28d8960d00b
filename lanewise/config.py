"""Everything a run can be told: paths, dates, lists and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------------------------------
# Fixed values. These lists, names and numbers define the results; they are the defaults of the classes below.

CORE_SITES = (
    "AVP1", "AVP2", "CFC1", "CLT1", "DAY1", "DFW1", "EFC3", "MCI1", "MCO1", "MDT1", "PHX1", "RNO1", "WFC2", "BNA1",
)
LATE_PULL_SITES = ("AVP2", "MCI1", "RNO1", "BNA1")
LATE_PULL_HOURS = 5
EARLY_PULL_HOURS = 3
NIGHT_PULL_BEFORE = "04:00:00"

TRAILING_VALUES = ("STD_ACTUAL_VATTEMPTED",)
TRAILING_GROUPS = (
    ("SHIPPED_DOW", "FFMCENTER_NAME", "CUSTOMER_STATE"),
    ("SHIPPED_DOW", "SHIPMENT_SHIP_ROUTE"),
    ("SHIPPED_DOW", "ACTUAL_ZONE"),
)
TRAILING_RANGES = ((-28, -1), (-7, -1))

DISTANCE_BOUNDS = (250, 500, 1000, 1500, 2000, 3000)
WEEKEND_LABELS = {5: "friday", 6: "saturday"}
TRANSIT_LIMIT = 11

ORDER_COLUMNS = (
    "order_id", "shipment_tracking_number", "ffmcenter_name", "fc_type", "uom_flag", "carrier_code",
    "customer_postcode", "customer_zip3", "customer_state", "shipment_delivery_date",
    "initial_shipment_delivery_attempt_date", "shipment_shipped_date", "holiday_flag", "shipped_fri_sat_tag",
    "shipped_dow", "is_after_cpt", "hours_till_cpt", "warehouse_expected_weight", "package_size", "adjtnt",
    "nextadjtnt", "std_v0",
)
TRAILING_COLUMNS = (
    "avg_-28_-1_std_actual_vattempted_shipped_dow_shipment_ship_route",
    "avg_-7_-1_std_actual_vattempted_shipped_dow_shipment_ship_route",
    "avg_-28_-1_std_actual_vattempted_shipped_dow_actual_zone",
    "avg_-7_-1_std_actual_vattempted_shipped_dow_actual_zone",
    "avg_-28_-1_std_actual_vattempted_shipped_dow_ffmcenter_name_customer_state",
    "avg_-7_-1_std_actual_vattempted_shipped_dow_ffmcenter_name_customer_state",
)
ROUTE_COLUMNS = ("shipment_ship_route", "arc_range", "distance_mi", "actual_zone", "routetype", *TRAILING_COLUMNS)
TARGET_COLUMNS = ("std_actual", "std_actual_vattempted")
ENCODED_COLUMNS = (
    "ffmcenter_name", "fc_type", "holiday_flag", "shipped_fri_sat_tag", "carrier_code", "shipped_dow", "routetype",
)

DATE_RANGES = {"train_val": ("2023-01-01", "2023-06-01"), "test": ("2023-06-01", "2023-08-01")}

WEEKDAY_COLUMNS = tuple(f"shipped_dow_{day}" for day in range(7))
FEATURES = (
    "uom_flag", "customer_state", "is_after_cpt", "hours_till_cpt", "package_size", "adjtnt", "nextadjtnt",
    "distance_mi", "actual_zone", *TRAILING_COLUMNS, *WEEKDAY_COLUMNS,
)
STACK_FEATURES = ("customer_state", "distance_mi", "std_v0", *WEEKDAY_COLUMNS)
WIDE_GRID = {
    "max_depth": (6, 7, 8),
    "step_size": (0.15, 0.1),
    "row_fraction": (0.7,),
    "column_fraction": (0.6, 0.65),
}
NARROW_GRID = {"max_depth": (8,), "step_size": (0.1,), "row_fraction": (0.7,), "column_fraction": (0.6,)}
REPORT_COLUMNS = (
    "order_id", "shipment_tracking_number", "ffmcenter_name", "fc_type", "uom_flag", "carrier_code",
    "customer_postcode", "customer_zip3", "customer_state", "shipment_delivery_date",
    "initial_shipment_delivery_attempt_date", "shipment_shipped_date", "holiday_flag", "shipped_fri_sat_tag",
    "shipped_dow", "is_after_cpt", "hours_till_cpt", "warehouse_expected_weight", "package_size", "adjtnt",
    "nextadjtnt", "std_v0", "shipment_ship_route", "arc_range", "distance_mi", "actual_zone", "std_actual",
    "std_actual_vattempted", "tag", "ensemble_pred", "ensemble_pred_rounded", "ml_pred", "ml_pred_rounded",
    "routetype",
)
# ---------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BoostParams:
    """Boosted regression trees. `rounds` is the number of trees."""

    rounds: int = 100
    max_depth: int = 8
    step_size: float = 0.1
    row_fraction: float = 0.7
    column_fraction: float = 0.6
    max_bins: int = 256
    max_memory_mb: int = 512
    seed: int = 7


@dataclass(frozen=True)
class PipelineConfig:
    """One run. The defaults give the standard features and models; paths have none."""

    output_root: str | None = None
    run_tag: str = "run"
    output_files: int | None = None
    allow_fan_out: bool = False  # do not end the job where a package has several rows

    core_sites: tuple[str, ...] | None = None  # sites whose offers count, as CORE_SITES; None: all
    late_pull_sites: tuple[str, ...] = ()  # as LATE_PULL_SITES
    late_pull_hours: int = LATE_PULL_HOURS
    early_pull_hours: int = EARLY_PULL_HOURS
    night_pull_before: str = NIGHT_PULL_BEFORE
    trailing_values: tuple[str, ...] = TRAILING_VALUES
    trailing_groups: tuple[tuple[str, ...], ...] = TRAILING_GROUPS
    trailing_ranges: tuple[tuple[int, int], ...] = TRAILING_RANGES
    trailing_stat: str = "avg"
    trailing_default: float = 1.0
    distance_bounds: tuple[float, ...] = DISTANCE_BOUNDS
    weekend_labels: dict[int, str] = field(default_factory=lambda: dict(WEEKEND_LABELS))
    route_type_default: str = "Others"
    lookup_spread: int = 1
    lookup_hot_share: float | None = None  # find keys with this share of the rows, and divide those alone

    transit_limit: int = TRANSIT_LIMIT
    model_columns: tuple[str, ...] = (*ORDER_COLUMNS, *ROUTE_COLUMNS, *TARGET_COLUMNS)
    encoded_columns: tuple[str, ...] = ENCODED_COLUMNS
    max_encoded_values: int | None = None
    encoded_domain: dict[str, tuple] = field(default_factory=dict)  # values of columns not to be read off the data
    date_ranges: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(DATE_RANGES))

    label: str = "std_actual_vattempted"
    features: tuple[str, ...] = FEATURES
    stack_features: tuple[str, ...] = STACK_FEATURES
    categorical: tuple[str, ...] = ("customer_state",)
    boost: BoostParams = BoostParams()
    stack_boost: BoostParams = BoostParams(max_depth=15, step_size=0.2)
    grid: dict[str, tuple] = field(default_factory=dict)  # empty: train with `boost`; else search, as WIDE_GRID
    folds: int = 3
    out_of_fold: int | None = None  # parts in which the first model scores rows for the second without having seen them
    report_columns: tuple[str, ...] = REPORT_COLUMNS

    def __post_init__(self):
        """Model columns and features name the trailing columns that these settings produce."""
        made = tuple(
            "_".join([self.trailing_stat, *map(str, days), value, *group]).lower()
            for group in self.trailing_groups
            for days in self.trailing_ranges
            for value in self.trailing_values
        )
        if set(made) != set(TRAILING_COLUMNS):
            for name in ("model_columns", "features"):
                given = getattr(self, name)
                first = next((i for i, column in enumerate(given) if column in TRAILING_COLUMNS), None)
                if first is not None:
                    kept = [column for column in given[first:] if column not in TRAILING_COLUMNS and column not in made]
                    object.__setattr__(self, name, (*(c for c in given[:first] if c not in made), *made, *kept))

    def path(self, *parts: str) -> str:
        """A path under the output root, in this run's folder."""
        if self.output_root is None:
            raise ValueError("output_root is not set")
        return "/".join([self.output_root.rstrip("/"), *parts, self.run_tag])

    @property
    def reporting_path(self) -> str:
        return self.path("reporting", "data")

    @property
    def enriched_path(self) -> str:
        return self.path("enrich")

    @property
    def prediction_path(self) -> str:
        return self.path("reporting", "model_out")

    def set_path(self, name: str) -> str:
        """Folder of a train or test set, named with its dates."""
        start, end = self.date_ranges[name]
        return f"{self.path('model_sets')}/{name}_{start}_{end}"
