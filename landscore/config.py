"""Parameters and fixed values of the environmental analysis."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class MetricRun:
    """One metric's tables: its column, the window and trend in years, score bins, and a tag for the file names. source: which
    input it comes from; part: cond or stress, if its score of the window's sum goes into the final table."""

    metric: str
    source: str = "yearly"
    window: int = 5
    trend: int | None = 2
    bins: tuple[float, ...] = (-float("inf"), -1, 0, float("inf"))
    reverse: bool = False
    nobaseline: bool = False
    scored: bool = True
    tag: str = ""
    part: str | None = None


_SOIL = (-1, 0.25, 0.5, 1)

#: The metrics and how they are summarised.
RUNS = (
    MetricRun("water+wet_median", part="stress"),
    MetricRun("pv_median"),
    MetricRun("npv_median"),
    MetricRun("npv+pv+wet_median", part="cond"),
    MetricRun("bs_median", reverse=True),
    MetricRun("water+wet_median", window=1, trend=None),
    MetricRun("pv_median", window=1, trend=None),
    MetricRun("water+wet_median", window=1, trend=None, nobaseline=True, scored=False, tag="_INUNDATION"),
    MetricRun("water+wet_max", window=1, trend=None, nobaseline=True),
    MetricRun("NDVI", source="ndvi", part="cond"),
    MetricRun("NDVI", source="ndvi_z", nobaseline=True, tag="_z"),
    MetricRun("NDVI", source="ndvi", window=1, trend=None),
    MetricRun("soilmoist", source="soil", bins=_SOIL, nobaseline=True, part="stress"),
    MetricRun("soilmoist", source="soil", window=1, trend=None, bins=_SOIL, nobaseline=True),
)


@dataclass(frozen=True)
class EngineConfig:
    """first_year and last_year are inclusive; drought years are left out of baselines. files: paths under input_dir of the
    polygons, the aggregators' layers (by name) and the tables yearly, finals, events, ndvi_old, ndvi_new, soil; what has no
    file is left out. A table's runs leave out metrics it doesn't have."""

    first_year: int = 1987
    last_year: int = 2020
    drought: tuple[int, ...] = tuple(range(2001, 2010))
    window: int = 5
    runs: tuple[MetricRun, ...] = RUNS
    files: dict[str, str] = field(default_factory=dict)
    type_column: str = "ANAE_TYPE"
    area_column: str = "Area_Ha"
    cell: float = 10_000.0
    input_dir: str = "."
    output_dir: str = "."


@dataclass(frozen=True)
class AggregatorSpec:
    """A way to sum fine units up: unit_cols name the coarse unit (none: one basin); identity keeps the fine units."""

    name: str
    unit_cols: tuple[str, ...] = field(default=())
    identity: bool = False


#: Coarse units and their key columns.
AGGREGATORS = (
    AggregatorSpec("ANAE", ("UID",), identity=True),
    AggregatorSpec("DTwaterbirds", ("LABEL",)),
    AggregatorSpec("DIWA", ("WNAME",)),
    AggregatorSpec("Ramsar", ("RAMSAR_NAM", "WETLAND_NA")),
    AggregatorSpec("Valley", ("BWS_Region",)),
    AggregatorSpec("Basin"),
    AggregatorSpec("analogue", ("analogue",)),
)

#: Days since the last inundation at which a vegetation group's stress score changes.
VEGETATION_DAYS = {
    "river red gum swamps and forests": (0, 730, 1825),
    "river red gum woodland": (0, 1460, 2555),
    "black box": (0, 1460, 2555),
    "cooba": (0, 1460, 2555),
    "coolibah": (0, 3650, 7300),
    "lignum": (0, 1095, 2555),
    "shrubland": (0, 1095, 3650),
    "submerged lake": (0, 90, 120),
    "tall reed beds": (0, 365, 730),
    "grassy meadows": (0, 240, 300),
    "herbfield": (0, 365, 1460),
    "clay pan": (0, 3650, 7300),
}

#: The same for waterbird habitat.
HABITAT_DAYS = {
    "river red gum swamps and forests": (0, 365, 1460),
    "river red gum woodland": (0, 365, 1460),
    "black box": (0, 365, 1460),
    "cooba": (0, 1460, 2555),
    "shrubland": (0, 1095, 3650),
    "coolibah": (0, 365, 1460),
    "lignum": (0, 365, 1460),
    "submerged lake": (0, 365, 1095),
    "tall reed beds": (0, 365, 1460),
    "grassy meadows": (0, 365, 1460),
    "herbfield": (0, 365, 1460),
    "clay pan": (0, 365, 1460),
}

#: The habitats of each waterbird group.
BIRD_HABITATS = {
    "Aerial_divers": ("submerged lake",),
    "Colonial_nesters": ("river red gum swamps and forests",),
    "Cryptic_waders": ("herbfield", "tall reed beds"),
    "Diving_swimmers": ("river red gum swamps and forests",),
    "Filtering": ("river red gum swamps and forests",),
    "Grazing_swimmers": ("river red gum swamps and forests",),
    "Shorebirds": ("submerged lake",),
}

#: Surveys that cover whole units.
BIG_SURVEYS = ("Murray Icon", "SEA", "CLLMM", "Eastern Australian Survey", "Hydrological Indicator Sites")

#: Patterns of type names and the group they give; of several that match, the last one in this list holds.
TYPE_RULES = (
    ("river red gum", "river red gum swamps and forests"),
    ("river red gum.*woodland|woodland.*river red gum", "river red gum woodland"),
    ("black box", "black box"),
    ("coolibah", "coolibah"),
    ("lignum", "lignum"),
    ("cooba", "cooba"),
    ("F2.4: shrubland riparian zone or floodplain", "shrubland"),
    ("permanent lake|permanent wetland|aquatic bed", "submerged lake"),
    ("tall emergent marsh", "tall reed beds"),
    ("grass|meadow", "grassy meadows"),
    ("forb marsh|temporary wetland|temporary lake", "herbfield"),
    ("clay", "clay pan"),
)
