"""The variable catalogue: which daily fields exist and how each is made.

One entry per daily output.  The table is small and fixed (68 rows over 43
source variables), so it lives on the driver and enters a query either as
literals inside Column expressions or as a broadcast table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KELVIN_SHIFT = -273.15


@dataclass(frozen=True)
class DailyVariable:
    """A daily output: source column, aggregate kind, shift and CF attributes."""

    name: str
    var_id: str
    agg_kind: str
    offset: float
    short_name: str
    standard_name: str
    units: str
    description: str
    cell_methods: str | None = None
    levelled: bool | None = None

    @property
    def dims(self) -> int:
        """3 with a level dimension, else 2; decided by the source variable unless ``levelled`` says so."""
        levelled = self.var_id in LEVELLED_SOURCES if self.levelled is None else self.levelled
        return 3 if levelled else 2


# Source variables that carry a vertical or soil level.
LEVELLED_SOURCES = frozenset(
    ["dbz", "twb", "rh", "temp", "height", "CLDFRA", "QVAPOR", "u", "v", "w", "SMOIS", "SH2O", "TSLB"]
)

# Name, source variable, aggregate, added constant, short name,
# standard name, units, description, cell methods.
_ROWS = [
    ("t2_mean", "T2", "mean", KELVIN_SHIFT, "t2m", "air_temperature", "degree_C", "Daily mean temperature at 2 meters", "time: mean"),
    ("t2_min", "T2", "min", KELVIN_SHIFT, "t2m", "air_temperature", "degree_C", "Daily minimum temperature at 2 meters", "time: minimum"),
    ("t2_max", "T2", "max", KELVIN_SHIFT, "t2m", "air_temperature", "degree_C", "Daily maximum temperature at 2 meters", "time: maximum"),
    ("rainnc_sum", "rainnc", "sum", 0.0, "prnc", "precipitation_amount", "mm", "Daily accumulated total grid-scale precipitation", "time: sum"),
    ("wspd10_mean", "wspd10", "mean", 0.0, "wspd10m", "wind_speed", "m s-1", "Daily mean 10m wind speed", "time: mean"),
    ("wspd10_max", "wspd10", "max", 0.0, "wspd10m", "wind_speed", "m s-1", "Daily maximum 10m wind speed", "time: maximum"),
    ("wdir10_mean", "wdir10", "circular_mean", 0.0, "wdir10m", "wind_from_direction", "degree", "Daily mean 10m wind direction", "time: mean"),
    ("rh2_mean", "rh2", "mean", 0.0, "rh2m", "relative_humidity", "%", "Daily mean 2m relative humidity", "time: mean"),
    ("rh2_min", "rh2", "min", 0.0, "rh2m", "relative_humidity", "%", "Daily minimum 2m relative humidity", "time: minimum"),
    ("rh2_max", "rh2", "max", 0.0, "rh2m", "relative_humidity", "%", "Daily maximum 2m relative humidity", "time: maximum"),
    ("seaice_max", "SEAICE", "max", 0.0, "siconc", "sea_ice_area_fraction", "1", "Daily maximum sea ice area fraction", "time: maximum"),
    ("slp_mean", "slp", "mean", 0.0, "slp", "air_pressure_at_mean_sea_level", "hPa", "Daily mean sea level pressure"),
    ("ctt_mean", "ctt", "mean", KELVIN_SHIFT, "ctt", "cloud_top_temperature", "degree_C", "Daily mean cloud top temperature"),
    ("ctt_min", "ctt", "min", KELVIN_SHIFT, "ctt", "cloud_top_temperature", "degree_C", "Daily minimum cloud top temperature"),
    ("ctt_max", "ctt", "max", KELVIN_SHIFT, "ctt", "cloud_top_temperature", "degree_C", "Daily maximum cloud top temperature"),
    ("dbz_max", "dbz", "max", 0.0, "dbz", "equivalent_reflectivity_factor", "dBZ", "Daily maximum radar reflectivity"),
    ("q2_mean", "Q2", "mean", 0.0, "q2m", "specific_humidity", "kg kg-1", "Daily mean water vapor mixing ratio at 2 meters"),
    ("psfc_mean", "PSFC", "mean", 0.0, "psfc", "surface_air_pressure", "Pa", "Daily mean surface pressure"),
    ("rh_mean", "rh", "mean", 0.0, "rh", "relative_humidity", "%", "Daily mean relative humidity"),
    ("rh_min", "rh", "min", 0.0, "rh", "relative_humidity", "%", "Daily minimum relative humidity"),
    ("rh_max", "rh", "max", 0.0, "rh", "relative_humidity", "%", "Daily maximum relative humidity"),
    ("temp_mean", "temp", "mean", 0.0, "t", "air_temperature", "K", "Daily mean temperature"),
    ("temp_min", "temp", "min", 0.0, "t", "air_temperature", "K", "Daily minimum temperature"),
    ("temp_max", "temp", "max", 0.0, "t", "air_temperature", "K", "Daily maximum temperature"),
    ("qvapor_mean", "QVAPOR", "mean", 0.0, "q", "specific_humidity", "kg kg-1", "Daily mean water vapor mixing ratio"),
    ("cldfra_mean", "CLDFRA", "mean", 0.0, "cldfra", "cloud_area_fraction", "1", "Daily mean cloud fraction"),
    ("cldfra_max", "CLDFRA", "max", 0.0, "cldfra", "cloud_area_fraction", "1", "Daily maximum cloud fraction"),
    ("u10_mean", "u10", "mean", 0.0, "u10m", "eastward_wind", "m s-1", "Daily mean 10m eastward wind component"),
    ("u10_max", "u10", "max", 0.0, "u10m", "eastward_wind", "m s-1", "Daily maximum 10m eastward wind component"),
    ("v10_mean", "v10", "mean", 0.0, "v10m", "northward_wind", "m s-1", "Daily mean 10m northward wind component"),
    ("v10_max", "v10", "max", 0.0, "v10m", "northward_wind", "m s-1", "Daily maximum 10m northward wind component"),
    ("u_mean", "u", "mean", 0.0, "u", "eastward_wind", "m s-1", "Daily mean eastward wind component"),
    ("u_max", "u", "max", 0.0, "u", "eastward_wind", "m s-1", "Daily maximum eastward wind component"),
    ("v_mean", "v", "mean", 0.0, "v", "northward_wind", "m s-1", "Daily mean northward wind component"),
    ("v_max", "v", "max", 0.0, "v", "northward_wind", "m s-1", "Daily maximum northward wind component"),
    ("w_mean", "w", "mean", 0.0, "w", "upward_air_velocity", "m s-1", "Daily mean vertical wind component"),
    ("w_max", "w", "max", 0.0, "w", "upward_air_velocity", "m s-1", "Daily maximum vertical wind component"),
    ("snow_sum", "SNOW", "sum", 0.0, "swe", "surface_snow_amount", "kg m-2", "Daily accumulated snow water equivalent"),
    ("snowh_mean", "SNOWH", "mean", 0.0, "snowd", "surface_snow_thickness", "m", "Daily mean physical snow depth"),
    ("snowc_max", "SNOWC", "max", 0.0, "snowc", "surface_snow_area_fraction", "1", "Daily maximum snow cover fraction"),
    ("rainc_sum", "rainc", "sum", 0.0, "prc", "convective_rainfall_amount", "mm", "Daily accumulated total cumulus precipitation"),
    ("acsnow_sum", "acsnow", "sum", 0.0, "prsn", "snowfall_amount", "kg m-2", "Daily accumulated snow"),
    ("hfx_sum", "HFX", "sum", 0.0, "hfss", "surface_upward_sensible_heat_flux", "W m-2", "Daily accumulated upward sensible heat flux at the surface"),
    ("lh_sum", "LH", "sum", 0.0, "hfls", "surface_upward_latent_heat_flux", "W m-2", "Daily accumulated latent heat flux at the surface"),
    ("swdnb_sum", "SWDNB", "sum", 0.0, "rsds", "surface_downwelling_shortwave_flux", "W m-2", "Daily accumulated downwelling shortwave flux at surface"),
    ("swdnbc_sum", "SWDNBC", "sum", 0.0, "rsdscs", "surface_downwelling_clear_sky_shortwave_flux", "W m-2", "Daily accumulated downwelling clear sky shortwave flux at surface"),
    ("swupb_sum", "SWUPB", "sum", 0.0, "rsus", "surface_upwelling_shortwave_flux", "W m-2", "Daily accumulated upwelling shortwave flux at surface"),
    ("swupbc_sum", "SWUPBC", "sum", 0.0, "rsuscs", "surface_upwelling_clear_sky_shortwave_flux", "W m-2", "Daily accumulated upwelling clear sky shortwave flux at surface"),
    ("lwdnb_sum", "LWDNB", "sum", 0.0, "rlds", "surface_downwelling_longwave_flux", "W m-2", "Daily accumulated downwelling longwave flux at surface"),
    ("lwdnbc_sum", "LWDNBC", "sum", 0.0, "rldscs", "surface_downwelling_clear_sky_longwave_flux", "W m-2", "Daily accumulated downwelling clear sky longwave flux at surface"),
    ("lwupb_sum", "LWUPB", "sum", 0.0, "rlus", "surface_upwelling_longwave_flux", "W m-2", "Daily accumulated upwelling longwave flux at surface"),
    ("lwupbc_sum", "LWUPBC", "sum", 0.0, "rluscs", "surface_upwelling_clear_sky_longwave_flux", "W m-2", "Daily accumulated upwelling clear sky longwave flux at surface"),
    ("twb_mean", "twb", "mean", 0.0, "twb", "wet_bulb_temperature", "K", "Daily mean wet bulb temperature"),
    ("twb_min", "twb", "min", 0.0, "twb", "wet_bulb_temperature", "K", "Daily minimum wet bulb temperature"),
    ("twb_max", "twb", "max", 0.0, "twb", "wet_bulb_temperature", "K", "Daily maximum wet bulb temperature"),
    ("albedo_mean", "ALBEDO", "mean", 0.0, "al", "surface_albedo", "1", "Daily mean albedo"),
    ("smois_mean", "SMOIS", "mean", 0.0, "mrsos", "volume_fraction_of_water_in_soil_layer", "m3 m-3", "Daily mean soil moisture"),
    ("sh2o_mean", "SH2O", "mean", 0.0, "mrso", "volume_fraction_of_liquid_water_in_soil_layer", "m3 m-3", "Daily mean soil liquid water content"),
    ("tsk_mean", "TSK", "mean", 0.0, "ts", "surface_temperature", "K", "Daily mean surface skin temperature"),
    ("tsk_min", "TSK", "min", 0.0, "ts", "surface_temperature", "K", "Daily minimum surface skin temperature"),
    ("tsk_max", "TSK", "max", 0.0, "ts", "surface_temperature", "K", "Daily maximum surface skin temperature"),
    ("tslb_mean", "TSLB", "mean", 0.0, "tsl", "soil_temperature", "K", "Daily mean soil temperature"),
    ("tslb_min", "TSLB", "min", 0.0, "tsl", "soil_temperature", "K", "Daily minimum soil temperature"),
    ("tslb_max", "TSLB", "max", 0.0, "tsl", "soil_temperature", "K", "Daily maximum soil temperature"),
    ("sst_mean", "SST", "mean", 0.0, "tos", "sea_surface_temperature", "K", "Daily mean sea surface temperature"),
    ("sst_min", "SST", "min", 0.0, "tos", "sea_surface_temperature", "K", "Daily minimum sea surface temperature"),
    ("sst_max", "SST", "max", 0.0, "tos", "sea_surface_temperature", "K", "Daily maximum sea surface temperature"),
    ("height_mean", "height", "mean", 0.0, "zg", "geopotential_height", "m", "Daily mean geopotential height"),
]

CATALOG: dict[str, DailyVariable] = {row[0]: DailyVariable(*row) for row in _ROWS}

# The outputs that the point series and the normals are made for by default.
PRIORITY_VARIABLES = [
    "t2_max", "t2_min", "t2_mean", "rainnc_sum", "wdir10_mean", "wspd10_mean",
    "wspd10_max", "rh2_max", "rh2_min", "rh2_mean", "seaice_max",
]

SCHEMA = (
    "position int, name string, var_id string, short_name string, standard_name string, units string, "
    "agg_kind string, description string, cell_methods string, offset double, dims int"
)


def lookup(name: str) -> DailyVariable:
    """The catalogue entry of ``name``; an unknown name is an error."""
    try:
        return CATALOG[name]
    except KeyError:
        known = ", ".join(list(CATALOG)[:10])
        raise ValueError(f"unknown variable {name!r}; known names start with: {known}, ...") from None


def resolve(names: Iterable[str | DailyVariable]) -> list[DailyVariable]:
    """Entries for a request: names are looked up, ready-made entries pass through."""
    return [n if isinstance(n, DailyVariable) else lookup(n) for n in names]


def source_variables(names: Iterable[str | DailyVariable]) -> list[str]:
    """Distinct source variables that a request needs; unknown names are ignored."""
    return list(dict.fromkeys(e.var_id for e in resolve(n for n in names if isinstance(n, DailyVariable) or n in CATALOG)))


def catalog_frame(spark: SparkSession, names: Iterable[str | DailyVariable] | None = None) -> DataFrame:
    """The catalogue (or a part of it) as a table, with its listing position."""
    entries = resolve(CATALOG if names is None else names)
    rows = [
        (i, e.name, e.var_id, e.short_name, e.standard_name, e.units, e.agg_kind,
         e.description, e.cell_methods, e.offset, e.dims)
        for i, e in enumerate(entries)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def is_levelled(var_id: Column) -> Column:
    """Whether a source variable has a level dimension."""
    return var_id.isin(sorted(LEVELLED_SOURCES))


def with_catalog(df: DataFrame, on: str = "var_id", how: str = "inner") -> DataFrame:
    """Attach catalogue attributes; ``on`` is ``var_id`` or ``name``.  The table has 68 rows, so it is broadcast."""
    return df.join(F.broadcast(catalog_frame(df.sparkSession)), on, how)


def unknown_names(df: DataFrame, column: str, against: str = "name") -> DataFrame:
    """Rows whose ``column`` is not in the catalogue."""
    known = catalog_frame(df.sparkSession).select(F.col(against).alias(column)).distinct()
    return df.join(F.broadcast(known), column, "left_anti")


def suggestions(requested: Column) -> Column:
    """Catalogue names that contain the request or are contained in it, in catalogue order."""
    wanted = F.lower(requested)
    names = F.array(*[F.lit(n) for n in CATALOG])
    return F.filter(names, lambda n: F.contains(F.lower(n), wanted) | F.contains(wanted, F.lower(n)))


def request_report(df: DataFrame, column: str) -> DataFrame:
    """One row per distinct request: whether it is known, and the message a user should see."""
    c = F.col(column)
    quoted = F.concat(F.lit("'"), c, F.lit("' "))
    similar = F.array_join(suggestions(c), ", ")
    found = c.isin(list(CATALOG))
    message = (
        F.when(c.isNull() | (c == ""), F.lit("empty request"))
        .when(found, F.concat(quoted, F.lit("is in the catalogue")))
        .when(similar != "", F.concat(quoted, F.lit("is unknown; similar names: "), similar))
        .otherwise(F.concat(quoted, F.lit("is unknown")))
    )
    return df.select(column).distinct().select(
        column, F.coalesce(found, F.lit(False)).alias("is_valid"), message.alias("message")
    )
