"""A whole run: hourly fields to daily fields, normals, anomalies, index tables and annual extremes.

Every stage is a lazy DataFrame; what a request doesn't need is never planned.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.functions import bands, physics
from isohyet.functions.calendar import local_day
from isohyet.operators import annual, daily, indices, normals, periods
from isohyet.operators.regions import if_small
from isohyet.plans.config import ACCUMULATED, Settings

log = logging.getLogger(__name__)

RAIN, TEMPERATURE = {"tp"}, {"t2m"}
PET_FULL = {"t2m", "d2m", "u10", "v10", "ssrd", "sp"}
AGROMET = {"t2m", "d2m", "u10", "v10"}
#: What each index needs. Demand can come from temperatures alone.
NEEDS: dict[str, set[str]] = {
    **dict.fromkeys(("spi", "pni", "imd-departure", "weekly", "fortnightly", "decile", "czi", "rai", "pci"), RAIN),
    **dict.fromkeys(("spei", "ai", "water-balance"), RAIN | TEMPERATURE),
    "eddi": TEMPERATURE,
    "temperature": TEMPERATURE,
    "extremes": RAIN,
}
EXTREMES = ("cdd", "cwd", "r95p", "sdii")


def wanted_indices(requested: Sequence[str], variables: Sequence[str]) -> tuple[list[str], dict[str, set[str]]]:
    """(to compute, what the others lack). 'all' stands for every index; an unknown name is a ValueError."""
    names = list(NEEDS) if "all" in requested else list(dict.fromkeys(requested))
    unknown = [n for n in names if n not in NEEDS]
    if unknown:
        raise ValueError(f"unknown indices: {', '.join(unknown)}")
    lacks = {n: NEEDS[n] - set(variables) for n in names if NEEDS[n] - set(variables)}
    for n, what in lacks.items():
        log.warning("%s skipped: no %s", n, ", ".join(sorted(what)))
    return [n for n in names if n not in lacks], lacks


@dataclass
class Run:
    """``hourly``: (cell, ts, and a column per variable in raw units); ``cells``: (cell, lat, lon, in_region)."""

    hourly: DataFrame
    cells: DataFrame
    settings: Settings
    #: Folder for tables that several results read: written once, then read back. None: planned anew for each result.
    store: str | None = None

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        if not self.store:
            return df
        df.write.mode("overwrite").parquet(f"{self.store}/{name}")  # the folder of this run: nothing else reads it
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.store}/{name}")

    @property
    def _have(self) -> list[str]:
        return [v for v in self.settings.variables if v in self.hourly.columns]

    def _converted(self) -> DataFrame:
        """(cell, ts, variables...): hourly values in working units, running totals as increments."""
        df = self.hourly
        for v in self._have:
            if v in ACCUMULATED:
                df = daily.deaccumulate_reset(df, v, v)
                df = df.withColumn(v, physics.not_negative(F.col(v)))
        return df.select("cell", "ts", *[physics.convert(F.col(v), v).alias(v) for v in self._have])

    @property
    def _full_demand(self) -> bool:
        return PET_FULL <= set(self.hourly.columns) and PET_FULL <= set(self.settings.variables)

    @cached_property
    def _fields(self) -> DataFrame:
        """(kind, cell, day, ...) of UTC days (daily fields; agromet ones end in _agromet) and, for a full demand, of local
        days: one scan of the hourly rows, one shuffle by cell, one grouping. Windows and grouping use the same partitioning."""
        s, have = self.settings, self._have
        df, utc = self.hourly.repartition("cell"), {}
        for v in have:
            if v in ACCUMULATED:
                df = daily.deaccumulate_reset(df, v, f"__{v}")
                df = df.withColumn(f"__{v}", physics.not_negative(F.col(f"__{v}")))
        if self._full_demand:
            df = df if "tp" in df.columns else df.withColumn("tp", F.lit(None).cast("double"))
            for v in ACCUMULATED:
                df = daily.deaccumulate_cycle(df, v, f"local_{v}", keep_first=True)
        for v in have:
            utc[f"utc_{v}"] = physics.convert(F.col(f"__{v}" if v in ACCUMULATED else v), v)
        if self.has_agromet and "tp" not in have:
            utc["utc_tp"] = F.lit(None).cast("double")
        df = df.withColumns(utc)
        outputs = daily.daily_outputs({v: s.aggregates[v] for v in have}, lambda v: f"utc_{v}")
        kinds = {"utc": F.col("ts").cast("date")}
        if self.has_agromet:
            names = {"t": "utc_t2m", "td": "utc_d2m", "u": "utc_u10", "v": "utc_v10", "rain": "utc_tp"}
            outputs += daily.agromet_outputs(names.__getitem__, rain_hour=s.rain_hour_mm, wet_rh=s.wet_rh, windy=s.windy_ms, suffix="_agromet")
        if self._full_demand:
            names = {"t": "t2m", "td": "d2m", "tp": "local_tp", "u": "u10", "v": "v10", "rs": "local_ssrd", "p": "sp"}
            outputs += [c.alias(f"{n}_local") for n, c in zip(("n_t", *daily.LOCAL_FIELDS), daily.local_outputs(names.__getitem__), strict=True)]
            kinds["local"] = local_day(F.col("ts"))
        return self._kept("fields", daily.by_kinds_of_day(df, kinds, outputs))

    def _inside(self, days: DataFrame) -> DataFrame:
        return days.join(if_small(self.cells.where("in_region").select("cell")), "cell", "left_semi")

    @cached_property
    def daily(self) -> DataFrame:
        """(cell, day, {variable}_{aggregate}...) of the cells in the region, in working units."""
        aggregates = {v: self.settings.aggregates[v] for v in self._have}
        if self.store:
            names = [f"{v}_{how}" for v, hows in aggregates.items() for how in hows]
            return self._kept("daily", self._inside(self._fields.where("kind = 'utc'").select("cell", "day", *names)))
        return self._inside(daily.aggregate_daily(self._converted(), aggregates))

    @property
    def has_agromet(self) -> bool:
        return AGROMET <= set(self._have)

    @cached_property
    def agromet(self) -> DataFrame:
        """Humidity, wind, rain and exposure hours of the cells in the region by day."""
        if not self.has_agromet:
            raise ValueError(f"agromet fields need {', '.join(sorted(AGROMET))}")
        s = self.settings
        if self.store:
            names = [c for c in self._fields.columns if c.endswith("_agromet")]
            days = self._fields.where("kind = 'utc'").select("cell", "day", *[F.col(c).alias(c.removesuffix("_agromet")) for c in names])
            return self._kept("agromet", self._inside(days.withColumn("rain_day", physics.flag(F.col("rain_mm") >= s.rain_day_mm))))
        rain = F.col("tp") if "tp" in self._have else F.lit(None).cast("double")
        hours = self._converted().select("cell", "ts", F.col("t2m").alias("t"), F.col("d2m").alias("td"), F.col("u10").alias("u"), F.col("v10").alias("v"), rain.alias("rain"))
        days = daily.agromet_daily(hours, rain_day=s.rain_day_mm, rain_hour=s.rain_hour_mm, wet_rh=s.wet_rh, windy=s.windy_ms)
        return self._inside(days)

    def _context(self) -> annual.Context:
        field = lambda c: F.col(c) if c in self.daily.columns else F.lit(None).cast("double")
        days = self.daily.select("cell", "day", field("t2m_max").alias("tmax"), field("t2m_min").alias("tmin"), field("tp_sum").alias("pr"))
        return annual.Context(daily=days, agromet=self.agromet if self.has_agromet else None, baseline=self.settings.baseline_years)

    def indicators(self, names: Sequence[str] = tuple(annual.REGISTRY)) -> dict[str, DataFrame]:
        """Annual indicators by name; those whose fields are missing are logged and left out."""
        return annual.compute(names, self._context())

    def indicator_makers(self, names: Sequence[str] = tuple(annual.REGISTRY)) -> dict[str, Callable[[], DataFrame]]:
        """What plans each annual indicator, to be written apart from the others."""
        return annual.makers(names, self._context())

    @cached_property
    def normals(self) -> DataFrame:
        columns = [c for c in self.daily.columns if c not in ("cell", "day")]
        table = normals.doy_normals(self.daily, columns, self.settings.baseline_years)
        return self._kept("normals", normals.smooth_circular(table, columns, self.settings.smoothing_days))

    @cached_property
    def anomalies(self) -> DataFrame:
        columns = [c for c in self.daily.columns if c not in ("cell", "day")]
        return self._kept("anomalies", normals.anomalies(self.daily, self.normals, columns, percent_of="tp_sum" if "tp_sum" in columns else None))

    @cached_property
    def area(self) -> DataFrame:
        """(cell = 0, day, fields) of the whole region."""
        columns = [c for c in self.daily.columns if c not in ("cell", "day")]
        return self._kept("area", daily.area_mean(self.daily, columns).withColumn("cell", F.lit(0)))

    @cached_property
    def demand(self) -> DataFrame:
        """(cell = 0, day, pet): Penman-Monteith where all its fields are there, else Hargreaves at the mid latitude."""
        if self._full_demand:
            cells = if_small(self.cells.where("in_region").select("cell", "lat"))
            fields = self._local_fields()
            et0 = physics.penman_monteith(F.col("tmax"), F.col("tmin"), F.col("tdew"), F.col("p_kpa"), F.col("u10"), F.col("rs_mj"), F.col("lat"), F.dayofyear("day"))
            return self._kept("demand", daily.area_mean(fields.join(cells, "cell").withColumn("pet", et0), ["pet"]).withColumn("cell", F.lit(0)))
        middle = self.cells.where("in_region").agg((F.max("lat") + F.min("lat")) / 2).scalar()
        pet = physics.hargreaves(F.col("t2m_mean"), F.col("t2m_max"), F.col("t2m_min"), middle, F.dayofyear("day"))
        return self.area.select("cell", "day", pet.alias("pet"))

    def _local_fields(self) -> DataFrame:
        if self.store:
            names = [c for c in self._fields.columns if c.endswith("_local")]
            return daily.complete_days(self._fields.where("kind = 'local'").select("cell", "day", *[F.col(c).alias(c.removesuffix("_local")) for c in names]))
        raw = self.hourly.withColumn("tp", F.col("tp") if "tp" in self.hourly.columns else F.lit(None).cast("double"))
        for v in ACCUMULATED:
            raw = daily.deaccumulate_cycle(raw, v, v, keep_first=True)
        return daily.local_day_fields(raw.select("cell", "ts", F.col("t2m").alias("t"), F.col("d2m").alias("td"), "tp", F.col("u10").alias("u"), F.col("v10").alias("v"), F.col("ssrd").alias("rs"), F.col("sp").alias("p")))

    def monthly(self, *columns: str) -> DataFrame:
        both = self.area
        if "pet" in columns:
            both = both.join(self.demand, ["cell", "day"], "full_outer")
        return periods.monthly(both, sums=columns)

    def tables(self) -> dict[str, DataFrame]:
        """Each requested index that the variables allow, as (date columns, inputs, value and category columns)."""
        names, _ = wanted_indices(self.settings.indices, self.settings.variables)
        makers: dict[str, Callable[[], DataFrame]] = {
            "spi": self._spi,
            "eddi": self._eddi,
            "spei": self._spei,
            "czi": lambda: self._scaled("tp_sum", "czi", indices.czi, bands.DROUGHT),
            "pni": lambda: self._one(indices.percent_of_normal, "pni_pct", bands.PNI),
            "imd-departure": lambda: self._one(indices.departure, "departure_pct", bands.DEPARTURE),
            "decile": lambda: self._one(indices.decile, "decile", bands.DECILE),
            "rai": lambda: self._one(indices.rai, "rai", bands.DROUGHT),
            "weekly": lambda: self._short(periods.weekly(self.area, "tp_sum"), "week"),
            "fortnightly": lambda: self._short(periods.fortnightly(self.area, "tp_sum"), "fortnight"),
            "pci": self._pci,
            "ai": self._aridity,
            "water-balance": self._balance,
            "temperature": self._temperature,
            "extremes": self._extremes,
        }
        return {n: makers[n]() for n in names}

    def _scaled(self, column: str, name: str, index, limits, sign: int = 1, source: DataFrame | None = None) -> DataFrame:
        """The index at each scale, all in one chain over one spine."""
        out = self.monthly(column) if source is None else source
        for k in self.settings.scales:
            out = indices.rolling_sum(out, column, f"{column}_{k}mo", k)
            out = index(out, f"{column}_{k}mo", f"{name}{k}", [F.month("month")])
            out = out.withColumn(f"{name}{k}_category", bands.categorize(sign * F.col(f"{name}{k}"), limits))
        return out.drop("cell", "n_days")

    def _spi(self) -> DataFrame:
        return self._scaled("tp_sum", "spi", indices.spi, bands.DROUGHT)

    def _eddi(self) -> DataFrame:
        return self._scaled("pet", "eddi", indices.eddi, bands.DROUGHT, -1)

    def _spei(self) -> DataFrame:
        both = self.monthly("tp_sum", "pet").withColumn("balance", F.col("tp_sum") - F.col("pet"))
        return self._scaled("balance", "spei", indices.spei, bands.DROUGHT, source=both)

    def _one(self, index, name: str, limits) -> DataFrame:
        out = index(self.monthly("tp_sum"), "tp_sum", name, [F.month("month")])
        return out.withColumn(f"{name}_category", bands.categorize(F.col(name), limits)).drop("cell")

    def _short(self, sums: DataFrame, key: str) -> DataFrame:
        out = indices.spi(sums, "tp_sum", "spi1", [key])
        out = indices.departure(out, "tp_sum", "departure_pct", [key])
        return out.withColumns({"spi1_category": bands.categorize(F.col("spi1"), bands.DROUGHT), "departure_category": bands.categorize(F.col("departure_pct"), bands.DEPARTURE)}).drop("cell")

    def _pci(self) -> DataFrame:
        return indices.pci(self.monthly("tp_sum"), "tp_sum").withColumn("pci_category", bands.categorize(F.col("pci"), bands.PCI)).drop("cell")

    def _aridity(self) -> DataFrame:
        sums = periods.annual(self.area.join(self.demand, ["cell", "day"], "full_outer"), sums=["tp_sum", "pet"])
        ai = F.when(F.col("pet") > 0, F.col("tp_sum") / F.col("pet"))
        return sums.select("year", ai.alias("ai"), bands.categorize(ai, bands.ARIDITY).alias("ai_category"))

    def _balance(self) -> DataFrame:
        both = self.monthly("tp_sum", "pet").withColumn("water_balance_mm", F.col("tp_sum") - F.col("pet"))
        out = indices.water_balance_anomaly(both, "water_balance_mm", "water_balance_anomaly_mm", [F.month("month")])
        return out.withColumn("anomaly_category", bands.categorize(F.col("water_balance_anomaly_mm") / 50, bands.DROUGHT)).drop("cell")

    def _temperature(self) -> DataFrame:
        means = periods.monthly(daily.area_mean(self.anomalies, ["t2m_mean_anomaly"]).withColumn("cell", F.lit(0)), means=["t2m_mean_anomaly"])
        return means.withColumn("t2m_category", bands.categorize(F.col("t2m_mean_anomaly"), bands.TEMPERATURE)).drop("cell")

    def _extremes(self) -> DataFrame:
        """Area means of the annual extremes of the cells of the region."""
        days = self.daily.select("cell", "day", F.col("tp_sum").alias("pr"))
        found = annual.compute(EXTREMES, annual.Context(daily=days, baseline=self.settings.baseline_years))
        long = None
        for name, df in found.items():
            own = df.select("year", F.lit(name).alias("name"), "value")
            long = own if long is None else long.unionByName(own)
        return long.groupBy("year").pivot("name", list(found)).agg(F.avg("value"))
