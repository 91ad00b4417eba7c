"""Unit conversions and agro-meteorological formulas as Column expressions. NULL in, NULL out."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KELVIN = 273.15

#: Raw unit to working unit of each variable: (factor, offset).
CONVERSIONS = {"t2m": (1.0, -KELVIN), "d2m": (1.0, -KELVIN), "sp": (0.01, 0.0), "tp": (1000.0, 0.0), "ssrd": (1e-6, 0.0)}


def convert(value: Column, variable: str, *, pressure: str = "hPa") -> Column:
    """Kelvin to Celsius, metres to mm, J/m2 to MJ/m2, Pa to hPa (or kPa); other variables stay as they are."""
    factor, offset = CONVERSIONS.get(variable, (1.0, 0.0))
    if variable == "sp" and pressure == "kPa":
        factor = 0.001
    return value * factor + offset if variable in CONVERSIONS else value


def not_negative(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def vapour_pressure(celsius: Column) -> Column:
    """Magnus form over water, hPa."""
    return 6.1094 * F.exp(17.625 * celsius / (celsius + 243.04))


def relative_humidity(temperature: Column, dewpoint: Column) -> Column:
    ratio = 100.0 * vapour_pressure(dewpoint) / vapour_pressure(temperature)
    return F.when(ratio.isNotNull(), F.least(ratio, F.lit(100.0)))


def wind_speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or can't be told."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def saturation_kpa(celsius: Column) -> Column:
    return 0.6108 * F.exp(17.27 * celsius / (celsius + 237.3))


def extraterrestrial_radiation(latitude: Column, day_of_year: Column, *, clip_sunset: bool = False) -> Column:
    """FAO-56 daily radiation at the top of the atmosphere, MJ/m2; latitude in degrees."""
    phi = F.radians(latitude)
    angle = day_of_year * (2 * math.pi / 365)
    distance = 1 + 0.033 * F.cos(angle)
    declination = 0.409 * F.sin(angle - 1.39)
    cosine = -F.tan(phi) * F.tan(declination)
    if clip_sunset:
        cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    sunset = F.acos(cosine)
    return 24 * 60 / math.pi * 0.0820 * distance * (sunset * F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.sin(sunset))


def hargreaves(tmean: Column, tmax: Column, tmin: Column, latitude: Column, day_of_year: Column) -> Column:
    """Reference evapotranspiration from temperatures, mm/day."""
    spread = F.greatest(tmax - tmin, F.lit(0.0))
    spread = F.when((tmax - tmin).isNotNull(), spread)
    return 0.0023 * (tmean + 17.8) * F.sqrt(spread) * 0.408 * extraterrestrial_radiation(latitude, day_of_year, clip_sunset=True)


def penman_monteith(tmax: Column, tmin: Column, tdew: Column, p_kpa: Column, u10: Column, rs_mj: Column, latitude: Column, day_of_year: Column) -> Column:
    """FAO-56 reference evapotranspiration, mm/day, not below 0."""
    t = (tmax + tmin) / 2
    es, ea = (saturation_kpa(tmax) + saturation_kpa(tmin)) / 2, saturation_kpa(tdew)
    slope = 4098 * saturation_kpa(t) / F.pow(t + 237.3, F.lit(2))
    gamma = 0.665e-3 * p_kpa
    u2 = u10 * (4.87 / math.log(67.8 * 10 - 5.42))
    ra = extraterrestrial_radiation(latitude, day_of_year)
    height = (1 - F.pow(p_kpa / 101.3, F.lit(1 / 5.26))) * (293 / 0.0065)
    clear = F.greatest(F.lit(0.3), F.least(F.lit(1.0), F.try_divide(rs_mj, (0.75 + 2e-5 * height) * ra)))
    warm = (F.pow(tmax + 273.16, F.lit(4)) + F.pow(tmin + 273.16, F.lit(4))) / 2
    rnl = 4.903e-9 * warm * (0.34 - 0.14 * F.sqrt(ea)) * (1.35 * clear - 0.35)
    rn = 0.77 * rs_mj - rnl
    et0 = (0.408 * slope * rn + gamma * 900 / (t + 273) * u2 * (es - ea)) / (slope + gamma * (1 + 0.34 * u2))
    return not_negative(et0)
