"""Fire-weather codes as native column expressions.

All formulas work in double precision. ``fire_codes`` rounds each code to float
before the next one reads it, because the stored codes are floats. A NULL input
gives a NULL code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Codes of the day before the first reading.
START_FFMC = 85.0
START_DMC = 6.0
START_DC = 15.0

# Drying factor by month, January first.
DMC_MONTH_FACTOR = [6.5, 7.5, 8.5, 9.5, 10.5, 11.5, 12.5, 13.5, 14.5, 15.5, 16.5, 17.5]
DC_MONTH_FACTOR = [0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.4, 1.5, 1.6]

# Range of each code.
FFMC_RANGE = (28.6, 92.5)
DMC_RANGE = (1.1, 65.9)
DC_RANGE = (7.0, 220.4)
ISI_RANGE = (0.0, 18.5)
BUI_RANGE = (1.1, 68.0)

# Risk by upper bound of the index, with meaning and colour.
RISK_LEVELS = [
    (5.0, "Very Low", "Little to no fire risk", "#27ae60"),
    (10.0, "Low", "Minimal fire danger, small fires possible", "#1e90ff"),
    (20.0, "Moderate", "Fires can start and spread moderately", "#f1c40f"),
    (30.0, "High", "High fire risk, fires spread quickly", "#e67e22"),
    (None, "Very High/Extreme", "Severe fire danger, rapid spread", "#c0392b"),
]


def _within(bounds: tuple[float, float], c: Column, *inputs: Column) -> Column:
    # greatest/least skip NULLs, so the guard keeps NULL from becoming a bound
    present = inputs[0].isNotNull()
    for i in inputs[1:]:
        present = present & i.isNotNull()
    return F.when(present, F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), c)))


def _by_month(factors: list[float], month: Column) -> Column:
    return F.get(F.array(*[F.lit(f) for f in factors]), month - 1)


def _moisture(code: Column) -> Column:
    return F.lit(147.2) * (F.lit(101.0) - code) / (F.lit(59.5) + code)


def ffmc(rh: Column, rain: Column, prev: Column) -> Column:
    """Fine fuel moisture code. Temperature and wind have no part in it."""
    wet = rain - 0.5
    start = _moisture(prev) + F.when(
        rain > 0.5, F.lit(42.5) * wet * (F.lit(1.0) - F.lit(0.0015) * wet)).otherwise(0.0)
    m = F.greatest(F.lit(0.0), start - F.lit(250.0) * (F.lit(1.0) - rh / 100.0))
    code = F.lit(59.5) * (F.lit(250.0) - m) / (F.lit(147.2) + m)
    return _within(FFMC_RANGE, code, rh, rain, prev)


def dmc(temp: Column, rh: Column, rain: Column, month: Column, prev: Column) -> Column:
    """Duff moisture code."""
    effective = F.lit(0.92) * rain - 1.27
    content = F.lit(20.0) + F.coalesce(
        F.lit(280.0) / (F.lit(1.0) + F.try_divide(F.lit(280.0), prev)), F.lit(0.0))
    slope = F.when(prev > 0, F.try_divide(F.lit(100.0), F.lit(0.5) * prev)).otherwise(100.0)
    wetted = content * (F.lit(1.0) - F.lit(0.001) * effective * slope)
    base = F.when(rain > 1.5, F.try_divide(wetted, F.lit(1.0) + wetted / 280.0)).otherwise(prev)
    drying = F.lit(1.6) * (temp + 1.1) * (F.lit(100.0) - rh) / 1000.0
    code = base + F.when(temp > -1.1, _by_month(DMC_MONTH_FACTOR, month) * drying).otherwise(0.0)
    return _within(DMC_RANGE, code, temp, rh, rain, month, prev)


def dc(temp: Column, rain: Column, month: Column, prev: Column) -> Column:
    """Drought code."""
    wet = F.when(rain > 2.8, F.lit(400.0) * ((F.lit(0.83) * rain - 1.27) / (F.lit(3.937) + prev)))
    dry = F.when(temp > -2.8, F.lit(0.36) * (temp + 2.8) * _by_month(DC_MONTH_FACTOR, month))
    code = prev + F.coalesce(wet, F.lit(0.0)) + F.coalesce(dry, F.lit(0.0))
    return _within(DC_RANGE, code, temp, rain, month, prev)


def isi(ffmc_code: Column, ws: Column) -> Column:
    """Initial spread index."""
    m = _moisture(ffmc_code)
    fuel = F.lit(19.115) * F.exp(F.lit(-0.1386) * m) * (
        F.lit(1.0) + F.pow(m, F.lit(5.31)) / F.lit(4.93e7))
    return _within(ISI_RANGE, fuel * F.exp(F.lit(0.05039) * ws), ffmc_code, ws)


def bui(dmc_code: Column, dc_code: Column) -> Column:
    """Build-up index."""
    share = (F.lit(1.0) - F.lit(0.8) * dmc_code / (dmc_code + dc_code)) * (F.lit(0.1) * dc_code)
    code = F.when(dmc_code <= F.lit(0.4) * dc_code, dmc_code + share).otherwise(dmc_code - share)
    return _within(BUI_RANGE, code, dmc_code, dc_code)


def fire_codes(df: DataFrame, month: Column, temp: str = "temperature", rh: str = "rh",
               ws: str = "ws", rain: str = "rain", prev_ffmc: Column | None = None,
               prev_dmc: Column | None = None, prev_dc: Column | None = None) -> DataFrame:
    """Add ``ffmc, dmc, dc, isi, bui`` (float); works on a batch or a stream.

    Without previous codes every reading starts from the fixed start values.
    """
    t, h, w, r = (F.col(c).cast("double") for c in (temp, rh, ws, rain))
    first = {
        "ffmc": ffmc(h, r, F.lit(START_FFMC) if prev_ffmc is None else prev_ffmc),
        "dmc": dmc(t, h, r, month, F.lit(START_DMC) if prev_dmc is None else prev_dmc),
        "dc": dc(t, r, month, F.lit(START_DC) if prev_dc is None else prev_dc),
    }
    coded = df.withColumns({name: c.cast("float") for name, c in first.items()})
    return coded.withColumns({
        "isi": isi(F.col("ffmc").cast("double"), w).cast("float"),
        "bui": bui(F.col("dmc").cast("double"), F.col("dc").cast("double")).cast("float"),
    })


def risk_level(index: Column, part: str = "level") -> Column:
    """Risk of a fire-weather index: its ``level``, ``meaning`` or ``color``."""
    at = {"level": 1, "meaning": 2, "color": 3}[part]
    branches = F.when(index.isNull(), F.lit(None).cast("string"))
    for row in RISK_LEVELS[:-1]:
        branches = branches.when(index < row[0], F.lit(row[at]))
    return branches.otherwise(F.lit(RISK_LEVELS[-1][at]))
