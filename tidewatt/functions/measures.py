"""Ratios, unit conversions and classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatt.functions.calendar import month_start
from tidewatt.params import Params


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(n: str | Column, d: str | Column) -> Column:
    """n / d in doubles; NULL when d is NULL or zero."""
    num, den = _column(n).cast("double"), _column(d).cast("double")
    return F.when(den != 0, num / den)


def share_pct(part: str | Column, whole: str | Column) -> Column:
    """100 * part / whole where whole is positive."""
    p, w = _column(part).cast("double"), _column(whole).cast("double")
    return F.when(w > 0, F.lit(100.0) * p / w)


def kwh_to_gwh(c: str | Column) -> Column:
    return _column(c).cast("double") / F.lit(1e6)


def half_hour_kwh_to_mw(c: str | Column) -> Column:
    return _column(c).cast("double") / F.lit(500.0)


def pricing_regime(day: str | Column, p: Params) -> Column:
    return F.when(_column(day) < F.lit(p.regime_cutover), "ex_post").otherwise("real_time")


def price_outlier(price: str | Column, p: Params) -> Column:
    """Spike before negative; NULL for an ordinary price."""
    c = _column(price)
    return F.when(c > p.spike_threshold, "positive_spike").when(
        c < p.negative_threshold, "negative_price"
    )


# Labels of the renewable-share bands, in display order.
SHARE_BANDS = ("0%", "1-24%", "25-49%", "50-74%", "75-99%", "100%")


def share_band(pct: str | Column) -> Column:
    c = _column(pct)
    return (
        F.when(c.isNull(), "No generation")
        .when(c >= 100, "100%")
        .when(c >= 75, "75-99%")
        .when(c >= 50, "50-74%")
        .when(c >= 25, "25-49%")
        .when(c > 0, "1-24%")
        .otherwise("0%")
    )


def ordinal(c: str | Column, labels) -> Column:
    """Position of a label in its display order, for sorting; unknown labels last."""
    col = _column(c)
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), col)
    return F.when(pos > 0, pos).otherwise(len(labels) + 1)


def change_pct(now: str | Column, before: str | Column) -> Column:
    a, b = _column(now).cast("double"), _column(before).cast("double")
    return F.when(b != 0, (a - b) / b * 100.0)


def correlation(x: str | Column, y: str | Column, min_points: int = 2) -> Column:
    """Pearson correlation over rows where both are present; NULL without variance or points."""
    a, b = _column(x).cast("double"), _column(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    enough = (F.count(a) >= min_points) & (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when(
        enough,
        F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)),
    )


def direction(r: str | Column) -> Column:
    """Reading of a storage/price correlation."""
    c = _column(r)
    return (
        F.when(c < -0.1, "expected inverse").when(c > 0.1, "positive").when(c.isNotNull(), "weak")
    )


def on_target(measure: str | Column, ok: Column) -> Column:
    """Three-state verdict of a service objective."""
    return (
        F.when(_column(measure).isNull(), "No recent data")
        .when(ok, "On target")
        .otherwise("Needs attention")
    )


def number_label(c: str | Column, digits: int = 1, suffix: str = "") -> Column:
    """'1,234.5 GWh'; 'N/A' for NULL."""
    return F.coalesce(F.concat(F.format_number(_column(c), digits), F.lit(suffix)), F.lit("N/A"))


def delta_label(c: str | Column, digits: int = 1, suffix: str = "") -> Column:
    """Signed change, '+3.2%'; NULL stays NULL."""
    sign = F.when(_column(c) >= 0, "+").otherwise("")
    return F.concat(sign, F.format_number(_column(c), digits), F.lit(suffix))


def date_label(day: str | Column) -> Column:
    """'15 Jan 2024'."""
    return F.coalesce(F.date_format(_column(day), "dd MMM yyyy"), F.lit("N/A"))


def month_label(ym: str | Column) -> Column:
    """'Jan 2024' of a YYYYMM string."""
    return F.coalesce(F.date_format(month_start(_column(ym)), "MMM yyyy"), F.lit("N/A"))


def price_label(c: str | Column) -> Column:
    """'$1,234/MWh'."""
    return F.concat(F.lit("$"), F.format_number(_column(c), 0), F.lit("/MWh"))


def event_label(day: str | Column, period: str | Column, poc: str | Column, price: str | Column) -> Column:
    """'2024-01-15 TP18 | POC | $450/MWh'."""
    return F.concat(
        F.date_format(_column(day), "yyyy-MM-dd"),
        F.lit(" TP"),
        F.lpad(_column(period).cast("string"), 2, "0"),
        F.lit(" | "),
        _column(poc),
        F.lit(" | "),
        price_label(price),
    )
