"""Calendar: spines, the date dimension, target allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, boundary_diff, div0
from sparkmart.operators import windows as wn


def date_spine(bounds: DataFrame, start, end, grain="day", out="date_day") -> DataFrame:
    """One row per period from start to end, both included; `bounds` has one row."""
    first, last = F.to_date(as_col(start)), F.to_date(as_col(end))
    if grain != "day":
        first = F.trunc(first, grain)
    return bounds.select(F.explode(F.sequence(first, last, F.expr(f"INTERVAL 1 {grain}"))).alias(out))


def fiscal_start(unit: str, d) -> Column:
    """First day of the fiscal quarter or year; the fiscal year starts on 1 February."""
    return F.add_months(F.trunc(F.add_months(F.trunc(as_col(d), "month"), -1), unit), 1)


def date_dim(spine: DataFrame, day="date_day") -> DataFrame:
    """Fifty calendar and fiscal attributes per day.

    Weeks run Sunday to Saturday and take the ISO number of their Monday. All
    attributes are arithmetic on the day itself, so the dimension needs no window
    and its first and last periods are whole even when the spine cuts them.
    """
    d = as_col(day)
    sunday = F.dayofweek(d) == 1
    fq_start, fy_start = fiscal_start("quarter", d), fiscal_start("year", d)
    fq_end, fy_end = F.date_sub(F.add_months(fq_start, 3), 1), F.date_sub(F.add_months(fy_start, 12), 1)
    month_start = F.trunc(d, "month")
    fiscal_year = F.when(F.month(d) < 2, F.year(d)).otherwise(F.year(d) + 1)
    fiscal_quarter = F.quarter(F.add_months(month_start, -1))
    fq_name = F.concat(fiscal_year.cast("string"), F.lit("-Q"), fiscal_quarter.cast("string"))
    fm_name = F.concat(fiscal_year.cast("string"), F.lit("-"), F.date_format(d, "MMM"))
    to_fq_end = F.datediff(fq_end, d)
    week_norm = 12 - F.floor(to_fq_end / 7)
    holiday = (F.when((F.month(d) == 1) & (F.dayofmonth(d) == 1), "New Year's Day")
               .when((F.month(d) == 12) & (F.dayofmonth(d) == 25), "Christmas Day")
               .when((F.month(d) == 12) & (F.dayofmonth(d) == 26), "Boxing Day"))
    first_index = spine.select(F.min(fiscal_year * 4 + fiscal_quarter)).scalar()
    week_start = F.date_sub(d, F.dayofweek(d) - 1)
    return spine.select(
        d.alias("date_day"),
        d.alias("date_actual"),
        F.date_format(d, "E").alias("day_name"),
        F.month(d).alias("month_actual"),
        F.year(d).alias("year_actual"),
        F.quarter(d).alias("quarter_actual"),
        F.dayofweek(d).alias("day_of_week"),
        week_start.alias("first_day_of_week"),
        F.weekofyear(F.when(sunday, F.date_add(d, 1)).otherwise(d)).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.datediff(d, F.trunc(d, "quarter")) + 1).alias("day_of_quarter"),
        F.dayofyear(d).alias("day_of_year"),
        fiscal_year.alias("fiscal_year"),
        fiscal_quarter.alias("fiscal_quarter"),
        (F.datediff(d, fq_start) + 1).alias("day_of_fiscal_quarter"),
        (F.datediff(d, fy_start) + 1).alias("day_of_fiscal_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        month_start.alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.trunc(d, "year").alias("first_day_of_year"),
        F.date_sub(F.add_months(F.trunc(d, "year"), 12), 1).alias("last_day_of_year"),
        F.trunc(d, "quarter").alias("first_day_of_quarter"),
        F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1).alias("last_day_of_quarter"),
        fq_start.alias("first_day_of_fiscal_quarter"),
        fq_end.alias("last_day_of_fiscal_quarter"),
        fy_start.alias("first_day_of_fiscal_year"),
        fy_end.alias("last_day_of_fiscal_year"),
        (boundary_diff("week", fy_start, d) + 1).alias("week_of_fiscal_year"),
        F.when(F.month(d) == 1, 12).otherwise(F.month(d) - 1).alias("month_of_fiscal_year"),
        F.date_add(week_start, 6).alias("last_day_of_week"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        fq_name.alias("fiscal_quarter_name"),
        F.concat(F.lit("FY"), F.substring(fq_name, 3, 7)).alias("fiscal_quarter_name_fy"),
        (fiscal_year * 4 + fiscal_quarter - first_index + 1).alias("fiscal_quarter_number_absolute"),
        fm_name.alias("fiscal_month_name"),
        F.concat(F.lit("FY"), F.substring(fm_name, 3, 8)).alias("fiscal_month_name_fy"),
        holiday.alias("holiday_desc"),
        holiday.isNotNull().alias("is_holiday"),
        F.trunc(fq_end, "month").alias("last_month_of_fiscal_quarter"),
        (F.trunc(fq_end, "month") == d).alias("is_first_day_of_last_month_of_fiscal_quarter"),
        F.trunc(fy_end, "month").alias("last_month_of_fiscal_year"),
        (F.trunc(fy_end, "month") == d).alias("is_first_day_of_last_month_of_fiscal_year"),
        F.date_add(F.add_months(month_start, 1), 7).alias("snapshot_date_fpa"),
        F.date_add(F.add_months(month_start, 1), 44).alias("snapshot_date_billings"),
        F.dayofmonth(F.last_day(d)).alias("days_in_month_count"),
        F.when(week_norm < 5, week_norm).when(week_norm < 9, week_norm - 4).otherwise(week_norm - 8).alias("week_of_month_normalised"),
        (90 - to_fq_end).alias("day_of_fiscal_quarter_normalised"),
        week_norm.alias("week_of_fiscal_quarter_normalised"),
        (365 - F.datediff(fy_end, d)).alias("day_of_fiscal_year_normalised"),
        F.when(((to_fq_end - 6) % 7 == 0) | (d == fq_start), 1).otherwise(0).alias("is_first_day_of_fiscal_quarter_week"),
    )


def allocate_daily(df, keys, month, amount) -> DataFrame:
    """Monthly target spread evenly over its days, with week/month/quarter/year to date.

    Each target row explodes its own month. The to-date sums run over one row per
    key and day.
    """
    m = as_col(month)
    days = df.withColumn("target_date", F.explode(F.sequence(m, F.last_day(m), F.expr("INTERVAL 1 DAY"))))
    days = days.withColumn("daily_target", div0(as_col(amount).cast("double"), F.dayofmonth(F.last_day(m))).cast("decimal(28,6)"))
    week = F.date_sub(F.col("target_date"), F.dayofweek("target_date") - 1)
    for name, period in (("wtd", week), ("mtd", F.trunc("target_date", "month")),
                         ("qtd", fiscal_start("quarter", "target_date")), ("ytd", fiscal_start("year", "target_date"))):
        w = wn.window([*keys, period], "target_date", wn.RUNNING)
        days = days.withColumn(f"{name}_target", F.sum("daily_target").over(w))
    return days


def ramp_status(people, start, end, last) -> DataFrame:
    """One row per person and day with the status Ramping or Active, NULL after the end.

    A start before the 14th ramps until the end of the next month, a later one
    until the end of the month after.
    """
    s = F.to_date(as_col(start))
    ramp_end = F.last_day(F.add_months(s, F.when(F.dayofmonth(s) < 14, 1).otherwise(2)))
    out = people.withColumn("ramp_end", ramp_end)
    out = out.withColumn("date_actual", F.explode(F.sequence(s, F.greatest(s, F.to_date(as_col(last))), F.expr("INTERVAL 1 DAY"))))
    status = (F.when(F.col("date_actual") <= F.col("ramp_end"), "Ramping")
              .when(F.col("date_actual") <= F.to_date(as_col(end)), "Active"))
    return out.withColumn("ramp_status", status)


def month_range(df, key, month, extra=1, out="month") -> DataFrame:
    """Every month of a key's life and `extra` after it, where a loss shows up."""
    keys = [key] if isinstance(key, str) else list(key)
    span = df.groupBy(*keys).agg(F.min(as_col(month)).alias("__lo"), F.max(as_col(month)).alias("__hi"))
    return span.select(*keys, F.explode(F.sequence("__lo", F.add_months("__hi", extra), F.expr("INTERVAL 1 MONTH"))).alias(out))
