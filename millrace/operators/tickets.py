"""Tickets and the fare sheets they were sold under: an interval and as-of join with reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import best_of, in_periods

REASONS = ("matched", "no sheet", "no sales period", "no travel period", "no carrier")


def contains_day(periods, day):
    """Whether some (from, to) of an array holds the day; null and empty arrays hold none."""
    return F.coalesce(F.exists(periods, lambda p: (p["from"] <= day) & (day <= p["to"])), F.lit(False))


def sheets_of_codes(sheets: DataFrame) -> DataFrame:
    """One row for each sheet and tour code it names."""
    return sheets.withColumn("tour_code", F.explode(F.array_distinct("tourcodes"))).drop("tourcodes")


_ASKED = ("tour_code", "carrier", "sold", "departs")


def _fitting(tickets: DataFrame, sheets: DataFrame, codes: DataFrame) -> DataFrame:
    """What tickets ask (``_ASKED``, each once) with the sales periods of their code that hold the day of sale, and of equal ones the smallest sheet.

    Many tickets ask the same and many sheets say the same, so the pairs depend on
    the different days, carriers and travel periods, not on the rows.
    """
    periods = sheets_of_codes(sheets).withColumn("sale", F.explode("sales")).join(codes.select("tour_code", "fee_only"), "tour_code")
    periods = periods.where(~F.col("fee_only") | F.coalesce("change_fee", F.lit(False)))
    periods = periods.groupBy("tour_code", "carriers", "travel", F.col("sale.from").alias("sales_from"), F.col("sale.to").alias("sales_to")).agg(F.min("sheet").alias("sheet"))
    return in_periods(tickets.select(*_ASKED).distinct(), periods, ["tour_code"], "sold", "sales_from", "sales_to")


def _of_tickets(tickets: DataFrame, found: DataFrame) -> DataFrame:
    """The rows found for what tickets ask, for each ticket; a null carrier or departure asks like others."""
    t, f = tickets.select("ticket", *_ASKED).alias("t"), found.alias("f")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in _ASKED]
    return t.join(f, same[0] & same[1] & same[2] & same[3]).select("t.ticket", *[F.col(f"f.{c}") for c in found.columns if c not in _ASKED])


def match_tickets(tickets: DataFrame, sheets: DataFrame) -> DataFrame:
    """(ticket, sheet, sales_from, sales_to) of the sheet each ticket was sold under.

    ``tickets`` are (ticket, tour_code, carrier, sold, departs); ``sheets`` are
    (sheet, tourcodes array, carriers array, sales and travel arrays of (from, to)
    dates, change_fee).  A sheet fits if it names the code and the carrier, some
    sales period holds the day of sale and some travel period the departure.
    Tickets whose code stands in a sheet that mentions a change fee take only such
    sheets; of the fitting ones the sales period that starts last counts, then the
    smallest sheet.  Tickets without a code, a date or a fitting sheet have no row.
    """
    codes = sheets_of_codes(sheets).groupBy("tour_code").agg(F.max(F.coalesce("change_fee", F.lit(False))).alias("fee_only"))
    fits = F.array_contains("carriers", F.col("carrier")) & contains_day(F.col("travel"), F.col("departs"))
    order, values = [F.col("sales_from"), -F.col("sheet")], ["sheet", "sales_from", "sales_to"]
    found = best_of(_fitting(tickets, sheets, codes).where(fits), list(_ASKED), order, values)
    return best_of(_of_tickets(tickets, found), ["ticket"], order, values)


def ticket_report(tickets: DataFrame, sheets: DataFrame) -> DataFrame:
    """(ticket, reason, sheet, candidates) of every ticket.

    ``reason`` tells what the sheets of its code lack, the first of ``REASONS`` that
    holds; ``candidates`` are all sheets that name the code (with a change fee, if
    any does), for tickets that match none.
    """
    named = sheets_of_codes(sheets)
    fee = F.max(F.coalesce("change_fee", F.lit(False)))
    codes = named.groupBy("tour_code").agg(fee.alias("fee_only"), F.array_sort(F.collect_set("sheet")).alias("all"), F.array_sort(F.collect_set(F.when(F.col("change_fee"), F.col("sheet")))).alias("fee"))
    codes = codes.select("tour_code", "fee_only", F.when(F.col("fee_only"), F.col("fee")).otherwise(F.col("all")).alias("candidates"))
    travels = contains_day(F.col("travel"), F.col("departs"))
    best = F.max(F.when(travels & F.array_contains("carriers", F.col("carrier")), F.struct("sales_from", (-F.col("sheet")).alias("order"), "sheet")))
    found = _fitting(tickets, sheets, codes).groupBy(*_ASKED).agg(F.max(travels).alias("travels"), best.alias("best"))
    steps = _of_tickets(tickets, found).groupBy("ticket").agg(F.max("travels").alias("travels"), F.max("best")["sheet"].alias("sheet"))
    joined = tickets.join(steps, "ticket", "left").join(codes, "tour_code", "left")
    reason = F.when(F.col("sheet").isNotNull(), REASONS[0]).when(F.col("candidates").isNull(), REASONS[1]).when(F.col("travels").isNull(), REASONS[2]).when(~F.col("travels"), REASONS[3]).otherwise(REASONS[4])
    candidates = F.when(F.col("sheet").isNull(), F.coalesce("candidates", F.array().cast("array<bigint>")))
    return joined.select("ticket", reason.alias("reason"), "sheet", candidates.alias("candidates"))
