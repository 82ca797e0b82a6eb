"""Typed records of the extracts, as one projection each.

Each function turns a raw extract (text dates, packed flags) into the typed
columns the indicators need.  They are plain ``select``s of column
expressions, so Catalyst prunes unused columns back to the scan and fuses the
projection into the scan's code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policylens.functions.dates import later, typed_date
from policylens.functions.flags import (
    contains_any, flag_in, in_set, is_null_flag, new_renew_transfer, not_in_set_trimmed,
)
from policylens.functions.money import percent_to_fraction

# Endorsement type codes.
CANCEL_TYPES = ("19", "N1")                      # policy cancellation
REDUCTION_NOT_OTHER_TYPES = ("19", "N1", "21", "10")  # excluded from "reduction, neither surrender nor cancel"
SURRENDER_PARTS = ("21", "10")                   # surrender: type text contains either
UNDERWRITTEN = ("1", "3")                        # underwriting passed
CO_INSURED = ("1", "2")                          # co-insurance flag values


def copymain_record(df: DataFrame, *extra: str) -> DataFrame:
    """Policy snapshot per application (endorsement side)."""
    return df.select(
        "applyno", "policyno", *extra,
        typed_date(df, "startdate").alias("startdate"),
        typed_date(df, "underwriteenddate").alias("policyunderwriteenddate"),
        F.col("endorsetimes"),
        F.col("othflag"),
        F.col("sumpremium"), F.col("sumamount"),
        flag_in("coinsflag", 0, *CO_INSURED).alias("coinsflag"),
        flag_in("othflag", 6, "Y").alias("chargeflag"),
        later(typed_date(df, "startdate"), typed_date(df, "underwriteenddate")).alias("policyValiddate"),
        flag_in("underwriteflag", 0, *UNDERWRITTEN).alias("policyunderwriteflag"),
        # 1 = NOT cancelled on this side (character 3 is "0").
        flag_in("othflag", 3, "0").alias("cancelflag"),
    )


def head_record(df: DataFrame, *extra: str) -> DataFrame:
    """Endorsement header with its type marks (``extra`` columns pass through)."""
    return df.select(
        "applyno", *extra,
        flag_in("underwriteflag", 0, *UNDERWRITTEN).alias("underwriteflag"),
        typed_date(df, "validdate").alias("validdate"),
        F.col("endortype"),
        typed_date(df, "underwriteenddate").alias("prppunderwriteenddate"),
        later(typed_date(df, "validdate"), typed_date(df, "underwriteenddate")).alias("maxValiddateAndWritedate"),
        contains_any("endortype", *SURRENDER_PARTS).alias("tuibaoflag"),
        in_set("endortype", CANCEL_TYPES).alias("policycancelflag"),
        not_in_set_trimmed("endortype", REDUCTION_NOT_OTHER_TYPES).alias("decreaseNotcancelflag"),
    )


def copycoins_record(df: DataFrame) -> DataFrame:
    """Endorsement co-insurance share: percent → fraction."""
    return df.select("applyno", percent_to_fraction("coinsrate").alias("coinsrate"))


POLICY_RECORD_COLUMNS = [
    "proposalno", "policyno", "riskcode", "comcode", "underwriteenddate", "startdate", "validdate",
    "operatedate", "underwriteflag", "chargeflag", "cancelflag", "coinsflag", "sumpremium", "sumamount",
    "stopflag", "inputflag", "businessnature", "agentcode", "enddate", "continueflag", "othflag",
    "maxOperatedateUnderwritedate", "maxStartdateUnderwritedate", "Tuancheflag",
]


def policy_record(df: DataFrame) -> DataFrame:
    """Policy master, 24 typed columns."""
    return df.select(
        "proposalno", "policyno", "riskcode", "comcode",
        typed_date(df, "underwriteenddate").alias("underwriteenddate"),
        typed_date(df, "startdate").alias("startdate"),
        later(typed_date(df, "underwriteenddate"), typed_date(df, "startdate")).alias("validdate"),
        typed_date(df, "operatedate").alias("operatedate"),
        # exact (untrimmed, whole-string) test on this side
        in_set("underwriteflag", UNDERWRITTEN).alias("underwriteflag"),
        flag_in("othflag", 6, "Y").alias("chargeflag"),
        # 1 = cancelled on this side (character 3 is "1").
        flag_in("othflag", 3, "1").alias("cancelflag"),
        flag_in("coinsflag", 0, *CO_INSURED).alias("coinsflag"),
        "sumpremium", "sumamount",
        flag_in("othflag", 5, "1").alias("stopflag"),
        "inputflag", "businessnature", "agentcode",
        typed_date(df, "enddate").alias("enddate"),
        new_renew_transfer("othflag", 0, "0", "1", "2").alias("continueflag"),
        "othflag",
        later(typed_date(df, "underwriteenddate"), typed_date(df, "operatedate")).alias("maxOperatedateUnderwritedate"),
        later(typed_date(df, "underwriteenddate"), typed_date(df, "startdate")).alias("maxStartdateUnderwritedate"),
        is_null_flag("contractno").alias("Tuancheflag"),
    )
