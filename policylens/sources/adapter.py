"""Derive the extract shapes from the driver's test tables.

The production job reads policy/endorsement extracts (``sources.files``).
For tests and the bench those extracts are derived, by Spark, from the
TPC-H-like tables so that the work grows with the scale factor.  The rules
use only portable arithmetic so the DuckDB oracle derives identical rows
(``policylens.oracle`` holds the same rules in SQL).  ``k`` = o_orderkey,
``n`` = l_linenumber.

Every derived frame is lazy; Catalyst prunes each query back to the parquet
columns it needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("orders", "customer", "lineitem", "nation", "region")

# Fixed values of the test mapping.
ENDORSEMENT_TYPES = ["19", "N1", "21", "10", "58", "\t19 ", "2110", "06"]   # by (k + n) % 8
UNDERWRITE_FLAGS = ["0", "2", "1", "3", "1", "11"]                       # by k % 6


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in names}


def _s(c: Column) -> Column:
    return c.cast("string")


def date_text(ts: Column, key: Column) -> Column:
    """Render a timestamp as extract text: dash with millis for even keys,
    slash without fraction for odd keys."""
    return F.when(key % 2 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")).otherwise(
        F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))


def plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def _pick(index: Column, values: list[str]) -> Column:
    out = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(index == i, F.lit(v))
    return out


def _unless(matches: Column, key: Column) -> Column:
    """The key where it should match, else one of the same width that nothing has."""
    return F.when(matches, key).otherwise(F.concat(F.lit("X"), F.substr(key, F.lit(2))))


@dataclass
class Sources:
    """The extracts of both jobs, as lazy DataFrames."""

    policy: DataFrame
    policy_coins: DataFrame
    vehicle: DataFrame
    company: DataFrame
    copymain: DataFrame
    head: DataFrame
    fee: DataFrame
    itemkind: DataFrame
    copycoins: DataFrame
    policy2: DataFrame
    head2: DataFrame
    fee2: DataFrame
    profit2: DataFrame
    vehicle2: DataFrame
    pmain2: DataFrame
    itemkind2: DataFrame
    claims: DataFrame


def build_sources(tables: dict[str, DataFrame]) -> Sources:
    orders, customer, lineitem = tables["orders"], tables["customer"], tables["lineitem"]
    k, n = F.col("k"), F.col("n")

    base = orders.select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority",
        "o_orderstatus",
    ).join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left_outer")

    start = F.col("o_orderdate")
    p3 = F.when(k % 5 == 0, "1").otherwise("0")
    p5 = F.when(k % 10 == 0, "1").otherwise("0")
    p6 = F.when(k % 7 == 0, "N").otherwise("Y")
    policy_cols = {
        "proposalno": F.lpad(_s(k), 22, "0"),
        "policyno": F.concat(F.lit("P"), _s(k)),
        "riskcode": F.when(k % 2 == 0, "DAA").otherwise("DZA"),
        "comcode": _s(F.col("c_nationkey")),
        "underwriteenddate": F.when(k % 89 == 0, F.lit(None).cast("string")).otherwise(
            date_text(plus_days(start, (k % 11 - 5).cast("int")), k)),
        "startdate": date_text(start, k),
        # some texts that are not dates: a year, a month, an offset
        "operatedate": F.when(k % 101 == 0, "2013").when(k % 103 == 0, "2013/5").otherwise(
            F.concat(date_text(plus_days(start, (k % 40 - 20).cast("int")), k),
                     F.when(k % 107 == 0, "+08:00").otherwise(""))),
        "underwriteflag": _pick(k % 6, UNDERWRITE_FLAGS),
        "coinsflag": F.when(F.col("o_orderpriority") == "1-URGENT", "1")
                      .when(F.col("o_orderpriority") == "2-HIGH", "2").otherwise("0"),
        "sumpremium": F.col("o_totalprice"),
        "sumamount": F.col("o_totalprice") * 10,
        "inputflag": F.col("o_orderstatus"),
        "businessnature": F.substring("o_orderpriority", 1, 1),
        "agentcode": F.concat(F.lit("AG"), _s(F.col("o_custkey") % 50)),
        "enddate": date_text(plus_days(start, F.lit(365)), k),
        "othflag": F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(_s(k % 4), F.lit("00"), p3, F.lit("0"), p5, p6)),
        "contractno": F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(_s(F.col("o_custkey"))),
        "insuredcode": F.when(k % 83 != 0, _s(F.col("o_custkey"))),
    }
    policy_k = base.select(k, *[v.alias(c) for c, v in policy_cols.items()])
    policy = policy_k.drop("k")

    # One application per distinct (order, line); sd = its first ship date.
    apps = lineitem.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(
        F.min("l_shipdate").alias("sd"))
    endo_applyno = F.concat(F.lit("A"), _s(k), F.lit("-"), _s(n))

    copy_cols = ["policyno", "startdate", "underwriteenddate", "othflag", "sumpremium", "sumamount",
                 "coinsflag", "underwriteflag"]
    copy_original = policy_k.select(
        k, F.concat(F.lit("A"), _s(k), F.lit("-0")).alias("applyno"), *copy_cols,
        F.lit(0.0).alias("endorsetimes"), "riskcode")
    # the applications of an order where its policy is joined: moved once for both
    apps_by_order = lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).repartition(
        "k").distinct()
    copy_endorse = apps_by_order.join(policy_k, "k").select(
        k, endo_applyno.alias("applyno"), *copy_cols, n.cast("double").alias("endorsetimes"), "riskcode")
    copy_all = copy_original.unionByName(copy_endorse)
    copymain = copy_all.select(
        "applyno", "policyno", "startdate", "underwriteenddate", "endorsetimes", "othflag", "sumpremium",
        "sumamount", "coinsflag", "underwriteflag")

    head_k = apps.select(
        k, endo_applyno.alias("applyno"),
        F.when((k + 2 * n) % 9 < 8, "1").otherwise("2").alias("underwriteflag"),
        date_text(plus_days(F.col("sd"), (n % 3).cast("int")), k).alias("validdate"),
        _pick((k + n) % 8, ENDORSEMENT_TYPES).alias("endortype"),
        date_text(plus_days(F.col("sd"), F.lit(-1)), k).alias("underwriteenddate"),
    )
    head = head_k.drop("k")

    lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
    fee = lineitem.select(
        F.concat(F.lit("A"), _s(lk), F.lit("-"), _s(ln)).alias("applyno"),
        (F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("chgpremium"),
        ((F.col("l_quantity") - 25) * 1000).alias("chgamount"),
        F.lit("CNY").alias("currency"),
    )

    # item kind: one row per application, original ones (n = 0) included
    all_apps = apps.select("k", "n").unionByName(policy_k.select("k", F.lit(0).alias("n")))

    def item_rows(calc: Column) -> DataFrame:
        return all_apps.select(
            k, endo_applyno.alias("applyno"), calc.alias("calculateflag"), F.lit("CNY").alias("currency"),
            (n * 100.0).alias("chgamount"), (n * 1.5).alias("chgpremium"),
            F.when(k % 11 == 0, F.concat(F.lit("X"), _s(k))).otherwise(F.concat(F.lit("P"), _s(k))).alias("policyno"),
        )

    first_item = item_rows(F.when(k % 13 == 0, F.lit(None).cast("string")).when(n % 3 == 0, "N").otherwise("Y"))
    second_item = item_rows(F.lit("Y")).where(k % 17 == 0)
    itemkind = first_item.unionByName(second_item).drop("k")

    # two thirds of the co-insurance rows belong to nothing; some shares are thirds
    percent = F.when(k % 33 == 0, F.lit(33.33333333)).otherwise((20 + k % 60).cast("double"))
    copycoins = copy_all.select(_unless(k % 3 == 0, F.col("applyno")).alias("applyno"), percent.alias("coinsrate"))
    policy_coins = policy_k.select(_unless(k % 3 == 0, F.col("proposalno")).alias("proposalno"),
                                   (percent / 100.0).alias("coinsrate"))

    nation, region = tables["nation"], tables["region"]
    company = nation.join(region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "left_outer").select(
        _s(F.col("n_nationkey")).alias("comcode"),
        F.col("n_name").alias("comcname"),
        F.concat(F.lit("N"), _s(F.col("n_nationkey"))).alias("comshortname"),
        F.lower("n_name").alias("comename"),
        F.col("r_name").alias("addresscname"),
        F.lower("r_name").alias("addressename"),
        _s(F.col("n_regionkey")).alias("comtype"),
        F.lit("2").alias("comlevel"),
        F.lit("1").alias("comkind"),
    )

    vehicle = orders.select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderpriority").select(
        _unless(k % 8 != 0, F.lpad(_s(k), 22, "0")).alias("proposalno"),
        F.concat(F.lit("C"), _s(k)).alias("carid"),
        F.concat(F.lit("L"), _s(k % 100000)).alias("licenseno"),
        F.concat(F.lit("V"), F.lpad(_s(k), 16, "0")).alias("vinno"),
        F.lit("02").alias("licensetype"),
        F.substring("o_orderpriority", 1, 1).alias("usenaturecode"),
        _s(F.col("o_custkey") * 10).alias("purchaseprice"),
        _s(k % 7 + 2).alias("seatcount"),
        F.lit("0").alias("toncount"),
        F.lit("1.6").alias("exhaustscale"),
        _s(k % 15).alias("useyears"),
        F.lit("F42").alias("clausetype"),
        F.lit("A0").alias("carkindcode"),
    )

    policy2 = policy.select("policyno", "proposalno", "startdate", "enddate", "underwriteenddate", "comcode",
                            "riskcode", "sumpremium", "sumamount")
    head2 = head_k.select(
        "applyno", "endortype", F.concat(F.lit("P"), _s(k)).alias("policyno"),
        F.when(k % 2 == 0, "DAA").otherwise("DZA").alias("riskcode"),
        "underwriteenddate", "underwriteflag", "validdate")
    fee2 = fee.select("applyno", "chgamount", "chgpremium", "currency")
    profit2 = orders.select(F.col("o_orderkey").alias("k"), "o_totalprice").select(
        _unless(k % 5 != 1, F.lpad(_s(k), 22, "0")).alias("proposalno"),
        (F.col("o_totalprice") * 0.12).alias("profit"),
        F.lit(0.12).alias("profitrate"))
    vehicle2 = vehicle.select("proposalno", "licenseno")
    pmain2 = copy_endorse.select(
        "applyno", (F.col("sumpremium") * 0.01).alias("chgpremium"), "coinsflag", "othflag", "riskcode")
    itemkind2 = itemkind.select("applyno", "calculateflag", "chgamount", "chgpremium", "currency", "policyno")

    # a line that was not returned is a claim of which nothing was paid
    claims = lineitem.select(
        F.concat(F.lit("P"), _s(lk)).alias("policyno"),
        date_text(F.col("l_shipdate"), lk).alias("claimtime"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice") * F.col("l_discount")).otherwise(0.0)
        .alias("paid"),
    )

    return Sources(
        policy=policy, policy_coins=policy_coins, vehicle=vehicle, company=company, copymain=copymain,
        head=head, fee=fee, itemkind=itemkind.select("applyno", "calculateflag", "currency", "chgamount",
                                                       "chgpremium", "policyno"),
        copycoins=copycoins, policy2=policy2, head2=head2, fee2=fee2, profit2=profit2, vehicle2=vehicle2,
        pmain2=pmain2, itemkind2=itemkind2, claims=claims,
    )


def sources_for(spark: SparkSession, sf_dir: str) -> Sources:
    return build_sources(read_tables(spark, sf_dir))


EXTRACT_SCHEMA_NAMES = {
    "policy": "POLICY", "policy_coins": "POLICY_COINS", "vehicle": "VEHICLE", "company": "COMPANY",
    "copymain": "COPYMAIN", "head": "HEAD", "fee": "FEE", "itemkind": "ITEMKIND", "copycoins": "COPYCOINS",
    "policy2": "POLICY2", "head2": "HEAD2", "fee2": "FEE2", "profit2": "PROFIT2", "vehicle2": "VEHICLE2",
    "pmain2": "PMAIN2", "itemkind2": "ITEMKIND2", "claims": "CLAIMS",
}


def materialize_sources(spark: SparkSession, src: Sources, base: str, fmt: str = "parquet",
                        files: int | None = None) -> Sources:
    """Write every extract once under ``base`` (a shared folder) and return
    sources that read the written files with their explicit schemas.  This
    is the production shape: the jobs read extract files, not the tables
    they were derived from.  Each extract is spread over ``files`` files
    (default: the cluster's default parallelism), as exported extracts are,
    so reading one is not limited to a handful of scan tasks."""
    from policylens import schemas

    files = files or int(spark.conf.get("spark.default.parallelism", None) or spark.sparkContext.defaultParallelism)
    out = {}
    for name in EXTRACT_SCHEMA_NAMES:
        path = f"{base.rstrip('/')}/{name}"
        getattr(src, name).repartition(files).write.mode("overwrite").format(fmt).save(path)
        schema = getattr(schemas, EXTRACT_SCHEMA_NAMES[name])
        out[name] = spark.read.schema(schema).format(fmt).load(path)
    return Sources(**out)
