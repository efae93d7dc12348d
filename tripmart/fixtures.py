"""Maps the star-schema test tables onto the trip and zone schemas, branch coverage included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import over_all_cores

AS_OF = "2026-01-01 00:00:00"

_PICKUP = (
    "timestampadd(SECOND, (l_orderkey*7 + l_partkey*13) % 86400, l_shipdate + interval '24' year)"
)
_SECONDS = (
    "case when l_orderkey % 107 = 0 then 30000 else (l_suppkey*37 + cast(l_quantity as int)*61) % 5400 + 20 end"
)

# Column -> expression over lineitem (with helper columns p and dur).
_TRIP_COLUMNS = {
    "vendorid": "cast(1 + l_linenumber % 2 as bigint)",
    "tpep_pickup_datetime": """case when l_partkey % 97 = 0 then 'corrupt'
        when l_partkey % 89 = 0 then '1970-01-01 00:00:00' else cast(p as string) end""",
    "tpep_dropoff_datetime": """case when l_partkey % 83 = 0 then null
        else cast(timestampadd(SECOND, dur, p) as string) end""",
    "passenger_count": "case when l_partkey % 50 = 0 then null else cast(cast(l_quantity as int) % 12 as bigint) end",
    "trip_distance": """case when (l_orderkey + l_linenumber) % 103 = 0 then (l_partkey % 300) * 2.0e0
        else (l_partkey % 300) / 10.0e0 end""",
    "ratecodeid": "1 + l_suppkey % 6",
    "store_and_fwd_flag": "case when l_returnflag = 'R' then 'Y' else 'N' end",
    "pulocationid": "l_suppkey % 27",
    "dolocationid": "l_partkey % 26",
    "payment_type": "cast(l_linenumber as bigint)",
    "fare_amount": """case when l_orderkey % 101 = 0 then l_extendedprice / 100e0
        else l_extendedprice / 1000e0 - 1.0e0 end""",
    "extra": "l_tax * 10e0",
    "mta_tax": "0.5e0",
    "tip_amount": "l_extendedprice * l_discount / 1000e0",
    "tolls_amount": "case when l_partkey % 10 = 0 then 6.55e0 else 0e0 end",
    "improvement_surcharge": "0.3e0",
    "total_amount": "l_extendedprice * (1 + l_discount + l_tax) / 1000e0",
    "congestion_surcharge": "case when l_partkey % 5 = 0 then null else 2.5e0 end",
    "airport_fee": "case when l_suppkey % 3 = 0 then null else 1.25e0 end",
    "cbd_congestion_fee": "case when l_linenumber % 2 = 0 then null else 0.75e0 end",
}


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw trips, one per line item; works on a batch or a streaming line item table."""
    helpers = lineitem.withColumns({"p": F.expr(_PICKUP), "dur": F.expr(_SECONDS)})
    return helpers.select(*[F.expr(text).alias(name) for name, text in _TRIP_COLUMNS.items()])


def raw_trips(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Trips of the stored line items; ``spread`` deals them over all cores, for work that costs more than the scan."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return trips_from_lineitem(over_all_cores(lineitem, "l_orderkey", "l_linenumber") if spread else lineitem)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup as loaded, before staging: locationid, borough, zone, service_zone."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.expr("case n_nationkey % 3 when 0 then 'Yellow Zone' when 1 then 'Boro Zone' else 'EWR' end").alias(
            "service_zone"
        ),
    )


def damaged_copy(spark: SparkSession, source: str, target: str, keep: int | None = None, wrong: tuple[int, int] | None = None) -> None:
    """Copies the first Parquet file of a folder, cut off after ``keep`` bytes, or with some bytes overwritten.

    The file systems' streams do it, so nothing is held in memory. Other files of the folder are moved beside the copy.
    """
    hadoop, copy = spark._jvm.org.apache.hadoop, spark._jvm.org.apache.commons.io.IOUtils.copyLarge
    store = hadoop.fs.Path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files = [f for f in store.listStatus(hadoop.fs.Path(source)) if f.getPath().getName().endswith(".parquet")]
    found, *others = sorted(files, key=lambda f: f.getPath().getName())
    read, write = store.open(found.getPath()), store.create(hadoop.fs.Path(f"{target}/part.parquet"))
    end = found.getLen() if keep is None else min(keep, found.getLen())
    if wrong is None:
        copy(read, write, 0, end)
    else:
        copy(read, write, 0, wrong[0])
        write.write(bytearray(b"\xff" * (wrong[1] - wrong[0])))
        read.seek(wrong[1])
        copy(read, write, 0, end - wrong[1])
    read.close()
    write.close()
    for file in others:
        store.rename(file.getPath(), hadoop.fs.Path(target, file.getPath().getName()))
