"""IPv4 -> country as a range join.

Spark has no range join, so ranges are cut at /16 boundaries: each range
yields one row per /16 bucket it touches, and an IP joins on its bucket
(equi-join) plus ``ip BETWEEN ip_from AND ip_to``.  For non-overlapping ranges
the bucketed table has at most ``#ranges + 65,536`` rows (each /16 boundary
splits at most one range), a bound that does not grow with the logs.  Spark
broadcasts it when its measured bytes are under the session's threshold,
otherwise the join shuffles on the bucket and AQE splits hot buckets.  Rows
without a valid IP match no range; they are dealt to buckets of their own by
all their columns, so that lines with one and the same junk address do not meet
in one task.  Ranges that overlap give a row more than once: see
``operators.networks`` for nested ranges and IPv6.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.ip import ipv4_to_long

BUCKET_BITS = 16
#: Buckets (below 0, so no range has them) of the rows without a valid IP.
NO_IP_BUCKETS = 4096


def bucket_ranges(ranges: DataFrame, lo: str = "ip_from", hi: str = "ip_to") -> DataFrame:
    """One row per (range, /16 bucket) pair."""
    b = F.explode(F.sequence(F.shiftright(F.col(lo), BUCKET_BITS),
                             F.shiftright(F.col(hi), BUCKET_BITS)))
    return ranges.select("*", b.alias("_geo_bucket"))


def no_match_bucket(df: DataFrame) -> Column:
    """A bucket below 0 by the row's columns (maps, which can't be hashed, aside)."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return -1 - F.pmod(F.xxhash64(*plain), F.lit(NO_IP_BUCKETS))


def geo_lookup(df: DataFrame, ranges: DataFrame, ip_col: str = "ip_address",
               out_col: str = "country", value_col: str = "country") -> DataFrame:
    """Left-join each row of ``df`` to the range containing its IP; no range or junk IP -> NULL.

    Works on batch and streaming ``df`` (stream-static left outer join).
    """
    buckets = bucket_ranges(ranges).select(
        F.col("_geo_bucket"), F.col("ip_from").alias("_geo_lo"), F.col("ip_to").alias("_geo_hi"),
        F.col(value_col).alias("_geo_value"))
    ipn = ipv4_to_long(F.col(ip_col))
    no_ip = no_match_bucket(df)
    left = df.withColumn("_geo_ip", ipn).withColumn("_geo_b", F.coalesce(F.shiftright("_geo_ip", BUCKET_BITS), no_ip))
    cond = ((left["_geo_b"] == buckets["_geo_bucket"])
            & left["_geo_ip"].between(buckets["_geo_lo"], buckets["_geo_hi"]))
    out = left.join(buckets, cond, "left")
    return (out.withColumn(out_col, F.col("_geo_value"))
               .drop("_geo_ip", "_geo_b", "_geo_bucket", "_geo_lo", "_geo_hi", "_geo_value"))


def ranges_from_cidr_blocks(blocks: DataFrame, locations: DataFrame, network_col: str = "network",
                            id_col: str = "geoname_id", name_col: str = "country_name") -> DataFrame:
    """Range table from country blocks (CIDR network, location id) and locations
    (location id, country name), the layout of public GeoIP country CSV files.
    Blocks without a location keep a NULL country."""
    from lakeshore.functions.ip import cidr_range

    lo, hi = cidr_range(F.col(network_col))
    b = blocks.select(lo.alias("ip_from"), hi.alias("ip_to"), F.col(id_col).alias("_gid"))
    loc = locations.select(F.col(id_col).alias("_gid"), F.col(name_col).alias("country"))
    return (b.where(F.col("ip_from").isNotNull())
             .join(loc, "_gid", "left").select("ip_from", "ip_to", "country"))
