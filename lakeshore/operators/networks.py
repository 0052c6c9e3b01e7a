"""IP address -> country over nested and overlapping networks, IPv4 and IPv6.

Public country files hold networks inside networks; the most specific one that
holds an address is the answer.  ``segments`` turns such a table into disjoint
segments: ranges are dealt to the parts of the address space they touch (a /8
of IPv4, a /16 of IPv6), and within a part a sweep over the range ends keeps
the smallest open range on top of a heap, so k ranges cost k log k.  The
segments come with the look-up buckets they are found in, so that an address
meets only the few segments of its own bucket: short ones under the /16 (IPv4)
or /32 (IPv6) buckets they touch, long ones under the part.  ``lookup`` is then
two equi-joins with a range condition and returns each row exactly once.

Addresses are 16-byte keys that sort as the addresses do (``functions.ip``).
The segment table depends on the country file alone, not on the logs; write it
once and look up from the written table, so Spark knows its size and broadcasts
it under the session's threshold (else the join shuffles by bucket).
"""

from __future__ import annotations

import heapq
import ipaddress
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.ip import V4_PREFIX, with_ip_key
from lakeshore.operators.geo import no_match_bucket

_V4 = bytes.fromhex(V4_PREFIX)
#: A segment that touches at most so many fine buckets is listed in each; a longer one in its part's.
FINE_SPAN = 64
#: Ranges dealt to their parts at a time (one that spans everything touches 65,792).
DEALT = 64
SEGMENT_COLUMNS = "bucket string, seg_lo binary, seg_hi binary, value string"


def _network(text: str | None) -> tuple[bytes, bytes] | None:
    """Keys of a network's first and last address; malformed text -> None."""
    try:
        net = ipaddress.ip_network(text, strict=False)
    except ValueError:
        return None
    head = _V4 if net.version == 4 else b""
    return head + net.network_address.packed, head + net.broadcast_address.packed


def networks(blocks: DataFrame, network_col: str = "network", value_col: str = "country") -> DataFrame:
    """(lo, hi, value) of a table of CIDR networks (or lone addresses); malformed networks are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [(_network(t), v) for t, v in zip(rows["network"], rows["value"])]
            yield pd.DataFrame([(*k, v) for k, v in made if k], columns=["lo", "hi", "value"], dtype=object)

    return blocks.select(F.col(network_col).cast("string").alias("network"), F.col(value_col).cast("string").alias("value")).mapInPandas(
        run, "lo binary, hi binary, value string")


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _parts_touched(lo: int, hi: int) -> Iterator[int]:
    """Numbers of the parts a range touches: 0..65535 for IPv6 by its first 16 bits, 65536.. for IPv4 by its first 8."""
    v4 = _number(_V4) << 32
    if lo <= v4 + 0xFFFFFFFF and hi >= v4:
        yield from range(65536 + ((max(lo, v4) - v4) >> 24), 65537 + ((min(hi, v4 + 0xFFFFFFFF) - v4) >> 24))
    if lo < v4 or hi > v4 + 0xFFFFFFFF:
        yield from range(lo >> 112, (hi >> 112) + 1)


def _bounds(part: int) -> list[tuple[int, int]]:
    """The address ranges of a part; the part of IPv6 that holds the IPv4 addresses leaves them out."""
    v4 = int.from_bytes(_V4, "big") << 32
    if part >= 65536:
        return [(v4 + ((part - 65536) << 24), v4 + ((part - 65535) << 24) - 1)]
    lo, hi = part << 112, ((part + 1) << 112) - 1
    return [(lo, v4 - 1), (v4 + (1 << 32), hi)] if part == 0 else [(lo, hi)]


def sweep(ranges: list[tuple[int, int, str | None]], lo: int, hi: int) -> list[tuple[int, int, str | None]]:
    """Disjoint (first, last, value) segments of [lo, hi]; the smallest range wins, then the later start, then the value (NULL last)."""
    rows = sorted((max(a, lo), min(b, hi), (b - a, -a, v is None, v or "")) for a, b, v in ranges if a <= hi and b >= lo)
    cuts = sorted({a for a, _, _ in rows} | {b + 1 for _, b, _ in rows})
    out: list[tuple[int, int, str | None]] = []
    heap: list[tuple[tuple, int]] = []
    at = 0
    for cut, end in zip(cuts, cuts[1:]):
        while at < len(rows) and rows[at][0] == cut:
            heapq.heappush(heap, (rows[at][2], rows[at][1]))
            at += 1
        while heap and heap[0][1] < cut:
            heapq.heappop(heap)
        if heap:
            _, _, missing, value = heap[0][0]
            value = None if missing else value
            if out and out[-1][1] == cut - 1 and out[-1][2] == value:
                out[-1] = (out[-1][0], end - 1, value)
            else:
                out.append((cut, end - 1, value))
    return out


def _buckets(part: int, lo: int, hi: int) -> list[str]:
    if part >= 65536:
        fine = range((lo >> 16) & 0xFFFF, ((hi >> 16) & 0xFFFF) + 1)
        return [f"4-{b:04X}" for b in fine] if len(fine) <= FINE_SPAN else [f"4-{part - 65536:02X}"]
    fine = range(lo >> 96, (hi >> 96) + 1)
    return [f"6-{b:08X}" for b in fine] if len(fine) <= FINE_SPAN else [f"6-{part:04X}"]


def segments(ranges: DataFrame) -> DataFrame:
    """Disjoint segments of a (lo, hi, value) table, one row per look-up bucket (SEGMENT_COLUMNS).

    Ranges with a NULL end or an end before their start are ignored; a NULL
    value is a value (an address in it has no country, whatever lies outside).
    """
    valid = ranges.select("lo", "hi", "value").where(F.col("lo") <= F.col("hi")).distinct()

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), DEALT):
                made = [(part, lo, hi, value) for lo, hi, value in rows[["lo", "hi", "value"]].iloc[at:at + DEALT].itertuples(index=False)
                        for part in _parts_touched(_number(lo), _number(hi))]
                yield pd.DataFrame(made, columns=["part", "lo", "hi", "value"], dtype=object)

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        table = [(_number(a), _number(b), None if v is None or v != v else v) for a, b, v in zip(rows["lo"], rows["hi"], rows["value"])]
        found = [s for lo, hi in _bounds(part) for s in sweep(table, lo, hi)]
        made = [(bucket, a.to_bytes(16, "big"), b.to_bytes(16, "big"), v) for a, b, v in found for bucket in _buckets(part, a, b)]
        return pd.DataFrame(made, columns=["bucket", "seg_lo", "seg_hi", "value"], dtype=object)

    dealt = valid.mapInPandas(deal, "part int, lo binary, hi binary, value string")
    return dealt.groupBy("part").applyInPandas(of_part, SEGMENT_COLUMNS)


def lookup(df: DataFrame, segment_table: DataFrame, ip_col: str = "ip_address", out_col: str = "country") -> DataFrame:
    """``df`` with the value of the most specific network of each row's address; none, or no valid address -> NULL.

    Segments are disjoint, so every row comes back once.  Works on a stream (two
    stream-static left joins).
    """
    key = F.col("_net_key")
    v4 = F.substring(key, 1, 12) == F.lit(_V4)
    fine = F.when(v4, F.concat(F.lit("4-"), F.hex(F.substring(key, 13, 2)))).otherwise(F.concat(F.lit("6-"), F.hex(F.substring(key, 1, 4))))
    part = F.when(v4, F.concat(F.lit("4-"), F.hex(F.substring(key, 13, 1)))).otherwise(F.concat(F.lit("6-"), F.hex(F.substring(key, 1, 2))))
    none = no_match_bucket(df).cast("string")
    out = with_ip_key(df, ip_col, "_net_key")
    out = out.select("*", F.coalesce(fine, none).alias("_net_fine"), F.coalesce(part, none).alias("_net_part"))
    for level in ("fine", "part"):
        side = segment_table.select(F.col("bucket").alias(f"_b_{level}"), F.col("seg_lo").alias(f"_lo_{level}"),
                                    F.col("seg_hi").alias(f"_hi_{level}"), F.col("value").alias(f"_v_{level}"))
        out = out.join(side, (F.col(f"_net_{level}") == F.col(f"_b_{level}")) & key.between(F.col(f"_lo_{level}"), F.col(f"_hi_{level}")), "left")
    kept = [c for c in df.columns if c != out_col]
    return out.select(*kept, F.coalesce("_v_fine", "_v_part").alias(out_col))
