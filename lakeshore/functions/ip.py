"""IP address text -> numbers (IPv4) and sortable keys (IPv4 and IPv6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IPV4 = r"^([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})$"


def ipv4_to_long(c) -> Column:
    """Dotted IPv4 -> bigint in [0, 2^32); anything else (junk, IPv6, octet > 255) -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.split(col, r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    in_range = octets[0] <= 255
    for o in octets[1:]:
        in_range = in_range & (o <= 255)
    return F.when(col.rlike(_IPV4) & in_range, value)


def cidr_range(c) -> tuple[Column, Column]:
    """``'1.2.3.0/24'`` -> (first, last) address as bigints; malformed -> NULLs."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.split(col, "/")
    base = ipv4_to_long(F.get(parts, F.lit(0)))
    bits = F.get(parts, F.lit(1)).try_cast("int")
    ok = base.isNotNull() & bits.between(0, 32)
    size = F.pow(F.lit(2), F.lit(32) - bits).cast("bigint")   # exact: powers of two up to 2^32
    first = F.when(ok, base - F.pmod(base, size))
    return first, F.when(ok, first + size - 1)


_HEXTETS = r"^[0-9a-f]{1,4}(:[0-9a-f]{1,4}){7}$"
#: Fixed value: the first 96 bits of an IPv4 address written as IPv6.
V4_PREFIX = "00000000000000000000ffff"


def _groups_in(half: Column) -> Column:
    return F.when(half == "", 0).otherwise(F.length(half) - F.length(F.replace(half, F.lit(":"), F.lit(""))) + 1)


def with_ip_key(df: DataFrame, ip_col: str, out_col: str) -> DataFrame:
    """``df`` with the address as 16 bytes that sort as addresses do; neither IPv4 nor IPv6 -> NULL.

    An IPv4 address and its IPv6-mapped form (``::ffff:a.b.c.d``) have one key.
    Each step is a column of its own, so it is evaluated once.
    """
    mine = f"{out_col}_"
    while any(c.lower().startswith(mine.lower()) for c in df.columns):
        mine += "_"
    v4, text, halves, missing, full = (F.col(f"`{mine}{n}`") for n in ("v4", "text", "halves", "missing", "full"))
    # An address may end in dotted form: those four bytes as two groups of hex digits.
    tail = ipv4_to_long(F.regexp_extract(F.col(ip_col), "([0-9.]+)$", 1))
    dotted = F.concat(F.regexp_extract(F.col(ip_col), r"^(.*:)[0-9.]+$", 1), F.hex(F.shiftright(tail, 16)), F.lit(":"), F.hex(tail % 65536))
    colon = F.contains(F.col(ip_col), F.lit(":"))
    out = df.select("*", ipv4_to_long(ip_col).alias(f"{mine}v4"),
                    F.when(colon, F.lower(F.when(F.contains(F.col(ip_col), F.lit(".")), dotted).otherwise(F.col(ip_col)))).alias(f"{mine}text"))
    out = out.select("*", F.split(text, "::").alias(f"{mine}halves"))
    left, right = F.get(halves, F.lit(0)), F.get(halves, F.lit(1))
    out = out.select("*", (8 - _groups_in(left) - _groups_in(right)).alias(f"{mine}missing"))
    filled = F.concat_ws(":", F.nullif(left, F.lit("")), F.array_join(F.array_repeat(F.lit("0"), missing), ":"), F.nullif(right, F.lit("")))
    # '::' stands for one group at least.
    whole = F.when(F.size(halves) == 1, text).when((F.size(halves) == 2) & (missing > 0), filled)
    out = out.select("*", F.when(whole.rlike(_HEXTETS), F.split(whole, ":")).alias(f"{mine}full"))
    v6 = F.concat(*[F.lpad(F.get(full, F.lit(i)), 4, "0") for i in range(8)])
    key = F.when(v4.isNotNull(), F.concat(F.lit(V4_PREFIX), F.lpad(F.hex(v4), 8, "0"))).otherwise(v6)
    return out.select(*df.columns, F.unhex(key).alias(out_col))
