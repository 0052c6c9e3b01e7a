"""Operators against brute-force Python models on small random inputs."""

import datetime
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeshore.functions.useragent import DEVICE_RULES, UNKNOWN_DEVICE, device_label
from lakeshore.operators.geo import geo_lookup
from lakeshore.operators.upsert import upsert

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
DDL = "cuit bigint, name string, updated_dt timestamp"
T = [datetime.datetime(2022, 11, 13) + datetime.timedelta(hours=h) for h in range(4)]

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abcd"),
                             st.sampled_from(T)), max_size=8)


def merge_model(target, source):
    """MERGE with a keep-latest source; NULL keys quarantined."""
    latest = {}
    for k, n, t in source:
        if k is None:
            continue
        cur = latest.get(k)
        if cur is None or (t, n) > (cur[2], cur[1]):
            latest[k] = (k, n, t)
    kept = [r for r in target if r[0] is None or r[0] not in latest]
    return sorted(kept + list(latest.values()), key=repr)


@SETTINGS
@given(target=rows_st, source=rows_st)
def test_upsert_matches_merge_model(spark, target, source):
    # target keys are unique (every write goes through upsert)
    seen, tgt = set(), []
    for r in target:
        if r[0] is None or r[0] not in seen:
            tgt.append(r)
            seen.add(r[0])
    t = spark.createDataFrame(tgt, DDL)
    s = spark.createDataFrame(source, DDL)
    want = merge_model(tgt, source)
    for how in ("anti", "full"):
        got = sorted((tuple(r) for r in upsert(t, s, ["cuit"], how=how).collect()), key=repr)
        assert got == want


ranges_st = st.lists(st.tuples(st.integers(0, 2**32 - 1), st.integers(0, 3 * 65536)), min_size=1, max_size=6)


@SETTINGS
@given(spans=ranges_st, probes=st.lists(st.integers(0, 2**32 - 1), max_size=10), near=st.integers(0, 5))
def test_geo_lookup_matches_linear_scan(spark, spans, probes, near):
    # non-overlapping ranges from sorted starts
    ranges, last = [], -1
    for i, (lo, width) in enumerate(sorted(spans)):
        lo = max(lo, last + 1)
        hi = min(lo + width, 2**32 - 1)
        if lo > hi:
            continue
        ranges.append((lo, hi, f"c{i}"))
        last = hi
    # probe around the edges too
    for lo, hi, _ in ranges:
        probes += [lo, hi, max(lo - near, 0), min(hi + near, 2**32 - 1)]

    def dotted(n):
        return ".".join(str((n >> s) & 255) for s in (24, 16, 8, 0))

    def model(n):
        hit = [c for lo, hi, c in ranges if lo <= n <= hi]
        return hit[0] if hit else None

    rdf = spark.createDataFrame(ranges, "ip_from bigint, ip_to bigint, country string")
    ips = spark.createDataFrame([(dotted(n),) for n in probes], "ip_address string")
    got = sorted(((r.ip_address, r.country) for r in geo_lookup(ips, rdf).collect()), key=repr)
    assert got == sorted(((dotted(n), model(n)) for n in probes), key=repr)


agent_st = st.lists(st.one_of(
    st.sampled_from(["iPhone", "iPad", "Googlebot", "SPIDER", "Android 13; SM-A52", "Android 12; Pixel 7",
                     "Android 9; X", "Macintosh", "Windows"]),
    st.text(alphabet="abAndroid ;SMiPhone-0123456789.", max_size=20)), min_size=1, max_size=6)


@SETTINGS
@given(parts=agent_st)
def test_device_label_matches_python_rules(spark, parts):
    ua = " ".join(parts)

    def model(s):
        for pattern, family, brand, model_ in DEVICE_RULES:
            m = re.search(pattern, s)
            if m:
                g = m.group(1) if m.groups() else ""
                return " ".join(x.replace("{1}", g or "") for x in (family, brand, model_))
        return UNKNOWN_DEVICE

    got = spark.createDataFrame([(ua,)], "ua string").select(device_label("ua").alias("d")).first().d
    assert got == model(ua)


@SETTINGS
@given(cents=st.lists(st.integers(0, 10**9), min_size=1, max_size=30))
def test_money_avg_is_exact_half_up(spark, cents):
    from decimal import ROUND_HALF_UP, Decimal

    from lakeshore.plans.reports import money_avg

    prices = [c / 100 for c in cents]
    df = spark.createDataFrame([(p,) for p in prices], "p double")
    got = df.agg(money_avg("p").alias("a")).first().a
    want = (Decimal(sum(cents)) / Decimal(len(cents)) / 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got == want


snap_st = st.dictionaries(st.integers(0, 8), st.tuples(st.sampled_from("abc"), st.sampled_from(T)), max_size=8)


@SETTINGS
@given(old=snap_st, new=snap_st)
def test_table_changes_matches_python_diff(spark, old, new):
    from lakeshore.operators.changes import table_changes

    def df(d):
        return spark.createDataFrame([(k, n, t) for k, (n, t) in d.items()], DDL)

    want = []
    for k in set(old) | set(new):
        if k not in old:
            want.append((k, *new[k], "insert"))
        elif k not in new:
            want.append((k, *old[k], "delete"))
        elif old[k] != new[k]:
            want += [(k, *old[k], "update_preimage"), (k, *new[k], "update_postimage")]
    got = [tuple(r) for r in table_changes(df(old), df(new), ["cuit"]).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)),
                                st.one_of(st.none(), st.integers(-5, 5))), max_size=12))
def test_quality_counters_match_python(spark, pairs):
    from lakeshore.operators.quality import Suite, not_null, pair_greater, run_suite

    df = spark.createDataFrame(pairs, "a int, b int")
    s = Suite("s", [not_null("a"), pair_greater("a", "b"), pair_greater("a", "b", or_equal=True)])
    got = [(r.total, r.failed, r.not_evaluated, r.success)
           for r in run_suite(df, s, "r").orderBy("rule_index").collect()]
    n = len(pairs)
    nulls = sum(a is None for a, _ in pairs)
    ne = sum(a is None or b is None for a, b in pairs)
    gt_fail = sum(a is not None and b is not None and not a > b for a, b in pairs)
    ge_fail = sum(a is not None and b is not None and not a >= b for a, b in pairs)
    assert got == [(n, nulls, 0, nulls == 0), (n, gt_fail, ne, gt_fail == 0 and ne == 0),
                   (n, ge_fail, ne, ge_fail == 0 and ne == 0)]
