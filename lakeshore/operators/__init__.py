"""Operators Spark lacks as one call, built from DataFrame operations."""

from lakeshore.operators.changes import table_changes, table_history  # noqa: F401
from lakeshore.operators.dedupe import dedupe_latest  # noqa: F401
from lakeshore.operators.geo import geo_lookup, ranges_from_cidr_blocks  # noqa: F401
from lakeshore.operators.quality import Suite, max_between, not_null, pair_greater, run_suite  # noqa: F401
from lakeshore.operators.referential import orphans  # noqa: F401
from lakeshore.operators.sample import hash_fraction, hash_sample_n  # noqa: F401
from lakeshore.operators.upsert import merge_into, read_table  # noqa: F401
