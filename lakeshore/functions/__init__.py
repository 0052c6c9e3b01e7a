"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from lakeshore.functions.casts import safe_get, to_bigint, to_date, to_double, to_int  # noqa: F401
from lakeshore.functions.fmt import (  # noqa: F401
    date_range_rows,
    epoch_ms_to_string,
    html_row_tag,
)
from lakeshore.functions.ids import key_id  # noqa: F401
from lakeshore.functions.ip import ipv4_to_long  # noqa: F401
from lakeshore.functions.logline import (  # noqa: F401
    format_log_line,
    parse_log_line,
    parse_log_timestamp,
    request_action,
    request_product_id,
)
from lakeshore.functions.useragent import DEVICE_RULES, device_label  # noqa: F401
