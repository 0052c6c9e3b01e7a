"""Schema versions of landed documents: additive evolution, rows read under the version that wrote them."""

import json
import os

import pytest

from lakeshore.schemas import ORDER_DOC
from lakeshore.sources import schema_history as sh


def lines(spark, docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def test_new_keys_add_a_version_and_old_ones_stay_readable(spark, tmp_dir):
    path = os.path.join(tmp_dir, "history")
    day1 = lines(spark, [[{"order_id": "a", "status": "pending"}], "broken {"])
    day2 = lines(spark, [{"order_id": "b", "zone": 3, "priority": "1-URGENT"}, {"order_id": "c", "tags": ["x", "y"], "a b": None}])
    with pytest.raises(ValueError):
        sh.schema_at(spark, path)
    n, parsed = sh.load_orders(spark, path, day1, ORDER_DOC, "2022-11-14")
    assert n == 1 and parsed.orders.count() == 1 and parsed.bad_records.count() == 1
    n, parsed = sh.load_orders(spark, path, day2, ORDER_DOC, "2022-11-14")
    assert n == 2 and parsed.orders.columns[len(ORDER_DOC.names):len(ORDER_DOC.names) + 4] == ["a b", "priority", "tags", "zone"]
    rows = {r.order_id: (r.priority, r.zone, r.tags, r._rescued_data) for r in parsed.orders.collect()}
    assert rows == {"b": ("1-URGENT", "3", None, None), "c": (None, None, '["x","y"]', None)}
    assert sh.evolve(spark, path, day2, ORDER_DOC)[0] == sh.evolve(spark, path, day1, ORDER_DOC)[0] == 2      # nothing new: no version
    before = sh.load_orders_under(spark, path, 1, day2, "2022-11-14").orders
    rescued = {r.order_id: json.loads(r._rescued_data) for r in before.collect()}
    assert "priority" not in before.columns and rescued["b"] == {"zone": "3", "priority": "1-URGENT"}
    got = sh.schema_versions(spark, path).where("added").orderBy("version", "position").collect()
    assert [r.column for r in got] == [*ORDER_DOC.names, "a b", "priority", "tags", "zone"] and {r.version for r in got} == {1, 2}
    assert sh.schema_at(spark, path, 1)[1] == sh.schema_at(spark, path, 1)[1] and sh.schema_at(spark, path, 1)[1].simpleString() == ORDER_DOC.simpleString()
    with pytest.raises(ValueError):
        sh.schema_at(spark, path, 3)
