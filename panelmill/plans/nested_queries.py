"""Queries of nested records: the clicks' properties, whose shapes differ and some of which are broken."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.functions import nested
from panelmill.plans.base import Tables, query

_KIND = "case type when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' when 'OBJECT' then 'object' when 'ARRAY' then 'array' else 'number' end"
_TREE = f"""t as (select click_id, fullkey as path, {_KIND} as kind, case when type in ('OBJECT', 'ARRAY', 'NULL') then null else atom ->> '$' end as value from r, json_tree(r.j) where type not in ('OBJECT', 'ARRAY') or value::varchar in ('[]', '{{}}'))"""


@query(f"with r as (select click_id, props as j from clicks where json_valid(props)), {_TREE} select * from t")
def property_leaves(spark, d):
    """Every leaf of every record, to any depth, through a table function; broken records have none."""
    return nested.leaves(Tables(spark, d).clicks, ["click_id"], "props")


@query(f"with r as (select click_id, props as j from clicks where json_valid(props)), {_TREE}, e as (select regexp_replace(path, '\\[[0-9]+\\]', '[*]', 'g') as pattern, kind, count(*) as n from t group by all) select pattern, string_agg(kind || ' ' || n, ', ' order by kind) as kinds, sum(n)::bigint as n from e group by pattern")
def property_shapes(spark, d):
    """What paths there are, of which kinds."""
    out = nested.shapes(nested.leaves(Tables(spark, d).clicks, ["click_id"], "props"))
    return out.select("pattern", F.array_join(F.transform("kinds", lambda k: F.concat(k["kind"], F.lit(" "), k["n"].cast("string"))), ", ").alias("kinds"), "n")


@query(f"""with c as (select click_id, any_value(props) as props from clicks where json_valid(props) group by click_id),
r as (select click_id, json_merge_patch(props::json, case click_id % 5 when 0 then '{{"device": {{"ver": "new", "more": {{"deep": [1, 2]}}}}}}' when 1 then '{{"device": "none"}}' when 2 then '{{"tags": {{"a": true}}, "k": 1.5}}' when 3 then '{{"items": [{{"sku": 1}}]}}' else '{{}}' end::json) as j from c), {_TREE} select * from t""")
def merged_properties(spark, d):
    """Records with another laid over: objects merge, the rest is replaced; rebuilt and flattened again."""
    k = F.col("click_id") % 5
    over = F.when(k == 0, '{"device": {"ver": "new", "more": {"deep": [1, 2]}}}').when(k == 1, '{"device": "none"}').when(k == 2, '{"tags": {"a": true}, "k": 1.5}').when(k == 3, '{"items": [{"sku": 1}]}').otherwise(None)
    rows = Tables(spark, d).clicks.dropDuplicates(["click_id"])
    base = nested.leaves(rows, ["click_id"], "props", arrays=False)
    more = nested.leaves(rows.withColumn("over", over).join(base.select("click_id").distinct(), "click_id", "left_semi"), ["click_id"], "over", arrays=False)
    return nested.leaves(nested.rebuilt(nested.merged(base, more, ["click_id"]), ["click_id"]), ["click_id"], "json")
