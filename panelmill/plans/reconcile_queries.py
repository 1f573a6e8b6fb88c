"""Queries of reconciled annotations: figures of 25 boxes from embeddings, whose numbers choose branches and conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.operators.reconcile import clipped_children, reconciled, with_texts
from panelmill.plans.base import Tables, query

_BOXES = {
    "kind": "case when j in (0, 8, 16) and (fig % 6 <> 0 or j = 0) then 'Panel' when j % 5 in (1, 3) then 'Label' else 'CFP' end",
    "region": "case when j in (0, 8, 16) or id % 11 <> 4 then concat('r', id) end",
    "source": "case when j in (0, 8, 16) or id % 11 <> 4 then 'annotation' else 'model' end",
    "x0": "case when j in (0, 8, 16) then cast(case when j = 8 and fig % 3 = 1 then 0 else j * 1.25 end as double) else 10.0 * (case when id % 7 < 3 then j * 2 else j end % 3) + 2 * u end",
    "x1": "case when j in (0, 8, 16) then j * 1.25 + 9.5 else 10.0 * (case when id % 7 < 3 then j * 2 else j end % 3) + 2 * u + 2 end",
    "y0": "case when j in (0, 8, 16) then 0 when id % 13 = 6 and fig % 5 = 4 then 50 + v else 7 * v end",
    "y1": "case when j in (0, 8, 16) then 10 when id % 13 = 6 and fig % 5 = 4 then 52 + v else 7 * v + 2 end",
}
_PARENT = "case when j not in (0, 8, 16) and (fig % 6 = 2 or fig % 6 in (3, 5) and id % 4 = 0) then concat('r', fig * 25 + case when fig % 12 = 5 and id % 3 = 0 then 1 else 8 * (j % 3) end) end"


def _inputs(spark, d):
    e = Tables(spark, d).embeddings.select(F.col("vec_id").alias("id"), F.expr("vec_id div 25").alias("fig"), F.expr("vec_id % 25").alias("j"), F.expr("abs(cast(embedding[0] as double)) % 1").alias("u"), F.expr("abs(cast(embedding[1] as double)) % 1").alias("v"))
    b = e.select("id", "fig", "j", *[F.expr(sql).alias(name) for name, sql in _BOXES.items()])
    boxes = b.select("id", "fig", "kind", "region", "source", F.struct(*[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")]).alias("box"))
    figures = b.select("fig").distinct().select("fig", F.expr("fig % 6 in (2, 3)").alias("images_annotated"))
    drawn = b.where("region is not null and not (fig % 30 = 9 and j = 2)").select("fig", "region", F.expr(_PARENT).alias("parent"))
    extra = figures.where("fig % 12 = 8").selectExpr("fig", "'none' as region", "concat('r', fig * 25) as parent")
    parts = b.where("j in (0, 8, 16) and fig % 6 > 1 and not (fig % 30 = 15 and j = 16)").selectExpr("fig", "region", "chr(65 + j div 8) as name", "concat('text ', id) as text")
    parts = parts.unionByName(figures.where("fig % 18 = 11").selectExpr("fig", "'zz' as region", "'Z' as name", "'lost' as text"))
    splits = figures.selectExpr("fig", "explode(case when fig % 6 = 0 then array('None') when fig % 6 = 1 then array('A') else array('A', 'B', 'C') end) as name", "'part' as text")
    return figures, boxes, drawn.unionByName(extra), parts, splits


#: The same figures, their attachments, conflicts and panels.
FIGURES = f"""with e as (select vec_id as id, vec_id // 25 as fig, vec_id % 25 as j, abs(embedding[1]::double) % 1 as u, abs(embedding[2]::double) % 1 as v from embeddings),
b as (select id, fig, j, {", ".join(f"{sql} as {name}" for name, sql in _BOXES.items())} from e),
f as (select distinct fig, case when fig % 6 < 2 then 'whole' when fig % 6 = 2 then 'annotated' else 'spatial' end as branch, fig % 6 in (3, 5) as forced from b),
r as (select fig, region, {_PARENT} as parent from b where region is not null and not (fig % 30 = 9 and j = 2) union all select fig, 'none', 'r' || fig * 25 from f where fig % 12 = 8),
p as (select fig, region, chr((65 + j // 8)::int) as name, 'text ' || id as text from b where j in (0, 8, 16) and fig % 6 > 1 and not (fig % 30 = 15 and j = 16) union all select fig, 'zz', 'Z', 'lost' from f where fig % 18 = 11),
touch as (select c.fig, c.id, q.id as panel_id, c.kind, c.region, q.region as panel_region, c.x0, c.y0, c.x1, c.y1 from b c join b q on c.fig = q.fig join f on f.fig = c.fig
  where f.branch = 'spatial' and c.kind <> 'Panel' and q.kind = 'Panel' and greatest(least(c.x1, q.x1) - greatest(c.x0, q.x0), 0) * greatest(least(c.y1, q.y1) - greatest(c.y0, q.y0), 0) >= 0.7 * (c.x1 - c.x0) * (c.y1 - c.y0)),
held as (select t.*, r.parent, r.region is not null as known, w.id as parent_id, w.kind as parent_kind from touch t join f using (fig) left join r on r.fig = t.fig and r.region = t.region left join b w on w.fig = t.fig and w.region = r.parent where f.forced and t.region is not null),
wrong as (select * from held where parent is not null and panel_region <> parent), moves as (select * from wrong where parent_kind = 'Panel'),
att as (select fig, id, panel_id, kind from touch where (fig, id, panel_id) not in (select fig, id, panel_id from moves) union select fig, id, parent_id, kind from moves),
told as (select r.fig, r.region as child, r.parent, c.id, c.kind, c.x0, c.y0, c.x1, c.y1, w.id as panel_id, w.x0 as p0, w.y0 as q0, w.x1 as p1, w.y1 as q1 from r join f using (fig) left join b c on c.fig = r.fig and c.region = r.region left join b w on w.fig = r.fig and w.region = r.parent
  where f.branch = 'annotated' and r.parent is not null and (r.fig, r.region) not in (select fig, region from p)),
c as (
  select fig, 'one part with a name' as rule, 'A' as child, null as before, null as after from f where fig % 6 = 1
  union all select p.fig, 'part of no region', p.region, null, null from p where (fig, region) not in (select fig, region from r)
  union all select fig, 'region without a box', child, null, null from told where id is null
  union all select fig, 'region without a box', region, null, null from p join f using (fig) where branch = 'annotated' and (fig, region) not in (select fig, region from b where region is not null)
  union all select fig, 'panel without children', region, null, null from p join f using (fig) where branch = 'annotated' and (fig, region) not in (select fig, parent from told where id is not null and panel_id is not null)
  union all select fig, 'box of no region', id::varchar, null, null from held where not known
  union all select fig, 'parent without a box', id::varchar, panel_id::varchar, parent from wrong where parent_id is null
  union all select fig, 'parent is no panel', id::varchar, panel_id::varchar, parent from wrong where parent_kind <> 'Panel'
  union all select fig, 'panel without a part', id::varchar, null, null from b join f using (fig) where branch = 'spatial' and kind = 'Panel' and (fig, region) not in (select fig, region from p)
  union all select fig, 'box without a panel', id::varchar, null, null from b join f using (fig) where branch <> 'whole' and source = 'annotation' and kind <> 'Panel' and (fig, id) not in (select fig, id from att union select fig, id from told where id is not null and panel_id is not null)
  union all select fig, 'moved', id::varchar, panel_id::varchar, parent_id::varchar from moves
  union all select fig, 'in several panels', id::varchar, string_agg(panel_id::varchar, ',' order by panel_id), null from att group by fig, id having count(*) > 1
  union all select fig, 'outside its panel', id::varchar, null, panel_id::varchar from told where id is not null and panel_id is not null and (least(x1, p1) <= greatest(x0, p0) or least(y1, q1) <= greatest(y0, q0))
), conflict as (select distinct *, rule not in ('moved', 'in several panels', 'outside its panel') as fatal from c),
ids as (
  select fig, first(id) filter (kind = 'Panel') as panel_id, 'whole' as branch, list(id order by id) filter (kind = 'CFP') as images, [] as labels, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, 'None' as name, 'part' as text from b where fig % 6 < 2 group by fig
  union all
  select told.fig, panel_id, 'annotated', coalesce(list(id order by id) filter (kind = 'CFP'), []), coalesce(list(id order by id) filter (kind = 'Label'), []), least(min(x0), any_value(p0)), least(min(y0), any_value(q0)), greatest(max(x1), any_value(p1)), greatest(max(y1), any_value(q1)), any_value(p.name), any_value(p.text)
  from told join p on p.fig = told.fig and p.region = told.parent where id is not null and panel_id is not null group by told.fig, panel_id
  union all
  select b.fig, b.id, 'spatial', coalesce((select list(id order by id) from att a where a.fig = b.fig and a.panel_id = b.id and kind = 'CFP'), []), coalesce((select list(id order by id) from att a where a.fig = b.fig and a.panel_id = b.id and kind = 'Label'), []),
    least(b.x0, (select min(x0) from touch t where t.panel_id = b.id and kind = 'CFP')), least(b.y0, (select min(y0) from touch t where t.panel_id = b.id and kind = 'CFP')), greatest(b.x1, (select max(x1) from touch t where t.panel_id = b.id and kind = 'CFP')), greatest(b.y1, (select max(y1) from touch t where t.panel_id = b.id and kind = 'CFP')), p.name, p.text
  from b join f using (fig) left join p on p.fig = b.fig and p.region = b.region where branch = 'spatial' and kind = 'Panel'
), panels as (select * from ids where fig not in (select fig from conflict where fatal))
"""


@query(FIGURES + "select fig::bigint as fig, rule, child, before, after, fatal from conflict")
def assembly_conflicts(spark, d):
    """What does not fit between annotations and places, fatal or settled."""
    return reconciled(*_inputs(spark, d))[1]


@query(FIGURES + "select fig::bigint as fig, panel_id::bigint as panel_id, branch, array_to_string(images, ',') as images, array_to_string(labels, ',') as labels, round(x0, 6) as x0, round(y0, 6) as y0, round(x1, 6) as x1, round(y1, 6) as y1, name, text from panels")
def annotated_panels(spark, d):
    """Panels of annotated figures, by branch, with their children and content."""
    panels = reconciled(*_inputs(spark, d))[0]
    return panels.select("fig", "panel_id", "branch", F.array_join(F.col("image_ids").cast("array<string>"), ",").alias("images"), F.array_join(F.col("label_ids").cast("array<string>"), ",").alias("labels"), *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")], "name", "text")


@query(FIGURES + """, kids as (select fig, panel_id, unnest(images || labels) as id from panels), k as (select kids.fig, kids.panel_id, b.* exclude (fig) from kids join b on b.id = kids.id),
s as (select fig, panel_id, bool_or(source = 'model') and count(*) filter (source = 'annotation') > 0 as anew, min(x0) filter (source = 'annotation') as a0, min(y0) filter (source = 'annotation') as b0, max(x1) filter (source = 'annotation') as a1, max(y1) filter (source = 'annotation') as b1 from k group by fig, panel_id),
w as (select panels.fig, panels.panel_id, case when anew then a0 else x0 end as x0, case when anew then b0 else y0 end as y0, case when anew then a1 else x1 end as x1, case when anew then b1 else y1 end as y1 from panels join s using (fig, panel_id))
select k.fig::bigint as fig, k.panel_id::bigint as panel_id, k.id::bigint as id, kind, round(case when source = 'model' then greatest(k.x0, w.x0) else k.x0 end, 6) as x0, round(case when source = 'model' then greatest(k.y0, w.y0) else k.y0 end, 6) as y0, round(case when source = 'model' then least(k.x1, w.x1) else k.x1 end, 6) as x1, round(case when source = 'model' then least(k.y1, w.y1) else k.y1 end, 6) as y1
from k join w using (fig, panel_id)""")
def annotated_children(spark, d):
    """Children of annotated panels; a model's boxes are cut to the content that the annotated ones span."""
    figures, boxes, *rest = _inputs(spark, d)
    kids = clipped_children(reconciled(figures, boxes, *rest)[0], boxes)[1]
    return kids.select("fig", "panel_id", "id", "kind", *[F.round(F.col("box")[c], 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query(FIGURES + """, l as (select fig, panel_id, text, unnest(labels) as label_id from panels)
select l.fig::bigint as fig, panel_id::bigint as panel_id, label_id::bigint as label_id, text as sub_caption_text, case when label_id % 3 = 0 then 'T' || label_id end as text, case when label_id % 3 = 0 then 0.5 + label_id % 10 / 20 end as confidence from l""")
def annotated_labels(spark, d):
    """Labels of annotated panels with the caption of their panel, and what was read on them."""
    figures, boxes, *rest = _inputs(spark, d)
    texts = boxes.where("kind = 'Label' and id % 3 = 0").selectExpr("fig", "id as label_id", "concat('T', id) as text", "0.5D + id % 10 / 20D as confidence")
    out = with_texts(reconciled(figures, boxes, *rest)[0], texts)
    return out.select("fig", "panel_id", F.explode("labels").alias("l")).select("fig", "panel_id", "l.*")
