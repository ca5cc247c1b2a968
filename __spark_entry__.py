"""

``entry(spark)`` runs the flagship query (heat map) on sf0.001;
``queries()`` maps every implemented operator to a callable
``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives, per query, DuckDB
SQL over the raw tables computing the same result by a different algorithm
(brute-force joins, slope-test hulls, un-tiled quadrant test).  The point and
box views of FIXTURES.md are inlined as CTEs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planar.functions import render
from planar.functions.geometry import box_ring, cross, dist2, normalize_boxes
from planar.operators.closest import closest_pair
from planar.operators.hull import (
    convex_hull,
    convex_hull_ring,
    farthest_pair,
    hull_chains,
    hull_closest_pair,
)
from planar.operators.joins import containment_join, containment_lists, heat_map, point_in_box_join
from planar.operators.range_query import range_query
from planar.operators.stats import distinct_points, extent
from planar.operators.union import box_union_vertices
from planar.plans.session import ensure_checkpoint_dir
from planar.sources import fixtures as fx
from planar.sources.fixtures import with_views
from planar.sources.text import ingest, one_part, parse_boxes, read_boxes, read_points, write_lines

# The training-data operators are optional: without their folder (and the
# pipeline built on it) everything else still works.
try:
    from planar.llm import queries as llm
except ImportError:
    llm = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SF_SMOKE = "/root/testdata/sf0.001"

# Query windows (fixed parameters of the registered queries).
WINDOW_PART = (2000.0, 2000.0, 30000.0, 12000.0)
CLOSEST_BASE = 256  # points that one task solves; larger sets take the grid join
WINDOW_EMB = (-0.1, -0.1, 0.1, 0.1)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: points-per-box heat map (boxes from part, points from events)."""
    return heat_map(fx.boxes_part(spark, SF_SMOKE), fx.points_ev(spark, SF_SMOKE))


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def _norm(spark, d):
    return normalize_boxes(fx.boxes_emb(spark, d)).select("id", "xmin", "ymin", "xmax", "ymax")


def _ring(spark, d):
    b = normalize_boxes(fx.boxes_part(spark, d))
    return b.select("id", F.posexplode(box_ring("xmin", "ymin", "xmax", "ymax")).alias("ord", "p")).select(
        "id", F.col("ord").cast("int").alias("ord"), "p.x", "p.y"
    )


def _as_lines(spark: SparkSession, d: str, view: str, cols: list[str], sep: str = ",", lead: bool = True, pad: str = "") -> DataFrame:
    """A fixture view as delimited lines in a ``value`` column: field 0 unused
    (``lead``), then the id if the view has one to carry, then ``cols``."""
    df = fx.VIEWS[view](spark, d)
    fields = [F.lit("0")] if lead else []
    fields += [F.concat(F.lit(pad), F.col(c).cast("string"), F.lit(pad)) for c in cols]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


_BOX_FIELDS = ["id", "x1", "y1", "x2", "y2"]


def _fresh(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _as_file(spark: SparkSession, lines: DataFrame) -> str:
    """The lines as text files."""
    path = _fresh(spark, "text")
    write_lines(lines, path)
    return path


def _text_range(spark, d):
    return range_query(read_boxes(spark, _as_file(spark, _as_lines(spark, d, "boxes_part", _BOX_FIELDS))), WINDOW_PART)


def _text_heat(spark, d):
    boxes = read_boxes(spark, _as_file(spark, _as_lines(spark, d, "boxes_part", _BOX_FIELDS)))
    return heat_map(boxes, read_points(spark, _as_file(spark, _as_lines(spark, d, "points_ev", ["id", "x", "y"]))))


def _text_boxes_id_first(spark, d):
    """Box lines with the id in field 0 and blanks around every field."""
    lines = _as_lines(spark, d, "boxes_emb", _BOX_FIELDS, lead=False, pad="  ")
    return read_boxes(spark, _as_file(spark, lines), id_col=0, first_coord=1)


def _text_points(spark, d):
    """Plain ``x, y`` lines."""
    lines = _as_lines(spark, d, "points_part", ["x", "y"], sep=", ", lead=False)
    return read_points(spark, _as_file(spark, lines), sep=", ", x_col=0, y_col=1)


def _text_rejects(spark, d):
    """Box lines of which some lost a field, a number or their id, read from
    files and written in one pass as good rows and rejects: the ids of the
    good ones, and the rejected lines."""
    v = F.col("value")
    n = F.split(v, ",")[1].cast("long")
    broken = (
        F.when(n % 5 == 0, F.substring_index(v, ",", 5)).when(n % 5 == 1, F.regexp_replace(v, "[^,]+$", "none"))
        .when(n % 5 == 2, F.regexp_replace(v, "^0,[^,]*", "0, ")).otherwise(v)
    )
    lines = _as_lines(spark, d, "boxes_part", _BOX_FIELDS).select(broken.alias("value"))
    good, bad = ingest(parse_boxes(spark, _as_file(spark, lines)), _fresh(spark, "boxes"))
    return good.select(F.lit("good").alias("kind"), F.col("id").alias("line")).unionByName(
        bad.select(F.lit("bad").alias("kind"), "line")
    )


def _single_file_lines(spark, d):
    """The rows that the single-file text sink writes, from one partition."""
    return one_part(render.format_range(range_query(fx.boxes_part(spark, d), WINDOW_PART)))


def _box_cross(spark, d):
    """Orientation of each box's centre against its raw corners, and the
    squared length of its diagonal."""
    b = fx.boxes_emb(spark, d)
    cx, cy = (F.col("x1") + F.col("y2")), (F.col("y1") - F.col("x2"))
    return b.select("id", cross("x1", "y1", "x2", "y2", cx, cy).alias("turn"), dist2("x1", "y1", "x2", "y2").alias("d2"))


def _mixed_boxes(spark, d):
    b = fx.boxes_part(spark, d)
    k = F.col("id") % 8
    wide, flat = F.when(k == 0, 40.0).when(k == 1, 8.0).otherwise(0.05), F.when(k == 0, 40.0).when(k == 2, 8.0).otherwise(0.05)
    return b.select(
        "id", "x1", "y1", (F.col("x1") + (F.col("x2") - F.col("x1")) * wide).alias("x2"),
        (F.col("y1") + (F.col("y2") - F.col("y1")) * flat).alias("y2"),
    )


def _outlier_boxes(spark, d):
    """Every box, the one of the smallest id moved far away."""
    b = fx.boxes_emb(spark, d)
    first = b.agg(F.min("id").alias("first"))
    far = F.when(F.col("id") == F.col("first"), F.lit(1e7)).otherwise(F.lit(0.0))
    return b.join(F.broadcast(first)).select("id", *[(F.col(c) + far).alias(c) for c in ("x1", "y1", "x2", "y2")])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "range_query": lambda s, d: range_query(fx.boxes_part(s, d), WINDOW_PART),
        "range_query_dense": lambda s, d: range_query(fx.boxes_emb(s, d), WINDOW_EMB),
        "normalize_boxes": _norm,
        "box_ring": _ring,
        "containment_join": lambda s, d: containment_join(fx.probes_ev(s, d), fx.boxes_part(s, d)),
        "containment_lists": lambda s, d: containment_lists(fx.probes_ev(s, d), fx.boxes_part(s, d)),
        "point_in_box_join": lambda s, d: point_in_box_join(fx.boxes_part(s, d), fx.points_ev(s, d)),
        "heat_map": lambda s, d: heat_map(fx.boxes_part(s, d), fx.points_ev(s, d)),
        "heat_map_dense": lambda s, d: heat_map(fx.boxes_emb(s, d), fx.points_emb(s, d)),
        "convex_hull_ring": lambda s, d: convex_hull_ring(fx.points_part(s, d)),
        "hull_chains": lambda s, d: hull_chains(fx.points_part(s, d)),
        "hull_closest_pair": lambda s, d: hull_closest_pair(fx.points_ev(s, d)),
        "extent": lambda s, d: extent(fx.points_ord(s, d)),
        "distinct_points": lambda s, d: distinct_points(fx.points_part(s, d)),
        "range_lines": lambda s, d: render.format_range(range_query(fx.boxes_part(s, d), WINDOW_PART)),
        "heat_lines": lambda s, d: render.format_heat(heat_map(fx.boxes_part(s, d), fx.points_ev(s, d))),
        "join_lines": lambda s, d: render.format_join(containment_lists(fx.probes_ev(s, d), fx.boxes_part(s, d))),
        "hull_lines": lambda s, d: render.format_hull(convex_hull(fx.points_part(s, d))),
        "farthest_lines": lambda s, d: render.format_pair(farthest_pair(fx.points_part(s, d))),
        "union_lines": lambda s, d: render.format_vertices(box_union_vertices(fx.boxes_part(s, d))),
    }
    for name in ("emb", "part", "ev", "ord", "line"):
        view = fx.VIEWS[f"points_{name}"]
        q[f"convex_hull_{name}"] = lambda s, d, v=view: convex_hull(v(s, d))
    for name in ("emb", "part", "ev"):
        view = fx.VIEWS[f"points_{name}"]
        q[f"farthest_pair_{name}"] = lambda s, d, v=view: farthest_pair(v(s, d))
    for name in ("emb", "part", "ev", "ord", "line"):
        view = fx.VIEWS[f"points_{name}"]
        q[f"closest_pair_{name}"] = lambda s, d, v=view: closest_pair(v(s, d), base_rows=CLOSEST_BASE)
    for name in ("part", "emb"):
        view = fx.VIEWS[f"boxes_{name}"]
        q[f"box_union_vertices_{name}"] = lambda s, d, v=view: box_union_vertices(v(s, d))
    for name in ("emb", "ev", "ord"):
        view = fx.VIEWS[f"points_{name}"]
        q[f"convex_hull_ring_{name}"] = lambda s, d, v=view: convex_hull_ring(v(s, d))
        q[f"hull_chains_{name}"] = lambda s, d, v=view: hull_chains(v(s, d))
    q["farthest_pair_ord"] = lambda s, d: farthest_pair(fx.points_ord(s, d))
    q["point_in_box_join_dense"] = lambda s, d: point_in_box_join(fx.boxes_emb(s, d), fx.points_emb(s, d))
    # Text sources: the views written as delimited lines, read and parsed back.
    q["text_range_query"] = _text_range
    q["text_heat_map"] = _text_heat
    q["text_boxes_id_first"] = _text_boxes_id_first
    q["text_points"] = _text_points
    q["text_rejects"] = _text_rejects
    q["single_file_lines"] = _single_file_lines
    q["box_cross"] = _box_cross
    # Large and small boxes, thin boxes and one far-off box in one set.
    q["heat_map_mixed"] = lambda s, d: heat_map(_mixed_boxes(s, d), fx.points_ev(s, d))
    q["point_in_box_join_outlier"] = lambda s, d: point_in_box_join(_outlier_boxes(s, d), fx.points_emb(s, d))
    if llm is not None:
        q |= llm.queries()
    if corpus_pipeline is not None:
        q["pipeline"] = corpus_pipeline.run
    return q


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------
def _B(boxes: str) -> str:
    return (
        f"B as (select id, least(x1,x2) xmin, greatest(x1,x2) xmax, least(y1,y2) ymin, "
        f"greatest(y1,y2) ymax from {boxes})"
    )


_PROBE_IN = (
    "q.x1>r.xmin and q.x2>r.xmin and q.x1<r.xmax and q.x2<r.xmax "
    "and q.y1>r.ymin and q.y2>r.ymin and q.y1<r.ymax and q.y2<r.ymax"
)
_POINT_IN = "p.x>r.xmin and p.x<r.xmax and p.y>r.ymin and p.y<r.ymax"


def _range_sql(view: str, w) -> str:
    lx, ly, hx, hy = min(w[0], w[2]), min(w[1], w[3]), max(w[0], w[2]), max(w[1], w[3])
    return (
        with_views(view)
        + f"select id,x1,y1,x2,y2 from {view} where x1 between {lx} and {hx} and x2 between {lx} and {hx} "
        f"and y1 between {ly} and {hy} and y2 between {ly} and {hy}"
    )


def _heat_sql(boxes: str, points: str) -> str:
    return (
        with_views(boxes, points)
        + f", {_B(boxes)} select r.id, count(p.x) n from B r left join {points} p on {_POINT_IN} group by r.id"
    )


def _lists_sql() -> str:
    return (
        with_views("probes_ev", "boxes_part")
        + f", {_B('boxes_part')} select q.id, coalesce(string_agg(r.id::varchar, ',' order by r.xmin, r.id), '') ids "
        f"from probes_ev q left join B r on {_PROBE_IN} group by q.id"
    )


def _hull_ctes(points: str) -> str:
    """Slope test: a column top is an upper-hull vertex when every slope
    into it from the left exceeds every slope out of it to the right."""
    return (
        with_views(points)
        + f""", p as (select distinct x,y from {points}),
u as (select x,max(y) ymax,min(y) ymin from p group by x),
up as (select x,y from (select b.x,b.ymax y, min((b.ymax-a.ymax)/(b.x-a.x)) filter(a.x<b.x) l,
                               max((a.ymax-b.ymax)/(a.x-b.x)) filter(a.x>b.x) r from u b join u a on true group by all)
       where l is null or r is null or l>r),
lo as (select x,y from (select b.x,b.ymin y, max((b.ymin-a.ymin)/(b.x-a.x)) filter(a.x<b.x) l,
                               min((a.ymin-b.ymin)/(a.x-b.x)) filter(a.x>b.x) r from u b join u a on true group by all)
       where l is null or r is null or l<r)
"""
    )


def _hull_sql(points: str) -> str:
    return _hull_ctes(points) + "select x,y from up union select x,y from lo"


def _ring_sql(points: str) -> str:
    return _hull_ctes(points) + """, st as (select x,y from p order by x,y limit 1),
o as (select 0 g, x k, x, y from st
      union all select 1, x, x, y from up where (x,y) not in (select (x,y) from st)
      union all select 2, -x, x, y from lo where (x,y) not in (select (x,y) from up) and (x,y) not in (select (x,y) from st))
select (row_number() over (order by g,k) - 1)::int ord, x, y from o"""


def _chains_sql(points: str) -> str:
    return _hull_ctes(points) + "select 'upper' chain,x,y from up union all select 'lower',x,y from lo"


def _pair_sql(points: str, desc: bool) -> str:
    order = "d2 desc" if desc else "d2"
    return (
        with_views(points)
        + f""", p as (select distinct x,y from {points})
select a.x ax,a.y ay,b.x bx,b.y "by",(a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) d2
from p a join p b on a.x<b.x or (a.x=b.x and a.y<b.y)
order by {order}, ax, ay, bx, "by" limit 1"""
    )


def _band_closest_sql(points: str) -> str:
    """Closest pair without an all-pairs scan: the nearest lexicographic
    neighbours give an upper bound d, and every closer pair lies in the band
    |dx| <= d, |dy| <= d (an inequality join); the slack covers the rounding
    of the square root."""
    return (
        with_views(points)
        + f""", p as (select distinct x, y from {points}),
s as (select x, y, lag(x) over (order by x, y) px, lag(y) over (order by x, y) py from p),
bound as (select sqrt(min((x-px)*(x-px)+(y-py)*(y-py))) * 1.000001 d from s where px is not null)
select a.x ax, a.y ay, c.x bx, c.y "by", (a.x-c.x)*(a.x-c.x)+(a.y-c.y)*(a.y-c.y) d2
from p a cross join bound join p c
  on c.x between a.x - bound.d and a.x + bound.d and c.y between a.y - bound.d and a.y + bound.d
 and (a.x < c.x or (a.x = c.x and a.y < c.y))
order by d2, ax, ay, bx, "by" limit 1"""
    )


def _hull_closest_sql(points: str) -> str:
    return _hull_ctes(points) + """, h as (select x,y from up union select x,y from lo)
select a.x ax,a.y ay,b.x bx,b.y "by",(a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) d2
from h a join h b on a.x<b.x and a.y<>b.y
order by d2, ax, ay, bx, "by" limit 1"""


def _union_sql(boxes: str) -> str:
    return (
        with_views(boxes)
        + f""", {_B(boxes)},
r as (select xmin,xmax,ymin,ymax from B where xmin<xmax and ymin<ymax),
v as (select distinct xmin x,ymin,ymax from r union select distinct xmax,ymin,ymax from r),
h as (select distinct ymin y,xmin,xmax from r union select distinct ymax,xmin,xmax from r),
c as (select distinct v.x,h.y from v join h on h.y between v.ymin and v.ymax and v.x between h.xmin and h.xmax),
q as (select c.x,c.y,
  bool_or(r.xmin< c.x and r.xmax>=c.x and r.ymin< c.y and r.ymax>=c.y) sw,
  bool_or(r.xmin<=c.x and r.xmax> c.x and r.ymin< c.y and r.ymax>=c.y) se,
  bool_or(r.xmin< c.x and r.xmax>=c.x and r.ymin<=c.y and r.ymax> c.y) nw,
  bool_or(r.xmin<=c.x and r.xmax> c.x and r.ymin<=c.y and r.ymax> c.y) ne
  from c join r on c.x between r.xmin and r.xmax and c.y between r.ymin and r.ymax group by all)
select x,y from q where sw::int+se::int+nw::int+ne::int in (1,3)
  or (sw and ne and not se and not nw) or (se and nw and not sw and not ne)"""
    )


def oracle_sql() -> dict[str, str]:
    o = {
        "range_query": _range_sql("boxes_part", WINDOW_PART),
        "range_query_dense": _range_sql("boxes_emb", WINDOW_EMB),
        "normalize_boxes": with_views("boxes_emb")
        + "select id, least(x1,x2) xmin, least(y1,y2) ymin, greatest(x1,x2) xmax, greatest(y1,y2) ymax from boxes_emb",
        "box_ring": with_views("boxes_part")
        + f", {_B('boxes_part')} "
        "select id, 0 ord, xmin x, ymin y from B union all select id, 1, xmax, ymin from B "
        "union all select id, 2, xmax, ymax from B union all select id, 3, xmin, ymax from B "
        "union all select id, 4, xmin, ymin from B",
        "containment_join": with_views("probes_ev", "boxes_part")
        + f", {_B('boxes_part')} select q.id probe_id, r.id box_id from probes_ev q join B r on {_PROBE_IN}",
        "containment_lists": _lists_sql(),
        "point_in_box_join": with_views("boxes_part", "points_ev")
        + f", {_B('boxes_part')} select r.id box_id, p.id point_id from B r join points_ev p on {_POINT_IN}",
        "heat_map": _heat_sql("boxes_part", "points_ev"),
        "heat_map_dense": _heat_sql("boxes_emb", "points_emb"),
        "convex_hull_ring": _ring_sql("points_part"),
        "hull_chains": _chains_sql("points_part"),
        "hull_closest_pair": _hull_closest_sql("points_ev"),
        "extent": with_views("points_ord")
        + "select min(x) xmin, min(y) ymin, max(x) xmax, max(y) ymax from points_ord",
        "distinct_points": with_views("points_part") + "select distinct x, y from points_part",
        "range_lines": f"select 'ID: ' || id || '  Coordinates:  ' || x1 || ', ' || y1 || ';   ' || x2 || ',  ' || y2 "
        f"as line from ({_range_sql('boxes_part', WINDOW_PART)})",
        "heat_lines": f"select '(' || id || ',' || n || ')' as line from ({_heat_sql('boxes_part', 'points_ev')})",
        "join_lines": f"select id || ': ' || ids as line from ({_lists_sql()})",
        "hull_lines": f"select x || ',  ' || y as line from ({_hull_sql('points_part')})",
        "farthest_lines": f"select unnest([ax || ',' || ay, bx || ',' || \"by\"]) as line "
        f"from ({_pair_sql('points_part', True)})",
        "union_lines": f"select '(' || x || ', ' || y || ', NaN)' as line from ({_union_sql('boxes_part')})",
    }
    for name in ("emb", "part", "ev", "ord", "line"):
        o[f"convex_hull_{name}"] = _hull_sql(f"points_{name}")
    for name in ("emb", "part", "ev"):
        o[f"farthest_pair_{name}"] = _pair_sql(f"points_{name}", True)
    for name in ("emb", "part", "ev", "ord"):
        o[f"closest_pair_{name}"] = _pair_sql(f"points_{name}", False)
    for name in ("part", "emb"):
        o[f"box_union_vertices_{name}"] = _union_sql(f"boxes_{name}")
    for name in ("emb", "ev", "ord"):
        o[f"convex_hull_ring_{name}"] = _ring_sql(f"points_{name}")
        o[f"hull_chains_{name}"] = _chains_sql(f"points_{name}")
    o["farthest_pair_ord"] = _pair_sql("points_ord", True)
    # 60k points at sf0.01: an all-pairs scan is too slow, the band join is not.
    o["closest_pair_line"] = _band_closest_sql("points_line")
    o["point_in_box_join_dense"] = (
        with_views("boxes_emb", "points_emb")
        + f", {_B('boxes_emb')} select r.id box_id, p.id point_id from B r join points_emb p on {_POINT_IN}"
    )
    o["text_range_query"] = (
        f"select id::varchar id, x1, y1, x2, y2 from ({_range_sql('boxes_part', WINDOW_PART)})"
    )
    o["text_heat_map"] = f"select id::varchar id, n from ({_heat_sql('boxes_part', 'points_ev')})"
    o["text_boxes_id_first"] = with_views("boxes_emb") + "select id::varchar id, x1, y1, x2, y2 from boxes_emb"
    o["text_points"] = with_views("points_part") + "select x, y from points_part"
    o["text_rejects"] = with_views("boxes_part") + """, t as (
select id, '0,' || id || ',' || x1 || ',' || y1 || ',' || x2 a, y2::varchar z from boxes_part)
select case when id % 5 > 2 then 'good' else 'bad' end kind,
       case id % 5 when 0 then a when 1 then a || ',none' when 2 then '0, ' || substr(a, length('0,' || id) + 1) || ',' || z
            else id::varchar end as line from t"""
    o["single_file_lines"] = f"select line as value from ({o['range_lines']})"
    o["box_cross"] = with_views("boxes_emb") + """select id,
  (x2-x1)*((y1-x2)-y1) - (y2-y1)*((x1+y2)-x1) turn, (x1-x2)*(x1-x2)+(y1-y2)*(y1-y2) d2 from boxes_emb"""
    o["heat_map_mixed"] = with_views("boxes_part", "points_ev") + f""", M as (select id, x1, y1,
  x1 + (x2-x1) * case id % 8 when 0 then 40.0::double when 1 then 8.0::double else 0.05::double end x2,
  y1 + (y2-y1) * case id % 8 when 0 then 40.0::double when 2 then 8.0::double else 0.05::double end y2 from boxes_part),
{_B('M')} select r.id, count(p.x) n from B r left join points_ev p on {_POINT_IN} group by r.id"""
    o["point_in_box_join_outlier"] = with_views("boxes_emb", "points_emb") + f""", f as (select min(id) i from boxes_emb),
M as (select id, x1 + k x1, y1 + k y1, x2 + k x2, y2 + k y2
      from (select b.*, case when id = f.i then 1e7::double else 0.0::double end k from boxes_emb b join f on true)),
{_B('M')} select r.id box_id, p.id point_id from B r join points_emb p on {_POINT_IN}"""
    if llm is not None:
        o |= llm.oracle_sql()
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        o["pipeline"] = corpus_pipeline.ORACLE_SQL
    return o
