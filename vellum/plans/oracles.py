"""SQL equivalents of the core's queries, for an independent engine over the same tables."""

from __future__ import annotations

_DET = """det as (select *, x0 + cast((q * 8 + 20) * (case when class_id = 1 then 3 else 1 end) as int) as x1, y0 + (case when class_id = 1 then 300 else 30 end) as y1
 from (select l_orderkey as page_id, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) - 1 as int) as det_id,
 case l_linenumber % 4 when 0 then 0 when 1 then 1 when 2 then 2 else 3 end as class_id, 1 - l_discount as confidence, exp(-10 * l_tax) as text_conf,
 cast((l_partkey % 40) * 20 as int) as x0, cast((l_suppkey % 50) * 20 as int) as y0, l_quantity as q from lineitem)),
lin as (select * from det where class_id >= 2), reg as (select *, cast(det_id as varchar) as region_id from det where class_id = 1)"""
_CUR = "cur as (select * from line_texts where page_id is not null and line_pos is not null qualify row_number() over (partition by page_id, line_pos order by recognised_at desc nulls last, line_uid desc, region_id desc, polygon desc, text desc, conf desc, text_conf desc, row_length desc) = 1)"
_COLS = "page_id, det_id, class_id, round(confidence, 6) as confidence, round(text_conf, 6) as text_conf, x0, y0, x1, y1"


def _inter(a: str, b: str) -> str:
    return f"(greatest(least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0), 0)::double * greatest(least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0), 0))"


def _area(a: str) -> str:
    return f"(({a}.x1 - {a}.x0)::double * ({a}.y1 - {a}.y0))"


def _ratio(a: str, b: str) -> str:
    return f"(case when {b} > 0 then {a} / {b} else 0.0 end)"


def _iou(a: str, b: str) -> str:
    return _ratio(_inter(a, b), f"({_area(a)} + {_area(b)} - {_inter(a, b)})")


def _ios(a: str, b: str) -> str:
    return _ratio(_inter(a, b), f"least({_area(a)}, {_area(b)})")


def _interval(axis: str, a: str = "a", b: str = "b") -> str:
    p, q = f"{axis}0", f"{axis}1"
    return _ratio(f"greatest(least({a}.{q}, {b}.{q}) - greatest({a}.{p}, {b}.{p}), 0)::double", f"(greatest({a}.{q}, {b}.{q}) - least({a}.{p}, {b}.{p}))::double")


_MEET = "a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1"
_PAIRS = f"lin a join lin b on a.page_id = b.page_id and a.det_id < b.det_id and {_MEET}"
_DIST = "sqrt(power(greatest(0, a.x0 - b.x1, b.x0 - a.x1)::double, 2) + power(greatest(0, a.y0 - b.y1, b.y0 - a.y1)::double, 2))"
_EDGE = f"edge as (select a.page_id, a.det_id as i, b.det_id as j, {_iou('a', 'b')} * {_interval('y')} > 0.3 as by_iou, {_ios('a', 'b')} * {_interval('y')} > 0.5 as by_share from {_PAIRS}), edges as (select page_id, i, j, case when by_iou then 'iou' else 'share' end as why from edge where by_iou or by_share)"
_COMP = "reach as (select page_id, det_id as i, det_id as j from lin union select r.page_id, r.i, case when e.i = r.j then e.j else e.i end from reach r join edges e on e.page_id = r.page_id and (e.i = r.j or e.j = r.j)), comp as (select page_id, i as det_id, min(j) as root from reach group by 1, 2)"
_MAPPED = "mapped as (select page_id, det_id, dense_rank() over (partition by page_id order by root) - 1 as out_id from comp)"
_ASSIGN = f"""pair as (select a.page_id, a.det_id as line_id, b.region_id, b.det_id as region_pos, {_iou('a', 'b')} as iou, {_DIST} as dist from lin a join reg b on a.page_id = b.page_id),
best as (select * from pair where iou > 0 qualify row_number() over (partition by page_id, line_id order by iou desc, region_pos) = 1),
near as (select p.* from pair p anti join best b on p.page_id = b.page_id and p.line_id = b.line_id where dist < 1000000 qualify row_number() over (partition by page_id, line_id order by dist, region_pos) = 1),
asg as (select l.page_id, l.det_id as line_id, coalesce(b.region_id, n.region_id) as region_id, case when b.region_id is not null then 'overlap' when n.region_id is not null then 'nearest' else 'none' end as how
 from lin l left join best b on l.page_id = b.page_id and l.det_id = b.line_id left join near n on l.page_id = n.page_id and l.det_id = n.line_id)"""


def _row(a: str, b: str) -> str:
    return f"(least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0) > 0.5 * (({a}.y1 - {a}.y0) + ({b}.y1 - {b}.y0)) / 2)"


def _precedes(a: str, b: str, rl: bool = False) -> str:
    return f"(case when {_row(a, b)} then {a}.x0 {'>' if rl else '<'} {b}.x0 else {a}.y0 < {b}.y0 end)"


def _ranked(source: str, keys: str, ident: str, rl: bool = False) -> str:
    """Rank by the number of boxes before; right for groups without a cycle."""
    on = " and ".join(f"u.{k.strip()} = v.{k.strip()}" for k in keys.split(","))
    cols = ", ".join(f"u.{k.strip()}" for k in keys.split(","))
    before = f"case when v.{ident} < u.{ident} then {_precedes('v', 'u', rl)} when v.{ident} > u.{ident} then not {_precedes('u', 'v', rl)} else false end"
    return f"select {cols}, u.{ident}, sum(case when {before} then 1 else 0 end)::int as ord from {source} u join {source} v on {on} group by {cols}, u.{ident}"


_FLAT = "placed as (select l.page_id, cast(a.region_id as int) as region_ord, l.det_id as line_id, cast(row_number() over (partition by l.page_id, a.region_id order by l.y0, l.x0, l.det_id) - 1 as int) as line_ord from asg a join lin l on a.page_id = l.page_id and a.line_id = l.det_id where a.region_id is not null), flat as (select page_id, region_ord, line_ord, line_id, cast(row_number() over (partition by page_id order by region_ord, line_ord) - 1 as int) as line_pos from placed)"


def _nms(keys: str, metric, t: float) -> str:
    on = " and ".join(f"s.{k} = k.{k}" for k in keys.split(", "))
    hit = f"len(list_filter(k.kept, lambda b: {metric('b', 's')} > {t})) > 0"
    return f"""with recursive {_DET}, s as (select *, row_number() over (partition by {keys} order by confidence desc, det_id) as rn from det),
k as (select page_id, class_id, det_id, confidence, rn, [struct_pack(x0 := x0, y0 := y0, x1 := x1, y1 := y1)] as kept, true as stays from s where rn = 1
union all select s.page_id, s.class_id, s.det_id, s.confidence, s.rn, case when {hit} then k.kept else list_append(k.kept, struct_pack(x0 := s.x0, y0 := s.y0, x1 := s.x1, y1 := s.y1)) end, not {hit} from k join s on {on} and s.rn = k.rn + 1)
select page_id, det_id, class_id, round(confidence, 6) as confidence from k where stays"""


def _partial(compat: bool) -> str:
    a, b, c, d = ("x0", "y0", "x1", "y1") if compat else ("x1", "x0", "y1", "y0")
    return f"""with {_DET}, t as (select page_id, det_id as id, {a} as a, {b} as b, {c} as c, {d} as d from lin)
select u.page_id, u.id as i, v.id as j from t u join t v on u.page_id = v.page_id where (u.b < v.a and u.a > v.b and u.d < v.d) or (not (u.b < v.a and u.a > v.b) and u.a < v.b and ((u.d < v.c and u.c > v.d) or not exists (
select 1 from t w where w.page_id = u.page_id and not (w.a = u.a and w.b = u.b and w.c = u.c and w.d = u.d) and not (w.a = v.a and w.b = v.b and w.c = v.c and w.d = v.d) and w.c >= least(u.d, v.d) and w.d <= greatest(u.c, v.c) and w.b < u.a and w.a > v.b)))"""


def _starts(size: str, s: int, o: int) -> str:
    if not o:
        return f"case when {size} <= {s} then [0] else range(0, {size}, {s}) end"
    return f"case when {size} <= {s} then [0] else list_append(range(0, {size} - {s}, {s - o}), {size} - {s}) end"


def _tiles(o: int) -> str:
    return f"""with g as (select page_id, width, height, {_starts('height', 640, o)} as ys, {_starts('width', 640, o)} as xs from pages where width > 0 and height > 0),
y as (select *, unnest(ys) as y0, generate_subscripts(ys, 1) - 1 as iy from g), x as (select *, unnest(xs) as x0, generate_subscripts(xs, 1) - 1 as ix from y)
select page_id, cast(iy * len(xs) + ix as int) as tile_id, cast(x0 as int) as x0, cast(y0 as int) as y0, cast(least(x0 + 640, width) as int) as x1, cast(least(y0 + 640, height) as int) as y1 from x"""


_MOVED = "mv as (select page_id, det_id, det_id % 4 as tile_id, x0 + (det_id % 4 % 2) * 284 as x0, y0 + cast(floor(det_id % 4 / 2.0) as int) * 540 as y0, x1 + (det_id % 4 % 2) * 284 as x1, y1 + cast(floor(det_id % 4 / 2.0) as int) * 540 as y1 from det)"
_PTS = "array_to_string(list_transform(coords, lambda p: concat(p.x, ',', p.y)), ' ')"


def _rounded(c: str) -> str:
    return f"cast(cast(printf('%.2f', {c}) as double) as varchar)"


def _esc(c: str) -> str:
    return f"replace(replace(replace(replace(coalesce({c}::varchar, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


_NAMED = "nr as (select page_id, region_id, name, coords, cast(row_number() over (partition by page_id order by region_id) - 1 as int) as region_ord from regions where page_id is not null), ids as (select *, concat(coalesce(name, 'region'), '_', row_number() over (partition by page_id, name order by region_ord) - 1) as xml_id from nr)"
_LINED = "ln as (select c.*, i.region_ord, i.xml_id, cast(row_number() over (partition by c.page_id, i.region_ord order by line_pos) - 1 as int) as line_ord from cur c join ids i on c.page_id = i.page_id and c.region_id = i.region_id)"
_STRIP = "regexp_replace(text, '^[\\s\\x{1c}-\\x{1f}\\x{85}\\p{Z}]+|[\\s\\x{1c}-\\x{1f}\\x{85}\\p{Z}]+$', '', 'g')"


def _pointlist(c: str, tail: str = "") -> str:
    return f"coalesce(array_to_string(list_transform({c}, lambda p: concat(p.x, ',', p.y)), ' ') || '{tail}', '')"


_DECL = '<?xml version="1.0" encoding="UTF-8"?>'
_PAGE_XML = f"""with {_CUR}, {_NAMED}, {_LINED},
lx as (select page_id, region_ord, string_agg(concat('<TextLine id="r', region_ord, 'l', line_ord, '" custom="readingOrder {{index:', line_ord, ';}}"><Coords points="', {_pointlist('polygon')}, '"/><Baseline points=""/><TextEquiv><Unicode>', {_esc(_STRIP)}, '</Unicode></TextEquiv></TextLine>'), '' order by line_ord) as x from ln group by 1, 2),
rx as (select i.page_id, string_agg(concat('<TextRegion id="r', i.region_ord, '" custom="readingOrder {{index:', i.region_ord, ';}}"><Coords points="', {_pointlist('coords')}, '"/>', lx.x, '</TextRegion>'), '' order by i.region_ord) as x from ids i join lx on i.page_id = lx.page_id and i.region_ord = lx.region_ord group by 1)
select p.page_id, concat('{_DECL}', chr(10), '<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"><Metadata><Creator>vellum</Creator><Created>2024-01-01T00:00:00.000000+02:00</Created><LastChange>2024-01-01T00:00:00.000000+02:00</LastChange></Metadata><Page imageFilename="', {_esc('img_name')}, '" imageWidth="', width, '" imageHeight="', height, '">', rx.x, '</Page></PcGts>') as xml from pages p join rx on p.page_id = rx.page_id"""
_STEPS = "".join(
    f'<Processing ID="{i}"><processingAgency>vellum</processingAgency><processingStepDescription>{what}</processingStepDescription><processingSoftware><softwareCreator>plug-in</softwareCreator>'
    f"<softwareName>{name}</softwareName><softwareVersion>{version}</softwareVersion></processingSoftware></Processing>"
    for i, what, name, version in (
        ("TEXT_REGION_SEGMENTATION", "Regions from masks", "detector", "regions"), ("TEXT_LINE_SEGMENTATION", "Lines from masks", "detector", "lines"), ("TEXT_RECOGNITION", "Texts from line images", "recogniser", "text"),
    )
)
_ALTO_XML = f"""with {_CUR}, {_NAMED}, {_LINED}, st as (select * from page_stats where page_id is not null qualify row_number() over (partition by page_id order by computed_at desc nulls last, img_name desc, height desc, width desc, page_conf_mean desc, page_conf_median desc, page_conf_25 desc, page_conf_75 desc, n_long_rowtext desc nulls last, language desc nulls last) = 1),
lx as (select page_id, region_ord, string_agg(concat('<TextLine ID="', {_esc("concat(xml_id, '_line_', line_ord)")}, '"><Shape><Polygon POINTS="', {_pointlist('polygon', ' ')}, '"/></Shape><String ID="', {_esc("concat(xml_id, '_line_', line_ord)")}, '" CONTENT="', {_esc('text')}, '" RL="', {_esc('row_length')}, '" WC="', {_esc(_rounded('text_conf'))}, '"/></TextLine>'), '' order by line_ord) as x from ln group by 1, 2),
rx as (select i.page_id, string_agg(concat('<TextBlock ID="', {_esc('xml_id')}, '"><Shape><Polygon POINTS="', {_pointlist('coords', ' ')}, '"/></Shape>', lx.x, '</TextBlock>'), '' order by i.region_ord) as x from ids i join lx on i.page_id = lx.page_id and i.region_ord = lx.region_ord group by 1)
select p.page_id, concat('{_DECL}', chr(10), '<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#" xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="http://www.loc.gov/standards/alto/ns-v4# http://www.loc.gov/standards/alto/v4/alto-4-0.xsd"><Description><MeasurementUnit>mm10</MeasurementUnit><sourceImageInformation><fileName>', {_esc('p.img_name')}, '</fileName></sourceImageInformation>{_STEPS}</Description><Styles/><Layout><Page ID="', {_esc('p.img_name')}, '" WIDTH="', p.width, '" HEIGHT="', p.height,
{", ".join(f"""'" {n}="', printf('%.2f', coalesce({c}, 0.0))""" for n, c in (("PC", "page_conf_mean"), ("PC50", "page_conf_median"), ("PC25", "page_conf_25"), ("PC75", "page_conf_75")))},
'" N_LONG_ROWTEXT="', {_esc('n_long_rowtext')}, '" LANGUAGE="', {_esc('language')}, '" PHYSICAL_IMG_NR="0"><PrintSpace HPOS="0" VPOS="0" WIDTH="', p.width, '" HEIGHT="', p.height, '">', rx.x, '</PrintSpace></Page></Layout></alto>') as xml from pages p join st on p.page_id = st.page_id join rx on p.page_id = rx.page_id"""
_STATS = "page_id, coalesce(avg(text_conf), 0.0) as m, coalesce(median(text_conf), 0.0) as md, coalesce(quantile_cont(text_conf, 0.25), 0.0) as q1, coalesce(quantile_cont(text_conf, 0.75), 0.0) as q3, count(*) filter (where length(text) > 100) as n_long_rowtext, count(*) as n_lines"


# pages without a region have one of the whole page
_WHOLE = "whole as (select page_id, region_id, det_id, x0, y0, x1, y1 from reg union all select distinct page_id, '0', 0, 0, 0, 2400, 3200 from lin where page_id not in (select page_id from reg))"


def _peeled(name: str, source: str, keys: str, ident: str = "det_id") -> str:
    """CTEs that order every group: next comes what all predecessors of went out, by the last of them, then by number; else
    the topmost, leftmost box that is left.  ``name``: keys, list of ids in order."""
    first = f"case when v.{ident} < u.{ident} then {_precedes('v', 'u')} when v.{ident} > u.{ident} then not {_precedes('u', 'v')} else false end"
    on = " and ".join(f"u.{k.strip()} = v.{k.strip()}" for k in keys.split(","))
    same = " and ".join(f"s.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    own, state = ", ".join(f"u.{k.strip()}" for k in keys.split(",")), ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    ready = "list_has_all(s.o, p.before)"
    key = f"case when {ready} then [0.0, coalesce(list_max(list_transform(p.before, lambda q: list_position(s.o, q))), 0)::double, p.id::double] else [1.0, p.y0::double, p.x0::double] end"
    return f"""{name}_p as (select {own}, u.{ident} as id, u.x0, u.y0, coalesce(list(v.{ident}) filter (where {first}), []) as before from {source} u join {source} v on {on} group by {own}, u.{ident}, u.x0, u.y0),
{name}_r as (select distinct {keys}, []::int[] as o, 0 as n from {source} union all select {state}, list_append(s.o, arg_min(p.id, {key})), s.n + 1 from {name}_r s join {name}_p p on {same} and not list_contains(s.o, p.id) group by {state}, s.o, s.n),
{name}_l as (select {keys}, arg_max(o, n) as o from {name}_r group by {keys}),
{name} as (select {keys}, unnest(o) as id, cast(generate_subscripts(o, 1) - 1 as int) as ord from {name}_l)"""


def _order_regions() -> str:
    assigned = _ASSIGN.replace("join reg b", "join whole b")
    inside = "ins as (select l.*, a.region_id from lin l join asg a on l.page_id = a.page_id and l.det_id = a.line_id where a.region_id is not null)"
    used = "used as (select * from whole w where exists (select 1 from ins i where i.page_id = w.page_id and i.region_id = w.region_id))"
    return f"""with recursive {_DET}, {_WHOLE}, {assigned}, {inside}, {used}, {_peeled("lo", "ins", "page_id, region_id")}, {_peeled("ro", "used", "page_id")}
select lo.page_id, lo.region_id, lo.id as line_id, ro.ord as region_ord, lo.ord as line_ord from lo join ro on lo.page_id = ro.page_id and lo.region_id = cast(ro.id as varchar)"""


def _language_id() -> str:
    from vellum.operators.stats import _WORDS

    hits = ", ".join(f"sum(len(list_filter(w, lambda x: x in ({', '.join(repr(v) for v in words.split())})))) as {k}" for k, words in _WORDS.items())
    long = " union all ".join(f"select page_id, {k} as n, '{k}' as k from h" for k in _WORDS)
    return f"""with {_CUR}, t as (select page_id, regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}]+') as w from cur), h as (select page_id, {hits} from t group by 1), a as ({long}),
b as (select * from a qualify row_number() over (partition by page_id order by n desc, k desc) = 1) select page_id, case when n > 0 then k else 'unknown' end as language from b"""


def oracle_sql() -> dict[str, str]:
    box = lambda v: f"with {_DET} select a.page_id, a.det_id as i, b.det_id as j, round({v}, 9) as value from {_PAIRS}"
    merged = f"with recursive {_DET}, {_EDGE}, {_COMP}"
    flat = f"with {_DET}, {_ASSIGN}, {_FLAT}"
    return {
        "flagship": f"""with {_DET}, {_ASSIGN}, o as ({_ranked('lin', 'page_id', 'det_id')})
select a.page_id, count(*) as n_lines, count(*) filter (where how = 'overlap') as n_overlap, count(*) filter (where how = 'nearest') as n_nearest, arg_min(a.line_id, o.ord) as first_line, round(avg(l.text_conf), 6) as page_conf_mean
from asg a join o on a.page_id = o.page_id and a.line_id = o.det_id join lin l on a.page_id = l.page_id and a.line_id = l.det_id group by 1""",
        "fx_detections": f"with {_DET} select {_COLS} from det",
        "fx_lines": f"with {_DET} select {_COLS} from lin",
        "fx_regions": f"with {_DET} select page_id, region_id, det_id as region_pos, x0, y0, x1, y1 from reg",
        "conf_filter": f"with {_DET} select page_id, det_id, confidence from det where confidence > 0.95",
        "class_split": f"with {_DET} select page_id, det_id, case when class_id >= 2 then 'line' else 'region' end as kind from det where class_id >= 1",
        "area_filter": f"with {_DET} select page_id, det_id, round({_area('det')} / 3840000.0, 9) as area_fraction from det where round({_area('det')} / 3840000.0, 9) > 0.003",
        "sliver_filter": f"with {_DET} select page_id, det_id from lin where least(x1 - x0, y1 - y0) > 0.01 * 2400",
        "box_features": f"with {_DET} select page_id, det_id, (x0 + x1) / 2.0::double as cx, (y0 + y1) / 2.0::double as cy, x1 - x0 as w, y1 - y0 as h, least(x1 - x0, y1 - y0) as thickness from lin",
        "bbox_of_polygon": "select page_id, region_id, list_min(list_transform(coords, lambda p: p.x)) as x_min, list_min(list_transform(coords, lambda p: p.y)) as y_min, list_max(list_transform(coords, lambda p: p.x)) as x_max, list_max(list_transform(coords, lambda p: p.y)) as y_max from regions",
        "shoelace_area": "select page_id, region_id, case when coords is null then null when len(coords) < 3 then 0.0::double else abs(list_sum(list_transform(range(1, len(coords) + 1), lambda i: coords[i].x::double * coords[i % len(coords) + 1].y - coords[i % len(coords) + 1].x::double * coords[i].y))) / 2 end as area from regions",
        "valid_polygon": "select page_id, region_id, coalesce(len(coords) >= 3, false) as is_valid from regions",
        "scale_polygon": "select page_id, region_id, cast(k - 1 as int) as at, cast(round_even(coords[k].x * 0.37::double, 0) as int) as x, cast(round_even(coords[k].y * 0.61::double, 0) as int) as y from (select *, unnest(range(1, len(coords) + 1)) as k from regions where coords is not null)",
        "points_page": f"select page_id, region_id, {_PTS} as points from regions",
        "points_alto": f"select page_id, region_id, {_PTS} || ' ' as points from regions",
        "resize_dims_long": "select page_id, case when height > 768 or width > 768 then cast(floor(height * least(768.0::double / height, 768.0::double / width)) as int) else height end as new_height, case when height > 768 or width > 768 then cast(floor(width * least(768.0::double / height, 768.0::double / width)) as int) else width end as new_width from pages",
        "resize_dims_short": "select page_id, case when least(height, width) > 640 then cast(round_even(height * (640.0::double / least(height, width)), 0) as int) else height end as new_height, case when least(height, width) > 640 then cast(round_even(width * (640.0::double / least(height, width)), 0) as int) else width end as new_width from pages",
        "upscale_bbox": f"with {_DET} select page_id, det_id, cast(trunc(least(x0 * (2400.0::double / 768), 2400)) as int) as x0, cast(trunc(least(y0 * (3200.0::double / 768), 3200)) as int) as y0, cast(trunc(least(x1 * (2400.0::double / 768), 2400)) as int) as x1, cast(trunc(least(y1 * (3200.0::double / 768), 3200)) as int) as y1 from lin",
        "path_parts": "select page_id, split_part(path, '/', -1) as file_name, regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]+$', '\\1') as stem, regexp_replace(path, '/?[^/]*$', '') as folder, upper(regexp_extract(path, '\\.([^./]+)$', 1)) as extension from pages",
        "interval_iou": box(_interval("x")), "iou_x": box(_interval("x")), "iou_y": box(_interval("y")), "box_iou": box(_iou("a", "b")), "box_ios": box(_ios("a", "b")),
        "box_intersects": f"with {_DET} select a.page_id, a.det_id as i, b.det_id as j from {_PAIRS}",
        "box_distance": f"with {_DET} select a.page_id, a.det_id as line_id, b.region_id, round({_DIST}, 9) as value from lin a join reg b on a.page_id = b.page_id",
        "tile_grid": _tiles(100), "tile_grid_no_overlap": _tiles(0),
        "move_detections": f"with {_DET}, {_MOVED} select * from mv",
        "tile_union": f"with {_DET}, {_MOVED} select *, cast(row_number() over (partition by page_id order by tile_id, det_id) - 1 as int) as merged_id from mv",
        "mask_runs_area": f"with {_DET} select page_id, det_id, ((x1 - x0) * (y1 - y0))::bigint as pixels from lin",
        "nms_class_aware": _nms("page_id, class_id", _iou, 0.2), "nms_agnostic": _nms("page_id", _iou, 0.2), "nms_ios": _nms("page_id, class_id", _ios, 0.5),
        "overlap_edges": f"with {_DET}, {_EDGE} select * from edges",
        "components": f"{merged} select * from comp",
        "component_mapping": f"{merged}, {_MAPPED} select page_id, det_id, cast(out_id as int) as out_id from mapped",
        "component_conf_mean": f"{merged}, {_MAPPED} select m.page_id, cast(out_id as int) as out_id, round(avg(confidence), 6) as confidence from mapped m join lin l on m.page_id = l.page_id and m.det_id = l.det_id group by 1, 2",
        "component_conf_compat": f"{merged}, {_MAPPED}, pos as (select page_id, det_id, confidence, cast(row_number() over (partition by page_id order by det_id) - 1 as int) as pos from lin) select p.page_id, p.pos as det_id, round(q.confidence, 6) as confidence from mapped m join pos p on m.page_id = p.page_id and m.det_id = p.det_id join pos q on q.page_id = m.page_id and q.pos = m.out_id",
        "dissolve_hull": f"{merged} select c.page_id, root, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, count(*) as members from comp c join lin l on c.page_id = l.page_id and c.det_id = l.det_id group by 1, 2",
        "default_region": "select page_id, '0' as region_id, 'paragraph' as name, 0.0::double as conf, 0 as x0, 0 as y0, width as x1, height as y1 from pages anti join regions using (page_id)",
        "default_region_compat": "select page_id, '0' as region_id, 'paragraph' as name, 0.0::double as conf, 0 as x0, 0 as y0, height as x1, width as y1 from pages anti join regions using (page_id)",
        "best_region": f"with {_DET}, {_ASSIGN} select page_id, line_id, region_id, round(iou, 9) as iou from best",
        "nearest_region": f"with {_DET}, {_ASSIGN} select page_id, line_id, region_id, round(dist, 9) as dist from near",
        "assign_regions": f"with {_DET}, {_ASSIGN} select * from asg",
        "region_line_join": f"with {_DET}, {_ASSIGN} select r.page_id, r.region_id, r.det_id as region_pos, a.line_id from reg r join asg a on r.page_id = a.page_id and r.region_id = a.region_id",
        "region_semi": f"with {_DET}, {_ASSIGN} select page_id, region_id, det_id as region_pos from reg r where exists (select 1 from asg a where r.page_id = a.page_id and r.region_id = a.region_id)",
        "order_graph_cyclic": f"with recursive {_DET}, stairs as (select page_id, det_id, (20 - det_id) * 10 as x0, 4 * det_id as y0, (20 - det_id) * 10 + 50 as x1, 4 * det_id + 10 as y1 from det), {_peeled('og', 'stairs', 'page_id')} select page_id, id, ord from og",
        "order_regions": _order_regions(), "language_id": _language_id(),
        "xml_roundtrip_named": f"with {_CUR}, {_NAMED}, {_LINED} select page_id, concat('r', region_ord, 'l', line_ord) as line_id, concat('r', region_ord) as region_id, coalesce({_STRIP}, '') as text from ln",
        "order_graph_lr": f"with {_DET}, o as ({_ranked('lin', 'page_id', 'det_id')}) select page_id, det_id as id, ord from o",
        "order_graph_rl": f"with {_DET}, o as ({_ranked('lin', 'page_id', 'det_id', True)}) select page_id, det_id as id, ord from o",
        "order_center": f"with {_DET} select u.page_id, u.det_id as id, cast(sum(case when u.det_id <> v.det_id and (case when {_row('v', 'u')} then v.x0 + v.x1 < u.x0 + u.x1 else v.y0 + v.y1 < u.y0 + u.y1 end) then 1 else 0 end) as int) as before from lin u join lin v on u.page_id = v.page_id group by 1, 2",
        "partial_order_intended": _partial(False), "partial_order_compat": _partial(True),
        "rec_batches": f"with {_CUR}, num as (select page_id, line_pos, (row_number() over (partition by page_id order by line_pos) - 1) // 8 as batch from cur) select page_id, cast(batch as int) as batch, count(*) as n, min(line_pos) as first_pos from num group by 1, 2",
        "score_exp": f"with {_CUR} select page_id, line_pos, round(power(2.718281828459045::double, 10 * text_conf - 10), 9) as score from cur",
        "row_length": f"with {_CUR} select page_id, line_pos, cast(length(text) as int) as row_length from cur",
        "page_stats": f"with {_CUR}, s as (select {_STATS} from cur group by 1) select page_id, round(m, 9) as page_conf_mean, round(md, 9) as page_conf_median, round(q1, 9) as page_conf_25, round(q3, 9) as page_conf_75, n_long_rowtext, n_lines from s",
        "long_rows": f"with {_CUR} select page_id, count(*) as n_long_rowtext from cur where length(text) > 100 group by 1",
        "page_text": f"with {_CUR} select page_id, coalesce(string_agg(text, ' ' order by line_pos), '') as text from cur group by 1",
        "strip_text": f"with {_CUR} select page_id, line_pos, {_STRIP} as text from cur",
        "nonempty_pages": f"with {_CUR} select page_id from pages p where exists (select 1 from cur c where c.page_id = p.page_id and c.text is not null)",
        "flatten_lines": f"{flat} select * from flat",
        "renest_counts": f"{flat} select page_id, region_ord, line_pos from flat",
        "region_result": f"{flat}, m as (select page_id, round(avg(text_conf), 6) as page_conf_mean from lin group by 1) select f.page_id, region_ord, count(*) as n_lines, string_agg(cast(line_id as varchar), ' ' order by line_ord) as line_ids, any_value(page_conf_mean) as page_conf_mean from flat f join m on f.page_id = m.page_id group by 1, 2",
        "zip_lists": f"with {_DET}, r as (select page_id, det_id, confidence, row_number() over (partition by page_id order by det_id) as rn from lin) select page_id, cast(rn - 1 as int) as at, det_id, round(confidence, 6) as confidence from r qualify rn < count(*) over (partition by page_id)",
        "region_ids": f"with {_NAMED} select page_id, region_id, name, region_ord, xml_id from ids",
        "xml_ids": f"with {_CUR}, {_NAMED}, {_LINED} select page_id, line_pos, concat('r', region_ord, 'l', line_ord) as page_line_id, concat(xml_id, '_line_', line_ord) as alto_line_id, concat('readingOrder {{index:', line_ord, ';}}') as custom from ln".replace("{{", "{").replace("}}", "}"),
        "page_xml": _PAGE_XML, "alto_xml": _ALTO_XML,
        "xml_targets": "with t as (select page_id, f as xml_format, concat('/out/', f, '/', regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]+$', '\\1'), '.xml') as target from pages, (values ('page'), ('alto')) v(f) where path is not null) select *, count(*) over (partition by target) > 1 as collides from t",
        "xml_timestamp": "select page_id, strftime(scanned_at, '%Y-%m-%dT%H:%M:%S.%f+02:00') as stamp from pages",
        "round_robin": "select page_id, path, cast((row_number() over (order by path, page_id) - 1) % 4 as int) as rank from pages",
        "format_2dp": "select page_id, computed_at, page_conf_mean, printf('%.2f', page_conf_mean) as page_conf_mean_text from page_stats",
    }
