"""DuckDB SQL oracles, one per registered query (same column names).

Written independently of the Spark code: plain SQL over the base tables with
the fixture views inlined as CTEs. Surrogate keys are ``row_number()`` over
the natural key (NULLs first), the definition the Spark operators meet.
"""

from __future__ import annotations

from starloom.plans.oracle_views import GENDER, SEASON, TIME_OF_DAY, html_text_sql, with_views

WEEKDAYS_SQL = "('Monday','Tuesday','Wednesday','Thursday','Friday')"


def _calendar(ts: str) -> str:
    return (f"cast(year({ts}) as int) as year, cast(month({ts}) as int) as month, "
            f"{SEASON.format(ts=ts)} season, cast(day({ts}) as int) as day, dayname({ts}) day_of_week, "
            f"{TIME_OF_DAY.format(ts=ts)} time_of_day")


SALES_AGG = f"""
select {_calendar('s.ts')}, p.name product_name, r.name room_name, m.gender gender, m.active is_active,
       cast(round(cast(sum(s.price) as double) / 100, 2) as decimal(10,2)) kroner_sales,
       count(*) unit_sales
from v_sale s join v_product p on p.id = s.product_id join v_room r on r.id = s.room_id
     join v_member m on m.id = s.member_id
group by all"""

STAGED = f"""
select year, month, season, day, day_of_week, time_of_day, {html_text_sql('product_name')} product_name,
       room_name, {GENDER.format(g='gender')} gender, is_active, kroner_sales, unit_sales
from sales_agg"""

REGROUPED = """
select year, month, season, day, day_of_week, time_of_day, product_name, room_name, gender, is_active,
       cast(sum(kroner_sales) as decimal(10,2)) kroner_sales, cast(sum(unit_sales) as bigint) unit_sales
from staged group by all"""

SALES_CTES = {"sales_agg": SALES_AGG, "staged": STAGED, "regrouped": REGROUPED}
SALES_VIEWS = ("v_sale", "v_product", "v_room", "v_member")


def _ranked(sfx: str) -> str:
    return f"""
select p.id, p.name pname, c.name cname, p.active, p.alcohol_content_ml,
       row_number() over (partition by p.id, p.name order by c.name nulls first) rn
from v_product p join v_product_categories{sfx} pc on p.id = pc.product_id
     join v_category{sfx} c on c.id = pc.category_id"""


PIVOTED = """
select id, pname, active, alcohol_content_ml, max(cname) filter (where rn = 1) cat_01,
       max(cname) filter (where rn = 2) cat_02, max(cname) filter (where rn = 3) cat_03
from ranked group by all"""


def _routed(sfx: str) -> str:
    def level(name: str) -> str:
        return f"arg_max(r.cname, r.rn) filter (where l.level = '{name}') {name}"
    return f"""
select r.id, r.pname, r.active, r.alcohol_content_ml, {level('product_type')}, {level('category')},
       {level('subcategory')}
from ranked r left join v_level{sfx} l on l.name = r.cname
group by r.id, r.pname, r.active, r.alcohol_content_ml"""


PROW = f"""
select id, {html_text_sql('pname')} product_name,
       coalesce(product_type, 'No product_type') product_type, coalesce(category, 'No category') category,
       coalesce(subcategory, 'No subcategory') subcategory,
       case when active then 'active' else 'inactive' end status, alcohol_content_ml
from routed"""

PRODUCT_SEED = ("select 1::bigint productid, 'undefined' product_name, null::varchar product_type, "
                "null::varchar category, null::varchar subcategory, 'inactive' status, "
                "0.0::double alcohol_content_ml")


def _scd1_new(rows: str, start: str) -> str:
    """New members of a type-1 load: plain attributes from the smallest id,
    status from the largest, keys after ``start`` in name order."""
    return f"""
select {start} + row_number() over (order by product_name nulls first) productid, product_name,
       arg_min(product_type, id) product_type, arg_min(category, id) category,
       arg_min(subcategory, id) subcategory, arg_max(status, id) status,
       arg_min(alcohol_content_ml, id) alcohol_content_ml
from {rows} group by product_name"""


PRODUCT_DIM = f"""
{PRODUCT_SEED}
union all
select * from ({_scd1_new("(select * from prow where product_name <> 'undefined')", '1')})"""

MEMBER_DIM = f"""
select row_number() over (order by gender nulls first, is_active nulls first) memberid, gender, is_active
from (select distinct {GENDER.format(g='gender')} gender, active is_active from v_member)"""

ROOM_DIM = """
select 1::bigint roomid, 'Unknown room' room_name
union all
select 1 + row_number() over (order by id nulls first), name from v_room"""

TIME_DIM = f"""
select row_number() over (order by year nulls first, month nulls first, day nulls first,
                                   time_of_day nulls first) timeid,
       year, month, day, time_of_day, season, day_of_week,
       case when day_of_week in {WEEKDAYS_SQL} then 'Yes' else 'No' end is_weekday,
       'Not a holiday' holiday, 'No event' event
from (select year, month, day, time_of_day, max(season) season, max(day_of_week) day_of_week
      from staged group by year, month, day, time_of_day)"""

PRODUCT_KEYS = "select product_name, min(productid) productid from product_dim group by product_name"
ROOM_KEYS = "select room_name, min(roomid) roomid from room_dim group by room_name"

FACT = """
select t.timeid, coalesce(p.productid, 1) productid, m.memberid, coalesce(r.roomid, 1) roomid,
       cast(sum(g.kroner_sales) as decimal(10,2)) kroner_sales, cast(sum(g.unit_sales) as int) unit_sales
from regrouped g
     join time_dim t on t.year = g.year and t.month = g.month and t.day = g.day
                     and t.time_of_day = g.time_of_day
     left join product_keys p on p.product_name = g.product_name
     join member_dim m on m.gender = g.gender and m.is_active = g.is_active
     left join room_keys r on r.room_name = g.room_name
group by t.timeid, coalesce(p.productid, 1), m.memberid, coalesce(r.roomid, 1)"""


def _product_ctes(gap: bool = False) -> dict[str, str]:
    sfx = "_gap" if gap else ""
    return {"ranked": _ranked(sfx), "pivoted": PIVOTED, "routed": _routed(sfx), "prow": PROW,
            "product_dim": PRODUCT_DIM}


def _product_views(gap: bool = False) -> tuple[str, ...]:
    sfx = "_gap" if gap else ""
    return ("v_product", f"v_product_categories{sfx}", f"v_category{sfx}", f"v_level{sfx}")


def _warehouse(gap: bool = False) -> str:
    ctes = dict(SALES_CTES)
    ctes.update(_product_ctes(gap))
    ctes.update({"member_dim": MEMBER_DIM, "room_dim": ROOM_DIM, "time_dim": TIME_DIM,
                 "product_keys": PRODUCT_KEYS, "room_keys": ROOM_KEYS, "fact": FACT})
    return with_views(*SALES_VIEWS, *_product_views(gap), extra=ctes)


def _sales(*extra_names: str, **extra: str) -> str:
    ctes = dict(SALES_CTES)
    ctes.update(extra)
    return with_views(*SALES_VIEWS, *extra_names, extra=ctes)


def _products(extra: dict[str, str] | None = None, gap: bool = False, upto: str = "product_dim",
              views: tuple[str, ...] = ()) -> str:
    ctes = {}
    for k, v in _product_ctes(gap).items():
        ctes[k] = v
        if k == upto:
            break
    ctes.update(extra or {})
    return with_views(*_product_views(gap), *views, extra=ctes)


GRAIN_COLS = "g.year, g.month, g.day, g.time_of_day, g.product_name, g.room_name, g.gender, g.is_active"

ORACLES: dict[str, str] = {
    # sources
    "scan_source": "select s_name room_name from supplier",
    "scan_renamed": with_views("v_member") + "select gender, active is_active from v_member group by gender, active",
    "member_distinct": with_views("v_member") + "select distinct gender, active from v_member",
    "project_alias": with_views("v_product") + "select id, name pname, active, alcohol_content_ml from v_product",
    # scalar functions
    "date_parts": ("select event_id, cast(year(ts) as int) as year, cast(month(ts) as int) as month, "
                   "cast(day(ts) as int) as day, cast(hour(ts) as int) as hour from events"),
    "day_name": "select event_id, dayname(ts) day_of_week from events",
    "time_of_day_bucket": (f"select event_id, cast(hour(ts) as int) as hour, {TIME_OF_DAY.format(ts='ts')} time_of_day "
                           "from events"),
    "season_bucket": (f"select o_orderkey, cast(month(o_orderdate) as int) as month, "
                      f"{SEASON.format(ts='o_orderdate')} season from orders"),
    "weekday_flag": (f"select event_id, dayname(ts) day_of_week, case when dayname(ts) in {WEEKDAYS_SQL} "
                     "then 'Yes' else 'No' end is_weekday from events"),
    "bool_label": with_views("v_product") + (
        "select id, active, case when active then 'active' else 'inactive' end status from v_product"),
    "recode_dict": with_views("v_member") + f"select id, {GENDER.format(g='gender')} gender from v_member",
    "recode_default": ("select c_custkey, coalesce(case c_mktsegment when 'BUILDING' then 'Building' "
                       "when 'MACHINERY' then 'Machinery' when 'FURNITURE' then 'Furniture' "
                       "when 'HOUSEHOLD' then 'Household' end, 'Other') segment from customer"),
    "html_text": f"select page_id, {html_text_sql('html')} text from pages",
    "canonical_names": with_views("v_product") + (
        f"select id, name, {html_text_sql('name')} clean_name from v_product"),
    # bridge, window, pivot, routing
    "bridge_join": with_views("v_product", "v_product_categories", "v_category") + """
select p.id, p.name pname, c.name cname, p.active, p.alcohol_content_ml
from v_product p join v_product_categories pc on p.id = pc.product_id join v_category c on c.id = pc.category_id""",
    "rank_in_group": _products(upto="ranked") + "select id, pname, cname, cast(rn as int) rn from ranked",
    "topk_per_group": _products(upto="ranked") + "select id, cname, cast(rn as int) rn from ranked where rn <= 3",
    "category_pivot": _products(upto="pivoted") + "select * from pivoted",
    "category_route": _products(upto="routed") + "select id, product_type, category, subcategory from routed",
    "fill_defaults": _products(upto="routed") + """
select id, coalesce(product_type, 'No product_type') product_type, coalesce(category, 'No category') category,
       coalesce(subcategory, 'No subcategory') subcategory from routed""",
    # joins and aggregates
    "star_join": with_views(*SALES_VIEWS) + """
select s.product_id, s.room_id, s.member_id, s.price, cast(hour(s.ts) as int) sale_hour, p.name p_name,
       r.name r_name, m.gender, m.active
from v_sale s join v_product p on p.id = s.product_id join v_room r on r.id = s.room_id
     join v_member m on m.id = s.member_id""",
    "sales_aggregated": with_views(*SALES_VIEWS, extra={"sales_agg": SALES_AGG}) + "select * from sales_agg",
    "money_sum": with_views("v_sale") + (
        "select room_id, cast(round(cast(sum(price) as double) / 100, 2) as decimal(10,2)) kroner_sales "
        "from v_sale group by room_id"),
    "staged_sales": _sales() + "select * from staged",
    "reaggregate_staging": _sales() + "select * from regrouped",
    # keys and dimensions
    "surrogate_keys": """
select row_number() over (order by l_orderkey nulls first, l_linenumber nulls first) id, l_orderkey, l_linenumber
from (select distinct l_orderkey, l_linenumber from lineitem)""",
    "surrogate_keys_tied": """
select row_number() over (order by l_suppkey nulls first, l_orderkey nulls first, l_linenumber nulls first,
                                   l_partkey nulls first) id, l_suppkey, l_orderkey, l_linenumber, l_partkey
from lineitem""",
    "dim_member": with_views("v_member", extra={"member_dim": MEMBER_DIM}) + "select * from member_dim",
    "dim_room": with_views("v_room", extra={"room_dim": ROOM_DIM}) + "select * from room_dim",
    "dim_insert": with_views("v_room", extra={"room_dim": ROOM_DIM}) + """
select * from room_dim
union all
select (select max(roomid) from room_dim) + row_number() over (order by id nulls first), name from v_room""",
    "dim_append_members": with_views("v_category") + """
select id, name from v_category
union all
select (select max(id) from v_category) + row_number() over (order by name nulls first), name
from (values ('Drikke'), ('Miscellaneous')) t(name)""",
    "default_members": _products(extra={"room_dim": ROOM_DIM}, views=("v_room",)) + """
select 'product' dimension, productid key, product_name name from product_dim where productid = 1
union all
select 'room', roomid, room_name from room_dim where roomid = 1""",
    "scd1_product": _products() + "select * from product_dim",
    "scd1_update_existing": _products(upto="prow", extra={
        "mid": "select (min(id) + max(id)) // 2 m from v_product",
        "b1": "select * from prow where id <= (select m from mid) and product_name <> 'undefined'",
        "b2": "select * from prow where id > (select m from mid) and product_name <> 'undefined'",
        "dim1": f"{PRODUCT_SEED} union all select * from ({_scd1_new('b1', '1')})",
        "b2_last": "select product_name, arg_max(status, id) status from b2 group by product_name",
        "b2_new": "select * from b2 where product_name not in (select product_name from dim1)",
    }) + f"""
select d.productid, d.product_name, d.product_type, d.category, d.subcategory,
       case when l.product_name is not null then l.status else d.status end status, d.alcohol_content_ml
from dim1 d left join b2_last l on l.product_name = d.product_name
union all
select * from ({_scd1_new('b2_new', '(select max(productid) from dim1)')})""",
    "dim_ensure": with_views(*_product_views(True), *_product_views(False), extra={
        **{f"{k}_gap": v.replace("from ranked", "from ranked_gap")
           .replace("from routed", "from routed_gap").replace("from prow", "from prow_gap")
           for k, v in _product_ctes(True).items()},
        **_product_ctes(False),
    }) + """
select * from product_dim_gap
union all
select (select max(productid) from product_dim_gap) + row_number() over (order by product_name nulls first),
       product_name, arg_min(product_type, id), arg_min(category, id), arg_min(subcategory, id),
       arg_min(status, id), arg_min(alcohol_content_ml, id)
from prow where product_name not in (select product_name from product_dim_gap)
group by product_name""",
    "dim_time": _sales(time_dim=TIME_DIM) + "select * from time_dim",
    "dim_lookup_single": _warehouse() + f"""
select {GRAIN_COLS}, p.productid, r.roomid
from regrouped g join product_keys p on p.product_name = g.product_name
     join room_keys r on r.room_name = g.room_name""",
    "dim_lookup_composite": _warehouse() + f"""
select {GRAIN_COLS}, t.timeid, m.memberid
from regrouped g join time_dim t on t.year = g.year and t.month = g.month and t.day = g.day
                              and t.time_of_day = g.time_of_day
     join member_dim m on m.gender = g.gender and m.is_active = g.is_active""",
    "dim_lookup_default": _warehouse(gap=True) + f"""
select {GRAIN_COLS}, coalesce(p.productid, 1) productid
from regrouped g left join product_keys p on p.product_name = g.product_name""",
    # facts
    "fact_sales": _warehouse() + "select * from fact",
    "fact_sales_keys_first": _warehouse() + "select * from fact",
    "fact_sales_unknown_product": _warehouse(gap=True) + "select * from fact",
    "full_reload": _warehouse() + "select * from fact",
    "commit_points": _warehouse() + """
select 'product' "table", count(*) n from product_dim union all select 'member', count(*) from member_dim
union all select 'room', count(*) from room_dim union all select 'time', count(*) from time_dim
union all select 'salesfact', count(*) from fact""",
    "star_rollup": _warehouse() + """
select t.year, t.month, t.day, t.time_of_day, p.product_name, m.gender, m.is_active, r.room_name,
       f.kroner_sales, f.unit_sales
from fact f join time_dim t on t.timeid = f.timeid join product_dim p on p.productid = f.productid
     join member_dim m on m.memberid = f.memberid join room_dim r on r.roomid = f.roomid""",
    "bridge_replace": with_views("v_product_categories") + "select product_id, category_id from v_product_categories",
    # joins beyond the star
    "semi_join_bloom": with_views("v_sale", "v_bridge", "v_bridge_gap") + """
select product_id, count(*) sales, cast(sum(price) as bigint) price from v_sale
where product_id in (select product_id from v_bridge_gap) group by product_id""",
    "anti_join_bloom": with_views("v_sale", "v_bridge", "v_bridge_gap") + """
select product_id, member_id, price from v_sale
where product_id not in (select product_id from v_bridge_gap)""",
    "interval_join": """
select s.event_id signup_id, count(*) events, cast(sum(cast(round(e.value * 100) as bigint)) as bigint) hundredths
from events s join events e on e.ts >= s.ts and e.ts < s.ts + interval 2 hours
where s.event_type = 'signup' group by s.event_id""",
    "interval_join_keyed": """
select o.o_orderkey, l.l_orderkey, l.l_linenumber
from lineitem l join orders p on p.o_orderkey = l.l_orderkey join orders o on o.o_custkey = p.o_custkey
where cast(l.l_shipdate as date) between cast(o.o_orderdate as date)
      and cast(o.o_orderdate as date) + cast(o.o_orderkey % 181 as int)""",
    "asof_join": """
select l.l_orderkey, l.l_linenumber, o.o_orderkey latest_order, o.o_orderdate
from (select row_number() over () r, * from lineitem) l join orders p on p.o_orderkey = l.l_orderkey
     left join orders o on o.o_custkey = p.o_custkey and o.o_orderdate <= l.l_shipdate
qualify row_number() over (partition by l.r
                           order by o.o_orderdate desc nulls last, o.o_orderkey desc nulls last) = 1""",
    "asof_join_strict": """
select e.event_id, p.event_id purchase_id, p.ts purchased
from events e left join events p on p.user_id = e.user_id and p.event_type = 'purchase' and p.ts < e.ts
qualify row_number() over (partition by e.event_id order by p.ts desc nulls last, p.event_id desc nulls last) = 1""",
    # rollups and frames
    "grouping_lattice": with_views("v_sale") + """
select cast(year(ts) as int) "year", cast(month(ts) as int) "month", cast(day(ts) as int) "day", room_id, product_id,
       grouping_id(year(ts), month(ts), day(ts), room_id, product_id) grouping_id, count(*) unit_sales,
       cast(sum(price) as bigint) total, min(price) lowest, max(price) highest, sum(price)::double / count(price) mean
from v_sale group by grouping sets ((year(ts), month(ts), day(ts), room_id, product_id), (year(ts), month(ts), room_id),
  (year(ts), month(ts), product_id), (year(ts), month(ts), day(ts)), (year(ts), room_id), (year(ts), product_id),
  (year(ts), month(ts)), (room_id), (product_id), (year(ts)), ())""",
    "distinct_rollup": with_views("v_sale") + """
select cast(year(ts) as int) "year", cast(month(ts) as int) "month", count(distinct member_id) members, true within_error
from v_sale group by 1, 2""",
    "quantile_rollup": with_views("v_sale") + "select room_id, count(*) sales, true within_error from v_sale group by room_id",
    "moving_frame": with_views("v_sale") + """
select room_id, cast(ts as date) "day", price, cast(sum(price) over f as bigint) week_price, count(*) over f week_sales
from v_sale window f as (partition by room_id order by cast(ts as date)
                         range between interval 6 days preceding and current row)""",
    # versions and layout
    "run_difference": """
with a as (select o_orderkey, o_custkey, o_orderstatus, cast(o_orderdate as date) o_date from orders),
b as (select o_orderkey, o_custkey, case when o_orderkey % 89 = 0 then 'X' else o_orderstatus end o_orderstatus, o_date
      from a where o_orderkey % 97 <> 0
      union all select * from a where o_orderkey % 83 = 0 and o_orderkey % 97 <> 0 and o_orderkey % 89 <> 0)
select o_orderkey, o_custkey, o_orderstatus, o_date, cast(sum(n) as bigint) change
from (select *, 1 n from b union all select *, -1 from a) group by all having sum(n) <> 0""",
    "clustered_layout": with_views("v_sale") + """
select cast(ts as date) "day", product_id, room_id, price from v_sale
where cast(ts as date) between date '1998-01-01' and date '1998-03-31'
  and product_id between 0 and (select max(p_partkey) // 10 from part)""",
    # streaming
    "incremental_events": """
select user_id, cast(ts as date) "day", count(*) events, cast(sum(cast(round(value * 100) as bigint)) as bigint) hundredths
from events group by 1, 2""",
    "bridge_script": with_views("v_product_categories") + "select product_id, category_id from v_product_categories",
    # integrity checks
    "check_pk": ("select l_orderkey, l_linenumber, count(*) n from lineitem group by l_orderkey, l_linenumber "
                 "having count(*) > 1"),
    "check_fk": ("select d.doc_id from documents d where d.doc_id is not null and not exists "
                 "(select 1 from labels l where l.doc_id = d.doc_id)"),
    "check_not_null": ("select d.doc_id, 'quality' \"column\" from documents d left join labels l "
                       "on l.doc_id = d.doc_id where l.quality is null"),
    "check_length": ("select doc_id, 'text' \"column\", cast(length(text) as int) length from documents "
                     "where length(text) > 100"),
    "check_decimal_range": ("select l_orderkey, l_linenumber, l_extendedprice * 1000 value from lineitem "
                            "where l_extendedprice * 1000 is not null "
                            "and try_cast(l_extendedprice * 1000 as decimal(10,2)) is null"),
}
