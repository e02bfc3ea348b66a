"""DuckDB text of the fixture views, used by the SQL oracles.

DuckDB only pre-registers the base tables, so each oracle inlines the views
it needs as CTEs (see FIXTURES.md).
"""

from __future__ import annotations

VIEWS = {
    "v_sale": """
select l_partkey product_id, l_suppkey room_id, o_custkey member_id,
       cast(round(l_extendedprice*100) as bigint) price,
       o_orderdate + to_hours(cast((l_orderkey + l_linenumber*5) % 24 as int)) ts
from lineitem join orders on o_orderkey = l_orderkey""",
    "v_product": """
select p_partkey id,
       case when p_partkey % 2 = 0 then '<b>' || p_name || '</b> &amp; co' else p_name || ' & co' end name,
       p_size > 25 active, p_retailprice alcohol_content_ml
from part""",
    "v_member": """
select c_custkey id,
       case when c_mktsegment in ('BUILDING','MACHINERY') then 'M'
            when c_mktsegment in ('FURNITURE','HOUSEHOLD') then 'F' else 'U' end gender,
       c_acctbal >= 0 active
from customer""",
    "v_room": "select s_suppkey id, s_name name from supplier",
    "v_bridge": """
select p_partkey product_id, p_type cname from part where p_size % 10 <> 0
union all
select p_partkey, p_brand from part where p_size % 10 <> 0 and p_size % 3 <> 0
union all
select p_partkey, case when p_size < 17 then 'S' when p_size < 34 then 'M' else 'L' end
from part where p_size % 10 <> 0 and p_size % 2 = 0
union all
select p_partkey, 'XL' from part where p_size % 10 <> 0 and p_size % 4 = 0
union all
select p_partkey, 'Seasonal' from part where p_size % 10 <> 0 and p_size % 7 = 0""",
    "v_bridge_gap": """
select b.* from v_bridge b join part on p_partkey = b.product_id
where not starts_with(p_name, 'blue') and not starts_with(p_name, 'cold')""",
    "v_category": "select row_number() over (order by name nulls first) id, name from (select distinct cname name from v_bridge)",
    "v_category_gap": "select row_number() over (order by name nulls first) id, name from (select distinct cname name from v_bridge_gap)",
    "v_product_categories": "select product_id, c.id category_id from v_bridge b join v_category c on c.name = b.cname",
    "v_product_categories_gap": "select product_id, c.id category_id from v_bridge_gap b join v_category_gap c on c.name = b.cname",
    "v_level": """
select name, case when starts_with(name, 'Brand#') then 'category'
                  when name in ('S','M','L','XL') then 'subcategory' else 'product_type' end level
from v_category where name <> 'Seasonal'""",
    "v_level_gap": """
select name, case when starts_with(name, 'Brand#') then 'category'
                  when name in ('S','M','L','XL') then 'subcategory' else 'product_type' end level
from v_category_gap where name <> 'Seasonal'""",
}

# Views each view depends on.
DEPENDS = {
    "v_bridge_gap": ["v_bridge"],
    "v_category": ["v_bridge"],
    "v_category_gap": ["v_bridge_gap"],
    "v_product_categories": ["v_category"],
    "v_product_categories_gap": ["v_category_gap"],
    "v_level": ["v_category"],
    "v_level_gap": ["v_category_gap"],
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding the named views (and their dependencies),
    followed by extra CTEs in the given order."""
    parts = [f"{n} as ({VIEWS[n].strip()})" for n in _closure(names)]
    parts += [f"{n} as ({q.strip()})" for n, q in (extra or {}).items()]
    return "with " + ",\n".join(parts) + "\n"


# SQL expressions shared by several oracles. Hour and month lists,
# labels and gender codes.
TIME_OF_DAY = """case when hour({ts}) in (6,7,8,9,10) then 'Morning'
     when hour({ts}) in (11,12,13) then 'Noon'
     when hour({ts}) in (13,14,15,16) then 'Afternoon' else 'Night' end"""
SEASON = """case when month({ts}) in (12,1,2) then 'Winter'
     when month({ts}) in (3,4,5) then 'Spring'
     when month({ts}) in (6,7,8) then 'Summer' else 'Fall' end"""
GENDER = """case {g} when 'M' then 'Male' when 'F' then 'Female' when 'U' then 'Undefined' end"""


def _without(x: str, opening: str, closing: str) -> str:
    """``x`` without its spans from ``opening`` through the next ``closing``:
    split at the openings, each later piece goes on after its closing."""
    rest = f"substr(p, instr(p, '{closing}') + {len(closing)})"
    return (f"array_to_string(list_transform(string_split({x}, '{opening}'), "
            f"lambda p, i: case when i = 1 then p else {rest} end), '')")


# The references that occur in the fixtures; '&amp' is decoded last.
REFERENCES = [("&copy;", "'©'"), ("&middot;", "'·'"), ("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"),
              ("&quot;", "chr(34)"), ("&apos;", "chr(39)"), ("&#39;", "chr(39)")]


def html_text_sql(x: str) -> str:
    """Oracle text of a column by splitting, without a pattern: it covers what
    the fixtures hold (closed lower-case elements, no '>' inside a tag)."""
    for opening, closing in (("<!--", "-->"), ("<script", "</script>"), ("<style", "</style>"), ("<", ">")):
        x = _without(x, opening, closing)
    for reference, char in REFERENCES:
        x = f"replace({x}, '{reference}', {char})"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"
