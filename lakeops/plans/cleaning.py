"""Projection, cleaning, nested data, expressions and text jobs over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import exprs as E
from lakeops.functions import text as X
from lakeops.operators import clean as C
from lakeops.operators import nested as N
from lakeops.operators import sets as S
from lakeops.plans.relational import money
from lakeops.registry import Tables, query

AS_OF = "2001-08-01 00:00:00"
CUST = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query("select_rename_cast", "select cast(o_orderkey as varchar) as ORDER_CODE, cast(o_totalprice as decimal(18,4)) as AMOUNT, cast(o_orderdate as date) as ORDER_DAY, cast(o_custkey as int) as SK_CUSTOMER from orders")
def _(t: Tables):
    return C.select_rename_cast(t.orders, [("o_orderkey", "string", "ORDER_CODE"), ("o_totalprice", "decimal(18,4)", "AMOUNT"),
                                           ("o_orderdate", "date", "ORDER_DAY"), ("o_custkey", "int", "SK_CUSTOMER")])


@query("conform_columns", "select c_name as Name, cast(null as varchar) as Phone, cast(c_custkey as varchar) as Id, cast(null as varchar) as Fax from customer")
def _(t: Tables):
    return C.conform_columns(t.customer, [("c_name", "Name"), ("c_phone", "Phone"), ("c_custkey", "Id"), ("", "Fax")])


@query("select_column_order", "select c_mktsegment, c_custkey from customer")
def _(t: Tables):
    return C.select_column_order(t.customer, ["c_mktsegment", "c_custkey"])


@query("rename_mapping", "select c_custkey as customer_id, c_name as customer_name, c_nationkey, c_mktsegment from customer")
def _(t: Tables):
    return C.rename_mapping(t.customer.select(*CUST), {"c_custkey": "customer_id", "c_name": "customer_name"})


@query("normalise_column_names", "select c_custkey as customer_key, c_name as full_name, c_nationkey as full_name_2, c_mktsegment as market_segment_uk from customer")
def _(t: Tables):
    return C.normalise_column_names(t.customer.select(*CUST).toDF("Customer Key", " Full-Name", "full name", "Market segment (UK)"))


@query("strip_name_prefix", "select c_custkey as custkey, c_name as name, c_nationkey as nationkey, c_mktsegment as mktsegment from customer")
def _(t: Tables):
    return C.strip_name_prefix(t.customer.select(*CUST), "c_")


@query("prefix_columns", "select c_custkey, c_name as Contact_c_name, c_nationkey as Contact_c_nationkey, c_mktsegment from customer")
def _(t: Tables):
    return C.prefix_columns(t.customer.select(*CUST), "Contact_", only=["c_name", "c_nationkey"])


@query("cast_all_string", "select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment from customer")
def _(t: Tables):
    return C.cast_all_string(t.customer.select(*CUST))


@query("constant_columns", "select o_orderkey, 'UK' as country, cast(7 as int) as source_id from orders")
def _(t: Tables):
    return C.constant_columns(t.orders.select("o_orderkey"), {"country": "UK", "source_id": 7})


@query("record_timestamp", "select o_orderkey, cast(20010801000000 as bigint) as record_timestamp from orders")
def _(t: Tables):
    return C.record_timestamp(t.orders.select("o_orderkey"), run=20010801000000)


@query("audit_columns", f"select o_orderkey, timestamp '{AS_OF}' as create_datetime, cast(null as timestamp) as update_datetime from orders")
def _(t: Tables):
    return C.audit_columns(t.orders.select("o_orderkey"), as_of=AS_OF)


_GAPS = "select c_custkey, o_orderstatus, o_orderkey, cast(o_totalprice as decimal(18,4)) as amount, cast(o_orderdate as date) as day from customer left join orders on c_custkey = case when o_orderpriority = '1-URGENT' then -o_custkey - 1 else o_custkey end"


def _gaps(t: Tables):
    # Renamed keys leave customers without orders.
    o = t.orders.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("c_custkey"), "o_orderstatus", "o_orderkey", F.col("o_totalprice").cast("decimal(18,4)").alias("amount"), F.col("o_orderdate").cast("date").alias("day"))
    return t.customer.select("c_custkey").join(o, "c_custkey", "left")


@query("default_sentinels", f"select c_custkey, coalesce(o_orderstatus, 'UNKNOWN') as o_orderstatus, coalesce(o_orderkey, -1) as o_orderkey, coalesce(amount, cast(0 as decimal(18,4))) as amount, coalesce(day, date '9999-12-31') as day from ({_GAPS})")
def _(t: Tables):
    return C.default_sentinels(_gaps(t), {"o_orderstatus": C.UNKNOWN_TEXT, "o_orderkey": C.UNKNOWN_CODE, "amount": C.UNKNOWN_AMOUNT, "day": "9999-12-31"})


@query("derived_case_columns", """
select p_partkey, case when p_size < 10 then 'small' when p_size < 30 then 'medium' else 'large' end as size_band,
 case when p_size < 10 and p_retailprice > 1000 then 'small dear' when p_type = 'PROMO' then 'promo' end as tag from part""")
def _(t: Tables):
    out = C.derived_case_columns(t.part.select("p_partkey", "p_size", "p_type", "p_retailprice"), [
        ("size_band", [("p_size < 10", "small"), ("p_size < 30", "medium")], "large"),
        ("tag", [("size_band = 'small' and p_retailprice > 1000", "small dear"), ("p_type = 'PROMO'", "promo")], None)])
    return out.select("p_partkey", "size_band", "tag")


PART_RULES = [
    {"label": "ROUND", "any": ["ring", "gear"], "none": ["old"]},
    {"label": "FASTENER", "any": ["bolt"], "codes": ("p_partkey", [7, 11, 13])},
    {"label": "DEVICE", "any": ["widget", "gizmo"]},
]
PART_RULES_SQL = """case when (lower(p_name) like '%ring%' or lower(p_name) like '%gear%') and lower(p_name) not like '%old%' then 'ROUND'
 when lower(p_name) like '%bolt%' or p_partkey in (7, 11, 13) then 'FASTENER' when lower(p_name) like '%widget%' or lower(p_name) like '%gizmo%' then 'DEVICE' else 'OTHER' end"""


@query("keyword_classify", f"select p_partkey, p_name, {PART_RULES_SQL} as category from part")
def _(t: Tables):
    return C.keyword_classify(t.part.select("p_partkey", "p_name"), "p_name", PART_RULES, default="OTHER")


@query("drop_empty_rows", f"select * from ({_GAPS}) where o_orderstatus is not null or o_orderkey is not null")
def _(t: Tables):
    return C.drop_empty_rows(_gaps(t), subset=["o_orderstatus", "o_orderkey"])


@query("trim_whitespace", "select c_custkey, c_name, c_mktsegment from customer")
def _(t: Tables):
    padded = t.customer.select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"), F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"))
    return C.trim_whitespace(padded)


@query("filter_predicates", "select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity > 20 and l_returnflag <> 'N' and l_discount between 0.02 and 0.06 and l_linestatus = 'O'")
def _(t: Tables):
    out = C.filter_predicates(t.lineitem, ["l_quantity > 20", "l_returnflag <> 'N'", "l_discount between 0.02D and 0.06D"], extra="l_linestatus = 'O'")
    return out.select("l_orderkey", "l_partkey", "l_quantity")


@query("status_filter", "select o_orderkey, lower(o_orderstatus) as status from orders where upper(o_orderstatus) not in ('P', 'X')")
def _(t: Tables):
    return C.status_filter(t.orders.select("o_orderkey", F.lower("o_orderstatus").alias("status")), "status", exclude=["p", "x"])


@query("pair_not_in", """
with l as (select l_orderkey, l_linenumber, nullif(l_returnflag, 'A') as flag, l_linestatus from lineitem)
select * from l where not coalesce((flag = 'R' and l_linestatus = 'O') or (flag = 'N' and l_linestatus = 'F'), false)""")
def _(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("A")).alias("flag"), "l_linestatus")
    return C.pair_not_in(li, "flag", "l_linestatus", [("R", "O"), ("N", "F")])


@query("range_exclusions", "select p_partkey, p_size from part where p_size not between 5 and 9 and p_size not between 20 and 29 and p_size not between 45 and 45")
def _(t: Tables):
    return C.range_exclusions(t.part.select("p_partkey", "p_size"), "p_size", [(5, 9), (20, 29), (45, 45)])


@query("sql_step", "select c_mktsegment, count(*) as n from orders join customer on o_custkey = c_custkey group by 1")
def _(t: Tables):
    return C.sql_step(t.spark, "select c_mktsegment, count(*) as n from {o} join {c} on o_custkey = c_custkey group by c_mktsegment", {"o": t.orders, "c": t.customer})


def _add_vat(df, *, rate: str):
    return df.withColumn("gross", (money("o_totalprice") * F.lit(rate).cast("decimal(4,2)")).cast("decimal(18,4)"))


def _only(df, *, status: str):
    return df.where(F.col("o_orderstatus") == status)


@query("custom_rule_hook", "select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) * cast(1.20 as decimal(4,2)) as decimal(18,4)) as gross from orders where o_orderstatus = 'F'")
def _(t: Tables):
    return C.custom_rule_hook(t.orders, [(_only, {"status": "F"}), (_add_vat, {"rate": "1.20"})]).select("o_orderkey", "gross")


# ---- nested

def order_heads(t: Tables):
    """Orders with a customer and a meta struct."""
    return t.orders.select("o_orderkey", F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("customer"),
                           F.struct(F.col("o_orderpriority").alias("priority")).alias("meta"))


def nested_orders(t: Tables):
    """Orders with a customer struct and the array of their lines; orders without lines have none."""
    lines = N.array_from_rows(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", money("l_quantity").alias("qty")), keys=["l_orderkey"],
        fields={"l_linenumber": "line", "l_partkey": "part", "qty": "qty"}, name="lines")
    head = order_heads(t)
    return head.join(lines, head.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")


@query("flatten_structs", "select o_orderkey, o_custkey as id, o_orderstatus as status, o_orderpriority as priority from orders")
def _(t: Tables):
    head = t.orders.select("o_orderkey", F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("customer"),
                           F.struct(F.col("o_orderpriority").alias("priority")).alias("meta"))
    return N.flatten_structs(head, ["customer", "meta"])


@query("explode_rows", "select o_orderkey, l_linenumber as line, l_partkey as part, cast(l_quantity as decimal(18,2)) as qty from orders join lineitem on o_orderkey = l_orderkey")
def _(t: Tables):
    return N.explode_rows(nested_orders(t).select("o_orderkey", "lines"), "lines")


@query("explode_outer_rows", "select o_orderkey, l_linenumber as line, l_partkey as part, cast(l_quantity as decimal(18,2)) as qty from orders left join lineitem on o_orderkey = l_orderkey")
def _(t: Tables):
    return N.explode_outer_rows(nested_orders(t).select("o_orderkey", "lines"), "lines")


@query("struct_or_array", """
select 'single' as shape, o_orderkey, o_custkey as id, o_orderstatus as status from orders
union all select 'array', l_orderkey, l_partkey, l_returnflag from lineitem""")
def _(t: Tables):
    single = t.orders.select("o_orderkey", F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("item"))
    many = N.array_from_rows(t.lineitem, keys=["l_orderkey"], fields={"l_partkey": "id", "l_returnflag": "status"}, name="item").withColumnRenamed("l_orderkey", "o_orderkey")
    return S.union_all_rows(*[N.explode_rows(N.struct_or_array(d, "item"), "item").select(F.lit(n).alias("shape"), "*") for n, d in (("single", single), ("array", many))])


@query("flatten_optional_groups", """
select o_orderkey, o_custkey as cust_id, o_orderstatus as cust_status, l_linenumber as line_line, l_partkey as line_part, cast(l_quantity as decimal(18,2)) as line_qty
from orders left join lineitem on o_orderkey = l_orderkey""")
def _(t: Tables):
    return N.flatten_optional_groups(nested_orders(t).drop("meta"), [("customer", "cust_"), ("lines", "line_"), ("phones", "phone_"), ("customer.address", "addr_")])


@query("pick_nested_or_flat", """
select o_orderkey, case when o_orderstatus = 'P' then o_orderpriority else cast(o_custkey as varchar) end as Contact_Id, o_orderstatus as Contact_Status, cast(null as varchar) as Contact_Fax from orders""")
def _(t: Tables):
    df = t.orders.select("o_orderkey", F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("Id")).alias("Contact"),
                         F.col("o_orderpriority").alias("Contact_Id"), F.col("o_orderstatus").alias("Contact_Status"))
    return df.select("o_orderkey", *[N.pick_nested_or_flat(df, "Contact", f) for f in ("Id", "Status", "Fax")])


@query("array_from_rows", """
select l_orderkey, len(list(l_partkey)) as n_lines, string_agg(l_partkey::varchar, '|' order by l_partkey) as parts from lineitem group by 1""")
def _(t: Tables):
    arr = N.array_from_rows(t.lineitem, keys=["l_orderkey"], fields={"l_partkey": "part"}, name="lines")
    return arr.select("l_orderkey", F.size("lines").cast("bigint").alias("n_lines"), F.array_join(F.transform("lines", lambda x: x["part"].cast("string")), "|").alias("parts"))


# ---- expressions

@query("safe_cast_columns", """
with r as (select o_orderkey, case when o_orderkey % 3 = 0 then o_orderstatus else cast(o_custkey as varchar) end as code, case when o_orderkey % 4 = 0 then 'n/a' else strftime(o_orderdate, '%Y-%m-%d') end as day from orders)
select o_orderkey, try_cast(code as int) as code, try_cast(day as date) as day, cast((try_cast(code as int) is null)::int + (try_cast(day as date) is null)::int as int) as cast_failures from r""")
def _(t: Tables):
    raw = t.orders.select("o_orderkey",
                          F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise(F.col("o_custkey").cast("string")).alias("code"),
                          F.when(F.col("o_orderkey") % 4 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return E.safe_cast_columns(raw, {"code": "int", "day": "date"})


@query("pad_period_label", "select o_orderkey, strftime(o_orderdate, '%y') || 'P' || lpad(cast(month(o_orderdate) as varchar), 2, '0') as period from orders")
def _(t: Tables):
    raw = F.concat(F.date_format("o_orderdate", "yy"), F.lit("P"), F.month("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", E.pad_period_label(raw).alias("period"))


@query("year_week_key", "select l_orderkey, l_linenumber, cast(isoyear(l_shipdate) * 100 + week(l_shipdate) as int) as year_week from lineitem")
def _(t: Tables):
    iso_year = F.extract(F.lit("YEAROFWEEK"), "l_shipdate")
    return t.lineitem.select("l_orderkey", "l_linenumber", E.year_week_key(iso_year, F.weekofyear("l_shipdate")).alias("year_week"))


@query("store_number_from_name", "select c_custkey, try_cast(ltrim(substring(c_name, 10, 9), '0') as int) as store_number from customer")
def _(t: Tables):
    return t.customer.select("c_custkey", E.store_number_from_name(F.col("c_name"), start=10, length=9).alias("store_number"))


def _half_up(num: str, scale: int) -> str:
    """Exact half-up rounding of a decimal SQL text, for a fixed scale."""
    return f"cast(round(cast({num} as decimal(38,10)), {scale}) as decimal(18,{scale}))"


@query("format_kpi", f"""
with v as (select o_orderkey, cast(o_totalprice as decimal(18,4)) as v, cast(cast(o_totalprice as decimal(18,4)) * cast(0.000001 as decimal(7,6)) - cast(0.25 as decimal(3,2)) as decimal(18,4)) as s from
  (select o_orderkey, cast(o_totalprice as decimal(18,2)) as o_totalprice from orders)),
w as (select o_orderkey, v, s, cast({_half_up('abs(s) * 100', 1)} as varchar) as pct, cast({_half_up('abs(s)', 2)} as varchar) as pnd from v)
select o_orderkey, cast({_half_up('v * cast(0.000001 as decimal(7,6))', 2)} as varchar) || 'm' as millions, '£' || cast(cast(v as decimal(18,2)) as varchar) as pounds,
 cast({_half_up('s * 100', 0)} as varchar) || '%' as percent,
 case when s >= 0 then pct || '%' else '(' || pct || '%)' end as change, case when s >= 0 then pct || '%p' else '(' || pct || '%p)' end as points,
 case when s >= 0 then '£' || pnd else '(£' || pnd || ')' end as pounds_change from w""")
def _(t: Tables):
    o = t.orders.select("o_orderkey", money("o_totalprice").cast("decimal(18,4)").alias("v"))
    o = o.withColumn("s", (F.col("v") / F.lit(1000000).cast("decimal(7,0)") - F.lit("0.25").cast("decimal(3,2)")).cast("decimal(18,4)"))
    v, s = F.col("v"), F.col("s")
    return o.select("o_orderkey", E.format_kpi(v, "millions").alias("millions"), E.format_kpi(v, "pounds").alias("pounds"), E.format_kpi(s, "percent").alias("percent"),
                    E.format_kpi(s, "percent_change").alias("change"), E.format_kpi(s, "points_change").alias("points"), E.format_kpi(s, "pounds_change").alias("pounds_change"))


@query("date_key_int", "select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) as date_key from orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", E.date_key_int(F.col("o_orderdate")).alias("date_key"))


@query("year_month_int", "select o_orderkey, cast(cast(year(o_orderdate) as varchar) || cast(month(o_orderdate) as varchar) as int) as year_month from orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", E.year_month_int(F.col("o_orderdate")).alias("year_month"))


@query("two_digit_year_prefix", "select event_id, cast(ts as date) as day from events")
def _(t: Tables):
    return t.events.select("event_id", E.two_digit_year_prefix(F.date_format("ts", "yyMMdd")).alias("day"))


@query("expiry_date", """
with o as (select o_orderkey, left(o_orderpriority, 1) as code, cast(o_orderdate as date) as received, case when o_orderkey % 3 = 0 then null else cast(o_orderdate as date) - 2 end as produced,
 case when o_orderkey % 5 = 0 then cast(o_orderdate as date) + 90 end as stored, case when o_orderkey % 7 = 0 then cast(o_orderdate as date) + 14 end as stored_other from orders)
select o_orderkey, case when code in ('1', '2') then coalesce(stored + 1, coalesce(produced, received) + 180) else coalesce(stored_other + 1, coalesce(produced, received) + 28) end as expiry from o""")
def _(t: Tables):
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    return t.orders.select("o_orderkey", E.expiry_date(
        F.left("o_orderpriority", F.lit(1)), F.when(k % 5 == 0, F.date_add(day, 90)), F.when(k % 7 == 0, F.date_add(day, 14)),
        F.when(k % 3 != 0, F.date_sub(day, 2)), day, codes=["1", "2"]).alias("expiry"))


@query("week_bucket_label", """
with e as (select event_id, ts, cast(ts as date) - cast(dayofweek(ts) as int) as sunday from events)
select event_id, 'ix-' || strftime(ts, '%Y%m') || strftime(sunday, '%d') || '_' || strftime(sunday + 6, '%d') as bucket from e""")
def _(t: Tables):
    return t.events.select("event_id", E.week_bucket_label(F.col("ts"), prefix="ix-").alias("bucket"))


@query("row_identity", "select c_custkey, sha256(c_name || chr(1) || c_nationkey::varchar || chr(1) || c_mktsegment) as row_id from customer")
def _(t: Tables):
    return E.row_identity(t.customer, ["c_name", "c_nationkey", "c_mktsegment"]).select("c_custkey", "row_id")


# ---- text

LINK = r'<a href="([^"]*)">([^<]*)</a>'


@query("extract_links", f"""
select page_id, cast(p - 1 as int) as position, href[p] as href, label[p] as label from
 (select page_id, regexp_extract_all(html, '{LINK}', 1) as href, regexp_extract_all(html, '{LINK}', 2) as label, unnest(range(1, len(regexp_extract_all(html, '{LINK}', 1)) + 1)) as p from pages)""")
def _(t: Tables):
    return X.extract_links(t.pages, "html", pattern=LINK, groups=["href", "label"], keep=["page_id"])


@query("strip_markup", r"""select page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[ \t\n\x0B\f\r]*\n[ \t\n\x0B\f\r]*', ' ', 'g'), ' ') as plain from pages""")
def _(t: Tables):
    return X.strip_markup(t.pages, "html").select("page_id", "plain")


@query("pattern_hits_with_context", r"""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_number from documents),
h as (select * from l where contains(lower(line), 'license'))
select h.doc_id, cast(h.line_number as int) as line_number, h.line, coalesce(string_agg(b.line, chr(10) order by b.line_number), '') as context
from h left join l b on b.doc_id = h.doc_id and b.line_number between h.line_number - 3 and h.line_number - 1 group by 1, 2, 3""")
def _(t: Tables):
    return X.pattern_hits_with_context(t.documents, "text", phrase="license", keep=["doc_id"])


@query("pair_counts_in_lookback", """
select user_id, event_type, count(*) as n, cast(min(ts) as date) as first_day, cast(max(ts) as date) as last_day from events
where cast(ts as date) > date '2024-01-25' - 14 and cast(ts as date) <= date '2024-01-25' group by 1, 2""")
def _(t: Tables):
    return X.pair_counts_in_lookback(t.events, "user_id", "event_type", ts="ts", days=14, as_of="2024-01-25")
