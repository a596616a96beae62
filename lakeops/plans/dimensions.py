"""Dimension loads: each one takes two deliveries and returns the dimension after both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import aggs as A
from lakeops.operators import clean as C
from lakeops.operators import joins as J
from lakeops.operators import loads as D
from lakeops.operators import nested as N
from lakeops.operators import sets as S
from lakeops.operators import windows as W
from lakeops.plans.files import framed
from lakeops.plans.ordering import CAL_SQL, calendar
from lakeops.plans.relational import money
from lakeops.registry import Tables, query
from lakeops.session import fresh_path, materialise
from lakeops.sources import files as R
from lakeops.sources import sinks as K

RUN1, RUN2 = "2001-01-01 00:00:00", "2001-08-01 00:00:00"
RUN_COL = "run_date_time"
SCD = ["scd_active_flag", "record_start_date", "record_end_date"]


def load_scd2(deliveries: Sequence[tuple[DataFrame, str]], *, keys: Sequence[str], cols: Sequence[str], sk: str) -> DataFrame:
    """Load deliveries ``(frame, run time)`` one after the other into an SCD-2 dimension.

    Each load keeps rows newer than the dimension, drops those equal to the
    active version, dates them, numbers them above the highest key, and merges.
    """
    first, run = deliveries[0]
    first = D.one_per_key(first, keys, RUN_COL)
    dim = D.new_dimension(W.surrogate_key(first, order=list(keys), name=sk), as_of=run)
    for src, run in deliveries[1:]:
        # The dimension is read several times below; numbering stores the changed set once.
        dim = materialise(dim, name="dimension")
        newest = D.one_per_key(D.incremental_since(src, dim, ts=RUN_COL), keys, RUN_COL)
        changed = D.scd2_changed_rows(newest, dim, cols=[*keys, *cols])
        dated = D.scd2_start_date(changed, dim, keys=keys, as_of=run)
        top = S.max_value(dim, sk, default=0).scalar()
        numbered = W.surrogate_key(dated, order=list(keys), start=top, name=sk)
        dim = D.scd2_upsert(numbered, dim, keys=keys, cols=[sk, *cols, RUN_COL], as_of=run)
    return dim.select(sk, *keys, *cols, *SCD)


def scd2_sql(v1: str, v2: str, keys: Sequence[str], cols: Sequence[str], sk: str) -> str:
    """The same in SQL: ``v1`` and ``v2`` select keys and columns, one row per key, all newer than the load before."""
    k, c = ", ".join(keys), ", ".join(cols)
    on = " and ".join(f"a.{x} = b.{x}" for x in keys)
    same = " and ".join(f"a.{x} is not distinct from b.{x}" for x in [*keys, *cols])
    return f"""v1 as ({v1}), v2 as ({v2}), t1 as (select row_number() over (order by {k}) as {sk}, {k}, {c} from v1),
chg as (select a.* from v2 a where not exists (select 1 from v1 b where {same})),
dim as (select {sk}, {", ".join("b." + x for x in [*keys, *cols])}, case when a.{keys[0]} is null then 'Y' else 'N' end as scd_active_flag, timestamp '1900-01-01 00:00:00' as record_start_date,
  case when a.{keys[0]} is null then timestamp '9999-12-31 11:59:59' else timestamp '{RUN2}' end as record_end_date from t1 b left join chg a on {on}
 union all select (select max({sk}) from t1) + row_number() over (order by {", ".join("a." + x for x in keys)}), {", ".join("a." + x for x in [*keys, *cols])}, 'Y',
  case when b.{keys[0]} is null then timestamp '1900-01-01 00:00:00' else timestamp '{RUN2}' end, timestamp '9999-12-31 11:59:59' from chg a left join v1 b on {on})"""


def stamped(df: DataFrame, run: str) -> DataFrame:
    return df.withColumn(RUN_COL, F.lit(run).cast("timestamp_ntz"))


AREA_SQL = f"""select row_number() over (order by c_custkey) as sk_area, c_custkey as area_code, c_name as area_name, coalesce(case when r_regionkey <> 1 then r_name end, 'UNKNOWN') as region_name,
 coalesce(case when c_custkey % 4 <> 0 then cast(c_acctbal as decimal(30,5)) end, cast(0 as decimal(30,5))) as area_size, timestamp '{RUN1}' as create_datetime, cast(null as timestamp) as update_datetime
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


@query("mart_dim_area", AREA_SQL)
def mart_dim_area(t: Tables):
    """Areas from GeoJSON features, nulls replaced, numbered by their code, and loaded as a whole."""
    path = fresh_path(t.spark, "areas")
    c = J.join_star_inner(t.customer, [(t.nation, F.col("c_nationkey") == F.col("n_nationkey")), (t.region, F.col("n_regionkey") == F.col("r_regionkey"))])
    props = F.struct(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.when(F.col("r_regionkey") != 1, F.col("r_name")).alias("region"),
                     F.when(F.col("c_custkey") % 4 != 0, money("c_acctbal")).alias("size"))
    row = F.to_json(F.struct(props.alias("properties")), {"pretty": "true"})
    framed(c.select(F.concat(row, F.lit(",")).alias("value")), '{"features": [', "{}]}").write.text(path)
    docs = R.scan_json_multiline(t.spark, path, schema="features array<struct<properties: struct<code: bigint, name: string, region: string, size: decimal(30,5)>>>")
    flat = N.flatten_structs(N.explode_rows(docs, "features"), ["properties"]).where("code is not null")
    areas = C.select_rename_cast(flat, [("code", "bigint", "area_code"), ("name", "string", "area_name"), ("region", "string", "region_name"), ("size", "decimal(30,5)", "area_size")])
    areas = C.default_sentinels(areas, {"area_name": "UNKNOWN", "region_name": "UNKNOWN", "area_size": 0})
    keyed = W.surrogate_key(areas, order=["area_code"], name="sk_area")
    return K.truncate_and_load(C.audit_columns(keyed, as_of=RUN1), fresh_path(t.spark, "dim_area"))


PACK_COLS = ["p_name", "p_brand", "p_size"]


@query("mart_dim_product_pack", "with " + scd2_sql(
    "select p_partkey, p_name, p_brand, p_size from part where p_size < 45",
    "select p_partkey, case when p_partkey % 4 = 0 then p_name || ' XL' else p_name end as p_name, p_brand, case when p_partkey % 10 = 1 then null else p_size end as p_size from part where p_size > 4",
    ["p_partkey"], PACK_COLS, "sk_pack") + " select * from dim")
def mart_dim_product_pack(t: Tables):
    """Product packs: a delivery repeats products under older run times, and the newest row per product counts."""
    p = t.part.select("p_partkey", *PACK_COLS)  # deliveries overlap, but neither has all products
    k = F.col("p_partkey")
    second = p.where("p_size > 4").withColumns({"p_name": F.when(k % 4 == 0, F.concat("p_name", F.lit(" XL"))).otherwise(F.col("p_name")),
                                                       "p_size": F.when(k % 10 != 1, F.col("p_size"))})
    older = stamped(p.withColumn("p_name", F.lit("superseded")), "2001-07-01 00:00:00").join(second.select("p_partkey"), "p_partkey", "left_semi")
    return load_scd2([(stamped(p.where("p_size < 45"), RUN1), RUN1), (stamped(second, RUN2).unionByName(older), RUN2)],
                     keys=["p_partkey"], cols=PACK_COLS, sk="sk_pack")


def price_list(t: Tables, average_below: int) -> DataFrame:
    """Unit price per part and pricing region: basic, else average, else a default, with its source."""
    regions = t.part.select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("region"))
    basic = t.part.where("p_size between 3 and 15").select(
        "p_partkey", (F.col("p_partkey") % 5).cast("int").alias("region"), F.col("p_retailprice").cast("decimal(28,10)").alias("unit_price"))
    no_basic = J.anti_join_not_in(t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_quantity", "l_extendedprice"), basic, "p_partkey")
    average = no_basic.where(F.col("l_quantity") < average_below).groupBy("p_partkey").agg(F.min(money("l_extendedprice")).cast("decimal(28,10)").alias("unit_price"))
    average = average.select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("region"), "unit_price")
    out = J.status_cascade_lookup(regions, [("Basic", basic), ("Average", average)], key=["p_partkey", "region"], value="unit_price", default="0.01", label="price_source")
    known = F.when(F.col("price_source") == "Default", F.lit(1)).otherwise(0)
    # A part with a basic price is priced in the basic regions only.
    priced = out.join(basic.select("p_partkey").withColumn("_b", F.lit(True)), "p_partkey", "left")
    return priced.where(~((known == 1) & F.coalesce("_b", F.lit(False)))).drop("_b").join(
        t.region.select(F.col("r_regionkey").alias("region"), F.col("r_name").alias("pricing_region")), "region").drop("region")


def _price_sql(below: int) -> str:
    return f"""select p.p_partkey, r_name as pricing_region, case when b.p_partkey is not null then b.unit_price when a.p_partkey is not null then a.unit_price else cast(0.01 as decimal(28,10)) end as unit_price,
  case when b.p_partkey is not null then 'Basic' when a.p_partkey is not null then 'Average' else 'Default' end as price_source
 from part p cross join region left join (select p_partkey, cast(p_partkey % 5 as int) as region, cast(p_retailprice as decimal(28,10)) as unit_price from part where p_size between 3 and 15) b on b.p_partkey = p.p_partkey and b.region = r_regionkey
 left join (select l_partkey as p_partkey, cast(min(cast(l_extendedprice as decimal(18,2))) as decimal(28,10)) as unit_price from lineitem where l_quantity < {below}
   and l_partkey not in (select p_partkey from part where p_size between 3 and 15) group by 1) a on a.p_partkey = p.p_partkey
 where b.p_partkey is not null or p.p_partkey not in (select p_partkey from part where p_size between 3 and 15)"""


@query("mart_dim_price", "with " + scd2_sql(_price_sql(10), _price_sql(15), ["p_partkey", "pricing_region"], ["unit_price", "price_source"], "sk_price") + " select * from dim")
def mart_dim_price(t: Tables):
    """Unit prices by region, each price from the first source that has one, as SCD-2."""
    return load_scd2([(stamped(price_list(t, 10), RUN1), RUN1), (stamped(price_list(t, 15), RUN2), RUN2)],
                     keys=["p_partkey", "pricing_region"], cols=["unit_price", "price_source"], sk="sk_price")


@query("mart_dim_pack_size", "with " + scd2_sql(
    "select s_suppkey, s_name, s_nationkey from supplier where s_acctbal >= 1000", "select s_suppkey, s_name, case when s_suppkey % 3 = 0 then s_nationkey + 1 else s_nationkey end as s_nationkey from supplier",
    ["s_suppkey"], ["s_name", "s_nationkey"], "sk_pack_size") + " select * from dim")
def mart_dim_pack_size(t: Tables):
    """Incremental load with keys above the highest one, as SCD-2; rows from before the last load are ignored."""
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    second = s.withColumn("s_nationkey", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey")))
    late = stamped(s.withColumn("s_name", F.lit("too late")), "2000-12-31 00:00:00")
    return load_scd2([(stamped(s.where("s_acctbal >= 1000"), RUN1), RUN1), (stamped(second, RUN2).unionByName(late), RUN2)],
                     keys=["s_suppkey"], cols=["s_name", "s_nationkey"], sk="sk_pack_size")


@query("mart_dim_reason", f"""
with t as (select row_number() over (order by c_custkey) as sk_reason, c_custkey, c_name, c_mktsegment from customer where c_acctbal >= 1000),
s as (select c_custkey, case when c_custkey % 6 = 0 then c_name || ' *' else c_name end as c_name, c_mktsegment from customer where c_acctbal < 8000),
n as (select (select max(sk_reason) from t) + row_number() over (order by s.c_custkey) as sk_reason, s.* from s where c_custkey not in (select c_custkey from t))
select t.sk_reason, t.c_custkey, coalesce(s.c_name, t.c_name) as c_name, t.c_mktsegment, timestamp '{RUN1}' as create_datetime, case when s.c_custkey is not null then timestamp '{RUN2}' end as update_datetime from t left join s on s.c_custkey = t.c_custkey
union all select sk_reason, c_custkey, c_name, c_mktsegment, timestamp '{RUN2}', null from n""")
def mart_dim_reason(t: Tables):
    """Incremental load as SCD-1: known reasons change in place, new ones get the next keys."""
    c = stamped(t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal"), RUN1)
    dim = C.audit_columns(W.surrogate_key(c.where("c_acctbal >= 1000").drop("c_acctbal"), order=["c_custkey"], name="sk_reason"), as_of=RUN1)
    dim = materialise(dim, name="dim_reason")
    fresh = c.where("c_acctbal < 8000").withColumns({
        "c_name": F.when(F.col("c_custkey") % 6 == 0, F.concat("c_name", F.lit(" *"))).otherwise(F.col("c_name")), RUN_COL: F.lit(RUN2).cast("timestamp_ntz")})
    src = D.incremental_since(fresh.unionByName(c.withColumn("c_name", F.lit("too late"))), dim, ts=RUN_COL)
    known = src.join(dim.select("c_custkey", "sk_reason"), "c_custkey", "left")
    new = W.surrogate_key(known.where("sk_reason is null"), order=["c_custkey"], start=S.max_value(dim, "sk_reason", default=0).scalar(), name="sk_reason")
    keyed = known.where("sk_reason is not null").unionByName(new.select(*known.columns))
    out = D.scd1_upsert(keyed, dim, keys=["c_custkey"], update_cols=["sk_reason", "c_name", "c_mktsegment", RUN_COL], as_of=RUN2)
    return out.drop(RUN_COL)


SITE_COLS = ["s_name", "country", "region_no", "region_name", "company"]
SITE_SQL = """select s_suppkey as site_code, s_name, n_name as country, coalesce(n_regionkey, -1) as region_no, coalesce(r_name, 'UNKNOWN') as region_name, coalesce(company, 'UNKNOWN') as company from supplier
 left join (select * replace (case when n_nationkey < 20 then n_nationkey end as n_nationkey) from nation) on n_nationkey = {} left join region on r_regionkey = n_regionkey left join (select distinct case when s_nationkey % 6 = 5 then -1 - s_nationkey else s_nationkey end as k, 'Company ' || cast(s_nationkey % 4 as varchar) as company from supplier) on k = s_nationkey"""


@query("mart_dim_site", "with " + scd2_sql(SITE_SQL.format("s_nationkey"), SITE_SQL.format("(case when s_suppkey % 4 = 1 then 24 - s_nationkey else s_nationkey end)"), ["site_code"], SITE_COLS, "sk_store") + " select * from dim")
def mart_dim_site(t: Tables):
    """Sites with their country, region and company, the company from a CSV look-up, as SCD-2 on the site code."""
    path = fresh_path(t.spark, "companies")
    # Renamed keys leave the suppliers of some nations without a company.
    company = t.supplier.select(F.when(F.col("s_nationkey") % 6 == 5, -1 - F.col("s_nationkey")).otherwise(F.col("s_nationkey")).alias("k"), F.concat(F.lit("Company "), (F.col("s_nationkey") % 4).cast("string")).alias("company"))
    company.distinct().write.csv(path, header=True)
    lookup = R.scan_csv_header_glob(t.spark, f"{path}/*.csv", schema="k int, company string")
    nations = t.nation.withColumn("n_nationkey", F.when(F.col("n_nationkey") < 20, F.col("n_nationkey")))

    def sites(moved):
        s = t.supplier.withColumn("_n", moved)
        s = s.join(nations, F.col("_n") == F.col("n_nationkey"), "left").join(t.region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
        s = J.lookup_map(s, lookup, key="s_nationkey", map_key="k", value="company", name="company")
        out = s.select(F.col("s_suppkey").alias("site_code"), "s_name", F.col("n_name").alias("country"), F.col("n_regionkey").alias("region_no"), F.col("r_name").alias("region_name"), "company")
        return C.default_sentinels(out, {"region_no": -1, "region_name": "UNKNOWN", "company": "UNKNOWN"})

    k = F.col("s_nationkey")
    return load_scd2([(stamped(sites(k), RUN1), RUN1), (stamped(sites(F.when(F.col("s_suppkey") % 4 == 1, 24 - k).otherwise(k)), RUN2), RUN2)],
                     keys=["site_code"], cols=SITE_COLS, sk="sk_store")


@query("mart_dim_bridge", f"select distinct l_partkey, l_suppkey, timestamp '{RUN1}' as create_datetime, cast(null as timestamp) as update_datetime from lineitem")
def mart_dim_bridge(t: Tables):
    """Product and stock unit pairs, distinct, loaded as a whole."""
    pairs = A.distinct_rows(t.lineitem, ["l_partkey", "l_suppkey"])
    return K.truncate_and_load(C.audit_columns(pairs, as_of=RUN1), fresh_path(t.spark, "dim_bridge"))


@query("mart_dim_prescribable", "with " + scd2_sql(
    "select p_partkey as product_code, p_type as product_type, cast(p_retailprice as decimal(18,4)) as price from part", "select p_partkey as product_code, p_type as product_type, cast(p_retailprice * case when p_partkey % 5 = 0 then 2 else 1 end as decimal(18,4)) as price from part where p_size <= 25",
    ["product_code"], ["product_type", "price"], "sk_product") + " select * from dim")
def mart_dim_prescribable(t: Tables):
    """Prescribable products, incremental, as SCD-2."""
    p = t.part.select(F.col("p_partkey").alias("product_code"), F.col("p_type").alias("product_type"), F.col("p_retailprice").cast("decimal(18,4)").alias("price"), "p_size")
    second = p.where("p_size <= 25").withColumn("price", F.when(F.col("product_code") % 5 == 0, F.col("price") * 2).otherwise(F.col("price")).cast("decimal(18,4)"))
    return load_scd2([(stamped(p, RUN1), RUN1), (stamped(second, RUN2), RUN2)], keys=["product_code"], cols=["product_type", "price"], sk="sk_product")


@query("mart_dim_calendar", f"with {CAL_SQL} select date_key, date_value, financial_week_number, financial_year, week_commencing_date from calendar")
def mart_dim_calendar(t: Tables):
    """The calendar, loaded as a whole."""
    out = K.truncate_and_load(calendar(t), fresh_path(t.spark, "dim_calendar"))
    return out.select("date_key", "date_value", "financial_week_number", "financial_year", "week_commencing_date")


@query("mart_dim_market", """
with o as (select c_custkey, trim(c_mktsegment) as segment, c_nationkey, case when c_custkey % 9 <> 0 then cast(o_orderdate as date) end as day from customer left join orders on o_custkey = c_custkey),
g as (select c_custkey, segment, c_nationkey, coalesce(min(day), date '1900-01-01') as valid_from, coalesce(max(day), date '9999-12-31') as valid_to from o group by 1, 2, 3)
select cast(dense_rank() over (order by segment, c_nationkey) as bigint) as market_sk, c_custkey, segment, case when c_nationkey < 5 then 'UK' when c_nationkey < 10 then 'IE' else 'UNKNOWN' end as country, valid_from, valid_to from g""")
def mart_dim_market(t: Tables):
    """Outlets with the days they were seen, a market key per segment and nation, and a country code."""
    day = F.when(F.col("c_custkey") % 9 != 0, F.col("o_orderdate"))
    seen = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", F.trim("c_mktsegment").alias("segment"), "c_nationkey", day.alias("day"))
    spans = W.validity_from_observations(seen, attrs=["c_custkey", "segment", "c_nationkey"], date="day")
    keyed = W.dense_surrogate(spans, ["segment", "c_nationkey"], name="market_sk")
    out = C.derived_case_columns(keyed, [("country", [("c_nationkey < 5", "UK"), ("c_nationkey < 10", "IE")], "UNKNOWN")])
    return out.select("market_sk", "c_custkey", "segment", "country", "valid_from", "valid_to")
