"""End-to-end feeds: files in, conformed tables out."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators import aggs as A
from lakeops.operators import clean as C
from lakeops.operators import control as L
from lakeops.operators import nested as N
from lakeops.operators import sets as S
from lakeops.operators.windows import Level, propagate_parent_keys
from lakeops.plans.files import FEED, framed, named_feed, write_xml
from lakeops.plans.relational import money
from lakeops.plans.streams import ENTITIES, ENV_SQL, SENT, envelopes, landed_entity
from lakeops.registry import Tables, query
from lakeops.session import fresh_path, materialise
from lakeops.sources import files as R
from lakeops.sources import sinks as O
from lakeops.streaming import changes as X

# ---- point-of-sale file: one layout, many record types

WIDTH = 29
POS_SCHEMA = R.text_schema(["Attribute0", "recordtype", *[f"Attribute{i}" for i in range(1, WIDTH + 1)]])

# Which record opens which key, and from which attributes.
POS_LEVELS = [
    Level("TRANSACTIONID", "H", ("Attribute1", "Attribute4", "Attribute6", "Attribute5")),
    Level("TRANSACTIONLINEITEMID", "L", ("Attribute1",), "TRANSACTIONID"),
    Level("TRANSLINEADJUSTMENTID", "LD", ("Attribute1",), "TRANSACTIONLINEITEMID"),
    Level("TRANADJUSTMENTID", "HD", ("Attribute6",), "TRANSACTIONID"),
    Level("PAYMENTID", "TR", ("Attribute1",), "TRANSACTIONID"),
]
POS_DATE = {"TRANSACTIONDATE": ("H", "Attribute2")}

# The fields of the record types used here, from Attribute1 on.
POS_LAYOUTS = {
    "H": "RETAILSTOREID BUSINESSDAYDATE TRANSTYPECODE WORKSTATIONID TRANSNUMBER BEGINTIMESTAMP ENDDATETIMESTAMP OPERATORQUAL OPERATORID TRANSCURRENCY",
    "L": "RETAILNUMBER RETAILTYPECODE RETAILREASONCODE ITEMIDQUALIFIER ITEMID RETAILQUANTITY SALESUOM SALESAMOUNT NORMALSALESAMOUNT ENTRYMETHODCODE",
    "55": "ORGPRICE",
    "LD": "DISCNUMBER DISCTYPECODE DISCREASONCODE REDUCTIONAMOUNT DISCOUNTID BONUSBUYID",
    "HD": "DISCNUMBER DISCTYPECODE DISCREASONCODE REDUCTIONAMOUNT DISCOUNTID BONUSBUYID",
    "34": "REWARDAMNT",
    "TR": "TENDERNUMBER TENDERTYPECODE TENDERAMOUNT TENDERID ACCOUNTNUMBER",
    "13": "NEGTNDRFLG",
    "LC": "LOYNUMBER CUSTCARDNUMBER LOYPROGRAMID LOYPNTSAWARDED ELIGIBLEAMOUNT",
    "38": "COUNTCRDUS LREASNCODE",
    "41": "PROMOID PRDESC",
    "64": "PROMOID PRDESC",
    "39": "CPONBARCOD CPONAMT",
    "46": "GCRDNUM GCRDTRNID GCRD1SALFL GCRD2SALFL GCRDRETFLG GCRDADDFLG GCRDREMFLG GCRDAMTADJ GCRDPREVBL",
    "86": "GCRDNUM GCRDTRNID GCRD1SALFL GCRD2SALFL GCRDRETFLG GCRDADDFLG GCRDREMFLG GCRDAMTADJ GCRDPREVBL",
    "45": "CARDNUM ITMCODE TOPUPAMT NETWRKNAME NETWRKPRDT SWIPEKEYED VOIDFLAG RESPONCODE MOBPHNNUM",
    "57": "CARDNUM ITMCODE TOPUPAMT NETWRKNAME NETWRKPRDT RESPONCODE",
    "24": "TRANSNUMBER BUSINESSDAYDATE BEGINTIMESTAMP CREDITCLAIMNO BCLETTER CLAIMREASON INVNUMBER FOLIONO BATCHREF CONSFLAG REPCATG REPNO POLCYNO DDDANO DELVNO DELDATE CARTONRCD REFDOCID COMMENT ITMCOUNT ITEMID BASEUOM BASEQUANTITY UNITPRICE",
    "25": "TRANSNUMBER BUSINESSDAYDATE BEGINTIMESTAMP CREDITCLAIMNO AUTHORISATION STOCKFL CLAIMREASON ITMCOUNT ITEMID BASEUOM BASEQUANTITY UNITPRICE",
    "26": "TRANSNUMBER BUSINESSDAYDATE BEGINTIMESTAMP UODNO STATUS CREDITCLAIMNO UODQTY STOCKFL SPROUTE DISPLOC BCLETTER RECALNO AUTHORISATION RETMETHD CARRIER CLAIMREASON RESCAN DAMREAS RECSTORE ITEMID BASEUOM BASEQUANTITY UNITPRICE",
    "28": "TRANSNUMBER BUSINESSDAYDATE BEGINTIMESTAMP UODNO STATUS CREDITCLAIMNO ITMCOUNT ITEMID BASEUOM BASEQUANTITY UNITPRICE",
}


def read_pos(spark, path: str) -> DataFrame:
    """Records of point-of-sale files with the keys of the records above them, stored by record type.

    Each record type becomes one partition, so a model table reads its own records only.
    """
    raw = R.with_position(R.scan_delimited(spark, path, schema=POS_SCHEMA)).drop("Attribute0")
    keyed = propagate_parent_keys(raw, record_type="recordtype", levels=POS_LEVELS, file_col=R.FILE, position_col=R.POSITION, carried=POS_DATE,
                                  block=R.split_start())
    target = fresh_path(spark, "pos")
    keyed = keyed.drop(R.FILE, R.POSITION)
    # Each task writes its own records of a type: whole rows are the largest thing here, so they are not shuffled.
    # Keys hardly repeat, so building dictionaries of them is lost time.
    plain = {f"parquet.enable.dictionary#{n}": "false" for n in [*[lv.name for lv in POS_LEVELS], *POS_DATE]}
    keyed.write.partitionBy("recordtype").options(**plain).parquet(target, compression="zstd")
    schema = keyed.schema
    return spark.read.schema(schema).parquet(target)


def record(pos: DataFrame, kind: str, keys: Sequence[str], layouts: Mapping[str, str] = POS_LAYOUTS) -> DataFrame:
    """One record type with its field names and the chosen keys."""
    fields = layouts[kind].split()
    return pos.where(F.col("recordtype") == kind).select(*keys, *[F.col(f"Attribute{i}").alias(f) for i, f in enumerate(fields, 1)])


def pos_tables(pos: DataFrame) -> dict[str, DataFrame]:
    """Model tables, each from a main record and the records that extend it."""
    tid, lid, aid, did, pid, day = "TRANSACTIONID", "TRANSACTIONLINEITEMID", "TRANADJUSTMENTID", "TRANSLINEADJUSTMENTID", "PAYMENTID", "TRANSACTIONDATE"
    rec = lambda k, *keys: record(pos, k, keys)
    lines = rec("L", tid, lid, day).join(rec("55", lid), lid, "left")
    promo = S.union_distinct_rows(rec("41", tid, day).where("PROMOID is not null"), rec("64", tid, day).where("PROMOID is not null"))
    header = rec("H", tid).select(tid, "ENDDATETIMESTAMP", "BUSINESSDAYDATE")
    earned = rec("LC", tid, day).where("CUSTCARDNUMBER is not null").join(rec("38", tid), tid, "left").join(header, tid, "left")
    cards = S.union_padded(rec("46", tid, lid), rec("86", tid)).where("GCRDNUM is not null").distinct().join(header, tid, "left")
    moved = F.when(F.col("GCRDRETFLG").isNotNull(), "Funds Returned").when(F.col("GCRDADDFLG").isNotNull(), "Funds Added").when(F.col("GCRDREMFLG").isNotNull(), "Funds Removed")
    top_ups = S.union_padded(rec("45", tid, lid, day), rec("57", tid, lid, day)).where("CARDNUM is not null").distinct()
    claims = S.union_padded(*[rec(k, tid) for k in ("24", "25", "26", "28")]).where("CREDITCLAIMNO is not null and ITEMID is not null").distinct()
    return {
        "LoyaltyAccountEarning": earned,
        "GiftCardTransaction": cards.withColumn("GIFTCARDTYPE", moved),
        "ETopupEVoucher": top_ups,
        "TransactionCreditClaim": claims,
        "Transaction": rec("H", tid),
        "TransactionLineItem": lines,
        "TransactionLineItemAdjustment": rec("LD", tid, lid, did, day),
        "TransactionAdjustment": rec("HD", tid, aid, day).join(rec("34", aid), aid, "left"),
        "TransactionLoyaltyAccount": rec("LC", tid, day).join(rec("38", tid), tid, "left"),
        "TransactionPromotion": promo,
        "TransactionPayment": rec("TR", tid, pid, day).select(tid, pid, day).distinct(),
        "Payment": rec("TR", pid).join(rec("13", pid), pid, "left"),
        "TransactionCoupon": rec("39", tid, day),
    }


LINES1_SQL = "lines as (select * exclude (r) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as r from lineitem) where r = 1)"


# The records of an order and, from 10 to 15, of a line: their place in the transaction, when they are written, and their text.
POS_RECORDS = {
    0: ("true", "|H|{cust}|{d}|{status}|1|{order}|{begun}|{ended}|||GBP"),
    1: ("o_orderpriority in ('2-HIGH', '3-MEDIUM')", "|LC|1|{card}|P|{points}|"),
    2: ("o_orderpriority = '2-HIGH'", "|38|2|R1"),
    1000: ("o_orderpriority = '1-URGENT'", "|HD|1|Z|R|5.00|D2|B9"),
    1001: ("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'", "|34|7"),
    1002: ("o_orderstatus = 'P'", "|41|P41|spring"),
    1003: ("o_orderstatus <> 'F'", "|64|{promo}|autumn"),
    1004: ("o_orderpriority = '5-LOW'", "|39|{claim}|1.50"),
    1005: ("true", "|TR|1|CARD|{total}|T1|"),
    1006: ("o_totalprice > 400000", "|13|Y"),
    1007: ("o_orderstatus = 'P'", "|86|{gift}|2||||||3.00|9.00"),
    1008: ("o_orderpriority = '3-MEDIUM'", "|24|{order}|{d}||{claim}" + "|" * 17 + "{i}|EA|1|{total}"),
    1009: ("o_orderpriority = '4-NOT SPECIFIED'", "|25|{order}|{d}||{even}" + "|" * 5 + "{j}|EA|2|1.25"),
    1010: ("o_orderpriority = '5-LOW'", "|26|{order}|{d}||u|s|{claim}" + "|" * 14 + "{k}|EA|3|2.50"),
    1011: ("o_orderpriority = '1-URGENT'", "|28|{order}|{d}||u|s|{claim}||{m}|EA|4|3.75"),
    10: ("true", "|L|{line}|{linestatus}|{flag}|SKU|{part}|{quantity}|EA|{price}|{price}|S"),
    11: ("l_quantity > 40", "|55|{price}"),
    12: ("l_discount > 0.05D", "|LD|1|Z|R|{disc}|D1|B1"),
    13: ("l_quantity > 45", "|46|{giftpart}|1|||{returned}|{added}|Y|{price}|9.00"),
    14: ("l_quantity < 3", "|45|{topup}|I|10.00|net|prd|S||00|077"),
    15: ("l_quantity = 5", "|57|{voucher}|I|20.00|net|prd|01"),
}


def is_line(number: int) -> bool:
    """Whether a record belongs to a line."""
    return 10 <= number < 1000


def write_pos(t: Tables) -> str:
    """Orders and their lines as point-of-sale files: whole transactions in order, each file led by an orphan line.

    Only the columns in use are shuffled, once, by order. Lines are made distinct and
    a row makes its records behind that shuffle. Files are compressed, for speed.
    """
    o = t.orders.select("*", F.date_format("o_orderdate", "yyyyMMdd").alias("d")).drop("o_orderdate")
    # The ship date comes last in the order that picks a line, and no record holds it.
    rest = [c for c in t.lineitem.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    # Orders are told apart by a number, so that two alike stay two.
    o = o.select(F.col("o_orderkey").alias("ok"), F.monotonically_increasing_id().alias("nth"), *o.columns)
    li = t.lineitem.select(F.col("l_orderkey").alias("ok"), "l_linenumber", *rest)
    rows = S.union_padded(o, li).repartitionByRange("ok")
    rows = A.dedupe_by(rows, ["ok", "nth", "l_linenumber"], [*rest, *[c for c in rows.columns if c.startswith("o_")], "d"])

    cust, price, flag = F.col("o_custkey"), money("l_extendedprice"), F.col("l_returnflag")
    led = lambda letters, c: F.concat(F.lit(letters), c.cast("string"))
    # Values are made once a row; a record puts them between its fixed texts.
    values = {
        "cust": cust, "d": F.col("d"), "status": F.col("o_orderstatus"), "order": F.col("o_orderkey"), "begun": F.concat("d", F.lit("0900")), "ended": F.concat("d", F.lit("0905")),
        "card": led("card", cust), "points": cust % 100, "promo": F.when(cust % 2 == 0, "P64"), "total": money("o_totalprice"), "gift": led("g", cust), "claim": led("c", cust),
        "even": F.when(cust % 2 == 0, led("c", cust)), "i": led("i", cust), "j": led("j", cust), "k": F.when(cust % 3 != 0, led("k", cust)), "m": led("m", cust),
        "line": F.col("l_linenumber"), "linestatus": F.col("l_linestatus"), "flag": flag, "part": F.col("l_partkey"), "quantity": money("l_quantity"), "price": price,
        "disc": F.when(F.expr("l_discount > 0.05D"), F.col("l_discount").cast("decimal(4,2)")), "giftpart": led("g", F.col("l_partkey")), "returned": F.when(flag == "R", "Y"),
        "added": F.when(flag == "A", "Y"), "topup": led("t", F.col("l_suppkey")), "voucher": F.when(flag != "N", led("v", F.col("l_suppkey"))),
    }
    conditions = ["o_orderstatus", "o_orderpriority", "o_totalprice", "l_quantity", "l_discount"]
    rows = rows.select("ok", F.col("nth").isNotNull().alias("of_order"), (F.col("l_linenumber").cast("bigint") * 10).alias("first"), *conditions,
                       *[F.coalesce(c.cast("string"), F.lit("")).alias(f"v_{n}") for n, c in values.items()])
    of_order, of_line = ([F.lit(n).cast("bigint") for n in POS_RECORDS if is_line(n) == y] for y in (False, True))
    records = rows.select("*", F.explode(F.when(F.col("of_order"), F.array(*of_order)).otherwise(F.array(*of_line))).alias("nth"))

    def chosen(of) -> Column:
        """What ``of`` gives for the number of each record."""
        return reduce(lambda made, n: made.when(F.col("nth") == n, of(*POS_RECORDS[n])), POS_RECORDS, F)

    def text(where: str, template: str) -> Column:
        return F.concat(*[F.col(f"v_{x}") if i % 2 else F.lit(x) for i, x in enumerate(re.split(r"\{(\w+)\}", template)) if x])

    records = records.where(chosen(lambda where, template: F.expr(where)))
    seq = F.when(F.col("of_order"), F.col("nth")).otherwise(F.col("first") + F.col("nth"))
    records = records.select("ok", seq.alias("seq"), chosen(text).alias("value"))
    path = fresh_path(t.spark, "pos_in")
    ordered = records.sortWithinPartitions("ok", "seq").select("value")
    framed(ordered, "|L|99|orphan", None).write.option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")
    return path


POS_SQL = f"""{LINES1_SQL}, h as (select o_orderkey as ok, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, strftime(o_orderdate, '%Y%m%d') as d, cast(o_custkey as varchar) || '1' || strftime(o_orderdate, '%Y%m%d') || '0900' || cast(o_orderkey as varchar) as tid from orders),
l as (select h.*, lines.*, tid || 'L' || cast(l_linenumber as varchar) as lid from lines join h on l_orderkey = ok)"""


@query("feed_pos_transactions", f"""
with {POS_SQL}
select 'Transaction' as model, tid as id, cast(null as varchar) as sub_id, cast(null as varchar) as day, o_orderstatus as code, cast(ok as varchar) as detail from h
union all select 'TransactionLineItem', tid, lid, d, cast(l_partkey as varchar), case when l_quantity > 40 then cast(cast(l_extendedprice as decimal(18,2)) as varchar) end from l
union all select 'TransactionLineItemAdjustment', tid, lid || 'LD1', d, 'D1', cast(cast(l_discount as decimal(4,2)) as varchar) from l where l_discount > 0.05
union all select 'TransactionAdjustment', tid, tid || 'HDB9', d, 'D2', case when o_orderstatus = 'F' then '7' end from h where o_orderpriority = '1-URGENT'
union all select 'TransactionLoyaltyAccount', tid, null, d, 'card' || cast(o_custkey as varchar), case when o_orderpriority = '2-HIGH' then '2' end from h where o_orderpriority in ('2-HIGH', '3-MEDIUM')
union all select 'TransactionPromotion', tid, null, d, 'P41', 'spring' from h where o_orderstatus = 'P' union all select 'TransactionPromotion', tid, null, d, 'P64', 'autumn' from h where o_orderstatus <> 'F' and o_custkey % 2 = 0
union all select 'TransactionPayment', tid, tid || 'TR1', d, null, null from h union all select 'Payment', null, tid || 'TR1', null, cast(cast(o_totalprice as decimal(18,2)) as varchar), case when o_totalprice > 400000 then 'Y' end from h
union all select 'TransactionCoupon', tid, null, d, 'c' || cast(o_custkey as varchar), '1.50' from h where o_orderpriority = '5-LOW'
union all select 'LoyaltyAccountEarning', tid, case when o_orderpriority = '2-HIGH' then 'R1' end, d, 'card' || cast(o_custkey as varchar), d || '0905' from h where o_orderpriority in ('2-HIGH', '3-MEDIUM')
union all select 'GiftCardTransaction', tid, lid, d, 'g' || cast(l_partkey as varchar), case l_returnflag when 'R' then 'Funds Returned' when 'A' then 'Funds Added' else 'Funds Removed' end from l where l_quantity > 45
union all select 'GiftCardTransaction', tid, null, d, 'g' || cast(o_custkey as varchar), null from h where o_orderstatus = 'P'
union all select 'ETopupEVoucher', tid, lid, d, 't' || cast(l_suppkey as varchar), '10.00' from l where l_quantity < 3 union all select 'ETopupEVoucher', tid, lid, d, 'v' || cast(l_suppkey as varchar), '20.00' from l where l_quantity = 5 and l_returnflag <> 'N'
union all select 'TransactionCreditClaim', tid, 'c' || cast(o_custkey as varchar), d, k || cast(o_custkey as varchar), price from (select *, 'i' as k, cast(cast(o_totalprice as decimal(18,2)) as varchar) as price from h where o_orderpriority = '3-MEDIUM'
 union all select *, 'j', '1.25' from h where o_orderpriority = '4-NOT SPECIFIED' and o_custkey % 2 = 0 union all select *, 'k', '2.50' from h where o_orderpriority = '5-LOW' and o_custkey % 3 <> 0 union all select *, 'm', '3.75' from h where o_orderpriority = '1-URGENT')
union all select 'orphans', null, null, null, 'seen', null from region where r_regionkey = 0""")
def feed_pos_transactions(t: Tables):
    """Point-of-sale files to model tables; lines above the first header keep null keys."""
    pos = read_pos(t.spark, write_pos(t))
    tables = pos_tables(pos)
    shown = {
        "Transaction": ("TRANSACTIONID", None, None, "TRANSTYPECODE", "TRANSNUMBER"),
        "TransactionLineItem": ("TRANSACTIONID", "TRANSACTIONLINEITEMID", "TRANSACTIONDATE", "ITEMID", "ORGPRICE"),
        "TransactionLineItemAdjustment": ("TRANSACTIONID", "TRANSLINEADJUSTMENTID", "TRANSACTIONDATE", "DISCOUNTID", "REDUCTIONAMOUNT"),
        "TransactionAdjustment": ("TRANSACTIONID", "TRANADJUSTMENTID", "TRANSACTIONDATE", "DISCOUNTID", "REWARDAMNT"),
        "TransactionLoyaltyAccount": ("TRANSACTIONID", None, "TRANSACTIONDATE", "CUSTCARDNUMBER", "COUNTCRDUS"),
        "TransactionPromotion": ("TRANSACTIONID", None, "TRANSACTIONDATE", "PROMOID", "PRDESC"),
        "TransactionPayment": ("TRANSACTIONID", "PAYMENTID", "TRANSACTIONDATE", None, None),
        "Payment": (None, "PAYMENTID", None, "TENDERAMOUNT", "NEGTNDRFLG"),
        "TransactionCoupon": ("TRANSACTIONID", None, "TRANSACTIONDATE", "CPONBARCOD", "CPONAMT"),
        "LoyaltyAccountEarning": ("TRANSACTIONID", "LREASNCODE", "TRANSACTIONDATE", "CUSTCARDNUMBER", "ENDDATETIMESTAMP"),
        "GiftCardTransaction": ("TRANSACTIONID", "TRANSACTIONLINEITEMID", "BUSINESSDAYDATE", "GCRDNUM", "GIFTCARDTYPE"),
        "ETopupEVoucher": ("TRANSACTIONID", "TRANSACTIONLINEITEMID", "TRANSACTIONDATE", "CARDNUM", "TOPUPAMT"),
        "TransactionCreditClaim": ("TRANSACTIONID", "CREDITCLAIMNO", "BUSINESSDAYDATE", "ITEMID", "UNITPRICE"),
    }
    outs = []
    for name, cols in shown.items():
        df = tables[name]
        if name == "TransactionLineItem":
            orphans = df.where("TRANSACTIONID is null").agg(F.when(F.count(F.lit(1)) > 0, "seen").otherwise("none").alias("code"))
            outs.append(orphans.select(F.lit("orphans").alias("model"), "code"))
            df = df.where("TRANSACTIONID is not null")
        outs.append(df.select(F.lit(name).alias("model"), *[(F.col(c) if c else F.lit(None).cast("string")).alias(n) for n, c in zip(("id", "sub_id", "day", "code", "detail"), cols)]))
    return S.union_padded(*outs)


# ---- XML feeds

ORDER_MAP = [("o_orderkey", "OrderId"), ("id", "CustomerId"), ("status", "Status"), ("", "Currency"), ("priority", "Priority"), ("line", "Line"), ("part", "Product"), ("qty", "Quantity"), ("discount", "Discount")]


@query("feed_orders_xml", """
select shape, cast(o_orderkey as varchar) as OrderId, cast(o_custkey as varchar) as CustomerId, o_orderstatus as Status, cast(null as varchar) as Currency, o_orderpriority as Priority, line as Line, part as Product, qty as Quantity, cast(null as varchar) as Discount, 'web' as SourceSystem
from (select 'many' as shape, o.*, cast(l_linenumber as varchar) as line, cast(l_partkey as varchar) as part, cast(cast(l_quantity as decimal(18,2)) as varchar) as qty from orders o left join lineitem on l_orderkey = o_orderkey
 union all select 'one', o.*, '1', cast(o_custkey as varchar), '1.00' from orders o)""")
def feed_orders_xml(t: Tables):
    """Order XML to one conformed all-text table, whether a file holds one item per order or many."""
    from lakeops.plans.cleaning import nested_orders, order_heads
    head = "o_orderkey string, customer struct<id: string, status: string>, meta struct<priority: string>, lines "
    item = "struct<line: string, part: string, qty: string>"
    many = nested_orders(t)
    # One row per order as well: its only item does not come from the lines.
    one = order_heads(t).withColumn("lines", F.struct(F.lit("1").alias("line"), F.col("customer.id").alias("part"), F.lit("1.00").alias("qty")))
    outs = []
    for shape, df, kind in (("many", many, f"array<{item}>"), ("one", one, item)):
        docs = R.scan_xml_rows(t.spark, write_xml(df, t, "web_order", "web_orders"), row_tag="web_order", schema=head + kind)
        flat = N.flatten_structs(N.struct_or_array(docs, "lines"), ["customer", "meta"])
        table = C.constant_columns(C.conform_columns(N.explode_outer_rows(flat, "lines"), ORDER_MAP), {"SourceSystem": "web"})
        out = O.write_run_folder(table, fresh_path(t.spark, "orders_xml"), run_date="20010801", run_time="101500")
        outs.append(out.select(F.lit(shape).alias("shape"), "*"))
    return S.union_all_rows(*outs)


@query("feed_site_xml", """
select cast(s_suppkey as varchar) as SiteId, s_name as Name, p.part as PPart_Code, p.qty as PPart_Qty, n_name as PNation_Name, cast(null as varchar) as PFax_Number from supplier left join nation on case when n_nationkey >= 6 then n_nationkey end = s_nationkey
left join (select case when l_suppkey % 9 <> 0 then l_suppkey end as l_suppkey, cast(l_partkey as varchar) as part, cast(sum(cast(l_quantity as decimal(18,2))) as varchar) as qty from lineitem group by l_suppkey, l_partkey) p on p.l_suppkey = s_suppkey""")
def feed_site_xml(t: Tables):
    """Site XML with optional repeating groups, flattened with a prefix per group; absent groups give nulls."""
    per = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(money("l_quantity")).cast("decimal(28,2)").alias("qty"))
    parts = N.array_from_rows(per, keys=["l_suppkey"], fields={"l_partkey": "Code", "qty": "Qty"}, name="Part")
    sites = t.supplier.join(parts, F.when(F.col("l_suppkey") % 9 != 0, F.col("l_suppkey")) == F.col("s_suppkey"), "left").join(t.nation, F.when(F.col("n_nationkey") >= 6, F.col("n_nationkey")) == F.col("s_nationkey"), "left")
    docs = sites.select(F.col("s_suppkey").alias("SiteId"), F.col("s_name").alias("Name"), F.struct("Part").alias("Parts"),
                        F.when(F.col("n_name").isNotNull(), F.struct(F.col("n_name").alias("Name"))).alias("Nation"))
    schema = "SiteId string, Name string, Parts struct<Part: array<struct<Code: string, Qty: string>>>, Nation struct<Name: string>"
    read = R.scan_xml_rows(t.spark, write_xml(docs, t, "Site", "Sites"), row_tag="Site", schema=schema)
    flat = N.flatten_optional_groups(read, [("Parts.Part", "PPart_"), ("Faxes.Fax", "PFax_"), ("Nation", "PNation_")])
    wanted = ["SiteId", "Name", "PPart_Code", "PPart_Qty", "PNation_Name", "PFax_Number"]
    return C.conform_columns(flat, [(c, c) for c in wanted])


@query("feed_case_xml", """
select cast(o_orderkey as varchar) as CaseNumber, o_orderstatus as Status, cast(case when o_orderkey % 3 = 0 then o_custkey else o_custkey + 1000000 end as varchar) as Contact_Number, o_orderpriority as Review_Date, cast(null as varchar) as Related_CaseNumber from orders""")
def feed_case_xml(t: Tables):
    """Case XML with a namespace prefix on every name, and a contact that is nested or flat."""
    k = F.col("o_orderkey")
    tag = lambda name, v: F.concat(F.lit(f"<hr:{name}>"), v.cast("string"), F.lit(f"</hr:{name}>"))
    contact = F.when(k % 3 == 0, tag("Contact", tag("Number", F.col("o_custkey")))).otherwise(tag("Contact_Number", F.col("o_custkey") + 1000000))
    row = F.concat(tag("CaseNumber", k), tag("Status", F.col("o_orderstatus")), tag("Review_Date", F.col("o_orderpriority")), contact)
    path = fresh_path(t.spark, "cases")
    framed(t.orders.select(tag("result", row).alias("value")), '<hr:results xmlns:hr="urn:cases">', "</hr:results>").write.text(path)
    schema = "`hr:CaseNumber` string, `hr:Status` string, `hr:Review_Date` string, `hr:Contact` struct<`hr:Number`: string>, `hr:Contact_Number` string"
    read = C.strip_name_prefix(R.scan_xml_rows(t.spark, path, row_tag="hr:result", schema=schema), "hr:")
    inner = read.schema["Contact"].dataType
    contact = F.when(F.col("Contact").isNotNull(), F.struct(*[F.col("Contact")[n].alias(n.removeprefix("hr:")) for n in inner.names]))
    read = read.withColumn("Contact", contact)
    picked = read.select("CaseNumber", "Status", "Review_Date", N.pick_nested_or_flat(read, "Contact", "Number"), N.pick_nested_or_flat(read, "Related", "CaseNumber"))
    return C.cast_all_string(C.select_column_order(picked, ["CaseNumber", "Status", "Contact_Number", "Review_Date", "Related_CaseNumber"]))


# ---- delimited, change-event and merge feeds

@query("feed_delimited", """
select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment, '202401' || lpad(cast(c_nationkey + 1 as varchar), 2, '0') as Source_Sent_Date, '1015' || lpad(cast(c_nationkey as varchar), 2, '0') as Source_Sent_Time, (select count(*) from customer) as rows_in_run from customer""")
def feed_delimited(t: Tables):
    """A delimited feed: files, lineage columns from their names, run folder, and counts of both sides."""
    source = R.filename_columns(R.scan_delimited(t.spark, named_feed(t), schema=FEED), parts={3: "Source_Sent_Date", 4: "Source_Sent_Time"})
    out = O.write_run_folder(source, fresh_path(t.spark, "delimited"), run_date="20010801", run_time="101500")
    counts = L.feed_counts_row(source, out, names=("customers", "run"))
    agreed = counts.where("source_count = destination_count").select("destination_count")
    return out.withColumn("rows_in_run", agreed.scalar())


@query("feed_change_events", f"""
with {ENV_SQL} select event_type as entity, extraction_time, cast(sum(case when message_operation = 'DELETE' then 1 else 0 end) as bigint) as deletes, count(*) as unique_rows, count(distinct user_id) as users from env group by 1, 2""")
def feed_change_events(t: Tables):
    """Change events drained from files, one folder per entity and batch, then summed up."""
    src, out = fresh_path(t.spark, "events_in"), fresh_path(t.spark, "events_out")
    # Copies of a message stay in one file and so in one batch, where they are removed.
    envelopes(t).repartition("body").write.parquet(src)
    sdf = X.stream_file_source(t.spark, src, schema="body binary", fmt="parquet", max_files=2)
    X.stream_for_each_batch(sdf, X.land_entities({name: ENTITIES[name] for name in SENT}, out), checkpoint=fresh_path(t.spark, "events_state")).awaitTermination()
    frames = [landed_entity(t, out, name).select(F.lit(name).alias("entity"), "user_id", "message_operation", "extraction_time") for name in SENT]
    rows = S.union_all_rows(*frames)
    return A.agg_two_level(rows, ["entity", "extraction_time"], ["user_id"], inner_aggs=[F.sum(F.expr("if(message_operation = 'DELETE', 1, 0)")).alias("d"), F.count(F.lit(1)).alias("n")],
                           outer_aggs=[F.sum("d").alias("deletes"), F.sum("n").alias("unique_rows"), F.count(F.lit(1)).alias("users")])


@query("feed_merge", "select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, '\"' || o_orderpriority || '\", ok' as note from orders")
def feed_merge(t: Tables):
    """Many small files of one table merged into few quoted files."""
    df = t.orders.select("o_orderkey", "o_orderstatus", F.concat(F.lit('"'), "o_orderpriority", F.lit('", ok')).alias("note"))
    src = fresh_path(t.spark, "merge_in")
    df.repartition("o_orderkey").write.csv(src, header=True, sep="|", quoteAll=True)
    return O.compact_small_files(t.spark, src, fresh_path(t.spark, "merged"), target_bytes=256 * 1024, schema=R.text_schema(["o_orderkey", "o_orderstatus", "note"]))
