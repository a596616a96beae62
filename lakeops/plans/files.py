"""Round trips through files: each query writes the driver tables as a feed and reads them back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import nested as N
from lakeops.operators import sets as S
from lakeops.plans.cleaning import nested_orders
from lakeops.plans.relational import money
from lakeops.registry import Tables, query
from lakeops.session import fresh_path, materialise
from lakeops.sources import files as R
from lakeops.sources import json_split
from lakeops.sources import sinks as W
from lakeops.sources.layout import by_layout

CUST = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
CUST_TEXT = "cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment"
FEED = R.text_schema([" c_custkey", "c_name", "c_nationkey ", "c_mktsegment"])


def lines_of(df: DataFrame, sep: str = "|") -> DataFrame:
    """Rows as delimited text."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value"))


def framed(lines: DataFrame, head: str | None, tail: str | None) -> DataFrame:
    """Each partition, and so each file written from it, with a first and a last line."""

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All batches of one kind: one with nulls allowed, as the first and last line are.
        batch = lambda value: pa.RecordBatch.from_arrays([value.cast(pa.string())], names=["value"])
        if head is not None:
            yield batch(pa.array([head]))
        yield from (batch(b.column(0)) for b in batches)
        if tail is not None:
            yield batch(pa.array([tail]))

    return lines.mapInArrow(frame, "value string")


def write_feed(t: Tables, df: DataFrame, *, head: str | None, tail: str | None) -> str:
    """A feed of several text files with header and trailer lines."""
    path = fresh_path(t.spark, "feed")
    framed(lines_of(df.repartition(df.columns[0])), head, tail).write.text(path)
    return path


def rename_parts(t: Tables, base: str, name_of) -> str:
    """Give the data files below ``base`` feed names, ``name_of(partition values, n)``, in one flat folder."""
    jvm = t.spark._jvm
    conf = t.spark._jsc.hadoopConfiguration()
    dest = fresh_path(t.spark, "named")
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(dest))
    found, n = fs.listFiles(jvm.org.apache.hadoop.fs.Path(base), True), 0
    while found.hasNext():
        path = found.next().getPath()
        if not path.getName().startswith("part-"):
            continue
        values = dict(p.split("=", 1) for p in path.toString().split("/") if "=" in p)
        fs.rename(path, jvm.org.apache.hadoop.fs.Path(f"{dest}/{name_of(values, n)}"))
        n += 1
    return dest


def rename_folders(t: Tables, base: str, prefix: str) -> None:
    """``<prefix>=<value>`` folders as plain ``<value>`` run folders."""
    jvm, conf = t.spark._jvm, t.spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(conf)
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith(f"{prefix}="):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(f"{base}/{name.split('=', 1)[1]}"))


# ---- sources

@query("scan_delimited", f"select {CUST_TEXT} from customer")
def _(t: Tables):
    path = write_feed(t, t.customer.select(*CUST), head=None, tail=None)
    return R.scan_delimited(t.spark, path, schema=FEED)


@query("drop_header_trailer", f"select 'both' as kind, {CUST_TEXT} from customer union all select 'header', {CUST_TEXT} from customer")
def _(t: Tables):
    both = write_feed(t, t.customer.select(*CUST), head="H|customers", tail="T|end|9")
    header = write_feed(t, t.customer.select(*CUST), head="c_custkey|c_name|c_nationkey|c_mktsegment", tail=None)
    return S.union_all_rows(
        R.drop_header_trailer(t.spark, both, schema=FEED, header=True, trailer=True).select(F.lit("both").alias("kind"), "*"),
        R.drop_header_trailer(t.spark, header, schema=FEED, header=True).select(F.lit("header").alias("kind"), "*"))


def named_feed(t: Tables) -> str:
    """Customers in files named CUST_UK_<nation>_<yyyyMMdd>_<HHmmss>_<n>.psv, one or more per nation."""
    base = fresh_path(t.spark, "by_nation")
    c = t.customer.select(*CUST)
    lines_of(c).withColumn("value", F.col("value")).select("value", F.element_at(F.split("value", r"\|"), 3).alias("n")).write.partitionBy("n").text(base)
    return rename_parts(t, base, lambda v, i: f"CUST_UK_{v['n']}_202401{int(v['n']) + 1:02d}_1015{int(v['n']):02d}_{i}.psv")


@query("filename_columns", f"""
select {CUST_TEXT}, cast(c_nationkey as varchar) as feed_no, '202401' || lpad(cast(c_nationkey + 1 as varchar), 2, '0') as sent_date, '1015' || lpad(cast(c_nationkey as varchar), 2, '0') as sent_time, cast(null as varchar) as beyond from customer""")
def _(t: Tables):
    df = R.scan_delimited(t.spark, named_feed(t), schema=FEED)
    return R.filename_columns(df, parts={2: "feed_no", 3: "sent_date", 4: "sent_time", 9: "beyond"})


@query("filename_timestamp", "select cast(c_custkey as varchar) as c_custkey, '2024-01-' || lpad(cast(c_nationkey + 1 as varchar), 2, '0') || ' 10:15:' || lpad(cast(c_nationkey as varchar), 2, '0') as creation_timestamp from customer")
def _(t: Tables):
    df = R.scan_delimited(t.spark, named_feed(t), schema=FEED)
    return R.filename_timestamp(df, date_part=3, time_part=4, name="creation_timestamp").select("c_custkey", "creation_timestamp")


@query("scan_csv_header_glob", f"select cast(c_custkey as varchar) as c_custkey, 'Café £€ ' || c_name as label from customer")
def _(t: Tables):
    path = fresh_path(t.spark, "accents")
    # Code 0x80 is the euro sign of windows-1252.
    t.customer.select("c_custkey", F.concat(F.lit("Café £\x80 "), "c_name").alias("label")).write.csv(path, header=True, encoding="ISO-8859-1")
    return R.scan_csv_header_glob(t.spark, f"{path}/part-*", encoding="windows-1252")


@query("scan_csv_infer", "select cast(o_orderkey as int) as o_orderkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as day from orders")
def _(t: Tables):
    path = fresh_path(t.spark, "infer")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))
    o.repartition("o_orderkey").write.csv(path, header=True, sep="|")
    return R.scan_csv_infer(t.spark, f"{path}/part-*.csv")


@query("scan_json_multiline", "select c_custkey, c_name, n_name as area from customer join nation on c_nationkey = n_nationkey")
def _(t: Tables):
    path = fresh_path(t.spark, "geojson")
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", F.col("n_name").alias("area"))
    row = F.to_json(F.struct(F.struct(*c.columns).alias("properties")), {"pretty": "true"})
    # One document per file; the last, empty feature closes the list.
    framed(c.select(F.concat(row, F.lit(",")).alias("value")), '{"features": [', '{}]}').write.text(path)
    schema = "features array<struct<properties: struct<c_custkey: bigint, c_name: string, area: string>>>"
    docs = R.scan_json_multiline(t.spark, path, schema=schema)
    return N.flatten_structs(N.explode_rows(docs, "features"), ["properties"]).where("c_custkey is not null")


@query("scan_json_elements", "select c_custkey, c_name, n_name as area from customer join nation on c_nationkey = n_nationkey")
def _(t: Tables):
    """All customers as one document in one file, read by as many tasks as it has splits."""
    path = fresh_path(t.spark, "one_document")
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", F.col("n_name").alias("area"))
    row = F.to_json(F.struct(F.struct(*c.columns).alias("properties")), {"pretty": "true"})
    # The list is closed by an empty feature, which has no key. One file, as the feed comes.
    framed(c.select(F.concat(row, F.lit(",")).alias("value")).coalesce(1), '{"type": "all", "features": [', '{}]}').write.text(path)
    found = json_split.scan_json_elements(t.spark, path, field="features", schema="properties struct<c_custkey: bigint, c_name: string, area: string>")
    return found.select("properties.*").where("c_custkey is not null")


@query("parse_json_column", "select event_id, cast(json_extract(props, '$.k') as int) as k, cast(null as varchar) as bad from events")
def _(t: Tables):
    return R.parse_json_column(t.events.select("event_id", "props"), "props", schema="k int", corrupt_col="bad")


# Fixed value: documents in one XML file, as one task reads a whole file.
XML_FILE_ROWS = 50_000


def write_xml(df: DataFrame, t: Tables, row_tag: str, root: str) -> str:
    """A frame as XML documents."""
    path = fresh_path(t.spark, "xml")
    df.write.format("xml").option("rowTag", row_tag).option("rootTag", root).option("maxRecordsPerFile", XML_FILE_ROWS).save(path)
    return path


ORDER_XML = "o_orderkey string, customer struct<id: string, status: string>, meta struct<priority: string>, lines array<struct<line: string, part: string, qty: string>>"


@query("scan_xml_rows", """
select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as id, o_orderstatus as status, o_orderpriority as priority, cast(l_linenumber as varchar) as line, cast(l_partkey as varchar) as part,
 cast(cast(l_quantity as decimal(18,2)) as varchar) as qty from orders left join lineitem on o_orderkey = l_orderkey""")
def _(t: Tables):
    path = write_xml(nested_orders(t), t, "order", "orders")
    docs = R.scan_xml_rows(t.spark, path, row_tag="order", schema=ORDER_XML)
    return N.explode_outer_rows(N.flatten_structs(docs, ["customer", "meta"]), "lines")


@query("scan_parquet_partitions", """
select 'list' as days, o_orderkey, o_orderstatus from orders where strftime(o_orderdate, '%Y%m') in ('199901', '199907', '200003')
union all select 'all', o_orderkey, o_orderstatus from orders""")
def _(t: Tables):
    base = fresh_path(t.spark, "runs")
    o = t.orders.select("o_orderkey", "o_orderstatus", F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01000000")).alias("run"))
    o.write.partitionBy("run").parquet(base)
    rename_folders(t, base, "run")
    schema = "o_orderkey bigint, o_orderstatus string"
    some = R.scan_parquet_partitions(t.spark, base, days=["19990101", "19990701", "20000301", "21000101"], schema=schema)
    none = R.scan_parquet_partitions(t.spark, base, days=["21000101"], schema=schema)
    every = R.scan_parquet_partitions(t.spark, base, days="*", schema=schema)
    return S.union_all_rows(some.unionByName(none).select(F.lit("list").alias("days"), "*"), every.select(F.lit("all").alias("days"), "*"))


@query("scan_parquet_decimal", "select o_orderkey, cast(o_totalprice as decimal(18,4)) as price from orders")
def _(t: Tables):
    paths = []
    for kind, cond in (("decimal(12,2)", "o_orderstatus = 'F'"), ("decimal(20,6)", "o_orderstatus <> 'F'")):
        paths.append(fresh_path(t.spark, "decimals"))
        t.orders.where(cond).select("o_orderkey", F.col("o_totalprice").cast(kind).alias("price")).write.parquet(paths[-1])
    return R.scan_parquet_decimal(t.spark, paths, decimals={"price": "decimal(18,4)"})


def _three_snapshots(t: Tables) -> str:
    base = fresh_path(t.spark, "snapshots")
    for i in (1, 2, 3):
        part = t.customer.where((F.col("c_nationkey") < 8 * i) | F.lit(i == 3)).select("c_custkey", F.lit(i).alias("version"))
        part.repartition("c_custkey").write.parquet(f"{base}/v{i}")
    return base


@query("scan_latest_file", "select c_custkey, cast(3 as int) as version from customer")
def _(t: Tables):
    return R.scan_latest_file(t.spark, _three_snapshots(t), fmt="parquet", schema="c_custkey bigint, version int")


@query("scan_latest_two_files", """
select c_custkey, cast(3 as int) as version, cast(1 as int) as snapshot from customer union all select c_custkey, cast(2 as int), cast(2 as int) from customer where c_nationkey < 16""")
def _(t: Tables):
    return R.scan_latest_two_files(t.spark, _three_snapshots(t), fmt="parquet", schema="c_custkey bigint, version int")


@query("scan_table_pruned", "select l_orderkey, l_extendedprice from lineitem where l_shipdate >= timestamp '2000-01-01' and l_returnflag = 'R'")
def _(t: Tables):
    return R.scan_table_pruned(t.spark, t.path("lineitem"), cols=["l_orderkey", "l_extendedprice"], where="l_shipdate >= timestamp_ntz '2000-01-01' and l_returnflag = 'R'")


# ---- sinks

ORD_SQL = "o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as price"


def _orders(t: Tables, where: str = "true") -> DataFrame:
    return t.orders.where(where).select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("price"))


@query("write_run_folder", f"select {ORD_SQL} from orders")
def _(t: Tables):
    dest = fresh_path(t.spark, "run_folder")
    W.write_run_folder(_orders(t, "o_orderstatus = 'F'"), dest, run_date="20010801", run_time="101500")
    return W.write_run_folder(_orders(t, "o_orderstatus <> 'F'"), dest, run_date="20010801", run_time="101500")


@query("write_partitioned_append", f"select {ORD_SQL} from orders where o_orderstatus <> 'P' or o_totalprice > 100000")
def _(t: Tables):
    dest = fresh_path(t.spark, "partitioned")
    W.write_partitioned_append(_orders(t, "o_orderstatus <> 'P'"), dest, keys=["o_orderstatus"])
    return W.write_partitioned_append(_orders(t, "o_orderstatus = 'P'"), dest, keys=["o_orderstatus"], where="price > 100000")


@query("write_by_layout", "select l_orderkey, l_linenumber, l_partkey, cast(l_shipdate as date) as day from lineitem")
def _(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    return W.truncate_and_load(by_layout(lines, ["day", "l_partkey"]), fresh_path(t.spark, "laid_out"))


@query("append_to_table", f"select {ORD_SQL} from orders")
def _(t: Tables):
    dest = fresh_path(t.spark, "append")
    W.append_to_table(_orders(t, "o_orderstatus = 'F'"), dest)
    return W.append_to_table(_orders(t, "o_orderstatus <> 'F'"), dest)


@query("truncate_and_load", f"select {ORD_SQL} from orders where o_orderstatus <> 'P'")
def _(t: Tables):
    dest = fresh_path(t.spark, "truncate")
    W.truncate_and_load(_orders(t), dest)
    return W.truncate_and_load(_orders(t, "o_orderstatus <> 'P'"), dest)


@query("replace_recent_partitions", """
with e as (select event_id, cast(ts as date) as day, cast(value as decimal(18,2)) as value from events)
select * from e where day >= date '2024-01-10' and day < date '2024-01-20' union all select event_id, day, cast(value * 2 as decimal(18,2)) from e where day >= date '2024-01-20' and day < date '2024-01-28'""")
def _(t: Tables):
    dest = fresh_path(t.spark, "recent")
    e = t.events.select("event_id", money("value").alias("value"), F.to_date("ts").alias("day"))
    W.write_partitioned_append(e, dest, keys=["day"])
    again = e.where("day >= date '2024-01-20' and day < date '2024-01-28'").withColumn("value", (F.col("value") * 2).cast("decimal(18,2)"))
    from datetime import date
    return W.replace_recent_partitions(again, dest, key="day", cutoff=date(2024, 1, 20), keep_from=date(2024, 1, 10))


@query("delete_where_and_append", """
select o_orderkey, cast(strftime(o_orderdate, '%Y%m') as int) as month_key from orders where strftime(o_orderdate, '%Y%m') <> '200005' or o_orderstatus = 'F'""")
def _(t: Tables):
    dest = fresh_path(t.spark, "month")
    month = F.date_format("o_orderdate", "yyyyMM").cast("int").alias("month_key")
    o = t.orders.select("o_orderkey", month, "o_orderstatus")
    W.write_partitioned_append(o.drop("o_orderstatus"), dest, keys=["month_key"])
    return W.delete_where_and_append(o.where("month_key = 200005 and o_orderstatus = 'F'").drop("o_orderstatus"), dest, key="month_key")


@query("delete_all_rows", "select (select count(*) from orders) as rows_before, cast(0 as bigint) as rows_after, 'o_orderkey,o_orderstatus,price' as columns_after from region where r_regionkey = 0")
def _(t: Tables):
    dest = fresh_path(t.spark, "emptied")
    before = W.append_to_table(_orders(t), dest).count()
    after = W.delete_all_rows(t.spark, dest)
    return after.agg(F.lit(before).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"), F.lit(",".join(after.columns)).alias("columns_after"))


@query("materialise", "select o_custkey, count(*) as n from orders group by 1")
def _(t: Tables):
    return materialise(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")))


_OUTPUTS = {f"{s}_{p}": f"o_orderstatus = '{s}' and left(o_orderpriority, 1) = '{p}'" for s in "FO" for p in "12345"}
_OUTPUTS |= {"none": "o_totalprice < 0", "late": "o_orderdate > timestamp_ntz '2100-01-01'", "all": "true"}


@query("write_nonempty_csv", "select distinct o_orderstatus || '_' || left(o_orderpriority, 1) as output from orders where o_orderstatus <> 'P' union all select 'all' from region where r_regionkey = 0")
def _(t: Tables):
    # Thirteen outputs from one stored read of the orders.
    stored = materialise(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"))
    frames = {n: stored.where(c) for n, c in _OUTPUTS.items()}
    return W.write_nonempty_csv(frames, fresh_path(t.spark, "outputs"), run_date="20010801", run_time="101500").select("output")


@query("fan_out_destinations", """
select 'all' as target, o_orderkey, o_orderstatus, cast(count(*) over (partition by o_orderkey) as bigint) as n from orders union all select 'urgent', o_orderkey, o_orderstatus, cast(1 as bigint) from orders where o_orderpriority = '1-URGENT'
union all select 'by status', cast(-1 as bigint), o_orderstatus, count(*) from orders group by 3""")
def _(t: Tables):
    base = fresh_path(t.spark, "targets")
    src = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    out = W.fan_out_destinations(src, [
        {"path": f"{base}/all", "mode": "overwrite"},
        {"path": f"{base}/urgent", "query": "select * from {source} where o_orderpriority = '1-URGENT'", "keys": ["o_orderstatus"]},
        {"path": f"{base}/status", "query": "select o_orderstatus, count(*) as n from {source} group by o_orderstatus"}])
    one = F.lit(1).cast("bigint").alias("n")
    return S.union_all_rows(
        out[f"{base}/all"].select(F.lit("all").alias("target"), "o_orderkey", "o_orderstatus", one),
        out[f"{base}/urgent"].select(F.lit("urgent").alias("target"), "o_orderkey", "o_orderstatus", one),
        out[f"{base}/status"].select(F.lit("by status").alias("target"), F.lit(-1).cast("bigint").alias("o_orderkey"), "o_orderstatus", "n"))


LINE_SQL = "select l_orderkey, l_linenumber, l_returnflag, l_extendedprice from lineitem"
LINE = ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"]


@query("split_by_rows", LINE_SQL)
def _(t: Tables):
    return W.split_by_rows(t.lineitem.select(*LINE), fresh_path(t.spark, "rows"), rows=5000)


@query("split_by_size", LINE_SQL)
def _(t: Tables):
    return W.split_by_size(t.lineitem.select(*LINE), fresh_path(t.spark, "size"), max_bytes=256 * 1024)


@query("compact_small_files", f"select {CUST_TEXT} from customer")
def _(t: Tables):
    src = write_feed(t, t.customer.select(*CUST), head="c_custkey|c_name|c_nationkey|c_mktsegment", tail=None)
    return W.compact_small_files(t.spark, src, fresh_path(t.spark, "compact"), target_bytes=64 * 1024, schema=FEED)


@query("size_guarded_parquet", f"{LINE_SQL.replace('select', 'select cast(1 as int) as guard,', 1)} union all {LINE_SQL.replace('select', 'select cast(2 as int),', 1)}")
def _(t: Tables):
    li = t.lineitem.select(*LINE)
    under = W.size_guarded_parquet(li, fresh_path(t.spark, "guarded"))
    over = W.size_guarded_parquet(li, fresh_path(t.spark, "guarded"), max_bytes=512 * 1024)
    return S.union_all_rows(under.select(F.lit(1).alias("guard"), "*"), over.select(F.lit(2).alias("guard"), "*"))


@query("delete_where", "select o_orderkey, o_orderstatus from orders where not coalesce(o_orderstatus = 'P' and nullif(o_custkey % 4, 1) = 2, false)")
def _(t: Tables):
    dest = fresh_path(t.spark, "delete_where")
    o = t.orders.select("o_orderkey", F.nullif(F.col("o_custkey") % 4, F.lit(1)).alias("grp"), "o_orderstatus")
    W.write_partitioned_append(o, dest, keys=["o_orderstatus"])
    return W.delete_where_from(t.spark, dest, key="o_orderstatus", where="o_orderstatus = 'P' and grp = 2").select("o_orderkey", "o_orderstatus")


@query("retain_recent", "select event_id, cast(ts as date) as day from events where cast(ts as date) >= date '2024-01-15'")
def _(t: Tables):
    from datetime import date
    dest = fresh_path(t.spark, "retain")
    W.write_partitioned_append(t.events.select("event_id", F.to_date("ts").alias("day")), dest, keys=["day"])
    return W.retain_recent(t.spark, dest, key="day", cutoff=date(2024, 1, 15))


@query("frozen_baseline_union", """
select cast(year(o_orderdate) as int) as year, o_orderstatus, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as total from orders group by 1, 2""")
def _(t: Tables):
    def yearly(o):
        return o.groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.sum(money("o_totalprice")).alias("total"))
    stored = W.truncate_and_load(yearly(t.orders.where("year(o_orderdate) = 1995")), fresh_path(t.spark, "baseline"))
    # Later deliveries lost some rows of the closed year; the stored result stands in for it.
    return S.frozen_baseline_union(yearly(t.orders.where("year(o_orderdate) <> 1995 or o_orderstatus = 'F'")), stored, period_col="year", period=1995)
