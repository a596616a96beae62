"""Recipes: steps over named views, written as plain dictionaries, in list order or by what they depend on.

Each step has a ``card_type`` and names its input and output views. Spark
evaluates lazily, so the list only builds plans; writes and counts run them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions import exprs as E
from lakeops.operators import aggs as A
from lakeops.operators import clean as C
from lakeops.operators import joins as J
from lakeops.operators import loads as D
from lakeops.operators import quality as Q
from lakeops.operators import sets as S
from lakeops.operators import windows as W
from lakeops.plans import recipe_order as R_ORDER
from lakeops.session import materialise
from lakeops.sources import files as R
from lakeops.sources import layout as L
from lakeops.sources import sinks as O


@dataclass
class Run:
    """Views by name, and the rows written and counted so far."""

    spark: SparkSession
    frames: dict[str, DataFrame] = field(default_factory=dict)
    summary: list[tuple[str, str, int]] = field(default_factory=list)
    extra_filter: str | None = None
    ledger: R_ORDER.Ledger | None = None

    def put(self, name: str, df: DataFrame) -> None:
        self.frames[name] = df
        df.createOrReplaceTempView(name)

    def get(self, name: str) -> DataFrame:
        return self.frames[name] if name in self.frames else self.spark.table(name)

    def count(self, label: str, kind: str, df: DataFrame) -> None:
        self.summary.append((label, kind, df.count()))


Step = Callable[[Run, Mapping], None]
STEPS: dict[str, Step] = {}


def step(*names: str):
    def register(fn: Step) -> Step:
        for n in names:
            STEPS[n] = fn
        return fn
    return register


def _list(value: str | Sequence[str] | None) -> list[str]:
    if not value:
        return []
    return [v.strip() for v in value.split(",")] if isinstance(value, str) else list(value)


def _ordered(df: DataFrame, first: str, given: Sequence[str] = ()) -> list[str]:
    """An order made total: the given columns, then all others that can be sorted."""
    plain = [f.name for f in df.schema if not f.dataType.simpleString().startswith("map")]
    return list(dict.fromkeys([first, *given, *plain]))


@step("read_delta")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], run.spark.read.parquet(s["data_path"]))


@step("read_table")
def _(run: Run, s: Mapping) -> None:
    # partition_column_list is accepted; later steps shuffle as they need.
    run.put(s["temp_table_name"], run.spark.sql(s["query"]))


@step("read_dataset")
def _(run: Run, s: Mapping) -> None:
    days = s.get("extraction_logic", "*")
    if s.get("data_type", "PARQUET").upper() == "CSV":
        path = s["data_path"] if days == "*" else [f"{s['data_path']}/{d}" for d in days]
        sep = (s.get("extra_parameters") or {}).get("seperator", ",")
        run.put(s["table_name"], R.scan_csv_header_glob(run.spark, path, schema=s.get("schema"), sep=sep))
    else:
        run.put(s["table_name"], R.scan_parquet_partitions(run.spark, s["data_path"], days=days, schema=s["schema"]))


@step("write_delta", "write_dataset")
def _(run: Run, s: Mapping) -> None:
    label, mark = s.get("label", s["data_path"]), s.get("_fingerprint")
    if mark and mark in run.ledger.rows:
        run.summary.append((label, "written", run.ledger.rows[mark]))
        return
    df, keys = run.spark.sql(s["query"]), _list(s.get("partition_key_columns"))
    if s.get("layout_columns"):
        df = L.by_layout(df, _list(s["layout_columns"]))
    default = "overwrite" if s["card_type"] == "write_delta" else "append"
    if s.get("mode", default) == "overwrite":
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*keys) if keys else writer).parquet(s["data_path"])
        out = run.spark.read.schema(df.schema).parquet(s["data_path"])
    elif mark:
        out = O.append_once(df, s["data_path"], keys=keys, staged=run.ledger.staged(mark), tag=mark[:16])
    else:
        out = O.write_partitioned_append(df, s["data_path"], keys=keys) if keys else O.append_to_table(df, s["data_path"])
    # The written files are counted, not the plan a second time.
    run.count(label, "written", out)
    if mark:
        run.ledger.record(mark, label, run.summary[-1][2])


@step("delete_delta")
def _(run: Run, s: Mapping) -> None:
    O.delete_where_from(run.spark, s["data_path"], key=s["partition_key"], where=s["query"])


@step("clean_delta")
def _(run: Run, s: Mapping) -> None:
    O.retain_recent(run.spark, s["data_path"], key=s["partition_key"], cutoff=s["cutoff"])


@step("apply_sparksql_2_tmp")
def _(run: Run, s: Mapping) -> None:
    run.put(s["table_name"], materialise(run.spark.sql(s["query"]), name="step"))


@step("apply_sparksql_4m_tmp")
def _(run: Run, s: Mapping) -> None:
    run.put(s["table_name"], run.spark.sql(s["query"]))


@step("apply_filter")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], C.filter_predicates(run.get(s["input_table"]), s["filter"], extra=run.extra_filter))


@step("apply_dedupe")
def _(run: Run, s: Mapping) -> None:
    df = run.get(s["input_table"])
    run.put(s["output_table"], A.dedupe_by(df, _list(s["columns"]), _list(s.get("dedupe_by")), descending=s.get("descending", False)))


@step("apply_join")
def _(run: Run, s: Mapping) -> None:
    # partition_left_col and partition_right_col are accepted; a shuffle by them would keep Spark from splitting a hot key.
    run.put(s["temp_table_name"], J.join_apply(
        run.get(s["left_table_name"]), run.get(s["right_table_name"]), on_sql=s["on_sql_condition"], how=s["join_type"],
        select_sql=s["select_sql"] if isinstance(s["select_sql"], (list, tuple)) else [s["select_sql"]]))


@step("apply_group_by")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], A.agg_recipe(run.get(s["input_table"]), _list(s["group_by_columns"]), s["aggregate_conditions"]))


@step("apply_union")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], S.union_recipe(*[run.get(n) for n in _list(s["input_tables"])]))


@step("apply_intersect")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], S.intersect_recipe(*[run.get(n) for n in _list(s["input_tables"])]))


@step("apply_difference")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], S.difference_recipe(run.get(s["minuend"]), run.get(s["subtrahend"])))


@step("apply_order_by")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], S.order_by_recipe(run.get(s["input_table"]), _list(s["order_by_conditions"])))


@step("apply_pivot")
def _(run: Run, s: Mapping) -> None:
    df = run.spark.sql(s["select_sql"])
    out = A.pivot_sum(df, _list(s["group_by_columns"]), s["pivot_column"], s["values"], F.expr(s["aggregate_in"]))
    run.put(s["output_table"], S.order_by_recipe(out, _list(s["order_by"])) if s.get("order_by") else out)


@step("apply_standardization_rule")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], Q.rule_predefined(run.get(s["input_table"]), s["standardization_rule"]))


@step("apply_window")
def _(run: Run, s: Mapping) -> None:
    df = run.get(s["input_table"])
    func, value = re.fullmatch(r"\s*(\w+)\s*\((.*)\)\s*", s["expression"]).groups()
    ranks = func.lower() in ("rank", "dense_rank")
    order = s.get("order_column")
    by = [] if not order else [order] if ranks else _ordered(df, order)
    out = W.window_apply(df, partition=_list(s.get("partition_list")), order=by, func=func.lower(), name=s["new_column_name"],
                         value=F.expr(value) if value.strip() not in ("", "*") else None)
    run.put(s.get("output_table", s["input_table"]), out)


@step("apply_merge_count")
def _(run: Run, s: Mapping) -> None:
    new, dim, keys = run.get(s["new_data_table"]), run.get(s["dim_data_table"]), _list(s["primaryKeyColumn"])
    cols = [c for c in new.columns if c not in keys and c in dim.columns]
    counts = D.merge_count(new, dim, keys=keys, cols=cols, kind=s["merge_type"].lower())
    changed = counts.where("action <> 'keep'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    run.put(s["merge_data_table"], D.apply_merge(new, dim, {"merge": s["merge_type"].lower(), "keys": keys, "cols": cols, "as_of": s["as_of"]}))
    run.summary.append((s.get("label", s["merge_data_table"]), "changed", int(changed)))


@step("ytd_running_sum_group")
def _(run: Run, s: Mapping) -> None:
    df = run.get(s["input_table"])
    run.put(s["output_table"], W.ytd_running_sum(
        df, keys=_list(s["partition_column_list"]), order=_ordered(df, s["order_by_column"]), measure=s["calculation_column_name"],
        name=s["ytd_column_name"], fmt=s.get("order_by_column_format", "yyyy-MM-dd")))


@step("impute_null_rows_group")
def _(run: Run, s: Mapping) -> None:
    df = run.get(s["input_table"]).withColumn(s["ytd_column_name"], F.col(s["calculation_column_name"]))
    order = [c for c in _ordered(df, s["order_by_column"]) if c != s["ytd_column_name"]]
    run.put(s["output_table"], W.fill_forward_group(
        df, s["ytd_column_name"], keys=_list(s["partition_column_list"]), order=order, fmt=s.get("order_by_column_format", "yyyy-MM-dd")))


@step("in_out_running_count")
def _(run: Run, s: Mapping) -> None:
    df = run.get(s["input_table"])
    run.put(s["output_table"], W.in_out_running_count(
        df, order=_ordered(df, s["order_by_column"]), value=s["value_column"], in_name=s["column_name_in_count"],
        out_name=s["column_name_out_count"], fmt=s.get("order_by_column_format", "yyyy-MM-dd")))


@step("table_lookup")
def _(run: Run, s: Mapping) -> None:
    cache, key = run.get(s["cache_table"]), s["commom_lookup_name"]
    value = next(c for c in cache.columns if c != key)
    out = J.lookup_map(run.get(s["source_table"]), cache, key=key, value=value, name=s["output_column_name"])
    run.put(s.get("output_table", s["source_table"]), out)


@step("upsert_table")
def _(run: Run, s: Mapping) -> None:
    run.put(s["output_table"], D.upsert_by_keys(run.spark.sql(s["query"]), run.get(s["target_table"]), keys=_list(s["key_columns"])))


def run_recipe(spark: SparkSession, steps: Sequence[Mapping], frames: Mapping[str, DataFrame], *, filter_condition: str | None = None,
               by_dependency: bool = False, at_once: int = 4, ledger: str | None = None, versions: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Run the steps and return all views plus ``run_summary`` (step, kind, rows).

    Steps run in list order or, ``by_dependency``, level by level: a step runs
    after those that make what it reads, and up to ``at_once`` steps of one
    level run as concurrent jobs. An unknown step or a failing one raises;
    nothing is swallowed. The view names last as long as the recipe runs.

    With a ``ledger`` folder, a write that an earlier run of the same steps on
    the same inputs has finished is not repeated. Inputs go by their files, or
    by ``versions`` where given. Appends are staged and their files moved under
    names of the step, so a run that dies while moving adds no row twice.
    """
    run = Run(spark, extra_filter=filter_condition or None)
    plan = R_ORDER.levels(steps, _views(spark, steps, frames)) if by_dependency else [[k] for k in range(len(steps))]
    todo = [{**s, "card_type": s.get("card_type", "").lower()} for s in steps]
    for s in todo:
        if s["card_type"] not in STEPS:
            raise ValueError(f"unknown card_type {s['card_type']!r}")
    if ledger:
        run.ledger = R_ORDER.Ledger(spark, ledger)
        known = {n: (versions or {}).get(n) or R_ORDER.version_of(df) for n, df in frames.items()}
        marks = R_ORDER.fingerprints(steps, {**dict.fromkeys(_views(spark, steps, frames), ""), **known, "": json.dumps(filter_condition)})
        todo = [{**s, "_fingerprint": m} for s, m in zip(todo, marks)]
    try:
        for name, df in frames.items():
            run.put(name, df)
        with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
            for level in plan:
                if len(level) == 1:
                    STEPS[todo[level[0]]["card_type"]](run, todo[level[0]])
                    continue
                jobs = [pool.submit(inheritable_thread_target(spark)(STEPS[todo[k]["card_type"]]), run, todo[k]) for k in level]
                # All steps of a level end before the first error is raised.
                for failed in [j.exception() for j in jobs]:
                    if failed is not None:
                        raise failed
    finally:
        # The frames are resolved; their view names are free for the next recipe.
        for name in run.frames:
            spark.catalog.dropTempView(name)
    if by_dependency:
        run.summary.sort()
    run.frames["run_summary"] = spark.createDataFrame(run.summary, "step string, kind string, row_count bigint")
    return run.frames


def _views(spark: SparkSession, steps: Sequence[Mapping], frames: Mapping[str, DataFrame]) -> set[str]:
    """Views that exist before the recipe runs: the frames given, and the catalog's tables among those that steps read."""
    asked = set().union(*[set(_list(s.get(k))) for s in steps for k in R_ORDER.READS]) if steps else set()
    return set(frames) | {n for n in asked if n not in frames and spark.catalog.tableExists(n)}


def read_source(spark: SparkSession, source: Mapping) -> DataFrame:
    """The feed that a recipe names: ``{data_type, path or paths, schema?, options?}``."""
    return R.scan_by_type(spark, source.get("paths") or source["path"], kind=source.get("data_type", "CSV"), schema=source.get("schema"), options=source.get("options"))


def run_cleanse(df: DataFrame | None, config: Mapping, spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """Cleanse one feed by a recipe and return its outputs.

    In order: the reader (``data_source``, where no frame is given), predefined,
    expression and complex rules, row checks, enforced tests, split and
    quarantine, report, filters, row key, constants and run stamp, derived
    columns, renames and column order, custom functions, destinations. The
    checked frame is stored once and feeds every count and every output.

    ``data_quality.enforced_tests`` are SQL conditions on the counts
    (total_rows, good_rows, bad_rows). If one does not hold, the feed as it
    was read goes to quarantine, and the result and the destinations stay empty.
    """
    df = read_source(spark, config["data_source"]) if df is None else df
    raw = df
    engine = config.get("rules_engine", {})
    df = Q.rule_predefined(df, engine.get("predefined", {}))
    df = Q.rule_expression(df, engine.get("expression", []))
    df = Q.rule_complex(df, engine.get("complex", []))
    checks = config.get("data_quality", {}).get("row_based_rules", {"enforce": False, "rules": []})
    df = Q.dq_error_text(Q.dq_final_flag(Q.dq_row_rules(df, checks["rules"])))
    stored = materialise(df, name="cleansed")
    good, bad = Q.dq_split(stored, enforce=checks["enforce"], store=False)
    outputs = {"counts": Q.dq_counts(stored), "bad_rows": bad}
    if checks["rules"]:
        outputs["report"] = Q.dq_rule_report(stored, checks["rules"])
        outputs["dimensions"] = Q.dq_dimensions(outputs["report"])
    tests = config.get("data_quality", {}).get("enforced_tests", [])
    failed = bool(tests) and not outputs["counts"].select(F.coalesce(F.expr(" and ".join(f"({x})" for x in tests)), F.lit(False))).first()[0]
    if failed:
        good = good.limit(0)
        if config.get("quarantine_path"):
            outputs["quarantined_feed"] = O.quarantine_bad_rows(raw, f"{config['quarantine_path']}/feed", run=str(config["run"]))
    elif config.get("quarantine_path"):
        outputs["bad_rows"] = O.quarantine_bad_rows(bad, config["quarantine_path"], run=str(config["run"]))
    out = Q.drop_helper_columns(good)
    out = C.drop_empty_rows(out) if config.get("drop_empty", True) else out
    out = C.filter_predicates(out, config.get("filters", []))
    key = config.get("generate_key")
    out = E.row_identity(out, key["columns"], name=key["column_name"]) if key else out
    out = C.constant_columns(out, config.get("constants", {}))
    out = C.record_timestamp(out, run=config["run"]) if config.get("run") else out
    out = C.derived_case_columns(out, config.get("derived", []))
    out = C.rename_mapping(out, config.get("rename", {}))
    out = C.select_column_order(out, config["columns"]) if config.get("columns") else out
    out = C.custom_rule_hook(out, config.get("custom", []))
    outputs["result"] = out
    if config.get("data_destination") and not failed:
        outputs |= O.fan_out_destinations(out, config["data_destination"])
    return outputs
