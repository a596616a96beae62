"""The order of a recipe's steps from what they read and write, and a ledger of finished writes."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Fields of a step that name views it reads, views it makes, and steps that change a path.
READS = ("input_table", "input_tables", "left_table_name", "right_table_name", "minuend", "subtrahend", "new_data_table", "dim_data_table", "source_table", "cache_table", "target_table")
MAKES = ("output_table", "temp_table_name", "table_name", "merge_data_table")
PATH_READERS = ("read_delta", "read_dataset")
PATH_WRITERS = ("write_delta", "write_dataset")
PATH_CHANGERS = ("delete_delta", "clean_delta")

_LITERAL = re.compile(r"'(?:[^'\\]|\\.)*'|--[^\n]*|/\*.*?\*/", re.S)
_SOURCE = re.compile(r"(?:\bfrom|\bjoin|,)\s+`?([A-Za-z_]\w*)`?", re.I)


class RecipeError(ValueError):
    """Steps that cannot be put in order."""


@dataclass
class Links:
    """Per step: a name for messages, the views it reads and makes, and the steps it waits for."""

    name: str
    kind: str
    reads: set[str]
    asked: set[str]
    makes: set[str]
    waits: set[int] = field(default_factory=set)


def _names(value: str | Sequence[str] | None) -> set[str]:
    if not value:
        return set()
    return {v.strip() for v in (value.split(",") if isinstance(value, str) else value)}


def _links(number: int, step: Mapping) -> Links:
    kind = step.get("card_type", "").lower()
    name = str(step.get("card_id") or step.get("label") or f"step {number + 1} ({kind})")
    reads = set().union(*[_names(step.get(k)) for k in READS])
    makes = set().union(*[_names(step.get(k)) for k in MAKES])
    if kind == "table_lookup" and not step.get("output_table"):
        raise RecipeError(f"{name}: a look-up needs an output_table to be put in order")
    asked = set(_SOURCE.findall(_LITERAL.sub(" ", step.get("query", "")))) if kind != "delete_delta" else set()
    return Links(name, kind, reads, asked, makes)


def dependencies(steps: Sequence[Mapping], given: Iterable[str]) -> list[Links]:
    """What each step waits for: the makers of the views it reads, the writers of the paths it reads, and ``depends_on``.

    Views in SQL texts are those named after FROM, JOIN or a comma that some
    step makes. A reader of a path waits for its writer and for the steps that
    delete from it; these follow the writer in list order.
    """
    links = [_links(k, s) for k, s in enumerate(steps)]
    maker: dict[str, int] = {}
    for k, link in enumerate(links):
        for view in link.makes:
            if view in maker:
                raise RecipeError(f"view {view!r} is made by {links[maker[view]].name} and by {link.name}")
            maker[view] = k
    named = {link.name: k for k, link in enumerate(links)}
    known = set(given)
    for k, (link, step) in enumerate(zip(links, steps)):
        for view in link.reads:
            if view in maker:
                link.waits.add(maker[view])
            elif view not in known:
                raise RecipeError(f"{link.name} reads {view!r}, which no step makes")
        link.waits |= {maker[v] for v in link.asked if v in maker}
        for other in _names(step.get("depends_on")):
            if other not in named:
                raise RecipeError(f"{link.name} depends on {other!r}, which is no step")
            link.waits.add(named[other])
    by_path: dict[str, list[int]] = {}
    for k, step in enumerate(steps):
        if "data_path" in step:
            by_path.setdefault(str(step["data_path"]).rstrip("/"), []).append(k)
    for touching in by_path.values():
        writers, changers, readers = ([k for k in touching if links[k].kind in kinds] for kinds in (PATH_WRITERS, PATH_CHANGERS, PATH_READERS))
        chain = [*writers, *changers]
        for before, after in zip(chain, chain[1:]):
            links[after].waits.add(before)
        for k in readers:
            links[k].waits |= set(chain[-1:])
    return links


def levels(steps: Sequence[Mapping], given: Iterable[str] = ()) -> list[list[int]]:
    """Numbers of the steps, level by level: a step waits for earlier levels only. A cycle names its steps."""
    links = dependencies(steps, given)
    done: set[int] = set()
    out: list[list[int]] = []
    while len(done) < len(links):
        ready = [k for k, link in enumerate(links) if k not in done and link.waits <= done]
        if not ready:
            raise RecipeError("cycle of steps: " + ", ".join(sorted(_cycle(links, done))))
        out.append(ready)
        done |= set(ready)
    return out


def _cycle(links: Sequence[Links], done: set[int]) -> list[str]:
    """Names of the steps of one cycle: follow any unfinished step that is waited for until one repeats."""
    at, seen = next(k for k in range(len(links)) if k not in done), []
    while at not in seen:
        seen.append(at)
        at = min(links[at].waits - done)
    return [links[k].name for k in seen[seen.index(at) :]]


def fingerprints(steps: Sequence[Mapping], given: Mapping[str, str]) -> list[str]:
    """A text per step that changes with the step, with any step it waits for, and with the versions of the ``given`` views it reads."""
    links = dependencies(steps, given)
    out: dict[int, str] = {}
    for level in levels(steps, given):
        for k in level:
            used = sorted(given[v] for v in (links[k].reads | links[k].asked) if v in given)
            body = json.dumps([{x: y for x, y in steps[k].items()}, used, sorted(out[w] for w in links[k].waits)], sort_keys=True, default=str)
            out[k] = hashlib.sha256(body.encode()).hexdigest()
    return [out[k] for k in range(len(steps))]


def version_of(df: DataFrame) -> str:
    """A version of a frame from its files and schema; frames without files go by their schema alone, so give such ones a version by hand."""
    return hashlib.sha256("\n".join([*sorted(df.inputFiles()), df.schema.json()]).encode()).hexdigest()


class Ledger:
    """Finished writes of a recipe as a small Parquet table (``fingerprint``, ``step``, ``rows``) below ``path``."""

    SCHEMA = "fingerprint string, step string, rows bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/done")
        there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
        # One row per finished write of a recipe, so as many as it has steps and runs.
        rows = spark.read.schema(self.SCHEMA).parquet(f"{self.path}/done").toLocalIterator() if there else []
        self.rows = {r["fingerprint"]: r["rows"] for r in rows}

    def staged(self, fingerprint: str) -> str:
        """Where rows of an append wait before their files are moved to the table."""
        return f"{self.path}/staged/{fingerprint}"

    def record(self, fingerprint: str, step: str, rows: int) -> None:
        self.spark.createDataFrame([(fingerprint, step, rows)], self.SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/done")
        self.rows[fingerprint] = rows
