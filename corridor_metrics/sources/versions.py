"""Tables that change as a whole: immutable folders, and one small file that names the current ones.

A writer puts a version of each table below ``<root>/<table>/v=<n>``, beside the older ones, and then
publishes state ``n``: a JSON file that is written under another name and renamed into
``<root>/_states``. A rename shows a file whole or not at all and never replaces one, so readers see all tables of the old
state or all of the new one, and of two writers one has to start again. Folders of a run
that failed are named by no state.

A state holds, for each table, either one version or spans of dates with the version that holds them,
the table's schema, the dates that are finished, and further values of the job.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor_metrics.functions.dates import Span, joined_spans, without_spans

STATES = "_states"
KEPT = 2


class Superseded(RuntimeError):
    """Another writer has published the state that this one was about to publish."""


def _path(spark: SparkSession, path: str):
    """File system and full path of a name."""
    raw = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = raw.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(raw)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names right below a folder, sorted; none if it does not exist. No file is opened."""
    system, path = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def remove(spark: SparkSession, folder: str) -> None:
    system, path = _path(spark, folder)
    system.delete(path, True)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[:-5]) for n in names_in(spark, f"{root}/{STATES}") if n.endswith(".json") and n[:-5].isdigit()]


def state_of(spark: SparkSession, root: str, number: int) -> dict:
    system, path = _path(spark, f"{root}/{STATES}/{number:09d}.json")
    stream = system.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, root: str) -> dict:
    """The current state; one without tables before the first is published."""
    numbers = _numbers(spark, root)
    return state_of(spark, root, max(numbers)) if numbers else {"number": 0, "tables": {}, "schemas": {}}


def publish(spark: SparkSession, root: str, state: Mapping) -> None:
    """Make a state the current one, unless its number is taken."""
    target = f"{root}/{STATES}/{state['number']:09d}.json"
    system, hidden = _path(spark, f"{root}/{STATES}/.{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), spark._jsc.hadoopConfiguration())
    keep_existing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(hidden, _path(spark, target)[1], keep_existing)
    except Py4JJavaError as e:
        system.delete(hidden, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            raise Superseded(f"state {state['number']} of {root} exists") from e
        raise


def _writer(df: DataFrame):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def publish_tables(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], **values) -> dict[str, str]:
    """Write new versions of some tables and make all of them current at once; the other tables stay. Returns their folders.

    ``values`` are kept in the state. A table may be computed from its own current version.
    """
    state = newest(spark, root)
    number = state["number"] + 1
    folders = {name: f"{root}/{name}/v={number}" for name in tables}
    for name, df in tables.items():
        _writer(df).parquet(folders[name])
    publish(spark, root, {
        **state, **values, "number": number,
        "tables": {**state["tables"], **dict.fromkeys(tables, number)},
        "schemas": {**state["schemas"], **{name: df.schema.jsonValue() for name, df in tables.items()}},
    })
    return folders


def _encoded(spans: Sequence[Span]) -> list[list[str]]:
    return [[first.isoformat(), last.isoformat()] for first, last in spans]


def _decoded(spans: Sequence[Sequence[str]]) -> list[Span]:
    return [(dt.date.fromisoformat(first), dt.date.fromisoformat(last)) for first, last in spans]


def finished(state: Mapping) -> list[Span]:
    """The dates that are finished, as spans."""
    return _decoded(state.get("finished", []))


def publish_dates(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], days: Sequence[Span], **values) -> int:
    """Write the given days of some tables, make them current and note the days as finished, all at once.

    The rows have a column ``date`` in these days. Earlier versions of the days are no longer read, also
    where a table has no rows now. Returns the number of the state.
    """
    state = newest(spark, root)
    number = state["number"] + 1
    spans = dict(state["tables"])
    for name, df in tables.items():
        _writer(df.hint("rebalance", "date")).partitionBy("date").parquet(f"{root}/{name}/v={number}")
        left = [[v, *span] for v, *old in spans.get(name, []) for span in _encoded(without_spans(_decoded([old]), days))]
        spans[name] = left + [[number, *span] for span in _encoded(days)]
    publish(spark, root, {
        **state, **values, "number": number, "tables": spans,
        "schemas": {**state["schemas"], **{name: df.schema.jsonValue() for name, df in tables.items()}},
        "finished": _encoded(joined_spans([*finished(state), *days])),
    })
    return number


def reopen(spark: SparkSession, root: str, days: Sequence[Span]) -> None:
    """Take days off the finished ones, so that the next run computes them again; what was written stays current until then."""
    state = newest(spark, root)
    publish(spark, root, {**state, "number": state["number"] + 1, "finished": _encoded(without_spans(finished(state), days))})


def read_table(spark: SparkSession, root: str, name: str, state: Mapping | None = None) -> DataFrame:
    """The current rows of a table; a table that no state names is read as a plain folder.

    Dates are partitions: a condition on ``date`` prunes files.
    """
    state = newest(spark, root) if state is None else state
    if name not in state["tables"]:
        return spark.read.parquet(f"{root}/{name}")
    versions, schema = state["tables"][name], T.StructType.fromJson(state["schemas"][name])
    if isinstance(versions, int):
        return spark.read.schema(schema).parquet(f"{root}/{name}/v={versions}")
    typed = T.StructType([*(f for f in schema if f.name != "date"), T.StructField("date", T.DateType()), T.StructField("v", T.LongType())])
    if not versions:
        return spark.createDataFrame([], typed).select(*schema.names)
    current = reduce(or_, [
        (F.col("v") == v) & F.col("date").between(F.lit(dt.date.fromisoformat(first)), F.lit(dt.date.fromisoformat(last)))
        for v, first, last in versions
    ])
    folders = [f"{root}/{name}/v={v}" for v in sorted({v for v, *_ in versions})]
    rows = spark.read.schema(typed).option("basePath", f"{root}/{name}").parquet(*folders)
    return rows.where(current).select(*schema.names)


def _named(state: Mapping) -> set[tuple[str, int]]:
    return {(name, v) for name, spans in state["tables"].items() for v in ([spans] if isinstance(spans, int) else [s[0] for s in spans])}


def prune(spark: SparkSession, root: str, keep: int = KEPT) -> int:
    """Remove versions that none of the last ``keep`` states name, and older states. Returns the number of removed versions.

    A reader has until the ``keep``-th next state to finish. Versions with a higher number than the current state's
    may belong to a running writer and stay.
    """
    numbers = sorted(_numbers(spark, root))
    if not numbers:
        return 0
    kept = [state_of(spark, root, n) for n in numbers[-keep:]]
    used = set().union(*(_named(s) for s in kept))
    gone = 0
    for name in {name for s in kept for name in s["tables"]}:
        for folder in names_in(spark, f"{root}/{name}"):
            v = folder.removeprefix("v=")
            if folder != v and v.isdigit() and int(v) <= numbers[-1] and (name, int(v)) not in used:
                remove(spark, f"{root}/{name}/{folder}")
                gone += 1
    for n in numbers[:-keep]:
        remove(spark, f"{root}/{STATES}/{n:09d}.json")
    return gone
