"""The analytics tables read as record tables.

Each stand-in is a projection (sometimes one join) of the given tables onto a record table's columns, once as a
DataFrame and once as the same view in SQL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import day
from tidemark.session import ensure_settings

_VIEWS = {
    "pod_costs": """
        SELECT CAST(l_orderkey AS VARCHAR) AS workflow_name,
               l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS pod,
               l_returnflag AS step, l_linestatus AS phase,
               o_custkey AS subject, l_linenumber AS session, l_suppkey AS node_instance_type,
               strftime(l_shipdate, '%Y-%m-%d') AS date,
               l_extendedprice AS total_cost_usd,
               l_extendedprice * 0.5 AS cpu_cost_usd, l_extendedprice * 0.25 AS memory_cost_usd,
               l_extendedprice * 0.2 AS gpu_cost_usd, l_extendedprice * 0.04 AS pv_cost_usd,
               l_extendedprice * 0.01 AS network_cost_usd,
               l_quantity AS runtime_minutes, l_quantity * l_discount AS cpu_core_hours,
               l_discount AS cpu_efficiency, l_tax AS ram_efficiency,
               CASE WHEN l_linenumber <> 7 THEN 1 - l_discount END AS node_effective_usd_per_hour,
               CASE WHEN l_linenumber <> 7 THEN 1.0 END AS node_ondemand_usd_per_hour,
               CAST(l_suppkey % 4 AS BIGINT) AS scrape_age_days
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "costs": """
        SELECT CAST(o_orderkey AS VARCHAR) AS workflow_name, o_custkey AS subject,
               strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS pipeline,
               o_totalprice AS total_cost_usd, o_totalprice * 0.5 AS cpu_cost_usd,
               o_totalprice * 0.25 AS memory_cost_usd, o_totalprice * 0.25 AS gpu_cost_usd,
               0.0 AS total_adjustment_usd, CAST(o_orderkey % 4 AS BIGINT) AS scrape_age_days
        FROM orders""",
    "workflow_runs": """
        SELECT CAST(o_orderkey AS VARCHAR) AS workflow_name, o_custkey AS subject,
               CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Succeeded' ELSE 'Running' END AS status,
               strftime(o_orderdate, '%Y-%m-%d') AS finished_at, o_orderpriority AS message,
               CAST(floor(o_totalprice) AS BIGINT) AS total_duration_s
        FROM orders""",
    "step_outcomes": """
        SELECT CAST(l_orderkey AS VARCHAR) AS workflow_name, l_returnflag AS step, o_custkey AS subject,
               l_linenumber AS session, l_partkey AS run, l_suppkey AS task,
               CASE WHEN l_linestatus = 'F' THEN 'failed' WHEN l_quantity < 3 THEN 'skipped'
                    ELSE 'succeeded' END AS status,
               CASE WHEN l_linestatus = 'F' THEN l_returnflag || CAST(l_linenumber AS VARCHAR) ELSE '' END
                    AS failure_category,
               strftime(l_shipdate, '%Y-%m-%d') AS recorded_at, l_quantity AS outputs
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "records": """
        SELECT event_id, user_id AS subject, event_type AS session, epoch_us(ts) AS completed_us,
               strftime(ts, '%Y-%m-%d') AS dt, value AS metric, CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events""",
}


class Tables:
    """The given tables and the stand-ins, as DataFrames over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = ensure_settings(spark)
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @staticmethod
    def with_views(sql: str) -> str:
        """The SQL with the stand-in views it names put in front as common table expressions."""
        used = [v for v in _VIEWS if re.search(rf"\b{v}\b", sql)]
        if not used:
            return sql.strip()
        ctes = ",\n".join(f"{v} AS ({_VIEWS[v].strip()})" for v in used)
        body = sql.strip()
        if re.match(r"(?i)with\s", body):
            return f"WITH {ctes},\n{body[4:].lstrip()}"
        return f"WITH {ctes}\n{body}"

    @property
    def pod_costs(self) -> DataFrame:
        price = F.col("l_extendedprice")
        priced = F.col("l_linenumber") != 7
        return self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").cast("string").alias("workflow_name"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("pod"),
            F.col("l_returnflag").alias("step"),
            F.col("l_linestatus").alias("phase"),
            F.col("o_custkey").alias("subject"),
            F.col("l_linenumber").alias("session"),
            F.col("l_suppkey").alias("node_instance_type"),
            day("l_shipdate").alias("date"),
            price.alias("total_cost_usd"),
            (price * 0.5).alias("cpu_cost_usd"),
            (price * 0.25).alias("memory_cost_usd"),
            (price * 0.2).alias("gpu_cost_usd"),
            (price * 0.04).alias("pv_cost_usd"),
            (price * 0.01).alias("network_cost_usd"),
            F.col("l_quantity").alias("runtime_minutes"),
            (F.col("l_quantity") * F.col("l_discount")).alias("cpu_core_hours"),
            F.col("l_discount").alias("cpu_efficiency"),
            F.col("l_tax").alias("ram_efficiency"),
            F.when(priced, 1 - F.col("l_discount")).alias("node_effective_usd_per_hour"),
            F.when(priced, F.lit(1.0)).alias("node_ondemand_usd_per_hour"),
            (F.col("l_suppkey") % 4).alias("scrape_age_days"),
        )

    @property
    def costs(self) -> DataFrame:
        price = F.col("o_totalprice")
        return self.orders.select(
            F.col("o_orderkey").cast("string").alias("workflow_name"),
            F.col("o_custkey").alias("subject"),
            day("o_orderdate").alias("date"),
            F.col("o_orderpriority").alias("pipeline"),
            price.alias("total_cost_usd"),
            (price * 0.5).alias("cpu_cost_usd"),
            (price * 0.25).alias("memory_cost_usd"),
            (price * 0.25).alias("gpu_cost_usd"),
            F.lit(0.0).alias("total_adjustment_usd"),
            (F.col("o_orderkey") % 4).alias("scrape_age_days"),
        )

    @property
    def workflow_runs(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.orders.select(
            F.col("o_orderkey").cast("string").alias("workflow_name"),
            F.col("o_custkey").alias("subject"),
            F.when(status == "F", "Failed").when(status == "O", "Succeeded").otherwise("Running").alias("status"),
            day("o_orderdate").alias("finished_at"),
            F.col("o_orderpriority").alias("message"),
            F.floor("o_totalprice").cast("long").alias("total_duration_s"),
        )

    @property
    def step_outcomes(self) -> DataFrame:
        failed = F.col("l_linestatus") == "F"
        return self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").cast("string").alias("workflow_name"),
            F.col("l_returnflag").alias("step"),
            F.col("o_custkey").alias("subject"),
            F.col("l_linenumber").alias("session"),
            F.col("l_partkey").alias("run"),
            F.col("l_suppkey").alias("task"),
            F.when(failed, "failed").when(F.col("l_quantity") < 3, "skipped").otherwise("succeeded").alias("status"),
            F.when(failed, F.concat("l_returnflag", F.col("l_linenumber").cast("string")))
            .otherwise("")
            .alias("failure_category"),
            day("l_shipdate").alias("recorded_at"),
            F.col("l_quantity").alias("outputs"),
        )

    @property
    def records(self) -> DataFrame:
        """QC records: many versions of one (subject, session) unit."""
        return self.events.select(
            "event_id",
            F.col("user_id").alias("subject"),
            F.col("event_type").alias("session"),
            F.unix_micros(F.col("ts").cast("timestamp")).alias("completed_us"),
            day("ts").alias("dt"),
            F.col("value").alias("metric"),
            F.get_json_object("props", "$.k").cast("long").alias("k"),
        )


def allocation_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One response per date: (date, member, text) sorted by date, where a text is the JSON object of one member, to (date, body)
    with a set of all members of the date and an idle one. Only the texts of one date are held. A date with a member twice is refused."""
    schema = pa.schema([("date", pa.string()), ("body", pa.string())])
    date, members, joined = None, [], []

    def response() -> pa.RecordBatch:
        names = pa.chunked_array(members)
        if pc.count_distinct(names).as_py() < len(names):
            raise ValueError(f"a member comes twice on {date}")
        members.clear()
        body = pa.py_buffer(b"".join([b'{"data":[{', *joined, b'"__idle__":null}]}']))
        joined.clear()
        ends = pa.py_buffer(np.array([0, body.size], dtype=np.int32))
        return pa.RecordBatch.from_arrays([pa.array([date], pa.string()), pa.StringArray.from_buffers(1, ends, body)], schema=schema)

    for batch in batches:
        dates = batch.column(0).to_pylist()
        start = 0
        while start < len(dates):
            if members and dates[start] != date:
                yield response()
            date, end = dates[start], start + 1
            while end < len(dates) and dates[end] == date:
                end += 1
            texts = pc.utf8_slice_codeunits(batch.column(2)[start:end], 1, -1)
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), texts), ",")[0]
            members.append(batch.column(1)[start:end])
            joined += [text.as_buffer(), b","]
            start = end
    if members:
        yield response()
