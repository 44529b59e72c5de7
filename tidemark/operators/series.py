"""Series matching, field-map pairing and as-of attachment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import chain, count_if
from tidemark.operators.ordered import HOUR_US, carry_last, next_value, previous_value, running_sum, time_chunk
from tidemark.session import measured, written_once


def asof_earlier(
    probes: DataFrame,
    sources: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    source_time: str,
    carry: Sequence[str],
    tie_break: Sequence[str] = (),
    chunk_us: int = HOUR_US,
) -> DataFrame:
    """Attach to each probe the nearest source strictly earlier than it, or NULLs. Times are microseconds.

    A sort-merge as-of: both sides are put on one timeline and the last source is carried forward, chunk by chunk. At
    equal times probes sort first, so a source at the same instant is never attached."""
    keys = list(keys)
    payload = F.struct(F.col(source_time).alias("_at"), *[F.col(c) for c in carry])
    line = probes.withColumn("_t", F.col(probe_time)).withColumn("_side", F.lit(0)).unionByName(
        sources.select(
            *keys,
            F.col(source_time).alias("_t"),
            F.lit(1).alias("_side"),
            payload.alias("_payload"),
            *[F.col(c).alias(f"_tie_{c}") for c in tie_break],
        ),
        allowMissingColumns=True,
    )
    line = line.withColumn("_chunk", time_chunk("_t", chunk_us))
    order = ["_t", "_side", *[f"_tie_{c}" for c in tie_break]]
    line = line.filter(F.col("_t").isNotNull())
    out = carry_last(line, keys, order, F.col("_payload"), "_hit", "_chunk").filter(F.col("_side") == 0)
    untimed = probes.filter(F.col(probe_time).isNull())
    columns = [*probes.columns]
    hit = [F.col(f"_hit.{c}").alias(f"asof_{c}") for c in carry] + [F.col("_hit._at").alias("asof_time")]
    matched = out.select(*columns, *hit)
    return matched.unionByName(untimed, allowMissingColumns=True)


def pair_adjacent(
    line: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    direction: str,
    chunk: str,
    first: str = "AP",
    second: str = "PA",
    combined: str = "combined",
) -> DataFrame:
    """Greedy pairing of neighbours of opposite direction on one timeline.

    `direction` is NULL for rows that are no field map. Rows of a maximal alternating stretch pair as 1–2, 3–4, …; any
    other row, or a repeated direction, ends the stretch. Adds `role`: pair_first, pair_second, single (combined),
    unpaired, or NULL, and `pair_at`, the position of the pair's first row in the key.

    `keys` must hold the date, since a pair never spans two dates."""
    keys, order = list(keys), list(order)
    d = F.col(direction)
    df = line.withColumn("_dir", F.when(d.isin(first, second), d))
    df = previous_value(df, keys, order, F.col("_dir"), "_prev", chunk)
    starts = F.col("_dir").isNotNull() & (F.col("_prev").isNull() | (F.col("_prev") == F.col("_dir")))
    df = running_sum(df, keys, order, F.lit(1).cast("long"), "_pos", chunk)
    df = carry_last(df, keys, order, F.when(starts, F.col("_pos")), "_start", chunk, include_current=True)
    df = next_value(df, keys, order, F.struct(F.col("_dir").alias("d"), F.col("_start").alias("s")), "_next", chunk)
    offset = F.when(F.col("_dir").isNotNull(), F.col("_pos") - F.col("_start"))
    continues = (F.col("_next.d").isNotNull()) & (F.col("_next.d") != F.col("_dir"))
    role = chain(
        [
            (d == combined, "single"),
            (F.col("_dir").isNull(), F.lit(None).cast("string")),
            (offset % 2 == 1, "pair_second"),
            (continues, "pair_first"),
        ],
        "unpaired",
    )
    df = df.withColumn("role", role)
    df = df.withColumn("pair_at", F.when(F.col("role") == "pair_second", F.col("_pos") - 1).when(F.col("role").isNotNull() & (F.col("role") != "unpaired"), F.col("_pos")))
    return df.drop("_dir", "_prev", "_pos", "_start", "_next")


def match_series(
    series: DataFrame,
    runs: DataFrame,
    tables: DataFrame,
    session: Sequence[str] = ("session",),
    table: str = "table",
    structural: Sequence[str] = ("T1w", "T2w"),
    tolerance_s: float = 1.0,
    twin_s: float = 5.0,
) -> DataFrame:
    """Status of each series against the QC table's runs, joined by UID with the time as a cross-check.

    `series`: session keys, series_id, table, kind, norm, uid, acquired_us. `runs`: session keys, table, run_index, uid,
    acquired_us. `tables`: the (session, table) rows that exist. Statuses: no_qc_row, no_uid, unmatched, ambiguous,
    timestamp_mismatch, matched, twin_matched."""
    session = list(session)
    key = [*session, table]
    known = tables.select(*key).distinct().withColumn("_row", F.lit(True))
    one = series.join(known, key, "left").withColumn("_marks", F.lit(0))
    # a UID's runs are one marker row among its series, a matched series three among the lone ones, so every table is read
    # once; rows that take no part in a count are dealt out by their own hash
    marker = runs.filter(F.col("uid").isNotNull()).groupBy(*key, "uid").agg(
        F.count(F.lit(1)).alias("_marks"), F.max("run_index").alias("_index"), F.max("acquired_us").alias("_at_us")
    )
    own = F.xxhash64("series_id", "acquired_us")
    lines = one.unionByName(marker, allowMissingColumns=True)
    by_uid = Window.partitionBy(*key, "uid", F.when(F.col("uid").isNull(), own))
    lines = lines.withColumns({"_hits": F.max("_marks").over(by_uid), "run_index": F.max("_index").over(by_uid), "_run_us": F.max("_at_us").over(by_uid)})
    lines = lines.filter(F.col("_marks") == 0)
    off = F.round((F.col("acquired_us") - F.col("_run_us")) / 1_000_000, 3)
    status = chain(
        [
            (F.col("_row").isNull(), "no_qc_row"),
            (F.col("uid").isNull(), "no_uid"),
            (F.col("_hits") == 0, "unmatched"),
            (F.col("_hits") > 1, "ambiguous"),
            (F.abs(off) > tolerance_s, "timestamp_mismatch"),
        ],
        "matched",
    )
    lines = lines.withColumn("status", status).withColumn("seconds_off", off)
    hit = F.col("status").isin("matched", "timestamp_mismatch")
    by_run = Window.partitionBy(*key, "run_index", F.when(~hit, own))
    lines = lines.withColumn("_claims", F.count(F.when(hit, 1)).over(by_run))
    lines = lines.withColumn("status", F.when(hit & (F.col("_claims") > 1), "ambiguous").otherwise(F.col("status")))
    lines = lines.withColumn("run_index", F.when(hit, F.col("run_index"))).withColumn("seconds_off", F.when(hit, F.col("seconds_off")))
    # a twin lies within twin_s: look only into the own and the two neighbouring slots of that width
    width = int(twin_s * 1_000_000) or 1
    known_twin = F.col("acquired_us").isNotNull() & F.col("norm").isNotNull() & F.col("kind").isin(*structural)
    offers = (F.col("status") == "matched") & known_twin
    itself = F.lit(None).cast("int")
    lines = lines.withColumn("_shift", F.explode(F.when(offers, F.array(itself, F.lit(-1), F.lit(0), F.lit(1))).otherwise(F.array(itself))))
    mark = F.col("_shift").isNotNull()
    lone = ~mark & (F.col("status") == "unmatched") & known_twin
    slot = F.floor(F.col("acquired_us") / width) + F.coalesce("_shift", F.lit(0))
    takes_part = F.coalesce(mark | lone, F.lit(False))
    by_slot = Window.partitionBy(*session, "kind", F.when(mark, F.col("norm")).otherwise(~F.col("norm")), slot, F.when(~takes_part, own))
    us = F.col("acquired_us")
    lines = lines.withColumns({
        "_same": F.max(F.col("_shift") == 0).over(by_slot),
        "_before": F.max(F.when(F.col("_shift") == 1, us)).over(by_slot),
        "_after": F.min(F.when(F.col("_shift") == -1, us)).over(by_slot),
    })
    near = F.col("_same") | (us - F.col("_before") <= width) | (F.col("_after") - us <= width)
    out = lines.withColumn("status", F.when(lone & F.coalesce(near, F.lit(False)), "twin_matched").otherwise(F.col("status"))).filter(~mark)
    return out.select(*series.columns, "run_index", "status", "seconds_off")


def pair_verdicts(attached: DataFrame, keys: Sequence[str], passes: str, agrees: str) -> DataFrame:
    """Verdict of each pair from the runs attached to it: only runs whose attachment agrees with the table count."""
    counted = F.when(F.col(agrees), F.col(passes))
    return (
        attached.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_attached"),
            count_if(F.col(agrees)).alias("n_counted"),
            F.bool_and(counted).alias("_all"),
            F.bool_or(counted).alias("_any"),
        )
        .withColumn(
            "verdict",
            chain(
                [
                    (F.col("n_counted") == 0, "no_qc_verdict"),
                    (F.col("_all"), "usable"),
                    (~F.col("_any"), "fm_failed_qc"),
                ],
                "conflicting_fm_verdicts",
            ),
        )
        .drop("_all", "_any")
    )


def attachment_status(has_run, missing_flag, has_pair):
    """Does the table's missing-field-map flag agree with what was attached?"""
    return chain(
        [
            (~has_run, "no_v7_run"),
            (missing_flag.isNull(), "no_fm_flags"),
            (((missing_flag == 0) & ~has_pair) | ((missing_flag == 1) & has_pair), "fm_attachment_mismatch"),
        ],
        "agrees",
    )


#: Chunks that a key's rows without a time are dealt to, and a number below that of any chunk of times.
UNTIMED_CHUNKS, UNTIMED = 256, -(2**40)


def assign_by_window(
    pods: DataFrame,
    runs: DataFrame,
    keys: Sequence[str],
    pod_id: Sequence[str],
    at: str,
    run_id: str,
    start: str,
    end: str,
    slack_us: int = 120_000_000,
    chunk_us: int = HOUR_US,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The run each pod belongs to, by start time: the one window (with slack) that holds it; several hits give none;
    no hit falls back to the nearest run that had started; a pod without a time gets the only candidate.

    Pods and runs never meet in pairs. On one chunked timeline a window adds one where it opens (slack before its start) and
    takes it off where it has closed: a pod's running count is its number of hits. Where that is one, the open window is
    the one that ends last of those opened so far, a running maximum; the nearest earlier start is a carried value. What the chunks
    before hold is one more row at the head of each chunk that has pods, so pods are shuffled and sorted once, and no pod is looked
    up again. A window without an end stays open, one that ends before it begins never opens.

    One row per pod; with `carry` (other columns of `pods`) every row of `pods` with these columns and its `_chunk`, by which rows lie
    together with their keys."""
    keys, pod_id = list(keys), list(pod_id)
    known = runs.select(*keys, F.col(run_id).alias("_run"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    known = known.filter(F.col("_run").isNotNull()).dropna(subset=keys)
    per_key = known.groupBy(*keys).agg(F.count("_run").alias("n_candidates"), F.max("_run").alias("_only"))

    # order at one instant: the chunk's past, windows open and runs start, pods look, windows close
    none, run_type = F.lit(None), known.schema["_run"].dataType
    until = F.coalesce(F.col("_e") + slack_us, F.lit(2**63 - 1)).cast("long")
    opens = F.col("_s") - slack_us
    nobody = none.cast(T.StructType([T.StructField("until", T.LongType()), T.StructField("run", run_type)]))

    def event(us, order, count, last, run):
        return F.struct(us.cast("long").alias("_us"), F.lit(order).alias("_o"), F.lit(count).cast("long").alias("_n"), last.alias("_last"), run.cast(run_type).alias("_r"))

    begun = event(F.col("_s"), 0, 0, nobody, F.col("_run"))
    edges = F.array(
        event(opens, 0, 1, F.struct(until.alias("until"), F.col("_run").alias("run")), none), begun, event(F.col("_e") + slack_us, 2, -1, nobody, none),
    )
    edges = F.when(until >= opens, edges).otherwise(F.array(begun))
    marks = known.filter(F.col("_s").isNotNull()).select(*keys, F.inline(edges)).filter(F.col("_us").isNotNull())
    marks = marks.withColumn("_chunk", time_chunk("_us", chunk_us))

    units = pods.groupBy(*keys, *pod_id).agg(F.max(at).alias(at)) if carry is None else _at_latest(pods, [*keys, *pod_id], at)
    untimed = F.lit(UNTIMED) - F.pmod(F.xxhash64(*pod_id), F.lit(UNTIMED_CHUNKS))
    units = units.select(*keys, *pod_id, at, *(carry or []), F.coalesce(time_chunk(at, chunk_us), untimed).alias("_chunk"))
    looks = units.withColumns({"_us": F.col(at).cast("long"), "_o": F.lit(1), "_n": F.lit(0).cast("long")})

    # the past of each chunk that has pods
    held = marks.groupBy(*keys, "_chunk").agg(F.sum("_n").alias("_n"), F.max("_last").alias("_last"), F.max(F.when(F.col("_r").isNotNull(), F.struct("_us", "_r"))).alias("_r"))
    held = held.withColumn("_r", F.col("_r._r"))
    past = held.unionByName(units.select(*keys, "_chunk").distinct().withColumn("_looked", F.lit(True)), allowMissingColumns=True)
    before = Window.partitionBy(*keys).orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1)
    past = past.withColumns({"_n": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_last": F.max("_last").over(before), "_r": F.last("_r", ignorenulls=True).over(before)})
    past = past.filter("_looked").drop("_looked").join(per_key, keys, "left")
    only = F.when(F.col("n_candidates") == 1, F.col("_only"))
    past = past.withColumn("_r", F.when(F.col("_chunk") <= UNTIMED, only).otherwise(F.col("_r"))).drop("_only")
    past = past.withColumns({"_us": (F.col("_chunk") * chunk_us).cast("long"), "_o": F.lit(-1)})
    past = past.withColumn("_us", F.when(F.col("_chunk") > UNTIMED, F.col("_us")))

    line = looks.unionByName(marks, allowMissingColumns=True).unionByName(past, allowMissingColumns=True)
    here = Window.partitionBy(*keys, "_chunk").orderBy("_us", "_o", "_r").rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumns({
        "n_hits": F.sum("_n").over(here), "_last": F.max("_last").over(here), "_r": F.last("_r", ignorenulls=True).over(here),
        "n_candidates": F.coalesce(F.max("n_candidates").over(here), F.lit(0)).cast("long"),
    })
    run = F.when(F.col("n_hits") == 1, F.col("_last.run")).when(F.col("n_hits") == 0, F.col("_r"))
    out = line.filter("_o = 1").withColumn("_placed", run)
    return out.select(*keys, *pod_id, at, *([] if carry is None else [*carry, "_chunk"]), "n_candidates", "n_hits", F.col("_placed").alias(run_id))


def _at_latest(rows: DataFrame, unit: Sequence[str], at: str) -> DataFrame:
    """`rows` with `at` as the latest one of their unit. Units are compared by a hash and two times; only rows of the few
    hashes under which times differ are grouped by the unit itself."""
    unit = list(unit)
    number = F.xxhash64(*unit)
    spread = rows.groupBy(number.alias("_h")).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"), F.bool_or(F.col(at).isNull()).alias("_some"))
    spread = written_once(spread.filter((F.col("_lo") < F.col("_hi")) | (F.col("_some") & F.col("_hi").isNotNull())).select("_h"))
    if spread.isEmpty():
        return rows
    latest = rows.withColumn("_h", number).join(measured(spread), "_h", "left_semi").groupBy(*unit).agg(F.max(at).alias("_latest"))
    latest = written_once(latest.select(*[F.col(c).alias(f"_q_{c}") for c in unit], "_latest"))
    same = F.lit(True)
    for c in unit:
        same = same & F.col(c).eqNullSafe(F.col(f"_q_{c}"))
    rows = rows.join(measured(latest), same, "left").withColumn(at, F.coalesce("_latest", at))
    return rows.drop("_latest", *[f"_q_{c}" for c in unit])
