"""Efficiency study: executed nodes from logs, stages, occupancy, critical path, session measures, ratio spreads."""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col, count_if, finite, micros, strict_sum
from tidemark.operators.intervals import concurrency_shares, union_length
from tidemark.operators.ordered import carry_last
from tidemark.operators.quantiles import packed_key, with_quantiles
from tidemark.session import measured, written_once

# ---- fixed values: log line patterns ----------------------------------------------------------------------------
STAMP_PATTERN = r"^(\d{6}-\d\d:\d\d:\d\d),(\d+) nipype\."
SETUP_PATTERN = r'\[Node\] Setting-up "([^"]+)" in "([^"]+)"'
EXECUTE_PATTERN = r'\[Node\] Executing "([^"]+)"'
CACHED_PATTERN = r'\[Node\] Cached "([^"]+)"'
FINISH_PATTERN = r'\[Node\] Finished "([^"]+)", elapsed time ([0-9.eE+-]+)s'
ROOT_PREFIX_PATTERN = r"^(?:.*?/)?fmriprep_\d+_\d+_wf(?:/+|$)"
SUBJECT_PREFIX_PATTERN = r"^sub_[^/]+_wf(?:/+|$)"
BOLD_RUN_PATTERN = r"^bold_(?:ses_[^/.]+_)?task_[^/.]+_wf$"
AMBIGUITY_S = 2.0
UNMAPPED = "unmapped"
# ---- end of fixed values ----------------------------------------------------------------------------------------

#: Lines of a log that one window holds.
LINES = 10_000
#: Lines of a log that are matched in one go; a longer log is matched in pieces.
PIECE_LINES = 200_000
#: Events of a piece that are put off until the state before it is known.
PUT_OFF = 20_000
#: The event of the row that tells a piece's state at its beginning.
STATE = "(state)"


def normalised_path(workdir: str | Column) -> Column:
    """Workflow path of a working directory: parts below the workflow root, without subject, mapped and iterable parts; run
    workflows fold into one name."""
    below = F.regexp_replace(col(workdir), ROOT_PREFIX_PATTERN, "")
    below = F.regexp_replace(below, SUBJECT_PREFIX_PATTERN, "")
    kept = F.filter(F.split(below, "/+"), lambda p: (p != "") & (p != "mapflow") & ~p.startswith("_"))
    return F.array_join(F.transform(kept, lambda p: F.when(p.rlike(BOLD_RUN_PATTERN), "bold_wf").otherwise(p)), ".")


def log_events(logs: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Node events of each log: (keys, line_number, stamp_us, event, node, path, elapsed_s).

    A line carries the last stamp before it; the stamp is carried inside the log's own array of lines, without a window."""
    lines = F.split(text, r"\r\n|\n|\r")
    stamped = F.transform(lines, lambda x: F.when(x.rlike(STAMP_PATTERN), F.regexp_extract(x, STAMP_PATTERN, 1)))
    fraction = F.transform(lines, lambda x: F.when(x.rlike(STAMP_PATTERN), F.rpad(F.regexp_extract(x, STAMP_PATTERN, 2), 6, "0")))
    zipped = F.arrays_zip(lines.alias("line"), stamped.alias("s"), fraction.alias("f"))
    exploded = logs.select(*keys, F.posexplode(zipped).alias("line_number", "_z"))
    line = F.col("_z.line")
    useful = exploded.filter(line.rlike(STAMP_PATTERN) | line.contains("[Node]"))
    stamp = F.when(F.col("_z.s").isNotNull(), F.concat(F.col("_z.s"), F.lit("."), F.substring("_z.f", 1, 6)))
    useful = useful.withColumn("_us", micros(F.try_to_timestamp(stamp, F.lit("yyMMdd-HH:mm:ss.SSSSSS"))))
    event = (
        F.when(line.rlike(SETUP_PATTERN), "setup").when(line.rlike(EXECUTE_PATTERN), "execute")
        .when(line.rlike(CACHED_PATTERN), "cached").when(line.rlike(FINISH_PATTERN), "finish")
    )
    name = F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in (SETUP_PATTERN, EXECUTE_PATTERN, CACHED_PATTERN, FINISH_PATTERN)])
    # what a line says is read before the stamps are carried, so its text is never sorted or shuffled
    useful = useful.withColumn("event", event).select(
        *keys, "line_number", "_us", "event", F.when(F.col("event").isNotNull(), F.substring_index(name, ".", -1)).alias("node"),
        F.when(F.col("event") == "setup", normalised_path(F.regexp_extract(line, SETUP_PATTERN, 2))).alias("path"),
        F.when(F.col("event") == "finish", F.regexp_extract(line, FINISH_PATTERN, 2).cast("double")).alias("elapsed_s"),
    )
    useful = useful.filter(F.col("event").isNotNull() | F.col("_us").isNotNull())
    chunked = useful.withColumn("_chunk", F.floor(F.col("line_number") / LINES))
    carried = carry_last(chunked, keys, ["line_number"], F.col("_us"), "stamp_us", "_chunk", include_current=True)
    return carried.select(*keys, "line_number", "stamp_us", "event", "node", "path", "elapsed_s").filter(F.col("event").isNotNull())


def prefix_class(path: str | Column, rules: Mapping[str, str] | None) -> Column:
    """Value of the longest of a few literal prefixes that is the path or one of its ancestors."""
    p = col(path)
    tests = [F.when((p == r) | p.startswith(r + "."), F.lit(v)) for r, v in sorted((rules or {}).items(), key=lambda x: -len(x[0]))]
    return F.coalesce(*tests, F.lit(UNMAPPED))


def executed_nodes(
    events: DataFrame, keys: Sequence[str], stages: Mapping[str, str] | None = None, tags: Mapping[str, str] | None = None
) -> DataFrame:
    """Executed nodes: each finish line with the in-flight node of that name that started nearest to finish − elapsed.

    A second candidate of another stage or tag about as near makes the pairing ambiguous; a finish without a candidate is
    unpaired (NULL path). Lines are written once. Those of a (log, node) are put in order and streamed through :class:`_InFlight`
    batch by batch; where logs are longer than PIECE_LINES, their pieces are matched side by side (:func:`_in_pieces`)."""
    unit = [*keys, "node"]
    kind = F.concat_ws("|", prefix_class("path", stages), prefix_class("path", tags))
    expected = F.col("stamp_us") - F.rint(F.col("elapsed_s") * 1_000_000).cast("long")
    lines = events.select(
        *unit, "line_number", "event", "path", F.when(F.col("event") == "setup", kind).alias("class"),
        F.when(F.col("event") == "finish", expected).otherwise(F.col("stamp_us")).alias("start_us"), F.col("stamp_us").alias("end_us"), "elapsed_s",
        # lines without a number come first
        F.coalesce(F.floor(F.col("line_number") / PIECE_LINES), F.lit(-1)).cast("long").alias("_piece"),
    )
    types = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    schema = ", ".join(f"`{k}` {types[k]}" for k in unit)
    lines = written_once(lines)
    ends = lines.agg(F.min("_piece").alias("low"), F.max("_piece").alias("high")).first()
    if ends["low"] == ends["high"]:
        whole = lines.repartition(*unit).sortWithinPartitions(*unit, "line_number")
        return whole.mapInArrow(_match_stream(unit), f"{schema}, {_MATCHED}")
    return _in_pieces(lines, unit, schema)


_MATCHED = "path string, start_us bigint, end_us bigint, elapsed_s double, ambiguous boolean"


def _in_pieces(lines: DataFrame, unit: list[str], schema: str) -> DataFrame:
    """The matching of logs cut into pieces by line number, each piece in a task of its own, with the result of one pass in line order.

    A first pass matches each piece without knowing what was in flight before it and puts off the events that concern it
    (:class:`_Unknown`). Per (log, node) those few are then gone through in order, which tells the state that each piece is likely to begin with.
    The second pass matches every piece from that state and tells the one it ends with. Where all pieces end as the next ones
    began, the matching is that of one pass. Where one does not, the next piece is matched again from the right state,
    until all agree: a piece at a time in the worst case, and never more than a piece and its state in a task."""
    place = [*unit, "_piece"]

    def streamed(rows: DataFrame, begin: DataFrame | None) -> DataFrame:
        if begin is not None:
            state = {"event": F.lit(STATE), "path": F.col("state")}
            first = begin.select(*[c if c in place else state.get(c, F.lit(None)).cast(lines.schema[c].dataType).alias(c) for c in lines.columns])
            rows = first.unionByName(rows)
        rows = rows.repartition(*place).sortWithinPartitions(*place, ~F.col("event").eqNullSafe(STATE), "line_number")
        return rows.mapInArrow(_match_pieces(unit, begin is None), f"{schema}, _piece bigint, {_MATCHED}, begun string, state string")

    unknown = streamed(lines, None).select(*place, "state")
    begin = unknown.groupBy(*unit).applyInArrow(_begin_states(unit), f"{schema}, _piece bigint, state string")
    rounds = [written_once(streamed(lines, begin))]
    while True:
        every = rounds[0].withColumn("_round", F.lit(0))
        for n, one in enumerate(rounds[1:], 1):
            every = every.unionByName(one.withColumn("_round", F.lit(n)))
        told = every.filter("state IS NOT NULL").groupBy(*place).agg(F.max_by(F.struct("begun", "state", "_round"), "_round").alias("_t")).select(*place, "_t.*")
        before = told.withColumn("_before", F.lag("state").over(Window.partitionBy(*unit).orderBy("_piece")))
        wrong = before.filter("_before <> begun").groupBy(*unit).agg(F.min("_piece").alias("_piece"), F.min_by("_before", "_piece").alias("state"))
        wrong = written_once(wrong)
        if wrong.isEmpty():
            break
        pieces = measured(wrong.select(packed_key(place).alias("_of")))
        again = lines.join(pieces, packed_key(place) == F.col("_of"), "left_semi")
        rounds.append(written_once(streamed(again, wrong)))
    matched = every.filter("state IS NULL")
    if len(rounds) > 1:
        last = measured(told.select(packed_key([*place, "_round"]).alias("_of")))
        matched = matched.join(last, packed_key([*place, "_round"]) == F.col("_of"), "left_semi")
    return matched.select(*unit, "path", "start_us", "end_us", "elapsed_s", "ambiguous")


class _InFlight:
    """Set-ups not executed yet, first in, first out, and executions that have not finished: per class sorted by start and line,
    those without a stamp apart in line order."""

    def __init__(self):
        self.waiting: deque[tuple[str, str]] = deque()
        self.timed: dict[str, list[tuple[int, int, str]]] = {}
        self.untimed: list[tuple[int, str]] = []

    def step(self, line: int, event: str | None, path: str | None, kind: str | None, start: int | None) -> tuple[str | None, bool] | None:
        """Go on by one line; a finish gives what :meth:`finish` does."""
        if event == "setup":
            self.waiting.append((path, kind))
        elif event == "execute":
            self.begin(line, start)
        elif event == "cached":
            if self.waiting:
                self.waiting.popleft()
        elif event == "finish":
            return self.finish(start)
        return None

    def told(self) -> str:
        """All that is held, as text: equal for equal states."""
        return json.dumps([list(self.waiting), self.timed, self.untimed], sort_keys=True)

    def add(self, told: str):
        """Take in what another one held, begun later than what is held here."""
        waiting, timed, untimed = json.loads(told)
        self.waiting.extend(map(tuple, waiting))
        for kind, held in timed.items():
            self.timed[kind] = sorted([*self.timed.get(kind, []), *map(tuple, held)], key=lambda x: x[:2])
        self.untimed.extend(map(tuple, untimed))

    def begin(self, line: int, start: int | None):
        if not self.waiting:
            return
        path, kind = self.waiting.popleft()
        if start is None:
            self.untimed.append((line, path))
        else:
            insort(self.timed.setdefault(kind, []), (start, line, path))

    def finish(self, expected: int | None) -> tuple[str | None, bool]:
        """Take the execution nearest to `expected`, the first one among equals; whether one of another class is about as near.
        None: nothing is in flight."""
        if not self.timed and not self.untimed:
            return None, False
        near = {}
        for kind, held in self.timed.items():
            if expected is None:
                near[kind] = min((x[1], i) for i, x in enumerate(held))
                continue
            at = bisect_left(held, (expected,))
            found = [(held[at][0] - expected, held[at][1], at)] if at < len(held) else []
            if at:
                first = bisect_left(held, (held[at - 1][0],))
                found.append((expected - held[first][0], held[first][1], first))
            near[kind] = min(found)
        if expected is None or not near:
            kind = min(near, key=near.get, default=None)
            if kind is None or self.untimed and self.untimed[0][0] < near[kind][0]:
                return self.untimed.pop(0)[1], False
            return self.take(kind, near[kind][1]), False
        kind = min(near, key=near.get)
        nearest = near.pop(kind)
        rival = any(x[0] <= nearest[0] + AMBIGUITY_S * 1e6 for x in near.values())
        return self.take(kind, nearest[2]), rival

    def take(self, kind: str, at: int) -> str:
        held = self.timed[kind]
        path = held.pop(at)[2]
        if not held:
            del self.timed[kind]
        return path


class _Unknown(_InFlight):
    """In flight since the beginning of a piece. What concerns executions from before it is put off, as `later`: a finish that
    belongs before the first execution here, one with nothing in flight, and what takes a set-up where none waits."""

    def __init__(self):
        super().__init__()
        self.later: list[tuple] = []
        self.since: int | None = None

    def step(self, line, event, path, kind, start):
        if event == "finish":
            before = start is None or self.since is None or start < self.since or not (self.timed or self.untimed)
        else:
            before = event in ("execute", "cached") and not self.waiting
        if before and len(self.later) < PUT_OFF:
            self.later.append((line, event, path, kind, start))
            return None
        if event == "execute" and self.since is None:
            self.since = start
        return super().step(line, event, path, kind, start)


_LINE = ("line_number", "event", "path", "class", "start_us")


def _match_stream(unit: list[str]):
    """A map over rows sorted by unit and line: the state goes on from batch to batch and starts anew with each unit."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, flight = None, _InFlight()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*unit, *_LINE)]
            place, paths, unsure = [], [], []
            for i, (*key, line, event, path, kind, start) in enumerate(zip(*columns, strict=True)):
                if key != now:
                    now, flight = key, _InFlight()
                if (found := flight.step(line, event, path, kind, start)) is not None:
                    place.append(i)
                    paths.append(found[0])
                    unsure.append(found[1])
            kept = batch.take(pa.array(place, pa.int64()))
            made = [*(kept.column(k) for k in unit), pa.array(paths, pa.string()), *(kept.column(c) for c in ("start_us", "end_us", "elapsed_s")), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays(made, names=[*unit, "path", "start_us", "end_us", "elapsed_s", "ambiguous"])

    return match


def _match_pieces(unit: list[str], unknown: bool):
    """A map over rows sorted by unit, piece and line. `unknown`: one row per piece, with what it held at its end and what it put off as
    `state`. Else a piece's first row has the state it begins with; the finishes are followed by a row with that as `begun` and
    with the state at the end."""
    place = [*unit, "_piece"]
    names = [*place, "path", "start_us", "end_us", "elapsed_s", "ambiguous", "begun", "state"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, flight, begun, kinds = None, None, None, None

        def end() -> pa.RecordBatch:
            state = json.dumps([flight.told(), flight.later]) if unknown else flight.told()
            row = {**dict(zip(place, now, strict=True)), "begun": begun, "state": state}
            return pa.RecordBatch.from_arrays([pa.array([row.get(n)], kinds[n]) for n in names], names=names)

        for batch in batches:
            if kinds is None:
                kinds = {n: batch.schema.field(n).type for n in (*place, "path", "start_us", "end_us", "elapsed_s")}
                kinds |= {"ambiguous": pa.bool_(), "begun": pa.string(), "state": pa.string()}
            columns = [batch.column(c).to_pylist() for c in (*place, *_LINE)]
            at, paths, unsure, ends = [], [], [], []
            for i, (*key, line, event, path, kind, start) in enumerate(zip(*columns, strict=True)):
                if key != now:
                    if now is not None:
                        ends.append(end())
                    now, flight, begun = key, _Unknown() if unknown else _InFlight(), None
                if event == STATE:
                    begun = path
                    flight.add(path)
                elif (found := flight.step(line, event, path, kind, start)) is not None and not unknown:
                    at.append(i)
                    paths.append(found[0])
                    unsure.append(found[1])
            if at:
                kept = batch.take(pa.array(at, pa.int64()))
                nothing = pa.nulls(len(at), pa.string())
                made = [*(kept.column(k) for k in place), pa.array(paths, kinds["path"]), *(kept.column(c) for c in ("start_us", "end_us", "elapsed_s")), pa.array(unsure, pa.bool_()), nothing, nothing]
                yield pa.RecordBatch.from_arrays(made, names=names)
            yield from ends
        if now is not None:
            yield end()

    return match


def _begin_states(unit: list[str]):
    """A map over the pieces of one unit: the state that each is likely to begin with, from what the pieces before it held and put off."""

    def walk(table: pa.Table) -> pa.Table:
        table = table.sort_by("_piece")
        flight, states = _InFlight(), []
        for told in table.column("state").to_pylist():
            states.append(flight.told())
            held, later = json.loads(told)
            for line in later:
                flight.step(*line)
            flight.add(held)
        return table.select([*unit, "_piece"]).append_column("state", pa.array(states, pa.string()))

    return walk


def longest_prefix(df: DataFrame, path: str, rules: DataFrame, out: str, default: str | None = UNMAPPED) -> DataFrame:
    """Value of the longest rule whose prefix is the path or one of its ancestors.

    A path has few ancestors, so it is expanded into them and joined by equality; rules of any number stay a hash join."""
    parts = F.split(path, r"\.")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))
    paths = df.select(path).distinct()
    hits = paths.select(path, F.posexplode(ancestors).alias("_depth", "prefix")).join(rules.select("prefix", F.col("value").alias("_v")), "prefix")
    best = hits.groupBy(path).agg(F.max_by("_v", "_depth").alias(out))
    joined = df.join(best, path, "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(default))) if default is not None else joined


def stage_occupancy(nodes: DataFrame, keys: Sequence[str], running: DataFrame, node_id: Sequence[str] = ("node_id",)) -> DataFrame:
    """Per stage: union time, occupancy share of the pod's running time, node seconds. Every instant of the pod goes to the
    nodes in flight, split equally.

    `nodes`: keys, node id, stage, start_us, end_us. `running`: keys, running_s."""
    shares = concurrency_shares(nodes, keys, node_id, "start_us", "end_us", "_share", carry=["stage"])
    busy = union_length(nodes, keys, "start_us", "end_us", "_busy")
    per_stage = shares.groupBy(*keys, "stage").agg(F.sum("_share").alias("_share"))
    time = union_length(nodes, [*keys, "stage"], "start_us", "end_us", "_time")
    seconds = nodes.groupBy(*keys, "stage").agg(F.sum((F.col("end_us") - F.col("start_us")) / 1e6).alias("node_s"))
    whole = busy.join(running, list(keys)).select(
        *keys, F.greatest(F.col("running_s"), F.col("_busy") / 1e6).alias("_whole"), (F.col("_busy") / 1e6).alias("busy_s")
    )
    return (
        per_stage.join(time, [*keys, "stage"], "left").join(seconds, [*keys, "stage"]).join(whole, list(keys))
        .select(
            *keys, "stage", (F.coalesce("_time", F.lit(0)) / 3.6e9).alias("time_h"),
            F.when(F.col("_whole") > 0, F.col("_share") / 1e6 / F.col("_whole")).alias("share"), "node_s", "busy_s",
        )
    )


def critical_path(durations: DataFrame, keys: Sequence[str], dag: Mapping[str, Sequence[str]], step: str = "step", seconds: str = "seconds") -> DataFrame:
    """Longest path through a small fixed step graph: finish time of each step in topological order, as columns.

    A step a unit did not run counts 0 and its dependents still wait for its own prerequisites."""
    names = {s: f"_d{i}" for i, s in enumerate(dag)}
    wide = durations.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(F.col(step) == s, F.col(seconds))), F.lit(0.0)).alias(c) for s, c in names.items()])
    finish: dict[str, Column] = {}
    pending = dict(dag)
    while pending:
        ready = [s for s, deps in pending.items() if all(d in finish or d not in dag for d in deps)]
        if not ready:
            raise ValueError(f"the step graph has a cycle among {sorted(pending)}")
        for s in ready:
            before = [finish[d] for d in pending.pop(s) if d in finish]
            name = f"_f{names[s]}"
            longest = F.lit(0.0) if not before else (before[0] if len(before) == 1 else F.greatest(*before))
            wide = wide.withColumn(name, longest + F.col(names[s]))
            finish[s] = F.col(name)
    ends = list(finish.values())
    return wide.select(*keys, (F.greatest(*ends) if len(ends) > 1 else ends[0]).alias("critical_s"))


def session_measures(
    pods: DataFrame,
    keys: Sequence[str],
    stage_of: Mapping[str, str],
    dag: Mapping[str, Sequence[str]],
    resources: Sequence[str],
    cost: str,
    k: str = "k",
    divided_stage: str | None = None,
    prior: str = "prior",
) -> DataFrame:
    """One session's measures from its pods: time to result, resources and cost (strict: one unknown pod makes a total NULL),
    retry cost of prior attempts, utilisation inputs and completeness.

    `divided_stage` is charged 1/k; time is never divided. Prior attempts add only to the cost and are reported as retries."""
    table = F.create_map(*[F.lit(x) for kv in stage_of.items() for x in kv])
    p = pods.withColumn("_stage", F.try_element_at(table, F.col("step")))
    final, scale = ~F.col(prior), F.lit(1.0)
    if divided_stage is not None:
        scale = F.when(F.col("_stage") == divided_stage, 1.0 / F.col(k)).otherwise(1.0)

    def strict(cond: Column, c: str) -> Column:
        known = F.count(F.when(cond, finite(c))) == count_if(cond)
        return F.when(known, F.coalesce(F.sum(F.when(cond, F.col(c) * scale)), F.lit(0.0)))

    # every known step counts once for completeness
    sums = p.groupBy(*keys).agg(
        *[strict(final, c).alias(c) for c in resources],
        strict(final, cost).alias("_own"), strict(~final, cost).alias("retry_usd"),
        F.countDistinct(F.when(final & F.col("_stage").isNotNull(), F.col("step"))).alias("_steps"),
        count_if(~final).alias("n_prior_attempts"), count_if(F.col("_stage").isNull()).alias("n_unknown_steps"),
        F.bool_and(F.when(final, F.col("settled"))).alias("settled"),
    )
    path = critical_path(p.filter(final), keys, dag, "step", "running_s")
    out = sums.join(path, list(keys), "left").withColumn(cost, F.col("_own") + F.col("retry_usd"))
    complete = (F.col("_steps") == len(stage_of)) & F.col(resources[0]).isNotNull()
    return out.withColumn("resources_complete", complete).withColumn("cost_complete", complete & F.col(cost).isNotNull()).withColumn(
        "time_h", F.col("critical_s") / 3600.0
    ).drop("_own", "_steps", "critical_s")


def ratio_spread(ratios: DataFrame, measures: Sequence[str]) -> DataFrame:
    """n, median, quartiles and 5th–95th percentile per measure over the finite ratios."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), finite(m).alias("_x")) for m in measures])
    long = ratios.select(F.inline(cells)).filter(F.col("_x").isNotNull())
    base = long.groupBy("measure").agg(F.count(F.lit(1)).alias("n"))
    return with_quantiles(base, long, ["measure"], "_x", {"median": 0.5, "q25": 0.25, "q75": 0.75, "p05": 0.05, "p95": 0.95})


__all__ = [
    "critical_path", "executed_nodes", "log_events", "longest_prefix", "normalised_path", "ratio_spread", "session_measures",
    "stage_occupancy", "strict_sum",
]
