"""Step outcomes, manifests, attempts, coverage checks and re-drive plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import chain, count_if
from tidemark.functions.predicates import attempt_cause
from tidemark.operators.latest import latest
from tidemark.operators.quantiles import values_at_ranks, with_quantiles

# ---- fixed values: phases, exit codes and messages of the re-drive rules ----------------------------------------
TERMINAL_PHASES = ("Failed", "Error")
EXTERNAL_KILL_MESSAGES = ("imminent node shutdown", "pod deleted")
EXTERNAL_KILL_CODE = "143"
QC_GATE_CODE = "65"
REPEAT_THRESHOLD = 2
#: Fewer successful attempts than this give no 95th percentile.
P95_MINIMUM = 20
#: A grain that covers less than this share of the best-covered grain's subjects is a partial read.
COVERAGE_RATIO = 0.9
# ---- end of fixed values ----------------------------------------------------------------------------------------


def explode_steps(manifests: DataFrame, column: str = "steps") -> DataFrame:
    """One row per step of the nested list."""
    rest = [c for c in manifests.columns if c != column]
    return manifests.select(*rest, F.inline(column))


def build_manifests(
    outcomes: DataFrame,
    workflows: DataFrame,
    keys: Sequence[str] = ("workflow_name",),
    step_fields: Sequence[str] = ("step", "session", "task", "run", "status", "failure_category"),
    status: str = "workflow_status",
    outputs: str | None = "outputs_verified",
) -> DataFrame:
    """Subject manifest per workflow: its steps, available outputs, failed and skipped steps, overall status.

    Repeated records of one step collapse before they are nested, so a list is as long as the workflow has steps. A
    workflow that did not succeed is never 'succeeded', even when all its recorded steps were."""
    keys = list(keys)
    step = F.struct(*step_fields)
    nested = outcomes.select(*keys, step.alias("_s")).distinct().groupBy(*keys).agg(
        F.array_sort(F.collect_list("_s")).alias("steps")
    )

    def steps_with(value: str) -> Column:
        return F.array_sort(F.array_distinct(F.transform(F.filter("steps", lambda s: s["status"] == value), lambda s: s["step"])))

    named = {"failed_steps": steps_with("failed"), "skipped_steps": steps_with("skipped")}
    out = workflows.join(nested, keys, "left").select("*", *[c.alias(n) for n, c in named.items()])
    if outputs:
        available = (
            outcomes.filter(F.col("status") == "succeeded")
            .select(*keys, F.explode(outputs).alias("_o"))
            .distinct()
            .groupBy(*keys)
            .agg(F.array_sort(F.collect_list("_o")).alias("outputs_available"))
        )
        out = out.join(available, keys, "left")
    bad = F.size(F.coalesce("failed_steps", F.array())) + F.size(F.coalesce("skipped_steps", F.array()))
    overall = chain(
        [
            ((F.col(status) != "Succeeded") & F.col("steps").isNotNull(), "partial"),
            (F.col(status) != "Succeeded", "failed"),
            (bad > 0, "partial"),
        ],
        "succeeded",
    )
    return out.withColumn("overall_status", overall)


def first_failed_step(
    outcomes: DataFrame, keys: Sequence[str], time: str = "recorded_at", tie_break: Sequence[str] = ("step",)
) -> DataFrame:
    """Step and category of the earliest recorded failure."""
    failed = outcomes.filter(F.col("status") == "failed")
    order = F.struct(F.coalesce(time, F.lit("")), *tie_break)
    pick = F.min_by(F.struct("step", "failure_category"), order)
    return failed.groupBy(*keys).agg(pick.alias("_f")).select(
        *keys, F.col("_f.step").alias("failed_step"), F.col("_f.failure_category").alias("failure_category")
    )


def relabel_targets(
    outcomes: DataFrame, targets: DataFrame, keys: Sequence[str], identity: Sequence[str], time: str = "recorded_at"
) -> DataFrame:
    """Workflows whose earliest failures are all targets of one step: only then may the label be borrowed."""
    keys = list(keys)
    failed = outcomes.filter(F.col("status") == "failed")
    marked = failed.join(targets.select(*identity, "rule"), list(identity), "left")
    # one row per (workflow, time): a single aggregate instead of joining the minimum back
    per_time = marked.groupBy(*keys, time).agg(
        F.bool_and(F.col("rule").isNotNull()).alias("_all"),
        F.min("step").alias("_lo"), F.max("step").alias("_hi"), F.min("rule").alias("_rule"),
    )
    first = per_time.groupBy(*keys).agg(F.min_by(F.struct("_all", "_lo", "_hi", "_rule"), time).alias("_f"))
    return first.filter(F.col("_f._all") & (F.col("_f._lo") == F.col("_f._hi"))).select(
        *keys, F.col("_f._lo").alias("step"), F.col("_f._rule").alias("rule")
    )


def mode_by_stratum(df: DataFrame, strata: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per stratum (ties: the smaller value), its runs and share, and the whole distribution."""
    counts = df.groupBy(*strata, value).agg(F.count(F.lit(1)).alias("_n"))
    entry = F.struct((-F.col("_n")).alias("o"), F.col(value).alias("v"))
    return (
        counts.groupBy(*strata)
        .agg(F.sum("_n").alias("runs"), F.array_sort(F.collect_list(entry)).alias("_d"))
        .select(
            *strata,
            "runs",
            F.col("_d")[0]["v"].alias("mode_value"),
            (-F.col("_d")[0]["o"]).alias("mode_runs"),
            (-F.col("_d")[0]["o"] / F.col("runs")).alias("mode_share"),
            F.array_join(
                F.transform("_d", lambda e: F.concat(e["v"].cast("string"), F.lit(":"), (-e["o"]).cast("string"))), ";"
            ).alias("distribution"),
        )
    )


def attempt_summary(pods: DataFrame, step: str = "step", phase: str = "phase", minutes: str = "minutes") -> DataFrame:
    """Attempts per step: how many ended non-zero and why, and durations of the successful ones.

    The median interpolates; the 95th percentile is the value at index floor(0.95 n) of the sorted durations, and is given
    from 20 successes on."""
    succeeded = F.col(phase) == "Succeeded"
    failed = ~succeeded & ~F.col(phase).isin("Omitted", "Skipped")
    df = pods.withColumn("_cause", F.when(failed, attempt_cause("message", "exit_code")))
    base = df.groupBy(step).agg(
        F.count(F.lit(1)).alias("attempts"),
        count_if(failed).alias("nonzero_attempts"),
        F.count(F.when(succeeded, F.col(minutes))).alias("n_successful"),
    )
    causes = (
        df.filter(F.col("_cause").isNotNull())
        .groupBy(step, "_cause")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(step)
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("_cause", "_n"))),
                    lambda e: F.concat(e["_cause"], F.lit("="), e["_n"].cast("string")),
                ),
                "; ",
            ).alias("causes")
        )
    )
    ok = df.filter(succeeded)
    out = with_quantiles(base.join(causes, step, "left"), ok, [step], minutes, {"median_duration_min": 0.5})
    picked = value_at_rank(ok, [step], minutes, lambda n: F.floor(n * 0.95), "p95_duration_min")
    out = out.join(picked, step, "left")
    return out.withColumn(
        "p95_duration_min", F.when(F.col("n_successful") >= P95_MINIMUM, F.col("p95_duration_min"))
    ).withColumn("nonzero_rate", F.col("nonzero_attempts") / F.col("attempts"))


def value_at_rank(df: DataFrame, keys: Sequence[str], value: str, rank, out: str) -> DataFrame:
    """The value at a 0-based rank of each group's sorted values; `rank` maps the group size column to the rank."""
    found = values_at_ranks(df, keys, value, F.array(rank(F.col("_n"))))
    return found.select("_k.*", F.element_at("_at", rank(F.col("_n"))).alias(out))


def attempts_by_exit(pods: DataFrame, step: str = "step", label: str = "exit_label") -> DataFrame:
    return pods.groupBy(step, label).agg(F.count(F.lit(1)).alias("attempts"))


def phase_split(records: DataFrame, keys: Sequence[str], init: str, main: str, cores: str) -> DataFrame:
    """Init and compute seconds per step, init share, and core-seconds the request held while initialising."""
    total = F.sum(init) + F.sum(main)
    return records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pods"),
        F.avg(init).alias("mean_init_s"),
        F.avg(main).alias("mean_main_s"),
        (F.sum(init) / F.when(total > 0, total)).alias("init_share"),
        F.sum(F.col(init) * F.col(cores)).alias("idle_core_s"),
    )


def staged_flow(df: DataFrame, stages: Sequence[tuple[str, Column]], count: Mapping[str, Sequence[str]]) -> DataFrame:
    """Participant flow: per stage what remains and per exclusion what it removed.

    `stages` are (name, condition) in order; a row leaves at its first condition that does not hold. `count` maps an
    output name to the columns whose distinct combinations are counted. A combination is one number whose bits say where its rows
    left, so it is shuffled once and no row is multiplied by the boxes."""
    if len(stages) > 61:
        raise ValueError("at most 61 stages")
    left_at = F.lit(len(stages))
    for i, (_, keep) in reversed(list(enumerate(stages))):
        left_at = F.when(F.coalesce(keep, F.lit(False)), left_at).otherwise(i)
    everyone = (1 << (len(stages) + 1)) - 1
    boxes = [("enrolled", "stage", everyone)]
    for i, (name, _) in enumerate(stages):
        boxes += [(name, "excluded", 1 << i), (name, "stage", everyone & ~((2 << i) - 1))]
    marked = df.withColumn("_left", left_at)
    bit = F.expr("shiftleft(1L, _left)")

    def by_box(units: DataFrame, name: str, amount: Column) -> DataFrame:
        inside = [F.col("_bit").bitwiseAND(F.lit(mask).cast("long")) != 0 for _, _, mask in boxes]
        sums = units.agg(*[F.sum(F.when(c, amount)).alias(f"_{i}") for i, c in enumerate(inside)])
        cells = [F.struct(F.lit(b).alias("box"), F.lit(k).alias("kind"), F.coalesce(f"_{i}", F.lit(0)).cast("long").alias(name)) for i, (b, k, _) in enumerate(boxes)]
        return sums.select(F.inline(F.array(*cells)))

    out = by_box(marked.groupBy(bit.alias("_bit")).agg(F.count(F.lit(1)).alias("_n")), "n_rows", F.col("_n"))
    for name, cols in count.items():
        units = marked.groupBy(*cols).agg(F.bit_or(bit).alias("_bit"))
        out = out.join(by_box(units, name, F.lit(1)), ["box", "kind"])
    return out.filter("n_rows > 0").select("box", "kind", *count, "n_rows")


def grain_coverage(grains: Mapping[str, DataFrame], subject: str = "subject", ratio: float = COVERAGE_RATIO) -> DataFrame:
    """Rows and distinct subjects per grain, flagged empty or short against the best-covered grain."""
    union = None
    for name, df in grains.items():
        part = df.select(F.lit(name).alias("grain"), F.col(subject).alias("_s"))
        union = part if union is None else union.unionByName(part)
    names = grains[next(iter(grains))].sparkSession.createDataFrame([(n,) for n in grains], ["grain"])
    counted = union.groupBy("grain").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_s").alias("n_subjects"))
    counted = names.join(counted, "grain", "left").fillna(0)
    best = F.max("n_subjects").over(Window.partitionBy())  # one row per grain: a handful
    any_rows = F.max("n_rows").over(Window.partitionBy())
    flag = chain(
        [
            (any_rows == 0, "all_empty"),
            (F.col("n_rows") == 0, "empty"),
            (F.col("n_subjects") < best * ratio, "partial"),
        ],
        "ok",
    )
    return counted.withColumn("flag", flag)


def coverage_check(
    name: str, expected: DataFrame, found: DataFrame, keys: Sequence[str], evidence: DataFrame | None = None,
    gated: DataFrame | None = None,
) -> DataFrame:
    """One check row: expected units, found, missing, excluded for lack of evidence, rejected by the gate, passed.

    A unit without evidence of input is no failure, and one the gate rejected is reported apart."""
    keys = list(keys)
    units = expected.select(*keys).distinct()
    marked = units.join(found.select(*keys).distinct().withColumn("_f", F.lit(True)), keys, "left")
    for flag, df in (("_e", evidence), ("_g", gated)):
        if df is None:
            marked = marked.withColumn(flag, F.lit(flag == "_e"))
        else:
            marked = marked.join(df.select(*keys).distinct().withColumn(flag, F.lit(True)), keys, "left")
    got, has, rejected = F.col("_f").isNotNull(), F.coalesce("_e", F.lit(False)), F.coalesce("_g", F.lit(False))
    out = marked.agg(
        F.count(F.lit(1)).alias("expected"),
        count_if(got).alias("found"),
        count_if(~got & ~has).alias("no_evidence"),
        count_if(~got & has & rejected).alias("gated"),
        count_if(~got & has & ~rejected).alias("missing"),
    )
    return out.select(F.lit(name).alias("check"), "*", (F.col("missing") == 0).alias("passed"))


def required_fields_check(name: str, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows whose required fields are NULL or empty, field by field, in one aggregate."""
    empty = {c: F.col(c).isNull() | (F.col(c).cast("string") == "") for c in required}
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(e).alias(c) for c, e in empty.items()])
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n_empty")) for c in required])
    return counted.select(F.lit(name).alias("check"), F.col("_n").alias("n_rows"), F.inline(cells)).withColumn(
        "passed", F.col("n_empty") == 0
    )


def expected_names_check(name: str, df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Names that must occur at least once, and those that do not: one partial aggregate over the rows, one flag per name."""
    here = df.agg(*[F.coalesce(F.bool_or(F.col(column) == n), F.lit(False)).alias(f"_{i}") for i, n in enumerate(expected)])
    flags = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"_{i}").alias("f")) for i, n in enumerate(expected)])
    missing = F.transform(F.filter(flags, lambda x: ~x["f"]), lambda x: x["n"])
    found = F.size(F.filter(flags, lambda x: x["f"]))
    return here.select(
        F.lit(name).alias("check"), F.lit(len(expected)).alias("expected"), found.alias("found"),
        F.array_join(F.array_sort(missing), ",").alias("missing"), (found == len(expected)).alias("passed"),
    )


def newest_version_check(
    name: str, records: DataFrame, keys: Sequence[str], time: str, version: str, wanted: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Units whose newest record has the wanted version; older records of other versions do not count. No units: passed."""
    newest = records.groupBy(*keys).agg(F.max_by(F.coalesce(version, F.lit("")), F.struct(time, *tie)).alias("_v"))
    wrong = F.col("_v") != wanted
    out = newest.agg(
        F.count(F.lit(1)).alias("expected"), count_if(~wrong).alias("found"),
        F.array_join(F.array_sort(F.collect_set(F.when(wrong, F.col("_v")))), ",").alias("other_versions"),  # versions, not units
    )
    return out.select(F.lit(name).alias("check"), "*", (F.col("found") == F.col("expected")).alias("passed"))


def anatomy_only_delivery(
    subjects: DataFrame, outcomes: DataFrame, markers: DataFrame, functional: Column, no_session: str = "na", template: str = "long-template"
) -> DataFrame:
    """One row per subject without functional evidence: (subject, n_sessions, n_gaps, has_template, verdict).

    Coverage counts functional runs, so a subject without any is invisible to it; its anatomy must still have been delivered.
    Expected sessions are those that the subject's own `outcomes` (subject, session, ...) name, and only a completion marker
    (`markers`: subject, session) proves one. Verdicts: `lost` (no session on record), `gaps`, `no_template` (a warning, not a
    failure), `delivered`. Outcomes and markers meet in one grouping by (subject, session)."""
    seen = outcomes.groupBy("subject", "session").agg(F.coalesce(F.bool_or(functional), F.lit(False)).alias("_func"))
    seen = seen.select("subject", "session", "_func", F.lit(True).alias("_seen"), F.lit(False).alias("_marked"))
    marked = markers.select("subject", "session", F.lit(False).alias("_func"), F.lit(False).alias("_seen"), F.lit(True).alias("_marked"))
    units = seen.unionByName(marked).groupBy("subject", "session").agg(*[F.bool_or(c).alias(c) for c in ("_func", "_seen", "_marked")])
    session = F.col("_seen") & F.col("session").isNotNull() & ~F.col("session").isin(no_session, template)
    per = units.groupBy("subject").agg(
        F.bool_or("_func").alias("_func"), count_if(session).alias("n_sessions"), count_if(session & ~F.col("_marked")).alias("n_gaps"),
        F.coalesce(F.bool_or((F.col("session") == template) & F.col("_marked")), F.lit(False)).alias("has_template"),
    )
    zero = F.lit(0).cast("long")
    out = subjects.select("subject").distinct().join(per, "subject", "left").filter(~F.coalesce("_func", F.lit(False)))
    out = out.select("subject", F.coalesce("n_sessions", zero).alias("n_sessions"), F.coalesce("n_gaps", zero).alias("n_gaps"), F.coalesce("has_template", F.lit(False)).alias("has_template"))
    verdict = chain([(F.col("n_sessions") == 0, "lost"), (F.col("n_gaps") > 0, "gaps"), (~F.col("has_template"), "no_template")], "delivered")
    return out.withColumn("verdict", verdict)


def anatomy_only_check(delivery: DataFrame, name: str = "anatomy_only_delivery") -> DataFrame:
    """The check row of :func:`anatomy_only_delivery`: a missing template warns, a lost subject or a gap fails."""
    bad = F.col("verdict").isin("lost", "gaps")
    out = delivery.agg(
        F.count(F.lit(1)).alias("expected"), count_if(~bad).alias("found"), count_if(F.col("verdict") == "lost").alias("lost"),
        count_if(F.col("verdict") == "gaps").alias("with_gaps"), count_if(F.col("verdict") == "no_template").alias("without_template"),
    )
    return out.select(F.lit(name).alias("check"), "*", (F.col("without_template") > 0).alias("warning"), (F.col("found") == F.col("expected")).alias("passed"))


def terminal_phase(workflows: DataFrame, subject: str = "subject", phase: str = "phase", time: str = "started_at"):
    """Newest phase per subject, how many workflows it took, and whether a later success recovered a failure."""
    return (
        workflows.groupBy(subject)
        .agg(
            F.max_by(phase, F.struct(time, "workflow_name")).alias("last_phase"),
            F.count(F.lit(1)).alias("n_workflows"),
            F.bool_or(F.col(phase).isin(*TERMINAL_PHASES)).alias("_failed"),
        )
        .withColumn("recovered", F.col("_failed") & (F.col("last_phase") == "Succeeded"))
        .drop("_failed")
    )


def redrive_plan(
    workflows: DataFrame,
    attempts: DataFrame,
    deterministic: Mapping[str, str] | None = None,
    absent_key: str = "key does not exist",
    exclude: Sequence[str] = (),
    time: str = "started_at",
) -> DataFrame:
    """Whether re-driving the newest failed workflow of each subject can succeed.

    Deterministic causes come before the deadline, which may only be their symptom; a gate rejection is a verdict only
    when it is the whole story. `attempts` are the failed attempts: workflow_name, step, exit_code, message."""
    newest = latest(workflows.filter(F.col("subject").isNotNull()), ["subject"], time, ["workflow_name"])
    candidates = newest.filter(F.col("phase").isin(*TERMINAL_PHASES))
    text = F.lower(F.coalesce("message", F.lit("")))
    code = F.coalesce(F.col("exit_code").cast("string"), F.lit(""))
    killed = code == EXTERNAL_KILL_CODE
    for needle in EXTERNAL_KILL_MESSAGES:
        killed = killed | text.contains(needle)
    reason = chain([(text.contains(n.lower()), r) for n, r in (deterministic or {}).items()])
    per_code = attempts.select(
        "workflow_name", "step", code.alias("_code"), killed.alias("_killed"),
        reason.cast("string").alias("_reason"), text.contains(absent_key).alias("_absent"),
    ).groupBy("workflow_name", "step", "_code").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(~F.col("_killed") & (F.col("_code") != ""), 1)).alias("_repeat"),
        F.min("_reason").alias("_reason"),
        F.bool_or("_absent").alias("_absent"),
    )
    tally = per_code.groupBy("workflow_name").agg(
        F.sum("_n").alias("n_attempts"),
        F.max("_repeat").alias("_repeat"),
        F.min("_reason").alias("_reason"),
        F.bool_or("_absent").alias("_absent"),
        F.bool_and(F.col("_code") == QC_GATE_CODE).alias("_gate"),
    )
    joined = candidates.join(tally, "workflow_name", "left")
    n = F.coalesce("n_attempts", F.lit(0))
    deadline = F.lower(F.coalesce("workflow_message", F.lit(""))).contains("deadline")
    cases = [
        (F.col("subject").isin(list(exclude)) if exclude else F.lit(False), "skip", "excluded by name"),
        (n == 0, "retry", "no failed pod"),
        (F.col("_reason").isNotNull(), "skip", "deterministic message"),
        (F.col("_repeat") >= REPEAT_THRESHOLD, "skip", "deterministic repeat"),
        (F.col("_absent"), "retry", "absent artifact key"),
        (deadline, "retry", "hit deadline"),
        (F.col("_gate"), "skip", "gate rejected the input"),
    ]
    return joined.select(
        "subject", "workflow_name", "phase", n.alias("n_attempts"),
        chain([(c, a) for c, a, _ in cases], "retry").alias("action"),
        chain([(c, r) for c, _, r in cases], "transient").alias("reason"),
    )


def completion_inventory(
    listing: DataFrame, keys: Sequence[str], parts: Mapping[str, Column], floor: Mapping[str, int] | None = None
) -> DataFrame:
    """Per unit, which parts exist in an object listing (path, size); `floor` is the size below which an object does not
    count as intact."""
    flags = []
    for name, cond in parts.items():
        least = (floor or {}).get(name, 0)
        flags.append(F.coalesce(F.bool_or(cond & (F.col("size") >= least)), F.lit(False)).alias(name))
    out = listing.groupBy(*keys).agg(*flags)
    complete = F.lit(True)
    for name in parts:
        complete = complete & F.col(name)
    return out.withColumn("complete", complete)


def table_quality(
    df: DataFrame, unit: Sequence[str], checks: Mapping[str, Column], expected_rows: DataFrame | None = None
) -> DataFrame:
    """Check rows per unit from one aggregate: how many rows of the unit violate each check."""
    counted = df.groupBy(*unit).agg(
        F.count(F.lit(1)).alias("n_rows"), *[count_if(c).alias(f"_c_{n}") for n, c in checks.items()]
    )
    cells = [F.struct(F.lit(n).alias("check"), F.col(f"_c_{n}").alias("n_bad")) for n in checks]
    if expected_rows is not None:
        counted = counted.join(expected_rows, list(unit), "left")
        off = F.abs(F.col("n_rows") - F.coalesce("expected_rows", F.lit(-1)))
        cells.append(F.struct(F.lit("row_count").alias("check"), off.alias("n_bad")))
    return counted.select(*unit, "n_rows", F.inline(F.array(*cells))).withColumn("passed", F.col("n_bad") == 0)


def log_census(logs: DataFrame, unit: Sequence[str], text: str, patterns: Mapping[str, str]) -> DataFrame:
    """One value per unit and pattern from log text: the value, 'mixed' for several, NULL when it never occurs."""
    found = logs.select(
        *unit,
        *[F.array_distinct(F.regexp_extract_all(text, F.lit(p), F.lit(1))).alias(n) for n, p in patterns.items()],
    )
    return found.select(
        *unit,
        *[
            F.when(F.size(n) == 1, F.col(n)[0]).when(F.size(n) > 1, "mixed").alias(n)
            for n in patterns
        ],
    )


def duty_cycle(
    samples: DataFrame, pod: Sequence[str], step: str, utilisation: str, memory: str, busy_above: float = 0.0
) -> DataFrame:
    """Share of busy samples and busy utilisation per pod, then averaged over the pods of a step with the peak memory."""
    busy = F.col(utilisation) > busy_above
    per_pod = samples.groupBy(*pod, step).agg(
        (count_if(busy) / F.count(F.lit(1))).alias("_duty"),
        F.avg(F.when(busy, F.col(utilisation))).alias("_busy"),
        F.max(memory).alias("_peak"),
    )
    return per_pod.groupBy(step).agg(
        F.count(F.lit(1)).alias("n_pods"),
        F.avg("_duty").alias("duty_cycle"),
        F.avg("_busy").alias("mean_busy_utilisation"),
        F.max("_peak").alias("peak_memory"),
    )
