"""Status, verdict and reason expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of, chain, col, finite, micros

# ---- fixed values: failure taxonomy, exit codes, causes, path classes, identifying fields ------------------------
FAILURE_PATTERNS = {
    "infrastructure": (
        r"OOMKilled", r"exit\s+code\s+137", r"evicted", r"node\s+cordoned", r"deadline\s+exceeded",
        r"pod\s+unschedul", r"Unschedulable", r"insufficient\s+memory",
    ),
    "data": (
        r"NoSuchKey", r"NoSuchBucket", r"nss_volumes", r"missing\s+input", r"corrupt", r"Unable\s+to\s+open",
        r"Input\s+file\s+not\s+found",
    ),
    "algorithm": (
        r"AssertionError", r"ValueError", r"segmentation\s+fault", r"Segmentation\s+fault", r"SIGSEGV",
        r"RuntimeError", r"CalledProcessError", r"non-zero\s+exit\s+code", r"ERROR:",
    ),
    "dependency": (r"depended\s+on\s+task", r"upstream\s+task\s+failed", r"Skipped"),
}
EXIT_CODE_CATEGORY = {
    137: "infrastructure", 143: "infrastructure", 139: "algorithm", 134: "algorithm", 65: "qc_rejected", 70: "data",
    66: "dependency",
}
ATTEMPT_MESSAGES = {
    "imminent node shutdown": "spot: imminent node shutdown",
    "pod deleted": "spot: pod deleted",
    "OOM": "OOMKilled",
}
ATTEMPT_CODES = {"65": "QC gate (exit 65)", "75": "EX_TEMPFAIL (exit 75)"}
BOLD_PATTERN = r"_task-([a-z]+)_run-\d+_bold\.json$"
FIELDMAP_DIRECTION_PATTERN = r"_acq-func_dir-(AP|PA)_run-\d+_epi\.json$"
FIELDMAP_COMBINED_PATTERN = r"_acq-func_run-\d+_epi\.json$"
IDENTIFYING_FIELDS = (
    "PatientName", "PatientID", "OtherPatientIDs", "OtherPatientIDsSequence", "PatientBirthDate", "PatientBirthTime",
    "PatientSex", "PatientAge", "PatientSize", "PatientWeight", "PatientAddress", "PatientTelephoneNumbers",
    "PatientMotherBirthName", "AccessionNumber", "ReferringPhysicianName", "DateOfBirth", "PatientsSex", "PatientsAge",
    "PatientsName", "PatientsBirthDate",
)
#: Gate of the two registration types: a metric crossing its bound fails the run.
REGISTRATION_GATES = {
    "t1w_to_mni": {"lncc": ("below", 0.65, False), "jac_det_frac_negative": ("above", 0.0, False)},
    "bold_to_t1w": {"nmi_gain": ("below", 0.0, True)},
}
#: Values shorter than this are too common to search a text for; digits alone need more.
MIN_VALUE_LENGTH = 5
MIN_DIGITS_LENGTH = 8
# ---- end of fixed values ----------------------------------------------------------------------------------------


def gate_verdict(bounds: Mapping[str, tuple[str, float, bool]], columns: Sequence[str]) -> Column:
    """'pass' or 'fail' over the bounds whose metric the table has. A gated metric that is NULL or not finite fails:
    a comparison with NaN is false, and a gate must not open on what it could not measure."""
    failing = []
    for metric, (direction, bound, inclusive) in bounds.items():
        if metric not in columns:
            continue
        x = finite(metric)
        if direction == "below":
            crossed = x <= bound if inclusive else x < bound
        else:
            crossed = x >= bound if inclusive else x > bound
        failing.append(x.isNull() | crossed)
    return F.when(any_of(failing), "fail").otherwise("pass")


def failure_category(
    status: str | Column,
    message: str | Column,
    exit_code: str | Column,
    patterns: Mapping[str, Sequence[str]] = FAILURE_PATTERNS,
    codes: Mapping[int, str] = EXIT_CODE_CATEGORY,
) -> Column:
    """Category of a failed or skipped step: status first, then message patterns in order, then the exit code."""
    st = F.lower(F.coalesce(col(status), F.lit("")))
    text = F.coalesce(col(message), F.lit(""))
    code = F.trim(F.coalesce(col(exit_code).cast("string"), F.lit("")))
    cases = [(st == "succeeded", ""), (st == "skipped", "dependency")]
    cases += [(text.rlike("(?i)" + "|".join(f"(?:{p})" for p in ps)), name) for name, ps in patterns.items()]
    cases += [(code.try_cast("int") == c, name) for c, name in codes.items()]
    cases.append(((st == "error") & (F.trim(text) == ""), "infrastructure"))
    return chain(cases, "unknown")


def attempt_cause(message: str | Column, exit_code: str | Column) -> Column:
    """Why one attempt ended non-zero. Memory kills and reclaims share an exit code; only the message tells them apart."""
    text = F.coalesce(col(message), F.lit(""))
    code = col(exit_code).cast("string")
    cases = [(text.contains(needle), cause) for needle, cause in ATTEMPT_MESSAGES.items()]
    cases += [(code == c, cause) for c, cause in ATTEMPT_CODES.items()]
    return chain(cases, F.concat(F.lit("other (exit "), F.coalesce(code, F.lit("None")), F.lit(")")))


def run_status(aggregate: str | Column, expected: str | Column, verified: str | Column) -> Column:
    """Status of one run: a step that never ran keeps its status, otherwise its own outputs decide."""
    status = col(aggregate)
    never_ran = F.lower(status).isin("skipped", "omitted", "")
    complete = F.size(F.array_except(col(expected), F.coalesce(col(verified), F.array().cast("array<string>")))) == 0
    return (
        F.when(never_ran | (F.coalesce(F.size(col(expected)), F.lit(0)) <= 0), status)
        .when(complete, "Succeeded")
        .otherwise("Failed")
    )


def expected_outputs(
    step: str | Column, templates: Mapping[str, str], values: Mapping[str, str | Column], run_scoped: Sequence[str] = (),
    absent: str = "na",
) -> Column:
    """Expected object keys of a step from `{name}` templates; a run-scoped step recorded at session scope has none."""
    empty = F.array().cast("array<string>")
    cases = []
    for name, template in templates.items():
        key = F.lit("")
        rest = template
        while "{" in rest:
            head, _, tail = rest.partition("{")
            field, _, rest = tail.partition("}")
            key = F.concat(key, F.lit(head), col(values[field]).cast("string"))
        key = F.concat(key, F.lit(rest))
        session_level = F.lit(name in run_scoped) & any_of(col(values[f]) == absent for f in ("task", "run") if f in values)
        cases.append((col(step) == name, F.when(session_level, empty).otherwise(F.array(key))))
    return chain(cases, empty)


def pending_seconds(submitted: str | Column, started: str | Column) -> Column:
    """Wait between two instants in seconds; equal or inverted instants are unmeasured, not zero."""
    seconds = (micros(started) - micros(submitted)) / 1_000_000
    return F.when(seconds > 0, seconds)


def uniform_value(values: str | Column, empty: str = "unknown") -> Column:
    """Aggregate: the one value of the group, 'mixed' for several, `empty` when any is missing or there is none."""
    v = col(values).cast("string")
    return (
        F.when((F.count(v) < F.count(F.lit(1))) | (F.count(v) == 0), F.lit(empty))
        .when(F.min(v) == F.max(v), F.min(v))
        .otherwise("mixed")
    )


def sentinel_null(c: str | Column, sentinel: float) -> Column:
    """NULL where a metric carries its not-computed value."""
    return F.when(col(c) != sentinel, col(c))


def path_class(path: str | Column) -> dict[str, Column]:
    """Series fields of a session-relative header path: kind, task, direction, norm (NULL kind: out of scope)."""
    p = col(path)
    folder = F.substring_index(p, "/", 1)
    name = F.when(p.contains("/"), F.regexp_replace(p, "^[^/]*/", "")).otherwise("")
    anat, func, fmap = folder == "anat", folder == "func", folder == "fmap"
    structural = F.regexp_extract(name, r"_(T1w|T2w)\.json$", 1)
    task = F.regexp_extract(name, BOLD_PATTERN, 1)
    direction = F.regexp_extract(name, FIELDMAP_DIRECTION_PATTERN, 1)
    kind = chain(
        [
            (anat & (structural != ""), structural),
            (func & (task != ""), "bold"),
            (fmap & ((direction != "") | name.rlike(FIELDMAP_COMBINED_PATTERN)), "fmap"),
        ]
    )
    return {
        "kind": kind,
        "task": F.when(func & (task != ""), task),
        "direction": F.when(fmap & (direction != ""), direction).when(
            fmap & name.rlike(FIELDMAP_COMBINED_PATTERN), "combined"
        ),
        "norm": anat & (structural != "") & name.contains("_rec-norm_"),
    }


def tolerant_datetime(date: str | Column, time: str | Column) -> Column:
    """Two spellings of one clock, `20181001` + `101042.2475` and `2018-10-01` + `10:10:42`; anything else is NULL."""
    d = F.regexp_replace(F.trim(F.coalesce(col(date).cast("string"), F.lit(""))), "-", "")
    t = F.regexp_replace(F.trim(F.coalesce(col(time).cast("string"), F.lit(""))), ":", "")
    whole = F.regexp_extract(t, r"^(\d{6})(?:\.\d*)?$", 1)
    fraction = F.rpad(F.regexp_extract(t, r"^\d{6}\.(\d*)$", 1), 6, "0")
    valid = d.rlike(r"^\d{8}$") & (whole != "")
    text = F.concat_ws(" ", d, F.concat(whole, F.lit("."), fraction))
    return F.when(valid, F.try_to_timestamp(text, F.lit("yyyyMMdd HHmmss.SSSSSS")))


def normal_name(name: str | Column) -> Column:
    return F.regexp_replace(F.lower(col(name)), "[^0-9a-z]", "")


def identifying_field(name: str | Column) -> Column:
    """Canonical identifying field a name spells in any case or punctuation, or NULL."""
    table = F.create_map(
        *[x for f in IDENTIFYING_FIELDS for x in (F.lit("".join(ch for ch in f.lower() if ch.isalnum())), F.lit(f))]
    )
    return F.try_element_at(table, normal_name(name))


def searchable_value(value: str | Column) -> Column:
    """Whether an identifying value is long enough to be looked for in a text."""
    v = F.trim(col(value))
    digits = v.rlike(r"^[\d\-/.: ]+$")
    return (F.length(v) >= MIN_VALUE_LENGTH) & ~(digits & (F.length(v) < MIN_DIGITS_LENGTH))
