"""What is done per session and run, from one pass over an object listing and the markers that steps leave."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col

# ---- fixed values: names of terminal files and surface routes ----------------------------------------------------
RUN_PARTS = {
    "b2t": r"^derivatives/registration/(sub-[^/]+)/(ses-[^/]+)/bold_to_t1w_[^/]+/\1_\2_(task-[^_/]+_run-[^_/]+)_desc-bold2t1w_itk\.txt$",
    "func_legacy": r"^derivatives/func/(sub-[^/]+)/(ses-[^/]+)/\1_\2_(task-[^_/]+_run-[^_/]+)_space-MNI152NLin2009cAsym_bold\.tar\.gz$",
    "components": r"^derivatives/func_surf/(sub-[^/]+)/(ses-[^/]+)/components/\1_\2_(task-[^_/]+_run-[^_/]+)_desc-grayordcomponents_bold\.tar\.gz$",
    "surf_fs": r"^derivatives/func_surf/(sub-[^/]+)/(ses-[^/]+)/fsLR32k/\1_\2_(task-[^_/]+_run-[^_/]+)_space-fsLR32k_bold\.dtseries\.nii$",
    "surf_newmsm": r"^derivatives/func_surf/(sub-[^/]+)/(ses-[^/]+)/fsLR32k/\1_\2_(task-[^_/]+_run-[^_/]+)_space-fsLR32k_desc-newmsm_bold\.dtseries\.nii$",
}
SESSION_PARTS = {"t1w_to_mni": r"^derivatives/registration/(sub-[^/]+)/(ses-[^/]+)/t1w_to_mni/\1_\2_desc-t1w2mni_affine\.mat$"}
FUNC_MARKER = "func-session"
#: What a run's flags mean, as conditions on the parts found. A finished surface proves its components, which are deleted once used.
RUN_RULES = {
    "fs": {
        "b2t_exists": "b2t", "func_exists": "func_listed OR func_legacy", "components_exist": "components", "surf_target_exists": "surf_fs OR surf_newmsm",
        "surf_exists": "components OR surf_fs OR surf_newmsm",
    },
    "newmsm": {
        "b2t_exists": "b2t", "func_exists": "func_listed OR func_legacy", "components_exist": "components", "surf_target_exists": "surf_newmsm",
        "surf_exists": "components OR surf_newmsm",
    },
}
# ---- end of fixed values ----------------------------------------------------------------------------------------


class InventoryError(LookupError):
    """A session has no entry in a lookup that its processing needs."""


def located(listing: DataFrame, path: str, parts: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """(names, part) of the keys that are one of `parts` (name -> pattern whose groups are `names`); other keys have no row.

    Only keys that begin like a pattern meet it, and the group texts are cut out once, behind a generator that is not repeated for
    each column read from it."""
    key = col(path)
    hits = []
    for part, p in parts.items():
        start = re.match(r"\^([\w/ -]*)(?![\w/ -]|[?*{])|", p)[1] or ""
        mine = key.startswith(start) & key.rlike(p) if start and "|" not in p else key.rlike(p)
        hits.append(F.when(mine, F.struct(*[F.regexp_extract(key, p, i + 1).alias(n) for i, n in enumerate(names)], F.lit(part).alias("part"))))
    return listing.select(F.inline(F.array_compact(F.array(F.coalesce(*hits)))))


def listed_runs(markers: DataFrame, kind: str = FUNC_MARKER, part: str = "func_listed") -> DataFrame:
    """(subject, session, run, part) of the runs that markers of `kind` list; a marker of another kind lists none."""
    mine = markers.filter(F.col("kind") == kind)
    return mine.select("subject", "session", F.explode("runs").alias("run"), F.lit(part).alias("part"))


def judged(units: DataFrame, evidence: DataFrame, keys: Sequence[str], parts: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """`units` with one flag per rule. Rules are conditions (AND, OR, NOT) on part names; all parts are collected in one grouping of
    the evidence, and a unit without any evidence has none of them."""
    keys = list(keys)
    flags = evidence.groupBy(*keys).agg(*[F.bool_or(F.col("part") == p).alias(p) for p in parts])
    joined = units.join(flags, keys, "left").fillna(False, list(parts))
    return joined.select(*units.columns, *[F.expr(rule).alias(name) for name, rule in rules.items()])


def run_inventory(runs: DataFrame, listing: DataFrame, markers: DataFrame, route: str = "fs", path: str = "path") -> DataFrame:
    """`runs` (subject, session, run) with the flags of :data:`RUN_RULES`. The route decides which surface counts: a newMSM one
    satisfies `fs` too, an FS one does not satisfy `newmsm`. Markers say what is finished; the legacy object is their fallback."""
    if route not in RUN_RULES:
        raise ValueError(f"unknown surface route {route!r}; expected one of {tuple(RUN_RULES)}")
    keys = ["subject", "session", "run"]
    evidence = located(listing, path, RUN_PARTS, keys).unionByName(listed_runs(markers))
    return judged(runs.distinct(), evidence, keys, [*RUN_PARTS, "func_listed"], RUN_RULES[route])


def session_inventory(
    sessions: DataFrame, listing: DataFrame, lookup: DataFrame, published: DataFrame, excluded: DataFrame | None = None, path: str = "path"
) -> DataFrame:
    """(subject, session, t1w_to_mni_exists, t1w_available, excluded, nss_frames, published, rejected).

    `sessions`: subject, session, has_t1w. An excluded session stays in the list without its T1w. A candidate (T1w available) without a
    published anatomy is rejected; a session without T1w is neither. Raises :class:`InventoryError` for sessions that `lookup`
    (subject, session, nss_frames) does not name; an empty entry is kept as it is."""
    keys = ["subject", "session"]
    lacking = sessions.join(lookup, keys, "left_anti").select(*keys).orderBy(*keys).limit(5).collect()
    if lacking:
        raise InventoryError("no nss_frames entry for " + ", ".join(f"{r['subject']}/{r['session']}" for r in lacking))
    found = judged(sessions, located(listing, path, SESSION_PARTS, keys), keys, list(SESSION_PARTS), {"t1w_to_mni_exists": "t1w_to_mni"})
    marks = {"published": published, "excluded": excluded}
    for name, marked in marks.items():
        if marked is None:
            found = found.withColumn(name, F.lit(False))
        else:
            found = found.join(marked.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").fillna(False, [name])
    entries = lookup.groupBy(*keys).agg(F.max("nss_frames").alias("nss_frames"))
    available: Column = F.col("has_t1w") & ~F.col("excluded")
    return found.join(entries, keys).select(
        *keys, "t1w_to_mni_exists", available.alias("t1w_available"), "excluded", "nss_frames", (available & F.col("published")).alias("published"),
        (available & ~F.col("published")).alias("rejected"),
    )


def unknown_sessions(excluded: DataFrame, sessions: DataFrame) -> DataFrame:
    """Excluded sessions that are not staged: reported, since an exclusion that names nothing is a slip."""
    return excluded.join(sessions, ["subject", "session"], "left_anti")
