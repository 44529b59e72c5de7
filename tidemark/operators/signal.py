"""Signal-quality measures over voxel × frame data.

Input is one row per voxel with its frames as an array: `(run, voxel, series ARRAY<DOUBLE>)`. Measures of one voxel need
no shuffle; measures of a frame aggregate partially before the shuffle on (run, frame); ranks and medians over the voxels
of a run use the distributed order statistics, since one run may hold a large share of all voxels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import tails
from tidemark.functions.columns import count_if, finite
from tidemark.operators.quantiles import exact_quantiles, mid_ranks, with_quantiles
from tidemark.session import cut_lineage, measured


def series_of(long: DataFrame, keys: Sequence[str], frame: str = "frame", value: str = "value") -> DataFrame:
    """Long (keys, frame, value) rows to one array per voxel (as long as the run has frames)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(frame).alias("f"), F.col(value).cast("double").alias("v"))))
    return long.groupBy(*keys).agg(F.transform(pairs, lambda p: p["v"]).alias("series"))


def steady(series: str | Column, n_nss: str | Column | int) -> Column:
    """Frames after the non-steady-state ones."""
    s = F.col(series) if isinstance(series, str) else series
    skip = F.lit(n_nss) if isinstance(n_nss, int) else (F.col(n_nss) if isinstance(n_nss, str) else n_nss)
    skip = F.greatest(skip.cast("int"), F.lit(0))
    return F.slice(s, skip + 1, F.greatest(F.size(s) - skip, F.lit(0)))


def _mean(s: Column) -> Column:
    return F.aggregate(s, F.lit(0.0), lambda a, v: a + v) / F.size(s)


def _median(s: Column) -> Column:
    ordered, n = F.array_sort(s), F.size(s)
    lo, hi = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(ordered, lo) + F.get(ordered, hi)) / 2.0


def _moments(s: Column) -> Column:
    """(mean, sum of squared deviations) of a series in one pass. The lambda only uses its own accumulator: a column of the
    row named inside it could be inlined by the optimizer and then be recomputed for every frame."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("ss"))

    def add(a: Column, v: Column) -> Column:
        n = a["n"] + 1.0
        mean = a["mean"] + (v - a["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (a["ss"] + (v - a["mean"]) * (v - mean)).alias("ss"))

    return F.aggregate(s, start, add)


def voxel_moments(df: DataFrame, series: str = "series") -> DataFrame:
    """Adds `_mean` and `_ss` (sum of squared deviations) of each series. No shuffle."""
    m = df.withColumn("_m", _moments(F.col(series)))
    return m.withColumn("_mean", F.col("_m.mean")).withColumn("_ss", F.col("_m.ss")).drop("_m")


def tsnr(df: DataFrame, series: str = "series") -> DataFrame:
    """Temporal SNR per voxel: mean over population sd, 0 where the sd is 0."""
    m = df.withColumn("_m", _moments(F.col(series)))
    value = F.when(F.col("_m.ss") > 0, F.col("_m.mean") / F.sqrt(F.col("_m.ss") / F.col("_m.n"))).otherwise(0.0)
    return m.withColumn("tsnr", value).drop("_m")


def tsnr_median(df: DataFrame, run: Sequence[str], series: str = "series") -> DataFrame:
    return exact_quantiles(tsnr(df, series), run, "tsnr", {"tsnr_median": 0.5})


def global_correlation(df: DataFrame, run: Sequence[str], series: str = "series") -> DataFrame:
    """Squared length of the mean unit-length series; a constant voxel counts as the zero vector."""
    # named twice, so that the optimizer keeps the mean a column instead of recomputing it for every frame in the lambda
    varies = (F.col("_ss") > 0) & F.col("_mean").isNotNull()
    unit = F.transform(series, lambda v: F.when(varies, (v - F.col("_mean")) / F.sqrt("_ss")).otherwise(0.0))
    frames = voxel_moments(df, series).select(*run, F.posexplode(unit).alias("_f", "_u"))
    return frames.groupBy(*run, "_f").agg(F.avg("_u").alias("_m")).groupBy(*run).agg(F.sum(F.col("_m") * F.col("_m")).alias("gcor"))


def outlier_alpha(n_frames: int) -> float:
    """Multiple of the MAD beyond which a frame of a voxel is an outlier."""
    return math.sqrt(0.5 * math.pi) * float(tails.normal_ppf(1.0 - 0.001 / n_frames))


def outlier_fraction(df: DataFrame, run: Sequence[str], series: str = "series") -> DataFrame:
    """Share of voxels that are outliers, per run and frame. A voxel with MAD 0 has no outliers but is counted."""

    def alphas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(_alpha=[outlier_alpha(int(n)) for n in pdf["_n"]])

    lengths = df.select(F.size(series).alias("_n")).distinct()  # one row per run length
    table = lengths.mapInPandas(alphas, "_n int, _alpha double")
    x = df.withColumn("_n", F.size(series)).join(table, "_n")
    x = x.withColumn("_med", _median(F.col(series)))
    # the guard names the median a second time, which keeps it a column instead of a sort per frame
    x = x.withColumn("_abs", F.when(F.col("_med").isNotNull(), F.transform(series, lambda v: F.abs(v - F.col("_med")))))
    x = x.withColumn("_mad", _median(F.col("_abs")))
    out = F.transform("_abs", lambda v: F.when((F.col("_mad") > 0) & (v > F.col("_alpha") * F.col("_mad")), 1.0).otherwise(0.0))
    frames = x.select(*run, F.posexplode(out).alias("frame", "_o"))
    return frames.groupBy(*run, "frame").agg(F.avg("_o").alias("outlier_frac"))


def correlation_or_zero(x: str, y: str) -> Column:
    """Pearson correlation of the group, 0 where one side is constant."""
    return F.coalesce(F.nanvl(F.corr(x, y), F.lit(0.0)), F.lit(0.0))


def quality_index(df: DataFrame, run: Sequence[str], voxel: str = "voxel", series: str = "series") -> DataFrame:
    """1 − Spearman correlation between each frame and the median volume, per run and frame."""
    reference = mid_ranks(df.select(*run, voxel, _median(F.col(series)).alias("_med")), run, "_med", "_ref").drop("_med")
    frames = df.select(*run, voxel, F.posexplode(series).alias("frame", "_value"))
    ranked = mid_ranks(frames, [*run, "frame"], "_value", "_rank")
    joined = ranked.join(reference, [*run, voxel])
    return joined.groupBy(*run, "frame").agg((1.0 - correlation_or_zero("_rank", "_ref")).alias("quality_index"))


def motion_summary(confounds: DataFrame, run: Sequence[str], frame: str = "frame", n_nss: str = "n_nss_frames") -> DataFrame:
    """Motion and DVARS summary over the steady-state frames. Differences start one frame later: the first one inside the
    window is measured from outside it."""
    fd = F.when(F.col(frame) > F.col(n_nss), finite("framewise_displacement"))
    dv = F.when(F.col(frame) > F.col(n_nss), finite("dvars"))
    gs = F.when(F.col(frame) >= F.col(n_nss), finite("global_signal"))
    df = confounds.withColumn("_fd", fd)
    base = df.groupBy(*run).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.coalesce(F.avg("_fd"), F.lit(0.0)).alias("mean_fd"),
        F.coalesce(F.max("_fd"), F.lit(0.0)).alias("max_fd"),
        count_if(F.col("_fd") > 0.2).alias("n_fd_above_0p2"),
        count_if(F.col("_fd") > 0.5).alias("n_fd_above_0p5"),
        F.coalesce(100.0 * count_if(F.col("_fd") > 0.5) / F.when(F.count("_fd") > 0, F.count("_fd")), F.lit(0.0)).alias("pct_fd_above_0p5"),
        F.coalesce(F.avg(dv), F.lit(0.0)).alias("mean_dvars"),
        F.coalesce(F.avg(gs), F.lit(0.0)).alias("mean_global_signal"),
    )
    base = base.withColumn(
        "dvars_std",
        F.when(F.col("mean_global_signal") != 0, F.col("mean_dvars") / F.col("mean_global_signal") * 100).otherwise(0.0),
    )
    return with_quantiles(base, df, run, "_fd", {"median_fd": 0.5}).fillna(0.0, ["median_fd"])


def nss_lookup(runs: DataFrame, by_length: DataFrame, by_vendor: DataFrame) -> DataFrame:
    """Non-steady-state frames of each run: by (task, length) where tabulated, else by scanner software, else 0."""
    joined = runs.join(by_length.withColumnRenamed("nss", "_len"), ["vendor", "task", "n_frames"], "left")
    joined = joined.join(by_vendor.withColumnRenamed("nss", "_ven"), ["vendor", "software"], "left")
    return joined.withColumn("nss_frames", F.coalesce("_len", "_ven", F.lit(0))).drop("_len", "_ven")


def dvars_common_scale(confounds: DataFrame, run: Sequence[str], scale: float = 1000.0, out: str = "dvars_mean1000") -> DataFrame:
    """DVARS × 1000 over the run's mean global signal; NULL for the whole run if any frame of the signal is missing or the
    mean is not positive."""
    means = confounds.groupBy(*run).agg(
        F.when(F.count(finite("global_signal")) == F.count(F.lit(1)), F.avg("global_signal")).alias("_gs")
    )
    return confounds.join(means, list(run), "left").withColumn(
        out, F.when(F.col("_gs") > 0, finite("dvars") * scale / F.col("_gs"))
    ).drop("_gs")


def tissue_means(voxels: DataFrame, masks: DataFrame, run: Sequence[str], voxel: str, tissue: str, series: str = "series") -> DataFrame:
    """Mean over the voxels of each tissue mask per frame, with the mask's voxel count."""
    inside = voxels.join(masks, [*run, voxel])
    frames = inside.select(*run, tissue, F.posexplode(series).alias("frame", "_v"))
    return frames.groupBy(*run, tissue, "frame").agg(F.avg("_v").alias("mean_signal"), F.count(F.lit(1)).alias("n_voxels"))


def tissue_columns(
    voxels: DataFrame, masks: DataFrame, run: Sequence[str], voxel: str, tissue: str, tissues: Sequence[str], series: str = "series"
) -> DataFrame:
    """Per (run, tissue, frame) the mean signal, the mask's voxel count and the run's status, a row for every frame of every run.

    Statuses: `unavailable` (the run has no mask at all), `empty-mask` (a tissue has no voxel in the brain: its mean is NULL and
    its count 0), `ok`. Means of frames are partial aggregates; voxels meet masks in one join, and a run's frames are counted
    from the voxels themselves."""
    labelled = voxels.join(masks.select(*run, voxel, tissue).distinct(), [*run, voxel], "left")
    lengths = labelled.groupBy(*run).agg(F.max(F.size(series)).alias("_length"), *[count_if(F.col(tissue) == n).alias(f"_n{i}") for i, n in enumerate(tissues)])
    drawn = masks.select(*run).distinct().withColumn("_drawn", F.lit(True))
    empty = F.lit(False)
    for i in range(len(tissues)):
        empty = empty | (F.col(f"_n{i}") == 0)
    status = F.when(F.col("_drawn").isNull(), "unavailable").when(empty, "empty-mask").otherwise("ok")
    cells = F.array(*[F.struct(F.lit(n).alias(tissue), F.col(f"_n{i}").alias("n_voxels")) for i, n in enumerate(tissues)])
    grid = lengths.join(drawn, list(run), "left").select(*run, "_length", status.alias("status"), F.inline(cells))
    grid = grid.select(*run, tissue, "n_voxels", "status", F.explode(F.sequence(F.lit(0), F.col("_length") - 1)).alias("frame"))
    frames = labelled.filter(F.col(tissue).isin(*tissues)).select(*run, tissue, F.posexplode(series).alias("frame", "_v"))
    means = frames.groupBy(*run, tissue, "frame").agg(F.avg("_v").alias("mean_signal"))
    return grid.join(means, [*run, tissue, "frame"], "left").select(*run, tissue, "frame", "mean_signal", "n_voxels", "status")


def dice_by_label(a: DataFrame, b: DataFrame, keys: Sequence[str], voxel: str, label: str) -> DataFrame:
    """Dice overlap per label of two labelled voxel tables; two empty sets agree fully."""
    marked = a.select(*keys, voxel, label, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, voxel, label, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    per_voxel = marked.groupBy(*keys, label, voxel).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    total = F.sum(F.col("_a") + F.col("_b"))
    return per_voxel.groupBy(*keys, label).agg(
        F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b"),
        F.when(total > 0, 2.0 * F.sum(F.col("_a") * F.col("_b")) / total).otherwise(1.0).alias("dice"),
    )


def map_agreement(a: DataFrame, b: DataFrame, keys: Sequence[str], voxel: str, value: str, within: Column | None = None) -> DataFrame:
    """Correlation, correlation distance and absolute differences of two maps on one grid."""
    joined = a.select(*keys, voxel, F.col(value).alias("_a")).join(b.select(*keys, voxel, F.col(value).alias("_b")), [*keys, voxel])
    if within is not None:
        joined = joined.filter(within)
    x, y = finite("_a"), finite("_b")
    joined = joined.withColumn("_x", F.when(x.isNotNull() & y.isNotNull(), x)).withColumn("_y", F.when(x.isNotNull() & y.isNotNull(), y))
    d = F.abs(F.col("_a") - F.col("_b"))
    grouped = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_voxels"),
        F.corr("_x", "_y").alias("_r"),
        F.bool_and(F.col("_a") == F.col("_b")).alias("_same"),
        F.avg(d).alias("mean_abs_diff"),
        F.max(d).alias("max_abs_diff"),
        F.avg(F.when(d != 0, 1.0).otherwise(0.0)).alias("voxels_differ_frac"),
    )
    r = F.when(F.col("_r").isNotNull() & ~F.isnan("_r"), F.col("_r"))
    return grouped.withColumn("correlation", r).withColumn(
        "correlation_distance", F.when(F.col("_same"), 0.0).otherwise(1.0 - F.coalesce(r, F.lit(0.0)))
    ).drop("_r", "_same")


def mutual_information(df: DataFrame, keys: Sequence[str], a: str, b: str, bins: int = 64) -> DataFrame:
    """Mutual information (nats) and normalised mutual information from a joint histogram over voxels with a > 0.

    The histogram has bins² cells per image pair, so everything after the count is small."""
    x = df.filter(F.col(a) > 0).select(*keys, F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b"))
    span = x.groupBy(*keys).agg(*[f(c).alias(f"{c}_{n}") for c in ("_a", "_b") for n, f in (("lo", F.min), ("hi", F.max))])

    def bin_of(c: str) -> Column:
        width = F.col(f"{c}_hi") - F.col(f"{c}_lo")
        # a constant image spans one unit around its value
        return F.when(width > 0, F.least(F.floor((F.col(c) - F.col(f"{c}_lo")) / width * bins), F.lit(bins - 1))).otherwise(bins // 2)

    # one row per image pair meets its voxels where they are: a shuffle would put a pair's voxels into one task
    span = measured(cut_lineage(span))
    cells = x.join(span, list(keys)).groupBy(*keys, bin_of("_a").alias("_i"), bin_of("_b").alias("_j")).agg(F.count(F.lit(1)).alias("_c"))
    total = cells.groupBy(*keys).agg(F.sum("_c").alias("_n"))

    def entropy(by: Sequence[str], name: str) -> DataFrame:
        p = F.col("_c") / F.col("_n")
        counted = cells.groupBy(*keys, *by).agg(F.sum("_c").alias("_c")).join(total, list(keys))
        return counted.groupBy(*keys).agg((-F.sum(p * F.log(p))).alias(name))

    joined = entropy(["_i"], "h_a").join(entropy(["_j"], "h_b"), list(keys)).join(entropy(["_i", "_j"], "h_ab"), list(keys))
    return joined.withColumn("mi", F.col("h_a") + F.col("h_b") - F.col("h_ab")).withColumn(
        "nmi", F.when(F.col("h_ab") > 0, (F.col("h_a") + F.col("h_b")) / F.col("h_ab")).otherwise(0.0)
    )


def centroid_displacement(
    df: DataFrame, keys: Sequence[str], axes: Sequence[str], fixed: str, moved: str, affine: Sequence[Sequence[float]]
) -> DataFrame:
    """Distance between the intensity-weighted centroids of two images inside a mask (the rows). An image whose weight is 0
    falls back to the mask's own centroid; `affine` is the 3×3 part, offsets cancel."""
    aggs = []
    for name, w in (("f", fixed), ("m", moved)):
        total = F.sum(w)
        for axis in axes:
            aggs.append(F.coalesce(F.sum(F.col(axis) * F.col(w)) / F.when(total != 0, total), F.avg(axis)).alias(f"_{name}_{axis}"))
    grouped = df.groupBy(*keys).agg(*aggs)
    squared = F.lit(0.0)
    for row in affine:
        component = F.lit(0.0)
        for axis, c in zip(axes, row, strict=True):
            component = component + (F.col(f"_f_{axis}") - F.col(f"_m_{axis}")) * float(c)
        squared = squared + component * component
    return grouped.select(*keys, F.sqrt(squared).alias("centroid_displacement_mm"))


def rigid_displacement(points: DataFrame, keys: Sequence[str], axes: Sequence[str], matrix: Sequence[Sequence[float]]) -> DataFrame:
    """Mean and largest displacement of the points under a 4×4 rigid transform, and its rotation angle in degrees."""
    squared = F.lit(0.0)
    for i, axis in enumerate(axes):
        moved = F.lit(float(matrix[i][3]))
        for j, other in enumerate(axes):
            moved = moved + F.col(other) * float(matrix[i][j])
        squared = squared + (moved - F.col(axis)) * (moved - F.col(axis))
    cosine = min(1.0, max(-1.0, (sum(float(matrix[i][i]) for i in range(3)) - 1.0) / 2.0))
    d = F.sqrt(squared)
    return points.groupBy(*keys).agg(F.avg(d).alias("rigid_disp_mean_mm"), F.max(d).alias("rigid_disp_max_mm")).withColumn(
        "rigid_rot_deg", F.lit(math.degrees(math.acos(cosine)))
    )


def jacobian_summary(df: DataFrame, keys: Sequence[str], det: str) -> DataFrame:
    """Determinant and log-determinant statistics. Logs use positive determinants only (0 when there are none); a run
    without any finite determinant has NULL everywhere."""
    x = df.withColumn("_d", finite(det))
    x = x.withColumn("_l", F.when(F.col("_d") > 0, F.log("_d")))

    def zero(c: Column) -> Column:
        return F.when(F.count("_d") > 0, F.coalesce(c, F.lit(0.0)))

    def beyond(bound: float) -> Column:
        return count_if(F.abs(F.col("_l")) > bound) / F.when(F.count("_l") > 0, F.count("_l"))

    base = x.groupBy(*keys).agg(
        F.min("_d").alias("jac_det_min"), F.max("_d").alias("jac_det_max"), F.avg("_d").alias("jac_det_mean"),
        F.stddev_pop("_d").alias("jac_det_std"),
        (count_if(F.col("_d") < 0) / F.when(F.count("_d") > 0, F.count("_d"))).alias("jac_det_frac_negative"),
        zero(F.avg("_l")).alias("log_jac_mean"), zero(F.stddev_pop("_l")).alias("log_jac_std"),
        zero(F.min("_l")).alias("log_jac_min"), zero(F.max("_l")).alias("log_jac_max"),
        zero(beyond(1.5)).alias("log_jac_frac_beyond_1p5"), zero(beyond(3.0)).alias("log_jac_frac_beyond_3"),
    )
    out = with_quantiles(base, x, keys, "_l", {"log_jac_p01": 0.01, "log_jac_p99": 0.99})
    for c in ("log_jac_p01", "log_jac_p99"):
        out = out.withColumn(c, F.when(F.col("jac_det_mean").isNotNull(), F.coalesce(c, F.lit(0.0))))
    return out


def vertex_coverage(df: DataFrame, keys: Sequence[str], n_nss: int | str = 0, series: str = "series") -> DataFrame:
    """Vertices, share covered (not zero in every frame), share of NaN values, median tSNR of the covered vertices."""
    covered = F.exists(series, lambda v: F.isnan(v) | (v != 0))
    nans = F.size(F.filter(series, lambda v: F.isnan(v)))
    marked = df.withColumn("_cov", covered).withColumn("_nan", nans).withColumn("_len", F.size(series))
    measured = tsnr(marked.withColumn("_steady", steady(series, n_nss)), "_steady")
    base = measured.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_vertices"),
        F.avg(F.col("_cov").cast("double")).alias("coverage_frac"),
        (F.sum("_nan") / F.sum("_len")).alias("nan_frac"),
    )
    return with_quantiles(base, measured.filter("_cov"), keys, "tsnr", {"tsnr_median": 0.5}).fillna(0.0, ["tsnr_median"])


def temporal_agreement(
    a: DataFrame, b: DataFrame, keys: Sequence[str], vertex: str, n_nss: int = 0, series: str = "series", tail: int = 5
) -> DataFrame:
    """Per-vertex temporal correlation of two arms over the steady-state frames: percentiles over the vertices, the declared
    tail, and the correlation of the vertices' temporal means. A constant vertex correlates 0."""
    left = a.select(*keys, vertex, steady(series, n_nss).alias("_a"))
    right = b.select(*keys, vertex, steady(series, n_nss).alias("_b"))
    j = left.join(right, [*keys, vertex]).withColumn("_ma", _mean(F.col("_a"))).withColumn("_mb", _mean(F.col("_b")))
    pairs = F.zip_with("_a", "_b", lambda x, y: F.struct((x - F.col("_ma")).alias("x"), (y - F.col("_mb")).alias("y")))
    j = j.withColumn("_p", pairs)

    def total(fn):
        return F.aggregate("_p", F.lit(0.0), lambda acc, p: acc + fn(p))

    j = j.withColumn("_xy", total(lambda p: p["x"] * p["y"])).withColumn("_xx", total(lambda p: p["x"] * p["x"])).withColumn("_yy", total(lambda p: p["y"] * p["y"]))
    den = F.sqrt(F.col("_xx") * F.col("_yy"))
    j = j.withColumn("_r", F.when(den > 0, F.col("_xy") / den).otherwise(0.0)).drop("_p", "_a", "_b")
    base = j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_vertices"),
        correlation_or_zero("_ma", "_mb").alias("mean_agreement"),
        count_if(F.col("_xx") == 0).alias("n_constant_a"),
        count_if(F.col("_yy") == 0).alias("n_constant_b"),
    )
    probs = {f"p{p:02d}": p / 100 for p in (1, 5, 25, 50, 75, 95, 99)}
    out = with_quantiles(base, j, keys, "_r", probs)
    return out.withColumn("tail_correlation", F.col(f"p{tail:02d}"))


def cosine_basis(n_frames: int, timestep: float, period: float = 128.0) -> np.ndarray:
    """High-pass basis: the slow cosines of a DCT-II followed by a constant column."""
    order = max(int(math.floor(2 * n_frames * timestep / period)), 1)
    t = np.arange(n_frames) + 0.5
    k = np.arange(1, order)
    cosines = math.sqrt(2.0 / n_frames) * np.cos(np.pi / n_frames * np.outer(t, k))
    return np.column_stack([cosines, np.ones(n_frames)])


def noise_components(
    voxels: DataFrame, run: str, timestep: float, explained: float = 0.5, series: str = "series", period: float = 128.0
) -> DataFrame:
    """Leading noise components per run: high-pass filtered, variance-normalised series, as many left singular vectors as
    explain the wanted share of variance.

    The left singular vectors of frames × voxels are the eigenvectors of the frames × frames Gram matrix. Each task adds
    up the Gram matrix of its voxels, Spark sums the parts, and only that matrix (frames²) is decomposed per run."""
    run_type = voxels.schema[run].dataType.simpleString()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for value, part in pdf.groupby(run, sort=False):
                data = np.stack([np.asarray(s, dtype=np.float64) for s in part[series]])
                data[np.isnan(data).any(axis=1)] = 0.0
                basis = cosine_basis(data.shape[1], timestep, period)
                fitted = basis @ np.linalg.lstsq(basis, data.T, rcond=None)[0]
                m = data.T - fitted
                sd = m.std(axis=0)
                # a constant voxel leaves only rounding noise behind, which must not be scaled up to a signal
                flat = ~(sd > 1e-12 * np.maximum(np.abs(data).max(axis=1), 1e-300))
                m = np.where(flat, 0.0, m / np.where(flat, 1.0, sd))
                gram = m @ m.T
                i, j = np.triu_indices(gram.shape[0])
                yield pd.DataFrame({run: value, "_i": i.astype(np.int32), "_j": j.astype(np.int32), "_g": gram[i, j]})

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_j"].max()) + 1
        gram = np.zeros((n, n))
        gram[pdf["_i"], pdf["_j"]] = pdf["_g"]
        gram[pdf["_j"], pdf["_i"]] = pdf["_g"]
        values, vectors = np.linalg.eigh(gram)
        values, vectors = np.clip(values[::-1], 0.0, None), vectors[:, ::-1]
        share = np.cumsum(values) / values.sum()
        kept = int(np.searchsorted(share, explained) + 1)
        return pd.DataFrame(
            {
                run: [pdf[run].iloc[0]] * kept,
                "component": np.arange(kept, dtype=np.int32),
                "cumulative_variance": share[:kept],
                "vector": [vectors[:, c].tolist() for c in range(kept)],
            }
        )

    parts = voxels.select(run, series).mapInPandas(partial, f"{run} {run_type}, _i int, _j int, _g double")
    gram = parts.groupBy(run, "_i", "_j").agg(F.sum("_g").alias("_g"))
    return gram.groupBy(run).applyInPandas(
        decompose, f"{run} {run_type}, component int, cumulative_variance double, vector array<double>"
    )


def noisy_voxels(df: DataFrame, run: Sequence[str], series: str = "series", top: float = 0.02) -> DataFrame:
    """Voxels whose sd after a quadratic detrend is at or above the (1 − top) quantile of their run."""

    def detrended_sd(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sds = np.zeros(len(pdf))
            lengths = pdf[series].map(len).to_numpy()
            for length in np.unique(lengths):  # one product per series length in the batch
                where = np.flatnonzero(lengths == length)
                y = np.stack(pdf[series].to_numpy()[where]).astype(np.float64)
                trend, _ = np.linalg.qr(np.polynomial.legendre.legvander(np.linspace(-1, 1, length), 2))
                sds[where] = np.nan_to_num(np.std(y - (y @ trend) @ trend.T, axis=1), nan=0.0)
            yield pdf.drop(columns=[series]).assign(detrended_sd=sds)

    keep = [f for f in df.schema.fields if f.name != series]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    measured = df.mapInPandas(detrended_sd, f"{schema}, detrended_sd double")
    bound = exact_quantiles(measured, run, "detrended_sd", {"_bound": round(100 * (1 - top)) / 100})
    return measured.join(bound, list(run)).withColumn("selected", F.col("detrended_sd") >= F.col("_bound")).drop("_bound")


def orthonormal(matrix: np.ndarray, demean: bool) -> np.ndarray:
    m = np.asarray(matrix, dtype=np.float64)
    if demean and m.size:
        m = m - m.mean(axis=0)
    m = m[:, np.linalg.norm(m, axis=0) > 1e-12] if m.size else m
    if not m.size:
        return np.zeros((m.shape[0], 0))
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    return u[:, s > s[0] * 1e-10]


def subspace_agreement(a: DataFrame, b: DataFrame, keys: Sequence[str], vector: str = "vector", demean: bool = False) -> DataFrame:
    """Principal angles between two sets of component vectors per run, mean cosine, and 1 − mean squared cosine.

    A group is one run's components: a few vectors of as many values as the run has frames."""
    types = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    schema = ", ".join(f"{k} {types[k]}" for k in keys)
    schema += ", n_a int, n_b int, angles array<double>, similarity double, distance double"

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, y = (np.array(p[vector].tolist(), dtype=np.float64).T if len(p) else np.zeros((0, 0)) for p in (left, right))
        qa, qb = orthonormal(x, demean), orthonormal(y, demean)
        if qa.shape[1] and qb.shape[1]:
            cosines = np.clip(np.linalg.svd(qa.T @ qb, compute_uv=False), 0.0, 1.0)
            angles, similarity, distance = np.arccos(cosines).tolist(), float(cosines.mean()), float(1 - np.mean(cosines**2))
        else:
            angles, similarity = [], 0.0
            distance = 0.0 if not qa.shape[1] and not qb.shape[1] else 1.0
        row = dict(zip(keys, key, strict=True))
        row.update(n_a=len(left), n_b=len(right), angles=angles, similarity=similarity, distance=distance)
        return pd.DataFrame([row])

    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(compare, schema)


def tissue_volumes(voxels: DataFrame, keys: Sequence[str], label: str, classes: Mapping[str, int], voxel_mm3: float, pve: Sequence[str] = ()) -> DataFrame:
    """Volume per tissue class, and the share of a class's voxels whose most probable class agrees (NULL if absent).

    `pve` are the probability columns in the order of `classes`; the first largest wins."""
    aggs = [(count_if(F.col(label) == i) * voxel_mm3).alias(f"{name}_vol_mm3") for name, i in classes.items()]
    if pve:
        best = F.greatest(*pve)
        winner = None
        for column, i in zip(pve, classes.values(), strict=True):
            winner = F.when(F.col(column) == best, i) if winner is None else winner.when(F.col(column) == best, i)
        aggs += [
            F.avg(F.when(F.col(label) == i, F.when(winner == i, 1.0).otherwise(0.0))).alias(f"agreement_{name}")
            for name, i in classes.items()
        ]
    return voxels.groupBy(*keys).agg(*aggs)


def residual_summary(df: DataFrame, keys: Sequence[str], norm: str) -> DataFrame:
    """Mean, 95th and 99th percentile and maximum of residual norms; zeros where nothing was finite."""
    x = df.withColumn("_r", finite(norm))
    base = x.groupBy(*keys).agg(
        F.coalesce(F.avg("_r"), F.lit(0.0)).alias("ice_mean_mm"), F.coalesce(F.max("_r"), F.lit(0.0)).alias("ice_max_mm")
    )
    return with_quantiles(base, x, keys, "_r", {"ice_p95_mm": 0.95, "ice_p99_mm": 0.99}).fillna(0.0, ["ice_p95_mm", "ice_p99_mm"])


def framewise_displacement(
    motion: DataFrame, run: Sequence[str], frame: str, translations: Sequence[str], rotations: Sequence[str],
    degrees: bool = True, radius: float = 50.0, out: str = "framewise_displacement",
) -> DataFrame:
    """Σ|Δ| of the motion parameters, rotations as arc length on a sphere; NULL on a run's first frame.

    Frames are numbered, so the previous frame is an equi-join on its number: a run never has to fit one task."""
    columns = [*translations, *rotations]
    previous = motion.select(*run, (F.col(frame) + 1).alias(frame), *[F.col(c).alias(f"_p_{c}") for c in columns])
    per_degree = math.pi / 180.0 * radius if degrees else radius
    total = F.lit(0.0)
    for c in columns:
        total = total + F.abs(F.col(c) - F.col(f"_p_{c}")) * (per_degree if c in rotations else 1.0)
    joined = motion.join(previous, [*run, frame], "left").withColumn(out, total)
    return joined.drop(*[f"_p_{c}" for c in columns])


def confounds_frame(
    voxels: DataFrame, run: Sequence[str], n_nss: int | str, timestep: float, n_frames: int, series: str = "series", period: float = 128.0
) -> DataFrame:
    """Per frame: global signal, DVARS (rms of the voxels' differences to the frame before), steady-state flag, and the
    slow cosines over the steady-state frames (0 before them).

    Every run has the basis of its own length; `n_nss` is one count or the column that holds a run's. `n_frames`, the longest
    run, sets how many cosine columns there are: those a shorter run does not have are NULL in it, and a longer run raises."""
    skipped = F.col(n_nss) if isinstance(n_nss, str) else F.lit(n_nss)
    value = F.posexplode(
        F.transform(
            series,
            lambda v, i: F.struct(v.alias("v"), F.when(i > 0, F.pow(v - F.get(F.col(series), i - 1), 2)).alias("d")),
        )
    ).alias("frame", "_p")
    frames = voxels.select(*run, F.size(series).alias("_length"), skipped.alias("_skip"), value).groupBy(*run, "frame").agg(
        F.avg("_p.v").alias("global_signal"), F.sqrt(F.avg("_p.d")).alias("dvars"), F.max("_length").alias("_length"), F.max("_skip").alias("_skip")
    )
    fits = F.when(F.col("_length") <= n_frames, F.col("_length")).otherwise(F.raise_error(F.lit(f"a run is longer than {n_frames} frames")))
    out = frames.withColumn("non_steady_state", (F.col("frame") < F.col("_skip")).cast("int")).withColumn("_used", fits - F.col("_skip"))
    least = 0 if isinstance(n_nss, str) else n_nss
    order = F.greatest(F.floor(2 * F.col("_used") * timestep / period), F.lit(1))
    for k in range(cosine_basis(n_frames - least, timestep, period).shape[1] - 1):
        angle = F.lit(math.pi) / F.col("_used") * (k + 1) * (F.col("frame") - F.col("_skip") + 0.5)
        wave = F.when(F.col("frame") >= F.col("_skip"), F.sqrt(F.lit(2.0) / F.col("_used")) * F.cos(angle)).otherwise(0.0)
        out = out.withColumn(f"cosine_{k:02d}", F.when(F.lit(k + 1) < order, wave))
    return out.drop("_length", "_skip", "_used")


def motion_terms(motion: DataFrame, run: Sequence[str], frame: str, columns: Sequence[str]) -> DataFrame:
    """Each motion column with its difference to the frame before (`_derivative1`, NULL in the first frame) and the squares of both
    (`_power2`, `_derivative1_power2`). The previous frame is an equi-join on its number, as in :func:`framewise_displacement`."""
    before = motion.select(*run, (F.col(frame) + 1).alias(frame), *[F.col(c).alias(f"_p_{c}") for c in columns])
    joined = motion.join(before, [*run, frame], "left")
    terms = []
    for c in columns:
        d = F.col(c) - F.col(f"_p_{c}")
        terms += [F.col(c), d.alias(f"{c}_derivative1"), (F.col(c) * F.col(c)).alias(f"{c}_power2"), (d * d).alias(f"{c}_derivative1_power2")]
    return joined.select(*run, frame, *terms)


def full_confounds(
    voxels: DataFrame,
    motion: DataFrame,
    run: Sequence[str],
    n_nss: int | str,
    most_nss: int,
    timestep: float,
    n_frames: int,
    rotations: Sequence[str],
    translations: Sequence[str],
    series: str = "series",
    period: float = 128.0,
    radius: float = 50.0,
) -> DataFrame:
    """The whole confounds table, one row per frame: frame number, one column per non-steady-state frame (1 in it, 0 elsewhere),
    motion with derivatives and squares, framewise displacement, DVARS, global signal and slow cosines.

    `motion` has (run, frame, rotations in degrees, translations in mm). `most_nss`, the largest count of a run, sets how many
    indicator columns there are; those beyond a run's own count are NULL in it. A frame without motion has NULLs there. The
    frame before is joined once for the derivatives, and the displacement is the sum of their sizes."""
    columns = [*rotations, *translations]
    moved = motion_terms(motion.select(*run, "frame", *columns), run, "frame", columns)
    size = F.lit(0.0)
    for c in columns:
        size = size + F.abs(F.col(f"{c}_derivative1")) * (math.pi / 180.0 * radius if c in rotations else 1.0)
    moved = moved.withColumn("framewise_displacement", size)
    signal = confounds_frame(voxels, run, n_nss, timestep, n_frames, series, period)
    cosines = [c for c in signal.columns if c.startswith("cosine_")]
    terms = [c for c in moved.columns if c not in (*run, "frame")]
    count = F.sum("non_steady_state").over(Window.partitionBy(*run)) if isinstance(n_nss, str) else F.lit(n_nss)  # one row per frame of a run
    flags = [F.when(F.lit(i) < F.col("_nss"), (F.col("frame") == i).cast("int")).alias(f"non_steady_state_outlier_{i:02d}") for i in range(most_nss)]
    out = signal.withColumn("_nss", count).join(moved, [*run, "frame"], "left")
    return out.select(*run, F.col("frame").alias("t_indx"), *flags, *terms, "dvars", "global_signal", *cosines)
