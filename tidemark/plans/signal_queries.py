"""Signal measures over the vectors: a vector is a voxel, its elements are the frames, its label the run."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemark.operators import signal as S
from tidemark.plans.registry import query, rounded

_V = """
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS s FROM embeddings),
    l AS (SELECT vec_id, label, unnest(range(0, len(s))) AS frame, unnest(s) AS x FROM v)"""


def _voxels(t):
    return t.embeddings.select(F.col("vec_id").alias("voxel"), "label", F.transform("embedding", lambda x: x.cast("double")).alias("series"))


@query(
    "v1_tsnr_map",
    _V + " SELECT vec_id AS voxel, ROUND(CASE WHEN STDDEV_POP(x) > 0 THEN AVG(x) / STDDEV_POP(x) ELSE 0 END, 8) AS tsnr FROM l GROUP BY vec_id",
)
def tsnr_map(t):
    return rounded(S.tsnr(_voxels(t)).select("voxel", "tsnr"), 8)


@query(
    "v1_tsnr_median",
    _V
    + """, m AS (SELECT label, vec_id, CASE WHEN STDDEV_POP(x) > 0 THEN AVG(x) / STDDEV_POP(x) ELSE 0 END AS tsnr FROM l GROUP BY ALL)
         SELECT label, ROUND(QUANTILE_CONT(tsnr, 0.5), 8) AS tsnr_median FROM m GROUP BY label""",
)
def tsnr_median(t):
    return rounded(S.tsnr_median(_voxels(t), ["label"]), 8)


@query(
    "v2_global_correlation",
    _V
    + """, m AS (SELECT label, vec_id, frame, x - AVG(x) OVER (PARTITION BY vec_id) AS d, VAR_POP(x) OVER (PARTITION BY vec_id) * COUNT(*) OVER (PARTITION BY vec_id) AS ss FROM l),
         f AS (SELECT label, frame, AVG(CASE WHEN ss > 0 THEN d / sqrt(ss) ELSE 0 END) AS u FROM m GROUP BY ALL)
         SELECT label, ROUND(SUM(u * u), 9) AS gcor FROM f GROUP BY label""",
)
def global_correlation(t):
    return rounded(S.global_correlation(_voxels(t), ["label"]), 9)


@query(
    "v3_outlier_fraction",
    _V
    + f""", n AS (SELECT label, vec_id, frame, abs(x - MEDIAN(x) OVER (PARTITION BY vec_id)) AS d FROM l),
         m AS (SELECT *, MEDIAN(d) OVER (PARTITION BY vec_id) AS mad FROM n)
         SELECT label, frame, ROUND(AVG(CASE WHEN mad > 0 AND d > {S.outlier_alpha(64)!r} * 0.5 * mad THEN 1.0 ELSE 0.0 END), 9) AS outlier_frac FROM m GROUP BY ALL""".replace(
        " * 0.5 * mad", " * mad"
    ),
)
def outlier_fraction(t):
    return rounded(S.outlier_fraction(_voxels(t), ["label"]), 9)


@query(
    "v4_quality_index",
    _V
    + """, m AS (SELECT label, vec_id, MEDIAN(x) AS med FROM l GROUP BY ALL),
         r AS (SELECT label, vec_id, RANK() OVER (PARTITION BY label ORDER BY med) + (COUNT(*) OVER (PARTITION BY label, med) - 1) / 2.0 AS ref FROM m),
         k AS (SELECT label, vec_id, frame, RANK() OVER (PARTITION BY label, frame ORDER BY x) + (COUNT(*) OVER (PARTITION BY label, frame, x) - 1) / 2.0 AS rk FROM l)
         SELECT label, frame, ROUND(1 - CORR(rk, ref), 9) AS quality_index FROM k JOIN r USING (label, vec_id) GROUP BY ALL""",
)
def quality_index(t):
    return rounded(S.quality_index(_voxels(t), ["label"]), 9)


_CONF = """
    WITH c AS (SELECT l_orderkey AS run, l_linenumber AS frame, AVG(l_discount) * 7 AS fd, AVG(l_quantity) AS dv, AVG(l_extendedprice) AS gs FROM lineitem GROUP BY ALL)"""


def _confounds(t):
    return t.lineitem.groupBy(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("frame")).agg(
        (F.avg("l_discount") * 7).alias("framewise_displacement"),
        F.avg("l_quantity").alias("dvars"),
        F.avg("l_extendedprice").alias("global_signal"),
        F.lit(1).alias("n_nss_frames"),
    )


@query(
    "v5_motion_summary",
    _CONF
    + """, s AS (SELECT run, COUNT(*) AS n_frames, AVG(fd) FILTER (frame > 1) AS mf, MAX(fd) FILTER (frame > 1) AS xf, COUNT(*) FILTER (frame > 1 AND fd > 0.2) AS a2,
                COUNT(*) FILTER (frame > 1 AND fd > 0.5) AS a5, COUNT(*) FILTER (frame > 1) AS n, AVG(dv) FILTER (frame > 1) AS md, AVG(gs) FILTER (frame >= 1) AS mg, QUANTILE_CONT(fd, 0.5) FILTER (frame > 1) AS qf FROM c GROUP BY run)
         SELECT run, n_frames, ROUND(COALESCE(mf, 0), 8) AS mean_fd, ROUND(COALESCE(xf, 0), 8) AS max_fd, a2 AS n_fd_above_0p2, a5 AS n_fd_above_0p5, ROUND(COALESCE(100.0 * a5 / NULLIF(n, 0), 0), 8) AS pct_fd_above_0p5,
                ROUND(COALESCE(md, 0), 8) AS mean_dvars, ROUND(COALESCE(mg, 0), 8) AS mean_global_signal, ROUND(CASE WHEN mg <> 0 THEN COALESCE(md, 0) / mg * 100 ELSE 0 END, 8) AS dvars_std, ROUND(COALESCE(qf, 0), 8) AS median_fd FROM s""",
)
def motion_summary(t):
    return rounded(S.motion_summary(_confounds(t), ["run"]), 8)


@query(
    "v6_nss_lookup",
    """
    WITH r AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'GE' ELSE 'S' END AS vendor, l_linestatus AS software, l_linenumber AS task, l_suppkey % 10 AS n_frames FROM lineitem)
    SELECT vendor, software, nss_frames, COUNT(*) AS n FROM (SELECT *, CASE WHEN vendor = 'GE' AND task <= 3 AND n_frames < 5 THEN task * 10 + n_frames WHEN vendor = 'GE' AND software = 'F' THEN 16
        WHEN vendor = 'S' AND software = 'O' THEN 8 ELSE 0 END AS nss_frames FROM r) GROUP BY ALL""",
)
def nss_lookup(t):
    li = t.lineitem
    runs = li.select(
        F.when(F.col("l_returnflag") == "A", "GE").otherwise("S").alias("vendor"), F.col("l_linestatus").alias("software"),
        F.col("l_linenumber").alias("task"), (F.col("l_suppkey") % 10).alias("n_frames"),
    )
    by_length = runs.filter((F.col("vendor") == "GE") & (F.col("task") <= 3) & (F.col("n_frames") < 5)).select("vendor", "task", "n_frames").distinct()
    by_length = by_length.withColumn("nss", F.col("task") * 10 + F.col("n_frames"))
    known = ((F.col("vendor") == "GE") & (F.col("software") == "F")) | ((F.col("vendor") == "S") & (F.col("software") == "O"))
    by_vendor = runs.filter(known).select("vendor", "software").distinct().withColumn("nss", F.when(F.col("vendor") == "GE", 16).otherwise(8).cast("long"))
    return S.nss_lookup(runs, by_length, by_vendor).groupBy("vendor", "software", "nss_frames").agg(F.count(F.lit(1)).alias("n"))


@query(
    "v7_dvars_common_scale",
    _CONF
    + """, g AS (SELECT run, CASE WHEN COUNT(*) FILTER (frame = 7) = 0 THEN AVG(gs) END AS m FROM c GROUP BY run)
         SELECT run, frame, ROUND(CASE WHEN m > 0 THEN dv * 1000 / m END, 9) AS dvars_mean1000 FROM c JOIN g USING (run)""",
)
def dvars_common_scale(t):
    """The signal of frame 7 is missing, which leaves the whole run without a scale."""
    c = _confounds(t).withColumn("global_signal", F.when(F.col("frame") != 7, F.col("global_signal")))
    return rounded(S.dvars_common_scale(c, ["run"]).select("run", "frame", "dvars_mean1000"), 9)


@query(
    "v8_tissue_means",
    _V
    + """ SELECT label, CASE WHEN vec_id % 3 = 0 THEN 'wm' ELSE 'csf' END AS tissue, frame, ROUND(AVG(x), 9) AS mean_signal, COUNT(*) AS n_voxels FROM l WHERE vec_id % 5 <> 0 GROUP BY ALL""",
)
def tissue_means(t):
    v = _voxels(t)
    masks = v.filter(F.col("voxel") % 5 != 0).select(
        "label", "voxel", F.when(F.col("voxel") % 3 == 0, "wm").otherwise("csf").alias("tissue")
    )
    return rounded(S.tissue_means(v, masks, ["label"], "voxel", "tissue"), 9)


@query(
    "v8_tissue_columns",
    _V
    + """,
    m AS (SELECT vec_id, label, CASE WHEN vec_id % 3 = 0 THEN 'wm' ELSE 'csf' END AS tissue FROM embeddings WHERE label % 4 <> 0 AND vec_id % 5 <> 0 AND NOT (label % 4 = 1 AND vec_id % 3 <> 0)),
    g AS (SELECT label, tissue, frame FROM (SELECT DISTINCT label, frame FROM l), (SELECT unnest(['wm', 'csf']) AS tissue)),
    c AS (SELECT label, tissue, COUNT(*) AS n FROM m GROUP BY ALL), k AS (SELECT label, COUNT(*) AS k FROM c GROUP BY label),
    a AS (SELECT l.label, m.tissue, l.frame, AVG(x) AS mean FROM l JOIN m ON l.vec_id = m.vec_id AND l.label = m.label GROUP BY ALL)
    SELECT g.label, g.tissue, g.frame, ROUND(mean, 9) AS mean_signal, COALESCE(n, 0) AS n_voxels, CASE WHEN k IS NULL THEN 'unavailable' WHEN k < 2 THEN 'empty-mask' ELSE 'ok' END AS status
    FROM g LEFT JOIN a USING (label, tissue, frame) LEFT JOIN c ON c.label = g.label AND c.tissue = g.tissue LEFT JOIN k ON k.label = g.label""",
)
def tissue_columns(t):
    """Every fourth label has no masks, another fourth only one of the two tissues."""
    v = _voxels(t)
    label, voxel = F.col("label"), F.col("voxel")
    drawn = v.filter((label % 4 != 0) & (voxel % 5 != 0) & ~((label % 4 == 1) & (voxel % 3 != 0)))
    masks = drawn.select("label", "voxel", F.when(voxel % 3 == 0, "wm").otherwise("csf").alias("tissue"))
    return rounded(S.tissue_columns(v, masks, ["label"], "voxel", "tissue", ["wm", "csf"]), 9)


@query(
    "v9_dice_by_label",
    """
    WITH a AS (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem WHERE l_linestatus = 'F'), b AS (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem WHERE l_linestatus = 'O' AND l_quantity > 25)
    SELECT COALESCE(a.l_returnflag, b.l_returnflag) AS l_returnflag, COUNT(a.l_partkey) AS n_a, COUNT(b.l_partkey) AS n_b,
           ROUND(2.0 * COUNT(CASE WHEN a.l_partkey = b.l_partkey THEN 1 END) / (COUNT(a.l_partkey) + COUNT(b.l_partkey)), 9) AS dice
    FROM a FULL JOIN b ON a.l_returnflag = b.l_returnflag AND a.l_partkey = b.l_partkey GROUP BY 1""",
)
def dice_by_label(t):
    a = t.lineitem.filter(F.col("l_linestatus") == "F")
    b = t.lineitem.filter((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 25))
    return rounded(S.dice_by_label(a, b, [], "l_partkey", "l_returnflag"), 9)


_MAPS = """
    WITH a AS (SELECT l_partkey, l_linenumber AS g, AVG(l_extendedprice) AS x FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL), b AS (SELECT l_partkey, l_linenumber AS g, AVG(l_extendedprice) AS x FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL),
    j AS (SELECT g, l_partkey, a.x AS x, b.x AS y FROM a JOIN b USING (g, l_partkey))"""


def _maps(t):
    return tuple(
        t.lineitem.filter(F.col("l_linestatus") == s).groupBy(F.col("l_linenumber").alias("g"), "l_partkey").agg(F.avg("l_extendedprice").alias("x"))
        for s in "FO"
    )


@query(
    "v10_map_agreement",
    _MAPS
    + """ SELECT g, COUNT(*) AS n_voxels, ROUND(CORR(x, y), 8) AS correlation, ROUND(1 - CORR(x, y), 8) AS correlation_distance, ROUND(AVG(abs(x - y)), 5) AS mean_abs_diff, ROUND(MAX(abs(x - y)), 5) AS max_abs_diff,
                 ROUND(AVG(CASE WHEN x <> y THEN 1.0 ELSE 0.0 END), 8) AS voxels_differ_frac FROM j GROUP BY g""",
)
def map_agreement(t):
    a, b = _maps(t)
    return rounded(S.map_agreement(a, b, ["g"], "l_partkey", "x"), 8, mean_abs_diff=5, max_abs_diff=5)


@query(
    "v11_mutual_information",
    """
    WITH x AS (SELECT l_returnflag AS g, l_quantity AS a, l_extendedprice AS b FROM lineitem WHERE l_quantity > 0),
    s AS (SELECT g, MIN(a) AS al, MAX(a) AS ah, MIN(b) AS bl, MAX(b) AS bh, COUNT(*) AS n FROM x GROUP BY g),
    c AS (SELECT g, n, LEAST(floor((a - al) / (ah - al) * 64), 63) AS i, LEAST(floor((b - bl) / (bh - bl) * 64), 63) AS j FROM x JOIN s USING (g)),
    h AS (SELECT g, i, j, COUNT(*) AS c, MAX(n) AS n FROM c GROUP BY ALL), ha AS (SELECT g, -SUM(p * ln(p)) AS h FROM (SELECT g, i, SUM(c) / MAX(n) AS p FROM h GROUP BY ALL) GROUP BY g),
    hb AS (SELECT g, -SUM(p * ln(p)) AS h FROM (SELECT g, j, SUM(c) / MAX(n) AS p FROM h GROUP BY ALL) GROUP BY g), hab AS (SELECT g, -SUM(c / n * ln(c / n)) AS h FROM h GROUP BY g)
    SELECT g, ROUND(ha.h, 8) AS h_a, ROUND(hb.h, 8) AS h_b, ROUND(hab.h, 8) AS h_ab, ROUND(ha.h + hb.h - hab.h, 8) AS mi, ROUND((ha.h + hb.h) / hab.h, 8) AS nmi FROM ha JOIN hb USING (g) JOIN hab USING (g)""",
)
def mutual_information(t):
    return rounded(S.mutual_information(t.lineitem.withColumnRenamed("l_returnflag", "g"), ["g"], "l_quantity", "l_extendedprice"), 8)


@query(
    "v12_centroid_displacement",
    """
    WITH c AS (SELECT l_returnflag AS g, SUM(l_linenumber * l_quantity) / SUM(l_quantity) - SUM(l_linenumber * l_tax) / SUM(l_tax) AS dx, SUM(l_partkey * l_quantity) / SUM(l_quantity) - SUM(l_partkey * l_tax) / SUM(l_tax) AS dy,
                      SUM(l_suppkey * l_quantity) / SUM(l_quantity) - SUM(l_suppkey * l_tax) / SUM(l_tax) AS dz FROM lineitem GROUP BY 1)
    SELECT g, ROUND(sqrt(power(2 * dx, 2) + power(2 * dy, 2) + power(2 * dz + 0.5 * dx, 2)), 6) AS centroid_displacement_mm FROM c""",
)
def centroid_displacement(t):
    df = t.lineitem.withColumnRenamed("l_returnflag", "g")
    axes = ["l_linenumber", "l_partkey", "l_suppkey"]
    return rounded(S.centroid_displacement(df, ["g"], axes, "l_quantity", "l_tax", [[2, 0, 0], [0, 2, 0], [0.5, 0, 2]]), 6)


_ANGLE = math.radians(5.0)
_RIGID = [[math.cos(_ANGLE), -math.sin(_ANGLE), 0, 1.5], [math.sin(_ANGLE), math.cos(_ANGLE), 0, -2.0], [0, 0, 1, 0.25], [0, 0, 0, 1]]


@query(
    "v13_rigid_displacement",
    f"""
    WITH p AS (SELECT l_returnflag AS g, l_linenumber * 1.0 AS x, l_quantity AS y, l_suppkey * 1.0 AS z FROM lineitem),
    d AS (SELECT g, sqrt(power({_RIGID[0][0]!r} * x + {_RIGID[0][1]!r} * y + 1.5 - x, 2) + power({_RIGID[1][0]!r} * x + {_RIGID[1][1]!r} * y - 2.0 - y, 2) + 0.0625) AS d FROM p)
    SELECT g, ROUND(AVG(d), 8) AS rigid_disp_mean_mm, ROUND(MAX(d), 8) AS rigid_disp_max_mm, 5.0 AS rigid_rot_deg FROM d GROUP BY g""",
)
def rigid_displacement(t):
    p = t.lineitem.withColumnRenamed("l_returnflag", "g")
    return rounded(S.rigid_displacement(p, ["g"], ["l_linenumber", "l_quantity", "l_suppkey"], _RIGID), 8)


@query(
    "v14_jacobian_summary",
    """
    WITH d AS (SELECT l_linenumber AS g, CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE (l_quantity - 3) / 10 END AS d FROM lineitem), l AS (SELECT g, d, CASE WHEN d > 0 THEN ln(d) END AS l FROM d)
    SELECT g, ROUND(MIN(d), 8) AS jac_det_min, ROUND(MAX(d), 8) AS jac_det_max, ROUND(AVG(d), 8) AS jac_det_mean, ROUND(STDDEV_POP(d), 8) AS jac_det_std, ROUND(COUNT(*) FILTER (d < 0) / COUNT(d), 8) AS jac_det_frac_negative,
           ROUND(AVG(l), 8) AS log_jac_mean, ROUND(STDDEV_POP(l), 8) AS log_jac_std, ROUND(MIN(l), 8) AS log_jac_min, ROUND(MAX(l), 8) AS log_jac_max, ROUND(COUNT(*) FILTER (abs(l) > 1.5) / COUNT(l), 8) AS log_jac_frac_beyond_1p5,
           ROUND(COUNT(*) FILTER (abs(l) > 3) / COUNT(l), 8) AS log_jac_frac_beyond_3, ROUND(QUANTILE_CONT(l, 0.01), 8) AS log_jac_p01, ROUND(QUANTILE_CONT(l, 0.99), 8) AS log_jac_p99 FROM l GROUP BY g""",
)
def jacobian_summary(t):
    det = F.when(F.col("l_suppkey") % 50 != 0, (F.col("l_quantity") - 3) / 10).otherwise(F.lit(float("nan")))
    return rounded(S.jacobian_summary(t.lineitem.select(F.col("l_linenumber").alias("g"), det.alias("det")), ["g"], "det"), 8)


@query(
    "v15_vertex_coverage",
    """
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS s FROM embeddings),
    l AS (SELECT vec_id, label, frame, CASE WHEN vec_id % 7 = 0 THEN 0.0 ELSE x END AS x FROM (SELECT vec_id, label, unnest(range(0, len(s))) AS frame, unnest(s) AS x FROM v)),
    m AS (SELECT label, vec_id, BOOL_OR(x <> 0) AS cov, CASE WHEN STDDEV_POP(x) FILTER (frame >= 4) > 0 THEN AVG(x) FILTER (frame >= 4) / STDDEV_POP(x) FILTER (frame >= 4) ELSE 0 END AS t FROM l GROUP BY ALL)
    SELECT label, COUNT(*) AS n_vertices, ROUND(AVG(CASE WHEN cov THEN 1.0 ELSE 0.0 END), 8) AS coverage_frac, 0.0 AS nan_frac, ROUND(QUANTILE_CONT(t, 0.5) FILTER (cov), 8) AS tsnr_median FROM m GROUP BY label""",
)
def vertex_coverage(t):
    v = _voxels(t).withColumn("series", F.when(F.col("voxel") % 7 == 0, F.transform("series", lambda x: F.lit(0.0))).otherwise(F.col("series")))
    return rounded(S.vertex_coverage(v, ["label"], 4), 8)


@query(
    "v16_temporal_agreement",
    _V
    + """, p AS (SELECT label, vec_id // 2 AS vertex, frame, MAX(x) FILTER (vec_id % 2 = 0) AS a, MAX(x) FILTER (vec_id % 2 = 1) AS b FROM l WHERE frame >= 4 GROUP BY ALL HAVING COUNT(*) = 2),
         c AS (SELECT label, vertex, CORR(a, b) AS r, AVG(a) AS ma, AVG(b) AS mb FROM p GROUP BY ALL)
         SELECT label, COUNT(*) AS n_vertices, ROUND(CASE WHEN isnan(CORR(ma, mb)) THEN 0 ELSE COALESCE(CORR(ma, mb), 0) END, 8) AS mean_agreement, 0 AS n_constant_a, 0 AS n_constant_b, """
    + ", ".join(f"ROUND(QUANTILE_CONT(r, {p / 100}), 8) AS p{p:02d}" for p in (1, 5, 25, 50, 75, 95, 99))
    + ", ROUND(QUANTILE_CONT(r, 0.05), 8) AS tail_correlation FROM c GROUP BY label",
)
def temporal_agreement(t):
    """Arms: neighbouring vectors of one label (even and odd number) stand for one vertex in both arms."""
    v = _voxels(t).withColumn("vertex", F.floor(F.col("voxel") / 2))
    a, b = (v.filter(F.col("voxel") % 2 == i).select("label", "vertex", "series") for i in (0, 1))
    return rounded(S.temporal_agreement(a, b, ["label"], "vertex", 4), 8)


@query("v17_noise_components")
def noise_components(t):
    out = S.noise_components(_voxels(t), "label", 0.8, period=8.0)
    return rounded(out.select("label", "component", "cumulative_variance"), 8)


@query(
    "v17_noisy_voxels",
    _V
    + """, r AS (SELECT vec_id, label, x, -1 + 2.0 * frame / (COUNT(*) OVER (PARTITION BY vec_id) - 1) AS t FROM l),
         m AS (SELECT vec_id, label, AVG(x) AS mean, AVG(t * t) AS tt, SUM(x * t) / SUM(t * t) AS slope FROM r GROUP BY ALL),
         c AS (SELECT vec_id, SUM(x * (t * t - tt)) / SUM((t * t - tt) * (t * t - tt)) AS bend FROM r JOIN m USING (vec_id) GROUP BY vec_id),
         d AS (SELECT r.vec_id, r.label, STDDEV_POP(x - mean - slope * t - bend * (t * t - tt)) AS sd
               FROM r JOIN m USING (vec_id) JOIN c USING (vec_id) GROUP BY ALL),
         b AS (SELECT label, quantile_cont(sd, 0.98) AS bound FROM d GROUP BY label)
         SELECT vec_id AS voxel, d.label, ROUND(sd, 8) AS detrended_sd, TRUE AS selected FROM d JOIN b USING (label) WHERE sd >= bound""",
)
def noisy_voxels(t):
    return rounded(S.noisy_voxels(_voxels(t), ["label"]).filter("selected"), 8)


@query("v18_subspace_agreement")
def subspace_agreement(t):
    v = _voxels(t)
    a, b = (S.noise_components(v.filter(F.col("voxel") % 2 == i), "label", 0.8, period=8.0) for i in (0, 1))
    return rounded(S.subspace_agreement(a, b, ["label"]).drop("angles"), 6)


@query(
    "v19_tissue_volumes",
    """
    WITH v AS (SELECT l_returnflag AS g, l_linenumber % 3 + 1 AS c, l_quantity AS p1, l_tax * 400 AS p2, l_discount * 300 AS p3 FROM lineitem), w AS (SELECT *, CASE WHEN p1 >= p2 AND p1 >= p3 THEN 1 WHEN p2 >= p3 THEN 2 ELSE 3 END AS w FROM v)
    SELECT g, COUNT(*) FILTER (c = 1) * 8.0 AS gm_vol_mm3, COUNT(*) FILTER (c = 2) * 8.0 AS wm_vol_mm3, COUNT(*) FILTER (c = 3) * 8.0 AS csf_vol_mm3, ROUND(AVG(CASE WHEN w = 1 THEN 1.0 ELSE 0.0 END) FILTER (c = 1), 8) AS agreement_gm,
           ROUND(AVG(CASE WHEN w = 2 THEN 1.0 ELSE 0.0 END) FILTER (c = 2), 8) AS agreement_wm, ROUND(AVG(CASE WHEN w = 3 THEN 1.0 ELSE 0.0 END) FILTER (c = 3), 8) AS agreement_csf FROM w GROUP BY g""",
)
def tissue_volumes(t):
    v = t.lineitem.select(
        F.col("l_returnflag").alias("g"), (F.col("l_linenumber") % 3 + 1).alias("c"),
        F.col("l_quantity").alias("p1"), (F.col("l_tax") * 400).alias("p2"), (F.col("l_discount") * 300).alias("p3"),
    )
    return rounded(S.tissue_volumes(v, ["g"], "c", {"gm": 1, "wm": 2, "csf": 3}, 8.0, ["p1", "p2", "p3"]), 8)


@query(
    "v20_residual_summary",
    """SELECT l_returnflag AS g, ROUND(AVG(l_extendedprice), 5) AS ice_mean_mm, MAX(l_extendedprice) AS ice_max_mm, ROUND(QUANTILE_CONT(l_extendedprice, 0.95), 5) AS ice_p95_mm, ROUND(QUANTILE_CONT(l_extendedprice, 0.99), 5) AS ice_p99_mm
       FROM lineitem GROUP BY 1""",
)
def residual_summary(t):
    return rounded(S.residual_summary(t.lineitem.withColumnRenamed("l_returnflag", "g"), ["g"], "l_extendedprice"), 5)


@query(
    "v21_framewise_displacement",
    f"""
    WITH m AS (SELECT l_orderkey AS run, l_linenumber AS frame, AVG(l_quantity) AS tx, AVG(l_tax) AS ry FROM lineitem GROUP BY ALL)
    SELECT a.run, a.frame, ROUND(abs(a.tx - b.tx) + abs(a.ry - b.ry) * {math.pi / 180 * 50!r}, 8) AS framewise_displacement FROM m a LEFT JOIN m b ON b.run = a.run AND b.frame = a.frame - 1""",
)
def framewise_displacement(t):
    m = t.lineitem.groupBy(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("frame")).agg(F.avg("l_quantity").alias("tx"), F.avg("l_tax").alias("ry"))
    out = S.framewise_displacement(m, ["run"], "frame", ["tx"], ["ry"])
    return rounded(out.select("run", "frame", "framewise_displacement"), 8)


@query(
    "v22_confounds_frame",
    _V
    + f""", d AS (SELECT label, frame, x, x - LAG(x) OVER (PARTITION BY vec_id ORDER BY frame) AS dx FROM l)
         SELECT label, frame, ROUND(AVG(x), 9) AS global_signal, ROUND(sqrt(AVG(dx * dx)), 9) AS dvars, CASE WHEN frame < 4 THEN 1 ELSE 0 END AS non_steady_state,
                ROUND(CASE WHEN frame >= 4 THEN {math.sqrt(2 / 60)!r} * cos({math.pi / 60!r} * (frame - 4 + 0.5)) ELSE 0 END, 9) AS cosine_00, ROUND(CASE WHEN frame >= 4 THEN {math.sqrt(2 / 60)!r} * cos({math.pi / 60 * 2!r} * (frame - 4 + 0.5)) ELSE 0 END, 9) AS cosine_01 FROM d GROUP BY ALL""",
)
def confounds_frame(t):
    return rounded(S.confounds_frame(_voxels(t), ["label"], 4, 0.8, 64, period=32.0), 9)


_FLAGS = ", ".join(f"CASE WHEN {i} < nss THEN CASE WHEN g.frame = {i} THEN 1 ELSE 0 END END AS non_steady_state_outlier_{i:02d}" for i in range(4))
_TERMS = ", ".join(
    f"ROUND({c}, 9) AS {c}, ROUND({c} - p_{c}, 9) AS {c}_derivative1, ROUND({c} * {c}, 9) AS {c}_power2, ROUND(({c} - p_{c}) * ({c} - p_{c}), 9) AS {c}_derivative1_power2"
    for c in ("rot_z", "trans_x")
)
_WAVES = ", ".join(
    f"ROUND(CASE WHEN g.frame >= nss THEN sqrt(2.0 / (64 - nss)) * cos(pi() / (64 - nss) * {k + 1} * (g.frame - nss + 0.5)) ELSE 0 END, 9) AS cosine_{k:02d}" for k in range(2)
)


@query(
    "v22_confounds_table",
    _V
    + f""",
    d AS (SELECT label, frame, x, x - LAG(x) OVER (PARTITION BY vec_id ORDER BY frame) AS dx FROM l),
    g AS (SELECT label, frame, label % 3 + 2 AS nss, AVG(x) AS global_signal, sqrt(AVG(dx * dx)) AS dvars FROM d GROUP BY ALL),
    m AS (SELECT label, frame, AVG(CASE WHEN vec_id % 2 = 1 THEN x END) AS rot_z, AVG(CASE WHEN vec_id % 2 = 0 THEN x END) AS trans_x FROM l WHERE frame <> 40 GROUP BY ALL),
    p AS (SELECT label, frame + 1 AS frame, rot_z AS p_rot_z, trans_x AS p_trans_x FROM m)
    SELECT g.label, g.frame AS t_indx, {_FLAGS}, {_TERMS}, ROUND(abs(rot_z - p_rot_z) * {math.pi / 180 * 50!r} + abs(trans_x - p_trans_x), 9) AS framewise_displacement,
           ROUND(dvars, 9) AS dvars, ROUND(global_signal, 9) AS global_signal, {_WAVES}
    FROM g LEFT JOIN m USING (label, frame) LEFT JOIN p ON p.label = g.label AND p.frame = g.frame AND m.label IS NOT NULL""",
)
def confounds_table(t):
    """Motion from the voxels' own means (frame 40 has none), two to four non-steady-state frames by run."""
    v = _voxels(t).withColumn("nss", F.col("label") % 3 + 2)
    frames = v.select("label", "voxel", F.posexplode("series").alias("frame", "x")).filter("frame <> 40")
    motion = frames.groupBy("label", "frame").agg(
        F.avg(F.when(F.col("voxel") % 2 == 1, F.col("x"))).alias("rot_z"), F.avg(F.when(F.col("voxel") % 2 == 0, F.col("x"))).alias("trans_x")
    )
    return rounded(S.full_confounds(v, motion, ["label"], "nss", 4, 0.8, 64, ["rot_z"], ["trans_x"], period=32.0), 9)
