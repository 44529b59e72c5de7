"""The eleven record tables: superset schema, grain, raw prefix and version column.

A column missing from an older record reads NULL, so each schema is the superset over all versions. `dt` is the
write date (string, `YYYY-MM-DD`) and is the partition column of every table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- fixed values: field names and types of the stored records ------------------------------------------------
_SURFACE = """
surf_L_n_vertices BIGINT, surf_L_coverage_frac DOUBLE, surf_L_nan_frac DOUBLE, surf_L_tsnr_median DOUBLE,
surf_R_n_vertices BIGINT, surf_R_coverage_frac DOUBLE, surf_R_nan_frac DOUBLE, surf_R_tsnr_median DOUBLE,
subcort_n_voxels BIGINT, subcort_n_structures BIGINT, subcort_space STRING
"""
_STEP = (
    "step STRING, session STRING, task STRING, run STRING, status STRING, failure_category STRING, "
    "failure_reason STRING"
)
_FIELDS = {
    "func_preproc": f"""
        subject STRING, session STRING, task STRING, run STRING,
        n_frames BIGINT, n_nss_frames BIGINT, tr_seconds DOUBLE,
        mean_fd DOUBLE, median_fd DOUBLE, max_fd DOUBLE, n_fd_above_0p2 BIGINT, n_fd_above_0p5 BIGINT,
        pct_fd_above_0p5 DOUBLE, mean_dvars DOUBLE, dvars_std DOUBLE, mean_global_signal DOUBLE,
        tsnr_median DOUBLE, gcor DOUBLE, aor DOUBLE, aqi DOUBLE,
        n_acompcor_wm BIGINT, n_acompcor_csf BIGINT, n_tcompcor BIGINT, n_cosines BIGINT,
        wm_mask_voxels BIGINT, csf_mask_voxels BIGINT, tissue_confounds STRING,
        stage_timings_s MAP<STRING,DOUBLE>, total_runtime_s DOUBLE, peak_memory_gb DOUBLE,
        container_peak_memory_gb DOUBLE, pipeline STRING, image_tag STRING, schema_version STRING,
        completed_at STRING, {_SURFACE}""",
    "surface_sample": f"""
        subject STRING, session STRING, task STRING, run STRING, pipeline STRING, image_tag STRING, emit STRING,
        stage_timings_s MAP<STRING,DOUBLE>, total_runtime_s DOUBLE, peak_memory_gb DOUBLE,
        container_peak_memory_gb DOUBLE, schema_version STRING, completed_at STRING, {_SURFACE}""",
    "anat_qc": """
        subject STRING, session STRING, efc DOUBLE, fber DOUBLE, cnr DOUBLE, cjv DOUBLE, wm2max DOUBLE,
        fwhm_x_mm DOUBLE, fwhm_y_mm DOUBLE, fwhm_z_mm DOUBLE, fwhm_avg_mm DOUBLE, etiv_mm3 DOUBLE,
        total_brain_vol_mm3 DOUBLE, lh_cortex_vol_mm3 DOUBLE, rh_cortex_vol_mm3 DOUBLE, wm_vol_mm3 DOUBLE,
        subcort_gm_vol_mm3 DOUBLE, lh_mean_thickness_mm DOUBLE, rh_mean_thickness_mm DOUBLE,
        lh_surface_area_mm2 DOUBLE, rh_surface_area_mm2 DOUBLE, pipeline STRING, schema_version STRING,
        completed_at STRING""",
    "fsqc_qc": """
        subject STRING, session STRING, wm_snr_orig DOUBLE, gm_snr_orig DOUBLE, wm_snr_norm DOUBLE,
        gm_snr_norm DOUBLE, cc_size DOUBLE, holes_lh DOUBLE, holes_rh DOUBLE, defects_lh DOUBLE,
        defects_rh DOUBLE, topo_lh DOUBLE, topo_rh DOUBLE, con_snr_lh DOUBLE, con_snr_rh DOUBLE,
        rot_tal_x DOUBLE, rot_tal_y DOUBLE, rot_tal_z DOUBLE, n_outlier_norms DOUBLE,
        n_outlier_sample_nonpar DOUBLE, n_outlier_sample_param DOUBLE, hypothalamus_whole_left_mm3 DOUBLE,
        hypothalamus_whole_right_mm3 DOUBLE, metrics_status BIGINT, outlier_status BIGINT,
        hippocampus_status BIGINT, hypothalamus_status BIGINT, fsqc_version STRING, pipeline STRING,
        schema_version STRING, completed_at STRING""",
    "tissue_masks": """
        subject STRING, session STRING, pipeline STRING, image_tag STRING, source STRING, schema_version STRING,
        completed_at STRING, dseg_gm_vol_mm3 DOUBLE, dseg_wm_vol_mm3 DOUBLE, dseg_csf_vol_mm3 DOUBLE,
        probseg_input STRING, probseg_seed BIGINT, probseg_written BOOLEAN, probseg_gm_vol_mm3 DOUBLE,
        probseg_wm_vol_mm3 DOUBLE, probseg_csf_vol_mm3 DOUBLE, agreement_gm DOUBLE, agreement_wm DOUBLE,
        agreement_csf DOUBLE""",
    "workflow_runs": """
        workflow_name STRING, workflow_uid STRING, subject STRING, status STRING, started_at STRING,
        finished_at STRING, total_duration_s BIGINT, pending_duration_s DOUBLE, message STRING,
        failed_step STRING, failure_category STRING, pipeline STRING, batch_label STRING,
        schema_version STRING, completed_at STRING""",
    "step_outcomes": """
        workflow_name STRING, workflow_uid STRING, step STRING, subject STRING, session STRING, task STRING,
        run STRING, status STRING, failure_category STRING, failure_reason STRING, upstream_failed_step STRING,
        outputs_verified ARRAY<STRING>, pipeline STRING, schema_version STRING, recorded_at STRING""",
    "subject_manifests": f"""
        workflow_name STRING, workflow_uid STRING, subject STRING, overall_status STRING,
        steps ARRAY<STRUCT<{_STEP.replace(" STRING", ": STRING")}>>,
        outputs_available ARRAY<STRING>, failed_steps ARRAY<STRING>, skipped_steps ARRAY<STRING>,
        pipeline STRING, schema_version STRING, completed_at STRING""",
    "registration": """
        subject STRING, session STRING, registration_type STRING, method STRING, dice DOUBLE, nmi DOUBLE,
        mi DOUBLE, rigid_disp_mean_mm DOUBLE, rigid_disp_max_mm DOUBLE, rigid_rot_deg DOUBLE, mhd_mm DOUBLE,
        nmi_identity DOUBLE, nmi_gain DOUBLE, seg_bbr_contrast DOUBLE, seg_bbr_contrast_identity DOUBLE,
        ngf DOUBLE, ngf_identity DOUBLE, bbr_cost DOUBLE, bbr_converged BOOLEAN, bbr_init_used STRING,
        mask_dice DOUBLE, lncc DOUBLE, verdict STRING, jac_det_min DOUBLE, jac_det_max DOUBLE,
        jac_det_mean DOUBLE, jac_det_std DOUBLE, jac_det_frac_negative DOUBLE, log_jac_mean DOUBLE,
        log_jac_std DOUBLE, log_jac_p01 DOUBLE, log_jac_p99 DOUBLE, log_jac_min DOUBLE, log_jac_max DOUBLE,
        log_jac_frac_beyond_1p5 DOUBLE, log_jac_frac_beyond_3 DOUBLE, ice_mean_mm DOUBLE, ice_p95_mm DOUBLE,
        ice_p99_mm DOUBLE, ice_max_mm DOUBLE, centroid_displacement_mm DOUBLE, task STRING, run STRING,
        pipeline STRING, schema_version STRING, completed_at STRING, sampling_strategy STRING,
        rescue_ticket BIGINT, sampling_seed BIGINT, itk_threads BIGINT, attempts_run BIGINT, none_lncc DOUBLE,
        none_jac_det_frac_negative DOUBLE, affine_tal_dev_mm DOUBLE, none_affine_tal_dev_mm DOUBLE""",
    "costs": """
        date STRING, workflow_name STRING, subject STRING, total_cost_usd DOUBLE, cpu_cost_usd DOUBLE,
        memory_cost_usd DOUBLE, gpu_cost_usd DOUBLE, total_adjustment_usd DOUBLE, scrape_age_days BIGINT,
        source STRING, scraped_total_cost_usd DOUBLE, pipeline STRING, schema_version STRING,
        completed_at STRING""",
    "pod_costs": """
        date STRING, workflow_name STRING, pod STRING, step STRING, phase STRING, subject STRING, session STRING,
        total_cost_usd DOUBLE, cpu_cost_usd DOUBLE, memory_cost_usd DOUBLE, gpu_cost_usd DOUBLE,
        pv_cost_usd DOUBLE, network_cost_usd DOUBLE, total_adjustment_usd DOUBLE, runtime_minutes DOUBLE,
        cpu_core_hours DOUBLE, ram_gb_hours DOUBLE, gpu_hours DOUBLE, cpu_efficiency DOUBLE,
        ram_efficiency DOUBLE, node STRING, node_instance_type STRING, node_capacity_type STRING,
        node_effective_usd_per_hour DOUBLE, node_ondemand_usd_per_hour DOUBLE, node_instance_id STRING,
        scrape_age_days BIGINT, pipeline STRING, schema_version STRING, completed_at STRING""",
}
_GRAIN = {
    "func_preproc": ("subject", "session", "task", "run"),
    "surface_sample": ("subject", "session", "task", "run"),
    "anat_qc": ("subject", "session"),
    "fsqc_qc": ("subject", "session"),
    "tissue_masks": ("subject", "session"),
    "workflow_runs": ("workflow_name", "workflow_uid", "subject"),
    "step_outcomes": ("workflow_name", "workflow_uid", "step", "subject", "session", "task", "run"),
    "subject_manifests": ("workflow_name", "workflow_uid", "subject"),
    "registration": ("subject", "session", "registration_type", "task", "run"),
    "costs": ("date", "workflow_name"),
    "pod_costs": ("date", "workflow_name", "pod"),
}
#: Tables whose newest record is told by another column than `completed_at`.
_TIME = {"step_outcomes": "recorded_at"}
#: Literal a record uses for a dimension that does not apply to it.
ABSENT = "na"
#: Version bucket of a record without `schema_version`.
UNKNOWN_VERSION = "unknown"
#: Values that mean "not computed" (a real 0.0 is kept everywhere else).
NOT_COMPUTED = {"gcor": 0.0, "aor": 0.0, "aqi": 0.0, "mhd_mm": -1.0, "bbr_cost": -1.0, "seg_bbr_contrast": -999.0}
# ---- end of fixed values ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RecordTable:
    """One record table by convention: prefix `a-b/` under the root holds table `a_b`."""

    name: str
    schema: T.StructType
    grain: tuple[str, ...]
    time_column: str = "completed_at"

    @property
    def prefix(self) -> str:
        return self.name.replace("_", "-")

    @property
    def partitioned_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("dt", T.StringType())])

    def raw_path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.prefix}"

    def compacted_path(self, root: str) -> str:
        return f"{root.rstrip('/')}/compacted/{self.name}"


def _parse(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


_CACHE: dict[str, RecordTable] = {}


def record_table(name: str) -> RecordTable:
    """The catalog entry of a record table (parsing DDL needs a running session, hence lazily)."""
    if name not in _FIELDS:
        raise KeyError(f"unknown record table {name!r}; one of {sorted(_FIELDS)}")
    if name not in _CACHE:
        _CACHE[name] = RecordTable(name, _parse(_FIELDS[name]), _GRAIN[name], _TIME.get(name, "completed_at"))
    return _CACHE[name]


TABLE_NAMES = tuple(_FIELDS)
