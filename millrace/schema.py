"""Schemas of samples, steps, task results and other records."""

from __future__ import annotations

MESSAGE = "struct<role:string,content:string,loss:boolean>"
QUALITY = "struct<components:map<string,double>,score:double,bucket:string,reject_reason:string,token_efficiency:double>"
METADATA = (
    "struct<representation:string,estimated_tokens:bigint,image_count:int,signals:array<string>,motifs:array<string>,app:string,"
    "group_id:string,collection_run:string,task_family:string,content_family:string,split_group_id:string,final_image_size:array<int>,image_size:array<int>,"
    "original_image_size:array<int>,target_width_px:int,target_height_px:int,action_canonical_final_pixels:string,finish_evidence:string,"
    "recovery_verified:boolean,native_interface:boolean,interface_history_mode:string,interface_image_placeholder:string,"
    f"assistant_target_sha256:string,quality:{QUALITY}>"
)
SAMPLE = f"messages array<{MESSAGE}>, images array<string>, source string, trajectory_id string, step_id string, task_type string, split string, metadata {METADATA}"
STEP = "trajectory_id string, task string, app string, source string, step_idx int, step_id string, verb string, action_text string, phash bigint, signals array<string>, continuity_id bigint"
REFERENCE = "task_id string, instruction string"
TASK_RESULT = (
    "task_id string, status string, steps int, latency_s double, failure_category string, failure_annotation string, "
    "error_detail string, finished boolean, env_success_at_finish boolean"
)
FRONTIER = "sample_id string, verifiable boolean, frontier_score double"
CHECKPOINT = "path string, global_step bigint, epoch_fraction_pct double, has_adapter boolean, name string"
FAILURE = "source string, error string, traceback string, at string"
