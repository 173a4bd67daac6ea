"""Schemas of the landed records and of the derived tables, as DDL."""

SOURCE = "struct<rank:int,title:string,url:string>"
TASK = "question_id string, question string, mode string"
ANSWER = (
    "platform string, question_id string, question string, answer string, turn_id string, chat_url string, mode string, mode_label string, "
    f"search_queries array<string>, sources array<{SOURCE}>, citation_mapping_available boolean, acquired_at timestamp_ntz"
)
TASK_RESULT = "struct<question_id:string,mode:string,question:string,status:string,output_path:string,error_type:string,error_message:string>"
BATCH_SUMMARY = (
    "platform string, status string, planned_count bigint, executed_count bigint, pass_count bigint, fail_count bigint, blocked_count bigint, pending_count bigint, "
    f"task_results array<{TASK_RESULT}>, started_at timestamp_ntz, finished_at timestamp_ntz"
)
TARGET = "target_id string, aliases array<string>"
OCCURRENCE = "question_id string, mode string, source_key string, domain string, title string, url string, rank int, item_pos bigint, source_pos int"
PACKAGE_TASK = "task_id string, question_id string, question string, mode_code string, task_status string, error_code string, error_message string"
PACKAGE_ANSWER = (
    "answer_id string, task_id string, question_id string, mode_code string, question_text string, answer_text_raw string, answer_text_clean string, acquisition_status string, validation_status string, "
    "is_complete boolean, source_collection_status string, source_count_raw bigint, screenshot_path string, collected_at timestamp_ntz, platform_meta_json string"
)
PACKAGE_SOURCE = (
    "occurrence_id string, answer_id string, source_order int, source_title_raw string, source_site_name_raw string, source_url_raw string, source_snippet string, is_duplicate_in_answer boolean"
)
MANIFEST = (
    "schema_version string, geo_batch_version string, platform_code string, platform_name string, product_id string, product_name string, batch_id string, collector_version string, status string, "
    "started_at timestamp_ntz, finished_at timestamp_ntz, capabilities struct<supports_sources:boolean,supports_multiple_modes:boolean,supports_screenshot:boolean>, "
    "task_count bigint, answer_count bigint, source_count bigint, files array<string>"
)
