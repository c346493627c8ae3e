"""Values that results depend on: word lists, tables, patterns and limits.

Fixed values. They define what the operators compute and are stated as they
are; operators take most of them as defaults that a caller can replace.
"""

from __future__ import annotations

# --- Fixed values: actions ---

VERBS = (
    "click", "double_click", "right_click", "middle_click", "move", "drag",
    "scroll", "type", "press", "hotkey", "key_down", "key_up",
    "mouse_down", "mouse_up", "wait", "finish", "point",
)
ANCHOR_VERBS = ("click", "double_click", "right_click", "middle_click", "drag", "scroll", "type", "press", "hotkey", "finish", "wait")
HISTORY_VERBS = ("move", "key_down", "key_up", "mouse_down", "mouse_up", "point")
VISUAL_VERBS = ("click", "double_click", "right_click", "middle_click", "drag", "type", "press")
POINT_VERBS = ("click", "double_click", "right_click", "middle_click", "move", "point")
MODIFIER_KEYS = ("ctrl", "control", "alt", "shift", "cmd", "command", "win", "windows", "meta")
VERB_SIGNAL = {
    "drag": "uncommon_action", "middle_click": "uncommon_action", "right_click": "uncommon_action",
    "hotkey": "keyboard_shortcut", "wait": "wait", "double_click": "uncommon_action",
}

# --- Fixed values: signals ---

POSITIVE_SIGNALS = (
    "recovery_evidenced", "failed_action",
    "verification", "verification_evidenced", "planning_evidenced", "save",
    "export", "modal_dialog", "file_dialog", "overwrite_confirmation",
    "sorting", "ranking", "exact_quantity", "multi_target", "multi_app",
    "uncommon_action", "scroll_read", "state_transition", "wait", "loading",
    "drag", "keyboard_shortcut", "small_target", "dense_ui", "finish_verification",
)
NEGATIVE_SIGNALS = ("repeated_identical_click", "trivial_open", "near_duplicate_no_recovery", "ordinary_navigation")
MEANINGFUL_SIGNALS = ("failed_action", "recovery_evidenced", "loading", "wait_evidenced", "verification_evidenced")
PLAN_CATEGORY = {
    "recovery_evidenced": "recovery", "verification_evidenced": "verification",
    "planning_evidenced": "planning", "wait_evidenced": "wait",
}
HARD_SIGNALS = ("sorting", "ranking", "exact_quantity", "multi_target", "formatting", "settings")

# --- Fixed values: label patterns, matched without regard to case ---

TASK_PATTERNS = {
    "sorting": r"\bsort(ed|ing)?\b|\barrange\b|\borderr?\b",
    "ranking": r"\brank(ed|ing)?\b|\btop\s*\d+\b|\bhighest\b|\blowest\b",
    "exact_quantity": r"\bexactly\s+\d+\b|\b\d+\s+(items?|files?|words?|cells?|rows?|slides?)\b",
    "multi_target": r"\band\b.*\balso\b|,\s*(then|and)\s*(open|create|rename|delete|move)\b",
    "save": r"\bsave(d)?\b|\bsave as\b",
    "export": r"\bexport\b|\bdownload\b|\bconvert to\b",
    "modal_dialog": r"\bconfirm\b|\boverwrite\b|\bdialog\b|\bmodal\b",
    "multi_app": r"\bin\s+(word|excel|powerpoint|ppt|browser|chrome|firefox|explorer)\b.*\bthen\b",
}
DIFFICULTY_PATTERNS = {
    "sorting": r"\bsort(ed|ing)?\b|\barrange\b|\border\b",
    "ranking": r"\brank(ed|ing)?\b|\btop\s*\d+\b|\bhighest\b|\blowest\b",
    "exact_quantity": r"\bexactly\s+\d+\b|\ball\s+\d+\b|\b\d+\s+(items?|files?|words?|cells?|rows?|slides?|students?)\b",
    "multi_target": r"\band\b[^.]{2,40}\balso\b|,\s*(then|and)\s+(open|create|rename|delete|move|save)\b",
    "save_export": r"\bsave(d)?( as)?\b|\bexport\b|\bdownload\b|\bprint\b",
    "dialog": r"dialog|modal|popup|confirm|overwrite",
    "formatting": r"\bformat\b|\bfont\b|\bstyle\b|\btheme\b|\blayout\b",
    "settings": r"\benable\b|\bdisable\b|\btoggle\b|\bsettings?\b|\bpreferences\b",
    "verification": r"verif|check|confirm|ensure|make sure",
}
MOTIF_PATTERNS = {
    "dialog_modal": r"\b(dialog|modal|popup|pop-up|confirmation|confirm)\b",
    "save_export": r"\b(save(?: as)?|export|download|print)\b",
    "file_chooser": r"\b(file chooser|open file|choose file|select file|browse(?: for)? file|save as)\b",
    "overwrite_confirmation": r"\b(overwrite|replace (?:the )?(?:existing )?file|already exists)\b",
    "exact_quantity": r"\bexactly\s+\d+\b|\b\d+\s+(?:items?|files?|rows?|cells?|slides?|words?|entries?)\b",
    "sort_rank": r"\b(sort|sorted|sorting|rank|ranking|highest|lowest|top\s*\d+)\b",
    "multi_target": r"\b(?:and then|then also|both|all of the following|multiple)\b",
    "settings": r"\b(settings?|preferences?|options?|configure|configuration|enable|disable|toggle)\b",
    "cross_app": r"\b(?:from|between)\s+(?:excel|word|powerpoint|chrome|firefox|edge|explorer|libreoffice)[^.!?]{0,100}\b(?:to|and)\s+(?:excel|word|powerpoint|chrome|firefox|edge|explorer|libreoffice)\b",
}
SIGNAL_MOTIF = {
    "modal_dialog": "dialog_modal", "dialog": "dialog_modal", "save_export": "save_export", "export": "save_export",
    "drag": "drag", "keyboard_shortcut": "hotkeys", "recovery_evidenced": "verified_recovery",
    "finish_verification": "finish_verification",
}
APP_PATTERNS = {
    "libreoffice_calc": r"libreoffice calc|spreadsheet|\bexcel\b|\bcolumn|\bcell",
    "libreoffice_writer": r"libreoffice writer|\bdocument\b|\bword\b",
    "libreoffice_impress": r"libreoffice impress|\bslide|\bpresentation|powerpoint",
    "vscode": r"vs code|visual studio code|\bide\b|\bterminal\b|\bcode editor",
    "browser": r"\bchrome\b|\bbrowser\b|\bfirefox\b",
    "file_manager": r"file(s)? manager|\bfolder\b|\bzip\b|\bcompress|\barchive",
    "vlc": r"\bvlc\b|media player",
    "gimp": r"\bgimp\b|\bimage editor",
}
REFERENT_QUOTED = r"\b(?:click(?:ing)?|select(?:ing)?|choose|choosing|open(?:ing)?|activate|activating|pick(?:ing)?)\s+(?:on\s+)?(?:the\s+)?['\"]([^'\"]{1,80})['\"](?:\s+(button|tab|item|option|listitem|menu|link|cell))?"
REFERENT_CELL = r"\b(?:click|select|choose)\s+(?:on\s+)?(?:the\s+)?(?:cell\s+)?([A-Z]{1,3}\d{1,7}(?::[A-Z]{1,3}\d{1,7})?)\b"
MARKDOWN_DESCRIPTION = r"\*\*Description:\*\*\s*(.+)"
CONTROL_KINDS = (
    "button", "tab", "menu", "checkbox", "radio", "cell", "input", "textbox",
    "link", "dropdown", "combobox", "toolbar", "icon", "slider",
)

# --- Fixed values: quality scores ---

ACTION_WEIGHTS = {
    "difficulty": 1.6, "recovery": 2.2, "verification": 1.8, "action_rarity": 1.0,
    "app_rarity": 0.8, "dialog": 0.8, "save_export": 1.0, "state_value": 0.8,
    "triviality": -1.8, "redundancy": -1.2, "sequence_value": 0.6,
    "offcenter_click": -0.7,
}
RARE_VERBS = {
    "drag": 1.0, "hotkey": 0.8, "double_click": 0.5, "right_click": 0.6,
    "middle_click": 1.0, "scroll": 0.4, "type": 0.3, "press": 0.4,
}
COMMON_APPS = (
    "excel", "word", "ppt", "powerpoint", "chrome", "chromium", "firefox",
    "edge", "explorer", "files", "desktop", "libreoffice", "unknown",
)
SEQUENCE_VALUE = {"single": 0.3, "window": 0.8, "chunk": 1.0}
VALUED_CATEGORIES = ("Button", "Menu", "Input Elements")
LOW_INFORMATION = ("cursor", "", "icon", "image", "logo")
SIZE_BUCKETS = {"tiny": (0, 16, 0.25), "small": (16, 32, 0.40), "medium": (32, 64, 0.25), "large": (64, 10**9, 0.10)}

# --- Fixed values: text rules ---

PLACEHOLDER_ANSWERS = ("n/a", "none", "todo", "placeholder", "cannot answer")
PLACEHOLDER_PARTS = ("<placeholder>", "your code here", "lorem ipsum", "todo: implement", "pass  # todo")
CODE_ALIASES = {"py": "python", "python3": "python", "js": "javascript", "ts": "typescript"}
CODE_KEYWORDS = {
    "python": "python", "javascript": "javascript", "typescript": "typescript",
    "java": "java", "c++": "cpp", "sql": "sql", "rust": "rust",
}
DEBUGGING = r"\b(debug|fix|bug|error)\b"
ALGORITHM = r"\b(algorithm|complexity|implement|function)\b"
MATH_NUMBER = r"\d+(?:\.\d+)?"
MATH_TERM = r"[%/$]|fraction|ratio|percent|probab|average|speed|rate|area|volume|discount|interest|exchange|per\s"
MATH_RELATION = r"\b(and|then|after|before|remaining|altogether|difference|more than|less than|each|respectively|remainder)\b"
SECRET_PATTERNS = (r"hf_[A-Za-z0-9]{20,}", r"gh[pousr]_[A-Za-z0-9]{20,}", r"(?i)Authorization:\s*\S+")

# --- Fixed values: selection ---

SUBTARGETS = {"coding": 1600, "math": 1500, "instruction": 1700, "vqa": 1400, "tool": 1300}
REPRESENTATIONS = {"single": 0.16, "window": 0.60, "chunk": 0.24}

# --- Fixed values: evaluation ---

STATUSES = (
    "success", "model_failure", "parser_failure", "timeout", "environment_failure",
    "harness_failure", "invalid_task", "aborted", "missing",
)
TERMINAL = ("success", "model_failure", "parser_failure", "timeout", "environment_failure", "harness_failure", "invalid_task")
PROTOCOL_EXCLUDES = ("invalid_task", "environment_failure", "harness_failure")
MANUAL_CATEGORIES = (
    "grounding_error", "typing_error", "navigation_error", "wrong_action", "planning_error", "recovery_failure",
    "state_misunderstanding", "wait_timing_error", "verification_failure", "long_horizon_context_failure",
)
CAUSED_BY = {
    "tool_harness_error": "harness_caused", "environment_error": "environment_caused",
    "premature_finish": "model_caused", "failure_to_finish": "model_caused",
} | dict.fromkeys(MANUAL_CATEGORIES, "model_caused")
MANIFEST_FIELDS = (
    "benchmark.name", "benchmark.repository", "benchmark.repository_revision", "benchmark.task_set_hash",
    "model.revision", "system_prompt_hash", "action_space", "tool_schema_hash", "observation", "sampling_settings",
    "seed", "seed_policy", "step_budget", "timeout_policy", "retry_policy", "history_policy",
    "scaffold_config_hash", "environment_revision", "vm_identifiers", "adapter.merged",
)

# --- Fixed values: validation reasons that fail a build ---

FATAL_CONDITIONS = (
    "missing_image", "invalid_json", "empty_assistant_target",
    "coordinate_out_of_bounds", "image_undecodable", "non_portable_path",
    "duplicate_sample_id",
)
SCHEMA_REASONS = (
    "invalid_action_syntax", "invalid_roles", "invalid_messages",
    "empty_message_content", "unknown_source", "missing_trajectory_id",
    "image_placeholder_mismatch", "grounding_without_point", "invalid_images",
    "multi_assistant_action_without_state_alignment", "action_without_image",
    "action_requires_exactly_one_image", "action_requires_exactly_one_supervised_assistant",
    "action_requires_visual_state", "native_history_prior_assistant_has_loss",
    "native_history_supervised_assistant_not_last", "native_target_hash_missing",
    "native_target_hash_mismatch", "missing_final_image_size",
    "final_image_size_mismatch", "invalid_understanding_turn_structure",
    "malformed_understanding_json", "malformed_understanding_control",
    "understanding_rect_out_of_bounds", "understanding_not_spatially_sorted",
    "finish_without_evidence",
)
RELEASE_REASONS = ("train_validation_group_overlap", "motif_coverage_floor_unmet", "auxiliary_loss_share_exceeded")

# --- Fixed values: the notation of English-like action strings ---

PHRASES = {
    "click": r"(click|double[- ]?click|right[- ]?click)\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)",
    "type": r"type(.*)",
    "press": r"(?:press|hotkey|key)\S*(?:\s+(.*))?",
    "finish": r"finish\S*(?:\s+(.*))?",
    "wait": r"wait\S*(?:\s+(.*))?",
    "scroll": r"scroll\S*(?:\s+(.*))?",
    "drag": r"drag\s+from\s*\(\s*(-?\d+)\s*,\s*(-?\d+)\s*\)\s+to\s*\(\s*(-?\d+)\s*,\s*(-?\d+)\s*\)",
}
#: Within them: the label before a text or a key, several keys in parentheses, a place, a count of clicks, a number.
PHRASE_TEXT_LABEL, PHRASE_KEY_LABEL = r"^text\s*:\s*", r"^key\s+"
PHRASE_KEYS, PHRASE_PLACE, PHRASE_COUNT, PHRASE_NUMBER = r"\(\s*\w+(?:\s*,\s*\w+)+\s*\)", r"\(\s*(\d+)\s*,\s*(\d+)\s*\)", r"\(?(-?\d+)\)?", r"\d+(?:\.\d+)?"
#: Clicks of a scroll by its direction; other words are a small step down.
PHRASE_SCROLL, PHRASE_SCROLL_ELSE = {"up": -3, "down": 3}, 2

# --- Fixed values: speakers of tool conversations ---

SPEAKERS = {"system": ("system", "gizmo"), "user": ("human", "function", "tool")}
TOOL_SPEAKERS, TOOL_RESPONSE = ("function", "tool"), "Tool response: "

# --- Fixed values: plans attached to actions ---

PLAN_SHARES = {"recovery": 0.40, "verification": 0.25, "planning": 0.20, "wait": 0.15}
PLAN_TEMPLATES = {
    "recovery": (
        "Plan: The previous action produced no visible change, so a different control is used instead.",
        "Plan: The earlier attempt did not reach the target state; this action takes the alternate path.",
        "Plan: The screen is unchanged after the last step, indicating the control was ineffective; switching approach.",
    ),
    "verification": (
        "Plan: The expected result is now visible, so the work is confirmed before finishing.",
        "Plan: This check confirms the saved output matches the requested name and location.",
        "Plan: The dialog closed and the requested state is present, which verifies completion.",
    ),
    "planning": (
        "Plan: This intermediate step is required before the requested final operation can succeed.",
        "Plan: The task spans two applications, so the content is prepared here before switching.",
        "Plan: Among the visible controls, this one matches the required operation for the next stage.",
    ),
    "wait": (
        "Plan: The interface is still loading, so the correct move is to wait rather than click.",
        "Plan: A progress indicator is active; acting now would target a moving control.",
        "Plan: The operation needs time to finish before its result can be verified.",
    ),
}

# --- Fixed values: module paths and applications ---

ALIGNER_WORDS = ("merger", "projector", "aligner")
VISION_SEGMENTS = ("visual", "vision_tower", "vision_model", "vision_encoder", "vision", "vit")
VISION_HEADS = ("visual", "vision", "patch_embed")
PRIORITY_APPS = (
    "libreoffice", "gimp", "inkscape", "blender", "freecad", "audacity", "darktable", "gnu octave", "gnucash", "gnumeric",
    "intellij idea", "eclipse", "ardour", "fontforge", "grassgis", "calibre", "joplin", "anki",
)
