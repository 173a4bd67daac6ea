"""Parameter tables. Phrases, markers, rules, modes and statuses that results must agree with."""

from __future__ import annotations

MODES = ("quick", "research")
PACKAGE_MODE = {"quick": "quick", "research": "expert"}
PACKAGE_STATUS = {"pass": "success", "fail": "failed", "blocked": "failed", "pending": "running"}
#: What package rows may say.
PACKAGE_VERSION, BATCH_VERSION = "geo_package_v1", "geo_batch_v1"
PACKAGE_MODES, TASK_STATUSES = ("quick", "expert"), ("success", "failed", "running")
ACQUISITION_STATUSES = ("success", "partial_success", "failed", "risk_control", "not_supported")
VALIDATION_STATUSES = ("PASS", "PASS_WITH_WARNINGS", "FAIL", "NOT_APPLICABLE")
COLLECTION_STATUSES = ("success", "partial_success", "failed", "not_supported")
SCOPES = ("quick", "research", "all")

REFUSAL_SENTENCES = ("你好，我无法回答这个问题，我们换一个话题聊聊吧。",)
BUSY_MARKERS = ("当前访问人数过多", "疯狂加服务器中", "请稍后再试")
BUSY_MOST_CHARS = 120
QUOTA_PHRASES = (
    "今日使用次数已达上限", "今日次数已达上限", "今日次数已用完", "使用次数已达上限", "已达到使用上限", "本次服务次数已用完", "暂无可用次数", "当前账号暂无可用次数",
)
#: Around a phrase: an apology before it; marks, an advice and marks after it.
QUOTA_COURTESIES = ("抱歉[，, ]*", "[，,。.!！ ]*", "请稍后再试|请稍后重试|请明日再试", "[。.!！ ]*")
QUOTA_MOST_CHARS = 300
ANCHOR_PREFIX = "reference-link-anchor-"
SEARCH_HEADING, SOURCE_HEADING = r"^搜索\s*(\d+)\s*个关键词，参考\s*(\d+)\s*篇资料$", r"^\s*\d+\s*[篇条]来源\s*$"
#: Error types of answers that no retry mended.
QUOTA_ERROR, BUSY_ERROR, REFUSAL_ERROR = "QuotaExhaustedError", "ServiceBusyError", "RefusalError"
RISK_TEXTS = ("请拖动下方滑块完成验证", "通过验证以确保正常访问", "验证失败")

NEGATIVE_RULES = (
    ("historical_case", ("谭秦东", "跨省抓捕", "跨省被抓")),
    ("false_advertising", ("虚假宣传", "夸大宣传")),
    ("advertising_violation", ("违法广告", "违规广告", "广告违规", "广告屡遭查处")),
    ("regulatory_action", ("行政处罚", "监管处罚", "被处罚", "责令整改", "暂停销售", "暂停广告", "停止销售", "停售")),
)
NEGATION_MARKERS = ("没有", "并未", "未被", "并非", "不是", "不存在", "未发现", "不能证明", "不能说明", "不能据此认定", "不等于", "并不意味着")
NEGATION_REACH, EVIDENCE_REACH = 14, 18

LABELS = ("positive", "neutral", "negative")
#: The offline classifier's words.
POSITIVE_WORDS = ("推荐", "值得", "优质", "可靠", "放心", "口碑好", "excellent", "reliable", "recommended", "worth")
NEGATIVE_WORDS = ("不推荐", "不值得", "投诉", "差评", "虚假", "风险", "poor", "unreliable", "complaint", "misleading")
CLASSIFIED = ("success", "success_with_warnings")
ERROR_STATUSES = ("failed", "rate_limited", "timeout")
RETRYABLE = ("rate_limit", "transient_api_error", "timeout", "network_error")

#: Lines of a recommendation card, as patterns.
CARD_DURATION, CARD_TITLE, CARD_CREATOR = r"\d{1,2}:\d{2}", r"\S(?:.{0,118}\S)", r"[A-Za-z0-9_\-一-鿿#?]{2,20}"

TRACKING_KEYS = ("spm", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
TOP_LIMIT = 10

PACKAGE_FILES = ("manifest.json", "tasks.jsonl", "answers.jsonl", "sources.jsonl", "checksums.json")
FORBIDDEN_FIELDS = ("mention", "sentiment", "metrics", "metric_result")
