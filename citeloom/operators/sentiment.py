"""Sentiment of answers that mention a target: classifier, priority rules, rates per scope."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom.functions import text
from citeloom.operators.mention import Targets, build_targets, mention_detail, scope_frame

Rules = Sequence[tuple[str, Sequence[str]]]


class ProviderError(RuntimeError):
    """A failure of a classifier's service; ``error_type`` is one of rate_limit, transient_api_error, api_error, timeout, network_error, invalid_response, ..."""

    def __init__(self, error_type: str, message: str):
        super().__init__(message)
        self.error_type = error_type

    @property
    def retryable(self) -> bool:
        return self.error_type in C.RETRYABLE


class Classifier(Protocol):
    """The plug-in point: a label for a text about a target. Instances are pickled to the executors."""

    def classify(self, answer_text: str, target_id: str, aliases: Sequence[str]) -> str: ...


class LexiconClassifier:
    """The offline default: the sign of the number of positive less negative words."""

    name = "lexicon"

    def __init__(self, positive: Sequence[str], negative: Sequence[str]):
        self.positive, self.negative = tuple(positive), tuple(negative)

    def classify(self, answer_text: str, target_id: str, aliases: Sequence[str]) -> str:
        lower = answer_text.lower()
        score = sum(lower.count(w) for w in self.positive) - sum(lower.count(w) for w in self.negative)
        return "positive" if score > 0 else "negative" if score < 0 else "neutral"

    def column(self, answer: Column) -> Column:
        """The same in the JVM."""

        def count(words: Sequence[str]) -> Column:
            total = F.lit(0)
            for w in words:
                total = total + (F.length(F.lower(answer)) - F.length(F.replace(F.lower(answer), F.lit(w), F.lit("")))) / len(w)
            return total

        score = count(self.positive) - count(self.negative)
        return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


class RetryingClassifier:
    """Retries retryable provider errors inside the task; the last delay stands for further ones."""

    def __init__(self, inner: Classifier, max_retries: int = 2, backoff_seconds: Sequence[float] = (3.0, 8.0),
        sleep: Callable[[float], None] = time.sleep):
        self.inner, self.max_retries, self.backoff, self.sleep = inner, max_retries, tuple(backoff_seconds), sleep
        self.name = classifier_name(inner)

    def classify(self, answer_text: str, target_id: str, aliases: Sequence[str]) -> str:
        for attempt in range(self.max_retries + 1):
            try:
                return self.inner.classify(answer_text, target_id, aliases)
            except ProviderError as error:
                if not error.retryable or attempt == self.max_retries:
                    raise
                if self.backoff:
                    self.sleep(self.backoff[min(attempt, len(self.backoff) - 1)])
        raise AssertionError("unreachable")


class HttpClassifier:
    """A chat service that answers with a JSON label; the transport is a parameter (urllib by default)."""

    name = "http"

    def __init__(self, base_url: str, model: str, timeout_seconds: int = 120,
        post: Callable[[str, dict, int], tuple[int, str]] | None = None):
        self.base_url, self.model, self.timeout, self.post = base_url.rstrip("/"), model, timeout_seconds, post

    def classify(self, answer_text: str, target_id: str, aliases: Sequence[str]) -> str:
        import json

        ask = f"Label the sentiment towards {aliases[0]} in the text as positive, neutral or negative. Answer as JSON with the key label.\n\n{answer_text}"
        body = {"model": self.model, "stream": False, "format": "json", "options": {"temperature": 0},
            "messages": [{"role": "user", "content": ask}]}
        try:
            status, content = (self.post or _post)(f"{self.base_url}/api/chat", body, self.timeout)
        except TimeoutError as error:
            raise ProviderError("timeout", str(error)) from error
        except OSError as error:
            raise ProviderError("network_error", str(error)) from error
        if status != 200:
            raise ProviderError("rate_limit" if status == 429 else "transient_api_error" if status >= 500 else "api_error",
                f"HTTP {status}")
        try:
            return json.loads(json.loads(content)["message"]["content"])["label"]
        except (ValueError, KeyError, TypeError) as error:
            raise ProviderError("invalid_response", str(error)) from error


def _post(url: str, body: dict, timeout: int) -> tuple[int, str]:
    import json
    import urllib.error
    import urllib.request

    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.status, response.read().decode()
    except urllib.error.HTTPError as error:
        return error.code, ""
    except urllib.error.URLError as error:
        if isinstance(error.reason, TimeoutError):
            raise error.reason from error
        raise


PROVIDERS: dict[str, Callable[..., Classifier]] = {"lexicon": LexiconClassifier, "http": HttpClassifier}


def create_classifier(provider: str, max_retries: int = 0, backoff_seconds: Sequence[float] = (3.0, 8.0), **options: object) -> Classifier:
    if provider not in PROVIDERS:
        raise ValueError(f"no provider {provider!r}; there are {sorted(PROVIDERS)}")
    made = PROVIDERS[provider](**options)
    return RetryingClassifier(made, max_retries, backoff_seconds) if max_retries else made


def classifier_name(classifier: object) -> str:
    return getattr(classifier, "name", None) or type(classifier).__name__


def _classified(rows: DataFrame, targets: Targets, classifier: Classifier) -> DataFrame:
    """``rows`` with label, error_type and error_message by the classifier, one call per row."""
    if isinstance(classifier, LexiconClassifier):
        none = F.lit(None).cast("string")
        return rows.withColumns({"label": classifier.column(F.col("answer")), "error_type": none, "error_message": none})

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for answer, target in zip(b["answer"], b["target_id"], strict=True):
                try:
                    raw = classifier.classify(answer, target, targets[target])
                    label = raw.strip().lower() if isinstance(raw, str) else None
                    if label not in C.LABELS:
                        raise ValueError(f"label {raw!r} is none of {', '.join(C.LABELS)}")
                    out.append((label, None, None))
                except ProviderError as error:
                    out.append((None, error.error_type, str(error)))
                except Exception as error:  # noqa: BLE001 - a row's failure is a result
                    out.append((None, type(error).__name__, str(error)))
            yield b.assign(**dict(zip(("label", "error_type", "error_message"), map(list, zip(*out, strict=True)) if out else ([], [], []),
                strict=True)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", label string, error_type string, error_message string"
    return rows.mapInPandas(call, schema)


def sentiment_detail(
    items: DataFrame, targets: Targets, classifier: Classifier, rules: dict[str, Rules] | None = None,
    markers: Sequence[str] = C.NEGATION_MARKERS
) -> DataFrame:
    """One row per item and target; items that are not classified are not_applicable.

    ``rules`` holds the priority rules of each target_id. Only planned rows reach the classifier:
    they are branched off before it and the rest is added by union.
    """
    targets, rules = build_targets(targets), rules or {}
    none = F.lit(None).cast("string")
    everything = items.select("question_id", "mode", "item_pos", F.explode(F.array(*[F.lit(t) for t in targets])).alias("target_id"))
    mentioned = mention_detail(items, targets).where("mentioned").select("item_pos", "target_id")
    planned_rows = items.select("question_id", "mode", "item_pos", "answer").join(mentioned, "item_pos")
    labelled = _classified(planned_rows.select("question_id", "mode", "item_pos", "answer", "target_id"), targets, classifier)
    normal = text.normalize(F.col("answer"))
    labelled = labelled.withColumn("_text", normal)
    hits = F.array().cast("array<struct<rule:string,term:string,start:int,evidence:string>>")
    for target, own in rules.items():
        hits = F.when(F.col("target_id") == target, text.rule_hits(F.col("_text"), own, markers)).otherwise(hits)
    labelled = labelled.withColumn("_hits", F.when(F.col("label").isNotNull(), hits))
    hit = F.coalesce(F.size("_hits") > 0, F.lit(False))
    override = hit & (F.col("label") != "negative")
    planned = labelled.select(
        "question_id", "mode", "item_pos", "target_id",
        F.lit(True).alias("classification_planned"),
        F.when(F.col("label").isNull(), F.when(F.col("error_type") == "rate_limit", "rate_limited").when(F.col("error_type") == "timeout",
        "timeout").otherwise("failed"))
        .when(override, "success_with_warnings").otherwise("success").alias("sentiment_status"),
        F.col("label").alias("model_sentiment"),
        F.when(hit, "negative").otherwise(F.col("label")).alias("final_sentiment"),
        F.lit(classifier_name(classifier)).alias("provider"),
        F.when(hit, F.concat(F.lit("negative priority rule: "), F.array_join(F.array_distinct(F.col("_hits.rule")),
        ", "))).otherwise(F.col("error_message")).alias("reason"),
        F.when(hit, F.array_distinct(F.col("_hits.evidence"))).otherwise(F.array().cast("array<string>")).alias("evidence"),
        hit.alias("rule_hit"), F.coalesce(override, F.lit(False)).alias("rule_override"),
        F.when(override,
        F.array(F.lit("model sentiment overridden by negative priority rule"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
        "error_type", "error_message",
    )
    empty = F.array().cast("array<string>")
    rest = everything.join(mentioned, ["item_pos", "target_id"], "left_anti").select(
        "question_id", "mode", "item_pos", "target_id", F.lit(False).alias("classification_planned"),
        F.lit("not_applicable").alias("sentiment_status"),
        none.alias("model_sentiment"), none.alias("final_sentiment"), none.alias("provider"), none.alias("reason"), empty.alias("evidence"),
        F.lit(False).alias("rule_hit"),
        F.lit(False).alias("rule_override"), empty.alias("warnings"), none.alias("error_type"), none.alias("error_message"),
    )
    return planned.unionByName(rest)


def _classified_ok() -> Column:
    return F.col("classification_planned") & F.col("sentiment_status").isin(*C.CLASSIFIED) & F.col("final_sentiment").isin(*C.LABELS)


def sentiment_summary(detail: DataFrame, targets: Targets) -> DataFrame:
    """Counts and rates per (target_id, scope); a question takes its worst label, negative before positive before neutral."""
    ok = _classified_ok()
    count = lambda name: F.count_if(ok & (F.col("final_sentiment") == name)).alias(f"{name}_count")
    planned = detail.where("classification_planned")
    answers = planned.withColumn("scope", F.explode(F.array("mode", F.lit("all_answers")))).groupBy("target_id", "scope").agg(
        F.count(F.lit(1)).alias("planned_count"), F.count_if(ok).alias("classified_count"), *[count(n) for n in C.LABELS]
    )
    weight = F.when(~ok, 0).when(F.col("final_sentiment") == "negative", 3).when(F.col("final_sentiment") == "positive", 2).otherwise(1)
    by_question = planned.groupBy("target_id", "question_id").agg(F.max(weight).alias("_w"))
    questions = by_question.groupBy("target_id").agg(
        F.lit("question_level").alias("scope"), F.count(F.lit(1)).alias("planned_count"),
        F.count_if(F.col("_w") > 0).alias("classified_count"),
        *[F.count_if(F.col("_w") == w).alias(f"{n}_count") for n, w in (("positive", 2), ("neutral", 1), ("negative", 3))],
    )
    found = answers.unionByName(questions)
    frame = scope_frame(detail, targets, (*C.MODES, "all_answers", "question_level"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    counts = ("planned_count", "classified_count", *[f"{n}_count" for n in C.LABELS])
    out = frame.join(found, ["target_id", "scope"], "left").select("target_id", "scope", *[zero(c) for c in counts])
    out = out.withColumns({"failed_count": F.col("planned_count") - F.col("classified_count"),
        "non_negative_count": F.col("positive_count") + F.col("neutral_count")})
    return out.withColumns({f"{n}_rate": text.ratio(F.col(f"{n}_count"), F.col("classified_count")) for n in (*C.LABELS, "non_negative")})


def error_count(detail: DataFrame) -> DataFrame:
    """One row: how many rows ended in an error status."""
    return detail.agg(F.count_if(F.col("sentiment_status").isin(*C.ERROR_STATUSES)).alias("error_count"))
