"""Settings of the classifier from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from citeloom import constants as C
from citeloom.operators import sentiment


@dataclass(frozen=True)
class SentimentConfig:
    provider: str = "lexicon"
    model: str = ""
    base_url: str = "http://127.0.0.1:11434"
    timeout_seconds: int = 120
    max_retries: int = 2
    retry_backoff_seconds: tuple[float, ...] = (3.0, 8.0)

    def classifier(self, **options: object) -> sentiment.Classifier:
        if self.provider == "http":
            options = {"base_url": self.base_url, "model": self.model, "timeout_seconds": self.timeout_seconds, **options}
        elif self.provider == "lexicon":
            options = {"positive": C.POSITIVE_WORDS, "negative": C.NEGATIVE_WORDS, **options}
        return sentiment.create_classifier(self.provider, self.max_retries, self.retry_backoff_seconds, **options)


def load_config(environment: Mapping[str, str] | None = None) -> SentimentConfig:
    """Settings by SENTIMENT_* variables; blank ones keep the default, bad ones are errors. An empty backoff list is no wait."""
    env = os.environ if environment is None else environment

    def number(name: str, default: int, least: int) -> int:
        raw = env.get(name, "").strip()
        if not raw:
            return default
        if not raw.lstrip("-").isdigit() or int(raw) < least:
            raise ValueError(f"{name} must be a whole number of at least {least}, not {raw!r}")
        return int(raw)

    base = SentimentConfig()
    backoff = base.retry_backoff_seconds
    if (raw := env.get("SENTIMENT_RETRY_BACKOFF_SECONDS")) is not None:
        try:
            backoff = tuple(float(x) for x in raw.split(",") if x.strip())
        except ValueError as error:
            raise ValueError(f"SENTIMENT_RETRY_BACKOFF_SECONDS must list seconds, not {raw!r}") from error
        if any(x < 0 for x in backoff):
            raise ValueError("SENTIMENT_RETRY_BACKOFF_SECONDS must not be negative")
    return SentimentConfig(
        env.get("SENTIMENT_PROVIDER", "").strip() or base.provider, env.get("SENTIMENT_MODEL", "").strip() or base.model,
        env.get("SENTIMENT_BASE_URL", "").strip() or base.base_url,
        number("SENTIMENT_REQUEST_TIMEOUT_SECONDS", base.timeout_seconds, 1), number("SENTIMENT_MAX_RETRIES", base.max_retries, 0), backoff,
    )
