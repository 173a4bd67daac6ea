"""Stable ids and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sure(c: Column, what: str) -> Column:
    return F.when(c.isNotNull(), c.cast("string")).otherwise(F.raise_error(F.lit(f"{what} must not be null")))


def stable_id(prefix: Column, *parts: tuple[str, Column]) -> Column:
    """prefix_ and 16 hex digits of the SHA-1 of the parts joined by '|'; a null part is an error, not skipped."""
    digest = F.sha1(F.concat_ws("|", *[_sure(c, name) for name, c in parts]).cast("binary"))
    return F.concat(prefix, F.lit("_"), F.substring(digest, 1, 16))


def task_id(platform: Column, batch_id: Column, question_id: Column, mode: Column) -> Column:
    return stable_id(F.concat(platform, F.lit("_task")), ("batch_id", batch_id), ("question_id", question_id), ("mode", mode))


def answer_id(platform: Column, task: Column) -> Column:
    return stable_id(F.concat(platform, F.lit("_answer")), ("task_id", task))


def source_id(platform: Column, answer: Column, order: Column, url: Column) -> Column:
    return stable_id(F.concat(platform, F.lit("_source")), ("answer_id", answer), ("source_order", order), ("url", url))


def legacy_source_id(question_id: Column, mode: Column, rank: Column, url: Column) -> Column:
    """12 hex digits; the parts as in ``stable_id``."""
    parts = [_sure(c, n) for n, c in (("question_id", question_id), ("mode", mode), ("rank", rank), ("url", url))]
    return F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, 12)


def checksum(c: Column) -> Column:
    """SHA-256 in hex of a text's UTF-8 bytes or of binary content."""
    return F.sha2(c.cast("binary"), 256)
