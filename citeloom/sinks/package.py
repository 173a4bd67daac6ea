"""Package directories and archives.

Tables are written by Spark as JSON lines in parts; the single files a package asks for are made by
copying the parts one after another, so no table has to fit into the driver's memory.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from citeloom import constants as C

CHUNK = 1 << 20
#: Spark writes milliseconds by itself.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def json_lines(df: DataFrame, json_columns: tuple[str, ...] = ()) -> DataFrame:
    """One compact JSON object per row with nulls kept and non-ASCII unescaped; ``json_columns`` hold JSON and stay objects."""
    fields = [F.parse_json(F.col(c)).alias(c) if c in json_columns else F.col(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false", **EXACT_TIMES}).alias("value"))


def write_json_lines(df: DataFrame, path: str | Path, order: list[str], json_columns: tuple[str, ...] = ()) -> int:
    """One file of JSON lines in the given order; an empty table gives an empty file. The number of lines.

    Executors write parts beside the result, so its folder must be one they share with the driver:
    where the driver finds other lines than were written, that is an error.
    """
    path, written = Path(path), Observation()
    parts = Path(tempfile.mkdtemp(prefix=".parts-", dir=path.parent))  # beside the result, on its own file system
    try:
        counted = json_lines(df.orderBy(*order), json_columns).observe(written, F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").text(parts.as_uri())
        lines = 0
        with path.open("wb") as out:
            for part in sorted(parts.glob("part-*")):
                with part.open("rb") as source:
                    while chunk := source.read(CHUNK):
                        lines += chunk.count(b"\n")
                        out.write(chunk)
        if lines != written.get["n"]:
            path.unlink()
            raise RuntimeError(f"{written.get['n']} rows were written and {lines} found in {parts}: executors and driver must share the folder of {path}")
        return lines
    finally:
        shutil.rmtree(parts, ignore_errors=True)


def write_json(value: object, path: str | Path) -> None:
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str), encoding="utf-8")


def write_answer_files(answers: DataFrame, folder: str) -> None:
    """Answers as JSON, partitioned by mode."""
    answers.write.mode("overwrite").partitionBy("mode").options(ignoreNullFields="false", **EXACT_TIMES).json(folder)


def sha256_file(path: str | Path) -> str:
    digest = hashlib.sha256()
    with Path(path).open("rb") as f:
        while chunk := f.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def checksums(folder: DataFrame) -> DataFrame:
    """(file_name, sha256) of a ``binaryFile`` table, computed where the files are read."""
    return folder.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.sha2("content", 256).alias("sha256"))


def export_directory(tasks: DataFrame, answers: DataFrame, sources: DataFrame, manifest: dict, folder: str | Path) -> Path:
    """The five files of a package; counts, file list and checksums are filled in."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    counts = {
        "task_count": write_json_lines(tasks, folder / "tasks.jsonl", ["task_id"]),
        "answer_count": write_json_lines(answers, folder / "answers.jsonl", ["answer_id"], ("platform_meta_json",)),
        "source_count": write_json_lines(sources, folder / "sources.jsonl", ["answer_id", "source_order", "occurrence_id"]),
    }
    return _closed(folder, manifest, counts)


def export_legacy_directory(tasks: DataFrame, answers: DataFrame, sources: DataFrame, manifest: dict, folder: str | Path) -> Path:
    """The five files of the older package: rows are keyed by question and mode."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    counts = {
        "task_count": write_json_lines(tasks, folder / "tasks.jsonl", ["question_id", "mode"]),
        "answer_count": write_json_lines(answers, folder / "answers.jsonl", ["question_id", "mode"]),
        "source_count": write_json_lines(sources, folder / "sources.jsonl", ["question_id", "mode", "rank", "occurrence_id"]),
    }
    return _closed(folder, {"schema_version": C.BATCH_VERSION} | manifest, counts)


def _closed(folder: Path, manifest: dict, counts: dict) -> Path:
    write_json(manifest | counts | {"files": list(C.PACKAGE_FILES)}, folder / "manifest.json")
    write_json({n: sha256_file(folder / n) for n in C.PACKAGE_FILES if n != "checksums.json"}, folder / "checksums.json")
    return folder


def export_archive(folder: str | Path, archive: str | Path) -> Path:
    """A deflated archive of a package directory, members in fixed order, put in place when complete."""
    archive = Path(archive)
    partial = archive.with_suffix(".partial")
    with zipfile.ZipFile(partial, "w", zipfile.ZIP_DEFLATED) as out:
        for name in C.PACKAGE_FILES:
            out.write(Path(folder) / name, name)
    os.replace(partial, archive)
    return archive
