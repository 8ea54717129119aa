"""One manifest form for all stages: what ran, from what, and what it wrote, with digests that can be checked later."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from pathlib import Path

from .provenance import file_sha256

VERSION = 1
STAGES = ("catalog", "build", "task")
REQUIRED = {"version": int, "stage": str, "run_id": str, "started": str, "finished": str, "status": str, "provenance": dict, "written": list, "warnings": list, "errors": list}


def envelope(stage: str, run_id: str, started: datetime, status: str, provenance: dict, written: list[dict], warnings: list[str], errors: list[str], **body) -> dict:
    return {"version": VERSION, "stage": stage, "run_id": run_id, "started": started.isoformat(), "finished": datetime.now(UTC).isoformat(), "status": status, "provenance": provenance, "written": written, "warnings": warnings, "errors": errors, **body}


def files(folder: Path, names: list[str]) -> list[dict]:
    return [{"name": n, "bytes": (folder / n).stat().st_size, "sha256": file_sha256(folder / n)} for n in sorted(names)]


def validate(record: dict) -> None:
    faults = [f"{k} is missing" if k not in record else f"{k} isn't {t.__name__}" for k, t in REQUIRED.items() if not isinstance(record.get(k), t)]
    if record.get("stage") not in STAGES:
        faults.append(f"stage {record.get('stage')!r} is none of {', '.join(STAGES)}")
    if record.get("status") not in ("complete", "failed"):
        faults.append(f"status {record.get('status')!r}")
    if record.get("status") == "complete" and record.get("errors"):
        faults.append("complete, with errors")
    if faults:
        raise ValueError("manifest: " + "; ".join(faults))


def dumps(record: dict) -> str:
    validate(record)
    return json.dumps(record, indent=2, sort_keys=True, allow_nan=False) + "\n"


def verify(path: Path) -> list[str]:
    """What is no longer as the manifest says."""
    record = json.loads(path.read_text())
    validate(record)
    out = []
    for f in record["written"]:
        at = path.parent / f["name"]
        if not at.exists():
            out.append(f"{f['name']}: gone")
        elif file_sha256(at) != f["sha256"]:
            out.append(f"{f['name']}: changed")
    return out


def upstream(record: dict, content_digest: str, catalog_digest: str | None = None) -> list[str]:
    """Whether a task's inputs are those that a build's manifest describes."""
    out = []
    if record.get("content_digest") != content_digest:
        out.append("the batch table isn't the one that the build wrote")
    if catalog_digest is not None and record.get("catalog_digest") not in (None, catalog_digest):
        out.append("the catalog has changed since the build")
    return out
