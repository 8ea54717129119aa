"""Private names in files that should hold none."""

from __future__ import annotations

import re
import subprocess
from collections.abc import Sequence
from pathlib import Path


def tracked(root: str | Path) -> list[Path]:
    done = subprocess.run(["git", "-C", str(root), "ls-files", "-z"], capture_output=True, text=True, timeout=5, check=True)
    return [Path(root) / n for n in done.stdout.split("\0") if n]


def scan(files: Sequence[Path], terms: Sequence[str], least: int = 4) -> list[dict]:
    """Each place where a term of at least `least` characters stands as a whole."""
    wanted = sorted({t.strip() for t in terms if len(t.strip()) >= least}, key=len, reverse=True)
    if not wanted:
        return []
    pattern = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, wanted)) + r")(?!\w)", re.IGNORECASE)
    out = []
    for f in files:
        try:
            lines = f.read_text(encoding="utf-8").splitlines()
        except (UnicodeDecodeError, OSError):
            continue
        out += [{"file": str(f), "line": n, "term": m[1]} for n, line in enumerate(lines, 1) for m in pattern.finditer(line)]
    return out
