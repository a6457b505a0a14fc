"""Names of versioned objects and track files, as columns and as strings."""

from __future__ import annotations

import os
import subprocess
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "__"
STAMP = "%Y%m%d%H%M%S"


def trip_id_of(name: Column) -> Column:
    """The digits between the last _ and .parquet; any other name stays as it is."""
    return F.regexp_replace(name, r"(?s)^.*_([0-9]+)\.parquet$", "$1")


def track_file(prefix: str, trip) -> str:
    return f"{prefix}_{trip}.parquet"


def parts_of(name: Column) -> tuple[Column, Column, Column]:
    """base_name, version and ext; a part that isn't there is null, more than three are dropped."""
    pieces = F.split(name, SEPARATOR)
    return F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1)), F.get(pieces, F.lit(2))


def _dotted(extension: str) -> str:
    return f".{extension}" if extension and not extension.startswith(".") else extension


def _short(commit: str | None, length: int) -> str:
    if length > 40:
        raise ValueError("a commit id has 40 characters at most")
    return (commit or "")[:length]


def commit_id() -> str:
    """COMMIT_SHA of the environment, else the commit of the working folder, else GITHUB_SHA, else nothing."""
    if given := os.environ.get("COMMIT_SHA"):
        return given
    try:
        return subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=True, timeout=10).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return os.environ.get("GITHUB_SHA", "")


def versioned(filename: str, extension: str = "", commit: str | None = None, length: int = 7, now: datetime | None = None, separator: str = SEPARATOR) -> str:
    """filename, the time and the commit (commit_id() if none is given), and the extension."""
    commit = _short(commit_id() if commit is None else commit, length)
    version = "_".join(x for x in ((now or datetime.now(UTC)).strftime(STAMP), commit) if x)
    return f"{filename}{separator}{version}{separator}{_dotted(extension)}"


def versioned_column(filename: Column, time: Column, extension: str = "", commit: str | None = None, length: int = 7, separator: str = SEPARATOR) -> Column:
    """versioned() with a column for the clock."""
    version = F.concat_ws("_", F.date_format(time, "yyyyMMddHHmmss"), *[F.lit(x) for x in [_short(commit, length)] if x])
    return F.concat(filename, F.lit(separator), version, F.lit(separator), F.lit(_dotted(extension)))
