"""Lake paths: forward slashes, no empty segments, no `.` or `..`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_path(path: str) -> str:
    """The cleaned path of a file to write; raises when nothing is left or it tries to climb."""
    segments = [segment.strip() for segment in path.replace("\\", "/").split("/")]
    segments = [segment for segment in segments if segment]
    if not segments or "." in segments or ".." in segments:
        raise ValueError("Invalid path: a file name is needed, without '.' or '..' segments.")
    return "/".join(segments)


def normalized_path(path: Column) -> Column:
    """`normalize_path` for a column; a rejected path becomes NULL."""
    segments = F.transform(F.split(F.translate(path, "\\", "/"), "/"), lambda s: F.btrim(s, F.lit(" \t\r\n\f\x0b")))
    segments = F.filter(segments, lambda s: s != "")
    rejected = (F.size(segments) == 0) | F.arrays_overlap(segments, F.array(F.lit("."), F.lit("..")))
    return F.when(~rejected, F.array_join(segments, "/"))


def check_extension(path: str, extensions: list[str]) -> None:
    if not any(path.lower().endswith(extension) for extension in extensions):
        raise ValueError(f"The path must end in {' or '.join(extensions)}.")
