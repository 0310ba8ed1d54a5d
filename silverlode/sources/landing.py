"""Landing files written on the driver, byte for byte the same on every run."""

from __future__ import annotations

import csv
import io
import json
from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class LandingFile:
    source: str
    emitter: str | None
    name: str
    records: tuple[dict, ...]


def render(file: LandingFile, format: str, columns: list[str]) -> bytes:
    """CSV with contract columns, extras by name, then the position; or JSON lines with sorted keys."""
    if format == "json":
        lines = (json.dumps({k: None if v is None else str(v) for k, v in r.items()}, sort_keys=True, ensure_ascii=False) for r in file.records)
        return "".join(line + "\n" for line in lines).encode()
    extras = sorted({k for r in file.records for k in r} - {*columns, "_ingestion_order"})
    out = io.StringIO()
    writer = csv.DictWriter(out, [*columns, *extras, "_ingestion_order"], lineterminator="\n", restval="")
    writer.writeheader()
    writer.writerows({k: "" if v is None else v for k, v in r.items()} for r in file.records)
    return out.getvalue().encode()


def write(files: list[LandingFile], root: str, sources: dict, contracts: dict) -> list[Path]:
    """Files at the paths of their sources under a local or mounted root."""
    out = []
    for f in files:
        source = sources[f.source]
        at = Path(root) / source.paths[f.emitter if source.emitters else None] / f.name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(render(f, source.format, list(contracts[f.source].columns)))
        out.append(at)
    return out
