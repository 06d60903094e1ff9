"""Settings with their defaults; fixed values of the chunking rules."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from logging.handlers import RotatingFileHandler

#: Rules in order, the first whose keyword occurs decides.
DENSE = {"keywords": ["results", "data", "table", "figure", "methods", "methodology", "pharmacoeconomic", "cost-effectiveness", "safety", "adverse events", "statistics"], "chunk_size": 512, "overlap": 100}
NARRATIVE = {"keywords": ["introduction", "background", "discussion", "conclusion", "summary", "abstract", "appendix", "appendices", "glossary"], "chunk_size": 1536, "overlap": 250}


@dataclass(frozen=True)
class Config:
    rules: list[dict] = field(default_factory=lambda: [DENSE, NARRATIVE])
    default_chunk: tuple[int, int] = (1024, 200)
    page_threshold: float = 0.6
    completeness: float = 0.95
    batch: int = 100

    @classmethod
    def from_dict(cls, d: dict) -> Config:
        """Settings by the names of a configuration file; what isn't there keeps its default."""
        base = cls()
        chunk = d.get("default_chunking", {})
        return cls(
            d.get("adaptive_chunking_rules", base.rules),
            (chunk.get("chunk_size", base.default_chunk[0]), chunk.get("overlap", base.default_chunk[1])),
            d.get("deconstruction_configs", {}).get("footer_header_page_threshold", base.page_threshold),
            d.get("validation_rules", {}).get("completeness_threshold", base.completeness),
            d.get("batch_size", base.batch),
        )


def resolve_paths(node, root: str):
    """A configuration with ${root} replaced in all its strings."""
    if isinstance(node, dict):
        return {k: resolve_paths(v, root) for k, v in node.items()}
    if isinstance(node, list):
        return [resolve_paths(v, root) for v in node]
    return node.replace("${root}", root) if isinstance(node, str) else node


def logger(name: str, file: str | None = None, level: int = logging.INFO, size: int = 5_000_000, backups: int = 3) -> logging.Logger:
    """The driver's log: to the console and, where a file is given, to it, begun anew when it is full. Asking again gives the same log, no second handler."""
    log = logging.getLogger(name)
    log.setLevel(level)
    form = logging.Formatter("%(asctime)s [%(levelname)s] %(message)s", datefmt="%Y-%m-%d %H:%M:%S")
    have = {getattr(h, "baseFilename", "console") for h in log.handlers}
    new = [logging.StreamHandler()] if "console" not in have else []
    if file and not any(x.endswith(file) for x in have):
        new.append(RotatingFileHandler(file, maxBytes=size, backupCount=backups, encoding="utf-8"))
    for h in new:
        h.setFormatter(form)
        log.addHandler(h)
    return log
