"""Settings with the defaults that the pipelines take (CFG-01, CFG-02, CFG-03, CFG-11)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class IngestSettings:
    catalogs: tuple[str, ...] = ("lake",)
    layers: dict[str, str] = field(default_factory=dict)
    schemas: tuple[str, ...] = ()
    sample_limit: int = 10
    cardinality_threshold: int = 50
    columns_per_scan: int = 50
    fk_threshold: float = 0.8
    fk_max_columns: int = 0
    embed_labels: tuple[str, ...] = ()
    embedding_dimension: int = 64
    embedding_model: str = "hash-64"
    embedding_failure_max: int = 0
    exact_cardinality: bool = False
    tables_per_batch: int = 200
    scoped_verification: bool = True

    def __post_init__(self) -> None:
        if min(self.sample_limit, self.cardinality_threshold, self.columns_per_scan, self.tables_per_batch) < 1:
            raise ValueError("sampling limits must be positive")
        if not 0 <= self.fk_threshold <= 1:
            raise ValueError("fk_threshold must lie between 0 and 1")
        if min(self.fk_max_columns, self.embedding_failure_max) < 0:
            raise ValueError("limits must not be negative")
        if not self.catalogs or any(not c for c in self.catalogs):
            raise ValueError("a catalog is needed")


@dataclass(frozen=True)
class RetrievalSettings:
    top_k: int = 5
    threshold: float = 0.8
    alpha: float = 0.5
    max_expansion_tables: int = 0
    inject_criteria: bool = True
    schemas: tuple[str, ...] = ()
    schema_dump_max_chars: int = 7500
