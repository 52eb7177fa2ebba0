"""The dataset specification: everything one load needs to know, checked once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from .functions.tags import TAG_COLUMN, normalized_name

DQ_MODES = ("flag", "cascade")


@dataclass(frozen=True)
class ColumnSpec:
    """One declared column: where it comes from, what it becomes, what it must obey."""

    source: str
    target: str
    source_type: str
    target_type: str
    nullable: bool = True
    regex: str = ""
    sensitivity: str | None = None

    @property
    def is_cast(self) -> bool:
        return self.source_type != self.target_type

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> ColumnSpec:
        return cls(
            source=raw["src_nm"],
            target=raw["tgt_nm"],
            source_type=raw["src_dtype"],
            target_type=raw["tgt_dtype"],
            nullable=bool(raw.get("nullable", True)),
            regex=raw.get("regex") or "",
            sensitivity=raw.get("sensitivity"),
        )


@dataclass(frozen=True)
class TableSpec:
    """A catalog table that receives the curated rows."""

    catalog: str
    database: str
    table: str
    partition_columns: tuple[str, ...] = (TAG_COLUMN,)
    provider: str = "iceberg"
    location: str | None = None
    #: Add columns that the table lacks, instead of refusing to publish them.
    evolve: bool = False

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> TableSpec:
        return cls(
            catalog=raw["catalog"],
            database=raw["database"],
            table=raw["table"],
            partition_columns=tuple(raw.get("partition_cols", (TAG_COLUMN,))),
            provider=raw.get("provider", "iceberg"),
            location=raw.get("location"),
            evolve=bool(raw.get("evolve", False)),
        )


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset. Field names of the JSON form are those ``from_dict`` reads."""

    name: str
    source_path: str
    format: str
    columns: tuple[ColumnSpec, ...] = ()
    version: str | None = None
    id_columns: tuple[str, ...] = ()
    update_columns: tuple[str, ...] = ()
    where: str = ""
    domicile: str = "global"
    check_schema: bool = True
    allow_extra_columns: bool = True
    allow_missing_columns: bool = False
    check_row_count: bool = True
    dq_mode: str = "flag"
    table: TableSpec | None = None

    def __post_init__(self) -> None:
        if self.dq_mode not in DQ_MODES:
            raise ValueError(f"dq_mode must be one of {DQ_MODES}, not {self.dq_mode!r}")
        for what in ("source", "target"):
            names = [getattr(c, what) for c in self.columns]
            twice = sorted({n for n in names if names.count(n) > 1})
            if twice:
                raise ValueError(f"{what} column declared twice: {', '.join(twice)}")

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any], name: str | None = None) -> DatasetSpec:
        """Build from the JSON form, with or without its outer ``ds`` key."""
        ds = raw.get("ds", raw)
        rules = ds.get("dq_rules") or {}
        table = ds.get("iceberg") or {}
        return cls(
            name=ds.get("nm") or name or "dataset",
            version=ds.get("ver"),
            source_path=ds["src_prefix"],
            format=ds["format"],
            columns=tuple(ColumnSpec.from_dict(c) for c in ds["cols"]),
            id_columns=tuple(ds.get("id_cols") or ()),
            update_columns=tuple(ds.get("upd_cols") or ()),
            where=(ds.get("custom_sql_stmt") or "").strip(),
            domicile=normalized_name(ds.get("domicile")),
            check_schema=rules.get("check_schema", True),
            allow_extra_columns=rules.get("allow_extra_columns", True),
            allow_missing_columns=rules.get("allow_missing_columns", False),
            check_row_count=rules.get("check_row_count", True),
            dq_mode=rules.get("mode", "flag"),
            table=TableSpec.from_dict(table) if table.get("enabled") else None,
        )

    def merge_keys(self) -> tuple[str, ...]:
        """Columns that identify a row in an upsert: the key plus the tag."""
        keys: Sequence[str] = self.id_columns
        if not keys:
            raise ValueError(f"{self.name}: an incremental table load needs id_cols")
        tagged = any(key.lower() == TAG_COLUMN for key in keys)
        return tuple(keys) if tagged else (*keys, TAG_COLUMN)
