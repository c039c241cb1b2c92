"""Plain dataclasses that describe datasets, target tables and loads.

These replace the reference's metadata service: a caller builds them directly (or from
the same JSON records through ``from_record``)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

LOAD_TYPES = ("full", "incremental")
CORRUPT_COLUMN = "_corrupt_line"  # the raw line's column, where a load with a quarantine names none


@dataclass(frozen=True)
class DatasetSpec:
    """A source or sink dataset.

    ``kind`` is one of ``delimited`` (local or object-store delimited file), ``table``
    (catalog table) or ``sql_file`` (a query text whose result is the dataset)."""

    dataset_id: str
    kind: str = "delimited"
    path_template: str | None = None
    delimiter: str = ","
    header: bool = True
    data_source_user: str | None = None
    recon_path_template: str | None = None
    recon_delimiter: str = "|"
    sql_path: str | None = None
    table: "TableSpec | None" = None
    # Extra CSV reader options (quote, escape, encoding, nullValue, multiLine, ...).
    # multiLine makes each file one split: keep it for files that need it.
    options: Mapping[str, Any] = field(default_factory=dict)

    @staticmethod
    def from_record(rec: Mapping[str, Any]) -> "DatasetSpec":
        kinds = {
            "local delim file": "delimited",
            "aws s3 delim file": "delimited",
            "spark table": "table",
            "spark sql file": "sql_file",
        }
        kind = kinds.get(str(rec.get("dataset_type", "")).lower())
        if kind is None:
            raise RuntimeError(f"dataset {rec.get('dataset_id')}: unknown dataset_type {rec.get('dataset_type')!r}")
        table = None
        if kind == "table":
            table = TableSpec(rec["database_name"], rec["table_name"], tuple(rec.get("partition_keys") or ()))
        return DatasetSpec(
            dataset_id=rec["dataset_id"],
            kind=kind,
            path_template=rec.get("file_path"),
            delimiter=rec.get("file_delim") or ",",
            data_source_user=rec.get("data_source_user"),
            recon_path_template=rec.get("recon_file_path"),
            recon_delimiter=rec.get("recon_file_delim") or "|",
            sql_path=rec.get("sql_file_path"),
            table=table,
        )


@dataclass(frozen=True)
class TableSpec:
    database: str
    name: str
    partition_keys: tuple[str, ...] = ()
    dataset_id: str | None = None  # name used for lineage; the qualified name when unset

    @property
    def qualified(self) -> str:
        return f"{self.database}.{self.name}"


@dataclass(frozen=True)
class LoadSpec:
    """One load: dated delimited source(s) into one catalog table."""

    source: DatasetSpec
    target: TableSpec
    columns: Sequence[Mapping[str, str]]
    load_type: str = "incremental"
    effective_dates: tuple[str, ...] = ()
    # The source schedule may name files by a different date than the target's
    # effective date; when set, file paths are resolved from these dates instead.
    source_dates: tuple[str, ...] | None = None
    date_column: str = "effective_date"
    date_from_path: bool = False
    warehouse_path: str | None = None
    parity: bool = False
    strict: bool = False
    rebalance: bool = False
    # Name of a column that receives the raw text of lines that do not parse; such
    # rows are counted during the load (``LoadResult.corrupt_count``) and the column is
    # not written to the table.
    corrupt_column: str | None = None
    # Table of lines that do not parse (needs ``corrupt_column``): such lines go there, with file and
    # date, and only parsed rows reach the target.
    quarantine_table: str | None = None
    # Table of the target's stored daily state (``operators/state.py``), kept up by every load.
    state_table: str | None = None
    state_columns: tuple[str, ...] | None = None
    # An append (incremental, no partition keys) that a rerun repeats without effect: files that the
    # target's ledger names are not loaded again (``sinks/ledger.py``).
    ledger: bool = False
