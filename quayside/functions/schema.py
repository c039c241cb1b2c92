"""Column spec (``[{"column_name": ..., "data_type": ...}]``) to ``StructType``."""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import types as T

# Fixed value: in parity mode only a type text starting with this exact, case-sensitive
# prefix becomes a decimal; every other type text becomes a string.
PARITY_DECIMAL_PREFIX = "decimal"
# Fixed value: precision and scale used when a parity decimal does not give both.
PARITY_DEFAULT_DECIMAL = (10, 0)

_PREC_SCALE = re.compile(r"\(\s*(\d+)\s*,\s*(\d+)\s*\)\s*$")


def _parity_type(type_text: str) -> T.DataType:
    if not type_text.startswith(PARITY_DECIMAL_PREFIX):
        return T.StringType()
    m = _PREC_SCALE.search(type_text)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    return T.DecimalType(*PARITY_DEFAULT_DECIMAL)


def _ddl_type(type_text: str) -> T.DataType:
    # Any Spark DDL type: decimal(12) keeps precision 12, DECIMAL(12,2) is a decimal, etc.
    return T.DataType.fromDDL(type_text.strip())


def column_spec_to_schema(columns: Sequence[Mapping[str, str]], parity: bool = False) -> T.StructType:
    """Build the declared schema. ``parity=True`` keeps the two-type mapping (decimal or
    string); otherwise every Spark DDL type is honoured. Columns are always nullable and
    names are kept exactly as given."""
    if not columns:
        raise ValueError("column spec is empty")
    fields = []
    seen = set()
    for col in columns:
        name = col["column_name"]
        type_text = col["data_type"]
        if name.lower() in seen:
            raise ValueError(f"column {name!r} is declared twice")
        seen.add(name.lower())
        dtype = _parity_type(type_text) if parity else _ddl_type(type_text)
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def schema_to_column_spec(schema: T.StructType) -> list[dict[str, str]]:
    return [{"column_name": f.name, "data_type": f.dataType.simpleString()} for f in schema.fields]
