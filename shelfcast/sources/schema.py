"""The panel contract and checks against it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_INT, _TEXT, _NUMBER = T.IntegerType(), T.StringType(), T.DoubleType()

# Names, order and types of the panel fields.
_PANEL_FIELDS = {
    "year": _INT,
    "month": _INT,
    "dn": _INT,
    "wday": _INT,
    "snap": _INT,
    "dept_id": _TEXT,
    "item_id": _TEXT,
    "store_id": _TEXT,
    "sales": _NUMBER,
    "flag_ram": _INT,
    "Sales_Pred": _NUMBER,
}


def _schema(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PANEL_SCHEMA = _schema(_PANEL_FIELDS)
LABELLED_SCHEMA = _schema(_PANEL_FIELDS | {"label": _NUMBER})


def to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select the contract's columns in its order and types; every one must exist."""
    missing = [name for name in contract.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])


def columns_by_kind(schema: T.StructType) -> dict[str, str]:
    """Column name -> ``numeric`` or ``categorical``, judged by type."""
    return {
        f.name: "numeric" if isinstance(f.dataType, T.NumericType) else "categorical"
        for f in schema
    }


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in columns_by_kind(df.schema).items() if kind == "numeric"]


def feature_columns(df: DataFrame, excluded: list[str]) -> list[str]:
    """All columns but the excluded ones, in table order."""
    return [c for c in df.columns if c not in set(excluded)]


def numbered_names(prefix: str, first: int, last: int) -> list[str]:
    """``prefix1, prefix2, ...`` for the numbers first..last."""
    return [f"{prefix}{n}" for n in range(first, last + 1)]
