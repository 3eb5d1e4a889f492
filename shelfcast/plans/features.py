"""Queries for categorical encoding."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfcast.operators import encoding
from shelfcast.operators.encoding import CATEGORICALS, VECTOR_ORDER
from shelfcast.operators.indexing import category_index as number_categories
from shelfcast.plans.registry import PANEL_KEY, over_panel, over_rated, register
from shelfcast.plans.shared import stored_panel
from shelfcast.scratch import fresh_path
from shelfcast.sources.panel import rated_documents
from shelfcast.sources.scans import read_csv_typed
from shelfcast.sources.sinks import write_csv, write_parquet

_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM panel" for c in CATEGORICALS
)

INDEX_SQL = f""", pairs AS ({_PAIRS_SQL}),
  sizes AS (SELECT column_name, value, count(*) AS n FROM pairs WHERE value IS NOT NULL GROUP BY column_name, value),
  idx AS (
    SELECT column_name, value, n,
           CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) - 1 AS BIGINT) AS idx,
           count(*) OVER (PARTITION BY column_name) - 1 AS width
    FROM sizes
  )"""

# First slot of each block, and of the plain numbers after the blocks.
_BLOCKS = [name[1:] for name in VECTOR_ORDER if name.startswith("v")]
_NUMBERS = VECTOR_ORDER[len(_BLOCKS):]


def _width_of(columns: list[str]) -> str:
    parts = [f"(SELECT max(width) FROM idx WHERE column_name = '{c}')" for c in columns]
    return " + ".join(parts) if parts else "0"


def _slots_sql() -> str:
    hot = [
        f"""SELECT item_id, store_id, dn, CAST({_width_of(_BLOCKS[:i])} + idx AS INTEGER) AS slot, 1.0::DOUBLE AS value
        FROM panel JOIN idx ON column_name = '{c}' AND idx.value = CAST(panel.{c} AS VARCHAR) WHERE idx < width"""
        for i, c in enumerate(_BLOCKS)
    ]
    plain = [
        f"""SELECT item_id, store_id, dn, CAST({_width_of(_BLOCKS)} + {i} AS INTEGER) AS slot,
        CAST({c} AS DOUBLE) AS value FROM panel WHERE {c} <> 0"""
        for i, c in enumerate(_NUMBERS)
    ]
    return " UNION ALL ".join(hot + plain)


SLOTS_SQL = f"{INDEX_SQL}, slots AS ({_slots_sql()})"


@register("category_index", over_panel(f"{INDEX_SQL} SELECT column_name, value, n, idx FROM idx"))
def category_index(spark, sf_dir):
    return number_categories(stored_panel(spark, sf_dir), CATEGORICALS)


@register(
    "onehot_slots",
    over_panel(
        INDEX_SQL
        + " SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, item_id, store_id, dn, CAST(idx AS INTEGER) AS slot
            FROM panel JOIN idx ON column_name = '{c}' AND idx.value = CAST(panel.{c} AS VARCHAR) WHERE idx < width"""
            for c in CATEGORICALS
        )
        + ")"
    ),
)
def onehot_slots(spark, sf_dir):
    panel = stored_panel(spark, sf_dir).select("item_id", "store_id", "dn", "dept_id", "wday")
    hot = encoding.one_hot_by_join(panel, PANEL_KEY)
    set_slots = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.unwrap_udt(f"v{c}")["indices"].alias("slots"))
            for c in CATEGORICALS
        ]
    )
    blocks = hot.select(*PANEL_KEY, F.inline(set_slots))
    return blocks.select("column_name", *PANEL_KEY, F.explode("slots").alias("slot"))


@register("assemble_features", over_panel(f"{SLOTS_SQL} SELECT * FROM slots"))
def assemble_features(spark, sf_dir):
    columns = ["item_id", "store_id", "dept_id", "wday", *_NUMBERS]
    hot = encoding.one_hot_by_join(stored_panel(spark, sf_dir).select(*columns), PANEL_KEY)
    vectors = VectorAssembler(inputCols=VECTOR_ORDER, outputCol="features").transform(hot)
    return encoding.active_slots(vectors, PANEL_KEY)


@register(
    "prepare_panel",
    over_panel(
        f"""{SLOTS_SQL}, packed AS (
          SELECT item_id, store_id, dn, string_agg(slot, ',' ORDER BY slot) AS slots, sum(value) AS slot_total
          FROM slots GROUP BY item_id, store_id, dn)
        SELECT year, month, dn, wday, snap, dept_id, item_id, store_id, sales, flag_ram, Sales_Pred, label,
               slots, slot_total FROM panel JOIN packed USING (item_id, store_id, dn)"""
    ),
)
def prepare_panel(spark, sf_dir):
    prepared = encoding.prepared_panel_by_join(stored_panel(spark, sf_dir), PANEL_KEY)
    path = fresh_path(spark, "prepared")
    write_parquet(prepared, path)
    raw = F.unwrap_udt("features")
    total = F.aggregate(raw["values"], F.lit(0.0), lambda a, v: a + v)
    stored = spark.read.parquet(path)
    return stored.withColumns(
        {"slots": F.array_join(raw["indices"].cast("array<string>"), ","), "slot_total": total}
    ).drop("features")


@register(
    "vector_width",
    over_panel(
        f"""{INDEX_SQL} SELECT CAST({_width_of(_BLOCKS)} + {len(_NUMBERS)} AS INTEGER) AS width, count(*) AS n_rows
        FROM panel"""
    ),
)
def vector_width(spark, sf_dir):
    prepared = encoding.prepared_panel_by_join(stored_panel(spark, sf_dir), PANEL_KEY)
    return encoding.vector_width(prepared)


_LANGS = ["de", "en", "es", "fr"]
_SOURCES = sorted(f"src{n}" for n in range(20))


_DUMMIES_SQL = over_rated(
    " SELECT doc_id, n_chars, quality, "
    + ", ".join(f"CAST(COALESCE(lang = '{v}', FALSE) AS INTEGER) AS lang_{v}" for v in _LANGS)
    + ", "
    + ", ".join(f"CAST(COALESCE(source = '{v}', FALSE) AS INTEGER) AS source_{v}" for v in _SOURCES)
    + " FROM rated"
)


@register("dummy_columns", _DUMMIES_SQL)
def dummy_columns(spark, sf_dir):
    rated = rated_documents(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", "quality")
    return encoding.dummy_columns(rated, ["lang", "source"])


@register("sink_dummy_columns", _DUMMIES_SQL)
def sink_dummy_columns(spark, sf_dir):
    """The encoded table as CSV, read back by its own types."""
    table = dummy_columns(spark, sf_dir)
    path = fresh_path(spark, "dummies-csv")
    write_csv(table, path)
    return read_csv_typed(spark, path, table.schema)
