"""Categorical encoding and feature vectors on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    FeatureHasher,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.operators.indexing import category_index, with_category_numbers
from shelfcast.scratch import stage

# Encoded fields, and the order of the blocks in the feature vector.
CATEGORICALS = ["dept_id", "item_id", "store_id", "wday"]
NUMERICS = ["flag_ram", "snap", "dn", "month", "year"]
VECTOR_ORDER = ["vwday", "vitem_id", "vdept_id", "vstore_id", "flag_ram", "snap", "dn", "month", "year"]

HASH_SLOTS = 1024


def encoder(
    categoricals: Sequence[str] = CATEGORICALS,
    vector_order: Sequence[str] = VECTOR_ORDER,
    hashed: Sequence[str] = (),
    hash_slots: int = HASH_SLOTS,
    base_slot: bool = False,
    handle_invalid: str = "error",
) -> Pipeline:
    """Unfitted encoder chain ending in ``features``.

    Category numbers and one-hot blocks without their last category, but for the columns
    named in ``hashed``: those become ``hash_slots`` slots each. The data never decide
    which form a column gets, so a slot means the same at every size. The labels of an
    indexed column are held by the driver and every task; columns without a bound on their
    categories belong in ``hashed`` or are encoded by ``one_hot_by_join``.

    ``base_slot`` leaves out the last hash slot, whose categories then are the base that
    an intercept stands for. Linear models without a penalty need it, as the slots of a
    column always sum to the intercept; for trees it would hide those categories.
    """
    if not set(hashed) <= set(categoricals):
        raise ValueError("hashed columns must be categorical ones")
    indexed = [c for c in categoricals if c not in set(hashed)]
    stages = []
    if indexed:
        stages += [
            StringIndexer(
                inputCols=indexed,
                outputCols=[f"i{c}" for c in indexed],
                handleInvalid=handle_invalid,
            ),
            OneHotEncoder(
                inputCols=[f"i{c}" for c in indexed], outputCols=[f"v{c}" for c in indexed]
            ),
        ]
    for c in hashed:
        slots = f"h{c}" if base_slot else f"v{c}"
        stages.append(FeatureHasher(inputCols=[c], outputCol=slots, categoricalCols=[c], numFeatures=hash_slots))
        if base_slot:
            stages.append(VectorSlicer(inputCol=slots, outputCol=f"v{c}", indices=list(range(hash_slots - 1))))
    stages.append(VectorAssembler(inputCols=list(vector_order), outputCol="features"))
    return Pipeline(stages=stages)


def encoded(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply a fitted encoder and drop its helper columns."""
    result = model.transform(df)
    helpers = [c for c in result.columns if c not in df.columns and c != "features"]
    return result.drop(*helpers)


def prepared_panel(panel: DataFrame, **options) -> tuple[PipelineModel, DataFrame]:
    """Fit the encoder on all rows, known and to predict, and apply it.

    Fitting on both kinds leaves no unseen category for the prediction.
    """
    model = encoder(**options).fit(panel)
    return model, encoded(model, panel)


def prepared_panel_by_join(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The panel with exact ``features``, numbered by join: same vectors as
    ``prepared_panel`` without hashed columns, and no labels on the driver.

    The vectors are made of the numbers at once. An assembler names each slot in the
    metadata of its column, which for millions of items fills the driver.
    """
    numbered = numbered_by_join(panel, keys, CATEGORICALS)
    return numbered.select(*panel.columns, assembled(numbered, VECTOR_ORDER))


def numbered_by_join(df: DataFrame, keys: Sequence[str], categoricals: Sequence[str]) -> DataFrame:
    """``i<column>``, the category number, for each column, without a limit on categories."""
    index = stage(category_index(df, categoricals), "category-index")
    return with_category_numbers(df, index, categoricals, keys)


def one_hot_by_join(
    df: DataFrame, keys: Sequence[str], categoricals: Sequence[str] = CATEGORICALS
) -> DataFrame:
    """One-hot blocks ``v<column>`` without a limit on the number of categories.

    The numbered columns carry their sizes as metadata, so fitting reads no rows.
    """
    numbered = numbered_by_join(df, keys, categoricals)
    blocks = OneHotEncoder(
        inputCols=[f"i{c}" for c in categoricals], outputCols=[f"v{c}" for c in categoricals]
    )
    return blocks.fit(numbered).transform(numbered).drop(*[f"i{c}" for c in categoricals])


def assembled(numbered: DataFrame, vector_order: Sequence[str], name: str = "features") -> Column:
    """The vectors that one-hot blocks (``v<column>``, of the numbers ``i<column>``) and plain
    numbers make side by side: dense or sparse, whichever is smaller, as the assembler does.

    Null and NaN inputs raise an error. The column's metadata hold its width alone.
    """
    entries, cells, inputs, width = [], [], [], 0
    for c in vector_order:
        if c in numbered.columns:
            value = F.col(c).cast("double")
            inputs.append(F.when(~F.isnan(value), value))
            entries.append(F.when(value != 0, F.struct(F.lit(width).alias("slot"), value.alias("value"))))
            cells.append(value)
            width += 1
        else:
            number = F.col(f"i{c[1:]}")
            known = numbered.schema[f"i{c[1:]}"].metadata.get("ml_attr", {})
            # the last category is the one without a slot
            slots = max(0, known.get("num_vals", 0) - 1)
            inputs.append(number)
            slot = (F.lit(width) + number).cast("int")
            entries.append(F.when(number < slots, F.struct(slot.alias("slot"), F.lit(1.0).alias("value"))))
            if width + slots < 1.5 * len(vector_order) + 2.5:
                cells += [(number == k).cast("double") for k in range(slots)]
            width += slots
    found = F.array_compact(F.array(*entries))

    def raw(kind, size, indices, values):
        fields = {"type": F.lit(kind).cast("byte"), "size": size, "indices": indices, "values": values}
        return F.struct(F.struct(*[v.alias(k) for k, v in fields.items()]).alias(name))

    vector = raw(0, F.lit(width), found["slot"], found["value"])
    # 12 bytes an entry and 20 more, in whole 8 bytes, against 8 bytes a slot and 8 more
    if width < 1.5 * len(entries) + 2.5:
        none = F.lit(None)
        plain = raw(1, none.cast("int"), none.cast("array<int>"), F.array(*cells).cast("array<double>"))
        vector = F.when(1.5 * F.size(found) + 2.5 <= width, vector).otherwise(plain)
    # Spark builds a vector of its parts only when it reads one
    kind = T.StructType([T.StructField(name, VectorUDT())])
    made = F.from_json(F.to_json(vector), kind)[name]
    missing = reduce(lambda a, b: a | b, [x.isNull() for x in inputs])
    error = F.raise_error(F.lit("a null or NaN cannot be part of a vector")).cast("string")
    vector_or_error = F.when(missing, F.from_json(error, kind)[name]).otherwise(made)
    return vector_or_error.alias(name, metadata={"ml_attr": {"num_attrs": width}})


def active_slots(df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
    """Non-zero vector entries as rows ``keys, slot, value``, read from the sparse form."""
    raw = F.unwrap_udt(vector)
    sparse = F.zip_with(
        raw["indices"],
        raw["values"],
        lambda i, v: F.struct(i.alias("slot"), v.alias("value")),
    )
    dense = F.transform(raw["values"], lambda v, i: F.struct(i.alias("slot"), v.alias("value")))
    entries = F.when(raw["type"] == 0, sparse).otherwise(dense)
    return (
        df.select(*keys, F.inline(entries))
        .where(F.col("value") != 0)
    )


def vector_width(df: DataFrame, vector: str = "features") -> DataFrame:
    """One row per vector width that occurs, with the number of rows."""
    raw = F.unwrap_udt(vector)
    width = F.when(raw["type"] == 0, raw["size"]).otherwise(F.size(raw["values"]))
    return df.groupBy(width.alias("width")).agg(F.count("*").alias("n_rows"))


def dummy_columns(df: DataFrame, columns: Sequence[str], max_categories: int = 1000) -> DataFrame:
    """Replace each column by one 0/1 column per category, named ``column_category``.

    A null is 0 in all of them. Column names come from the data, so the categories are
    fetched, as text and in its order, those of all columns in one pass; more than
    ``max_categories`` per column is an error, as it is no table shape;
    ``one_hot_by_join`` is the form without a limit.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    found = df.select(F.inline(F.array(*pairs))) if pairs else df.selectExpr("'' AS column", "'' AS value").limit(0)
    most = max_categories * len(columns)
    rows = found.where(F.col("value").isNotNull()).distinct().limit(most + 1).collect()
    categories = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}
    for c in columns:
        if len(categories[c]) > max_categories:
            raise ValueError(f"column {c} has more than {max_categories} categories")
    rest = [c for c in df.columns if c not in set(columns)]
    dummies = [
        F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in columns
        for v in categories[c]
    ]
    return df.select(*rest, *dummies)
