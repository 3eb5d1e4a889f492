"""Queries for image rows; the embeddings stand in for 8 x 8 images."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions import arrays
from shelfcast.plans.registry import register
from shelfcast.sources.scans import read_named

SIDE = 8
# Fixed value: the image that is looked at.
PICKED = 2


def _images(spark, sf_dir):
    return read_named(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("pixels")
    )


@register(
    "array_scale",
    """SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS pos,
              CAST(unnest(embedding) AS DOUBLE) / 255.0 AS value FROM embeddings""",
)
def array_scale(spark, sf_dir):
    scaled = arrays.scaled("pixels")
    return _images(spark, sf_dir).select("vec_id", F.posexplode(scaled).alias("pos", "value"))


@register(
    "array_slice",
    """SELECT vec_id, CAST(unnest(range(16)) AS INTEGER) AS pos,
              CAST(unnest(embedding[9:24]) AS DOUBLE) AS value FROM embeddings""",
)
def array_slice(spark, sf_dir):
    part = arrays.sliced("pixels", 8, 16)
    return _images(spark, sf_dir).select("vec_id", F.posexplode(part).alias("pos", "value"))


@register(
    "array_reshape",
    f"""SELECT vec_id, CAST(p // {SIDE} AS INTEGER) AS image_row, CAST(p % {SIDE} AS INTEGER) AS image_col, value
        FROM (SELECT vec_id, unnest(range(len(embedding))) AS p, CAST(unnest(embedding) AS DOUBLE) AS value
              FROM embeddings)""",
)
def array_reshape(spark, sf_dir):
    rows = _images(spark, sf_dir).select(
        "vec_id", F.posexplode(arrays.square_rows("pixels", SIDE)).alias("image_row", "row_pixels")
    )
    return rows.select("vec_id", "image_row", F.posexplode("row_pixels").alias("image_col", "value"))


@register(
    "array_pick_image",
    f"""SELECT CAST(p // {SIDE} AS INTEGER) AS image_row, CAST(p % {SIDE} AS INTEGER) AS image_col, value
        FROM (SELECT unnest(range(len(embedding))) AS p, CAST(unnest(embedding) AS DOUBLE) AS value
              FROM embeddings WHERE vec_id = {PICKED})""",
)
def array_pick_image(spark, sf_dir):
    images = _images(spark, sf_dir).withColumn("image", arrays.square_rows("pixels", SIDE))
    rows = images.where(F.col("vec_id") == PICKED).select(F.posexplode("image").alias("image_row", "row_pixels"))
    return rows.select("image_row", F.posexplode("row_pixels").alias("image_col", "value"))


@register(
    "array_first_positive",
    """SELECT vec_id,
        CAST(COALESCE(list_position(lit, TRUE), 1) - 1 AS BIGINT) AS from_left,
        CAST(COALESCE(list_position(list_reverse(lit), TRUE), 1) - 1 AS BIGINT) AS from_right
       FROM (SELECT vec_id, list_transform(embedding, lambda v: v > 0) AS lit FROM embeddings)""",
)
def array_first_positive(spark, sf_dir):
    return _images(spark, sf_dir).select(
        "vec_id",
        arrays.first_positive("pixels").cast("bigint").alias("from_left"),
        arrays.last_positive("pixels").cast("bigint").alias("from_right"),
    )
