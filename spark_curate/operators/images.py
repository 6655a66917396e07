"""Work on decoded pixels and with a caller's encoder, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from spark_curate.functions import names as N
from spark_curate.functions import pixels as P
from spark_curate.operators import resolution


def perceptual_hashes(images: DataFrame, key: str = "image") -> DataFrame:
    """(key, phash) of decoded images; null for unreadable ones.

    ``images`` holds the key and ``pixels``. Pixel data go no further than this.
    """
    flat = images.select(
        key, "pixels.height", "pixels.width", "pixels.nChannels", "pixels.data"
    )

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [
                None if data is None else P.perceptual_hash(P.from_bytes(data, int(h), int(w), int(c)))
                for h, w, c, data in zip(batch["height"], batch["width"], batch["nChannels"], batch["data"])
            ]
            yield pd.DataFrame({key: batch[key], "phash": pd.array(values, dtype="Int64")})

    return flat.mapInPandas(hashed, f"`{key}` string, phash bigint")


#: Mode of a three-channel byte image in Spark's image struct (a fixed value).
BGR_MODE = 16


def to_rgb(images: DataFrame) -> DataFrame:
    """Decoded images with three colour channels, whatever the file held.

    Grey images, palettes and images with alpha are turned; the pixels of those that have
    three channels already do not leave the JVM.
    """

    @F.arrow_udf("binary")
    def colours(data: pa.Array, height: pa.Array, width: pa.Array, channels: pa.Array) -> pa.Array:
        shapes = zip(height.to_pylist(), width.to_pylist(), channels.to_pylist())
        return pa.array(
            [
                None if raw is None else P.three_channels(P.from_bytes(raw, h, w, c)).tobytes()
                for raw, (h, w, c) in zip(data.to_pylist(), shapes)
            ],
            pa.binary(),
        )

    other = F.col("pixels.nChannels") != 3
    turned = colours(F.when(other, F.col("pixels.data")), "pixels.height", "pixels.width", "pixels.nChannels")
    image = F.struct(
        F.col("pixels.origin").alias("origin"),
        F.col("pixels.height").alias("height"),
        F.col("pixels.width").alias("width"),
        F.lit(3).alias("nChannels"),
        F.lit(BGR_MODE).alias("mode"),
        F.coalesce("_turned", F.col("pixels.data")).alias("data"),
    )
    rest = [c for c in images.columns if c != "pixels"]
    return images.withColumn("_turned", turned).select(
        *rest, F.when(F.col("pixels").isNotNull(), image).alias("pixels")
    ).select(*images.columns)


def resized_images(
    images: DataFrame,
    least: int = resolution.MIN_SHORTEST,
    most: int = resolution.MAX_SIDE,
    mode: str = "shortest_side",
) -> DataFrame:
    """Pixels of kept images, shrunk where needed: name, height, width, channels, data.

    ``images`` holds path, pixels, width and height.
    """
    new_width, new_height, _ = resolution.target_dims(F.col("width"), F.col("height"), most, mode)
    passing = images.where(
        F.coalesce(resolution.passes_resolution(F.col("width"), F.col("height"), least), F.lit(False))
    )
    flat = passing.select(
        N.resized_name(F.col("path")).alias("name"),
        F.col("pixels.height").alias("height"),
        F.col("pixels.width").alias("width"),
        F.col("pixels.nChannels").alias("channels"),
        F.col("pixels.data").alias("data"),
        new_width.alias("new_width"),
        new_height.alias("new_height"),
    )
    return flat.mapInPandas(
        _shrink, "name string, height int, width int, channels int, data binary"
    )


def _shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        data = [
            raw
            if (w, h) == (nw, nh)
            else P.resize(P.from_bytes(raw, h, w, c), nw, nh).tobytes()
            for h, w, c, raw, nw, nh in zip(
                batch["height"], batch["width"], batch["channels"], batch["data"],
                batch["new_width"], batch["new_height"],
            )
        ]
        yield pd.DataFrame(
            {
                "name": batch["name"],
                "height": batch["new_height"],
                "width": batch["new_width"],
                "channels": batch["channels"],
                "data": data,
            }
        )


def encode(
    df: DataFrame,
    column: str,
    make_predict_fn: Callable[[], Callable],
    batch_size: int = 128,
    input_tensor_shapes: Sequence[Sequence[int]] | None = None,
) -> DataFrame:
    """Add unit vectors from a caller's model as ``embedding``.

    ``make_predict_fn`` loads the model once per worker and returns a function on
    batches of the column (pixels or prompt texts).
    """
    def make_unit_fn() -> Callable:
        predict = make_predict_fn()

        def unit_vectors(*batch):
            vectors = np.asarray(predict(*batch), dtype=np.float64)
            length = np.linalg.norm(vectors, axis=1, keepdims=True)
            return (vectors / np.where(length > 0, length, 1.0)).astype(np.float32)

        return unit_vectors

    encoded = predict_batch_udf(
        make_unit_fn,
        return_type=ArrayType(FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=input_tensor_shapes,
    )
    return df.withColumn("embedding", encoded(F.col(column)))
