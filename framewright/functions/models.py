"""Models behind one batched function, loaded once in each Python process, with stand-ins that need no weights."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import SparkFiles
from pyspark.ml.functions import predict_batch_udf
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, FloatType

from .kernels import bilinear_weights
from .tensor import IMAGE_MEAN, IMAGE_STD

#: A model takes [batch, channels, height, width] floats and gives [batch, values].
Model = Callable[[np.ndarray], np.ndarray]


def padded(model: Model, shape: tuple[int, int, int], batch: int) -> Model:
    """Calls `model` with whole batches only: the last one is filled with zeros and its surplus results go."""

    def run(x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float32).reshape(-1, *shape)
        short = -len(x) % batch
        whole = np.concatenate([x, np.zeros((short, *shape), np.float32)]) if short else x
        parts = [model(whole[i : i + batch]) for i in range(0, len(whole), batch)]
        return np.concatenate(parts)[: len(x)] if parts else np.zeros((0, 1), np.float32)

    return run


def batched(load: Callable[[], Model], shape: tuple[int, int, int], values: int, batch: int):
    """A column function: flat float arrays of `shape` to arrays of `values` floats.

    `load` runs once in each Python process, where it reads weights that were sent with ``spark.addFile``.
    """

    def make() -> Callable[[np.ndarray], np.ndarray]:
        run = padded(load(), shape, batch)
        return lambda x: run(x).reshape(-1, values).astype(np.float32)

    size = int(np.prod(shape))
    return predict_batch_udf(make, return_type=ArrayType(FloatType()), batch_size=batch, input_tensor_shapes=[[size]])


def block_means(blocks: int) -> Callable[[], Model]:
    """Stand-in encoder: the mean of each of `blocks` by `blocks` parts of the image."""

    def load() -> Model:
        def run(x: np.ndarray) -> np.ndarray:
            b, c, h, w = x.shape
            parts = x.astype(np.float64).reshape(b, c, blocks, h // blocks, blocks, w // blocks)
            return parts.mean(axis=(1, 3, 5)).reshape(b, -1)

        return run

    return load


def mean_depth() -> Callable[[], Model]:
    """Stand-in depth model: the mean over channels."""

    def load() -> Model:
        return lambda x: x.astype(np.float64).mean(axis=1).reshape(len(x), -1)

    return load


def weights(spark: SparkSession, uri: str) -> Callable[[], np.ndarray]:
    """Ships an array file of weights to every executor; the function that is returned reads it there, once a process."""
    spark.sparkContext.addFile(uri)
    name = uri.rstrip("/").rpartition("/")[2]

    def load() -> np.ndarray:
        return np.load(SparkFiles.get(name), allow_pickle=False)

    return load


def linear(load: Callable[[], np.ndarray]) -> Callable[[], Model]:
    """A model of one matrix, [inputs, values], from shipped weights."""

    def make() -> Model:
        matrix = load()
        return lambda x: x.reshape(len(x), -1).astype(np.float64) @ matrix

    return make


def depth_chain(load: Callable[[], Model], inside: tuple[int, int]) -> Callable[[], Model]:
    """Standardise images of 0..1, resize them to the model's size, run it, and resize its depth back; corners aligned."""

    def make() -> Model:
        model = load()

        def resized(x: np.ndarray, height: int, width: int) -> np.ndarray:
            rows, columns = (bilinear_weights(a, b, "corners") for a, b in zip(x.shape[-2:], (height, width), strict=True))
            return np.einsum("yh,...hw,xw->...yx", rows, x, columns)

        def run(x: np.ndarray) -> np.ndarray:
            mean, std = (np.array(v)[None, :, None, None] for v in (IMAGE_MEAN, IMAGE_STD))
            depth = model(resized((x.astype(np.float64) - mean) / std, *inside)).reshape(len(x), 1, *inside)
            return resized(depth, *x.shape[-2:]).reshape(len(x), -1)

        return run

    return make


def on_accelerators(spark: SparkSession, amount: int = 1):
    """A resource profile of so many GPUs a task for ``mapInArrow(profile=...)``; None where executors have no such number.

    What executors have is in ``spark.executor.resource.gpu.amount``. Only tasks ask, of the executors as they are: to ask for
    other executors fails wherever these are not allocated dynamically. A local master has none.
    """
    held = int(spark.sparkContext.getConf().get("spark.executor.resource.gpu.amount", "0"))
    if held < amount or spark.sparkContext.master.startswith("local"):
        return None
    return ResourceProfileBuilder().require(TaskResourceRequests().resource("gpu", amount)).build


def single(load: Callable[[], Model], shape: tuple[int, int, int], values: int):
    """One image at a time."""
    return batched(load, shape, values, 1)
