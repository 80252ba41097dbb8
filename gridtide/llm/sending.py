"""Values of this package for tasks, on workers that cannot import it."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def send(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast `value`, whose size must be bounded, and return a function that gives it in a task.

    A broadcast by itself names the classes of what it holds and leaves the worker to import them; here their
    definitions travel in the same bytes. Called once per task.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
