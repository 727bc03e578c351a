"""Work on several items of a stage side by side: a bounded number of driver threads, each with a scheduler pool of its own."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")


def each(spark: SparkSession, items: Iterable[Item], work: Callable[[Item], object], at_once: int = 1) -> Sequence[tuple[Item, object, Exception | None]]:
    """(item, result, error) of every item in the order given; an item's error stops no other one.

    With ``at_once`` over 1 that many items are worked on at a time. Their jobs carry one tag, and if the caller is interrupted, the jobs of that
    tag are cancelled and no further item begins. Pools share the cluster fairly where ``spark.scheduler.mode`` is FAIR.
    """
    items = list(items)

    def tried(item: Item) -> tuple[Item, object, Exception | None]:
        try:
            return item, work(item), None
        except Exception as error:
            return item, None, error

    if at_once <= 1 or len(items) <= 1:
        return [tried(item) for item in items]
    tag, context = f"plumbline-{uuid.uuid4().hex}", spark.sparkContext

    def run(number: int) -> tuple[Item, object, Exception | None]:
        context.setLocalProperty("spark.scheduler.pool", f"{tag}-{number % at_once}")
        spark.addTag(tag)
        try:
            return tried(items[number])
        finally:
            spark.removeTag(tag)

    pool = ThreadPoolExecutor(min(at_once, len(items)))
    try:
        tasks = [pool.submit(inheritable_thread_target(spark)(run), number) for number in range(len(items))]
        return [task.result() for task in tasks]
    except BaseException:
        pool.shutdown(wait=False, cancel_futures=True)
        spark.interruptTag(tag)
        raise
    finally:
        pool.shutdown()
