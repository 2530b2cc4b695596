"""A recogniser as a row function: one answer an image, a failure named in its row.

Defined results: an image without bytes gets a null answer and an error; a recogniser that fails on an image
leaves the others of its batch alone; one that can't be loaded fails the job; an empty table loads none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answered(images: DataFrame, load: Callable[[], Callable[[bytes], str]], key: str, image: str = "image.bytes") -> DataFrame:
    """(key, answer, error) of each row. ``load`` makes the recogniser, once a task, when its first rows come."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recognise = None
        for b in batches:
            out = []
            for k, data in zip(b["key"], b["data"]):
                if data is None:
                    out.append((k, None, "no image"))
                    continue
                recognise = recognise or load()
                try:
                    out.append((k, recognise(bytes(data)), None))
                except Exception as e:  # the row tells what failed
                    out.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "answer", "error"])

    kind = images.select(key).schema[0].dataType.simpleString()
    made = images.select(F.col(key).alias("key"), F.col(image).alias("data")).mapInPandas(run, f"key {kind}, answer string, error string")
    return made.withColumnRenamed("key", key)
