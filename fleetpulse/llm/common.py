"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import materialize

#: The six ASCII white-space characters that end a word: \x20 and \x09-\x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the checkpoint directory and read it back."""
    return materialize(df, f"llm-{label}")


def beside_text(docs: DataFrame, text_col: str, keep: tuple[str, ...], new_col: str, new_type: str,
                run: Callable[[Iterator[pa.Array]], Iterator[pa.Array]]) -> DataFrame:
    """The ``keep`` columns as they are and a new one, which ``run`` makes from the text's Arrow arrays.

    A text that is kept travels once: its batches are the largest thing that a task holds.
    """
    kept = [f"_{i}" for i in range(len(keep))]
    if text_col in keep and docs.select(text_col).schema[0].dataType == StringType():
        kept[keep.index(text_col)] = "_text"
    others = [F.col(c).alias(k) for c, k in zip(keep, kept) if k != "_text"]
    source = docs.select(F.col(text_col).cast("string").alias("_text"), *others)
    fields = [f"_{i} {source.schema[k].dataType.simpleString()}" for i, k in enumerate(kept)]
    names = [f"_{i}" for i in range(len(keep))] + ["_new"]

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # a reused worker still holds what its last task's batches took
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                held.append(batch)
                yield batch.column(0)

        for made in run(texts()):
            batch = held.pop(0)
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), made], names)

    made = source.mapInArrow(through, ", ".join([*fields, f"_new {new_type}"]))
    return made.toDF(*keep, new_col)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array."""
    return F.array_remove(F.split(F.translate(text, ASCII_SPACE, " " * len(ASCII_SPACE)), " "), "")


def alnum_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits as an array (every other character separates)."""
    spaced = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    return F.array_remove(F.split(spaced, " "), "")


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (a null id is in fold 0 of no split)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))
