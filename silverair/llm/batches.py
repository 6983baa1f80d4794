"""A narrow pass over texts: Arrow batches in, Arrow batches out, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Texts of about this many characters are worked on at once. A longer text is
# worked on alone. Bounds memory only; results do not depend on it.
SLICE_CHARS = 1_500_000


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``most`` characters each; a longer text is alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    columns: str,
    worker: Callable[[], Callable],
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id_column`` of every row with the ``columns`` (DDL) that ``worker`` derives from its text.

    ``worker()`` runs once per task and returns a function from a list of texts
    to one list or array per column. A null text reaches it as an empty one.
    Columns named in ``carry`` (instead of the id) are passed on. Other columns
    of ``docs`` are not read, so their names cannot clash.
    """
    kept = list(carry) or [id_column]
    schema = T.StructType([*(docs.schema[c] for c in kept), *T.StructType.fromDDL(columns).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spark uses a worker again: what earlier tasks left in Arrow's pool goes back to the system.
        pa.default_memory_pool().release_unused()
        work = worker()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for low, high in slices(texts):
                arrays = [batch.column(i + 1)[low:high].cast(arrow[i].type) for i in range(len(kept))]
                for values in work(texts[low:high]):
                    arrays.append(pa.array(values, arrow[len(arrays)].type))
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(F.col(text_column).alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(kept))).mapInArrow(
        run, schema
    )
