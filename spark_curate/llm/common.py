"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: The white space that separates words, as a character class: space and \t\n\v\f\r.
BLANKS = b" \t\n\x0b\x0c\r"


def words(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8.

    ``bytes.split`` separates at exactly these six characters, ``str.split`` at more.
    """
    return text.encode().split()


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def map_texts(
    docs: DataFrame,
    start: Callable[[], Callable[[list[str]], dict[str, list]]],
    fields: str,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per document: the ``carry`` columns and ``fields`` made from its whole text.

    ``start`` is called once per task and returns the function for the texts of a
    batch, so caches live as long as a task and a lost task starts afresh. Only the
    named columns are read; a null text counts as empty.
    """
    docs = docs.select(*carry, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    schema = T.StructType(docs.schema.fields[:-1] + T.StructType.fromDDL(fields).fields)
    arrow = to_arrow_schema(schema)
    names = [f.name for f in schema.fields[len(carry) :]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made = work(batch.column(len(carry)).to_pylist())
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(len(carry))]
            columns += [pa.array(made[n], arrow.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)
