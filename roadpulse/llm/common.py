"""Helpers of the text operators: deterministic samples, Arrow maps, gapless numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from roadpulse.session import written

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below
_HASH_RANGE = 1 << 53

#: What an Arrow map computes for a list of texts: one list per new column.
TextFunction = Callable[[list[bytes | None]], dict[str, list]]


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of an id written as text, modulo ``divisor``; NULL for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def unit_hash(*cols: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the columns and the salt alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(salt), *cols), 11)
    return bits.cast("double") / _HASH_RANGE


def map_texts(
    docs: DataFrame, make: Callable[[], TextFunction], fields: str, carry: list[str] | None = None
) -> DataFrame:
    """Carried columns of every row, followed by columns computed from ``text``.

    ``make`` runs once per task and returns the function for one batch. Batches are
    cut into runs of rows by bytes, so that memory follows the longest text and not
    the number of rows. A carried column named like a computed one is left out.
    """
    added = StructType.fromDDL(fields)
    carried = [c for c in (carry or ["doc_id"]) if c not in added.fieldNames()]
    chosen = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], "text")
    schema = StructType(chosen.schema.fields[:-1] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, arrow = make(), to_arrow_schema(schema)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            for start, stop in byte_runs(texts):
                found = function(texts[start:stop].to_pylist())
                columns = [batch.column(i)[start:stop] for i in range(len(carried))]
                columns += [pa.array(found[f.name], arrow.field(f.name).type) for f in added]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    mapped = chosen.mapInArrow(run, schema)
    return mapped.toDF(*carried, *added.fieldNames())


def map_columns(
    df: DataFrame,
    make: Callable[[], Callable[..., dict]],
    read: Sequence[str],
    fields: str,
    carry: Sequence[str],
) -> DataFrame:
    """Carried columns of every row, followed by columns computed row by row.

    ``make`` runs once per task; what it returns takes the values of the ``read``
    columns, strings but the last as Python values and the last, the large one, as bytes,
    and gives one value per added field. Batches are cut by the bytes of the last column.
    A carried column named like an added one is left out.
    """
    added = StructType.fromDDL(fields)
    carried = [c for c in carry if c not in added.fieldNames()]
    chosen = df.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)],
        *[F.col(c).alias(f"r{i}") for i, c in enumerate(read)],
    )
    width = len(carried)
    schema = StructType(chosen.schema.fields[:width] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, arrow = make(), to_arrow_schema(schema)
        for batch in batches:
            large = batch.column(batch.num_columns - 1).cast(pa.binary())
            for start, stop in byte_runs(large):
                part = [batch.column(i)[start:stop].to_pylist() for i in range(width, batch.num_columns - 1)]
                rows = [function(*values) for values in zip(*part, large[start:stop].to_pylist())]
                columns = [batch.column(i)[start:stop] for i in range(width)]
                for f in added:
                    values, kind = [row[f.name] for row in rows], arrow.field(f.name).type
                    # Bytes of UTF-8 become text without being decoded.
                    raw = pa.types.is_string(kind) and any(isinstance(v, bytes) for v in values)
                    columns.append(pa.array(values, pa.binary()).view(kind) if raw else pa.array(values, kind))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return chosen.mapInArrow(run, schema).toDF(*carried, *added.fieldNames())


def filter_texts(docs: DataFrame, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows, with all their columns, for whose text the function holds."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            for start, stop in byte_runs(texts, 1 << 19):
                mask = pa.array(function(texts[start:stop].to_pylist()), pa.bool_())
                yield batch.slice(start, stop - start).filter(mask)

    return docs.mapInArrow(run, docs.schema)


def byte_runs(texts: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``most`` bytes; a longer text is alone."""
    start = size = 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    for at, length in enumerate(lengths):
        if at > start and size + length > most:
            yield start, at
            start, size = at, 0
        size += length
    if len(lengths) > start:
        yield start, len(lengths)


def pieces(text: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """A text cut at blanks into parts of about ``most`` bytes; words stay whole."""
    start = 0
    while len(text) - start > most:
        cut = min((at for b in b" \n\t\r\x0b\x0c" if (at := text.find(b, start + most)) >= 0),
                  default=len(text))
        yield text[start:cut]
        start = cut
    yield text[start:]


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows with a gapless number from 0 in the given order, without a single sorting task.

    Rows are range partitioned and written in order; a row's number is its place in
    its partition plus the rows of the partitions before, of which there are as many
    as the session has shuffle partitions.
    """
    place = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = written(ordered.withColumn("_place", place), f"numbered-{name}")
    part = F.shiftright("_place", _POSITION_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = sizes.selectExpr(
        "_part", "sum(_size) over (order by _part) - _size as _before"
    )
    local = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + local)
        .drop("_part", "_place", "_before")
    )
