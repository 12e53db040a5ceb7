"""What several operators of this folder share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

#: White space of the contracts: blank and the characters U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def sql_text(text: str) -> str:
    """A text as an SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    for sign, name in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\x0b", "\\u000b"), ("\x0c", "\\u000c")):
        escaped = escaped.replace(sign, name)
    return f"'{escaped}'"


def spare_name(base: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever its case."""
    names = {t.lower() for t in taken}
    while base.lower() in names:
        base += "_"
    return base


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(key: str, folds: int) -> Column:
    """crc32 of a key's text form, modulo the number of folds (null keys are in fold 0)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)) % folds


def add_columns(
    df: DataFrame,
    reads: list[str],
    adds: list[tuple[str, DataType]],
    compute: Callable[[pa.RecordBatch], list],
) -> DataFrame:
    """Append columns that ``compute`` derives from the columns ``reads`` of each Arrow batch.

    All other columns pass through as they are. A column of ``df`` that has the
    name of an added one is replaced, so clashing names keep one meaning.
    """
    names = {name for name, _ in adds}
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = StructType(kept + [StructField(n, t, True) for n, t in adds])
    arrow = to_arrow_schema(schema)
    keep = [f.name for f in kept]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            fresh = compute(batch.select(reads))
            columns = [batch.column(n) for n in keep]
            columns += [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in fresh]
            yield pa.RecordBatch.from_arrays(
                [_as(c, arrow.field(i).type) for i, c in enumerate(columns)], schema=arrow
            )

    return df.mapInArrow(run, schema)


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches in runs of rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _as(column, kind: pa.DataType):
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column if column.type == kind else column.cast(kind)


def keep_rows(df: DataFrame, reads: list[str], wanted: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """The rows for which ``wanted`` returns true; all columns stay as they are."""
    schema = df.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            mask = pa.array(wanted(batch.select(reads)), pa.bool_())
            rows = batch.filter(mask)
            yield pa.RecordBatch.from_arrays(
                [_as(c, arrow.field(i).type) for i, c in enumerate(rows.columns)], schema=arrow
            )

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: int = 0) -> list[str]:
    """A text column as a list, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def bounded_by_class(df: DataFrame, key: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label at most, chosen by a hash of the key.

    The share of each label follows from counts over all rows, so the choice
    is the same on every run. Rows without a label are left out.
    """
    known = df.where(F.col(label).isNotNull())
    counts = known.groupBy(label).count().collect()
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col(label) == F.lit(row[0]), F.lit(min(1.0, per_class / row[1]))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return known.where(place < share)


class SharedFile:
    """A tokenizer file's content, sent to each executor once (a file of a few MB)."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as file:
            self._broadcast = spark.sparkContext.broadcast(file.read())
        self.id = self._broadcast._jbroadcast.id()

    @property
    def value(self) -> str:
        return self._broadcast.value

    def __getstate__(self):
        return {"_broadcast": self._broadcast, "id": self.id}


def byte_signs() -> list[str]:
    """The sign of each byte in byte-level vocabularies: printable ones stand for themselves, the
    others take the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in plain}
    rest = iter(range(256, 512))
    return [signs.get(b) or chr(next(rest)) for b in range(256)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid with smoothed targets, by Newton steps."""
    n1, n0 = float(labels.sum()), float(len(labels) - labels.sum())
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * margins + offset)
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * margins).sum() + 1e-3 * slope, (p - target).sum()])
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        step *= min(1.0, 2.0 / size) if size else 1.0
        slope, offset = slope - step[0], offset - step[1]
        if size < 1e-6:
            break
    return float(slope), float(offset)


def learn_in_task(sample: DataFrame, learn: Callable[[pa.Table], object]) -> object:
    """What ``learn`` makes of a bounded sample, which is gathered in one task (sort it there: its order varies)."""
    arrow = to_arrow_schema(sample.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), schema=arrow)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn(rows))], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found[0]) if found else learn(arrow.empty_table())
