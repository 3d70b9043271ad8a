"""Helpers that several training-data operators share.

Operators keep whatever columns a table carries: their own working columns start
with ``__cw_``, and only the columns they name are read.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Text handled at once inside a Python task (bytes); longer texts go alone.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; a private one only in local mode."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="candlewick-llm-")
    sc.setCheckpointDir(shared)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_candlewick_llm_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="candlewick-code-")) / "candlewick.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._candlewick_llm_shipped = True


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it again."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, **options)
    return spark.read.parquet(path)


def most_frequent(counts: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """Rows of the largest counts, at most ``limit`` in all, chosen by a threshold.

    Rows are counted by level (eight to an octave), and whole levels are taken from the
    top while they fit, so no task or driver sees more than ``limit`` rows.  ``counts``
    is read twice: pass a written table.
    """
    level = F.floor(F.log2(F.col(n).cast("double")) * 8)
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    total, least = 0, None
    for at, rows in sizes:
        total += rows
        if total > limit:
            break
        least = at
    return counts.where(F.lit(False) if least is None else level >= least)


def crc_remainder(column: str | Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus`` (null counts as empty text)."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Cut a string array into pieces of about ``limit`` bytes, never inside a text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield texts.slice(a, b - a)


def raw(texts: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text, without decoding."""
    return texts.cast(pa.binary()).to_pylist()


def per_slice(batches: Iterator[pa.Array], fn: Callable[[pa.Array], pa.Array], kind: pa.DataType, limit: int = SLICE_BYTES):
    """Apply ``fn`` to every slice of every batch; one result array for each batch."""
    for batch in batches:
        parts = [fn(x) for x in slices(batch, limit)]
        out = pa.concat_arrays(parts) if parts else pa.array([], kind)
        yield out.cast(kind) if out.type != kind else out


def struct_type(**fields: pa.DataType) -> pa.StructType:
    return pa.struct([pa.field(k, v) for k, v in fields.items()])


def build_struct(kind: pa.StructType, *columns) -> pa.StructArray:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, kind)]
    return pa.StructArray.from_arrays(arrays, fields=list(kind))


def factorize(tokens: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct tokens in order of appearance, and each token's index among them."""
    place = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
    ids = np.fromiter(map(place.__getitem__, tokens), np.int32, len(tokens))
    return list(place), ids


def pack(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of ``words`` in one array, with len(words) + 1 offsets."""
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)), out=offsets[1:])
    return np.frombuffer(b"".join(words), np.uint8), offsets


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for each i; empty segments give 0."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out
