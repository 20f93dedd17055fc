"""What the corpus operators share: the shared scratch folder, text expressions, sources."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Runs of letters a-z, digits and everything beyond ASCII.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side of a join is broadcast only when it was counted and has no more rows than this.
BROADCAST_ROWS = 100_000

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Without one, only a session of a single machine gets a default."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints/plotweave"
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Within, an action's shuffle files go when the action ends instead of at the driver's next collection."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within, an action's Arrow batches hold so many rows at most."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_MADE: ContextVar[list | None] = ContextVar("scratch", default=None)


@contextmanager
def passing_scratch():
    """Scratch tables that this thread makes within go at the end, but for those taken out of the list that is given."""
    made: list[DataFrame] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        discard(*made)


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a table of its own in the shared folder and read it back: this cuts the lineage, and the
    files outlive executors. They go with ``discard``, else when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffle_cleanup(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    if (made := _MADE.get()) is not None:
        made.append(out)
    return out


def discard(*frames: DataFrame) -> None:
    """Delete scratch tables that no plan needs any more."""
    for df in frames:
        if path := getattr(df, "scratch_path", None):
            spark = df.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``rows``: the counted rows of ``df``. Beyond the bound Spark shuffles both sides and splits hot keys."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def own_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted``, with underscores appended until no column of ``df`` is called so, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    """A top-level column, dots in its name included."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_whole_rows(df: DataFrame, run, keep: int | None = None) -> DataFrame:
    """``mapInArrow`` over rows whose columns are called c0, c1 ... meanwhile, as it can't take names with dots; ``keep``:
    how many columns, from the first, the result has (all where None)."""
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    out = plain.select(plain.columns[:keep]).schema
    return plain.mapInArrow(run, out).toDF(*df.columns[:keep])


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once; named in a lambda it would be worked out at every element."""
    return F.transform(F.array(value), body)[0]


def join_counted(big: DataFrame, small: DataFrame, key: str, rows: int, n: str = "n", how: str = "inner") -> DataFrame:
    """Equi-join, inner or left, of ``big`` with ``small`` (one row a ``key``, which ``n`` of the ``rows`` of ``big`` have).

    Keys with more than a thousandth of the rows, so fewer than a thousand, are broadcast; the rest is shuffled."""
    share = rows // 1000 + 1
    hot = small.filter(F.col(n) > share)
    cold = small.filter(F.col(n) <= share)
    return (big.join(F.broadcast(hot), key)
            .unionByName(big.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)))


def whole_text(text: str | Column) -> Column:
    return F.coalesce(column(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: str | Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def text_key(text: str | Column) -> Column:
    """With the id it tells rows apart that share an id; rows equal in both get equal results."""
    return F.xxhash64(whole_text(text))
