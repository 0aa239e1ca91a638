"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import hashlib
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Rows of a partition that training passes over many times, at most.
ROWS_A_PART = 200_000

# Paths of intermediate tables, in the order of their making.
_MADE: list[str] = []

# Paths of artefacts by application, source, state of the source's files, and name.
_ARTEFACTS: dict[tuple[str, str, str, str], str] = {}

# Fallback folders of local sessions, by application id.
_LOCAL_ROOTS: dict[str, str] = {}


def get_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as its time zone."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # HotSpot never compiles a method above 8000 bytes of bytecode; wide projections run faster
        # unfused than fused and interpreted
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # no Python call-site capture per Column: plans with hundreds of expressions build much faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and executors
    are one process, may fall back to a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="riskloom-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A new, unused path below the shared folder. ``scratch_scope`` removes what is not ``kept``."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if not kept:
        _MADE.append(path)
    return path


def _files_state(spark: SparkSession, folder: str) -> str:
    """A digest of names, sizes and times of all files below ``folder``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    facts = []
    while listed.hasNext():
        file = listed.next()
        facts.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(facts)).encode()).hexdigest()


def artefact(spark: SparkSession, source: str, name: str, make: Callable[[str], None]) -> str:
    """The path of a stored table or model made from the folder ``source``, made when this session asks for it
    the first time, and again when files were added to the folder, removed or changed. Later steps read it instead of
    making it again; ``drop_artefact`` forgets it."""
    key = (spark.sparkContext.applicationId, source, _files_state(spark, source), name)
    if key not in _ARTEFACTS:
        path = scratch_path(spark, name, kept=True)
        make(path)
        _ARTEFACTS[key] = path
    return _ARTEFACTS[key]


def drop_artefact(source: str, name: str | None = None) -> int:
    """Forgets the artefacts of a folder, all or those of one name; returns how many. Their tables stay."""
    gone = [k for k in _ARTEFACTS if k[1] == source and name in (None, k[3])]
    for key in gone:
        del _ARTEFACTS[key]
    return len(gone)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the intermediate tables that were written within. Results must be used before."""
    start = len(_MADE)
    try:
        yield
    finally:
        made = _MADE[start:]
        del _MADE[start:]
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in map(hadoop.Path, made):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows of ``df`` dealt evenly to as many partitions as the session has cores, or more for larger tables.

    A small file is one partition however many rows it holds, and whatever reads it again and again then runs in one task.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_A_PART)))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage in a way that survives lost executors. It also gives Catalyst the real size of
    the table, so a join with it is broadcast when it is below the broadcast threshold and shuffled
    when it is not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
