"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.errors import TallyError

SETTING = "spark.checkpoint.dir"
#: Words of a text: whatever white space in ASCII does not separate.
WORD_SPACE = " \t\n\x0b\x0c\r"
#: Remembered pieces of text of a worker process; some 120 MB. When full, it starts anew.
REMEMBERED = 600_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one if unset, in local mode only."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise TallyError(f"{SETTING} is not set; a cluster needs a shared folder")
    folder = tempfile.mkdtemp(prefix="tallybook-")
    spark.conf.set(SETTING, folder)
    return folder


def new_folder(spark: SparkSession, what: str) -> str:
    """A folder name in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/llm/{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame, what: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there.

    Columns without a type (all null) become text, which Parquet can hold.
    """
    spark = df.sparkSession
    void = {c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if kind == "void"}
    df = df.withColumns(void) if void else df
    path = new_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives memory of this process that nothing holds any more back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    # this one also trims what Python and the tokenizers have freed
    pa.system_memory_pool().release_unused()


#: step -> what drops all that this worker process remembers for it.
_begun: dict[str, Callable[[], None]] = {}


def begin_step(step: str, forget: Callable[[], None] = lambda: None) -> None:
    """A task of ``step`` begins here: a worker process remembers things for one step at a time.

    ``forget`` drops what this step will remember; processes outlive the step that they are started for.
    """
    others = [forgotten for other, forgotten in _begun.items() if other != step]
    if others:
        _begun.clear()
        for forgotten in others:
            forgotten()
        release()
    _begun[step] = forget


def fresh(names: Iterable[str], wanted: str) -> str:
    """``wanted``, or with underscores in front until it is none of ``names`` in any case."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted



class Pieces(dict):
    """piece -> value, computed on first use."""

    def __init__(self, compute: Callable, remembered: int = REMEMBERED) -> None:
        super().__init__()
        self._compute = compute
        self._remembered = remembered

    def __missing__(self, piece: str):
        if len(self) >= self._remembered:
            self.clear()
        value = self[piece] = self._compute(piece)
        return value


class ShortPieces(Pieces):
    """As ``Pieces``, but long pieces are computed each time, so that its bytes are bounded too."""

    LONGEST = 64

    def __missing__(self, piece):
        return super().__missing__(piece) if len(piece) <= self.LONGEST else self._compute(piece)
