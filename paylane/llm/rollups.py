"""Token counts by source, language and tokenizer version, kept up by signed deltas.

A change feed holds what a batch adds and takes away: an insert adds a document and its tokens, a delete takes both off
again, a revised count takes the old one off and adds the new. Deltas are summed by key before they are written, and totals
are sums of deltas, so order does not matter.

A batch counts once, however often it is delivered. Its sums go to a folder of their own, and a marker that names the folder
publishes it. A marker is written whole under another name, then renamed, which fails if another writer was first; so there is
never half a marker. A commit that dies before the rename leaves nothing that readers see.

Totals are kept, not summed anew: after some batches a new generation adds their deltas to the last one's totals and is published
the same way. Markers of batches that it covers then move out of the way, so a reader opens one table of totals and the few
batches since, however many there ever were. A generation names what it newly covers, so that a death before the move changes
nothing.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")
SUMS = ("n_docs", "n_tokens")

# Tokenizer versions that can be counted in place: words between white space; runs of letters and digits, and single marks.
COUNTERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "marks-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]",
}


def n_tokens(text: Column, version: str) -> Column:
    """A null text has no tokens."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(COUNTERS[version])).cast("long")


def signed(rows: DataFrame, sign: int, version: str, count: str) -> DataFrame:
    """Deltas that add (1) or take off (-1) the rows with their column ``count``."""
    return rows.select(
        "source", "lang", F.lit(version).alias("version"), F.lit(sign).cast("long").alias("n_docs"), (F.col(count) * sign).cast("long").alias("n_tokens")
    )


TOTALS = ", ".join([*(f"{k} string" for k in KEYS), *(f"{c} long" for c in SUMS)])
KEEP_UP = 16  # batches after which totals are brought up to date


def added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))


class Rollup:
    """Totals below a folder of any file system that Spark writes to and that renames files."""

    def __init__(self, spark: SparkSession, path: str, keep_up: int = KEEP_UP):
        self.spark, self.path, self.keep_up = spark, path.rstrip("/"), keep_up

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where, fs = self._at(folder)
        return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []

    def _read(self, path: str) -> list[str]:
        """Lines of a small file; none if it is missing or was torn off, as its last line is ``end``."""
        where, fs = self._at(path)
        if not fs.exists(where):
            return []
        stream = fs.open(where)
        try:
            text = bytes(stream.readAllBytes()).decode("ascii", "replace")
        finally:
            stream.close()
        *lines, last = text.split("\n")
        return lines if last == "end" else []

    def _move(self, source: str, target: str) -> bool:
        """Rename a file; False if the target is there already."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        (old, _), (new, fs) = self._at(source), self._at(target)
        fs.mkdirs(new.getParent())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(old), fs.makeQualified(new), none)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def _publish(self, target: str, lines: list[str]) -> bool:
        """Put a small file in place whole, or not at all: False if there is one. A torn one is none and makes room."""
        draft = f"drafts/{uuid.uuid4().hex}"
        where, fs = self._at(draft)
        out = fs.create(where, False)
        out.write(bytearray("\n".join([*lines, "end"]), "ascii"))
        out.close()
        there, _ = self._at(target)
        if fs.exists(there) and not self._read(target):
            fs.delete(there, False)
        if self._move(draft, target):
            return True
        fs.delete(where, False)
        return False

    @staticmethod
    def marker(batch: str) -> str:
        """A file name for any batch name; no file system or reader hides it."""
        return "b-" + quote(batch, safe="")

    def committed(self, batch: str) -> bool:
        return any(self._read(f"{folder}/{self.marker(batch)}") for folder in ("commits", "covered"))

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch of deltas (KEYS and SUMS); False if that batch is already in, whose delivery then changes nothing."""
        if self.committed(batch):
            return False
        folder = uuid.uuid4().hex
        added_up(deltas).write.parquet(f"{self.path}/batches/{folder}")  # summed before the shuffle: a hot source is no burden
        # A batch that another writer committed and a generation covered meanwhile has its marker moved.
        if self.committed(batch) or not self._publish(f"commits/{self.marker(batch)}", [folder]):
            return False
        if len(self._names("commits")) >= self.keep_up:
            self.keep_totals()
        return True

    def _generation(self) -> tuple[int, str | None, set[str]]:
        """Number and folder of the last totals, and the markers that they newly cover."""
        for name in reversed(self._names("generations")):
            if lines := self._read(f"generations/{name}"):
                return int(name[2:]), lines[0], set(lines[1:])
        return 0, None, set()

    def _state(self) -> tuple[int, str | None, dict[str, str]]:
        """The last totals, and folders of the batches that they do not cover, by marker; both of one moment."""
        while True:
            number, folder, covered = self._generation()
            since = [m for m in self._names("commits") if m not in covered and not self._read(f"covered/{m}")]
            open_batches = {m: lines[0] for m in since if (lines := self._read(f"commits/{m}"))}
            if self._generation()[0] == number:
                return number, folder, open_batches

    def _sum(self, folder: str | None, batches: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/batches/{b}" for b in batches.values()] + ([f"{self.path}/totals/{folder}"] if folder else [])
        rows = self.spark.read.schema(TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], TOTALS)
        return added_up(rows).where(" or ".join(f"{c} <> 0" for c in SUMS))

    def keep_totals(self) -> bool:
        """Bring the totals up to date with all batches since; False if another writer did so first."""
        self._put_away()
        number, folder, batches = self._state()
        if not batches:
            return False
        fresh = uuid.uuid4().hex
        self._sum(folder, batches).write.parquet(f"{self.path}/totals/{fresh}")
        if not self._publish(f"generations/g-{number + 1:012d}", [fresh, *batches]):
            return False
        self._put_away()
        return True

    def _put_away(self) -> None:
        """Markers that the last generation covers, out of the folder that readers list."""
        _, _, covered = self._generation()
        for marker in self._names("commits"):
            done = self._read(f"covered/{marker}")  # a writer was so late that its batch had been covered already
            if not done and marker in covered:
                done = not self._move(f"commits/{marker}", f"covered/{marker}")
            if done:
                where, fs = self._at(f"commits/{marker}")
                fs.delete(where, False)

    def totals(self) -> DataFrame:
        """Sums of all committed batches by key; keys whose sums are all zero are left out. Null keys are keys."""
        _, folder, batches = self._state()
        return self._sum(folder, batches)
