"""A lexicon that grows with a stream and can be read at any moment.

The store is a folder of parts, each a table of counts, and of versions. A version is a
small file that names the parts which together are the lexicon and the last micro-batch
that is in them. It is written under a name of its own and moved into place, so readers
see one version or the next and never a half of one. A micro-batch that is run again is
recognised by its number and changes nothing. When ``MERGE`` parts of one size class
have come together they are added up to one of the next class, in the same step, so a
running stream keeps few parts and rewrites a word only a logarithmic number of times.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smudgelex.operators.lexicon import build_lexicon
from smudgelex.sources.reader import file_system

MERGE = 8
SCHEMA = "token string, n bigint"


@dataclass
class Version:
    number: int = 0
    batch: int = -1
    # Name of the part and its size class.
    parts: list[tuple[str, int]] = field(default_factory=list)


class LexiconStore:
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.fs, self.root = file_system(self.path)

    def _file(self, number: int) -> str:
        return f"{self.root}/versions/{number:012d}.json"

    def numbers(self) -> list[int]:
        """The versions that are there, oldest first."""
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/versions", allow_not_found=True))
        names = [f.base_name for f in found if f.is_file and f.base_name.endswith(".json")]
        return sorted(int(n.removesuffix(".json")) for n in names)

    def version(self, number: int | None = None) -> Version:
        numbers = self.numbers()
        if number is None and not numbers:
            return Version()
        number = numbers[-1] if number is None else number
        with self.fs.open_input_stream(self._file(number)) as f:
            held = json.loads(f.read())
        return Version(held["number"], held["batch"], [(p, c) for p, c in held["parts"]])

    def _commit(self, version: Version) -> None:
        self.fs.create_dir(f"{self.root}/versions", recursive=True)
        draft = f"{self.root}/versions/draft-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(asdict(version)).encode())
        self.fs.move(draft, self._file(version.number))

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame:
        if not names:
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(*[f"{self.path}/parts/{n}" for n in names])

    def _write(self, counts: DataFrame) -> str:
        name = uuid.uuid4().hex
        counts.write.parquet(f"{self.path}/parts/{name}")
        return name

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """``(token, n)`` of one version, the last one unless another is named."""
        counts = self._read(spark, [p for p, _ in self.version(number).parts])
        return counts.groupBy("token").agg(F.sum("n").alias("n"))

    def add(self, counts: DataFrame, batch: int) -> bool:
        """Add the counts of a micro-batch once; tells whether they were new."""
        now = self.version()
        if batch <= now.batch:
            return False
        spark = counts.sparkSession
        parts = [*now.parts, (self._write(counts), 0)]
        merged = 0
        while len(same := [p for p, c in parts if c == merged]) >= MERGE:
            total = self._read(spark, same).groupBy("token").agg(F.sum("n").alias("n"))
            parts = [(p, c) for p, c in parts if c != merged] + [(self._write(total), merged + 1)]
            merged += 1
        self._commit(Version(now.number + 1, batch, parts))
        return True

    def clean(self, keep: int = 2) -> None:
        """Delete parts and versions that the last ``keep`` versions do not need.

        Readers of older versions must be done; no batch may be running.
        """
        numbers = self.numbers()
        held = {p for n in numbers[-keep:] for p, _ in self.version(n).parts}
        for n in numbers[:-keep]:
            self.fs.delete_file(self._file(n))
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/parts", allow_not_found=True))
        for folder in found:
            if folder.base_name not in held:
                self.fs.delete_dir(folder.path)


def write_lexicon(
    tokens: DataFrame, store: LexiconStore, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Count a token stream into a store; no state is kept beside it.

    A store belongs to one checkpoint: batches are told apart by their numbers.
    """

    def count(batch: DataFrame, number: int) -> None:
        store.add(build_lexicon(batch), number)

    writer = tokens.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
