"""Token counts as delta-maintained rollups.

A rollup lives in one folder of the shared storage:

- `changes/<attempt>`: the batch as it came, so that counts are made once;
- `ledger/<attempt>`: per changed document and tokenizer version its current
  source, language and count (null once deleted);
- `deltas/<attempt>`: what the batch adds to the totals by source, language and
  tokenizer version, signed;
- `commits/<attempt>`: one row with the batch's id;
- `log/<n>`: a file that gives the n-th place to an attempt. It is created last,
  once and whole. A batch counts from then on.

A commit compares the batch with the ledger: an insert or a revised count adds
the new value and takes off the old one, a delete takes off the old one. So
totals are plain sums over the committed deltas. A batch that is sent again
changes nothing; one that broke off before its place in the log leaves folders
that nothing reads. Of two writers who commit from the same view one gets the
place, the other one an error, and commits again on the new view.

The ledger is kept short by merging: `FAN` neighbouring parts become one, and
`FAN` of those again, so that n batches lie in at most FAN - 1 parts a level and
a row is rewritten once a level. A merged part is sorted by document id, and a
commit reads the range of ids that its batch spans. Merged parts have log entries
of their own, `merged-<from>-<to>`; the parts they replace stay for other readers
until `vacuum` is called, with no writer or reader at work.

Results for odd input: several changes of one document and version in a batch
count as one, the last by `seq`, then a delete before the largest count; a null
count is a delete; deletes of unknown documents change nothing; rows without a
document id can be inserted (they add up, untracked), not revised or deleted;
null sources, languages and versions are values of their own; an empty batch is
committed and changes nothing.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as sh
from .packing import Encoder

KEYS = ["source", "lang", "tokenizer_version"]
CHANGES = "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, seq long"
LEDGER = CHANGES.replace(", seq long", "")
DELTAS = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"


ENTRY = "first long, last long, attempt string"
FAN = 8


class PlaceTaken(RuntimeError):
    """Another writer has committed since this commit read the rollup."""


class Rollup:
    def __init__(self, spark: SparkSession, path: str, fan: int = FAN):
        self.spark, self.path, self.fan = spark, path.rstrip("/"), fan

    def _entries(self) -> list:
        """The log: one small row per batch and merged part."""
        try:
            return self.spark.read.schema(ENTRY).json(f"{self.path}/log/*").collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []

    def _enter(self, name: str, first: int, last: int, attempt: str) -> bool:
        """Creates the log entry, whole or not at all; False if it exists."""
        jvm = self.spark._jvm
        fs = jvm.org.apache.hadoop.fs
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        draft = fs.Path(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = draft.getFileSystem(conf).create(draft)
        out.write(bytearray(json.dumps({"first": first, "last": last, "attempt": attempt}).encode()))
        out.close()
        target = fs.Path(f"{self.path}/log/{name}")
        draft.getFileSystem(conf).mkdirs(target.getParent())
        context = fs.FileContext.getFileContext(draft.getFileSystem(conf).getUri(), conf)
        keep = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        keep[0] = fs.Options.Rename.NONE
        try:
            context.rename(draft, target, keep)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            context.delete(draft, False)
            return False
        return True

    def _attempts(self, entries: list) -> list[str]:
        """The committed attempts, in commit order."""
        return [e.attempt for e in sorted((e for e in entries if e.first == e.last), key=lambda e: e.first)]

    def committed(self) -> list[str]:
        """Batch ids in commit order."""
        return list(self._batches(self._attempts(self._entries())))

    def _batches(self, attempts: list[str]) -> dict[str, str]:
        """Batch id -> attempt, in commit order."""
        if not attempts:
            return {}
        rows = self.spark.read.schema("batch_id string, attempt string").parquet(
            *[f"{self.path}/commits/{a}" for a in attempts]).collect()
        batch = {r.attempt: r.batch_id for r in rows}
        return {batch[a]: a for a in attempts}

    def _parts(self, entries: list) -> list:
        """The fewest entries that hold every batch once, in order."""
        longest = {}
        for e in entries:
            if e.first not in longest or e.last > longest[e.first].last:
                longest[e.first] = e
        out, at = [], 0
        while at in longest:
            out.append(longest[at])
            at = longest[at].last + 1
        return out

    def _read(self, kind: str, schema: str, attempts: list[str]) -> DataFrame:
        if not attempts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/{a}" for a in attempts])

    def _ledger(self, parts: list) -> DataFrame:
        """The parts' ledger rows with their last batch's place `nth`."""
        out = None
        for e in parts:
            part = self._read("ledger", LEDGER, [e.attempt]).withColumn("nth", F.lit(e.last).cast("long"))
            out = part if out is None else out.unionByName(part)
        return out if out is not None else self.spark.createDataFrame([], LEDGER + ", nth long")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch of (doc_id, source, lang, tokenizer_version, n_tokens[, seq]);
        a null n_tokens deletes. False if the batch was committed before. Raises
        PlaceTaken if another writer commits meanwhile; nothing counts then."""
        entries = self._entries()
        done = self._attempts(entries)
        if batch_id in self._batches(done):
            return False
        attempt = uuid.uuid4().hex
        if "seq" not in changes.columns:
            changes = changes.withColumn("seq", F.lit(0).cast("long"))
        changes.select(*[F.col(c).cast(t).alias(c) for c, t in
                         (x.split(" ") for x in CHANGES.split(", "))]).write.parquet(
            f"{self.path}/changes/{attempt}")
        rows = self._read("changes", CHANGES, [attempt])
        tracked = rows.filter("doc_id is not null").groupBy("doc_id", "tokenizer_version").agg(
            F.max(F.struct("seq", F.col("n_tokens").isNull().alias("gone"), "n_tokens",
                           "source", "lang")).alias("c")).select(
            "doc_id", "c.source", "c.lang", "tokenizer_version", "c.n_tokens")
        tracked.write.parquet(f"{self.path}/ledger/{attempt}")
        tracked = self._read("ledger", LEDGER, [attempt])
        loose = rows.filter("doc_id is null and n_tokens is not null")
        now = tracked.filter("n_tokens is not null").unionByName(
            loose.select(*tracked.columns)).select(*KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens")
        deltas = now
        if done:
            span = tracked.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
            past = self._ledger(self._parts(entries)).filter(
                F.col("doc_id").between(F.lit(span.low).cast("long"), F.lit(span.high).cast("long")))
            key = (past.doc_id == tracked.doc_id) & past.tokenizer_version.eqNullSafe(
                tracked.tokenizer_version)
            old = past.join(tracked, key, "left_semi").groupBy("doc_id", "tokenizer_version").agg(
                F.max(F.struct("nth", "source", "lang", "n_tokens")).alias("c")).select(
                "c.source", "c.lang", "tokenizer_version", "c.n_tokens").filter("n_tokens is not null")
            deltas = now.unionByName(old.select(
                *KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")))
        self._summed(deltas).write.parquet(f"{self.path}/deltas/{attempt}")
        self.spark.createDataFrame([(batch_id, attempt)], "batch_id string, attempt string").coalesce(
            1).write.parquet(f"{self.path}/commits/{attempt}")
        nth = len(done)
        if not self._enter(str(nth), nth, nth, attempt):
            raise PlaceTaken(f"place {nth} of {self.path} is taken; commit {batch_id!r} again")
        self.merge()
        return True

    def merge(self) -> int:
        """Merge every full row of `fan` parts that isn't merged yet; how many there were."""
        n, merged = 0, True
        while merged:
            merged = False
            parts = self._parts(self._entries())
            size = 1
            while not merged and size <= sum(e.last - e.first + 1 for e in parts) // self.fan:
                whole = size * self.fan
                for at in range(len(parts) - self.fan + 1):
                    some = parts[at:at + self.fan]
                    if some[0].first % whole == 0 and all(e.last - e.first + 1 == size for e in some):
                        self._merge(some)
                        n, merged = n + 1, True
                        break
                size = whole
        return n

    def _merge(self, parts: list) -> None:
        first, last, attempt = parts[0].first, parts[-1].last, uuid.uuid4().hex
        rows = self._ledger(parts).groupBy("doc_id", "tokenizer_version").agg(
            F.max(F.struct("nth", "source", "lang", "n_tokens")).alias("c")).select(
            "doc_id", "c.source", "c.lang", "tokenizer_version", "c.n_tokens")
        if first == 0:                                 # nothing before it that a delete could meet
            rows = rows.filter("n_tokens is not null")
        rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(
            f"{self.path}/ledger/{attempt}")
        self._summed(self._read("deltas", DELTAS, [e.attempt for e in parts])).write.parquet(
            f"{self.path}/deltas/{attempt}")
        # another writer may have merged the same parts: theirs is as good
        self._enter(f"merged-{first}-{last}", first, last, attempt)

    @staticmethod
    def _summed(deltas: DataFrame) -> DataFrame:
        return deltas.groupBy(*KEYS).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter(
            "n_docs != 0 or n_tokens != 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens of all that is committed."""
        return self._summed(self._read("deltas", DELTAS, [e.attempt for e in self._parts(self._entries())]))

    def vacuum(self) -> int:
        """Delete the folders that no part of the rollup reads (merged parts, attempts
        that broke off); how many. Only while nobody else writes or reads."""
        entries = self._entries()
        parts = {e.attempt for e in self._parts(entries)}
        wanted = {"changes": set(), "ledger": parts, "deltas": parts, "commits": set(self._attempts(entries))}
        fs = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        n = 0
        for kind, keep in wanted.items():
            folder = fs.Path(f"{self.path}/{kind}")
            store = folder.getFileSystem(conf)
            for status in store.listStatus(folder) if store.exists(folder) else []:
                if status.getPath().getName() not in keep:
                    store.delete(status.getPath(), True)
                    n += 1
        return n


def bpe_counts(docs: DataFrame, encoder_args: tuple, text_col: str = "text") -> DataFrame:
    """The documents' other columns plus `n_tokens` by a byte-level BPE vocabulary."""
    at = docs.columns.index(text_col)

    def run(batches):
        encoder = Encoder(*encoder_args)
        for b in batches:
            n = [len(encoder.encode(t.as_py())) // 4 for t in b.column(at)]
            cols = [b.column(i) for i in range(b.num_columns) if i != at]
            names = [b.schema.names[i] for i in range(b.num_columns) if i != at]
            yield pa.record_batch([*cols, pa.array(n, pa.int64())], names=[*names, "n_tokens"])

    from pyspark.sql import types as T
    schema = T.StructType([f for f in docs.schema if f.name != text_col]
                          + [T.StructField("n_tokens", T.LongType())])
    return docs.mapInArrow(run, schema)


def word_count(text, pattern: str):
    """Matches of a pattern, 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of the documents whose whole text a smaller id has too (null ids, null texts: none)."""
    keys = sh.text_keys(docs, id_col, text_col)
    return sh.copies(keys, 0).filter("doc_id is not null").select("doc_id").distinct()
