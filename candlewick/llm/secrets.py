"""Secret scans with an incremental blob ledger (operator 13).

A blob is the SHA-256 of a text, whatever paths and versions hold it; a rule version is
the SHA-256 of a rule's definition.  The ledger is a folder of Parquet rows
``(blob, rules, spans)``: which rule versions have been run on a blob, and what they found
(nothing, mostly).  A scan

1. hashes every version of every path, and asks the ledger which rules each blob lacks;
2. sends one text of each blob that lacks some to the task that owns the blob (each task
   sends a blob once, so a text with a third of all rows costs one row a task), where
   only the missing rules run, once for each blob;
3. appends the outcome to the ledger, under a folder of its own;
4. joins the findings of the current rules back to all paths; findings are salted, so the
   paths of one blob are spread over tasks.

Running again over the same texts scans nothing; a new or changed rule is run alone over
the old blobs; a new version of a path costs its own text.  Ledger rows stand by
themselves: a lost job leaves whole rows or none, and two scans at a time only do some
work twice.

Defined results: a null text is the empty blob, which holds no secret; null paths are
paths; repeated rows each get the findings; texts of any length are scanned whole; an
empty table adds nothing to the ledger; spans that start together are in the order of the
rules; columns that are not named as path or text play no part.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.shared import ensure_checkpoint_dir, raw, ship_code, slices


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds candidates from left to right, without overlap; those whose
    ``group`` has fewer than ``least`` bytes are dropped.  A text without any of ``hints``
    (in lower case) can't match, and is not searched."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    hints: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]

    @cached_property
    def regex(self) -> re.Pattern[bytes]:
        return re.compile(self.pattern.encode())

    def spans(self, text: bytes, lower: bytes) -> Iterator[tuple[int, int]]:
        """Byte offsets of the matches that stay."""
        if self.hints and not any(h.encode() in lower for h in self.hints):
            return
        for m in self.regex.finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.span()


#: The rules every scan runs.
BASE_RULES = (
    SecretRule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, ("password", "passwd", "secret", "token", "api")),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
#: Rules beside the base ones: private key blocks, and hosting tokens.
MORE_RULES = (
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    SecretRule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
RULES = BASE_RULES + MORE_RULES

LEDGER_SCHEMA = "blob binary, rules string, spans array<struct<rule: string, start: long, end: long>>"
_SPANS = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
#: Tasks that the paths of one blob are spread over when findings are joined back.
SALTS = 16


def find_spans(text: bytes, rules: Sequence[SecretRule]) -> list[dict]:
    """Spans of all ``rules``, in code points, by start."""
    lower = text.lower()
    found = sorted((a, b, rule.version) for rule in rules for a, b in rule.spans(text, lower))
    if not found or text.isascii():
        return [{"rule": v, "start": a, "end": b} for a, b, v in found]
    points, at, n = {}, 0, 0
    for edge in sorted({e for a, b, _ in found for e in (a, b)}):
        n += len(text[at:edge].decode())
        points[edge], at = n, edge
    return [{"rule": v, "start": points[a], "end": points[b]} for a, b, v in found]


def new_ledger(spark: SparkSession) -> str:
    """Place for a ledger in the shared folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/secrets-{uuid.uuid4().hex}"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All rows of a ledger; one that is not there yet is begun."""
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(f"{ledger}/scan=begin")
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", ledger).parquet(ledger).drop("scan")


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose blob this task has not sent yet."""
    sent: set[bytes] = set()
    for batch in batches:
        fresh = []
        for blob in batch.column(0).to_pylist():
            fresh.append(blob not in sent)
            sent.add(blob)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _scan_blobs(rules: Sequence[SecretRule]):
    by_version = {r.version: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for batch in batches:
            at = 0
            for part in slices(batch.column(2)):
                blobs, lacks = (batch.column(i).slice(at, len(part)).to_pylist() for i in (0, 1))
                at += len(part)
                rows = []
                for blob, missing, text in zip(blobs, lacks, raw(part)):
                    if blob not in done:
                        done.add(blob)
                        rows.append((blob, missing, find_spans(text or b"", [by_version[v] for v in missing.split(",")])))
                columns = list(zip(*rows)) or [(), (), ()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), _SPANS))], names=["blob", "rules", "spans"])

    return scan


def unseen_texts(versions: DataFrame, known: DataFrame, text: str, rules: Sequence[SecretRule]) -> DataFrame:
    """(blob, rules it lacks, text) of the versions whose blob lacks any of ``rules``: one
    row for each task that held the blob, all of them in one partition."""
    wanted = F.array(*[F.lit(r.version) for r in rules])
    # one row a scan of the blob: as many as the rules have changed
    seen = known.groupBy("blob").agg(F.split(F.array_join(F.collect_set("rules"), ","), ",").alias("seen"))
    hashed = versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # the one shuffle of texts: the join and the scan go by the same key
    lone = hashed.mapInArrow(_first_of_each, "blob binary, text string").repartition("blob")
    missing = F.array_join(F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))), ",")
    return lone.join(seen, "blob", "left").select("blob", missing.alias("rules"), "text").where("rules != ''")


def scan_unseen(versions: DataFrame, ledger: str, text: str = "text", rules: Sequence[SecretRule] = RULES) -> str:
    """Run the missing rules over the blobs of ``versions`` and add the outcome to the
    ledger.  Returns the folder of this scan's rows."""
    spark = versions.sparkSession
    ship_code(spark)
    todo = unseen_texts(versions, read_ledger(spark, ledger), text, rules)
    found = todo.mapInArrow(_scan_blobs(rules), LEDGER_SCHEMA)
    folder = f"{ledger}/scan={uuid.uuid4().hex}"
    found.write.parquet(folder)
    return folder


def findings(known: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """(blob, spans) of the blobs in which the current rules found something; spans are
    structs (start, rank, end, kind) in order of start, then rule."""
    versions = [r.version for r in rules]
    current = F.filter("spans", lambda s: s["rule"].isin(*versions))
    some = known.select("blob", current.alias("spans")).where(F.size("spans") > 0)
    every = some.groupBy("blob").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    order, kinds = F.array(*[F.lit(v) for v in versions]), F.array(*[F.lit(r.kind) for r in rules])

    def named(s: Column) -> Column:
        rank = F.array_position(order, s["rule"]).cast("int")
        return F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), F.get(kinds, rank - 1).alias("kind"))

    return every.select("blob", F.array_sort(F.array_distinct(F.transform("spans", named))).alias("spans"))


def scan_history(versions: DataFrame, paths: Sequence[str], ledger: str | None = None, text: str = "text", rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """The path columns of every row of ``versions``, its blob, and ``spans`` (maybe none).

    Without ``ledger`` a new one is begun in the shared folder.
    """
    spark = versions.sparkSession
    ledger = ledger or new_ledger(spark)
    scan_unseen(versions, ledger, text, rules)
    found = findings(read_ledger(spark, ledger), rules)
    salted = found.select("blob", "spans", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    path = [F.col(f"`{p}`") for p in paths]
    rows = versions.select(F.struct(*path).alias("path"), blob_of(text).alias("blob"), F.pmod(F.xxhash64(*path), F.lit(SALTS)).cast("int").alias("salt"))
    joined = rows.join(salted, ["blob", "salt"], "left")
    nothing = F.array().cast(found.schema["spans"].dataType)
    return joined.select("path.*", "blob", F.coalesce("spans", nothing).alias("spans"))


def span_list(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end``, comma-joined, of all spans or those of ``kinds``."""
    some = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
