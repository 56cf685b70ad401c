"""Secret scans with a ledger of blobs.

A blob is a text, addressed by its SHA-256, whatever paths or versions hold it. The ledger
keeps, for each blob, which versions of which rules have scanned it and what they found. A
run scans only pairs of blob and rule version that the ledger lacks, appends them, and joins
the findings back to every path.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Collection, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_bytes, shared_folder, table

BATCH_BYTES = 8 << 20


class Rule(NamedTuple):
    """A kind of secret: the pattern, its flags, and how long group `group` must be.

    `hint` is a pattern that every text with a match also matches, quick to search for.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = re.ASCII
    hint: str = ""

    @property
    def version(self) -> str:
        told = "\x00".join(map(str, (self.kind, self.pattern, self.group, self.least, int(self.flags))))
        return f"{self.kind}-{hashlib.sha256(told.encode()).hexdigest()[:12]}"


#: The base kinds come first; where two spans start at one place, they go by this order.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        flags=re.ASCII | re.IGNORECASE,
        hint=r"(?i:pass|secret|token|api)",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),  # a run of these letters, whole, like [0-9a-f]+
    # To its END line, or to the end of the text if the key is cut off.
    Rule(
        "private_key",
        r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----"
        r"(?s:.*?)(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----|\Z)",
        hint="-----BEGIN ",
    ),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"\b[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # The password ends at the last @ before white space. Where there is none the rest of the run
    # is taken without the group, as no later URL of it can have one either.
    Rule(
        "url_password",
        r"(?<![A-Za-z0-9+.-])[A-Za-z0-9+.-]++://[^\s/:]*+:(?:(\S+@)|\S++)",
        group=1,
        hint="://",
    ),
)
BASE = ("assign", "access", "hex")

SPAN = "struct<start:bigint,kind_no:int,end:bigint,rule:string>"
LEDGER = f"blob string, rules array<string>, findings array<{SPAN}>"


def scan(
    text: str, rules: tuple[Rule, ...] = RULES, versions: Collection[str] | None = None
) -> list[tuple[int, int, int, str]]:
    """start, number of the kind, end and rule version of each finding, in code points.

    With `versions`, only rules of these versions are tried.
    """
    found = []
    for number, rule in enumerate(rules):
        if versions is not None and rule.version not in versions:
            continue
        if rule.hint and not re.search(rule.hint, text, re.ASCII):
            continue
        for match in re.finditer(rule.pattern, text, rule.flags):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                found.append((match.start(), number, match.end(), rule.version))
    return sorted(found)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """What former runs have written, or None if there was none."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/run-*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_versions(
    versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """path, blob and findings for every row of versions (path, text).

    `ledger` is a folder that keeps what was scanned; a run adds a subfolder to it. Null
    texts count as empty. Copies are reduced to one text in the map tasks before the blobs
    are shuffled. Findings are sorted by start, then by the order of the rules.
    """
    spark = versions.sparkSession
    named = versions.select("path", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "blob", F.sha2("text", 256)
    )
    wanted = F.array(*[F.lit(rule.version) for rule in rules])
    blobs = named.groupBy("blob").agg(F.any_value("text").alias("text"))
    before = _ledger(spark, ledger)
    if before is None:
        todo = blobs.withColumn("todo", wanted)
    else:
        done = before.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(
            F.collect_set("rule").alias("done")
        )
        todo = (
            blobs.join(done, "blob", "left")
            .withColumn("todo", F.array_except(wanted, F.coalesce("done", F.array())))
            .filter(F.size("todo") > 0)
        )

    fields = ("start", "kind_no", "end", "rule")
    kind = pa.list_(pa.struct(list(zip(fields, (pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True))))
    all_versions = {rule.version for rule in rules}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            findings = []
            for text, asked in zip(*(batch.column(c).to_pylist() for c in ("text", "todo")), strict=True):
                spans = scan(text, rules, None if len(asked) == len(all_versions) else asked)
                findings.append([dict(zip(fields, span, strict=True)) for span in spans])
            yield pa.record_batch(
                [batch.column("blob"), batch.column("todo"), pa.array(findings, kind)],
                ["blob", "rules", "findings"],
            )

    todo.select("blob", "text", "todo").mapInArrow(look, LEDGER).write.parquet(
        f"{ledger}/run-{uuid.uuid4().hex}"
    )
    known = (
        _ledger(spark, ledger)
        .select("blob", F.explode("findings").alias("f"))
        .filter(F.array_contains(wanted, F.col("f.rule")))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set("f")).alias("findings"))
    )
    nothing = F.array().cast(f"array<{SPAN}>")
    return (
        named.select("path", "blob")
        .join(known, "blob", "left")
        .withColumn("findings", F.coalesce("findings", nothing))
        .select("path", "blob", "findings")
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as paths with one version each, against a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents")
    found = scan_versions(
        docs.select(F.col("doc_id").alias("path"), "text"), shared_folder(spark, "blob-ledger")
    )
    kinds = F.array(*[F.lit(rule.kind) for rule in RULES])

    def told(spans: Column | str) -> Column:
        texts = F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind_no"]), s["start"], s["end"])
        )
        return F.array_join(texts, ",")

    def count(kind: str) -> Column:
        number = [rule.kind for rule in RULES].index(kind)
        return F.size(F.filter("findings", lambda s: s["kind_no"] == number)).cast("long")

    base = F.filter("findings", lambda s: s["kind_no"] < len(BASE))
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("findings")).alias("spans"),
    )
