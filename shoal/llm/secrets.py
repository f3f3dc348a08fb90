"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its bytes).  The ledger
holds the (blob, rule version) pairs already scanned and their findings; a run scans only
the blobs its rule version hasn't seen, each once however many paths hold it, and joins
the findings back to all paths.

Cases: a null text is the empty blob and has no findings; repeated rows come back as
often as they came in; very long texts are scanned whole; empty tables give empty
results; only the named columns are read, so further columns can't clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm import common as C


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds candidates, leftmost and non-overlapping; ``group`` of at least
    ``least`` characters passes.  ``hints``: lower-case bytes of which a text must hold one."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0
    hints: tuple[bytes, ...] = ()


BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               2, 12, re.IGNORECASE | re.ASCII, (b"passw", b"secret", b"token", b"api")),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 18, 0, (b"akia",)),
    SecretRule("hex", r"[0-9a-f]+", 0, 16),
)
MORE_RULES = (
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----", hints=(b"private key",)),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=(b"eyj",)),
    SecretRule("bearer", r"(?:authorization|bearer)[\x20:=\"']+(?:bearer\x20+)?([A-Za-z0-9+/_.=-]+)", 1, 20, re.IGNORECASE | re.ASCII, (b"bearer", b"authorization")),
    SecretRule("hosting", r"(?:gh[pousr]_|xox[abpr]-)[A-Za-z0-9-]+", 0, 20, 0, (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_", b"xox")),
)
RULES = BASE_RULES + MORE_RULES
FINDING = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_FINDING = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_HEX = bytes(0x31 if c in b"0123456789abcdef" else 0x30 for c in range(256))


class Scanner:
    def __init__(self, rules: tuple[SecretRule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern, r.flags)) for r in rules]

    def __call__(self, raw: bytes) -> list[dict]:
        """Findings in code points, end exclusive, by start, then by the rules' order."""
        low, text, out = raw.lower(), None, []
        for k, (rule, pattern) in enumerate(self.rules):
            if rule.hints and not any(h in low for h in rule.hints):
                continue
            if rule.kind == "hex" and b"1" * rule.least not in raw.translate(_HEX):
                continue
            text = raw.decode("utf-8", "replace") if text is None else text
            out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least]
        return [{"kind": self.rules[k][0].kind, "start": s, "end": e} for s, k, e in sorted(out)]


def rule_version(rules: tuple[SecretRule, ...] = RULES) -> str:
    from hashlib import sha256

    return sha256(repr(rules).encode()).hexdigest()[:16]


def versions(table: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """(path, blob, content): every version row with its content address."""
    content = C.text_bytes(text_col)
    return table.select(F.col(path_col).alias("path"), F.sha2(content, 256).alias("blob"), content.alias("content"))


def unseen(vers: DataFrame, ledger: DataFrame | None, version: str) -> DataFrame:
    """(blob, content) once for each blob that (blob, ``version``) in the ledger doesn't cover.

    The blob's first path stands for it.  Only narrow rows are aggregated (copies by the
    thousand collapse before the shuffle); contents meet them on (path, blob), a key no
    group of copies shares."""
    todo = vers.groupBy("blob").agg(F.min("path").alias("first"))
    if ledger is not None:
        todo = todo.join(ledger.where(F.col("rule_version") == version).select(F.col("blob").alias("done")),
                         F.col("blob") == F.col("done"), "left_anti")
    todo = todo.select(F.col("blob").alias("b"), F.col("first").alias("p")).hint("shuffle_hash")
    return vers.join(todo, (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("p"))).select("blob", "content")


def scan(blobs: DataFrame, version: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rule_version, findings) of the given blobs."""

    def run(batches):
        find = Scanner(rules)
        for b in batches:
            found = [find(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([version] * len(found), pa.string()), pa.array(found, ARROW_FINDING)],
                                             ["blob", "rule_version", "findings"])

    schema = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rule_version", T.StringType()), T.StructField("findings", FINDING)])
    # rows repeated with path and content alike: one ledger row
    return C.map_batches(blobs, run, schema).dropDuplicates(["blob"])


def update_ledger(table: DataFrame, ledger_path: str, path_col: str = "doc_id", text_col: str = "text",
                  rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Scan what the Parquet ledger at ``ledger_path`` hasn't seen, append it, and return
    the whole ledger.  A run that dies before its append commits is simply run again."""
    spark, version = table.sparkSession, rule_version(rules)
    schema = "blob string, rule_version string, findings array<struct<kind:string,start:int,end:int>>"
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    there = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)
    old = spark.read.schema(schema).parquet(ledger_path) if there else None
    scan(unseen(versions(table, path_col, text_col), old, version), version, rules).write.mode("append").parquet(ledger_path)
    return spark.read.schema(schema).parquet(ledger_path)


def findings(table: DataFrame, ledger: DataFrame, path_col: str = "doc_id", text_col: str = "text",
             rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(path, blob, findings) for every row of ``table``.  Blobs with findings join;
    a blob that very many paths share is split by the adaptive skew join."""
    now = ledger.where((F.col("rule_version") == rule_version(rules)) & (F.size("findings") > 0)) \
        .select(F.col("blob").alias("b"), "findings")
    paths = table.select(F.col(path_col).alias("path"), F.sha2(C.text_bytes(text_col), 256).alias("blob"))
    return paths.join(now, F.col("blob") == F.col("b"), "left").select(
        "path", "blob", F.coalesce("findings", F.array().cast(FINDING)).alias("findings"))
