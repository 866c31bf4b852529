"""Secret scans: known shapes, and windows of high entropy by character class.

The base shapes are an assignment to a name like ``password``, an access key id
and a long hexadecimal string. Besides, each maximal candidate string of
``MIN_CANDIDATE`` or more token characters is scanned once per character class: a
window slides over each of its stretches within the class, the counts of the
window's characters are kept up as one enters and one leaves, and with them the
Shannon entropy. Windows that reach the class's bits are joined to spans, which
are dropped where the allow-list covers them.

One pass over each text by itself: nothing is shuffled or gathered.

Defined results: null text counts as empty: no spans; repeated rows are each
scanned; other columns pass through, and result names replace input columns of the
same name. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import prepare_workers, read_table, reserved

#: Fixed shapes.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings of the entropy scan, its window, and for each class the
#: characters and the bits that a window must reach.
MIN_CANDIDATE = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
CLASSES = (
    ("hex", frozenset("0123456789abcdef"), 3.0),
    ("upper", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 3.7),
    ("base64", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="), 3.9),
)

#: Strings that are no secrets whatever their entropy: words without a digit,
#: dates and numbers, uuids, paths of words, placeholders.
ALLOWED = (
    re.compile(r"[A-Za-z_/+=-]+"),
    re.compile(r"[0-9/_+=-]+"),
    re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"),
    re.compile(r"(?:[A-Za-z]{2,}|[0-9]{1,4})(?:[/_-](?:[A-Za-z]{2,}|[0-9]{1,4}))+"),
    re.compile(r".*(?:EXAMPLE|example|placeholder|0123456789|abcdefghij).*"),
)

_C_LOG_C = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]


def entropy_spans(candidate: str, characters: frozenset[str], bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Joined windows of ``candidate`` within the class that reach ``bits``.

    Entropy is log2(w) - sum(c log2 c) / w; the sum changes by two terms a step.
    """
    spans: list[tuple[int, int]] = []
    most = (log2(window) - bits) * window + 1e-9
    start, total, counts = 0, 0.0, {}
    for end, ch in enumerate(candidate):
        if ch not in characters:
            start, total, counts = end + 1, 0.0, {}
            continue
        c = counts.get(ch, 0)
        total += _C_LOG_C[c + 1] - _C_LOG_C[c]
        counts[ch] = c + 1
        if end - start >= window:
            gone = candidate[start]
            c = counts[gone]
            total += _C_LOG_C[c - 1] - _C_LOG_C[c]
            counts[gone] = c - 1
            start += 1
        if end - start + 1 == window and total <= most:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end + 1)
            else:
                spans.append((start, end + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known shapes, leftmost and not overlapping per kind."""
    found: list[tuple[int, int, str]] = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def high_entropy_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of any class, joined where they overlap, without allowed strings."""
    found = []
    for m in CANDIDATE.finditer(text):
        candidate = m[0]
        if any(a.fullmatch(candidate) for a in ALLOWED):
            continue
        spans = sorted(s for _, characters, bits in CLASSES for s in entropy_spans(candidate, characters, bits))
        joined: list[tuple[int, int]] = []
        for start, end in spans:
            if joined and start <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
            else:
                joined.append((start, end))
        found += [(m.start() + s, m.start() + e, "entropy") for s, e in joined if not any(a.fullmatch(candidate[s:e]) for a in ALLOWED)]
    return found


SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())])


def scan_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Add base and spans: arrays of (start, end, kind) by start, then kind."""
    prepare_workers(df.sparkSession)
    added = [T.StructField("base", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN))]
    kept = [f for f in df.schema.fields if f.name.lower() not in ("base", "spans")]
    width = len(kept)
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias(reserved(df, "text")["text"]))
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans = [], []
            for t in batch.column(width).to_pylist():
                known = base_spans(t or "")
                base.append(known)
                spans.append(sorted(known + high_entropy_spans(t or ""), key=lambda s: (s[0], KINDS.index(s[2]))))
            shaped = [pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in row] for row in rows], arrow) for rows in (base, spans)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(width)], *shaped], names=[f.name for f in kept] + ["base", "spans"])

    return source.mapInArrow(run, T.StructType([*kept, *added]))


def _shown(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    number = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return scanned.select("doc_id", *number, F.sha2(_shown("base"), 256).alias("base_sha256"), _shown("spans").alias("spans"))
