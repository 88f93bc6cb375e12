"""Secret scan with corpus-wide ownership frequency.

Base spans are found by three fixed patterns.  Further candidates (provider tokens, key blocks,
mixed high-entropy strings) are only suspicious: what decides is who owns them.  Every
candidate value, base or not, is hashed and aggregated over the whole corpus by distinct
owners and repositories.  A value that several owners or many repositories carry is a copied example; one of a single
owner and few repositories is live-looking.  Extra candidates join the result when live-looking; base spans
always stay, and ``n_live`` / ``n_example`` say how each was judged.

Scale: one pass over the texts writes narrow rows (no texts); frequencies are two partially
aggregated ``groupBy``s (distinct pairs first, then counts), so a value that a third of the corpus
carries reaches the shuffle as one row per task and owner.

Defined results: null text is empty and has no spans; a null owner or repository counts as one
owner or repository of its own; repeated rows give repeated results; an empty table gives no rows;
other columns are not read.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, stored

# The base patterns and the least length of what must match
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")     # maximal runs of 24 and more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: further kinds, in the order that breaks ties of start
EXTRA = {
    "provider": re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "keyblock": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    "mixed": re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"),
}
KINDS = ["assign", "access", "hex", *EXTRA]
#: a live-looking value is carried by so many owners and repositories at most
MAX_OWNERS, MAX_REPOSITORIES = 1, 8
MIXED_BITS = 3.5          # least entropy of a "mixed" candidate, bits a character

# Supersets that a linear-time matcher finds quickly; only texts that they hit are scanned in full
_MAY = [r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
        r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}",
        r"[A-Za-z0-9+/_=-]{20}|eyJ[A-Za-z0-9_-]{8}|-----BEGIN |xox[abprs]-"]


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in map(s.count, set(s)))


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of all candidates in order; extras never overlap a base span."""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    extra = []
    for k, name in enumerate(EXTRA, 3):
        for m in EXTRA[name].finditer(text):
            value = m[0]
            if name == "mixed" and not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
                                        and _entropy(value) >= MIXED_BITS):
                continue
            extra.append((m.start(), k, m.end()))
    taken = sorted(base)
    for span in sorted(extra):
        if not any(s < span[2] and span[0] < e for s, _, e in taken):
            taken.append(span)
    return sorted(taken)


def _value(text: str, start: int, kind: int, end: int) -> str:
    """What is compared across owners: the secret itself, without the name it is assigned to."""
    if kind == 0:
        return ASSIGN.match(text, start)[2]
    return text[start:end]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.binary())])
    for batch in batches:
        text = batch.column("text").fill_null("")
        may = [pc.match_substring_regex(text, p) for p in _MAY]
        may = pc.or_(pc.or_(may[0], may[1]), may[2]).to_pylist()
        found = []
        for hit, t in zip(may, text):
            if not hit:
                found.append([])
                continue
            t = t.as_py()
            found.append([{"start": s, "kind": k, "end": e,
                           "value": hashlib.blake2b(_value(t, s, k, e).encode(), digest_size=16).digest()}
                          for s, k, e in find_spans(t)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("repo"), batch.column("owner"), pa.array(found, pa.list_(span))],
            names=["id", "repo", "owner", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id",
                 owner_col: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per row: the id and ``spans``, an array of (start, kind, end, owners, repositories, live).

    A value is live-looking when at most ``max_owners`` distinct owners and ``max_repositories`` distinct repositories carry it:
    what lies in more of either is an example that people copy.
    """
    python_ready(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(repo_col).cast("string").alias("repo"),
                         F.col(owner_col).cast("string").alias("owner"), F.col(text_col).alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    rows = stored(
        narrow.mapInArrow(_scan, f"id {id_type}, repo string, owner string, "
                          "spans array<struct<start:bigint,kind:int,end:bigint,value:binary>>")
        .withColumn("row", F.monotonically_increasing_id()), "secret-spans")

    found = rows.select("row", "repo", "owner", F.explode("spans").alias("s")).select(
        "row", "repo", "owner", "s.start", "s.kind", "s.end", "s.value")
    owners = found.groupBy("value", "owner").agg(F.lit(1).alias("x")).groupBy("value").agg(
        F.count("*").alias("owners"))
    repos = found.groupBy("value", "repo").agg(F.lit(1).alias("x")).groupBy("value").agg(
        F.count("*").alias("repositories"))
    # a small table beside all spans, stored, so that a value that very many rows carry can be split
    spread = stored(owners.join(repos, "value"), "secret-values")
    judged = found.join(spread, "value")
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind", "end", "owners", "repositories",
        ((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).alias("live")))).alias("spans"))
    return (rows.select("id", "row").join(per_row, "row", "left")
            .select(F.col("id").alias(id_col),
                    F.expr("filter(coalesce(spans, array()), s -> s.kind < 3 or s.live)").alias("spans")))


def span_digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the digest of the base spans and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: lambda s: s["kind"] == k
    return scanned.select(
        id_col,
        *[count(of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(text(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"))
