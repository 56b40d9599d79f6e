"""Secret scans judged by corpus-wide ownership frequency.

Patterns find candidates in every text. Each candidate's value is hashed, and
the hashes are aggregated over the corpus: how many repositories hold the
value, and how many owners. A live-looking value that one owner alone holds is
a credential of that owner (``live``); one that several owners hold is a
widely copied example (``example``). Both verdicts go back to every place
where the value stands, as spans beside those of the patterns. Only hashes
leave the scan, never a value.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import materialize

#: Kinds of spans, in the order they are listed at one place of a text. The
#: first three are the patterns'; ``token`` finds further candidates, which
#: show as ``live`` or ``example`` only.
KINDS = ("assign", "access", "hex", "live", "example")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}")
#: What every match of ASSIGN holds, in lower case.
SIGNS = ("passw", "secret", "token", "apikey", "api_key")
SHORTEST_VALUE = 6
#: Parts of values that were never meant to be secret, in lower case.
PLACEHOLDERS = (
    "changeme", "dummy", "example", "fake", "insert", "placeholder", "redacted", "sample", "test", "xxxx", "your",
)
_PLACEHOLDER = re.compile("|".join(PLACEHOLDERS))
#: Different characters that a live-looking value has at least.
LEAST_VARIETY = 6


def looks_live(value: str) -> bool:
    """Letters and digits, varied, and no placeholder."""
    return (
        len(set(value)) >= LEAST_VARIETY and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        and not _PLACEHOLDER.search(value.lower())
    )


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Spans of the patterns, as (start, place in KINDS, end), and spans of
    the candidate values, each once; in code points."""
    spans, values = [], set()
    low = text.lower()
    if any(s in low for s in SIGNS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= SHORTEST_VALUE:
                spans.append((m.start(), 0, m.end()))
                values.add(m.span(2))
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        for m in pattern.finditer(text):
            spans.append((m.start(), kind, m.end()))
            values.add(m.span())
    for m in TOKEN.finditer(text):
        run = m.group()
        if run != run.lower() and run != run.upper() and any(c.isdigit() for c in run):
            values.add(m.span())
    return sorted(spans), sorted(values)


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_VALUE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary()), ("live", pa.bool_())])
_SCANNED = "spans array<struct<start:long,kind:int,end:long>>, found array<struct<start:long,end:long,hash:binary,live:boolean>>"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns before the last, the text, and what its scan finds."""
    for batch in batches:
        spans, found = [], []
        for cell in batch.column(batch.num_columns - 1):  # one text at a time in Python
            text = cell.as_py() or ""
            own, values = scan(text)
            spans.append([{"start": a, "kind": k, "end": b} for a, k, b in own])
            found.append([
                {"start": a, "end": b, "hash": hashlib.blake2b(text[a:b].encode(), digest_size=16).digest(),
                 "live": looks_live(text[a:b])}
                for a, b in values
            ])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(spans, pa.list_(_SPAN)), pa.array(found, pa.list_(_VALUE))],
            names=["row", "id", "owner", "repository", "spans", "found"],
        )


def ownership(held: DataFrame, live_owners: int = 1, example_owners: int = 3) -> DataFrame:
    """(hash, live, owners, repositories, verdict) of the candidates (hash,
    live, owner, repository): ``live`` for a live-looking value of at most
    ``live_owners`` owners, ``example`` for one of at least
    ``example_owners``, else null. A repository is one of its owner. Distinct
    holders are counted in steps, so a value that every document holds meets
    in one task only as one row per owner."""
    per_owner = held.distinct().groupBy("hash", "live", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    counted = per_owner.groupBy("hash", "live").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories")
    )
    verdict = F.when(F.col("owners") >= example_owners, "example").when(
        F.col("live") & (F.col("owners") <= live_owners), "live"
    )
    return counted.withColumn("verdict", verdict)


def find_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str | None = None,
    live_owners: int = 1, example_owners: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans``, an array of
    (start, kind, end, owners, repositories), ordered by start, kind (its
    place in KINDS) and end: the patterns' matches, and the values that
    ``ownership`` gives a verdict, with their numbers of holders (null for the
    patterns' own spans). Positions are code points, ends exclusive.

    ``repository`` (default: the document) and ``owner`` name the columns that
    tell who holds a value; null owners are one owner, null repositories one
    repository. A null text counts as empty. Repeated rows are scanned and
    returned each, but are one repository. Texts are searched whole. Empty
    tables give empty results; no other column is read.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository or doc_id).cast("string"), F.lit("")).alias("repository"), F.col(text).alias("text"),
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    scanned = materialize(
        rows.mapInArrow(_scanned, f"row long, id {kind}, owner string, repository string, {_SCANNED}"), "secrets"
    )
    some = scanned.filter(F.size("found") > 0)
    # written, so that the join below is between two plain exchanges, which AQE
    # can split where one value stands in many documents
    judged = materialize(
        ownership(
            some.select("owner", "repository", F.inline("found")).select("hash", "live", "owner", "repository"),
            live_owners, example_owners,
        ).filter("verdict IS NOT NULL").select("hash", "owners", "repositories", "verdict"),
        "secret-values",
    )
    place = F.when(F.col("verdict") == "live", KINDS.index("live")).otherwise(KINDS.index("example"))
    added = (
        some.select("row", F.inline("found")).join(judged, "hash")
        .groupBy("row").agg(F.collect_set(F.struct("start", place.alias("kind"), "end", "owners", "repositories")).alias("added"))
    )
    none = F.lit(None).cast("long")
    own = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), none.alias("owners"),
        none.alias("repositories"),
    ))
    names = F.array(*[F.lit(k) for k in KINDS])
    all_spans = F.array_sort(F.concat(own, F.coalesce("added", F.array().cast(
        "array<struct<start:long,kind:int,end:long,owners:long,repositories:long>>"
    ))))
    return scanned.join(added, "row", "left").select(
        F.col("id").alias(doc_id),
        F.transform(all_spans, lambda s: F.struct(
            s["start"].alias("start"), F.get(names, s["kind"]).alias("kind"), s["end"].alias("end"),
            s["owners"].alias("owners"), s["repositories"].alias("repositories"),
        )).alias("spans"),
    )


def of_kinds(spans: str, *kinds: str) -> Column:
    """The spans of ``kinds`` (default: all)."""
    return F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else F.col(spans)


def joined(spans: str, *kinds: str) -> Column:
    """``kind:start:end`` of the spans of ``kinds`` (default: all), in order."""
    return F.array_join(
        F.transform(of_kinds(spans, *kinds), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
