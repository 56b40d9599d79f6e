"""Pattern packing by non-negative least squares.

Only the histogram of lengths decides the packing. Patterns of up to three
lengths that fill a sequence exactly are enumerated, their repeat counts are
fit to the histogram by non-negative least squares, rounded down to what the
histogram holds, and the residual histogram is packed best-fit, longest
first, whole runs of equal lengths at a time. The resulting plan (which
ranks of which length go into which sequences) is bounded by the sequence
length alone; rows find their place in it by their exact rank among the rows
of their length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.bpe import byte_alphabet
from gridlake.llm.common import materialize, read_text, widened

LIMIT = 2048
#: Triples tried per smallest length, and rounds of coordinate descent.
TRIPLES, ROUNDS = 6, 60
#: Entries of a worker's table of encoded words.
CACHE = 500_000
ROWS = 256
_RANK_BITS = 42


# The word split of the public lower-case vocabulary (fixed value), with the
# letters and numbers below U+0100.
_L, _N = "a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9²³¹¼½¾"
SPLIT = re.compile(rf"[{_L}]+|'(?:s|t|re|ve|m|ll|d)|[{_N}]|[^\s{_L}{_N}]+").findall

# -- tokens -------------------------------------------------------------------


class _Table(dict):
    """Values by text, made on first look-up: at most ``size`` in two
    generations. A full younger generation replaces the older one, from which
    texts come back when they are looked up again, so frequent ones stay."""

    def __init__(self, make: Callable[[str], bytes], size: int):
        super().__init__()
        self.make, self.half = make, size // 2
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.make(text)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[text] = found
        return found


class WordTokenizer:
    """The tokenizers library behind a table of words.

    Texts of the characters below U+0100 without controls, which normalizing
    only lower-cases, are cut into words as the tokenizer's own split does.
    Words are looked up; new ones go to the library's BPE alone, past its
    normalizer. Any other text goes to the library whole."""

    plain = re.compile("[^\t\n\x0b\x0c\r -~\xa1-\xac\xae-\xff]").search

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words = _Table(self._word, CACHE)
        self.packed = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.letters = {b: c for c, b in byte_alphabet().items()}

    def _word(self, word: str) -> bytes:
        """Ids of one word: the library's BPE on its bytes' letters (the
        printable ASCII characters stand for themselves)."""
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        return b"".join([self.packed[t.id] for t in self.model.tokenize(word)])

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (little-endian unsigned 32-bit)."""
        look, out = self.words.__getitem__, []
        for t in texts:
            whole = self.plain(t) or any(s in t for s in self.special)
            out.append(self._whole([t])[0] if whole else b"".join(map(look, SPLIT(t.lower()))))
        return out


_WORKER: list = []


def _tokenizer(spec: str) -> WordTokenizer:
    if not _WORKER or _WORKER[0] is not spec:
        _WORKER[:] = spec, WordTokenizer(spec)
    return _WORKER[1]


def token_pieces(
    docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text",
    end: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """The pieces of every document's ids (tokenizer file at ``path``, special
    tokens not added, then ``end``): doc_id, piece, start, length, ids_crc32
    and, with ``keep_ids``, ids (binary, little-endian unsigned 32-bit).

    Documents of more than ``limit`` ids are cut into pieces of ``limit``; the
    last may be shorter. A null or empty text is the one id ``end``. Repeated
    rows give repeated pieces; a null id stays null; other columns are not
    read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_text(docs.sparkSession, path))
    rows = docs.select(doc_id, text)
    schema = widened(rows.select(doc_id), piece="int", start="long", length="long", ids_crc32="long")
    if keep_ids:
        schema = schema.add("ids", "binary")
    tail, step = np.array([end], "<u4").tobytes(), 4 * limit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _tokenizer(sent.value)
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                doc, piece, start, length, crc, kept = [], [], [], [], [], []
                for k, ids in enumerate(own.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += tail
                    for n, at in enumerate(range(0, len(ids), step)):
                        cut = ids[at : at + step]
                        doc.append(k)
                        piece.append(n)
                        start.append(at // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        if keep_ids:
                            kept.append(cut)
                cols = [
                    part.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * keep_ids, names=schema.names)

    return rows.mapInArrow(run, schema)


# -- the plan -----------------------------------------------------------------


def patterns(have: np.ndarray, limit: int, triples: int = TRIPLES) -> list[tuple[int, ...]]:
    """Ascending length patterns of one to three present lengths that sum to
    ``limit``: all singles and pairs, and per smallest length up to
    ``triples`` triples spread over its middle lengths."""
    out: list[tuple[int, ...]] = [(limit,)] if have[limit] else []
    out += [(a, limit - a) for a in range(1, limit // 2 + 1) if have[a] and have[limit - a]]
    for a in range(1, limit // 3 + 1):
        if have[a]:
            b = np.arange(a, (limit - a) // 2 + 1)
            b = b[(have[b] > 0) & (have[limit - a - b] > 0)]
            at = np.unique((np.arange(triples) + (a * 0.618) % 1) * len(b) // triples) if len(b) else []
            out += [(a, int(b[int(k)]), limit - a - int(b[int(k)])) for k in at]
    return out


def fit_counts(counts: np.ndarray, found: list[tuple[int, ...]], rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that minimise the squared tokens
    between the lengths they use and ``counts`` (a long row left over costs
    more than a short one, which fits anywhere): cyclic coordinate descent,
    each coordinate set to its exact minimiser."""
    residual = counts.astype(float).tolist()
    x = [0.0] * len(found)
    norm = [sum((p.count(v) * v) ** 2 for v in set(p)) for p in found]
    for _ in range(rounds):
        moved = 0.0
        for j, p in enumerate(found):
            step = max(-x[j], sum(residual[v] * v * v for v in p) / norm[j])
            if step:
                x[j] += step
                for v in p:
                    residual[v] -= step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return np.array(x)


Plan = list[tuple[int, list[tuple[int, int]]]]


def best_fit(left: np.ndarray, limit: int) -> Plan:
    """Packs ``left[length]`` rows of each length best-fit, longest first;
    bins of equal room are handled as one group."""
    room: list[Plan] = [[] for _ in range(limit + 1)]
    for v in range(limit, 0, -1):
        n, at = int(left[v]), v
        while n:
            while at <= limit and not room[at]:
                at += 1
            if at <= limit:
                # one after another into the fullest bins, as long as they fit
                have, parts = room[at].pop()
                q = at // v
                take = min(have, n // q)
                if take:
                    room[at - q * v].append((take, [*parts, (v, q)]))
                    n -= take * q
                else:
                    take = 1
                    room[at - n * v].append((1, [*parts, (v, n)]))
                    n = 0
                if have > take:
                    room[at].append((have - take, parts))
            else:
                q = limit // v
                full, rest = divmod(n, q)
                if full:
                    room[limit - q * v].append((full, [(v, q)]))
                if rest:
                    room[limit - rest * v].append((1, [(v, rest)]))
                n = 0
    return [g for groups in room for g in groups]


def plan_packing(counts: np.ndarray, limit: int = LIMIT) -> Plan:
    """How to pack ``counts[length]`` rows of each length: a list of (number
    of sequences, [(length, how many in each sequence), ...]).

    The fitted repeat counts are rounded to the nearest and, as another plan,
    down; a third plan uses no pattern but full rows. The one that needs the
    fewest sequences is taken, the first of equals."""
    found = patterns(counts, limit)
    repeats = fit_counts(counts, found)
    best: Plan | None = None
    for used in (np.floor(repeats + 0.5), np.floor(repeats), np.zeros(len(found))):
        left = counts.astype(np.int64).copy()
        plan: Plan = []
        for j in np.argsort(-repeats, kind="stable"):
            p = found[j]
            parts = [(v, p.count(v)) for v in sorted(set(p), reverse=True)]
            n = min(int(used[j]), *(int(left[v]) // q for v, q in parts))
            if n > 0:
                plan.append((n, parts))
                for v, q in parts:
                    left[v] -= n * q
        plan += best_fit(left, limit)
        if best is None or sum(n for n, _ in plan) < sum(n for n, _ in best):
            best = plan
    return best


class _Plan:
    """The plan by length and rank: arrays for binary search."""

    def __init__(self, plan: Plan):
        used: dict[int, int] = {}
        rows, base = [], 0
        for n, parts in plan:
            offset = 0
            for v, q in parts:
                rows.append((v, used.get(v, 0), q, base, offset))
                used[v] = used.get(v, 0) + n * q
                offset += v * q
            base += n
        at = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        self.length, self.first, self.each, self.base, self.offset = at
        self.code = (self.length << _RANK_BITS) + self.first

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.code, (length << _RANK_BITS) + rank, "right") - 1
        sequence, within = np.divmod(rank - self.first[at], self.each[at])
        return self.base[at] + sequence, self.offset[at] + within * length


def pack_pieces(pieces: DataFrame, limit: int = LIMIT, length: str = "length") -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset`` (long): every row's place
    in sequences of at most ``limit``, gapless from 0 in each.

    Rows without a length, or of length 0 or less, get nulls; a length over
    ``limit`` is an error. Repeated rows are packed each. An empty table gives
    an empty result; columns named sequence_id or offset are replaced. The
    histogram (``limit`` rows) is all that the driver sees.
    """
    pieces = pieces.drop("sequence_id", "offset")
    at = pieces.columns.index(length)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            size = pa.compute.fill_null(batch.column(at).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            if len(size) and size.max() > limit:
                raise ValueError(f"a piece of length {size.max()} does not fit {limit}")
            size = np.maximum(size, 0)
            order = np.argsort(size, kind="stable")
            n = np.bincount(size, minlength=limit + 1)
            rank = np.empty(len(size), np.int64)
            rank[order] = np.arange(len(size)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(seen, n)
            seen += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(size), task, np.int32)), pa.array(size), pa.array(rank)],
                names=[*batch.schema.names, "_task", "_length", "_rank"],
            )

    # the pieces are written before they are numbered: chained, the two Python
    # stages would hold twice as many workers, each with tables of words
    ranked = materialize(
        materialize(pieces, "unranked").mapInArrow(number, widened(pieces, _task="int", _length="long", _rank="long")), "pieces"
    )
    own = ranked.groupBy("_task", "_length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = materialize(
        own.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))), "pieces-ranks"
    )
    counts = np.zeros(limit + 1, np.int64)
    for r in firsts.groupBy("_length").agg(F.sum("_n").alias("n")).collect():
        counts[r["_length"]] = r.n
    counts[0] = 0
    sent = pieces.sparkSession.sparkContext.broadcast(_Plan(plan_packing(counts, limit)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (c.to_numpy(zero_copy_only=False) for c in batch.columns[-2:])
            none = size == 0
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            sequence[~none], offset[~none] = sent.value.place(size[~none], rank[~none])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(sequence, mask=none), pa.array(offset, mask=none)],
                names=names,
            )

    names = [*pieces.columns, "sequence_id", "offset"]
    known = ranked.join(firsts.select("_task", "_length", "_first"), ["_task", "_length"]).select(
        *pieces.columns, "_length", (F.col("_rank") + F.col("_first")).alias("_rank")
    )
    return known.mapInArrow(assign, widened(pieces, sequence_id="long", offset="long"))
