"""Source divergence audit by a minimal-perfect-hash recount.

A first pass counts exactly how many documents of each language hold each
term and keeps the frequent ones. Their vocabulary is cut into shards, and
each shard gets a minimal perfect hash with its terms stored by slot. The
hashes are broadcast, a bounded number of bytes at a time, and a second pass
over the documents counts every occurrence of a kept term into dense slots of
its (language, source) group; a term that the stored keys do not confirm is
not counted. Smoothed shares, and the divergence of each source from the other
sources and from its language, follow from the counts in integer arithmetic.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import materialize

#: Letters of ASCII and all characters beyond it, in UTF-8 after lower-casing A-Z.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: A text is read in slices of about so many bytes; a task holds so many
#: different terms, and bytes of them, before it hands them on, and so many
#: words before it counts them.
SLICE, HELD_TERMS, HELD_BYTES, WAITING = 1 << 19, 300_000, 32 << 20, 100_000
#: Terms of a shard on average, bytes of hashes that are broadcast at a time,
#: and counters that a task of the second pass holds.
SHARD_TERMS, WAVE_BYTES, HELD_SLOTS = 4096, 64 << 20, 20 << 20
#: Words counted before the 32-bit counters are handed on.
LARGEST = 1 << 30
#: Sources on either side that one task of the pair part compares, on average.
PAIR_BLOCK = 48
#: Shares are in billionths.
SCALE = 1_000_000_000


# -- terms -------------------------------------------------------------------


def _slices(data: bytes) -> Iterator[bytes]:
    """The lower-cased text in slices that cut no term."""
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and (data[end] >= 0x80 or chr(data[end]).isalpha()):
            end += 1
        yield data[at:end].lower()
        at = end


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): documents with the term, summed over parts of a task."""
    counts: dict[str, Counter] = defaultdict(Counter)
    held = size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                names=["lang", "term", "n"],
            )

    for batch in batches:
        for lang, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = set()
            for part in _slices(cell.as_py()):
                own.update(TERM.findall(part))
            counter = counts[lang]
            before = len(counter)
            counter.update(own)
            held += len(counter) - before
            if len(counter) > before:
                size += sum(map(len, own))
            if held > HELD_TERMS or size > HELD_BYTES:
                yield from out()
                counts.clear()
                held = size = 0
    yield from out()


# -- minimal perfect hashes --------------------------------------------------


def _lanes(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each term."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, terms)), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _place(lanes: tuple[np.ndarray, np.ndarray], level: int, m: int) -> np.ndarray:
    """A place below ``m`` for each key, another one at each level."""
    h = lanes[0] + np.uint64(2 * level + 1) * lanes[1]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(m)).astype(np.int64)


class PerfectHash:
    """Slots 0..n-1 of n different terms, with the term of each slot.

    Each level has a bit for every place that just one remaining key takes;
    keys that meet others go to the next level. A key's slot is the number of
    set bits before its own. Terms outside are found out by the stored keys.
    """

    def __init__(self, bits: list[np.ndarray], terms: pa.Array):
        self.bits, self.terms = bits, terms
        self.before, n = [], 0
        for b in bits:
            self.before.append(n + np.cumsum(b, dtype=np.int32) - b)
            n += int(b.sum())

    @classmethod
    def build(cls, terms: list[bytes]) -> PerfectHash:
        lanes, bits = _lanes(terms), []
        left = np.arange(len(terms))
        while len(left):
            if len(bits) > 1000:
                raise ValueError("two terms have one 128-bit hash")
            m = 2 * len(left)
            at = _place((lanes[0][left], lanes[1][left]), len(bits), m)
            bits.append(np.bincount(at, minlength=m) == 1)
            left = left[~bits[-1][at]]
        found = cls(bits, pa.array([], pa.binary()))
        order = np.empty(len(terms), np.int64)
        order[found.slots(lanes)] = np.arange(len(terms))
        found.terms = pa.array(terms, pa.binary()).take(pa.array(order))
        return found

    def slots(self, lanes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The slot of each key by its hashes, -1 where no level has it."""
        out = np.full(len(lanes[0]), -1)
        left = np.arange(len(out))
        for level, (b, before) in enumerate(zip(self.bits, self.before)):
            at = _place((lanes[0][left], lanes[1][left]), level, len(b))
            hit = b[at]
            out[left[hit]] = before[at[hit]]
            left = left[~hit]
        return out

    def verified(self, terms: pa.Array, lanes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The slot of each term, -1 for those that are not stored there."""
        slots = self.slots(lanes)
        if not len(self.terms):
            return slots
        same = pc.equal(self.terms.take(pa.array(np.maximum(slots, 0))), terms).to_numpy(zero_copy_only=False)
        return np.where(same, slots, -1)

    @classmethod
    def of(cls, state) -> PerfectHash:
        found = cls.__new__(cls)
        found.__setstate__(state)
        return found

    def __getstate__(self):
        return [(len(b), np.packbits(b)) for b in self.bits], self.terms

    def __setstate__(self, state):
        bits, terms = state
        self.__init__([np.unpackbits(b, count=n).astype(bool) for n, b in bits], terms)


_HASHES = "lang string, shard int, v long, hash binary, terms array<binary>, shards int, bytes long"


def _hash_of(group: pa.Table) -> pa.Table:
    found = PerfectHash.build(group["term"].to_pylist())
    packed = pickle.dumps(found.__getstate__())
    return pa.table({
        "lang": group["lang"].slice(0, 1), "shard": group["shard"].slice(0, 1), "v": pa.array([len(found.terms)], pa.int64()),
        "hash": pa.array([packed], pa.binary()), "terms": pa.array([found.terms.to_pylist()], pa.list_(pa.binary())),
        "shards": group["shards"].slice(0, 1), "bytes": pa.array([len(packed)], pa.int64()),
    })


def perfect_hashes(kept: DataFrame) -> DataFrame:
    """One row per shard of the kept terms (lang, term: binary): its hash, the
    number of its language's shards, and about the bytes it takes."""
    sizes = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SHARD_TERMS).cast("int").alias("shards"))
    return (
        kept.join(sizes, "lang")
        .withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))
        .repartition("lang", "shard")  # or the join's rows by language, of which one may have most, would do
        .groupBy("lang", "shard").applyInArrow(_hash_of, _HASHES)
    )


# -- recount -----------------------------------------------------------------


class _Recount:
    """Dense counters of each (lang, source) group, one for each slot of its
    language's shards in this wave, one shard after the other."""

    def __init__(self, tables: dict[str, tuple[int, dict[int, PerfectHash]]]):
        self.tables, self.starts, self.slots_of = tables, {}, {}
        for lang, (_, shards) in tables.items():
            ends = np.cumsum([len(t.terms) for t in shards.values()]).tolist()
            self.starts[lang] = dict(zip(shards, [0, *ends]))
            self.slots_of[lang] = ends[-1]
        self.known: dict[str, dict[bytes, int]] = {lang: {} for lang in self.tables}
        self.counters: dict[tuple[str, str], np.ndarray] = {}
        self.waiting: list[tuple[tuple[str, str], list[bytes]]] = []
        self.held = self.added = self.tokens = self.size = 0

    def take(self, group: tuple[str, str], terms: list[bytes]) -> None:
        self.waiting.append((group, terms))
        self.tokens += len(terms)

    def _learn(self, lang: str, terms: list[bytes]) -> None:
        """The places of terms not met before (the last counter: no kept term)."""
        place = np.full(len(terms), self.slots_of[lang], np.int64)
        lanes = _lanes(terms)
        # the shard as Spark's xxhash64 deals it
        hashed = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))
        n, tables = self.tables[lang]
        shards, array = hashed.astype(np.int64) % n, pa.array(terms, pa.binary())
        for shard in np.unique(shards).tolist():
            if shard in tables:  # else of another wave
                at = np.nonzero(shards == shard)[0]
                slots = tables[shard].verified(array.take(pa.array(at)), (lanes[0][at], lanes[1][at]))
                place[at[slots >= 0]] = self.starts[lang][shard] + slots[slots >= 0]
        self.known[lang].update(zip(terms, place.tolist()))
        self.size += sum(map(len, terms))

    def count(self) -> None:
        """Count what waits."""
        if sum(map(len, self.known.values())) > HELD_TERMS or self.size > HELD_BYTES:
            self.known, self.size = {lang: {} for lang in self.tables}, 0
        for lang in {group[0] for group, _ in self.waiting}:
            own = [(group, terms) for group, terms in self.waiting if group[0] == lang]
            terms = [t for _, part in own for t in part]
            places = np.fromiter(map(self.known[lang].get, terms, repeat(-1)), np.int64, len(terms))
            if len(missing := np.flatnonzero(places < 0)):
                self._learn(lang, list({terms[i] for i in missing}))
                places[missing] = [self.known[lang][terms[i]] for i in missing]
            at = 0
            for group, part in own:
                counter = self.counters.get(group)
                if counter is None:
                    counter = self.counters[group] = np.zeros(self.slots_of[lang] + 1, np.int32)
                    self.held += len(counter)
                np.add.at(counter, places[at : at + len(part)], 1)
                at += len(part)
        self.added += self.tokens
        self.waiting, self.tokens = [], 0

    def drain(self) -> Iterator[pa.RecordBatch]:
        rows = []
        for (lang, source), counter in self.counters.items():
            at = np.flatnonzero(counter[:-1])
            starts = self.starts[lang]
            cuts = np.searchsorted(at, [*starts.values(), self.slots_of[lang]])
            for (shard, start), a, b in zip(starts.items(), cuts, cuts[1:]):
                if a < b:
                    rows.append((lang, shard, source, *_blobs(at[a:b] - start, counter[at[a:b]])))
        self.counters, self.held, self.added = {}, 0, 0
        yield _batch(rows)


def _blobs(slots: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    return slots.astype("<i4").tobytes(), n.astype("<i8").tobytes()


def _batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = [pa.string(), pa.int32(), pa.string(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "shard", "source", "slots", "n"])


def _dense(slots: bytes, n: bytes, v: int) -> np.ndarray:
    out = np.zeros(v, np.int64)
    out[np.frombuffer(slots, "<i4")] = np.frombuffer(n, "<i8")
    return out


def _counted(batches: Iterator[pa.RecordBatch], tables: dict) -> Iterator[pa.RecordBatch]:
    """(lang, shard, source, slots, n) of the terms that the hashes hold."""
    recount = _Recount(tables)
    for batch in batches:
        for lang, source, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if lang not in tables:
                continue
            for part in _slices(cell.as_py()):
                recount.take((lang, source), TERM.findall(part))
                if recount.tokens > WAITING:
                    recount.count()
                    if recount.held > HELD_SLOTS or recount.added > LARGEST:
                        yield from recount.drain()
    recount.count()
    yield from recount.drain()


def _added(batches: Iterator[pa.RecordBatch], by_source: bool) -> Iterator[pa.RecordBatch]:
    """Sums of rows sorted by (lang, shard, source), or by (lang, shard), one
    group's counters at a time."""
    key, total = None, np.zeros(0, np.int64)

    def out() -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(total)
        if key is not None:
            yield _batch([(*key, *_blobs(at, total[at]))])

    for batch in batches:
        for lang, shard, source, slots, n in zip(*(c.to_pylist() for c in batch.columns)):
            own = (lang, shard, source if by_source else None)
            if own != key:
                yield from out()
                key, total = own, np.zeros(0, np.int64)
            at = np.frombuffer(slots, "<i4")  # ascending
            if len(at) and at[-1] >= len(total):
                total = np.concatenate([total, np.zeros(int(at[-1]) + 1 - len(total), np.int64)])
            total[at] += np.frombuffer(n, "<i8")
    yield from out()


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    by_source = "source" in keys
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _added(b, by_source), _COUNTS)


_COUNTS = "lang string, shard int, source string, slots binary, n binary"


def _waves(hashes: DataFrame) -> list[list[tuple[str, int]]]:
    """Shards in lots of at most WAVE_BYTES (or one shard). One short row per
    shard comes to the driver."""
    waves, size = [], WAVE_BYTES + 1
    for r in hashes.select("lang", "shard", "bytes").orderBy("lang", "shard").collect():
        if size + r.bytes > WAVE_BYTES:
            waves.append([])
            size = 0
        waves[-1].append((r.lang, r.shard))
        size += r.bytes
    return waves


def recount(texts: DataFrame, hashes: DataFrame) -> DataFrame:
    """(lang, shard, source, slots, n): for each group of the documents (lang,
    source, text: binary) and shard, the slots of the kept terms that occur, as
    32-bit integers in ascending order, and their occurrences as 64-bit ones."""
    spark = texts.sparkSession
    out = spark.createDataFrame([], _COUNTS)
    for wave in _waves(hashes):
        first, last = wave[0], wave[-1]
        of_wave = hashes.filter(
            ((F.col("lang") > first[0]) | ((F.col("lang") == first[0]) & (F.col("shard") >= first[1])))
            & ((F.col("lang") < last[0]) | ((F.col("lang") == last[0]) & (F.col("shard") <= last[1])))
        )
        tables: dict[str, tuple[int, dict[int, PerfectHash]]] = {}
        for r in of_wave.select("lang", "shard", "shards", "hash").collect():
            tables.setdefault(r.lang, (r.shards, {}))[1][r.shard] = PerfectHash.of(pickle.loads(r.hash))
        sent = spark.sparkContext.broadcast(tables)
        out = out.union(texts.mapInArrow(lambda b, sent=sent: _counted(b, sent.value), _COUNTS))
    return _sums(out, "lang", "shard", "source")


# -- divergence --------------------------------------------------------------


def _shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), in steps that fit 64 bits."""
    a, b = 31_250, SCALE // 31_250
    whole, rest = np.divmod((counts + 1) * a, total)
    return whole * b + rest * b // total + 1


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _audited(group: pa.Table, top: int) -> pa.Table:
    """Over one shard's terms: the divergence of each source of block i from
    each of block j, and the other way; and where i is j, the terms of each
    source that lead by their divergence from the language. Rows with a
    source have its counts and totals, the row without has the shard's terms
    and the language's counts."""
    rows = group.drop_columns(["terms"]).to_pylist()
    lang, i, j = rows[0]["lang"], rows[0]["i"], rows[0]["j"]
    sources = [r for r in rows if r["source"] is not None]
    v = sources[0]["v"] if sources else 0  # no source's hash fell into the block
    counts = [_dense(r["slots"] or b"", r["n"] or b"", v) for r in sources]
    p = np.array([_shares(c, r["total"]) for c, r in zip(counts, sources)])
    names = np.array([r["source"] for r in sources], object)
    block = np.array([r["block"] for r in sources])
    mine, other = np.nonzero(block == i)[0], np.nonzero(block == j)[0]
    out: dict[str, list] = {"part": [], "source": [], "item": [], "value": []}

    def add(part: str, source: str, items: list, values: np.ndarray) -> None:
        out["part"] += [part] * len(items)
        out["source"] += [source] * len(items)
        out["item"] += items
        out["value"] += values.tolist()

    for ours, theirs in [(mine, other)] if i == j else [(mine, other), (other, mine)]:
        for x in ours.tolist():
            y = theirs[theirs != x]
            add("pair", names[x], names[y].tolist(), _distances(p[x], p[y]).sum(axis=1))
    at = [k for k, r in enumerate(rows) if r["source"] is None]
    if i == j and at and v:
        terms = group["terms"][at[0]].as_py()
        order = np.empty(v, np.int64)
        order[sorted(range(v), key=terms.__getitem__)] = np.arange(v)
        q = _shares(_dense(rows[at[0]]["slots"], rows[at[0]]["n"], v), sources[0]["lang_total"])
        for x in mine.tolist():
            own = np.nonzero((counts[x] > 0) & (p[x] > q))[0]
            far = _distances(p[x][own], q[own])
            best = np.lexsort((order[own], -far))[:top]
            add("term", names[x], [terms[k].decode() for k in own[best]], far[best])
    kinds = {"part": pa.string(), "source": pa.string(), "item": pa.string(), "value": pa.int64()}
    return pa.table({"lang": pa.array([lang] * len(out["part"]), pa.string())} | {c: pa.array(out[c], k) for c, k in kinds.items()})


def _audit(counts: DataFrame, groups: DataFrame, hashes: DataFrame, top: int) -> DataFrame:
    """(lang, part, source, item, value): summed divergences of all ordered
    pairs of a language's sources, and for each source the ``top`` terms of
    each shard. A task has one shard's terms and two blocks of sources."""
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / PAIR_BLOCK).cast("int").alias("blocks"))
    cut = groups.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    heads = cut.join(hashes.select("lang", "shard", "v"), "lang", "left").select(
        "lang", "source", "blocks", "block", "total", "lang_total",
        F.coalesce("shard", F.lit(0)).alias("shard"), F.coalesce("v", F.lit(0)).alias("v"),  # no terms: one shard without
    )
    none = F.lit(None)
    sources = heads.join(counts, ["lang", "source", "shard"], "left").withColumn(
        "_o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "lang", "shard", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"), "block", "source", "total",
        "lang_total", "v", "slots", "n", none.cast("array<binary>").alias("terms"),
    )
    long = none.cast("long")
    wholes = _sums(counts, "lang", "shard").select("lang", "shard", "slots", "n").join(
        hashes.select("lang", "shard", "terms"), ["lang", "shard"]
    ).join(blocks, "lang").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "shard", "i", F.col("i").alias("j"), F.col("i").alias("block"), none.cast("string").alias("source"),
        long.alias("total"), long.alias("lang_total"), long.alias("v"), "slots", "n", "terms",
    )
    found = sources.union(wholes).groupBy("lang", "shard", "i", "j").applyInArrow(
        lambda t: _audited(t, top), "lang string, part string, source string, item string, value long"
    )
    return found.groupBy("lang", "part", "source", "item").agg(F.sum("value").alias("value"))  # a term is in one shard


def divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 3, top: int = 200
) -> DataFrame:
    """How the sources of each language differ in the use of its terms.

    A term is a run of ASCII letters and characters beyond ASCII, A-Z
    lower-cased. A language keeps the V terms that at least ``least_docs`` of
    its documents hold. A group with n occurrences of a kept term, N of all,
    has the share 1 + floor(10^9 (n + 1) / (N + V)) of it, and p diverges from
    q by floor((p - q)^2 / q). Returns (lang, source, part, item, value long,
    rank int): part ``pair`` has, for each other source of the language, the
    divergence from it summed over all kept terms; part ``term`` the ``top``
    kept terms that the source uses, with a larger share than its language
    has, by their divergence from the language. Ranks are by value, largest
    first, then by item in UTF-8 order.

    Each row is a document, repeated rows too. Null texts, languages and
    sources are empty ones; a language of one source has no pairs, one
    without kept terms has pairs of value 0. Texts are read whole. Empty
    tables give empty results; no other column is read.
    """
    empty = F.lit("")
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), empty).alias("lang"), F.coalesce(F.col(source).cast("string"), empty).alias("source"),
        F.coalesce(F.col(text), empty).cast("binary").alias("text"),
    )
    kept = materialize(
        texts.select("lang", "text").mapInArrow(_document_frequencies, "lang string, term binary, n long")
        .groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_docs).select("lang", "term"),
        "audit-terms",
    )
    hashes = materialize(perfect_hashes(kept), "audit-hashes")
    counts = materialize(recount(texts, hashes), "audit-counts")

    # a group's occurrences, added up from its shards' counters
    used = counts.mapInArrow(_occurrences, "lang string, source string, n long").groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kinds = hashes.groupBy("lang").agg(F.sum("v").alias("v"))
    groups = texts.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(kinds, "lang", "left").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")
    )
    whole = groups.groupBy("lang").agg((F.sum("n") + F.max("v")).alias("lang_total"))
    groups = materialize(
        groups.join(whole, "lang").select("lang", "source", F.greatest(F.col("n") + F.col("v"), F.lit(1)).alias("total"), "lang_total"),
        "audit-groups",
    )
    found = materialize(_audit(counts, groups, hashes, top), "audit-values")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]

    def of(part: str) -> DataFrame:
        return found.filter(F.col("part") == part).withColumn("rank", F.row_number().over(order)).select(*columns)

    return of("pair").union(of("term").filter(F.col("rank") <= top))


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [int(np.frombuffer(x.as_py(), "<i8").sum()) for x in batch.column("n")]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("source"), pa.array(n, pa.int64())], names=["lang", "source", "n"])
