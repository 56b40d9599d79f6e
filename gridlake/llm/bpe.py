"""Byte-level BPE by a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that BPE can produce. It
starts as one state with a loop for every byte. Each merge (a, b) in rank
order adds a gadget: the target of the a-arcs becomes a copy of itself
without the b-arc, and wherever an a-arc and then a b-arc led from p to q, an
arc for the new token ab leads from p to q. Since all arcs of one token share
their target and their set of sources is copied from an earlier token's, the
automaton is held by classes: ``row[token]`` is the state its arcs lead to,
``col[token]`` the class of its sources, and one bit matrix says which class
can leave which state.

Every prefix of a word has exactly one accepted token sequence, so encoding
keeps one state per position: from each position the trie of labels is
walked, and a label whose class may leave the position's state fixes the
state where it ends. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gridlake.llm.common import read_text, widened

#: Words up to this many bytes are encoded side by side in arrays.
SHORT = 48
#: Entries of a worker's table of encoded words; it starts anew when full.
CACHE = 200_000
ROWS = 256

# The byte-level split of public GPT-2-style vocabularies (fixed value).
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte: itself where
    printable, else the next free one from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_labels(spec: dict) -> list[bytes]:
    """The bytes of each token id, special tokens included."""
    alphabet = byte_alphabet()
    named = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    named |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    return [named.get(i, b"") for i in range(max(named) + 1)]


def compile_automaton(spec: dict) -> dict:
    """The tables of the automaton for a tokenizer file's content: state and
    source class of each token, the packed bit matrix, labels, trie."""
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
    labels, size = token_labels(spec), max(vocab.values()) + 1
    made = {vocab[a + b] for a, b in merges}
    base = [i for i in vocab.values() if i not in made]

    row, col = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    can = np.zeros((1 << 10, 1 << 9), np.uint8)  # [state, class], grown on demand
    can[0, : len(base)] = 1
    row[base], col[base] = 0, np.arange(len(base))
    states, classes = [len(base) + 1], [1] * len(base)  # holders; the start holds state 0
    free_s: list[int] = []
    free_c: list[int] = []

    def state() -> int:
        nonlocal can
        if free_s:
            return free_s.pop()
        states.append(0)
        if len(states) > can.shape[0]:
            can = np.concatenate([can, np.zeros_like(can[: can.shape[0] // 2])])
        return len(states) - 1

    def source() -> int:
        nonlocal can
        if free_c:
            return free_c.pop()
        classes.append(0)
        if len(classes) > can.shape[1]:
            can = np.concatenate([can, np.zeros_like(can[:, : can.shape[1] // 2])], axis=1)
        return len(classes) - 1

    for a, b in merges:
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        s, c, target = row[u], col[v], row[v]
        if not can[s, c]:  # no accepted sequence has this pair: the token never arises
            new = source()
            can[:, new] = 0
            classes[new] += 1
            row[w], col[w] = target, new
            states[target] += 1
            continue
        states[target] += 1
        row[w] = target
        if states[s] > 1:  # u's target also serves other tokens: copy it
            new = state()
            can[new] = can[s]
            states[s] -= 1
            states[new] = 1
            row[u] = s = new
        if classes[c] > 1:
            new = source()
            can[: len(states), new] = can[: len(states), c]
            classes[c] -= 1
            classes[new] = 1
            col[v] = c = new
        can[s, c] = 0
        col[w] = col[u]
        classes[col[w]] += 1

    # trie of the labels that an arc exists for
    child: dict[int, int] = {}
    ends = [-1]
    for i in sorted(vocab.values()):
        node = 0
        for x in labels[i]:
            node = child.setdefault(node * 256 + x, len(ends))
            if node == len(ends):
                ends.append(-1)
        if can[: len(states), col[i]].any():
            ends[node] = i
    keys = np.fromiter(child, np.int64, len(child))
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    return {
        "row": row, "col": col, "labels": labels, "special": special, "ends": np.array(ends, np.int32),
        "can": np.packbits(can[: len(states), : len(classes)], axis=1, bitorder="little"),
        "edges": keys, "to": np.fromiter(child.values(), np.int32, len(child)),
    }


_OTHER_BLANK = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search


def uneven(text: str) -> bool:
    """Whether a blank of the text is neither one space between two words
    nor a line end inside a word's run."""
    return (
        text[:1].isspace() or text[-1:].isspace() or "  " in text or " \n" in text or "\n " in text
        or _OTHER_BLANK(text) is not None
    )


class Encoder:
    """Runs the tables on texts; one per Python worker."""

    def __init__(self, tables: dict):
        self.row, self.col, self.can = tables["row"], tables["col"], tables["can"]
        self.labels, self.ends, self.special = tables["labels"], tables["ends"], tables["special"]
        self.trie = np.zeros((len(self.ends), 256), np.int32)
        self.trie.ravel()[tables["edges"]] = tables["to"]
        self.size = np.fromiter(map(len, self.labels), np.int64, len(self.labels))
        self.split = regex.compile(SPLIT).findall
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _may(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        c = self.col[tokens]
        return (self.can[states, c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1

    def _long(self, word: bytes) -> bytes:
        """Ids of one word, position by position."""
        last, n = [-1] * len(word), len(word)
        trie, ends, row, col, can = self.trie, self.ends, self.row, self.col, self.can
        for i in range(n):
            state, node = (row[last[i - 1]] if i else 0), 0
            for e in range(i, n):
                node = trie[node, word[e]]
                if not node:
                    break
                t = ends[node]
                if t >= 0 and can[state, col[t] >> 3] >> (col[t] & 7) & 1:
                    last[e] = int(t)
        out = []
        while n:
            out.append(last[n - 1])
            n -= int(self.size[out[-1]])
        return np.array(out[::-1], "<u4").tobytes()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each non-empty word (little-endian unsigned 32-bit)."""
        out: list = [b""] * len(words)
        short = []
        for k, w in enumerate(words):
            if len(w) > SHORT:
                out[k] = self._long(w)
            else:
                short.append(k)
        short.sort(key=lambda k: -len(words[k]))
        if not short:
            return out
        data = np.frombuffer(b"".join(words[k] for k in short), np.uint8)
        size = np.fromiter((len(words[k]) for k in short), np.int64, len(short))
        start = np.cumsum(size) - size
        last = np.zeros(len(data), np.int32)
        for i in range(int(size[0])):
            idx = np.arange(np.searchsorted(-size, -i, "left"))  # words longer than i
            state = self.row[last[start[idx] + i - 1]] if i else np.zeros(len(idx), np.int32)
            node = np.zeros(len(idx), np.int32)
            e = i
            while len(idx):
                node = self.trie[node, data[start[idx] + e]]
                go = node > 0
                idx, node, state = idx[go], node[go], state[go]
                token = self.ends[node]
                at = np.nonzero(token >= 0)[0]
                at = at[self._may(state[at], token[at])]
                last[start[idx[at]] + e] = token[at]
                e += 1
                go = size[idx] > e
                idx, node, state = idx[go], node[go], state[go]
        steps, left, idx = [], size.copy(), np.arange(len(short))
        while len(idx):
            token = last[start[idx] + left[idx] - 1]
            steps.append((idx, token))
            left[idx] -= self.size[token]
            idx = idx[left[idx] > 0]
        who = np.concatenate([i for i, _ in steps])
        order = np.lexsort((-np.repeat(np.arange(len(steps)), [len(i) for i, _ in steps]), who))
        flat = np.concatenate([t for _, t in steps])[order].astype("<u4").tobytes()
        end = 4 * np.cumsum(np.bincount(who, minlength=len(short)))
        a = 0
        for k, b in zip(short, end.tolist()):
            out[k] = flat[a:b]
            a = b
        return out

    def _learn(self, pieces: list[str]) -> None:
        new = [p for p in dict.fromkeys(pieces) if p not in self.words]
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = list(dict.fromkeys(pieces))
        self.words.update(zip(new, self.encode_words([p.encode() for p in new])))

    def _parts(self, text: str) -> list[str | int]:
        """The text cut at special tokens, which become their ids."""
        if self.marks is None or not (found := self.marks.findall(text)):
            return [text]
        out: list[str | int] = []
        for part, mark in zip(self.marks.split(text), [*found, None]):
            out += [part] if mark is None else [part, self.special[mark]]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (little-endian unsigned 32-bit)."""
        plans, pieces, need = [], [], set()
        for text in texts:
            plan = []
            for part in self._parts(text):
                if isinstance(part, int):
                    plan.append(([], [], part.to_bytes(4, "little")))
                    continue
                # one space between two words belongs to the second word: cut there
                first, *rest = [part] if uneven(part) else part.split(" ")
                head = self.split(first)
                pieces += head
                need.update(rest)
                plan.append((head, rest, b""))
            plans.append(plan)
        need.difference_update(self.chunks)
        if len(self.chunks) + len(need) > CACHE:
            self.chunks.clear()
            need = {c for plan in plans for _, rest, _ in plan for c in rest}
        cut = {c: self.split(" " + c) for c in need}
        for own in cut.values():
            pieces += own
        self._learn(pieces)
        word, chunk = self.words.__getitem__, self.chunks.__getitem__
        for c, own in cut.items():
            self.chunks[c] = b"".join(map(word, own))
        return [
            b"".join([b"".join([*map(word, head), mark, *map(chunk, rest)]) for head, rest, mark in plan])
            for plan in plans
        ]


def decode(labels: list[bytes], ids: bytes) -> str:
    return b"".join(map(labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_WORKER: list = []


def encoder(tables: dict) -> Encoder:
    """This worker's encoder for the automaton; its tables of words last
    from task to task."""
    if not _WORKER or _WORKER[0] is not tables:
        _WORKER[:] = tables, Encoder(tables)
    return _WORKER[1]


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``ids`` (binary: little-endian unsigned 32-bit) and
    ``n_tokens`` (long), for the tokenizer file at ``path``.

    Special tokens in a text become their ids. A null or empty text has no
    ids. Columns named ids or n_tokens are replaced, all others pass through.
    Memory of a task is that of ROWS documents and of a bounded word table.
    """
    spark = docs.sparkSession
    docs = docs.drop("ids", "n_tokens")
    sent = spark.sparkContext.broadcast(compile_automaton(json.loads(read_text(spark, path))))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = encoder(sent.value)
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                ids = own.encode([t or "" for t in part.column(at).to_pylist()])
                cols = [*part.columns, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "ids", "n_tokens"])

    return docs.mapInArrow(run, widened(docs, ids="binary", n_tokens="long"))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` plus ``decoded`` (string): the labels of each row's ``ids`` in
    order, special tokens included; bytes that are no UTF-8 become U+FFFD.
    Null ids decode to the empty text."""
    spark = docs.sparkSession
    docs = docs.drop("decoded")
    sent = spark.sparkContext.broadcast(token_labels(json.loads(read_text(spark, path))))
    at = docs.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = sent.value
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                texts = [decode(labels, x or b"") for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
                )

    return docs.mapInArrow(run, widened(docs, decoded="string"))
