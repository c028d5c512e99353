"""BPE encoding and decoding by a deterministic automaton over tokens.

The automaton starts with one state that every symbol leads back to. Merges
are applied in order by a gadget: for a merge (u, v) -> uv, reading u now
leads to a copy of the state it led to that lacks the arc v, and wherever u
can be read, uv can be read too and leads where v led before. What remains
accepts exactly the token sequences that the merges produce, so each prefix
of a word has one accepted path, and a word is encoded by following arcs.

A copy differs from the state it was made of by one arc, and every state is
the one some arc leads to: so a state is named by its arc and kept as the arcs
it lacks, each with the time of its merge, and the arc whose state it was made
of. Whether a state has an arc follows from walking both arcs back in time, a
few steps each; looked-up transitions are kept in a table. That keeps the
49k-merge automaton at one entry per merge.

Edge cases: a null text is encoded like an empty one (no token, empty decoded
text); strings of the added tokens inside a text become those tokens, as the
file says; a word of any length is encoded whole; repeated rows give repeated
results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkeep.llm.common import give_back

#: Entries of a worker's word table before the older half goes: bounds memory only.
WORD_TABLE = 125_000
_ROOT = -1  # the state before any arc: it has them all


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level
    vocabularies: itself where printable in Latin-1, else the next free code
    point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class Automaton:
    """States and arcs compiled from a tokenizer file's merges."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.label = [""] * (max([*self.ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for t, i in self.ids.items():
            self.label[i] = t
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.added.items():
            self.label[i] = t
        self.suffix = model["end_of_word_suffix"] or ""
        n = len(self.label)
        self.left, self.right, self.born = [-1] * n, [-1] * n, [0] * n  # of each arc: its parts and its merge's time
        #: (arc, arc its state lacks since this time): the copies the gadgets make.
        self.lacks: dict[int, int] = {}
        for time, (u, v) in enumerate(model["merges"], 1):
            u, v, w = self.ids[u], self.ids[v], self.ids[u + v]
            # Reading u leads to a copy without the arc v; w goes where v led.
            self.lacks[u << 20 | v] = time
            self.left[w], self.right[w], self.born[w] = u, v, time
        self.table: dict[int, bool] = {}
        self.longest = max(len(t) - (len(self.suffix) if t.endswith(self.suffix) else 0) for t in self.ids)

    def has(self, state: int, arc: int) -> bool:
        """Whether the state that the arc `state` leads to has `arc`."""
        if state == _ROOT:
            return True
        key = state << 20 | arc
        got = self.table.get(key)
        if got is None:
            u, v, until, got = state, arc, len(self.lacks) + 1, True
            born, lacks = self.born, self.lacks
            while True:
                if lacks.get(u << 20 | v, until) < until:
                    got = False
                    break
                # The younger arc did not exist before its merge: u's state was
                # then that of its right part (as it was just before), v stood
                # for its left part (up to that merge and with it).
                if not born[u] and not born[v]:
                    break
                if born[u] >= born[v]:
                    u, until = self.right[u], min(until, born[u])
                else:
                    v, until = self.left[v], min(until, born[v] + 1)
            if len(self.table) > 1_000_000:
                self.table.clear()
            self.table[key] = got
        return got

    def encode(self, word: str) -> list[int]:
        """The accepted path of a pre-split word: left to right, the longest
        arc first, one step back where no arc goes on."""
        n, ids, suffix, has = len(word), self.ids, self.suffix, self.has
        path: list[int] = []
        ends, tried, pos, state = [], [], 0, _ROOT
        dead = bytearray(n + 1)  # positions whose accepted prefix leads nowhere
        stop = min(n, self.longest)
        while pos < n:
            end = stop
            while end > pos:
                arc = ids.get(word[pos:end] + suffix if end == n else word[pos:end])
                if arc is not None and not dead[end] and (state < 0 or has(state, arc)):
                    break
                end -= 1
            if end > pos:
                path.append(arc)
                ends.append(pos)
                pos, state = end, arc
            else:
                dead[pos] = 1
                if not path:
                    raise ValueError("no path for %r" % word[:80])
                path.pop()
                pos = ends.pop()
                state = path[-1] if path else _ROOT
            stop = min(n, pos + self.longest)
        return path

    def decode(self, ids) -> list[str]:
        """The labels of the arcs."""
        label = self.label
        return [label[i] for i in ids]


class Encoder:
    """Normalising, pre-splitting and a table of words already encoded."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        self.automaton = Automaton(spec)
        self.letters = dict(enumerate(byte_letters()))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.added = regex.compile("|".join(map(regex.escape, sorted(self.automaton.added, key=len, reverse=True))) or r"(?!)")
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def word(self, word: str) -> tuple[bytes, str]:
        got = self.older.get(word)
        if got is None:
            ids = self.automaton.encode(word.encode().decode("latin-1").translate(self.letters))
            got = struct.pack("<%dI" % len(ids), *ids), " ".join(self.automaton.decode(ids))
        if len(self.known) >= WORD_TABLE:
            self.known, self.older = {}, self.known
        self.known[word] = got
        return got

    def forget(self) -> None:
        """Empties the tables, which only save time."""
        self.known, self.older = {}, {}
        self.automaton.table.clear()

    def normalise(self, text: str) -> str:
        # Lower-casing looks at single characters: no final sigma.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text)."""
        parts: list[tuple[bytes, str]] = []
        at = 0
        cuts = list(self.added.finditer(text)) if "<|" in text else []
        word = self.word
        for m in [*cuts, None]:
            piece = text[at:m.start() if m else len(text)]
            parts += [self.known.get(w) or word(w) for w in self.words.findall(self.normalise(piece))]
            if m:
                i = self.automaton.added[m[0]]
                parts.append((struct.pack("<I", i), self.automaton.label[i]))
                at = m.end()
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """One row per input row: `keep`, n_tokens, ids_sha256, decoded_sha256
    and, on request, ids (little-endian unsigned 32-bit) and decoded. `path`
    names the tokenizer file, which every executor must hold; by default the
    installed public file."""
    schema = docs.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", "binary").add("decoded", "string")

    def run(batches):
        import pyarrow as pa
        if path is None:
            import public_tokenizers
        e = encoder(path or public_tokenizers.path("word_bpe_49k.json"))
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                rows = []
                for t in part.column(part.num_columns - 1):
                    ids, text = e.encode(t.as_py() or "")
                    row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
                    rows.append(row + (ids, text) if with_ids else row)
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(part.num_columns - 1)), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    schema.names)
            give_back()
        # A task's words seldom help the next one's; the worker lives on.
        e.forget()
        give_back()

    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document's token and decoded digests under word_bpe_49k."""
    from barkeep.llm.common import table
    return encoded(table(spark, sf_dir, "documents"))
