"""BPE by dynamic programming over prefixes.

A merge tokenizer gives every text one encoding, and every prefix of a word has
one encoding of its own, hence one last token. Walking a word from the left, an
Aho-Corasick automaton (the suffix automaton of the vocabulary) lists the
tokens that end at each position; the prefix's last token is the one whose pair
with the last token of the prefix before it is stable, that is, the merge rules
applied to both together give the same two tokens. The ids follow from the
stored last tokens, read backwards.

``encode`` covers tokenizers of the kind of ``word_bpe_49k.json``: composed,
space-folded, lower-cased text, split by the file's pattern, byte-level symbols,
a suffix on each word's last symbol. Each process keeps the encodings of the words it
has met, in two generations of up to ``CACHE`` words of at most ``LONGEST``
characters, so memory is bounded (a longer run without white space, as in texts
written without it, is put together from its pieces each time); the results do
not depend on it.

Defined results: a null text is an empty text, with no ids and an empty decoded
text; a null id is encoded like any other; repeated rows are encoded alike;
other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.store import id_text

CACHE = 250_000
LONGEST = 64     # characters of a word or piece that is remembered
PAIRS = 200_000  # remembered pair tests
END = "\x01"  # stands for the word-end suffix; not a byte-level symbol
#: Fixed value: characters that the tokenizers library's pattern engine counts as white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(256 + extra))
        extra += b not in plain
    return out


class Encoder:
    """One tokenizer file, ready to encode words."""

    def __init__(self, path: str):
        import regex

        self.cache = CACHE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        inner = lambda t: t[:-len(self.suffix)] + END if self.suffix and t.endswith(self.suffix) else t
        self.name = {i: t for t, i in model["vocab"].items()}
        self.id = {inner(t): i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.name.update({i: t for t, i in self.added.items()})
        self.rank, self.parts = {}, {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made = self.id[a + inner(b)]
            self.rank[self.id[a], self.id[inner(b)]] = r
            self.parts.setdefault(made, (self.id[a], self.id[inner(b)], r))
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self.pairs: dict[int, bool] = {}
        self._automaton()
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.split = regex.compile(pattern.replace("\\s", WHITE))
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None
        self.symbols = byte_symbols()
        self.words: dict[str, tuple[int, str, str]] = {}   # this generation's words
        self.before: dict[str, tuple[int, str, str]] = {}  # the generation before
        self.pieces: dict[str, tuple[int, str, str]] = {}
        self.white = re.compile(f"[{WHITE}]+")

    def _automaton(self) -> None:
        """Aho-Corasick states over the tokens that the rules make out of their
        own symbols; ``ends[state]`` lists the tokens that end there, longest first."""
        whole: dict[int, bool] = {}
        for i, (a, b, _) in sorted(self.parts.items(), key=lambda x: x[1][2]):
            whole[i] = whole.get(a, True) and whole.get(b, True) and not any(
                (r := self.rank.get((x, y))) is not None and r < ux and r <= uy and (x, y) != (a, b)
                for x, ux in self._edge(a, 1) for y, uy in self._edge(b, 0))
        children: list[dict[str, int]] = [{}]
        self.ends: list[tuple] = [()]
        for t, i in self.id.items():
            if whole.get(i, True) and t != END:
                state = 0
                for c in t:
                    if c not in children[state]:
                        children[state][c] = len(children)
                        children.append({})
                        self.ends.append(())
                    state = children[state][c]
                self.ends[state] = ((len(t), i),)
        self.children, self.fail, queue = children, [0] * len(children), list(children[0].values())
        for state in queue:
            for c, nxt in children[state].items():
                back = self.fail[state]
                while back and c not in children[back]:
                    back = self.fail[back]
                self.fail[nxt] = children[back].get(c, 0)
                queue.append(nxt)
            self.ends[state] += self.ends[self.fail[state]]
        self.steps: dict[int, int] = {}

    def _step(self, key: int) -> int:
        """The state after the character ``key & 511`` in state ``key >> 9``."""
        state, c = key >> 9, chr(key & 511)
        while state and c not in self.children[state]:
            state = self.fail[state]
        got = self.steps[key] = self.children[state].get(c, 0)
        return got

    def _edge(self, i: int, side: int) -> list[tuple[int, int]]:
        """The parts that stand at one edge (0: left, 1: right) while token ``i``
        is made, each with the rank of the merge that uses it up."""
        known = (self._left, self._right)[side]
        if i not in known:
            out, used = [], 1 << 30
            while True:
                out.append((i if not out else part, used))
                here = self.parts.get(out[-1][0])
                if here is None:
                    break
                part, used = here[side], here[2]
            known[out[0][0]] = out
        return known[i]

    def stable(self, a: int, b: int) -> bool:
        """Whether the rules leave the tokens ``a`` and ``b`` side by side: no
        part at a's right edge merges with one at b's left edge before either
        is used up by its own token's merges (at the same rank, the left one
        goes first)."""
        key = a << 20 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            rank = self.rank
            got = not any((r := rank.get((x, y))) is not None and r < ux and r <= uy
                          for x, ux in self._edge(a, 1) for y, uy in self._edge(b, 0))
            self.pairs[key] = got
        return got

    def word(self, inner: str) -> list[int]:
        """Ids of one word of byte-level symbols that ends in ``END``."""
        last = [-1] * (len(inner) + 1)  # last token of each prefix; where it starts is kept beside it
        start = [0] * (len(inner) + 1)
        pairs, steps, ends, state = self.pairs, self.steps, self.ends, 0
        for end, c in enumerate(map(ord, inner), 1):
            key = state << 9 | c
            state = steps.get(key)
            if state is None:
                state = self._step(key)
            for size, token in ends[state]:
                begin = end - size
                before = last[begin]
                if begin == 0 or before >= 0 and ((ok := pairs.get(before << 20 | token)) or ok is None and self.stable(before, token)):
                    last[end], start[end] = token, begin
                    break
        out, at = [], len(inner)
        while at:
            out.append(last[at])
            at = start[at]
        return out[::-1]

    def _piece(self, piece: str) -> tuple[int, str, str]:
        """The encoding of one match of the file's pattern."""
        got = self.pieces.get(piece)
        if got is None:
            symbols = self.symbols
            plain = piece.isascii() and piece.isprintable()  # such bytes stand for themselves
            ids = self.word((piece if plain else "".join([symbols[b] for b in piece.encode("utf-8")])) + END)
            got = (len(ids), " ".join(map(str, ids)), " ".join([self.name[i] for i in ids]))
            if len(piece) <= LONGEST:
                if len(self.pieces) >= self.cache:
                    self.pieces = {}
                self.pieces[piece] = got
        return got

    def _known(self, word: str) -> tuple[int, str, str]:
        """The encoding of the text between two white spaces."""
        got = self.before.get(word)
        if got is None:
            parts = []
            for part in self.special.split(word) if self.special and "<|" in word else (word,):
                if part in self.added:
                    parts.append((1, str(self.added[part]), part))
                else:
                    part = self.normal(part)
                    if part.isalpha():  # one run of letters
                        parts.append(self._piece(part))
                    elif part[:-1].isalpha() and part[-1] in ".,;:!?|":
                        parts += (self._piece(part[:-1]), self._piece(part[-1]))
                    else:
                        parts += map(self._piece, self.split.findall(part))
            got = parts[0] if len(parts) == 1 else (
                sum(p[0] for p in parts), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts]))
        if len(word) > LONGEST:
            return got
        if len(self.words) >= self.cache:  # words not met since the last change of generation are forgotten
            self.before, self.words, self.pieces = self.words, {}, {}
        self.words[word] = got
        return got

    def normal(self, text: str) -> str:
        """Composed and lower-cased, character by character (no final sigma)."""
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def text(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by spaces, decoded text) of a whole text.
        No piece, special token or composed character crosses white space, so
        words between white spaces are encoded on their own."""
        known, make = self.words.get, self._known
        split = self.white.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        got = []
        for w in split:
            got.append(known(w) or make(w))
            known = self.words.get
        got = [g for g in got if g[0]]
        return sum([g[0] for g in got]), " ".join([g[1] for g in got]), " ".join([g[2] for g in got])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _encoded(batches, path: str | None, make, names, cache: int, release: bool = False):
    path = path or default_path()
    e = encoder(path)
    e.cache = cache
    try:
        yield from _rows(e, batches, make, names)
    finally:
        if release:
            _ENCODERS.pop(path, None)
            del e
            gc.collect()  # the tables refer to each other


def _rows(e: Encoder, batches, make, names):
    for batch in batches:
        ids, text = batch.column("doc_id"), batch.column("text")
        for a in range(0, len(batch), 256):  # a few hundred encodings at once
            rows = [make(*e.text(t.as_py())) for t in text[a:a + 256]]
            cols = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(names)]
            yield pa.RecordBatch.from_arrays([ids[a:a + 256], *cols], ["doc_id", *(n for n, _ in names)])


def encode(docs: DataFrame, path: str | None = None, cache: int = CACHE, release: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row. ``path`` names a tokenizer
    file that every executor has (by default the installed word-level one);
    ``cache`` bounds the words that a process remembers, in two generations;
    ``release`` gives the tables of a tokenizer back after each task (they take
    under a second to make, and 80 MB and the remembered words as long as the
    process lives), for jobs whose other stages need the memory."""
    names = [("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]

    def make(n, ids, names):
        return n, np.array(ids.split(), dtype=np.int32), names

    return id_text(docs).mapInArrow(lambda it: _encoded(it, path, make, names, cache, release),
                                    "doc_id long, n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None, cache: int = CACHE) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the same run, digested in
    the task so that ids and decoded texts need not leave it."""
    names = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]

    def make(n, ids, names):
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(names.encode()).hexdigest()

    return id_text(docs).mapInArrow(lambda it: _encoded(it, path, make, names, cache),
                                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
