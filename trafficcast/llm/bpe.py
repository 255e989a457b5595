"""BPE encoding and decoding by speculation and verification.

A word is first cut greedily into the longest vocabulary entries. That guess is the true BPE
result exactly if every adjacent pair of tokens is compatible: no merge across their border would
have fired while both border parts existed. The parts that exist at a border are known: the right
edge of the left token and the left edge of the right token, undone merge by merge in reverse. All
pairs of all new words are tested together in numpy; words with a failing pair are merged exactly.

The file format is that of the tokenizers library for word-level BPE with a word-end suffix: NFC,
white space dropped, lower case, bytes written as printable characters. Runs between ASCII white
space are handled alone, as neither normalisation nor words reach across it.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import SPACE, distinct_spans, pick, slices, spans, text_bytes
from trafficcast.llm.common import arrow_map, documents, keyed

#: Ids of remembered runs kept by one worker.
CACHE_IDS = 2 << 20
_NEVER = np.int64(1) << 40
_loaded: dict[str, Vocabulary] = {}

# Unicode White_Space.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _char_class(prefix: str) -> str:
    """All code points of a general category, as ranges of a character class."""
    parts, begin = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code)).startswith(prefix)
        if inside and begin is None:
            begin = code
        elif not inside and begin is not None:
            parts.append(f"\\U{begin:08x}-\\U{code - 1:08x}")
            begin = None
    return "".join(parts)


def byte_characters() -> list[str]:
    """The printable character of each byte: itself, or the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the edges of every token, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.size = max([*self.ids.values(), *self.special.values()]) + 1
        self.names = [""] * self.size
        for name, number in {**self.ids, **self.special}.items():
            self.names[number] = name
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.ids[left], self.ids[right]] = rank, self.ids[left + right]
        self._edges()
        keys = np.array([a * self.size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.letters = byte_characters()
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        letter, number = _char_class("L"), _char_class("N")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{_WHITE}{letter}{number}]+")
        self.white = re.compile(f"[{_WHITE}]+")
        shown = [" " + name for name in self.names]
        raw = [name.encode() for name in shown]
        self.shown_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.shown_length = np.array([len(x) for x in raw], np.int64)
        self.shown_start = np.cumsum(self.shown_length) - self.shown_length
        self.cache: dict[bytes, int] = {}
        self._reset()

    def _edges(self) -> None:
        """How each token comes about, and which tokens greedy matching may propose."""
        self.formed = np.full(self.size, -1, np.int64)
        self.left = np.arange(self.size)
        self.right = np.arange(self.size)
        final = {number for name, number in self.ids.items() if name.endswith(self.end) and len(name) == len(self.end) + 1}
        self.open: dict[str, int] = {name: n for name, n in self.ids.items() if len(name) == 1}
        self.closed: dict[str, int] = {self._bare(n): n for n in final}
        for (a, b), (rank, made) in self.merges.items():
            if b in final:
                final.add(made)
        for (a, b), (rank, made) in self.merges.items():
            symbols = self._symbols(made, made in final)
            ids, last = self._merge(symbols)
            if ids == [made]:
                self.formed[made], self.left[made], self.right[made] = last
                if made in final:
                    self.closed[self._bare(made)] = made
                else:
                    self.open[self.names[made]] = made
        self.most_open = max(map(len, self.open))
        self.most_closed = max(map(len, self.closed))

    def _bare(self, number: int) -> str:
        return self.names[number][: -len(self.end)]

    def _symbols(self, number: int, final: bool) -> list[int]:
        name = self._bare(number) if final else self.names[number]
        return self.symbols(name) if final else [self.ids[c] for c in name]

    def symbols(self, word: str) -> list[int]:
        return [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + self.end]]

    def _merge(self, symbols: list[int]) -> tuple[list[int], tuple[int, int, int]]:
        """Exact merging, lowest rank and leftmost first; also the last merge that fired."""
        ids = list(symbols)
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        merges, last = self.merges, (-1, -1, -1)
        queue = []
        for i in range(len(ids) - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            rank, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            last = rank, a, b
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if found := merges.get((made, ids[after[i]])):
                    heapq.heappush(queue, (found[0], i, made, ids[after[i]], found[1]))
            if before[i] >= 0:
                h = before[i]
                if found := merges.get((ids[h], made)):
                    heapq.heappush(queue, (found[0], h, ids[h], made, found[1]))
        return [x for x in ids if x >= 0], last

    def exact(self, word: str) -> list[int]:
        return self._merge(self.symbols(word))[0]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match."""
        found, i, n = [], 0, len(word)
        opened, closed = self.open, self.closed
        while True:
            rest = n - i
            if rest <= self.most_closed and (token := closed.get(word[i:])) is not None:
                found.append(token)
                return found
            for size in range(min(self.most_open, rest - 1), 0, -1):
                if (token := opened.get(word[i : i + size])) is not None:
                    break
            found.append(token)
            i += size

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves the border between tokens a and b alone, for all pairs at once.

        Each side's border part lasts until the merge that absorbs it; the part formed later is
        undone first. A merge across the border wins if it comes before both absorptions; of two
        merges of one rank the left one fires first.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        until_a = np.full(len(a), _NEVER)
        until_b = np.full(len(a), _NEVER)
        a, b = a.copy(), b.copy()
        while len(live):
            rank = self._ranks(a, b)
            wins = (rank < until_a) & (rank <= until_b) & (rank < _NEVER)
            good[live[wins]] = False
            made_a, made_b = self.formed[a], self.formed[b]
            stay = ~wins & ((made_a >= 0) | (made_b >= 0))
            live, a, b, until_a, until_b = live[stay], a[stay], b[stay], until_a[stay], until_b[stay]
            made_a, made_b = made_a[stay], made_b[stay]
            undo_a = made_a > made_b
            until_a = np.where(undo_a, made_a, until_a)
            until_b = np.where(undo_a, until_b, made_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of normalised words, written with the printable characters of their bytes."""
        guesses = [self.propose(w) for w in words]
        sizes = np.array([len(g) for g in guesses], np.int64)
        flat = np.array([t for g in guesses for t in g], np.int64)
        if len(flat) < 2:
            return guesses
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[back]
        for i in np.unique(owner[inner[~good]]).tolist():
            guesses[i] = self.exact(words[i])
        return guesses

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, content) of a text: special strings as they stand, words normalised."""
        at = 0
        for found in self.cut.finditer(text) if self.cut and any(s in text for s in self.special) else ():
            yield from ((False, w) for w in self.split(text[at : found.start()]))
            yield True, found.group()
            at = found.end()
        yield from ((False, w) for w in self.split(text[at:]))

    def split(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = self.white.sub(" ", text)
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return self.words.findall(text)

    def _reset(self) -> None:
        self.cache.clear()
        #: By word, and by special string as a tuple of one.
        self.known_words: dict[str | tuple[str], list[int]] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.run_start: list[int] = []
        self.run_length: list[int] = []

    def learn(self, names: list[bytes]) -> None:
        """Encodes unseen runs and remembers their ids."""
        texts = [x.decode("utf-8", "replace") for x in names]
        together = "\n".join(texts)
        if any(s in together for s in self.special):
            parts = [[(w,) if special else w for special, w in self.pieces(t)] for t in texts]
        else:
            # A run has no ASCII white space, so an ASCII one only has to be lower-cased.
            words = self.words.findall
            parts = [words(t.lower()) if t.isascii() else self.split(t) for t in texts]
        letters, known = self.letters, self.known_words
        new = {w for part in parts for w in part if w not in known}
        marks = [w for w in new if isinstance(w, tuple)]
        known.update((w, [self.special[w[0]]]) for w in marks)
        words = list(new.difference(marks))
        shown = [w if w.isascii() and w.isprintable() else "".join(letters[x] for x in w.encode("utf-8", "replace")) for w in words]
        known.update(zip(words, self.encode_words(shown), strict=True))
        ids: list[int] = []
        at = len(self.run_start)
        for part in parts:
            before = len(ids)
            for w in part:
                ids += known[w]
            self.run_start.append(self.used + before)
            self.run_length.append(len(ids) - before)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.cache.update(zip(names, range(at, at + len(names)), strict=True))


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode_slice(column: pa.Array, vocab: Vocabulary) -> pa.Array:
    """Ids of each text of one slice, as a list column."""
    data, offsets = text_bytes(column)
    starts, ends, owner = spans(~SPACE[data], offsets)
    if vocab.used > CACHE_IDS:
        vocab._reset()
    first, back = distinct_spans(data, starts, ends)
    raw, cache = data.tobytes(), vocab.cache
    names = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    vocab.learn([name for name in names if name not in cache])
    runs = np.array([cache[name] for name in names], np.int64)
    lengths = np.array(vocab.run_length, np.int64)[runs][back]
    ids = pick(vocab.flat, np.array(vocab.run_start, np.int64)[runs][back], lengths)
    running = np.concatenate([[0], np.cumsum(lengths)])
    where = running[np.searchsorted(owner, np.arange(len(column) + 1))]
    return pa.ListArray.from_arrays(pa.array(where.astype(np.int32)), pa.array(ids.astype(np.int32)))


def decode_slice(lists: pa.ListArray, vocab: Vocabulary) -> pa.Array:
    """The tokens of each list with one space between, which is how a file without decoder decodes."""
    where = lists.offsets.to_numpy().astype(np.int64)
    ids = lists.values.to_numpy()[where[0] : where[-1]]
    where = where - where[0]
    starts, lengths = vocab.shown_start[ids], vocab.shown_length[ids]
    first = where[:-1][np.diff(where) > 0]
    starts[first] += 1
    lengths[first] -= 1
    data = pick(vocab.shown_bytes, starts, lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)])[where]
    return pa.Array.from_buffers(
        pa.large_string(), len(lists), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.string())


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, n_tokens, decoded) of every row; no shuffle.

    Null, empty and white-space-only texts have no ids and decode to the empty text; repeated rows
    and null keys give one row each; an empty table gives none; other columns are ignored; a run
    without white space of any length is encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = encode_slice(part.column("text"), vocab)
                counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), ids, pa.array(counts), decode_slice(ids, vocab)],
                    names=[key, "ids", "n_tokens", "decoded"],
                )

    return arrow_map(keyed(docs, key, text), run, key, "ids array<int>, n_tokens long, decoded string")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, decoded) of ids alone; null and empty lists decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            lists = batch.column("ids").cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), decode_slice(lists, vocab)], names=[key, "decoded"])

    plain = encoded.select(encoded[key].alias("key"), F.coalesce(encoded[ids], F.array().cast("array<int>")).alias("ids"))
    return arrow_map(plain, run, key, "decoded string")


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256)."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        key,
        "n_tokens",
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return digests(encode_decode(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json")))
