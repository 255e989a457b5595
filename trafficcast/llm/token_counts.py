"""Token counts: how many tokens a text has, without building the tokens.

Texts reach Python in Arrow batches and are cut into slices balanced by bytes. Every text is then
split where no token can reach across: before a space or line feed that follows a character other
than white space. The pre-tokenizer of a byte-level BPE lets white space only start a token, and
its look-ahead only asks about white space, so the pieces are encoded alike alone and together.
Pieces of equal bytes are encoded once, short ones once per worker; the encoder returns lengths only. A text without such a
place stays whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import byte_class, distinct_spans, slices, text_bytes
from trafficcast.llm.common import arrow_map, documents, keyed

#: Pieces remembered by one worker, the bytes of the longest of them, and bytes handed to the encoder at once.
CACHE = 1 << 19
REMEMBERED = 64
ENCODE_BYTES = 1 << 19

_BREAK = byte_class((0x20, 0x20), (0x0A, 0x0A))
_BLANK = byte_class((0x09, 0x0D), (0x1C, 0x20))
_state: dict[str, tuple] = {}


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: at texts, and at safe boundaries within them."""
    n = len(data)
    cut = np.zeros(n, bool)
    if not n:
        return np.flatnonzero(cut)
    before = data[:-1]
    # Beyond ASCII, white space ends like C2 85, C2 A0, E1 9A 80, E2 80 xx, E2 81 9F or E3 80 80;
    # three-byte characters that begin alike are left whole as well, which is safe.
    other = np.zeros(n - 1, bool)
    if n > 2:
        other[1:] = (data[:-2] == 0xC2) & ((before[1:] == 0x85) | (before[1:] == 0xA0))
    if n > 3:
        lead, middle = data[:-3], data[1:-2]
        other[2:] |= (lead >= 0xE1) & (lead <= 0xE3) & ((middle == 0x9A) | (middle == 0x80) | (middle == 0x81))
    cut[1:] = _BREAK[data[1:]] & ~_BLANK[before] & ~other
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


def _encoder(path: str):
    if path not in _state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(path)
        encoder.no_truncation()
        encoder.no_padding()
        _state[path] = encoder, {}
    return _state[path]


def _lengths(encoder, texts: list[str]) -> list[int]:
    found, start = [], 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= ENCODE_BYTES):
            size += len(texts[stop])
            stop += 1
        found += [len(e) for e in encoder.encode_batch_fast(texts[start:stop], add_special_tokens=False)]
        start = stop
    return found


def count_slice(column: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text of one slice."""
    encoder, cache = _encoder(path)
    data, offsets = text_bytes(column)
    starts = piece_starts(data, offsets)
    if not len(starts):
        return np.zeros(len(column), np.int64)
    ends = np.append(starts[1:], len(data))
    first, back = distinct_spans(data, starts, ends)
    if len(cache) > CACHE:
        cache.clear()
    raw = data.tobytes()
    names = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    unseen = [name for name in names if name not in cache]
    new = dict(zip(unseen, _lengths(encoder, [x.decode("utf-8", "replace") for x in unseen]), strict=True))
    counts = np.array([new[x] if x in new else cache[x] for x in names], np.int64)[back]
    cache.update((x, n) for x, n in new.items() if len(x) <= REMEMBERED)
    running = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(running[np.searchsorted(starts, offsets)])


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row; no shuffle.

    `path` is a byte-level BPE file of the tokenizers library. Null and empty texts have 0 bytes and
    0 tokens; repeated rows and null keys give one row each; an empty table gives none; other
    columns are ignored. Special strings within a text count as the library counts them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column("text")
                sizes = np.diff(text_bytes(column)[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(sizes), pa.array(count_slice(column, path))],
                    names=[key, "n_bytes", "n_tokens"],
                )

    return arrow_map(keyed(docs, key, text), run, key, "n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return over_limit(token_counts(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json")), 1024)
