"""Byte-level BPE with a contiguous rank array.

A text is cut into words by the tokenizer's public pattern.  A word's bytes are
held as part boundaries with the rank of each adjacent pair beside them; the
smallest rank is found by scanning, its boundary deleted, and the ranks of the
two neighbours looked up again, until no pair has a rank.

Words repeat, so each worker keeps the ids of the last ``CACHE`` words it merged.
The vocabulary file is named by the caller, read once on the driver and sent to
the tasks as a broadcast value (a few megabytes, with a checked bound).
"""

import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellshift.llm.common import small_batches

CACHE = 500_000
#: Texts are taken from a batch in runs of about so many characters, which bounds a task's memory.
RUN = 4 << 20
#: Words over so many bytes take the smallest rank from a heap; shorter ones are scanned.
LONG = 255
_NONE = 1 << 60
_LEFT = [bytes([n]) for n in range(256)]  # lengths of left parts; no token is longer


def byte_letters() -> dict[str, int]:
    """The printable letter a byte-level vocabulary writes for each byte, reversed.

    Printable Latin-1 bytes stand for themselves; the others follow from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class Vocabulary:
    """Ranks of mergeable byte strings, ids, special tokens and the word pattern of a tokenizer file."""

    def __init__(self, text: str, pattern: str):
        said = json.loads(text)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        vocab = said["model"]["vocab"]
        self.ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.pairs = {}
        for rank, merge in enumerate(said["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            # a pair is known by its joined bytes and the length of its left part
            first = raw(left)
            self.pairs[first + raw(right) + _LEFT[len(first)]] = rank
        self.bytes_of = [b""] * (1 + max(chain(vocab.values(), self.special.values())))
        for token, i in chain(self.ids.items(), ((s.encode(), i) for s, i in self.special.items())):
            self.bytes_of[i] = token
        self.words = regex.compile(pattern)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None


class _Merged(dict):
    """word -> ids, merging a word when it is first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self[word] = merge(word.encode("utf-8", "surrogatepass"), self.vocabulary)
        return found


def merge(word: bytes, vocabulary: Vocabulary) -> tuple[int, ...]:
    """The ids of one word."""
    if len(word) > LONG:
        return _merge_long(word, vocabulary)
    ids = vocabulary.ids
    look, left = vocabulary.pairs.get, _LEFT
    bounds = list(range(len(word) + 1))
    # ranks[n] is that of the pair of parts beginning at bounds[n]
    one = left[1]
    ranks = [look(word[n : n + 2] + one, _NONE) for n in range(len(word) - 1)]
    while ranks:
        least = min(ranks)
        if least == _NONE:
            break
        at = ranks.index(least)
        del bounds[at + 1]
        del ranks[at]
        a, b = bounds[at], bounds[at + 1]
        if at < len(ranks):
            ranks[at] = look(word[a : bounds[at + 2]] + left[b - a], _NONE)
        if at:
            z = bounds[at - 1]
            ranks[at - 1] = look(word[z:b] + left[a - z], _NONE)
    return tuple([ids[word[a:b]] for a, b in zip(bounds, bounds[1:], strict=False)])


def _merge_long(word: bytes, vocabulary: Vocabulary) -> tuple[int, ...]:
    """The same for a long word: the smallest rank comes from a heap, not from a scan."""
    ids, look, left = vocabulary.ids, vocabulary.pairs.get, _LEFT
    size = len(word)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))

    def rank(a: int) -> int:
        b = after[a]
        if b >= size or b - a >= len(left):
            return _NONE
        return look(word[a : after[b]] + left[b - a], _NONE)

    heap = [(r, a) for a in range(size) if (r := rank(a)) != _NONE]
    heapq.heapify(heap)
    gone = bytearray(size)
    while heap:
        r, a = heapq.heappop(heap)
        if gone[a] or rank(a) != r:
            continue  # one of the two parts has grown since
        b = after[a]
        gone[b] = 1
        after[a] = after[b]
        if after[b] < size:
            before[after[b]] = a
        for start in (a, before[a]):
            if start >= 0 and (now := rank(start)) != _NONE:
                heapq.heappush(heap, (now, start))
    found, a = [], 0
    while a < size:
        found.append(ids[word[a : after[a]]])
        a = after[a]
    return tuple(found)


def encode_text(text: str, merged: _Merged) -> list[int]:
    vocabulary = merged.vocabulary
    parts = vocabulary.cut.split(text) if vocabulary.cut else [text]
    found: list[int] = []
    for part in parts:
        if part in vocabulary.special:
            found.append(vocabulary.special[part])
        elif part:
            found.extend(chain.from_iterable(map(merged.__getitem__, vocabulary.words.findall(part))))
    if len(merged) > CACHE:
        merged.clear()
    return found


_loaded: dict[tuple[str, int], tuple[Vocabulary, _Merged]] = {}


def _tokenizer(text: str, pattern: str) -> tuple[Vocabulary, _Merged]:
    """The vocabulary of this worker, built once for all its tasks."""
    key = (pattern, hash(text))
    if key not in _loaded:
        vocabulary = Vocabulary(text, pattern)
        _loaded.clear()
        _loaded[key] = (vocabulary, _Merged(vocabulary))
    return _loaded[key]


def _file(spark, path: str):
    """The vocabulary file as a broadcast value; a file of a few megabytes, refused beyond 64."""
    with open(path, encoding="utf-8") as f:
        text = f.read(1 << 26)
        if f.read(1):
            raise ValueError("a vocabulary file has 64 MB at most")
    return spark.sparkContext.broadcast(text)


def text_of(ids: list[int], table: list[bytes]) -> str:
    """The text of ``ids``; invalid UTF-8 becomes replacement characters, unknown ids are left out."""
    try:
        joined = b"".join(map(table.__getitem__, ids))
    except IndexError:
        last = len(table)
        joined = b"".join(table[i] for i in ids if 0 <= i < last)
    return joined.decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str, pattern: str, back: bool = False) -> DataFrame:
    """doc_id, ids for every row of ``docs`` (doc_id, text; others are not read).

    With ``back`` also decoded, the text decoded from ids, in the same pass: one
    worker a task holds the vocabulary, and ids do not travel to a second one.

    Special tokens of the file are recognised in texts.  A null text is empty and
    has no ids.  Repeated rows return a row each; an empty table returns none.
    Texts of any length are taken whole.
    """
    small_batches(docs.sparkSession)
    sent = _file(docs.sparkSession, path)
    columns = docs.select("doc_id", "text")
    id_type = columns.schema["doc_id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, merged = _tokenizer(sent.value, pattern)
        table = vocabulary.bytes_of

        def batch(keys: pa.Array, lists: list[np.ndarray]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            columns = {"doc_id": keys, "ids": ids}
            if back:
                columns["decoded"] = pa.array([text_of(i.tolist(), table) for i in lists], pa.string())
            return pa.RecordBatch.from_pydict(columns)

        for rows in batches:
            texts, lists, begin, held = rows.column("text"), [], 0, 0
            for n in range(len(texts)):
                text = texts[n].as_py() or ""
                lists.append(np.array(encode_text(text, merged), dtype=np.int32))
                held += len(text)
                if held >= RUN:
                    yield batch(rows.column("doc_id").slice(begin, n + 1 - begin), lists)
                    begin, held, lists = n + 1, 0, []
            if lists:
                yield batch(rows.column("doc_id").slice(begin), lists)

    shape = f"doc_id {id_type.simpleString()}, ids array<int>" + ", decoded string" * back
    return columns.mapInArrow(encode, shape)


def decoded(tokens: DataFrame, path: str, pattern: str, name: str = "decoded") -> DataFrame:
    """Add the text of ``ids`` to ``tokens``; invalid UTF-8 becomes replacement characters.

    Null ids have a null text; an id outside the vocabulary is left out.
    """
    small_batches(tokens.sparkSession)
    sent = _file(tokens.sparkSession, path)

    @F.pandas_udf("string")
    def decode(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _tokenizer(sent.value, pattern)[0].bytes_of
        for batch in lists:
            yield pd.Series([None if i is None else text_of(i.tolist(), table) for i in batch], dtype=object)

    return tokens.withColumn(name, decode("ids"))
