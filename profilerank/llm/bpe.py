"""Byte-pair encoding and decoding with a given vocabulary.

A word is a doubly linked list of symbols. A priority queue holds the rank of every neighbouring pair that the
merge table knows; the lowest rank, leftmost first, is merged next, and entries whose pair has changed since are
skipped. Decoding concatenates the vocabulary's byte strings. Words repeat, so a worker keeps the ids of the words
it has met lately, from one task to the next.

Nulls and empty texts have no tokens. Texts of any length are encoded whole: the cost is n log n in the longest word.
Repeated rows get equal results, an empty table gives none, and other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import chain
from operator import itemgetter

import regex
from pyspark.sql import DataFrame

from .common import fields, map_texts

#: The pattern that splits a text before the merges.
WORDS = r" ?\p{L}++|'(?:[stmd]|re|ve|ll)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"

#: Words in each half of what a task remembers, and the longest it remembers.
CACHE_WORDS, CACHE_CHARS = 200_000, 64

#: The ids of a word, and the same as decimal numbers joined by commas.
Entry = tuple[tuple[int, ...], str]
_IDS, _JOINED = itemgetter(0), itemgetter(1)


class _Recent:
    """Ids of words met lately: when the younger half is full it becomes the older one, and what is met again moves up."""

    def __init__(self):
        self.now: dict[str, Entry] = {}
        self.before: dict[str, Entry] = {}

    def find(self, word: str) -> Entry | None:
        entry = self.now.get(word)
        if entry is None:
            entry = self.before.get(word)
            if entry is not None:
                self.keep(word, entry)
        return entry

    def keep(self, word: str, entry: Entry) -> None:
        if len(word) <= CACHE_CHARS:
            if len(self.now) >= CACHE_WORDS:
                self.before = dict(self.now)
                self.now.clear()
            self.now[word] = entry


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes are themselves, others follow from 256 up."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class BytePairCoder:
    """Encoder and decoder of one vocabulary (the text of a tokenizer file of kind byte-level BPE)."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.first = [vocab.get(c) for c in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[left] << 24 | vocab[right], rank)
            self.merged.append(vocab[left + right])
        added = {t["content"]: t for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added.values()):
            raise ValueError("added tokens that take neighbouring white space are not supported")
        self.added = {c: t["id"] for c, t in added.items()}
        self.strings: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            self.strings[i] = bytes(map(byte_of.__getitem__, token))
        for content, i in self.added.items():
            self.strings[i] = content.encode()
        self.numbers = [str(i) for i in range(len(self.strings))]
        self.words = regex.compile(WORDS)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.known = _Recent()

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(_IDS, self.entries(text))))

    def entries(self, text: str) -> list[Entry]:
        """The words and added tokens of a text, one after another, as ids."""
        if self.split is None or not self.split.search(text):
            return self._plain(text)
        out: list[Entry] = []
        for piece in self.split.split(text):
            out += [self._entry((self.added[piece],))] if piece in self.added else self._plain(piece)
        return out

    def _entry(self, ids: tuple[int, ...]) -> Entry:
        return ids, ",".join(map(self.numbers.__getitem__, ids))

    def _plain(self, text: str) -> list[Entry]:
        words, known = self.words.findall(text), self.known
        found = list(map(known.now.get, words))
        if None in found:
            for i, entry in enumerate(found):
                if entry is None:
                    entry = known.find(words[i])
                    if entry is None:
                        entry = self._entry(self._merge(words[i].encode()))
                        known.keep(words[i], entry)
                    found[i] = entry
        return found

    def _merge(self, word: bytes) -> tuple[int, ...]:
        rank_of, merged_of, push, pop = self.ranks.get, self.merged, heapq.heappush, heapq.heappop
        symbols = list(map(self.first.__getitem__, word))
        size = len(symbols)
        # A pair is two ids in one number. now: the rank of the pair that starts at each place, -1 if there is none.
        now = [rank_of(a << 24 | b, -1) for a, b in zip(symbols, symbols[1:])]
        now.append(-1)
        # A queue entry is the rank, then the place.
        queue = [rank << 32 | i for i, rank in enumerate(now) if rank >= 0]
        heapq.heapify(queue)
        after, before = list(range(1, size + 1)), list(range(-1, size))
        while queue:
            entry = pop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if now[i] != rank:
                continue  # stale: one of the two symbols has been merged since
            merged = symbols[i] = merged_of[rank]
            j = after[i]
            k = after[i] = after[j]
            symbols[j] = now[j] = -1
            if k < size:
                before[k] = i
                rank = now[i] = rank_of(merged << 24 | symbols[k], -1)
                if rank >= 0:
                    push(queue, rank << 32 | i)
            else:
                now[i] = -1
            h = before[i]
            if h >= 0:
                rank = now[h] = rank_of(symbols[h] << 24 | merged, -1)
                if rank >= 0:
                    push(queue, rank << 32 | h)
        return tuple([s for s in symbols if s >= 0])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def _shared(docs: DataFrame, tokenizer: str):
    """The tokenizer file (one to two MB, whatever the corpus) read once and sent to the executors."""
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    if len(definition) > 64 << 20:
        raise ValueError("the vocabulary is too large to be sent to the executors")
    return docs.sparkSession.sparkContext.broadcast(definition)


def _coder(shared) -> BytePairCoder:
    """The worker's coder for this vocabulary, kept beside the broadcast it is made from, with the words it has met."""
    if not hasattr(shared, "coder"):
        shared.coder = BytePairCoder(shared.value)
    return shared.coder


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids array<int>) of every whole text. Null texts have no tokens; repeated rows and ids are rows of their own."""
    shared = _shared(docs, tokenizer)

    def setup():
        coder = _coder(shared)
        return lambda texts: [[coder.encode((t or b"").decode("utf-8", "replace")) for t in texts]]

    return map_texts(docs, id_col, text_col, setup, fields("token_ids array<int>"))


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, text) of every list of token ids; null lists are empty texts, repeated rows are rows of their own."""
    import pyarrow as pa
    from pyspark.sql import functions as F, types as T

    shared = _shared(encoded, tokenizer)
    source = encoded.select(F.col(f"`{id_col}`").alias("c0"), F.col(f"`{ids_col}`").cast("array<int>").alias("c1"))
    schema = T.StructType([T.StructField(id_col, source.schema["c0"].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        coder = _coder(shared)
        for batch in batches:
            texts = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.names)

    return source.mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and decoded again from its ids.

    Null is the empty text; repeated rows and ids are rows of their own.
    One pass without a shuffle; the ids themselves, several times the size of a text, do not leave the task.
    """
    shared = _shared(docs, tokenizer)

    def setup():
        coder = _coder(shared)

        def work(texts):
            counts, id_digests, text_digests = [], [], []
            for text in texts:
                entries = coder.entries((text or b"").decode("utf-8", "replace"))
                ids = list(chain.from_iterable(map(_IDS, entries)))
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(",".join(map(_JOINED, entries)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            return counts, id_digests, text_digests

        return work

    return map_texts(docs, id_col, text_col, setup, fields("n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
