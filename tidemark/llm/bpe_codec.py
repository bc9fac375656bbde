"""BPE encoding and decoding by prefix-sharing trie traversal.

A word's encoding is found from its prefixes. A sequence of tokens is what the merges give if and only if every
two neighbours, merged on their own, stay the two tokens they are. So each prefix has exactly one last token: the
longest vocabulary entry that ends the prefix and can stand behind the last token of what is left when it is cut
off. The words of a batch are put into a trie; a depth-first walk gives each node its last token, and words that
share a prefix share its states. The last symbol of a word carries the end mark ``</w>`` and is an edge of its own.
A word is read off its states from the end to the front.

Whole texts: special tokens are taken out of the raw text first, as the tokenizers library does; the rest goes
through NFC, lower-casing of single characters and the vocabulary's word pattern. Decoding joins token strings
with one space, as the vocabulary file names no decoder.

Defined results: a null or empty text has no tokens and decodes to the empty text; an empty table gives no rows; repeated rows
each give a row; other columns are ignored. A text or a single word may have any length: states are kept by prefix for words of
KEEP_CHARS or less only, longer ones are walked in sorted order with one stack of states, in time and memory linear in their
length. A worker keeps about CACHE_WORDS words with their tokens, those it met last; longer words are encoded and not
kept. Neither changes a result. No shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.texts import map_batches, to_batch

CACHE_WORDS = 400_000
KEEP_CHARS = 64
CHUNK_CHARS = 2_000_000
VOCABULARY = "word_bpe_49k.json"
END = "</w>"
_SPACE = r"\t-\r\x20\x85\xa0  -     　"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (chr(256 + i) for i in range(256))
    return [chr(b) if b in plain else next(others) for b in range(256)]


class TrieEncoder:
    """Encodes sets of words of one vocabulary."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.stands: dict[tuple[str, str], bool] = {}
        self.alone: dict[str, bool | None] = dict.fromkeys(self.ids)
        #: Everything that some entry starts with; where no suffix of a prefix is among them, no entry can end.
        self.starts = {t[:i] for t in (t.removesuffix(END) for t in self.ids) for i in range(1, len(t) + 1)}
        #: Last token of a prefix, and where its longest suffix that starts an entry begins.
        self.states: dict[str, tuple[str, int]] = {}

    def symbols(self, token: str) -> list[str]:
        return [*token[: -len(END) - 1], token[-len(END) - 1 :]] if token.endswith(END) and len(token) > len(END) else list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """The merges applied one by one, lowest rank first and the leftmost of equals: defines what stands."""
        parts, known, none = list(symbols), self.ranks.get, len(self.ranks)
        ranks = [known(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = known((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = known((parts[i - 1], parts[i]), none)
        return parts

    def is_token(self, token: str) -> bool:
        """Whether a vocabulary entry is what its own merges lead to."""
        known = self.alone[token] = self.merge(self.symbols(token)) == [token]
        return known

    def can_follow(self, left: str, right: str) -> bool:
        """Whether two tokens stay as they are when their symbols are merged together."""
        if len(self.stands) > 1_000_000:
            self.stands.clear()
        known = self.stands[left, right] = self.merge(self.symbols(left) + self.symbols(right)) == [left, right]
        return known

    def last_token(self, spelt: str, stop: int, tokens: list[str], begin: int, end: str) -> str:
        """The last token of ``spelt[:stop] + end``, which begins at ``begin`` or later; ``tokens[i]`` is that of the first i symbols."""
        alone, stands = self.alone, self.stands
        for start in range(begin, stop):
            token = spelt[start:stop] + end if end else spelt[start:stop]
            known = alone.get(token, False)
            if known or (known is None and self.is_token(token)):
                if not start:
                    return token
                known = stands.get((tokens[start], token))
                if known or (known is None and self.can_follow(tokens[start], token)):
                    return token
        raise ValueError(f"no token ends {spelt[:stop][-80:]!r}")

    def next_state(self, spelt: str, stop: int, tokens: list[str], begin: int) -> tuple[str, int]:
        """The state of ``spelt[:stop]``; the longest suffix of a symbol less that starts an entry begins at ``begin``."""
        starts = self.starts
        while spelt[begin:stop] not in starts:
            begin += 1
        return self.last_token(spelt, stop, tokens, begin, ""), begin

    def state(self, prefix: str, tokens: list[str], begin: int) -> tuple[str, int]:
        """The state of a prefix of a word that may be kept."""
        if len(self.states) > CACHE_WORDS:
            self.states.clear()
        starts = self.starts
        while (token := prefix[begin:]) not in starts:
            begin += 1
        if not self.alone.get(token) or (begin and not self.stands.get((tokens[begin], token))):
            token = self.last_token(prefix, len(prefix), tokens, begin, "")
        found = self.states[prefix] = token, begin
        return found

    def read_off(self, word: str, tokens: list[str], begin: int) -> list[str]:
        """A word's tokens, from the states of its prefixes."""
        token = self.last_token(word, len(word), tokens, begin, END)
        own, at = [token], len(word) - len(token) + len(END)
        while at:
            own.append(tokens[at])
            at -= len(tokens[at])
        own.reverse()
        return own

    def encode_words(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word (in byte symbols).

        Sorted words are a trie's leaves in depth-first order: what a word shares with the one before is the path to the node
        where they part. The stack holds the states along the path, so a shared prefix is walked once.
        """
        found: dict[str, list[str]] = {}
        before, tokens, begins = "", [""], [0]
        known = self.states.get
        for word in sorted(words):
            last = len(word) - 1
            shared, most = 0, min(len(tokens) - 1, last)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del tokens[shared + 1 :], begins[shared + 1 :]
            if last < KEEP_CHARS:
                begin = begins[-1]
                for stop in range(shared + 1, last + 1):
                    state = known(word[:stop])
                    if state is None:
                        state = self.state(word[:stop], tokens, begin)
                    token, begin = state
                    tokens.append(token)
                    begins.append(begin)
            else:
                for stop in range(shared + 1, last + 1):
                    token, begin = self.next_state(word, stop, tokens, begins[-1])
                    tokens.append(token)
                    begins.append(begin)
            found[word] = self.read_off(word, tokens, begins[-1])
            before = word
        return found


class Codec:
    """Encodes and decodes texts; keeps the words it has met."""

    def __init__(self, path: str):
        self.trie = TrieEncoder(path)
        self.pattern = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
        # the same over the first 256 characters, of which most texts are made: Python's own patterns take half the time with a plain set
        letters, numbers = ("".join(re.escape(chr(i)) for i in range(256) if regex.fullmatch(kind, chr(i))) for kind in (r"\p{L}", r"\p{N}"))
        self.narrow = re.compile(rf"[{letters}]+|'(?:[stmd]|re|ve|ll)|[{numbers}]|[^{_SPACE}{letters}{numbers}]+")
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.trie.special, key=len, reverse=True))) + ")")
        self.bytes = byte_symbols()
        self.table = {i: s for i, s in enumerate(self.bytes)}
        self.ids: dict[str, bytes] = {}
        self.said: dict[str, str] = {}
        for token, number in self.trie.special.items():
            self.ids[token], self.said[token] = number.to_bytes(4, "little"), token
        self.packed = {token: number.to_bytes(4, "little") for token, number in self.trie.ids.items()}
        self.fixed = len(self.ids)
        self.older: tuple[dict[str, bytes], dict[str, str]] = {}, {}

    def words(self, text: str) -> list[str]:
        if "<|" in text and (pieces := self.special.split(text))[1:]:
            return [w for i, piece in enumerate(pieces) for w in ([piece] if i % 2 else self.plain_words(piece))]
        return self.plain_words(text)

    def plain_words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern.findall(text)
        return self.narrow.findall(text)

    def learn(self, words: set[str]) -> None:
        """Adds words that are not yet known. Of two generations of words the older goes when the younger is full; words met again move up."""
        new = words.difference(self.ids)
        if not new:
            return
        if len(self.ids) + len(new) > CACHE_WORDS // 2 and len(self.ids) > self.fixed:
            self.older = self.ids, self.said
            self.ids, self.said = ({w: known[w] for w in self.trie.special} for known in self.older)
            new = words.difference(self.ids)
        ids, said = self.older
        fresh = new.difference(ids)
        for word in new.difference(fresh):
            self.ids[word], self.said[word] = ids.pop(word), said.pop(word)
        new = fresh
        spelt = {w: w if w.isascii() and w.isalnum() else w.encode("utf-8").decode("latin-1").translate(self.table) for w in new}
        tokens = self.trie.encode_words(set(spelt.values()))
        packed = self.packed
        for word, spelling in spelt.items():
            found = tokens[spelling]
            self.ids[word] = packed[found[0]] if len(found) == 1 else b"".join([packed[t] for t in found])
            self.said[word] = " ".join(found)

    def forget_long(self, words: set[str]) -> None:
        for word in words:
            if len(word) > KEEP_CHARS and word not in self.trie.special:
                del self.ids[word], self.said[word]

    def encode(self, words: list[str]) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; the words must be known."""
        return b"".join(map(self.ids.__getitem__, words))

    def decode(self, words: list[str]) -> str:
        return " ".join(map(self.said.__getitem__, words))


def chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about CHUNK_CHARS, or one longer text."""
    run, n = [], 0
    for text in texts:
        run.append(text)
        n += len(text or "")
        if n >= CHUNK_CHARS:
            yield run
            run, n = [], 0
    if run:
        yield run


@lru_cache(2)
def shared_codec(path: str) -> Codec:
    """One codec for each Python worker: what it has learnt serves the worker's later tasks too."""
    return Codec(path)


def codec_batches(path: str, with_ids: bool = False):
    """A worker for map_batches over (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out: dict[str, list] = {name: [] for name in TYPES}
            ids_out: list[bytes] = []
            for some in chunks(texts):
                split = [codec.words(t or "") for t in some]
                distinct = set().union(*split)
                codec.learn(distinct)
                for words in split:
                    ids = codec.encode(words)
                    out["n_tokens"].append(len(ids) // 4)
                    out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(codec.decode(words).encode("utf-8", "replace")).hexdigest())
                    if with_ids:
                        ids_out.append(ids)
                codec.forget_long({w for w in distinct if len(w) > KEEP_CHARS})
            out["doc_id"] = batch.column("doc_id")
            if with_ids:
                offsets = np.cumsum([0, *(len(ids) // 4 for ids in ids_out)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids_out), "<u4").astype(np.int64))
                yield to_batch(out | {"ids": lists}, TYPES | {"ids": pa.list_(pa.int64())})
            else:
                yield to_batch(out, TYPES)

    return work


TYPES = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(documents: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each document: its number of tokens and digests of its ids and decoded text; the ids on demand."""
    given = documents.select("doc_id", "text")
    return map_batches(given, codec_batches(path or vocabulary_path(), with_ids), SCHEMA + (", ids array<long>" if with_ids else ""))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens and its decoded text, as digests."""
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
