"""Byte-level BPE encoding and decoding by a depth-first walk of a trie of distinct words.

Of a string's BPE tokens, all but the last are the tokens of the string without its last one. So each trie node, which
stands for a prefix, needs one state: the last token of that prefix. It is the one token t that ends there and that the
last token u of the rest leaves alone, meaning that BPE on the bytes of u and t gives u and t again. The walk keeps the
states of the current path; words with a common prefix share its states. A word's tokens are read off backwards.
"""

from __future__ import annotations

import hashlib
import json
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, map_batches, slices, whole_text

#: Distinct chunks whose ids a worker keeps; when there are more, it starts afresh.
KEPT_CHUNKS = 600_000


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Bpe:
    """The vocabulary of a byte-level tokenizer file; every method returns what the tokenizers library would."""

    #: Fixed value: how the byte-level pre-tokenizer splits a text.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {to_bytes(t): i for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(to_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.tokens = [b""] * size
        for t, i in self.ids.items():
            self.tokens[i] = t
        for t, i in self.special.items():
            self.tokens[i] = t.encode()
        self.longest = max(map(len, self.ids))
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.split = regex.compile(self.SPLIT)
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # Where a space is followed by a character that no one takes for white space, a chunk begins: no pre-token crosses it.
        self.odd_space = regex.compile(r" (?:[\s\x1c-\x1f]|$)", regex.V0)
        self.at_chunk = regex.compile(r" (?=[^\s\x1c-\x1f])")
        self.agree: dict[tuple[int, int], bool] = {}
        self.chunks: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE: the pair of lowest rank is merged first, leftmost first."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            rank, at = min((self.merges.get(pair, (1 << 60,))[0], i) for i, pair in enumerate(zip(ids, ids[1:])))
            if rank == 1 << 60:
                break
            ids[at : at + 2] = [self.merges[ids[at], ids[at + 1]][1]]
        return ids

    def _leaves_alone(self, u: int, t: int) -> bool:
        """Whether BPE on the bytes of u and t gives u and t; u = -1 stands for nothing."""
        self.agree[u, t] = ok = self.merged((self.tokens[u] if u >= 0 else b"") + self.tokens[t]) == ([u, t] if u >= 0 else [t])
        return ok

    def encode_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """The tokens of distinct words (pre-tokens), by a depth-first walk of their trie.

        Sorted words are the trie's leaves in depth-first order: what a word shares with the one before it is the part
        of the path that stays.
        """
        ids, agree, test, longest = self.ids, self.agree, self._leaves_alone, self.longest
        last: list[int] = [-1]  # the last token of each prefix on the path
        before, out = b"", {}
        for word in sorted(words):
            n, shared, most = len(word), 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, n + 1):
                for start in range(max(0, end - longest), end):
                    t = ids.get(word[start:end])
                    if t is not None:
                        u = last[start]
                        ok = agree.get((u, t))
                        if test(u, t) if ok is None else ok:
                            last.append(t)
                            break
            before, tokens, end = word, [], n
            while end:
                tokens.append(t := last[end])
                end -= len(self.tokens[t])
            out[word] = tokens[::-1]
        return out

    def _ids(self, chunks: list[str], known: dict[str, bytes], lead: str) -> list[bytes]:
        """The ids of chunks, each with lead before it; known keeps those of distinct chunks."""
        found = list(map(known.get, chunks))
        if None in found:
            new = {c for c, x in zip(chunks, found) if x is None}
            if len(known) + len(new) > KEPT_CHUNKS:
                known.clear()
            if len(self.agree) > 2_000_000:
                self.agree.clear()
            pieces = {c: [w.encode() for w in self.split.findall(lead + c)] for c in new}
            words = self.encode_words(list({w for p in pieces.values() for w in p}))
            fresh = {c: np.array([t for w in p for t in words[w]], dtype="<u4").tobytes() for c, p in pieces.items()}
            known.update(fresh)
            found = [fresh[c] if x is None else x for c, x in zip(chunks, found)]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers; special tokens' strings count as such."""
        plan: list[list] = []  # of each text: ids of special tokens, and how many chunks follow a first one
        firsts: list[str] = []
        chunks: list[str] = []
        for text in texts:
            parts: list = []
            at = 0
            for m in self.at_special.finditer(text) if self.at_special else ():
                parts += [text[at : m.start()], self.special[m[0]].to_bytes(4, "little")]
                at = m.end()
            parts.append(text[at:])
            for k, part in enumerate(parts):
                if isinstance(part, str):
                    cut = self.at_chunk.split(part) if self.odd_space.search(part) else part.split(" ")
                    firsts.append(cut[0])
                    del cut[0]
                    chunks += cut
                    parts[k] = len(cut)
            plan.append(parts)
        first, rest = iter(self._ids(firsts, self.firsts, "")), self._ids(chunks, self.chunks, " ")
        out, at = [], 0
        for parts in plan:
            whole = []
            for part in parts:
                if isinstance(part, int):
                    whole += [next(first), *rest[at : at + part]]
                    at += part
                else:
                    whole.append(part)
            out.append(b"".join(whole))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids as encode gives them; bytes that aren't UTF-8 are replaced."""
        return self.joined(ids).decode("utf-8", "replace")

    def joined(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@cache
def bpe(path: str) -> Bpe:
    """One for each worker and file."""
    return Bpe(path)


def encoded_batches(batches, path: str):
    """For each record batch its rows a slice at a time: (batch, first row, texts as bytes, ids of each)."""
    coder = bpe(path)
    for batch in batches:
        column = batch.column("text")
        for start, stop in slices(column):
            texts = column.slice(start, stop - start).to_pylist()
            yield batch, start, texts, coder.encode([t.decode("utf-8", "replace") for t in texts])


def _coded(batches, path: str, keep_ids: bool):
    coder = bpe(path)
    for batch, start, texts, ids in encoded_batches(batches, path):
        decoded = []
        for text, x in zip(texts, ids):
            back = coder.joined(x)
            decoded.append(hashlib.sha256(back if back == text else back.decode("utf-8", "replace").encode()).hexdigest())
        columns = [batch.column("id").slice(start, len(texts)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array(decoded, pa.string())]
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            columns.append(pa.array([np.frombuffer(x, dtype="<u4").astype("i4") for x in ids], pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, keep_ids: bool = True) -> DataFrame:
    """One row per input row: id_col, n_tokens, ids_sha256, decoded_sha256 and, if keep_ids, ids (array of int).

    A null text counts as empty: no ids, and the digests of nothing. Rows are independent: repeated rows repeat, a null
    id stays null, an empty table gives none. vocabulary is a path that every executor has (the installed package's).
    """
    path = vocabulary or default_vocabulary()
    schema = f"id {id_type(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    pairs = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    return map_batches(pairs, lambda batches: _coded(batches, path, keep_ids), schema).withColumnRenamed("id", id_col)


def decode_documents(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """id_col and the text of ids_col (array of int); null ids give an empty text."""
    path = vocabulary or default_vocabulary()

    def decoded(batches):
        coder = bpe(path)
        for batch in batches:
            texts = [coder.decode(np.array(x or [], dtype="<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    pairs = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return map_batches(pairs, decoded, f"id {id_type(coded, id_col)}, text string").withColumnRenamed("id", id_col)
