"""Token counts: the exact token count of every prefix of a text.

For each text a table holds, character by character, how the token count of
the prefix changes.  One running sum answers "how many tokens are the first k
characters" and "how many characters fit into a budget" without encoding again.

The table is built by dynamic programming over prefixes.  The BPE encoding of a
prefix ends in exactly one token t, and what comes before t is the encoding of
the shorter prefix; t follows the last token u of that shorter prefix only if
BPE leaves the two alone, that is if the encoding of u + t is [u, t].  So
count[i] = count[i - len(t)] + 1 for the one valid t.  Words share their
prefixes, hence the states are kept by prefix.  The last count of each word is
checked against the library's own encoding.

Defined results: a NULL or empty text has no characters, 0 tokens and an empty
table.  NULL keys pass through.  Repeated rows give repeated rows.  Special
strings inside a text count as one token (the library's default); a prefix that
ends inside such a string counts as ordinary text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from vitrina.llm.pieces import ByteLevelEncoder, Generations, byte_alphabet, encode_texts, worker_encoder

SHARED = 64  # bytes; the states of longer words are not kept
_CONTINUES = frozenset(sign for byte, sign in byte_alphabet().items() if 0x80 <= byte < 0xC0)
_RUN = re.compile(r"\s*\S+|\s+")


class PrefixCounter(ByteLevelEncoder):
    """Like the encoder, but a piece's value is the change of the count at each of its characters."""

    dtype = "<i2"

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__(path, limit)
        self.vocab = self.tok.get_vocab()
        self.longest = max(map(len, self.vocab))
        self.states: dict[str, tuple[str, int]] = {}
        self.pairs = Generations(limit, weigh=lambda keys, values: 0)

    def _pairs_alone(self, pairs: list[tuple[str, str]]) -> list[bool]:
        tokenize = self.tok.model.tokenize
        return [[t.value for t in tokenize(a + b)] == [a, b] for a, b in pairs]

    def byte_counts(self, word: str) -> bytes | list[int]:
        """Token counts of all prefixes of a word in the byte alphabet (lengths 1 to all)."""
        if len(word) > SHARED:
            return self._long_counts(word)
        states = self.states
        if len(states) > 400_000:
            states.clear()
        low, high = 0, len(word)  # the longest prefix that an earlier word had
        while low < high:
            middle = (low + high + 1) // 2
            if word[:middle] in states:
                low = middle
            else:
                high = middle - 1
        last, counts = states[word[:low]] if low else ("", b"")
        vocab, alone = self.vocab, self.pairs.young
        for i in range(low + 1, len(word) + 1):
            prefix = word[:i]
            if prefix in vocab:
                last, n = prefix, 1
            else:
                # Most likely the new token starts where the last one did, or after that.
                was = max(i - 1 - len(last), 1)
                for j in chain(range(was, i), range(was - 1, 0, -1)):
                    token = word[j:i]
                    if token in vocab:
                        pair = (states[word[:j]][0], token)
                        follows = alone.get(pair)
                        if follows is None:
                            follows = self.pairs.fill((pair,), self._pairs_alone)[pair]
                            alone = self.pairs.young
                        if follows:
                            break
                else:
                    raise ValueError(f"no token of the vocabulary ends {prefix!r}: not a closed byte-level vocabulary")
                last, n = token, counts[j - 1] + 1
            counts += n.to_bytes()
            states[prefix] = (last, counts)
        if counts and counts[-1] != len(self.tok.model.tokenize(word)):  # the check against the library
            return [len(self.tok.model.tokenize(word[:i])) for i in range(1, len(word) + 1)]
        return counts

    def _long_counts(self, word: str) -> list[int]:
        """The same for one long word, with its states in a list of its own."""
        last, counts = [""], [0]
        for i in range(1, len(word) + 1):
            if i <= self.longest and word[:i] in self.vocab:
                token, j = word[:i], 0
            else:
                token, j = self._last_token(word[max(0, i - self.longest):i], lambda j: last[max(0, i - self.longest) + j])
                j += max(0, i - self.longest)
            last.append(token)
            counts.append(counts[j] + 1)
        return counts[1:]

    def _last_token(self, text: str, last_at) -> tuple[str, int]:
        """The token that ends a prefix, and where it starts: the one that BPE leaves alone
        after the last token of what is before it."""
        vocab, alone = self.vocab, self.pairs.young
        for j in range(1, len(text)):
            token = text[j:]
            if token in vocab:
                before = last_at(j)
                pair = (before, token)
                follows = alone.get(pair)
                if follows is None:
                    follows = self.pairs.fill((pair,), self._pairs_alone)[pair]
                    alone = self.pairs.young
                if follows:
                    return token, j
        raise ValueError(f"no token of the vocabulary ends {text!r}: this is not a closed byte-level BPE vocabulary")

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Changes of the count at each character of each word (UTF-8 continuation bytes
        are U+0080 to U+00BF: the count of a character is the one at its last byte)."""
        out = []
        for word in words:
            counts = self.byte_counts(word)
            if not word.isascii():
                counts = [c for c, after in zip(counts, word[1:] + "a") if after not in _CONTINUES]
            out.append(_changes(counts))
        return out

    def cut_words(self, piece: str, blank: str) -> list[str] | None:
        words = self.simple_words(piece, blank)
        if words:
            return words
        words = super().cut_words(piece, blank)
        if words is not None and ("'" in piece or re.search(r"\s\s", blank + piece)):
            return None  # a prefix may be cut into words differently: see ``whole``
        return words

    def whole(self, text: str) -> bytes:
        """Changes of the count where the words of a prefix are not a prefix of the words."""
        return _changes(self._whole_counts(text))

    def _library(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def _whole_counts(self, text: str) -> list[int]:
        found = min(((text.find(s), s) for s in self.special if s in text), default=None)
        if found:
            at, special = found
            left = self._whole_counts(text[:at])
            base = left[-1] if left else 0
            inside = [self._library(text[:at] + special[:k]) for k in range(1, len(special))]
            rest = self._whole_counts(text[at + len(special):])
            return left + inside + [base + 1] + [base + 1 + c for c in rest]
        out: list[int] = []
        for segment in _segments(text):  # each starts at a sure word boundary
            base = out[-1] if out else 0
            lead = len(segment) - len(segment.lstrip())
            words = [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(segment)]
            changes = b"".join(self._word_ids(words))
            counts = np.cumsum(np.frombuffer(changes, "<i2").astype(np.int64)).tolist()
            if lead:  # white space at the end of a prefix is one word
                space = "".join(w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(segment[:lead]))
                counts[:lead] = np.cumsum(np.frombuffer(self._word_ids([space])[0], "<i2").astype(np.int64)).tolist()
            for k in range(lead + 1, min(len(segment), lead + 4) + 1):  # a contraction may begin here
                counts[k - 1] = self._library(segment[:k])
            out += [base + c for c in counts]
        return out


def _changes(counts: list[int]) -> bytes:
    return array("h", map(sub, counts, [0, *counts[:-1]])).tobytes()


def _segments(text: str) -> list[str]:
    """White space with what follows it, cut again before an apostrophe after a letter or digit."""
    out = []
    for run in _RUN.findall(text):
        start = 0
        for k in range(1, len(run)):
            if run[k] == "'" and run[k - 1].isalnum():
                out.append(run[start:k])
                start = k
        out.append(run[start:])
    return out


def prefix_token_counts(df: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",),
                        text_col: str = "text", budgets: tuple[int, ...] = ()) -> DataFrame:
    """``keep`` columns of ``df`` with n_bytes, n_tokens, count_changes (16-bit little-endian,
    one per character) and, for each budget b, chars_in_b: the most characters a prefix of at
    most b tokens has.  A kept column named like a result is left out."""
    results = {"n_bytes", "n_tokens", "count_changes", *(f"chars_in_{b}" for b in budgets)}
    keep = tuple(c for c in keep if c.lower() not in results)
    src = df.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).cast("string").alias("__text"))
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*fields, "n_bytes bigint", "n_tokens bigint", "count_changes binary",
                        *(f"chars_in_{b} bigint" for b in budgets)])
    n_keep = len(keep)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_encoder(PrefixCounter, tokenizer_path)
        for batch in batches:
            texts = batch.column(n_keep)
            tables, totals, fits = [], [], [[] for _ in budgets]
            for changes in encode_texts(counter, texts.to_pylist()):
                counts = np.cumsum(changes, dtype=np.int64)
                tables.append(changes.tobytes())
                totals.append(int(counts[-1]) if len(counts) else 0)
                for fit, b in zip(fits, budgets):
                    inside = np.flatnonzero(counts <= b)
                    fit.append(int(inside[-1]) + 1 if len(inside) else 0)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(n_keep)), n_bytes, pa.array(totals, pa.int64()),
                 pa.array(tables, pa.binary()), *(pa.array(f, pa.int64()) for f in fits)],
                names=[*keep, "n_bytes", "n_tokens", "count_changes", *(f"chars_in_{b}" for b in budgets)])

    return src.mapInArrow(count, schema)


def tokens_of_prefix(count_changes: bytes, n_chars: int) -> int:
    """Token count of the first ``n_chars`` characters, from the table alone."""
    return int(np.frombuffer(count_changes, "<i2")[:n_chars].sum(dtype=np.int64))
