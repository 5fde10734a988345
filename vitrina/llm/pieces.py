"""Tokenizer access with bounded caches of encoded pieces.

A BPE tokenizer splits a text at word boundaries before it merges characters,
so the ids of a text are the ids of its words one after the other.  Texts are
cut into *pieces* only where such a boundary is certain: at a single blank
between two characters that are not white space.  The distinct pieces of a run
of texts are found by Arrow's dictionary encoding; each is tokenized once while
it stays in the cache, by the ``tokenizers`` library (its normalizer, its
pre-tokenizer and its BPE model); the ids of the texts are then gathered with
numpy.  Special strings hold no blank, so they stay inside one piece, and such
a piece is encoded by the library whole, which gives them its default meaning.

Caches belong to a Python worker, which holds one encoder at a time.  Each cache has two
generations of at most ``GENERATION`` entries and about ``GENERATION_BYTES``; the older is let go
when the younger is full, so memory is bounded however many words the corpus has and however
long they are.  Caches do not know their encoder, so dropping an encoder frees them at once.
"""

from __future__ import annotations

import gc
import re
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GENERATION = 350_000
GENERATION_BYTES = 40_000_000
ENTRY = 180  # bytes of a key and a value without their contents, and their place
_BLANK = re.compile(r"(?<=\S) (?=\S)")
# Letters, then punctuation (no apostrophe: contractions have rules of their own), perhaps a
# line break and the same again: each group is a word of a GPT-2 style pre-tokenizer.
_LATIN, _PUNCT = "A-Za-zÀ-ÖØ-öø-ÿ", "!-&(-/:-@\\[-`{-~"
RUN_CHARS = 6_000_000  # characters that are cut into pieces at once
TOGETHER = 64  # pieces that one call of the library normalizes and cuts
_GAP = re.compile(r"\s")
_SIMPLE = re.compile(f"([{_LATIN}]+)([{_PUNCT}]*)(?:(\n)([{_LATIN}]+)([{_PUNCT}]*))?")
_PLAIN = f"^(?P<a>[{_LATIN}]+)(?P<b>[{_PUNCT}]*)(?:(?P<c>\n)(?P<d>[{_LATIN}]+)(?P<e>[{_PUNCT}]*))?$"  # the same for Arrow


def byte_alphabet() -> dict[int, str]:
    """The sign of each byte in a byte-level vocabulary: printable Latin-1 bytes stand for
    themselves, the others for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(own))
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


_ALPHABET = byte_alphabet()


class Generations:
    """A dict of bounded size: ``fill`` computes missing values, many at a time.  ``weigh`` gives the
    bytes of keys and values beyond ``ENTRY`` each."""

    def __init__(self, limit: int = GENERATION, max_bytes: int = GENERATION_BYTES, weigh=None):
        self.limit, self.max_bytes = limit, max_bytes
        self.weigh = weigh or (lambda keys, values: sum(map(len, keys)) + sum(map(len, values)))
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def fill(self, keys, compute) -> dict:
        """A dict that holds the values of all ``keys``; ``compute`` gives those of a list of them."""
        young = self.young
        missing = [k for k in keys if k not in young]
        if young and (len(young) + len(missing) > self.limit or self.size > self.max_bytes):
            self.old, self.young, young, self.size = young, {}, {}, 0
            missing = list(keys)
            self.young = young
        if missing:
            old = self.old
            again = [k for k in missing if k in old] if old else ()
            if again:
                young.update(zip(again, map(old.__getitem__, again)))
                missing = [k for k in missing if k not in old]
                self.size += ENTRY * len(again) + self.weigh(again, [old[k] for k in again])
            if missing:
                values = compute(missing)
                young.update(zip(missing, values))
                self.size += ENTRY * len(missing) + self.weigh(missing, values)
        return young


def strings(values: pa.Array) -> list[str]:
    """The Python strings of an array without NULLs, made in one call and not one scalar after the other."""
    return values.to_numpy(zero_copy_only=False).tolist()


def cut_texts(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct pieces, place of each piece of all texts among them, offsets of the texts): texts cut at
    each blank between two characters that are not white space.  An empty text is one empty piece."""
    arr = pc.split_pattern(pa.array(texts, pa.large_string()), pattern=" ")
    offsets = arr.offsets.to_numpy().astype(np.int64)
    coded = arr.flatten().dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    same = pc.equal(pc.utf8_trim_whitespace(coded.dictionary), coded.dictionary)
    odd = ~pc.and_(same, pc.not_equal(coded.dictionary, "")).to_numpy(zero_copy_only=False)
    uniques = strings(coded.dictionary)
    if odd.any():  # white space beside the blank: cut these texts with care
        rows = np.unique(np.searchsorted(offsets, np.flatnonzero(odd[index]), side="right") - 1)
        again = set(rows.tolist())
        pieces = [_BLANK.split(t) if k in again else t.split(" ") for k, t in enumerate(texts)]
        place: dict[str, int] = {}
        index = np.fromiter((place.setdefault(p, len(place)) for ps in pieces for p in ps), np.int64,
                            sum(map(len, pieces)))
        uniques = list(place)
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    return uniques, index, offsets


def load_tokenizer(path: str):
    """The tokenizer of a .json file, with truncation and padding off."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class _Encoder:
    """Shared part: ids of distinct pieces, and the gathering of texts from them.

    The tokenizers library's pre-tokenizer gives a piece's words, its BPE model
    each word's ids; words have a cache of their own, because "word" and
    "word," share one.
    """

    special: list[str]

    def __init__(self, path: str, limit: int = GENERATION):
        self.tok = load_tokenizer(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.words = Generations(limit)

    def _word_ids(self, words: list[str]) -> list[bytes]:
        tokenize = self.tok.model.tokenize
        return [array("I", [t.id for t in tokenize(w)]).tobytes() for w in words]

    def _plain_ids(self, words: list[str]) -> list[bytes]:
        """Values of words as they are in a text, perhaps with the blank before them."""
        return self._word_ids([w if w.isascii() and w[0] > " " else "Ġ" + w[1:] if w[0] == " " and w.isascii()
                               else w.encode().decode("latin-1").translate(_ALPHABET) for w in words])

    def _plain_values(self, pieces: list[str], pattern: str, blank: str = "", lower: bool = False) -> np.ndarray:
        """Values of the pieces that match ``pattern``, whose groups are their words; None: the piece does not.
        Arrow cuts them; Python meets each distinct word once.

        The cache holds these words as they are and others in the byte alphabet: no two of them are alike but
        different words, since plain ones beyond ASCII hold letters alone, the alphabet's a byte after each."""
        found = pc.extract_regex(pa.array(pieces, pa.large_string()), pattern)
        out = np.full(len(pieces), None, object)
        values = None
        for k, part in enumerate(found.drop_null().flatten()):
            if lower:
                part = pc.utf8_lower(part)
            some = np.flatnonzero(pc.not_equal(part, "").to_numpy(zero_copy_only=False))
            if k:
                part = part.take(pa.array(some))
            elif blank:
                part = pc.binary_join_element_wise(pa.scalar(blank, pa.large_string()), part, pa.scalar("", pa.large_string()))
            coded = part.dictionary_encode()
            words = strings(coded.dictionary)
            get = self.words.fill(words, self._plain_ids).__getitem__
            given = np.fromiter(map(get, words), object, len(words))[coded.indices.to_numpy()]
            if k:
                values[some] += given
            else:
                values = given
        out[found.is_valid().to_numpy(zero_copy_only=False)] = values
        return out

    def whole(self, text: str) -> bytes:
        """The library's ids of one text, in one call."""
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def _gather(self, index: np.ndarray, offsets: np.ndarray, values: list[bytes], dtype: str):
        """Texts from pieces: (all elements of all texts, offsets of the texts)."""
        width = np.dtype(dtype).itemsize
        flat = np.frombuffer(b"".join(values), dtype=dtype)
        lens = np.fromiter(map(len, values), np.int64, len(values)) // width
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(lens) else lens
        n = lens[index]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        place = np.int32 if max(total, len(flat)) < 2**31 else np.int64
        take = np.repeat((starts[index] - (ends - n)).astype(place), n)
        take += np.arange(total, dtype=place)
        bounds = np.concatenate([[0], ends])[offsets]
        return flat[take], bounds


class ByteLevelEncoder(_Encoder):
    """Values of whole texts under a byte-level tokenizer (no normalizer, no prefix space).

    ``encode`` gives ids.  A subclass may keep another value for each piece by
    overriding ``_piece_values`` and ``dtype``.
    """

    dtype = "<u4"

    def __init__(self, path: str, limit: int = GENERATION):
        super().__init__(path, limit)
        self.heads = Generations(10_000, GENERATION_BYTES // 8)
        self.cache = Generations(limit, GENERATION_BYTES // 2)

    def _piece_values(self, pieces: list[str], blank: str) -> list[bytes]:
        """Values of pieces, each with ``blank`` before it: those of their words, which the cache keeps;
        pieces that are not plain words are kept themselves."""
        values = self._plain_values(pieces, _PLAIN, blank)
        rest = [k for k, v in enumerate(values) if v is None]
        if rest:
            odd = [pieces[k] for k in rest]
            kept = (self.cache if blank else self.heads).fill(odd, lambda ps: self._odd_values(ps, blank))
            for k, p in zip(rest, odd):
                values[k] = kept[p]
        return values.tolist()

    def _odd_values(self, pieces: list[str], blank: str) -> list[bytes]:
        """Values of pieces that are not plain words, from the library's pre-tokenizer."""
        cut = [self.cut_words(p, blank) for p in pieces]
        get = self.words.fill({w for ws in cut if ws for w in ws}, self._word_ids).__getitem__
        return [b"".join(map(get, ws)) if ws is not None else self.whole(blank + p) for p, ws in zip(pieces, cut)]

    def simple_words(self, piece: str, blank: str) -> list[str] | None:
        """The same for letters and punctuation; None: the piece is of another kind."""
        m = _SIMPLE.fullmatch(piece)
        if not m:
            return None
        first, marks, line, second, more = m.groups()
        words = [first, marks] if marks else [first]
        if not piece.isascii():
            words[0] = first.encode().decode("latin-1").translate(_ALPHABET)
        if blank:
            words[0] = "Ġ" + words[0]
        if line:
            words += ["Ċ", second if second.isascii() else second.encode().decode("latin-1").translate(_ALPHABET)]
            if more:
                words.append(more)
        return words

    def cut_words(self, piece: str, blank: str) -> list[str] | None:
        """The pre-tokenizer's words of a piece in the byte alphabet; None: it holds a special string."""
        words = self.simple_words(piece, blank)
        if words:
            return words
        if "<" in piece and self.has_special(piece):
            return None
        return [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(blank + piece)]

    def run(self, texts: list[str]):
        """(all values, offsets) of a run of texts."""
        uniques, index, offsets = cut_texts(texts)
        first = offsets[:-1]
        heads = [uniques[k] for k in index[first].tolist()]
        index[first] = np.arange(len(uniques), len(uniques) + len(heads))
        values = self._piece_values(uniques, " ") + self._piece_values(heads, "")
        return self._gather(index, offsets, values, self.dtype)


class WordEncoder(_Encoder):
    """ids of whole texts under a tokenizer that drops white space (each word stands alone)."""

    def __init__(self, path: str, limit: int = GENERATION):
        super().__init__(path, limit)
        self.cache = Generations(limit)

    def _piece_values(self, pieces: list[str]) -> list[bytes]:
        letters = _LATIN if self.lower_latin else "A-Za-z"
        values = (self._plain_values(pieces, f"^(?P<a>[{letters}]+)(?P<b>[{_PUNCT}]*)$", lower=True) if self.lower_ascii
                  else np.full(len(pieces), None, object))
        rest = [k for k, v in enumerate(values) if v is None]
        cut: list = []
        together = []
        for p in map(pieces.__getitem__, rest):
            if not p.isascii() and not ("<" in p and self.has_special(p)):
                together.append(len(cut))
                cut.append(())
            else:
                cut.append(self.cut_words(p))
        for at, ws in zip(together, self._cut_together([pieces[rest[k]] for k in together])):
            cut[at] = ws
        for k, v in zip(rest, self._joined(cut)):
            values[k] = self.whole(pieces[k]) if v is None else v
        return values.tolist()

    def _joined(self, cut: list) -> list:
        """The values of pieces cut into words; None stays."""
        get = self.words.fill({w for ws in cut if ws for w in ws}, self._word_ids).__getitem__
        return [b"".join(map(get, ws)) if ws is not None else None for ws in cut]

    def _cut_together(self, pieces: list[str]) -> list[list[str]]:
        """``cut_words`` of pieces without special strings, ``TOGETHER`` in one call of the normalizer and one of
        the pre-tokenizer: a blank between two pieces parts them in both.  Where the normalizer puts blanks into
        or takes them from a piece (their number tells), its run is cut piece by piece."""
        out: list[list[str]] = []
        for at in range(0, len(pieces), TOGETHER):
            run = pieces[at:at + TOGETHER]
            text = self.tok.normalizer.normalize_str(" ".join(run))
            ends = [m.start() for m in _GAP.finditer(text)]
            if len(ends) != len(run) - 1:
                out += [[w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(p))] for p in run]
                continue
            ends.append(len(text))
            cut: list[list[str]] = [[] for _ in run]
            k = 0
            for w, (start, _) in self.tok.pre_tokenizer.pre_tokenize_str(text):
                while start >= ends[k]:
                    k += 1
                cut[k].append(w)
            out += cut
        return out

    def cut_words(self, piece: str) -> list[str] | None:
        """The pre-tokenizer's words of a piece; None: it holds a special string."""
        if "<" in piece and self.has_special(piece):
            return None
        if piece.isascii():
            m = _SIMPLE.fullmatch(piece.lower())
            if m and self.lower_ascii:
                return [w for w in m.groups() if w and w != "\n"]
        return [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(piece))]

    @cached_property
    def lower_ascii(self) -> bool:
        """Whether ASCII words come out of normalizer and pre-tokenizer in lower case, else as they are."""
        given = "Ab,;\nc.*{"
        got = self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(given))
        return [w for w, _ in got] == ["ab", ",;", "c", ".*{"]

    @cached_property
    def lower_latin(self) -> bool:
        """Whether that holds for the letters from U+00C0 to U+00FF too, with their words in the byte alphabet."""
        letters = [c for c in map(chr, range(0xC0, 0x100)) if c.isalpha()]
        got = self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(" ".join(f"a{c}{c}#" for c in letters)))
        want = [w for c in letters for w in (f"a{c}{c}".lower().encode().decode("latin-1").translate(_ALPHABET), "#")]
        return self.lower_ascii and [w for w, _ in got] == want

    def run(self, texts: list[str]):
        """(all ids, offsets) of a run of texts."""
        flat = pc.replace_substring(pa.array(texts, pa.large_string()), pattern="\n", replacement=" ")
        arr = pc.split_pattern(flat, pattern=" ")
        coded = arr.flatten().dictionary_encode()
        uniques = strings(coded.dictionary)
        get = self.cache.fill(uniques, self._piece_values)
        return self._gather(coded.indices.to_numpy().astype(np.int64), arr.offsets.to_numpy().astype(np.int64),
                            [get[u] for u in uniques], "<u4")


_LOADED: dict = {}


def worker_encoder(kind: type, path: str):
    """The worker's encoder (workers serve many tasks); one of another kind or file is let go first."""
    key = (kind.__name__, path)
    if key not in _LOADED:
        release_encoders()
        gc.disable()  # no cycles are made; walking the caches again and again costs a fifth of the time
        _LOADED[key] = kind(path)
    return _LOADED[key]


def release_encoders() -> None:
    """Let go of the encoder, for tasks that need its memory."""
    if _LOADED:
        _LOADED.clear()
        gc.enable()
        gc.collect()
        trim_memory()


def trim_memory() -> None:
    """Give freed memory back to the system where Arrow's pool and the C library can (many small objects
    leave holes that they would otherwise keep)."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def row_runs(batches, rows: int = 2500):
    """The batches in parts of at most ``rows`` rows; what a part took is given back before the next."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
            trim_memory()


def small_runs(texts: list, budget: int = 3_000_000):
    """(from, to) runs of a batch with about ``budget`` characters each, so a batch of
    long texts is not cut into words all at once; a longer text is a run of its own."""
    start = size = 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if k > start and size + n > budget:
            yield start, k
            start, size = k, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def encode_texts(encoder, texts: list):
    """Yields the numpy values of each text of a batch (None: empty), run by run: the longer a run, the
    fewer pieces are met again in the next."""
    for a, b in small_runs(texts, RUN_CHARS):
        values, bounds = encoder.run([t or "" for t in texts[a:b]])
        for k in range(b - a):
            yield values[bounds[k]:bounds[k + 1]]
