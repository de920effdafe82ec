"""Token ids of whole texts with a public tokenizer, for large corpora.

``TextEncoder`` gives exactly the ids of ``Tokenizer.encode(text,
add_special_tokens=False)``. A tokenizer that first cuts a text into words and
encodes each by itself needs the library only once per distinct word: the ids
of words are kept (up to a documented number per worker process), and the
words not kept are encoded by the library, many in one call. Texts of plain
letters, digits and punctuation are cut as the tokenizer file's pattern does,
whole batches at a time on their bytes, and words are looked up by a 64-bit
hash of their 8-byte pieces in a table of open slots and then compared with the
word kept there, piece by piece. Texts with an apostrophe are cut with the pattern itself; in texts with
any other character, white-space-delimited chunks that have one go to the
library as they are. At start-up, probe texts check that the
tokenizer works like this; one that does not is run on whole texts.
"""

from __future__ import annotations

import re
import zlib
from hashlib import blake2b
from collections.abc import Iterator

import numpy as np

from flowatlas.llm.common import KEPT
from flowatlas.llm.textops import LOWER_TABLE, mix

END_ID = 1
#: words kept per worker process (about 150 bytes each)
MAX_WORDS = 600_000

#: characters that need no Unicode normalisation and lower-case one by one
_PLAIN_TEXT = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*\Z")
#: fixed value: the word pattern of the tokenizer file, for those characters in lower case
_WORD = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-zß-öø-ÿ0-9]+")
#: byte classes: 0 space, 1 letter (ASCII, or either byte of a Latin-1 letter), 2 digit, 3 other
_CLASS = np.array([0 if b == 32 or 9 <= b <= 13 else 1 if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 2 if 48 <= b <= 57 else 3
                   for b in range(256)], np.uint8)
_PROBES = ["It's Émile's 42nd re'vealed --token=\"x9\" d'été.", "AKIA12 foo||bar ÀÉ1½ don't", "a\tb\nc  d\x0be ʻokina ﬁ Σας",
           " ".join(f"a{chr(c)}b" for c in range(0x21, 0x100) if not 0x7F <= c <= 0xA0)]

#: bytes of the longest words that are hashed and compared piece by piece, all of
#: a batch at once; longer ones one by one
PIECED = 64
_PIECE = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of eight
_ODD = np.uint64(0x9E3779B97F4A7C15)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... ``size[0]`` places, then those of start[1], and so on."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class TextEncoder:
    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        for token, i in vocab.items():
            self.last[i] = token.endswith("</w>")
        self.words: dict[str | bytes, bytes] = {}
        self.max_words = max_words
        self._forget()
        self.by_word = True
        whole = [p.tobytes() for p in self._library(_PROBES)]
        self.by_word = list(self.encode([t.encode() for t in _PROBES])) == whole
        self.words.clear()
        self._forget()

    def _forget(self) -> None:
        # the words by hash: ``slots`` has their numbers; by number the hash, where
        # their ids are in ``flat``, how many they are, where their pieces are in
        # ``letters`` (a hash alone decides nothing), and how many bytes they have
        self.slots = np.full(1 << 12, -1, np.int32)
        self.keys = np.zeros(0, np.uint64)
        self.at, self.n, self.word_at, self.word_n = (np.zeros(0, np.int64) for _ in range(4))
        self.flat, self.letters = np.zeros(0, self.dtype), np.zeros(0, np.uint64)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The library's ids of words, many in one call, cut at the word ends."""
        out: list[np.ndarray] = []
        for at in range(0, len(words), 4000):
            part = words[at:at + 4000]
            ids = self._library([" ".join(part)])[0]
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            # if some token breaks the rule: one by one
            out += [ids[a:b] for a, b in zip([0, *ends], ends)] if len(ends) == len(part) else self._library(part)
        return out

    def _learn(self, new: set) -> None:
        """Ids of words (str) and of chunks that the library takes as they are (bytes)."""
        words = [w for w in new if isinstance(w, str)]
        chunks = [c for c in new if isinstance(c, bytes)]
        self.words.update(zip(words, (p.tobytes() for p in self._encode_words(words))))
        if chunks:
            found = self._library([c.decode("utf-8", "replace") for c in chunks])
            self.words.update(zip(chunks, (p.tobytes() for p in found)))

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The numbers of the words kept under these hashes, -1 for none."""
        last = len(self.slots) - 1
        slot = (h & np.uint64(last)).astype(np.int64)
        at = self.slots[slot]
        if not len(self.keys):
            return at
        on = np.flatnonzero((at >= 0) & (self.keys[at] != h))
        while len(on):  # another hash's slot: the next one
            slot[on] = (slot[on] + 1) & last
            at[on] = self.slots[slot[on]]
            on = on[(at[on] >= 0) & (self.keys[at[on]] != h[on])]
        return at

    def _keep(self, first: int) -> None:
        """Gives the words from number ``first`` on their slots."""
        if 3 * len(self.keys) > len(self.slots):
            self.slots = np.full(1 << (6 * len(self.keys)).bit_length(), -1, np.int32)
            first = 0
        last = len(self.slots) - 1
        i = np.arange(first, len(self.keys), dtype=np.int32)
        slot = (self.keys[first:] & np.uint64(last)).astype(np.int64)
        while len(i):  # of several that want one slot, one gets it
            free = self.slots[slot] < 0
            self.slots[slot[free]] = i[free]
            on = self.slots[slot] != i
            i, slot = i[on], (slot[on] + 1) & last

    def _plain(self, texts: list[bytes]) -> list[bytes | None]:
        """Ids of texts of plain characters without apostrophes; none for a text
        with a word that only shares another one's hash."""
        if not texts:
            return []
        # eight blanks more, so that eight bytes can be read from any word's last one on
        a = np.frombuffer(b" ".join([*texts, b" " * 8]).translate(LOWER_TABLE), np.uint8).copy()
        capital = np.flatnonzero((a[1:] >= 0x80) & (a[1:] <= 0x9E) & (a[:-1] == 0xC3)) + 1
        a[capital] += 0x20
        kind = _CLASS[a]
        edge = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == 2)) + 1
        start = np.concatenate([[0], edge])
        size = np.diff(start, append=len(a))
        word = np.flatnonzero(kind[start])
        start, size = start[word], size[word]
        raw = a.tobytes()
        wide = np.ndarray(len(a) - 7, "<u8", raw, strides=(1,))  # eight bytes from every place
        pieces = [wide[start] & _PIECE[np.minimum(size, 8)]]
        h = mix(pieces[0] + size.astype(np.uint64) * _ODD)
        longer = [np.arange(0)]  # words with a k-th piece
        for k in range(1, PIECED // 8):
            w = np.flatnonzero(size > 8 * k) if k == 1 else longer[-1][size[longer[-1]] > 8 * k]
            if not len(w):
                break
            longer.append(w)
            pieces.append(wide[start[w] + 8 * k] & _PIECE[np.minimum(size[w] - 8 * k, 8)])
            h[w] = mix(h[w] * _ODD ^ pieces[-1])
        long = [(i, raw[start[i]:start[i] + size[i]]) for i in np.flatnonzero(size > PIECED).tolist()]
        for i, x in long:
            h[i] = mix(np.frombuffer(blake2b(x, digest_size=8).digest(), "<u8"))[0]
        at = self._find(h)
        missing = np.flatnonzero(at < 0)
        before = self.keys, self.at, self.n, self.flat, self.word_at, self.word_n, self.letters
        if len(missing):
            u, where, back = np.unique(h[missing], return_index=True, return_inverse=True)
            new = missing[where]
            words = [raw[i:i + j] for i, j in zip(start[new].tolist(), size[new].tolist())]
            ids = self._encode_words([x.decode() for x in words])
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            at[missing] = len(self.keys) + back
            held = (size[new] + 7) // 8
            self.keys = np.concatenate([self.keys, u])
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(n) - n])
            self.n = np.concatenate([self.n, n])
            self.flat = np.concatenate([self.flat, *ids])
            self.word_at = np.concatenate([self.word_at, len(self.letters) + np.cumsum(held) - held])
            self.word_n = np.concatenate([self.word_n, size[new]])
            self.letters = np.concatenate([self.letters, np.frombuffer(b"".join([x.ljust(-(-len(x) // 8) * 8, b"\0") for x in words]), "<u8")])
        # the places of words whose bytes are not those of the word kept under their hash
        kept = self.word_at[at]
        other = [np.flatnonzero((self.word_n[at] != size) | (self.letters[kept] != pieces[0]))]
        for k in range(1, len(pieces)):
            w = longer[k]
            # of words of another length, any piece may be met
            other.append(w[self.letters[np.minimum(kept[w] + k, len(self.letters) - 1)] != pieces[k]])
        for i, x in long:
            same = self.letters[kept[i]:kept[i] + (len(x) + 7) // 8].tobytes()[:len(x)] == x
            other.append(np.array([] if same else [i], np.int64))
        n, source = self.n[at], self.at[at]
        stop = np.cumsum(n)
        ids = np.empty(stop[-1] if len(stop) else 0, self.dtype)
        some = np.flatnonzero(n)
        ids[(stop - n)[some]] = self.flat[source[some]]
        more = np.flatnonzero(n > 1)
        ids[_runs((stop - n)[more] + 1, n[more] - 1)] = self.flat[_runs(source[more] + 1, n[more] - 1)]
        if len(self.keys) > self.max_words:  # the early words are the frequent ones
            self.keys, self.at, self.n, self.flat, self.word_at, self.word_n, self.letters = before
        elif len(missing):
            self._keep(len(before[0]))
        first = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        cut = np.concatenate([[0], stop])[first].tolist()
        out: list[bytes | None] = [ids[i:j].tobytes() for i, j in zip(cut, cut[1:])]
        for i in (np.searchsorted(first, np.concatenate(other), side="right") - 1).tolist():
            out[i] = None
        return out

    @staticmethod
    def _cut(text: bytes) -> list:
        t = text.decode("utf-8", "replace")
        if _PLAIN_TEXT.match(t) and "<|" not in t:
            return _WORD.findall(t.lower())
        out: list = []
        for c in text.split():
            t = c.decode("utf-8", "replace")
            if _PLAIN_TEXT.match(t) and "<|" not in t:
                out += _WORD.findall(t.lower())
            else:
                out.append(c)
        return out

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each UTF-8 text as little-endian bytes of ``dtype``."""
        if not self.by_word:
            for p in self._library([t.decode("utf-8", "replace") for t in texts]):
                yield p.tobytes()
            return
        for at in range(0, len(texts), 128):
            part = texts[at:at + 128]
            done: list[bytes | None] = [None] * len(part)
            easy = [i for i, t in enumerate(part) if b"'" not in t and b"<|" not in t and len(t) < 1 << 22 and _PLAIN_TEXT.match(t.decode("utf-8", "replace"))]
            for i, ids in zip(easy, self._plain([part[i] for i in easy])):
                done[i] = ids
            cut = {i: self._cut(t) for i, t in enumerate(part) if done[i] is None}
            known = self.words
            new = set().union(*cut.values()).difference(known)
            self._learn(new)
            for i, c in cut.items():
                done[i] = b"".join(map(known.__getitem__, c))
            if len(known) > self.max_words:
                for w in new:
                    del known[w]
            yield from done


def encoder(path: str) -> TextEncoder:
    """One per worker process and tokenizer file, until a task lets it go."""
    if path not in KEPT:
        KEPT[path] = TextEncoder(path)
    return KEPT[path]


def crc32_u32(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes()) & 0xFFFFFFFF
