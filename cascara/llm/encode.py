"""Exact, fast encoding with the ``tokenizers`` and ``sentencepiece`` libraries.

A text is cut where no token can cross, and every distinct piece is encoded once
per worker. For byte-level BPE a piece is a word with the one white-space
character before it, or the white space before that: its pattern draws borders
there. For a sentencepiece model without a piece that holds a blank after another
character, it is a word with the blanks before it. Cutting, hashing and putting
ids together is array work on the texts' bytes, and a piece counts as known only
if its bytes equal the remembered ones; the libraries see new pieces only. Texts
in which a border is not certain (an added token's string, white space beyond
ASCII, a character that pattern engines class differently) go through the
library whole. ``tests/llm`` holds the result against the plain library calls.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re

import numpy as np

# Latin letters; every pattern engine classes them alike.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
# Words that are one pre-token, with what may stand before and after.
_PLAIN = re.compile(rf"(\n?)( ?[{_LETTERS}]+)([.,]?)")
# Characters for which the text goes whole: white space beyond ASCII, and what
# some engines count as such.
_ODD = (*(chr(c) for c in range(0x1C, 0x3001) if chr(c).isspace() and c != 0x20), "᠎")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_GROUP = 1000
_Q = 0x9E3779B97F4A7C15


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if it shows, else the next free one from 256 on. Fixed values, set by
    the format of the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenizer_digest(path: str) -> str:
    """Digest of all that decides a count: the file, the library's version and
    the options used here."""
    import tokenizers

    with open(path, "rb") as f:
        data = f.read()
    return hashlib.sha256(
        data + f"|{tokenizers.__version__}|add_special_tokens=False".encode()).hexdigest()


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    """At least ``n`` long, by doubling."""
    while len(a) < n:
        a = np.concatenate((a, np.zeros_like(a)))
    return a


def _different(a: np.ndarray, at: np.ndarray, b: np.ndarray, there: np.ndarray,
               size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes of ``a`` from ``at`` differ from those of ``b`` from
    ``there``, for each of the places."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return np.zeros(len(size), dtype=bool)
    step = np.arange(ends[-1]) - np.repeat(ends - size, size)
    other = a[step + np.repeat(at, size)] != b[step + np.repeat(there, size)]
    out = np.zeros(len(size), dtype=bool)
    if other.any():
        out[np.searchsorted(ends, np.flatnonzero(other), side="right")] = True
    return out


class Pieces:
    """Pieces met so far and their ids. Places are found by a 64-bit hash and
    confirmed by the bytes. When ``limit`` pieces are kept the table starts anew."""

    def __init__(self, cut, learn, limit: int):
        self.cut, self.learn, self.limit = cut, learn, limit
        self.up = self.down = np.ones(1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        # The pieces' hashes in ascending order, and the row of each.
        self.hashes, self.rows = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype="<u4")  # the rows' ids, one after the other
        self.ends = np.zeros(1 << 14, dtype=np.int64)  # where a row ends in them
        self.bytes = np.zeros(1 << 16, dtype=np.uint8)  # likewise the rows' pieces
        self.stops = np.zeros(1 << 14, dtype=np.int64)

    def _hash(self, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        if len(b) >= len(self.up):
            self.up, self.down = (_powers(x, len(b) + 1) for x in (pow(_Q, -1, 1 << 64), _Q))
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        # +1: a zero byte counts too.
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.down[:len(b)], dtype=np.uint64, out=sums[1:])
        x = (np.append(sums[at[1:]], sums[-1]) - sums[at]) * self.up[at]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 if it is new."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.rows[at], -1)

    def _add(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Add new pieces, a row each."""
        rows = self.learn([p.decode() for p in pieces])
        n, used, stop = len(self.rows), self.ends[len(self.rows)], self.stops[len(self.rows)]
        ends = used + np.cumsum([len(r) // 4 for r in rows])
        stops = stop + np.cumsum(list(map(len, pieces)))
        self.ends, self.stops = (_grown(x, n + len(rows) + 1) for x in (self.ends, self.stops))
        self.ids, self.bytes = _grown(self.ids, ends[-1]), _grown(self.bytes, stops[-1])
        self.ends[n + 1:n + 1 + len(rows)], self.stops[n + 1:n + 1 + len(rows)] = ends, stops
        self.ids[used:ends[-1]] = np.frombuffer(b"".join(rows), dtype="<u4")
        self.bytes[stop:stops[-1]] = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        order = np.argsort(hashes)
        there = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, there, hashes[order])
        self.rows = np.insert(self.rows, there, n + order)

    def table(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts, none of them empty: the row of each of their pieces, the
        number of pieces before each text, and the places of pieces whose bytes
        are not those of their row (equal hashes)."""
        starts = np.cumsum([0] + list(map(len, raw)))
        data = b"".join(raw)
        b = np.frombuffer(data, dtype=np.uint8)
        at = np.flatnonzero(self.cut(b, starts[:-1]))
        ends = np.append(at[1:], len(b))
        size = ends - at
        distinct, first, codes = np.unique(self._hash(b, at), return_index=True, return_inverse=True)
        rows = self._find(distinct)
        if len(self.rows) + (rows < 0).sum() > self.limit:
            self._forget()
            rows = np.full(len(rows), -1)
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = np.arange(len(self.rows), len(self.rows) + len(new))
            self._add(distinct[new], [data[a:e] for a, e in zip(at[first[new]].tolist(), ends[first[new]].tolist())])
        rows = rows[codes]
        there = self.stops[rows]
        wrong = size != self.stops[rows + 1] - there
        if wrong.any():
            same = np.flatnonzero(~wrong)
            wrong[same] = _different(b, at[same], self.bytes, there[same], size[same])
        else:  # the pieces are the texts, end to end
            place = np.arange(len(b), dtype=np.int32)
            place += np.repeat((there - at).astype(np.int32), size)
            other = np.flatnonzero(self.bytes[place] != b)
            wrong[np.searchsorted(ends, other, side="right")] = True
        return rows, np.searchsorted(at, starts), np.flatnonzero(wrong)

    def encode(self, raw: list[bytes]) -> list[bytes | None]:
        """Ids of each text, None where a piece is not the one remembered."""
        rows, bounds, wrong = self.table(raw)
        begin, end = self.ends[rows], self.ends[rows + 1]
        done = np.cumsum(end - begin)
        place = np.arange(done[-1]) + np.repeat(end - done, end - begin)
        data = self.ids[place].tobytes()
        marks = (np.insert(done, 0, 0)[bounds] * 4).tolist()
        out = [data[a:b] for a, b in zip(marks, marks[1:])]
        for i in np.searchsorted(bounds, wrong, side="right") - 1:
            out[i] = None
        return out


def _in_pieces(pieces: Pieces, texts: list[str], direct: set[int], whole, before: str = "") -> list[bytes]:
    """Ids of texts; those of ``direct``, and what pieces cannot tell, ``whole``."""
    out: list[bytes | None] = [None] * len(texts)
    cut = [i for i in range(len(texts)) if i not in direct]
    if cut:
        for i, x in zip(cut, pieces.encode([(before + texts[i]).encode() for i in cut])):
            out[i] = x
    left = [i for i, x in enumerate(out) if x is None]
    for i, x in zip(left, whole([texts[i] for i in left])):
        out[i] = x
    return out


class Encoder:
    """Texts to little-endian uint32 ids, by a ``tokenizers`` file. With
    ``plain`` the strings of added tokens are ordinary text. ``limit`` bounds the
    pieces remembered."""

    def __init__(self, path: str, plain: bool = False, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = plain
        added = [] if plain else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.odd, self.added = re.compile("[" + "".join(_ODD) + "]"), added
        pre, norm = self.tok.pre_tokenizer, self.tok.normalizer
        # Pieces are exact only for the byte-level pattern without a prefix.
        self.pieces = None
        if (norm is None and type(pre).__name__ == "ByteLevel"
                and not pre.add_prefix_space and "use_regex=True" in repr(pre)):
            self.pieces = Pieces(self._cut, self._learn, limit)
            self.model = Tokenizer(self.tok.model)
            self.letters = _byte_letters()
            self.marks = dict(zip(("", ".", ",", "\n"), self._whole(["", ".", ",", "\n"])))
            self.n_bytes = np.array(
                [len(self.tok.id_to_token(i) or "") for i in range(self.tok.get_vocab_size())])

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of strings that are one pre-token each: the library's model
        takes them as they are, spelled in the vocabulary's letters."""
        out = []
        for k in range(0, len(words), _GROUP):
            group = [w.encode().decode("latin-1").translate(self.letters) for w in words[k:k + _GROUP]]
            e = self.model.encode_batch_fast([group], is_pretokenized=True, add_special_tokens=False)[0]
            ids = np.array(e.ids, dtype="<u4")
            ends, want = np.cumsum(self.n_bytes[ids]), np.cumsum(list(map(len, group)))
            cut = np.searchsorted(ends, want)
            if not np.array_equal(ends[cut], want):
                raise AssertionError("a token crosses a piece border")
            data, at = ids.tobytes(), 0
            for end in ((cut + 1) * 4).tolist():
                out.append(data[at:end])
                at = end
        return out

    def _learn(self, pieces: list[str]) -> list[bytes]:
        parts = [_PLAIN.fullmatch(p) for p in pieces]
        words = dict.fromkeys(m[2] for m in parts if m)
        words = dict(zip(words, self._words(list(words))))
        other = iter(self._whole([p for p, m in zip(pieces, parts) if not m]))
        return [self.marks[m[1]] + words[m[2]] + self.marks[m[3]] if m else next(other) for m in parts]

    @staticmethod
    def _cut(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where a piece starts in texts that lie end to end.

        White space before a word: its last character goes with the word (a
        blank is part of the pre-token, any other is one by itself), what is
        before is a pre-token, and so is white space that ends a text.
        """
        space = _SPACE[b]
        after = np.append(space[1:], True)
        after[starts[1:] - 1] = True  # a text's end is no word
        before = np.insert(space[:-1], 0, False)
        first = space & ~(after & before)
        first[starts] = True
        return first

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every whole text as uint32 bytes; null is the empty text."""
        texts = [t or "" for t in texts]
        direct = {i for i, t in enumerate(texts) if self.pieces is None or not t or self.odd.search(t)
                  or any(a in t for a in self.added)}
        return _in_pieces(self.pieces, texts, direct, self._whole)

    def count(self, texts: list[str | None]) -> list[int]:
        """The number of ids of every whole text."""
        return [len(x) // 4 for x in self.encode(texts)]

    def token_bytes(self) -> list[bytes]:
        """What each id of a byte-level vocabulary stands for."""
        back = {ord(c): b for b, c in _byte_letters().items()}
        names = [self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size())]
        return [n.translate(back).encode("latin-1") if all(ord(c) in back for c in n) else n.encode()
                for n in names]


class PieceEncoder:
    """The same for a sentencepiece model, without begin and end."""

    def __init__(self, path: str, limit: int = 800_000):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        # Blanks are kept as they are, and no piece goes on after one.
        self.certain = (self.sp.decode(self.sp.encode("  a  b ")) == "  a  b "
                    and not any(re.search("[^▁]▁", n) for n in names))
        self.blank = self._whole(["a "])[0][len(self._whole(["a"])[0]):]
        self.pieces = Pieces(self._cut, self._learn, limit)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, dtype="<u4").tobytes() for x in self.sp.encode(texts, num_threads=1)]

    def _learn(self, pieces: list[str]) -> list[bytes]:
        # The model puts a blank before each text but the empty one.
        return [x if len(p) > 1 else self.blank for p, x in zip(pieces, self._whole([p[1:] for p in pieces]))]

    @staticmethod
    def _cut(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
        blank = b == 0x20
        first = blank & ~np.insert(blank[:-1], 0, False)
        first[starts] = True
        return first

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every whole text as uint32 bytes; null is the empty text."""
        texts = [t or "" for t in texts]
        direct = {i for i, t in enumerate(texts) if not t or not self.certain or "▁" in t}
        return _in_pieces(self.pieces, texts, direct, self._whole, before=" ")

    def token_bytes(self) -> list[bytes]:
        """What each id stands for: a byte, or a piece with its blanks."""
        names = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        return [bytes([int(n[3:5], 16)]) if self.sp.is_byte(i) else n.replace("▁", " ").encode()
                for i, n in enumerate(names)]


_ENCODERS: dict[tuple, Encoder | PieceEncoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder | PieceEncoder:
    """One encoder per Python worker: its pieces outlive single tasks."""
    key = (path, plain)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path) if path.endswith(".model") else Encoder(path, plain)
    return _ENCODERS[key]


def forget_encoders() -> None:
    """Frees what the worker's encoders hold, where a later stage has no use for them."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()  # an encoder and its pieces refer to each other


def in_slices(texts: list[str | None], chars: int = 300_000):
    """Index ranges of about ``chars`` characters, so that the pieces held at
    once stay bounded whatever the batch holds."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
