"""Byte-level BPE by the `tokenizers` library, with segments encoded once.

A text is cut before every single space that stands between two non-space
characters. The byte-level pre-tokenizer always starts a new word there (a space
joins the word that follows it, and no alternative of its pattern crosses it), so
the ids of the text are the ids of its segments in order. Segments repeat, so
each worker keeps a bounded memo of them; only new ones reach the library. The
heads of texts, and texts with other white space, go there in batches balanced by bytes.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import threading
import time

SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
#: A text longer than this many characters is encoded slice by slice.
SLICE_CHARS = 1 << 20
#: Bytes per call of the library.
BATCH_BYTES = 1 << 18
#: Longest segment kept in a memo, in characters, and entries kept in its two generations (about
#: 200 bytes an entry). Workers live on between tasks, and so do their memos, until no task
#: has used them for IDLE_SECONDS.
MEMO_CHARS = 48
MEMO_ENTRIES, WORD_ENTRIES = 1_000_000, 1_000_000
IDLE_SECONDS = 4.0
#: Latin letters, then marks, perhaps a line break and the same again: words of the pre-tokenizer.
_LETTERS, _MARKS = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+)", "([.,;:!?#$%&*|)]*)"
PLAIN = re.compile(rf"{_LETTERS}{_MARKS}(?:\n{_LETTERS}{_MARKS})?")

_ENCODERS: dict = {}
_LAST_USE = [0.0]
_TIMER: list = []


def byte_letters() -> dict[int, str]:
    """How byte-level BPE writes a byte: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo(dict):
    """Segment -> value; a missing one is asked of ``learn`` and remembered if it is short."""

    def __init__(self, learn, entries: int):
        super().__init__()
        self.learn, self.entries = learn, entries
        self.before: dict = {}  # the generation before this one

    def __missing__(self, s: str):
        value = self.before[s] if s in self.before else self.learn(s)
        if len(s) <= MEMO_CHARS:
            if len(self) >= self.entries // 2:
                self.before = dict(self)
                self.clear()
            self[s] = value
        return value


class SegmentEncoder:
    """Whole-text encoding; ``keep`` turns ids into what is stored, ``join`` adds values up."""

    def __init__(self, path: str, keep, join):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keep, self.join = keep, join
        self.letters = byte_letters()
        self.words = _Memo(self._word, WORD_ENTRIES)
        self.segments = _Memo(self._segment, MEMO_ENTRIES)  # of segments without their leading space; None if not safe alone

    def _word(self, word: str):
        """A word of the pre-tokenizer: letters after a space, or marks."""
        # U+0120 is how a space is written, other printable ASCII stays
        letters = word.replace(" ", "\u0120").replace("\n", "\u010a") if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return self.keep([t.id for t in self.model.tokenize(letters)])

    def _segment(self, s: str):
        if m := PLAIN.fullmatch(s):
            words = self.words
            if m[3]:
                return self.join([words[" " + m[1]], words[m[2]], words["\n"], words[m[3]], words[m[4]]])
            return self.join([words[" " + m[1]], words[m[2]]]) if m[2] else words[" " + m[1]]
        if not s or s[0].isspace() or s[-1].isspace():
            return None
        return self.keep(self.tokenizer.encode(" " + s, add_special_tokens=False).ids)

    def _library(self, texts: list[str]) -> list:
        """Values of ``texts``, in calls of about BATCH_BYTES each."""
        out: list = []
        for a, b in balanced(texts, BATCH_BYTES):
            out += [self.keep(e.ids) for e in self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False)]
        return out

    def values(self, texts: list[str]) -> list:
        """The value of each whole text."""
        parts = [t.split(" ") for t in texts]
        heads = self._library([p[0] for p in parts])
        value, out = self.segments.__getitem__, []
        for t, p, head in zip(texts, parts, heads):
            first = p[0]
            p[0] = head
            try:
                if len(p) > 1 and (not first or first[-1].isspace()):
                    raise TypeError
                p[1:] = map(value, p[1:])
                out.append(self.join(p))
            except TypeError:  # a None among the values: some space is no safe cut
                first, *rest = SAFE_CUT.split(t)
                out.append(self.join(self._library([first, *(" " + s for s in rest)])))
        return out


def slices(text: str) -> list[str]:
    """The text cut at safe spaces into slices of about SLICE_CHARS; joined they are the text."""
    if len(text) <= SLICE_CHARS:
        return [text]
    out, at = [], 0
    while len(text) - at > SLICE_CHARS:
        cut = SAFE_CUT.search(text, at + SLICE_CHARS)
        if not cut:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def as_count(ids) -> int:
    return len(ids)


def as_bytes(ids) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return struct.pack(f"<{len(ids)}I", *ids)


def joined(values) -> bytes:
    return b"".join(values)


JOINS = {as_count: sum, as_bytes: joined}


def encoder(path: str, keep) -> SegmentEncoder:
    """One encoder per worker process, tokenizer file and kind of value."""
    key = (path, keep.__name__)
    if key not in _ENCODERS:
        _ENCODERS[key] = SegmentEncoder(path, keep, JOINS[keep])
    _LAST_USE[0] = time.monotonic()
    if not _TIMER or not _TIMER[0].is_alive():
        _TIMER[:] = [threading.Timer(IDLE_SECONDS, _forget)]
        _TIMER[0].daemon = True
        _TIMER[0].start()
    return _ENCODERS[key]


def _forget() -> None:
    """Drop the encoders of an idle worker; look again later while they are used."""
    while (left := _LAST_USE[0] + IDLE_SECONDS - time.monotonic()) > 0:
        time.sleep(left)
    _ENCODERS.clear()
    gc.collect()


def balanced(texts: list[str], limit: int):
    """Index ranges of consecutive texts of about ``limit`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 16
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_all(texts: list[str], path: str, keep, limit: int = 1 << 21):
    """Yield a list with the value of each text, byte-balanced batch by batch."""
    for a, b in balanced(texts, limit):
        enc = encoder(path, keep)
        flat = [slices(t) for t in texts[a:b]]
        values = iter(enc.values([s for cut in flat for s in cut]))
        yield [enc.join([next(values) for _ in cut]) for cut in flat]
