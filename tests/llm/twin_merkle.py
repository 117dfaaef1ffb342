"""A plain-Python twin of the Merkle fingerprints."""

import hashlib
import re

PIECE = re.compile(r"(?s)(?=.)[^.!?\n]{0,32}[^.!?\n ]{0,128}+[.!?\n ]?")


def h(x: str) -> str:
    return hashlib.md5(x.encode()).hexdigest()[:16]


def leaves(text: str) -> list[str]:
    return [h(x) + (";" if x.endswith("\n") else ",") for x in PIECE.findall(text)]


def grouped(hashes: list[str], closes) -> list[str]:
    """Strings of consecutive hashes, each up to and without the mark of the one that closes it."""
    out, now = [], ""
    for x in hashes:
        now += x[:16] if closes(x) else x[:16] + ","
        if closes(x):
            out.append(now)
            now = ""
    return out + [now] if now else out


def tree(text: str) -> list[list[str]]:
    """Sections as lists of paragraphs' hashes."""
    paragraphs = [h(p) for p in grouped(leaves(text), lambda x: x[0] == "0" or x[16] == ";")]
    return [s.rstrip(",").split(",") for s in grouped([p + "," for p in paragraphs], lambda x: x[0] == "0")]


def section_hash(paragraphs: list[str]) -> str:
    last = "" if paragraphs[-1][0] == "0" else ","
    return h(",".join(paragraphs) + last)


def fingerprint(text: str) -> str:
    sections = tree(text)
    root = hashlib.md5(",".join(section_hash(s) for s in sections).encode()).hexdigest()
    return root + ":" + ";".join(section_hash(s) + "=" + ",".join(p[:8] for p in s) for s in sections)


def likeness(a: str, b: str) -> float:
    if fingerprint(a) == fingerprint(b):
        return 1.0
    x, y = leaves(a), leaves(b)
    distinct = 2 * len(set(x) & set(y)) / (len(set(x)) + len(set(y)))
    placed = 2 * sum(p == q for p, q in zip(x, y)) / (len(x) + len(y))
    return max(distinct, placed)


def changed(a: str, b: str) -> list[int]:
    if fingerprint(a) == fingerprint(b):
        return []
    theirs = tree(b)
    known, short = {section_hash(s) for s in theirs}, {p[:8] for s in theirs for p in s}
    at, out = 0, []
    for s in tree(a):
        out += [at + i for i, p in enumerate(s) if section_hash(s) not in known and p[:8] not in short]
        at += len(s)
    return out
