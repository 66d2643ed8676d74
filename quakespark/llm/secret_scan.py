"""Secret scan: fixed patterns, and strings that a tokenizer cannot shorten."""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import tiktoken
from pyspark.sql import DataFrame

from quakespark.llm.common import from_text

#: The patterns of the base kinds and their shortest accepted match.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "token")

#: Strings of at least this many characters are tested for token efficiency.
LEAST = 16
#: Characters per token below which a string counts as random.
RATIO = 1.9
#: Characters encoded at once: a longer string is encoded piece by piece, so that one huge run stays linear.
PIECE = 256

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
#: Hexadecimal digits of common digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
_DIGESTS = {32, 40, 56, 64, 96, 128}
_HEXADECIMAL = re.compile(r"(?ai:(?:0x)?([0-9a-f]+))")
_UUID = re.compile(r"(?ai:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})")
#: One word, or words and short numbers joined as in names of variables, files and places in a tree.
_IDENTIFIER = re.compile(r"(?:[A-Z]?[a-z]*|[A-Z]+)(?:[/_=+-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[0-9]{0,4}[/_=+-]*")
_CAMEL = re.compile(r"[a-z]*(?:[A-Z][a-z]{2,})+[0-9]{0,4}")
_NUMBER = re.compile(r"[0-9+/_=-]+")
#: Letters in one case within an identifier: a word if it shortens well, else as random as any other string.
_LETTERS = re.compile(r"[A-Z]{%d,}|[A-Z]?[a-z]{%d,}" % (LEAST, LEAST - 1))
_JOINING = "+/_=-"
#: UUIDs and digests that stand between joining characters: what is around them is tested without them.
_PLACED = re.compile(r"(?<![A-Za-z0-9])(?:%s|(?ai:0x)?(?:%s))(?![A-Za-z0-9])" % (
    _UUID.pattern, "|".join("(?ai:[0-9a-f]{%d})" % n for n in sorted(_DIGESTS)),
))
#: Characters of a long run whose stretches are sought at once, and characters that two such blocks share.
_BLOCK, _SHARED = 4096, 256


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _standard(text: str) -> bool:
    """Digests, UUIDs and numbers."""
    digest = _HEXADECIMAL.fullmatch(text)
    return bool(digest and len(digest[1]) in _DIGESTS or _UUID.fullmatch(text) or _NUMBER.fullmatch(text))


def known(text: str) -> bool:
    """Digests, UUIDs, numbers and identifiers: strings that look random, or shorten badly, without being secret."""
    return bool(_standard(text) or _IDENTIFIER.fullmatch(text) or _CAMEL.fullmatch(text))


def _lengths(text: str, encoding: tiktoken.Encoding) -> list[int]:
    """Characters of each token."""
    pieces = (text[i : i + PIECE] for i in range(0, len(text), PIECE))
    return [len(t) for p in pieces for t in encoding.decode_tokens_bytes(encoding.encode_ordinary(p))]


def _random(text: str, encoding: tiktoken.Encoding, ratio: float) -> bool:
    return len(text) < ratio * len(_lengths(text, encoding))


def _words(text: str, encoding: tiktoken.Encoding, ratio: float) -> list[tuple[int, int]]:
    """Letters in one case, of an identifier, that are random by themselves."""
    if _standard(text):
        return []
    return [m.span() for m in _LETTERS.finditer(text) if len(m[0]) >= LEAST and _random(m[0], encoding, ratio)]


def _densest(ends: list[int], low: int, high: int, ratio: float) -> tuple[int, int] | None:
    """Token positions of the stretch of at least ``LEAST`` characters with most tokens above its share, if one has any.

    ``ends`` are the places between tokens; one scan with the best start for every end.
    """
    gain = lambda i: ratio * i - ends[i]
    best, found, start, at = 0.0, None, low, low
    for end in range(low + 1, high + 1):
        while ends[at] <= ends[end] - LEAST:
            if gain(at) < gain(start):
                start = at
            at += 1
        if at > low and gain(end) - gain(start) > best + 1e-9:
            best, found = gain(end) - gain(start), (start, end)
    return found


def _stretches(text: str, encoding: tiktoken.Encoding, ratio: float) -> list[tuple[int, int]]:
    """Stretches of a run that are random by themselves, whatever is joined to them; neither ordered nor disjoint.

    Stretches end where tokens do; one is drawn out to the joining characters around it where it stays random.
    """
    ends = list(accumulate(_lengths(text, encoding), initial=0))
    found, todo = [], [(0, len(ends) - 1)]
    while todo:
        low, high = todo.pop()
        if ends[high] - ends[low] < LEAST or not (best := _densest(ends, low, high, ratio)):
            continue
        todo += [(low, best[0]), (best[1], high)]
        a, b = ends[best[0]], ends[best[1]]
        while a < b and text[a] in _JOINING:
            a += 1
        while b > a and text[b - 1] in _JOINING:
            b -= 1
        wide_a, wide_b = a, b
        while wide_a and text[wide_a - 1] not in _JOINING:
            wide_a -= 1
        while wide_b < len(text) and text[wide_b] not in _JOINING:
            wide_b += 1
        if known(text[wide_a:wide_b]):
            continue
        if _random(text[wide_a:wide_b], encoding, ratio):
            found.append((wide_a, wide_b))
        elif b - a >= LEAST and (not known(text[a:b]) or _words(text[a:b], encoding, ratio)) and _random(text[a:b], encoding, ratio):
            found.append((a, b))
        elif not known(text[ends[best[0]] : ends[best[1]]]):
            # random with the joining characters at its ends, which are left out where enough is left
            found.append((a, b) if b - a >= LEAST else (ends[best[0]], ends[best[1]]))
    # a part between joining characters is cut into tokens by itself as well
    for m in re.finditer(r"[A-Za-z0-9]{%d,}" % LEAST, text):
        if known(m[0]):
            found += [(m.start() + a, m.start() + b) for a, b in _words(m[0], encoding, ratio)]
        elif _random(m[0], encoding, ratio):
            found.append(m.span())
    return found


def _joined(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def random_spans(text: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> list[tuple[int, int]]:
    """Strings of at least ``LEAST`` characters that take more than one token for each ``ratio`` characters.

    Of an identifier only its random words are spans. A run that is random as a whole is one span. Otherwise its parts between joining characters and its stretches of
    tokens are tested by themselves, so a random string is found whatever readable text it is joined to.
    """
    found = []
    for m in _RUN.finditer(text):
        run = m[0]
        if known(run):
            found += [(m.start() + a, m.start() + b) for a, b in _words(run, encoding, ratio)]
            continue
        if _random(run, encoding, ratio):
            found.append(m.span())
            continue
        cuts = [0, *(x for p in _PLACED.finditer(run) for x in p.span()), len(run)]
        inside = []
        for low, high in zip(cuts[::2], cuts[1::2], strict=True):
            for at in range(low, max(high - _SHARED, low + 1), _BLOCK - _SHARED):
                part = run[at : min(at + _BLOCK, high)]
                if len(part) >= LEAST:
                    inside += [(at + a, at + b) for a, b in _stretches(part, encoding, ratio)]
        found += [(m.start() + a, m.start() + b) for a, b in _joined(inside)]
    return found


def spans(text: str | None, encoding: tiktoken.Encoding, ratio: float = RATIO) -> list[tuple[int, int, str]]:
    """(start, end, kind) of one whole text, by start and then kind as in ``KINDS``; code points, end exclusive.

    Base kinds are leftmost and non-overlapping within their kind; a match that fails its length is dropped and not
    searched again. ``token`` spans are strings of low token efficiency, also where readable text is joined to them; one
    that a base span covers is not repeated.
    """
    text = text or ""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    # maximal runs: the shorter ones are those that would be dropped
    found += [(*m.span(), "hex") for m in _LONG_HEX.finditer(text)]
    base = sorted(found)
    starts, ends = [s[0] for s in base], list(accumulate((s[1] for s in base), max))  # how far earlier starts reach
    for a, b in random_spans(text, encoding, ratio):
        if not (i := bisect_right(starts, a)) or ends[i - 1] < b:
            found.append((a, b, "token"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, path: str, pattern: str, ratio: float = RATIO) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, n_token, spans), a row for each row of ``docs`` (doc_id, text).

    ``spans`` joins kind:start:end of all spans by commas, ``base_sha256`` is the digest of the base ones so joined.
    A null text counts as empty. ``path`` and ``pattern`` give a tiktoken vocabulary and how it cuts words.
    """

    def start():
        encoding = _encoding(path, pattern)
        joined = lambda found: ",".join(f"{kind}:{a}:{b}" for a, b, kind in found)

        def row(text: str | None) -> tuple:
            found = spans(text, encoding, ratio)
            kinds = [s[2] for s in found]
            base = joined(s for s in found if s[2] != "token")
            counts = [kinds.count(k) for k in KINDS]
            return *counts[:3], hashlib.sha256(base.encode()).hexdigest(), counts[3], joined(found)

        return lambda texts: [row(t) for t in texts]

    columns = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, n_token bigint, spans string"
    return from_text(docs.select("doc_id", "text"), columns, start)
