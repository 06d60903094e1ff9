"""URL filters: glob rules packed into multiword Shift-And masks.

Every rule ``glob`` is a string over bytes with ``*`` for any run of bytes. All rules are laid out
one after another over the bits of a state of several 64-bit words. One step for a byte ``c``
moves each active position one on where the rule's byte is ``c`` (``((D << 1) & M[c])``, with the
carry passed between words) and keeps positions before a ``*`` active (``D & LOOP``), so
all patterns run at once. A batch of URLs is a byte matrix; a step handles one column of it,
that is, the same byte position of all URLs of the batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of addresses that are not worth reading: advertising and tracking, adult, gambling, spam, piracy, and pages of the machinery of a site.
WORDS = (
    "ads adserver adservice adsystem adtech adclick advert adverts banner banners popup popunder doubleclick sponsored affiliate affiliates tracking tracker pixel beacon telemetry "
    "porn porno xxx sex adult nude nudes escort escorts camgirls hentai milf "
    "casino casinos poker betting slots jackpot lottery roulette sportsbook bookmaker "
    "viagra cialis levitra pharmacy pills payday replica linkfarm spam clickbait "
    "warez crack cracks keygen keygens torrent torrents serials "
    "login signin signup register logout wp-login wp-admin wp-json cgi-bin cart checkout captcha xmlrpc phpmyadmin"
).split()
#: Where a word counts: a label of the host or part of one, a segment of the path or part of one, a name or value of the query.
PLACES = ("{}.*", "*.{}.*", "{}-*.*", "*-{}.*", "*.{}-*", "*/{}", "*/{}/*", "*/{}.*", "*/{}-*", "*-{}/*", "*/{}_*", "*&{}=*", "*={}", "*={}&*")
#: Default judgement where no host rule fits: these globs on the canonical address are blocked, all else is allowed.
DEFAULT_BLOCK = tuple(p.format(w) for w in WORDS for p in PLACES)
#: host, path prefix, verdict: the rules of the query.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


#: Strings whose states are held at once: few enough for a processor's cache.
ROWS = 1024


class ShiftAnd:
    """Masks of a list of globs; match() gives, for a list of byte strings, a boolean matrix (strings, globs)."""

    def __init__(self, globs: list[bytes]):
        self.n = len(globs)
        bits = 0
        cells: list[tuple[int, int]] = []  # (bit, byte) to set
        loops, inits, ends = [], [], []
        for g in globs:
            inits.append(bits)
            for c in g:
                if c == 42:
                    loops.append(bits)
                else:
                    cells.append((bits + 1, c))
                    bits += 1
            ends.append(bits)
            bits += 1  # a glob of k literal bytes has k + 1 bits; the first: nothing read yet
        self.words = max(1, -(-bits // 64))
        self.masks = np.zeros((256, self.words), np.uint64)
        for bit, c in cells:
            self.masks[c, bit // 64] |= np.uint64(1 << bit % 64)
        self.loop, self.init = self._word(loops), self._word(inits)
        self.ends = [(e // 64, np.uint64(1 << e % 64)) for e in ends]

    def _word(self, at: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for b in at:
            out[b // 64] |= np.uint64(1 << b % 64)
        return out

    def match(self, texts: list[bytes]) -> np.ndarray:
        done = self._states(texts)
        return np.stack([(done[:, w] & bit) != 0 for w, bit in self.ends], 1) if self.n else np.zeros((len(texts), 0), bool)

    def match_any(self, texts: list[bytes]) -> np.ndarray:
        """Which strings some glob matches."""
        final = np.zeros(self.words, np.uint64)
        for w, bit in self.ends:
            final[w] |= bit
        return (self._states(texts) & final).any(1)

    def _states(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), self.words), np.uint64)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        # longest first: strings that have ended are cut off the end of the state matrix
        order = np.argsort(-lengths, kind="stable")
        for at in range(0, len(order), ROWS):
            rows = order[at : at + ROWS]
            out[rows] = self._run([texts[i] for i in rows], lengths[rows])
        return out

    def _run(self, texts: list[bytes], lengths: np.ndarray) -> np.ndarray:
        n, one, top = len(texts), np.uint64(1), np.uint64(63)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if n else np.zeros(0, np.int64)
        state = np.tile(self.init, (n, 1))
        done = np.empty_like(state)
        live = n
        for j in range(int(lengths[0]) + 1 if n else 0):
            k = int(np.searchsorted(-lengths, -j, side="left"))  # strings longer than j
            done[k:live] = state[k:live]
            live = k
            if not live:
                break
            d = state[:live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:live] = (moved & self.masks[flat[starts[:live] + j]]) | (d & self.loop)
        return done


#: Stands between host and path; no UTF-8 text has this byte, so a ``*`` before it stays within the host.
GAP = b"\xff"


def rule_globs(rules) -> list[tuple[bytes, str, str]]:
    """(glob, rule, verdict), two for each host rule: the host itself and its subdomains; short rules first."""
    globs = [(g.encode() + GAP + path.encode() + b"*", f"{host}{path}", verdict) for host, path, verdict in rules for g in (host, f"*.{host}")]
    return sorted(globs, key=lambda x: len(x[1]))


def split_url(col: str):
    """(host, path, query) of a URL column: host after the first '://', up to / ? # or the end, A-Z lower-cased; path up to ? # or the end; query from ? up to #; all empty without '://'."""
    url = F.coalesce(F.col(col), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path, F.regexp_extract(rest, r"(?s)^[^?#]*(\?[^#]*)", 1)


UNRESERVED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~"
_ESCAPES = {f"%{ord(c):02x}": c for c in UNRESERVED}


def canonical(host: str, path: str, query: str) -> str:
    """An address as globs see it: host without user, port and closing dots, path with single slashes, query with its mark; escapes of plain letters,
    digits and -._~ undone; no fragment."""
    host = re.sub(r":\d*$", "", host.rpartition("@")[2]).rstrip(".")
    plain = lambda x: re.sub("%[0-9A-Fa-f]{2}", lambda m: _ESCAPES.get(m[0].lower(), m[0]), x)
    return host + re.sub("/+", "/", plain(path)) + plain(query)


def filter_urls(pages: DataFrame, rules=RULES, default_block=DEFAULT_BLOCK, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every row's URL: (page_id, host, path, rule, verdict).

    The longest host rule that fits decides; without one, a default glob over the canonical address (canonical()) blocks,
    and all else is allowed. Null URLs and those without ``://`` have an empty host and
    path: they fit no rule and are allowed. Repeated rows are judged alike, other columns of the table are not
    read, an empty table gives an empty result, URLs of any length are read to their end. One narrow pass: no shuffle, and a
    state whose size depends on the rules only.
    """
    globs, plain = rule_globs(rules), [g.encode() for g in default_block]
    host, path, query = split_url(url_col)
    src = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), query.alias("query"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_host, anywhere = ShiftAnd([g for g, _, _ in globs]), ShiftAnd(plain)
        for b in batches:
            pairs = list(zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True))
            hit = by_host.match([h.encode() + GAP + p.encode() for h, p, _ in pairs])
            best = np.where(hit.any(1), hit.shape[1] - 1 - hit[:, ::-1].argmax(1), -1) if globs else np.full(len(pairs), -1)
            open_ = np.flatnonzero(best < 0)  # the others are decided
            blocked = np.zeros(len(pairs), bool)
            blocked[open_] = anywhere.match_any([canonical(*pairs[i]).encode() for i in open_])
            rule = [globs[i][1] if i >= 0 else None for i in best]
            verdict = [globs[i][2] if i >= 0 else "block" if x else "allow" for i, x in zip(best, blocked, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    kind = src.schema["page_id"].dataType.simpleString()
    return src.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
