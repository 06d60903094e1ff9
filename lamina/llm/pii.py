"""Personal data: generators propose spans, boosted trees judge them by format and context, calibrated thresholds select what is redacted."""

from __future__ import annotations

import ipaddress
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order of ties.
KINDS = ("email", "ip", "card", "phone")
#: The model is fitted on planted items in at most so many slices of texts, each of so many characters; all documents are judged.
CARRIERS, SLICE = 400, 600
#: Items and look-alikes planted in each slice; one slice in so many is kept for calibration.
PLANTED, HELD = 14, 4
#: Thresholds are the lowest at which so large a share of the selected spans is right, on slices that had no part in the fit.
PRECISION = 0.98

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Where ip, card and phone can stand: from a digit or a sign before it over digits and what may part them.
_ZONE = re.compile(r"(?:\+\(?|\(\+?)?[0-9][0-9.()+/\x20 ‐-–-]{5,}")
_GROUP = re.compile(r"[0-9]+")
_DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])")
_COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
_HEX = frozenset("0123456789abcdefABCDEF:")
_AT = re.compile(r"[\[({<]\s?(?:at|AT|At|@)\s?[\])}>]|\s(?:at|AT)\s|\s@\s?|@\s", re.ASCII)
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s{0,2}\Z", re.ASCII)
_SPELT = re.compile(r"\s{0,2}[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[({<]\s?(?:dot|DOT|Dot|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s)[A-Za-z0-9-]{1,63}){1,4}", re.ASCII)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's matches, found from each @: in time that is linear in the text, also where a run without @ is very long."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _base_of_zone(zone: str) -> Iterator[tuple[int, int, int]]:
    for m in _IP.finditer(zone):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            yield m.start(), 1, m.end()
    for m in _CARD.finditer(zone):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), 2, m.end()
    for m in _PHONE.finditer(zone):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.start(), 3, m.end()


class Candidate(NamedTuple):
    """A proposed span; way: the generator's number."""

    kind: int
    start: int
    end: int
    way: int


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[Candidate]]:
    """(base spans as start, kind, end, in order; candidates that no base span overlaps)."""
    base = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    found: list[Candidate] = []
    for z in _ZONE.finditer(text):
        zone, at = z[0], z.start()
        groups = [(m.start(), m.end()) for m in _GROUP.finditer(zone)]
        if sum(e - s for s, e in groups) < 4:
            continue
        base += [(at + s, k, at + e) for s, k, e in _base_of_zone(zone)]
        found += _numbers(zone, at, groups)
    if ":" in text:
        found += _colons(text)
    if "." in text or "dot]" in text:
        found += [Candidate(1, m.start(), m.end(), 3) for m in _DEFANGED.finditer(text)]
    if "at" in text or "AT" in text or "@" in text:
        found += _spelt(text)
    base.sort()
    return base, _apart(base, found)


def _apart(base: list[tuple[int, int, int]], found: list[Candidate]) -> list[Candidate]:
    if not base or not found:
        return found
    starts = np.array([s for s, _, _ in base])
    ends = np.maximum.accumulate([e for _, _, e in base])  # of all base spans that start before
    before = np.searchsorted(starts, [c.end for c in found], side="left")
    return [c for c, n in zip(found, before, strict=True) if n == 0 or ends[n - 1] <= c.start]


def _numbers(zone: str, at: int, groups: list[tuple[int, int]]) -> Iterator[Candidate]:
    """Cards and phones as runs of neighbouring digit groups; from a group on there are at most as many as digits allow."""
    for i, (start, _) in enumerate(groups):
        digits = 0
        for j in range(i, min(i + 8, len(groups))):
            if j > i:
                between = zone[groups[j - 1][1] : groups[j][0]]
                if len(between) > 3 or "+" in between:
                    break
            digits += groups[j][1] - groups[j][0]
            if digits > 19:
                break
            end = groups[j][1]
            parts = j - i + 1
            inner = zone[start:end]
            if 13 <= digits <= 19 and "(" not in inner and ")" not in inner and (parts == 1 or all(b[0] - a[1] == 1 for a, b in zip(groups[i:j], groups[i + 1 : j + 1], strict=True))):
                yield Candidate(2, at + start, at + end, 0)
            if parts <= 6 and _dialled(zone, start, inner, digits, parts):
                first = start
                if first and zone[first - 1] == "(" and ")" in inner:
                    first -= 1
                if first and zone[first - 1] == "+":
                    first -= 1
                if inner.count("(") + (zone[first] == "(" or zone[first : first + 2] == "+(") == inner.count(")"):
                    yield Candidate(3, at + first, at + end, 1)


def _dialled(zone: str, start: int, inner: str, digits: int, parts: int) -> bool:
    """Whether so many digits from here on can be a phone number: with a sign or 00 before the country, a 0 before the area, ten digits, or seven in two parts."""
    if "+" in zone[max(0, start - 2) : start] or inner.startswith("00"):
        return 10 <= digits <= 15
    return digits == 10 or 9 <= digits <= 12 and inner[0] == "0" or digits == 11 and inner[0] == "1" or digits == 7 and parts == 2


def _colons(text: str) -> Iterator[Candidate]:
    last = 0
    for m in _COLONS.finditer(text):
        if m.start() < last:
            continue
        start, end = m.start(), m.end()
        while start > last and text[start - 1] in _HEX and m.start() - start < 40:
            start -= 1
        while end < len(text) and text[end] in _HEX and end - start < 46:
            end += 1
        last = end
        if end - start <= 39:
            try:
                ipaddress.IPv6Address(text[start:end])
            except ValueError:
                continue
            yield Candidate(1, start, end, 2)


def _spelt(text: str) -> Iterator[Candidate]:
    for m in _AT.finditer(text):
        left = _LOCAL_END.search(text, max(0, m.start() - 66), m.start())
        right = _SPELT.match(text, m.end())
        if left and right:
            yield Candidate(0, left.start(), right.end(), 4)


#: Words before an item that tell what it is, in the languages of the tables.
CUES = {
    "email": ("mail", "contact", "write to", "reach", "correo", "schreib", "adresse", "courriel"),
    "ip": ("ip", "host", "server", "address", "login", "client", "adresse", "direcc"),
    "card": ("card", "visa", "credit", "debit", "mastercard", "amex", "pay", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "cell", "whatsapp", "anruf", "appel", "llam", "reach"),
    "none": ("version", "isbn", "order", "invoice", "ref", "number", "no.", "id", "serial", "part", "section", "page", "date", "build", "rfc", "figure", "sum", "total", "price"),
}
TLDS = ("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at", "us", "ca", "au")
WIDTH = 33


def features(text: str, c: Candidate) -> list[float]:
    """Numbers for the trees: what the span looks like, what stands beside it, and words before it."""
    span, before, after = text[c.start : c.end], text[max(0, c.start - 40) : c.start], text[c.end : c.end + 12]
    groups = _GROUP.findall(span)
    digits = "".join(groups)
    seps = re.sub(r"[0-9]", "", span)
    low = before.lower()
    prev, nxt = before[-1:], after[:1]
    kind_of = lambda x: 0.0 if not x else 1.0 if x.isspace() else 2.0 if x.isalpha() else 3.0 if x.isdigit() else 4.0 if x in ".,;:!?" else 5.0 if x in "()[]{}\"'" else 6.0
    lengths = [len(g) for g in groups] or [0]
    nanp = digits[-10:] if len(digits) == 10 or len(digits) == 11 and digits[0] == "1" else ""
    domain = re.split(r"[^A-Za-z0-9-]+", span.rstrip())[-1].lower()
    return [
        float(c.kind), float(c.way), float(len(span)), float(len(digits)), float(len(groups)), float(min(lengths)), float(max(lengths)), float(lengths[0]), float(lengths[-1]),
        float(bool(digits) and luhn(digits)),
        float({"4": 1, "5": 2 if digits[1:2] in tuple("12345") else 0, "3": 3 if digits[1:2] in ("4", "7") else 0, "6": 4, "2": 5 if digits[1:2] in tuple("234567") else 0}.get(digits[:1], 0)),
        float(len(set(seps))), float("(" in span), float(span[:1] == "+") + 2 * (digits[:2] == "00") + 4 * (digits[:1] == "0" and digits[1:2] != "0"),
        float(len(set(digits))), float(bool(nanp) and nanp[0] > "1" and nanp[3] > "1") if nanp else -1.0,
        float("/" in span), float("." in seps), float("-" in seps), float(" " in seps), float(seps.count(":")),
        kind_of(prev), kind_of(nxt), float(prev in tuple("$€£#=")), float(bool(re.match(r"\s?(?:%|[€$£]|[a-zµ]{1,2}\b|[.,/:-]?[0-9])", after))),
        float(bool(re.search(r"[0-9][.,/:-]?\s?\Z", before))),
        float(bool(re.search(r"(?:19|20)[0-9]{2}(?:[^0-9]|\Z)|(?:^|[^0-9])(?:0?[1-9]|[12][0-9]|3[01])[./-](?:0?[1-9]|1[0-2])[./-]", span))),
        *(float(max((low.rfind(w) for w in CUES[k]), default=-1) + 1 + (40 - len(low)) * (max((low.rfind(w) for w in CUES[k]), default=-1) >= 0)) for k in KINDS[c.kind : c.kind + 1]),
        float(max((low.rfind(w) for w in CUES["none"]), default=-1) + 1),
        float(domain in TLDS), float(bool(re.search(r"[\[({<]", span))) + 2 * bool(re.search(r"\sdot\s", span, re.IGNORECASE)), float("@" in span), float(sum(x.isupper() for x in span)),
    ]


class Trees:
    """Gradient boosting for a yes or no: trees of fixed depth over binned features, logistic loss with second-order leaves, and a monotone calibration on held-out rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: int = 8):
        self.edges = [np.unique(np.quantile(f, np.linspace(0, 1, bins)[1:-1])) for f in x.T]
        self.depth, width = depth, bins
        b = self._bins(x)
        self.start = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        score = np.full(len(y), self.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node, split, cut = np.zeros(len(y), np.int64), np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins, np.int64)
            for level in range(depth):
                first, n = 2**level - 1, 2**level
                best = np.zeros(n)
                for f in range(x.shape[1]):
                    at = (node - first) * width + b[:, f]
                    gs, hs, ns = (np.bincount(at, w, n * width).reshape(n, width).cumsum(1) for w in (g, h, None))
                    gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                    gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                    gain[(ns < least) | (nt - ns < least)] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(n), k]
                    better = top > best + 1e-9
                    best[better] = top[better]
                    split[first + np.flatnonzero(better)], cut[first + np.flatnonzero(better)] = f, k[better]
                node = 2 * node + 1 + (b[np.arange(len(y)), split[node]] > cut[node])
            leaf = node - (2**depth - 1)
            value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2)
            self.trees.append((split, cut, value))
            score += value[leaf]
        self.steps = (np.array([-np.inf]), np.array([0.0]))

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, f, side="left") for e, f in zip(self.edges, x.T, strict=True)], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, out, rows = self._bins(x), np.full(len(x), self.start), np.arange(len(x))
        for split, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, split[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Monotone steps from raw scores to shares of right ones, by pooling neighbours that are out of order."""
        s = self.raw(x)
        o = np.argsort(s, kind="stable")
        pools: list[list[float]] = []  # first score, right, all
        for v, t in zip(s[o], y[o], strict=True):
            pools.append([v, float(t), 1.0])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                _, r, n = pools.pop()
                pools[-1][1] += r
                pools[-1][2] += n
        self.steps = np.array([-np.inf, *(p[0] for p in pools)]), np.array([0.0, *(p[1] / p[2] for p in pools)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.steps[1][np.searchsorted(self.steps[0], self.raw(x), side="right") - 1]


@dataclass
class Model:
    trees: Trees
    thresholds: tuple[float, ...]  # by kind; over 1: none of that kind is added

    def select(self, text: str, found: list[Candidate], chunk: int = 5000) -> list[tuple[int, int, int, float]]:
        """(start, kind, end, probability) of candidates at their kind's threshold or above: the likeliest that don't overlap; ties: the longer, then the earlier."""
        parts = (np.array([features(text, c) for c in found[i : i + chunk]]) for i in range(0, len(found), chunk))
        p = np.concatenate([self.trees.probability(x) for x in parts])
        good = [(q, c) for q, c in zip(p.tolist(), found, strict=True) if q >= self.thresholds[c.kind]]
        good.sort(key=lambda x: (-x[0], x[1].start - x[1].end, x[1].start, x[1].kind))
        taken: list[tuple[int, int, int, float]] = []
        used: set[int] = set()  # a span has at most some hundred characters
        for q, c in good:
            places = range(c.start, c.end)
            if used.isdisjoint(places):
                used.update(places)
                taken.append((c.start, c.kind, c.end, q))
        return taken


def _card(r: random.Random) -> str:
    head, n = r.choice([("4", 16), ("4", 16), ("51", 16), ("55", 16), ("34", 15), ("37", 15), ("6011", 16), ("4", 13)])
    digits = head + "".join(str(r.randrange(10)) for _ in range(n - len(head) - 1))
    return digits + next(d for d in "0123456789" if luhn(digits + d))


def _wrong(card: str) -> str:
    return card[:-1] + str((int(card[-1]) + 5) % 10)


def _number(r: random.Random, pattern: str) -> str:
    """# is a digit, N one from 2 to 9."""
    return "".join(str(r.randrange(10)) if c == "#" else str(r.randrange(2, 10)) if c == "N" else c for c in pattern)


def _name(r: random.Random) -> str:
    return "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiou") for _ in range(r.randint(2, 4)))


def _item(r: random.Random) -> tuple[str, int | None, str]:
    """(text before, kind or None, the item): what is planted, with a cue before it or without."""
    cue = lambda k, share: r.choice(CUES[KINDS[k]]) + r.choice([": ", " ", " is ", " = "]) if r.random() < share else ""
    what = r.randrange(16)
    if what < 3:
        shape = r.choice(["(N##) N##-####", "N##-N##-####", "N##.N##.####", "1-N##-N##-####", "1 (N##) N##-####", "+1 (N##) N##-####", "+## # ## ## ## ##", "+## ### ######", "00## ### #######"])
        return cue(3, 0.6), 3, _number(r, shape)
    if what == 3:  # shapes that only a cue tells from other numbers
        shape = r.choice(["N#########", "N## N## ####", "0# ## ## ## ##", "0### ######", "0## ### ####", "N##-####"])
        known = r.random() < 0.7
        return (cue(3, 1), 3, _number(r, shape)) if known else ("", None, _number(r, shape))
    if what < 7:
        card, c = _card(r), r.random()
        parts = [card[i : i + 4] for i in range(0, len(card), 4)] if len(card) != 15 else [card[:4], card[4:10], card[10:]]
        shown = card if c < 0.5 else r.choice([" ", ".", "-", "/", " ", "–"]).join(parts)
        return cue(2, 0.4), 2, shown
    if what == 7:
        groups = [f"{r.randrange(1, 65536):x}" for _ in range(8)]
        cut = r.randint(1, 5)
        return cue(1, 0.5), 1, ":".join(groups) if r.random() < 0.5 else ":".join(groups[:cut]) + "::" + ":".join(groups[cut + 2 :])
    if what == 8:
        return cue(1, 0.5), 1, r.choice(["[.]", "(.)"]).join(str(r.randrange(256)) for _ in range(4))
    if what < 11:
        at, dot = r.choice([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), ("[at]", "."), (" (at) ", "."), (" AT ", " DOT "), (" @ ", "."), ("{at}", "{dot}")])
        return cue(0, 0.5), 0, f"{_name(r)}{r.choice(['.', '', '_'])}{_name(r)}{at}{_name(r)}{dot}{r.choice(TLDS[:10])}"
    no = lambda x: (r.choice([*CUES["none"], "", "", ""]) + " ", None, x)
    return no(
        [
            lambda: _number(r, r.choice(["20##-0N-1#", "1#/0N/20##", "1#.0N.19## 1#:##:##", "20##-0N-1# 1#:##:##", "19##-19## 20##-20##", "20##/0N/1#"])),
            lambda: _wrong(_card(r)) if r.random() < 0.7 else " ".join(re.findall("....", _wrong(_card(r)))),
            lambda: _number(r, r.choice(["978-#-##-######-#", "N####### ########", "# ### ###", "## ## ## ## ##", "### ### ### ### ###", "#####################", "########", "############", "0.#### 0.#### 0.####", "N.##.##.#.###", "#-###-####", "### / ### / ####", "#################", "####-####", "##.###.###.###"])),
            lambda: f"{_name(r)} at {_name(r)}.{r.choice([*TLDS[:4], _name(r)])}",
            lambda: r.choice([":".join(_number(r, "##") for _ in range(r.choice([3, 6]))), f"{_name(r)}::{_name(r)}", "std::" + _name(r), f"{r.randrange(9)} @ {r.randrange(9)}.{r.randrange(99)}", f"{_name(r)} @{_name(r)}", f"{_name(r)} at {r.randrange(99)}.{r.randrange(99)}"]),
        ][what - 11]()
    )


def planted(slices: list[str], seed: int = 11) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Candidates' features and labels, slice by slice: items and look-alikes are put between the words of each; a candidate is right if it is a planted item.

    Candidates of the slice's own text have no label and are left out, and so are parts of an item; what runs past an item's end is wrong.
    """
    xs, ys = [], []
    for n, text in enumerate(slices):
        r = random.Random(seed * 1_000_003 + n)
        words = re.split(r"(\s+)", text)[: 2 * PLANTED * 6]
        places = sorted(r.sample(range(len(words)), min(PLANTED, len(words))))
        out, at, right, wrong = "", 0, {}, []
        for p in places:
            out, at = out + "".join(words[at:p]) + r.choice([" ", " ", "\n"]), p
            for _ in range(2 if r.random() < 0.25 else 1):  # items side by side
                cue, kind, item = _item(r)
                start = len(out) + len(cue)
                out += cue + item
                if kind is None:
                    wrong.append((start - len(cue), len(out)))
                else:
                    right[start, len(out)] = kind
                out += r.choice([" ", " ", " ", ", ", ". ", "; "])
        out += "".join(words[at:])
        x, y = [], []
        for c in scan(out)[1]:
            hit = right.get((c.start, c.end))
            near = [k for k in right if k[0] < c.end and c.start < k[1]]
            if hit is not None and hit == c.kind:
                y.append(1.0)
            elif near or any(s < c.end and c.start < e for s, e in wrong):
                y.append(0.0)
            else:
                continue
            x.append(features(out, c))
        xs.append(np.array(x, float).reshape(-1, WIDTH))
        ys.append(np.array(y))
    return xs, ys


def fit(slices: list[str], seed: int = 11) -> Model:
    """A model from at most CARRIERS slices of texts; no slice, as of an empty table, is one empty slice, so that a model is always there."""
    slices = (slices or [""]) * (1 if len(slices) > 40 else 40)
    xs, ys = planted(slices, seed)
    held = np.arange(len(xs)) % HELD == 0
    join = lambda z, keep: np.concatenate([v for v, k in zip(z, keep, strict=True) if k])
    trees = Trees(join(xs, ~held), join(ys, ~held))
    x, y = join(xs, held), join(ys, held)
    trees.calibrate(x, y)
    p, limits = trees.probability(x), []
    for k in range(len(KINDS)):
        mine = x[:, 0] == k
        cuts = [t for t in np.unique(p[mine]) if t > 0.5 and y[mine & (p >= t)].mean() >= PRECISION]
        limits.append(float(min(cuts, default=2.0)))
    return Model(trees, tuple(limits))


def sample(docs: DataFrame) -> list[str]:
    """At most CARRIERS slices of SLICE characters, from any place of a text; the same for the same texts. Those with the least digests, sought below a bound that about four times as many texts pass, so tasks return few rows."""
    n, h = docs.count(), F.xxhash64(F.lit(11), "text")
    start = F.pmod(h, F.greatest(F.length("text") - SLICE, F.lit(0)) + 1).cast("int") + 1
    cut = docs.filter(F.length("text") > 0).select(h.alias("h"), F.substring(F.col("text"), start, F.lit(SLICE)).alias("s"))

    def least(share: float) -> list[str]:
        few = cut.filter(F.col("h") < int(-(2**63) + share * (2**64 - 1))) if share < 1 else cut
        return [r["s"] for r in few.distinct().orderBy("h", "s").limit(CARRIERS).collect()]

    found = least(4 * CARRIERS / n if n else 1.0)
    # where most texts are copies of few, the bound can leave too few of them
    return found if len(found) >= CARRIERS // 4 else least(1.0)


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), model: Model | None = None, redacted: bool = False) -> DataFrame:
    """The columns `keep` with base (array of kind, start, end), spans (base and selected ones, with the score of those that the trees selected), and redacted text on request.

    Spans are in code points, end exclusive, by start, then kind. Base spans always stay; what the trees add overlaps no base span and no other added one. In redacted texts [KIND]
    stands for every span; overlapping spans are one. A null text is empty, and has no span; rows that repeat are judged alike; an empty table gives none; texts count whole, at any length.
    Columns that aren't kept aren't read. model: of fit(); by default it is fitted on sample(docs), the only thing the driver sees.
    """
    model = model or fit(sample(docs))
    names = [*keep, "text"]
    span = "array<struct<kind:string,start:int,end:int,score:double>>"
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, every, shown = [], [], []
            for t in b.column(b.num_columns - 1).to_pylist():
                t = t or ""
                own, found = scan(t)
                mine = [(s, k, e, None) for s, k, e in own]
                added = model.select(t, found) if found else []
                both = sorted([*mine, *added], key=lambda x: x[:3])
                base.append([{"kind": KINDS[k], "start": s, "end": e, "score": q} for s, k, e, q in mine])
                every.append([{"kind": KINDS[k], "start": s, "end": e, "score": q} for s, k, e, q in both])
                if redacted:
                    shown.append(_without(t, both))
            cols = [*b.columns[:-1], pa.array(base, out_type), pa.array(every, out_type)]
            cols += [pa.array(shown, pa.string())] if redacted else []
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names[:-1], "base", "spans"] + ["redacted"] * redacted)

    schema = ", ".join(x for x in (kept, f"base {span}", f"spans {span}", "redacted string" if redacted else "") if x)
    return docs.select(*names).mapInArrow(run, schema)


def _without(text: str, spans: list[tuple]) -> str:
    out, at = [], 0
    for s, k, e, _ in spans:
        if e <= at:
            continue
        out.append((text[at:s] + f"[{KINDS[k].upper()}]") if s >= at else "")
        at = e
    return "".join([*out, text[at:]])


def shown(spans):
    """An array of spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
