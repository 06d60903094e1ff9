"""JSON that models get nearly right, mended by a stack machine over tokens: what is open stands on the stack, and each token closes, continues or completes it."""

from __future__ import annotations

import json
import re

#: What words mean; everything else without quotes is text.
WORDS = {"true": "true", "false": "false", "null": "null", "none": "null", "nil": "null", "undefined": "null", "nan": "null", "infinity": "null", "-infinity": "null"}
_QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "`": "`", "”": "”"}
_SKIP = re.compile(r"(?:\s+|//[^\n]*|/\*.*?(?:\*/|\Z)|#[^\n]*)+", re.DOTALL)
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_LOOSE = re.compile(r"[+-]?(?:[0-9][0-9_]*\.?[0-9_]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
_KEY = re.compile(r"[^\s:={}\[\],\"']+")
_BARE = re.compile(r"[^\n,{}\[\]\"]+")
_NEXT_KEY = re.compile(r"\s*[\"'“][^\"'“”\n]{0,200}[\"'”]\s*:")
_ESCAPES = frozenset('"\\/bfnrt')


class Broken(Exception):
    """No reading as JSON."""


def _quoted(text: str, at: int, key: bool, in_list: bool) -> tuple[str, int]:
    """The string that begins at a quote, as JSON, and where it ends. A quote closes it only if what follows can follow a string; others are part of it."""
    close, out, i = _QUOTES[text[at]], [], at + 1
    while i < len(text):
        c = text[i]
        if c == "\\":
            n = text[i + 1 : i + 2]
            if n == "u" and re.fullmatch("[0-9a-fA-F]{4}", text[i + 2 : i + 6]):
                out.append(text[i : i + 6])
                i += 6
            elif n == "x" and re.fullmatch("[0-9a-fA-F]{2}", text[i + 2 : i + 4]):
                out.append(f"\\u00{text[i + 2 : i + 4]}")
                i += 4
            elif n:
                out.append(c + n if n in _ESCAPES else n if n in "'`“”‘’" else "\\\\" + json.dumps(n, ensure_ascii=False)[1:-1])
                i += 2
            else:
                i += 1
            continue
        if c == close or (c == '"' and close == "”"):
            after = _SKIP.match(text, i + 1)
            to = after.end() if after else i + 1
            n = text[to : to + 1]
            if not n or key and (n in ":=,}{[-0123456789" or n in _QUOTES) or not key and n in ",}]" or in_list and n == ":" or in_list and (n in _QUOTES or n in "{[-0123456789") or not key and _NEXT_KEY.match(text, i + 1):
                return '"' + "".join(out) + '"', i + 1
            out.append('\\"' if c == '"' else c)
        elif c == '"':
            out.append('\\"')
        else:
            out.append(json.dumps(c, ensure_ascii=False)[1:-1] if c < " " else c)
        i += 1
    return '"' + "".join(out) + '"', i  # cut off


def _scalar(raw: str) -> str:
    """A value without quotes as JSON: a word that means something, a number (mended), else text."""
    raw = raw.strip()
    if raw.lower() in WORDS:
        return WORDS[raw.lower()]
    if _NUMBER.fullmatch(raw):
        return raw
    if re.fullmatch(r"0[xX][0-9a-fA-F]{1,16}", raw):
        return str(int(raw, 16))
    if _LOOSE.fullmatch(raw) and not re.match(r"[+-]?0[0-9]", raw):
        n = raw.replace("_", "").lstrip("+")
        n = re.sub(r"^(-?)\.", r"\g<1>0.", n)
        n = re.sub(r"\.(?=$|[eE])", ".0", n)
        if _NUMBER.fullmatch(n):
            return n
    return json.dumps(raw, ensure_ascii=False)


class Machine:
    """Objects and lists that are open, innermost last: [bracket, state, whether it has a member, the key that waits for its value]."""

    def __init__(self, text: str):
        self.text, self.at, self.out, self.stack = text, 0, [], []

    def run(self) -> str:
        start = re.search(r"[{\[]", self.text)
        if not start:
            raise Broken
        self.at = start.start()
        self._open()
        while self.stack:
            skipped = _SKIP.match(self.text, self.at)
            self.at = skipped.end() if skipped else self.at
            if self.at >= len(self.text) or self.text.startswith("```", self.at):
                while self.stack:
                    self._close()  # cut off: all that is open ends here
                break
            self._step(self.text[self.at])
        return "".join(self.out)

    def _open(self) -> None:
        c = self.text[self.at]
        self.stack.append([c, "key" if c == "{" else "value", False, None])
        self.out.append(c)
        self.at += 1

    def _close(self) -> None:
        kind, state, _, key = self.stack.pop()
        if kind == "{" and state == "value":
            self._member(None, key)
            self.out.append("null")
        self.out.append("}" if kind == "{" else "]")
        if self.stack:
            self.stack[-1][1] = "next"

    def _member(self, frame: list | None, key: str | None) -> None:
        has = frame[2] if frame else self.out[-1] not in ("{", "[")
        self.out.append(", " if has else "")
        if key is not None:
            self.out.append(f"{key}: ")
        if frame:
            frame[2], frame[3] = True, None

    def _value(self, top: list) -> None:
        c = self.text[self.at]
        self._member(top, top[3])
        top[1] = "next"
        if c in "{[":
            self._open()
        elif c in _QUOTES:
            value, self.at = _quoted(self.text, self.at, False, top[0] == "[")
            self.out.append(value)
        else:
            m = _BARE.match(self.text, self.at)
            raw = re.split(r"\s+(?:#|//|/\*)|\s*```", m[0])[0]
            pair = re.match(r"(\S+)\s+[A-Za-z_]\w*\s*:", raw) if top[0] == "{" else None  # a comma is missing before the next key
            raw = pair[1] if pair else raw
            self.out.append(_scalar(raw))
            self.at += len(raw)

    def _step(self, c: str) -> None:
        top = self.stack[-1]
        kind, state = top[0], top[1]
        if c in "}]":
            self._bracket(c, kind, state)
        elif c == ",":
            if kind == "{" and state == "value":
                self._member(top, top[3])
                self.out.append("null")
            elif state == "colon":
                raise Broken
            top[1] = "key" if kind == "{" else "value"
            self.at += 1
        elif state == "value" or state == "next" and kind == "[":
            if c in ":=":
                raise Broken
            self._value(top)
        elif state in ("key", "next"):
            if c in ":={[":
                raise Broken
            if c in _QUOTES:
                top[3], self.at = _quoted(self.text, self.at, True, False)
                if self.at >= len(self.text):
                    return  # a key that is cut off goes
            else:
                m = _KEY.match(self.text, self.at)
                top[3], self.at = json.dumps(m[0], ensure_ascii=False), m.end()
            top[1] = "colon"
        elif c in ":=":
            self.at += 2 if self.text.startswith("=>", self.at) else 1
            top[1] = "value"
        elif c in _QUOTES or c in "{[-" or c.isdigit():
            top[1] = "value"  # the colon is missing
        else:
            raise Broken

    def _bracket(self, c: str, kind: str, state: str) -> None:
        if state == "colon":
            raise Broken
        if (c == "}") == (kind == "{"):
            self.at += 1
            self._close()
        elif any((f[0] == "{") == (c == "}") for f in self.stack[:-1]):
            self._close()  # what is inside was not closed; the bracket is read again
        else:
            self.at += 1  # it closes nothing


def mend(text: str | None) -> str | None:
    """JSON of a text that nearly is: an object or a list, from the first bracket on; what comes after its end is ignored. None if there is no reading.

    Mended: quotes that are missing, single, curved or not escaped; keys without quotes; missing, doubled and trailing commas; missing colons; missing values
    (null); missing or crossed brackets; strings, lists and objects that are cut off (a cut key goes); comments; Python's and JavaScript's words; numbers such as .5, +1, 1_000 and 0x1F;
    raw line ends and wrong escapes in strings; code fences and prose around it.
    """
    try:
        out = Machine(text or "").run()
        json.loads(out)
        return out
    except (Broken, ValueError, RecursionError):
        return None
