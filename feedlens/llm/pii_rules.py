"""Base patterns of personal data: spans in code points, leftmost and non-overlapping for each kind, in linear time."""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: No match starts inside a run of digits, as one that starts with the run finds the same end.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ with the local part before it and a domain of two labels or more after it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free))
            at = text.find("@", free)
        else:
            free = max(free, at + 1)
            at = text.find("@", at + 1)
    return found


def _ip(m: str) -> bool:
    parts = (p.lstrip("0") or "0" for p in m.split("."))
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _card(m: str) -> bool:
    d = digits_of(m)
    return 16 <= len(d) <= 19 and luhn(d)


def _phone(m: str) -> bool:
    return 8 <= len(digits_of(m)) <= 15


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind; matches that fail their kind's test are dropped, without another try inside them."""
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if _DIGIT.search(text):
        for kind, pattern, test in (("ip", _IP, _ip), ("card", _CARD, _card), ("phone", _PHONE, _phone)):
            if kind != "phone" or "+" in text:
                out[kind] = [m.span() for m in pattern.finditer(text) if test(m.group())]
    return out
