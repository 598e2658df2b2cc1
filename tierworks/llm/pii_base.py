"""Personal data by pattern: exact spans of e-mails, IP addresses, cards and phones.

Each kind is scanned on its own, leftmost and without overlaps; a match that fails its
check is dropped and the scan goes on behind it. The patterns are written so that a long
run of one character class is read once: a match can only start where a run starts.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")

_LOCAL_BEFORE = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+(?<=[0-9])")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def is_card(text: str) -> bool:
    digits = "".join(_DIGIT.findall(text))
    return 12 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> list[tuple[int, int]]:
    """From each at sign backwards over the local part, as far as the last match allows."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL_BEFORE.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    return [
        m.span() for m in _IP.finditer(text)
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))
    ]


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 12 and is_card(m[0])]


def phones(text: str) -> list[tuple[int, int]]:
    return [
        m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15
    ]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then in the order of ``KINDS``."""
    found = [(a, b, "email") for a, b in emails(text)]
    if _DIGIT.search(text):
        for kind, scan in (("ip", ips), ("card", cards), ("phone", phones)):
            found += [(a, b, kind) for a, b in scan(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))
