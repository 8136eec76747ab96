"""Personal data by rule: e-mail addresses, IP addresses, card and telephone numbers of a text.

Each kind's leftmost, non-overlapping matches of

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)        parts at most 255
    card   [0-9]([\\x20-]?[0-9])+                        16 to 19 digits, Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9]                   8 to 15 digits

in time linear in the text: addresses are found by their @ and read back from there, and digit runs are
taken whole, which gives the same matches, as none can begin or end within a run.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Digits doubled, their sum of digits.
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    return sum(int(d) if i % 2 == 0 else _DOUBLED[int(d)] for i, d in enumerate(reversed(digits))) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def ip_parts_ok(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str):
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if ip_parts_ok(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = digits_of(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return out
