"""Visible lines of a page: repaired, trimmed, and joined where a price or speed was broken over several."""

from __future__ import annotations

import html
import re
from itertools import takewhile

MOJIBAKE = ("Ð", "Ñ", "Ã")  # fixed values: marks of UTF-8 that was read as Latin-1
LINE_CHARS = 800

# What a broken line holds, what it is joined to, and to how many such lines before it.
_AMOUNT = re.compile(r"\d[\d\s]{0,8}(?:[.,]\d+)?")
_MONEY_END = re.compile(r".*(?:₽|руб(?:\.|лей)?|р\.?)", re.I | re.S)
JOINS = (
    (re.compile(r"/?\s*(?:мес|месяц)", re.I), _MONEY_END, 1),
    (re.compile(r"(?:мбит|гбит|mbps|gbps)(?:/с)?", re.I), _AMOUNT, 1),
    (re.compile(r"(?:₽|руб(?:\.|лей)?|р\.?)\s*/?\s*(?:мес|месяц)", re.I), _AMOUNT, 2),
)


def _marks(value: str) -> int:
    return sum(value.count(m) for m in MOJIBAKE)


def repaired(value: str) -> str:
    """UTF-8 that was read as Latin-1 put right, up to twice, while its marks become fewer."""
    steps = [value]
    while len(steps) < 3 and _marks(steps[-1]):
        try:
            steps.append(steps[-1].encode("latin-1").decode("utf-8"))
        except UnicodeError:
            break
        if _marks(steps[-1]) >= _marks(steps[-2]):
            steps.pop()
            break
    return steps[-1]


def clean_lines(text: str) -> list[str]:
    """Lines of a text; single characters count only if they are digits."""
    trimmed = (repaired(re.sub(r"\s+", " ", x).strip(" |\t"))[:LINE_CHARS] for x in html.unescape(text).replace("\xa0", " ").splitlines())
    out: list[str] = []
    for line in trimmed:
        if len(line) > 1 or line.isdigit():
            reach = next((list(takewhile(before.fullmatch, out[: -many - 1 : -1])) for broken, before, many in JOINS if broken.fullmatch(line) and out and before.fullmatch(out[-1])), [])
            for back in range(1, len(reach) + 1):
                out[-back] += f" {line}"
            if not reach:
                out.append(line)
    return out
