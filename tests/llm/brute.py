"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import re
from itertools import combinations

from xxhash import xxh64_intdigest

SPACES = " \t\n\x0b\x0c\r"


def simhash(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACES:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items: list, linked) -> dict:
    """Each item's smallest reachable item."""
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(items, 2):
        if linked(a, b):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {x: find(x) for x in items}


_WORDS = "(password|passwd|secret|token|api_?key)"
_IS = r"""["']?\x20*[:=]\x20*["']?"""
_PARTS = {
    "assign": (re.compile(f"(?ai:{_WORDS}){_IS}([A-Za-z0-9+/_.=-]+)"), 2),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0),
    "hex": (re.compile("[0-9a-f]+"), 0),
    "login": (
        re.compile(f"(?ai:(username|user|login|client_id|account_id)){_IS}([A-Za-z0-9@._-]{{3,}})"),
        2,
    ),
    "endpoint": (
        re.compile(
            "(?:https?|ftps?|sftp|ssh|jdbc|postgres(?:ql)?|mysql|redis|mongodb|amqps?|s3)"
            "://[^\x00-\x20\"'<>]{4,}"
        ),
        0,
    ),
    "named": (
        re.compile(
            f"(?a:(?:[A-Za-z0-9_]{{0,40}}_(?i:key)|(?i:secret_)[A-Za-z0-9_]{{1,40}}){_IS}"
            "([A-Za-z0-9+/_=-]{8,}))"
        ),
        1,
    ),
    "mixed": (
        re.compile(
            r"""(?:(?<=[\x20\x09-\x0D"'=:,(\[])|^)[A-Za-z0-9+][A-Za-z0-9+/_=-]{19,}"""
        ),
        0,
    ),
}
_KINDS = [
    ("assign", "assign", 8, 10**9, "secret", False),
    ("access", "access", 16, 10**9, "partner", False),
    ("hex", "hex", 32, 10**9, "secret", False),
    ("short", "assign", 4, 7, "secret", True),
    ("run", "hex", 16, 31, "secret", True),
    ("login", "login", 3, 10**9, "partner", True),
    ("endpoint", "endpoint", 4, 10**9, "partner", True),
    ("named", "named", 8, 10**9, "secret", True),
    ("mixed", "mixed", 20, 10**9, "secret", True),
]


def _links(one: tuple, two: tuple, reach: int) -> bool:
    (s, _, kind, e, side, _), (start, _, other, end, far, _) = one, two
    apart = end <= s or start >= e
    free = apart or not {kind, other} & {"named", "mixed"}
    return side != far and start < e + reach and end > s - reach and free


def secrets(text: str | None, reach: int = 200) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all reported spans."""
    found = []
    for rank, (kind, name, least, most, side, weak) in enumerate(_KINDS):
        pattern, group = _PARTS[name]
        for m in pattern.finditer(text or ""):
            mixed = all(re.search(c, m[group]) for c in ("[a-z]", "[A-Z]", "[0-9]"))
            if least <= len(m[group]) <= most and (kind != "mixed" or mixed):
                found.append((m.start(), rank, kind, m.end(), side, weak))
    shown = [
        (s, rank, kind, e)
        for s, rank, kind, e, side, weak in found
        if not weak
        or any(_links((s, rank, kind, e, side, weak), x, reach) for x in found)
    ]
    return [(s, kind, e) for s, _, kind, e in sorted(shown)]
