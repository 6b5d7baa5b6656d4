"""Base spans by the plain patterns, for comparison."""

import hashlib
import re

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for i, d in enumerate(reversed(digits)):
            x = int(d) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def digest(text):
    found = ",".join(f"{k}:{a}:{b}" for k, a, b in spans(text))
    return hashlib.sha256(found.encode()).hexdigest()
