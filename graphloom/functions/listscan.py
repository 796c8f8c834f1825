"""Top-level lists of a text with their nested items, by one scan with a memory of the items already counted."""

from __future__ import annotations

import re

_ITEM = re.compile(r"([-*+])\s+(?:\[[ xX]\]\s+)?|(\d+)[.)]\s+")
SHOWN, WIDE = 3, 50


def _shape(line: str):
    """(indent by twos, kind or None, blank, first number, text) of a line."""
    body = line.lstrip()
    m = _ITEM.match(line.strip())
    kind = None if not m else "unordered" if m[1] else "ordered"
    rest = line.strip()
    if m:
        rest = re.sub(r"^\d+[.)]\s+", "", re.sub(r"^[-*+]\s+(\[[ xX]\]\s+)?", "", rest))
    return (len(line) - len(body)) // 2 if body else 0, kind, not body, int(m[2]) if m and m[2] else 1, rest[:WIDE]


def scan(text: str | None) -> list[dict]:
    """A list begins at an item without indent and keeps its first item's kind. It takes items of its indent, counts
    deeper runs (blank lines inside them included), and goes on over one blank line if an item follows."""
    shapes = [_shape(x) for x in (text or "").splitlines()]
    counted: set[int] = set()
    out = []
    at = 0
    while at < len(shapes):
        indent, kind, _, first, _ = shapes[at]
        if at in counted or kind is None or indent:
            at += 1
            continue
        own, nested, shown, k = 0, 0, [], at
        while k < len(shapes):
            if k in counted:
                k += 1
                continue
            deep, item, blank, _, rest = shapes[k]
            if item and not deep:
                own += 1
                counted.add(k)
                shown.append(rest)
            elif item:
                j = k
                while j < len(shapes) and (j in counted or shapes[j][2] or shapes[j][1] and shapes[j][0] >= deep):
                    if j not in counted and not shapes[j][2]:
                        nested += 1
                        counted.add(j)
                    j += 1
            elif not (blank and k + 1 < len(shapes) and shapes[k + 1][1]):
                break
            k += 1
        out.append({"start": at + 1, "end": k, "kind": kind, "n_items": own, "n_total": own + nested, "preview": "|".join(shown[:SHOWN]), "first_number": first if kind == "ordered" else None})
        at = k
    return out
