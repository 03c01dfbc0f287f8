"""Where quoted CSV values open and close."""

from __future__ import annotations

import re

# From inside a quoted value to its closing quote; doubled quotes are content.
_CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')


def inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted value is open after ``line``. A quote opens one only at the start of a field."""
    at = 0
    while True:
        if inside:
            closed = _CLOSE.match(line, at)
            if not closed:
                return True
            at = line.find(",", closed.end())
            if at < 0:
                return False
        if at == 0 and line.startswith('"') and not inside:
            at, inside = 1, True
            continue
        opened = line.find(',"', at)
        if opened < 0:
            return False
        at, inside = opened + 2, True
