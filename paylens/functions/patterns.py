"""Patterns written in Python's dialect (as JSON Schema contracts are checked) for the JVM."""

from __future__ import annotations

import re

#: Classes that hold more than ASCII in Python; their spelling inside a Java class.
_CLASSES = {"d": r"\p{Nd}", "s": r"\s\x1c-\x1f\x85\p{Z}", "w": r"\p{L}\p{N}_"}
_SAME_IN_JAVA = set("tnrfvxu\\^$.|?*+()[]{}-/ &~#@!%:;,<>=\"'`_")


def java_pattern(pattern: str) -> str:
    """The pattern with the same matches in Java.

    In Java ``$`` also lies before a carriage return and other line ends, ``.``
    excludes them, and the class letters are ASCII.  Constructs whose meaning is
    not known to be the same are refused.
    """
    re.compile(pattern)
    out, at, in_class = [], 0, False
    while at < len(pattern):
        c, rest = pattern[at], pattern[at + 1:]
        if c == "\\":
            letter = rest[0]
            if letter in _CLASSES:
                out.append(_CLASSES[letter] if in_class else f"[{_CLASSES[letter]}]")
            elif letter.lower() in _CLASSES and not in_class:
                out.append(f"[^{_CLASSES[letter.lower()]}]")
            elif letter == "Z" and not in_class:
                out.append(r"\z")
            elif letter == "A" and not in_class or letter in _SAME_IN_JAVA or letter.isdigit() and not in_class:
                out.append(c + letter)
            else:
                raise ValueError(f"No Java equivalent for \\{letter} in {pattern!r}")
            at += 2
            continue
        if in_class:
            in_class = c != "]"
            out.append("\\" + c if c == "[" or c == "&" else c)
        elif c == "[":
            in_class = True
            negated = rest.startswith("^")
            out.append("[^" if negated else "[")
            at += negated
            if pattern[at + 1] == "]":
                out.append(r"\]")
                at += 1
        elif c == "(" and rest.startswith("?"):
            if not re.match(r"\?(:|=|!|<=|<!)", rest):
                raise ValueError(f"No Java equivalent for ({rest[:2]} in {pattern!r}")
            out.append(c)
        else:
            out.append({"$": r"(?=\n?\z)", ".": r"[^\n]"}.get(c, c))
        at += 1
    return "".join(out)
