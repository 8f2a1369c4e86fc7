"""What a regular expression tells about the texts it can match."""

from __future__ import annotations


def _quantifier(regex: str, at: int) -> tuple[bool, int]:
    """Whether a quantifier at a place lets the item before it be missing, and where it ends."""
    if regex[at:at + 1] in ("*", "?"):
        missing, stop = True, at + 1
    elif regex[at:at + 1] == "+":
        missing, stop = False, at + 1
    elif regex[at:at + 1] == "{" and "}" in regex[at:]:
        stop = regex.index("}", at) + 1
        low = regex[at + 1:stop - 1].split(",")[0].strip()
        missing = not low.isdigit() or int(low) == 0
    else:
        return False, at
    while regex[stop:stop + 1] in ("?", "+") and regex[stop:stop + 1]:
        stop += 1
    return missing, stop


def _skip_class(regex: str, at: int) -> int:
    """The place after the character class that begins at ``at``; classes may be nested."""
    depth, first = 0, True
    while at < len(regex):
        c = regex[at]
        if c == "\\":
            at += 1
        elif c == "[":
            depth += 1
            first = True
            at += 1 + (regex[at + 1:at + 2] == "^")
            continue
        elif c == "]" and not first:
            depth -= 1
            if not depth:
                return at + 1
        first = False
        at += 1
    return at


def _skip_group(regex: str, at: int) -> int:
    """The place after the group that begins at ``at``."""
    depth = 0
    while at < len(regex):
        c = regex[at]
        if c == "\\":
            at += 1
        elif c == "[":
            at = _skip_class(regex, at)
            continue
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return at


def required_literal(regex: str) -> str:
    """The longest run of characters that every match contains; empty if none is certain.

    Only characters outside of groups and classes count. With alternatives outside of
    groups, inline flags or quoted stretches nothing is told.
    """
    runs, run, at = [""], "", 0
    if "\\Q" in regex or any(regex.startswith("(?" + f, i) for i in range(len(regex)) for f in "imsxudU-"):
        return ""
    while at < len(regex):
        c, single = regex[at], ""
        if c == "|":
            return ""
        if c == "\\":
            after = regex[at + 1:at + 2]
            if after.isalnum() or not after.isascii():
                # a class, a bound, or a code or name of more characters
                if after in "xucpPkN0":
                    return ""
            else:
                single = after
            stop = at + 2
        elif c == "[":
            stop = _skip_class(regex, at)
        elif c == "(":
            stop = _skip_group(regex, at)
        elif c in ".^$":
            stop = at + 1
        else:
            single, stop = c, at + 1
        missing, end = _quantifier(regex, stop)
        if single and not missing:
            run += single
        if not single or end > stop:
            runs.append(run)
            run = single if single and not missing and "+" in regex[stop:stop + 1] else ""
        at = end
    return max([*runs, run], key=len)
