"""A vocabulary as a regular expression that finds the longest entry at a place."""

from __future__ import annotations

from collections.abc import Iterable

# Branches tried one by one at a place; more of them are reached through groups guarded by a range.
FAN = 16


def _code(char: str) -> str:
    return rf"\x{{{ord(char):X}}}"


def _guarded(branches: list[tuple[str, str]]) -> str:
    """Alternatives, each under its first character (ascending), as a tree of ranges."""
    if len(branches) <= FAN:
        return "|".join(text for _, text in branches)
    size = -(-len(branches) // FAN)
    groups = [branches[i : i + size] for i in range(0, len(branches), size)]
    return "|".join(f"(?=[{_code(g[0][0])}-{_code(g[-1][0])}])(?:{_guarded(g)})" for g in groups)


def _node(children: dict) -> str:
    branches = [(char, _code(char) + _node(children[char])) for char in sorted(c for c in children if c)]
    if not branches:
        return ""
    return f"(?:{_guarded(branches)})" + ("?" if "" in children else "")


def longest(words: Iterable[str]) -> str:
    """Matches the longest of ``words`` that begins where it is tried; nothing at all if there is none.

    Words share their beginnings as in a trie: each character is looked at once, and a way that ends inside a word
    falls back to the last place where one ended.
    """
    root: dict = {}
    for word in words:
        node = root
        for char in word:
            node = node.setdefault(char, {})
        if word:
            node[""] = {}
    return _node(root) if root else r"(?!)"
