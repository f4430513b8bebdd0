"""Splitting text into pre-tokens, as byte-level BPE tokenizers do before any merge."""

from __future__ import annotations

import functools
import re

import regex

#: Fixed value: the public pattern of this family of tokenizers.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
           r"""|\s+(?!\S)|\s+""")
#: The same for texts in which the standard library's classes mean the same characters; it
#: runs about twice as fast.
PLAIN = r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
#: Letters and numbers (hexadecimal) that the pattern engine here knows and those
#: of the tokenizer libraries do not know yet; to them, these are other characters.
NEWER = """
    558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d
    107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1
    1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff
    18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6
    1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5
    1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479
    3d000-3fc3f
"""
#: Characters below this are compared for that; a text with others takes the full pattern.
COMPARED = 0x2100


@functools.cache
def _splitters():
    same = []
    full = [regex.compile(p) for p in (r"\p{L}", r"\p{N}", r"\s")]
    plain = [re.compile(p) for p in (r"[^\W\d_]", r"\d", r"\s")]
    for c in map(chr, range(COMPARED)):
        if all(bool(f.match(c)) == bool(p.match(c)) for f, p in zip(full, plain)):
            same.append(c)
    newer = "".join("-".join(f"\\U{int(end, 16):08x}" for end in part.split("-")) for part in NEWER.split())
    same = [c for c in same if not regex.match(f"[{newer}]", c)]
    pattern = (PATTERN.replace(r"[^\s\p{L}\p{N}]", f"(?:[{newer}]|[^\\s\\p{{L}}\\p{{N}}])")
               .replace(r" ?\p{L}", f" ?[\\p{{L}}--[{newer}]]").replace(r" ?\p{N}", f" ?[\\p{{N}}--[{newer}]]"))
    odd = re.compile("[^" + "".join(map(re.escape, same)) + "]")
    return odd.search, re.compile(PLAIN).findall, regex.compile(pattern, regex.V1).findall


def splitter():
    """A function from text to its list of pre-tokens; joined, they are the text."""
    odd, plain, full = _splitters()
    return lambda text: full(text) if odd(text) else plain(text)
