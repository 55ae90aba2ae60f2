"""Pre-tokens of the word-level BPE vocabulary, as the tokenizers library cuts them.

Most texts hold only printable ASCII and Latin letters up to U+024F, for which
normalisation is plain lower-casing and the cut is one regular expression.
Every other text goes through the library's own normaliser and pre-tokeniser.
"""

from __future__ import annotations

import functools
import re
import unicodedata

# Characters for which NFC changes nothing and lower-casing is per character.
_PLAIN = [c for c in map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0x250)])
          if c not in "İ­"]


def _cls(kind: str) -> str:
    return "".join(re.escape(c) for c in _PLAIN if unicodedata.category(c)[0] == kind)


_L, _N = _cls("L"), _cls("N")
_ODD = re.compile("[^" + "".join(map(re.escape, _PLAIN)) + "]")
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t\n\r {_L}{_N}]+")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    # a task has its own core; the library's threads would only contend for it
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _specials(path: str) -> re.Pattern:
    import json

    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    return re.compile("|".join(re.escape(t["content"]) for t in added) or r"(?!)")


@functools.lru_cache(maxsize=2)
def byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    bytes stand for themselves, the rest follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _cut(segment: str, path: str) -> list[str]:
    if not _ODD.search(segment):
        return _CUT.findall(segment.lower())
    tok = tokenizer(path)
    back = {c: b for b, c in byte_chars().items()}
    pieces = tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(segment))
    return [bytes(back[c] for c in p).decode("utf-8", "surrogatepass") for p, _ in pieces]


def pretokens(text: str, path: str) -> list[str]:
    """The pre-tokens of a text; a special string in the text is one of them."""
    if "<|" not in text:
        return _cut(text, path)
    out, at = [], 0
    for m in _specials(path).finditer(text):
        out += _cut(text[at:m.start()], path)
        out.append(m[0])
        at = m.end()
    return out + _cut(text[at:], path)


def is_special(piece: str, path: str) -> bool:
    return "<|" in piece and bool(_specials(path).fullmatch(piece))
