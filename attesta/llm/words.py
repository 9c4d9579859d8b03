"""Splitting texts at places where a tokenizer's result cannot depend on context.

Public BPE tokenizers first cut a text by a pattern in which white space and
punctuation never join letters, so the pieces between certain boundaries can be
encoded on their own and joined. Only boundaries that hold for the patterns of
both supported tokenizers are used; a text with anything unusual near its white
space is cut by a slower, still exact rule.
"""

from __future__ import annotations

import os
import re
import sys
import types

ODD_SPACE = re.compile(r"[^\S \n]")
BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789àâäéèêëíîïóôöúûüçñß")


def load_tokenizer(path: str):
    """A tokenizer without truncation or padding, on one thread."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    place = {b: i for i, b in enumerate(hidden)}
    return [chr(256 + place[b]) if b in place else chr(b) for b in range(256)]


def worker_state(name: str) -> dict:
    """A dict that lives as long as the Python worker process, for caches."""
    return sys.modules.setdefault(f"_attesta_{name}", types.ModuleType(name)).__dict__


def worker_tokenizer(path: str):
    """The tokenizer of a file, loaded once per Python worker."""
    state = worker_state("tokenizers")
    if path not in state:
        state[path] = load_tokenizer(path)
    return state[path]


def without_tail(word: str) -> str:
    """The word without a final comma or full stop that follows a letter or digit."""
    return word[:-1] if len(word) > 1 and word[-1] in ".," and word[-2] in LETTERS else word


def unspaced(text: str) -> list[str]:
    """Pieces between spaces and line ends, for tokenizers that drop white space."""
    return text.replace("\n", " ").split(" ")


def spaced(text: str) -> list[str]:
    """Pieces with their leading space, whose concatenation is the text.

    A cut lies before a space between two non-space characters, and around a
    single line end between two such characters.
    """
    if (
        "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        or text[:1].isspace() or text[-1:].isspace() or ODD_SPACE.search(text)
    ):
        return BEFORE_SPACE.split(text)
    out: list[str] = []
    for line in text.split("\n"):
        first, *rest = line.split(" ")
        out.append(first)
        out.extend([" " + word for word in rest])
        out.append("\n")
    return out[:-1]
