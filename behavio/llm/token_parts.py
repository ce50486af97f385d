"""Texts cut into parts that tokenizers code independently.

Byte-level BPE never joins what lies before and after a single blank between two visible
characters, as its pre-tokeniser ends a word there; a sentencepiece BPE model does neither, if blanks
only lead its pieces.  So the ids of a text are those of its parts, and each part has to
be coded once a task.  Only blanks between characters that no Unicode version calls white space
are cut; what else follows a blank stays in one part."""

from __future__ import annotations

import json
import re

from .packing import WordIds, rank_encoder

LOOSE = re.compile(r" (?![!-~\w])|(?<![!-~\w]) ")
CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")


def parts_of(text: str) -> list[str]:
    """The first part, then the parts that each follow one blank."""
    return CUT.split(text) if LOOSE.search(text) else text.split(" ")


def in_merge_order(path: str) -> bool:
    """Whether each merge of a BPE vocabulary makes the next id, so that merging by id is merging by rank."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    last = -1
    for m in model["merges"]:
        a, b = m if isinstance(m, list) else m.split(" ")
        made = model["vocab"].get(a + b)
        if made is None or made <= last:
            return False
        last = made
    return True


def word_ids(path: str, tokenizer=None) -> WordIds:
    """Ids (little-endian unsigned 32-bit) of words after a blank; special strings are ordinary text.  A vocabulary whose ids
    are not in merge order is left to the library."""
    if tokenizer is None:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
    by_rank = rank_encoder(path)
    return WordIds(tokenizer, by_rank if by_rank and in_merge_order(path) else None)
