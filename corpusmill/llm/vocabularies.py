"""Public byte-level vocabularies, read where they lie."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path


def place(name: str) -> str:
    """A vocabulary's path: ``name`` itself if it is one, else a file of the public set."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def byte_ranks(name: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Each token's bytes with its id, by which merges are ranked, and the special strings.

    For ``.json`` files the rank of a merge is that of the token it makes; that needs ids
    in the order of merges, which is checked.
    """
    path = Path(place(name))
    if path.suffix == ".tiktoken":
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, path.open("rb"))}, {}
    spec = json.loads(path.read_text())
    if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
        raise ValueError(f"not a plain byte-level vocabulary: {name}")
    letters, special = _letters(), {a["content"]: a["id"] for a in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
    last = -1
    for merge in spec["model"]["merges"]:
        made = vocab["".join(merge.split(" ") if isinstance(merge, str) else merge)]
        if made <= last:
            raise ValueError(f"ids are not in the order of merges: {name}")
        last = made
    return ranks, special


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def encoder(name: str) -> Callable[[str], list[int]]:
    """A text's ids; special strings in it become their ids, as the ``.json`` file's own library
    does by default. The ids are the same, the code three times as fast. Its pattern gives up on
    very long runs of white space; such a text goes to the file's own library."""
    import tiktoken

    ranks, special = byte_ranks(name)
    made = tiktoken.Encoding("public", pat_str=pattern(), mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        try:
            return made.encode(text, allowed_special="all", disallowed_special=())
        except ValueError:
            return _library(name).encode(text, add_special_tokens=False).ids

    return encode


@lru_cache(maxsize=4)
def _library(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(place(name))
