"""Token ids of whole texts by a public tokenizer file, loaded once in each Python worker."""

from __future__ import annotations

import base64
import os
import re

#: Texts of these characters only (Latin letters, digits, common punctuation, white space) are
#: split alike by both libraries whatever their Unicode version, so the faster one may take them.
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ſ‐-‧€]*")
SPECIAL = "<|endoftext|>"

_loaded: dict[tuple, tuple] = {}


class Encoder:
    """Ids as ``tokenizers`` gives them without added special tokens.

    With a rank file of the same vocabulary, plain texts go through ``tiktoken``, which yields the
    same ids in a third of the time. All other texts, and those with the text of a special token,
    go through ``tokenizers``.
    """

    def __init__(self, path: str, ranks_path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._full = Tokenizer.from_file(path)
        self._fast = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def ids(self, text: str) -> list[int]:
        if self._fast is not None and SPECIAL not in text and _PLAIN.fullmatch(text):
            return self._fast.encode_ordinary(text)
        return self._full.encode(text, add_special_tokens=False).ids


def encoder(path: str, ranks_path: str | None = None) -> Encoder:
    """The encoder of these files in this process."""
    key = (path, ranks_path)
    if key not in _loaded:
        _loaded[key] = Encoder(path, ranks_path)
    return _loaded[key]
