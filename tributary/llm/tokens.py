"""Byte-level BPE ids of texts, by public tokenizer files."""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np

_END = "<|endoftext|>"


class Encoder:
    """Ids as ``tokenizers`` gives them for the JSON file, without special tokens added.

    The same merges are run by tiktoken, which is faster; ids are equal."""

    def __init__(self, json_path: str | None = None, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken
        self.json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
        ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.full = None

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.array([], np.uint32)
        if _END in text:  # a special token in the text itself: as the JSON file says
            if self.full is None:
                os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
                from tokenizers import Tokenizer
                self.full = Tokenizer.from_file(self.json_path)
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.plain.encode_ordinary(text), np.uint32)


@cache
def worker_encoder(json_path: str | None = None) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(json_path)
