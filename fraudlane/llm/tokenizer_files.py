"""Vocabulary files of public tokenizers, read where the driver finds them; never copied."""

from __future__ import annotations

from functools import lru_cache


@lru_cache(maxsize=4)
def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@lru_cache(maxsize=4)
def rank_file(name: str = "byte_bpe_50k.tiktoken") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@lru_cache(maxsize=4)
def piece_model(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


#: The id that the rank file leaves free, used as the end token.
END_TOKEN = 50256
